import csv
import random

import pytest
from pyspark.sql import functions as F

import docketflow as d

from .plans import physical

ROWS = [("a,b", 'say "hi"', "007"), ("NA", None, "1"), ("", " x ", "2")]
SCHEMA = "name string, note string, cik string"


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("ending", [".csv", ".parquet", ".PARQUET/"])
def test_round_trip(spark, small, tmp_path, ending):
    path = str(tmp_path / ("t" + ending))
    assert d.write_table(small, path)
    kept = {(r[0] or (None if "csv" in ending else r[0]), *r[1:]) for r in ROWS}
    assert {tuple(r) for r in d.scan_table(spark, path).collect()} == kept


def test_csv_is_all_text(spark, tmp_path):
    path = str(tmp_path / "n.csv")
    d.write_table(spark.range(3), path)
    assert dict(d.scan_table(spark, path).dtypes) == {"id": "string"}


def test_unknown_formats(spark, small, tmp_path):
    for act in (lambda: d.scan_table(spark, "x.txt"), lambda: d.scan_table(spark, "x", "orc"),
                lambda: d.write_table(small, str(tmp_path / "x"), "orc"),
                lambda: d.write_table(small, str(tmp_path / "x.csv"), if_exists="maybe")):
        with pytest.raises(ValueError):
            act()


def test_existing_output(spark, small, tmp_path):
    path = str(tmp_path / "t.parquet")
    assert not d.output_exists(spark, path)
    assert d.write_table(small, path)
    assert d.output_exists(spark, path)
    assert not d.write_table(small.limit(1), path, if_exists="skip")
    assert d.scan_table(spark, path).count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        d.write_table(small, path)
    assert d.write_table(small.limit(1), path, if_exists="overwrite")
    assert d.scan_table(spark, path).count() == 1


def test_nothing_to_write(spark, small, tmp_path):
    none = small.filter("name = 'zzz'").withColumn("filename", F.lit("a")).withColumn("year", F.lit(1))
    path = str(tmp_path / "none.parquet")
    assert not d.write_table(none, path)
    assert not d.write_parts(none, path)
    assert not d.write_documents(none, path)
    assert not d.output_exists(spark, path)


def test_parts_by_size(spark, tmp_path):
    path = str(tmp_path / "parts")
    d.write_parts(spark.range(0, 100, 1, 1), path, rows_per_part=30)
    files = d.list_parts(spark, path).collect()
    assert len(files) == 4 and all(f.bytes > 0 for f in files)
    assert [f.path for f in files] == sorted(f.path for f in files)


def test_numbered_parts(spark, tmp_path):
    path = str(tmp_path / "parts")
    numbered = spark.range(10).withColumn("part", F.expr("id div 4"))
    d.write_parts(numbered, path, folders=True)
    assert {p.name for p in (tmp_path / "parts").iterdir() if p.is_dir()} == {
        "part=000000", "part=000001", "part=000002",
    }
    assert spark.read.parquet(path + "/part=000001").count() == 4


def test_csv_keeps_line_breaks_and_kinds(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    rows = [("a\nb", 1), ('say "x",\r\ny', 2), (" p ", 3)]
    d.write_table(spark.createDataFrame(rows, "s string, n int"), path)
    got = sorted((r.s, r.n) for r in d.scan_table(spark, path).collect())
    assert [n for _, n in got] != [] and {s.replace("\r\n", "\n") for s, _ in got} == {
        s.replace("\r\n", "\n") for s, _ in rows
    }


def test_compact(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    d.write_parts(spark.range(0, 1000, 1, 20).withColumn("part", F.expr("id div 100")), source)
    assert d.list_parts(spark, source).count() == 20
    assert d.compact(spark, source, target, compression="gzip") == 1000
    assert d.list_parts(spark, target).count() < 20
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(1000))


def test_compact_needs_parts_of_one_schema(spark, tmp_path):
    source = tmp_path / "in"
    spark.range(3).write.parquet(str(source / "a"))
    spark.range(3).selectExpr("cast(id as string) as id").write.parquet(str(source / "b"))
    with pytest.raises(Exception, match="MERGE"):
        d.compact(spark, str(source), str(tmp_path / "out"))
    assert not d.output_exists(spark, str(tmp_path / "out"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        d.compact(spark, str(tmp_path / "empty"), str(tmp_path / "out"))


DOCS = [
    ("0007", 2020, "edgar/data/7/0007-20-1.txt", "<p>a</p>"),
    ("0007", None, "edgar/data/7/0007-20-2.txt", "<p>b</p>"),
    ("8", 2021, "short", "<p>c</p>"),
    ("", 2021, None, "<p>d</p>"),
]
STORED = [
    ("0007", "2020", "0007-20-1", "<p>a</p>"),
    ("0007", "unknown", "0007-20-2", "<p>b</p>"),
    ("8", "2021", "unknown", "<p>c</p>"),
    ("unknown", "2021", "unknown", "<p>d</p>"),
]


@pytest.mark.parametrize("by", [("year",), ("cik", "year")])
def test_documents(spark, tmp_path, by):
    df = spark.createDataFrame(DOCS, "cik string, year int, filename string, body string")
    path = str(tmp_path / "docs")
    d.write_documents(df, path, by)
    assert (tmp_path / "docs" / (f"{by[0]}=2020" if by == ("year",) else "cik=0007")).is_dir()
    got = {tuple(r) for r in d.scan_documents(spark, path).select("cik", "year", "accession", "body").collect()}
    assert got == set(STORED)
    one = d.scan_documents(spark, path, ciks=["0007"], years=[2020]).collect()
    assert [r.body for r in one] == ["<p>a</p>"]


def test_schema_check(spark):
    good = spark.createDataFrame([], d.FILING)
    assert d.check_schema(good, d.FILING) is good
    with pytest.raises(ValueError, match="year: expected int, found string"):
        d.check_schema(good.withColumn("year", F.lit("x")), d.FILING)
    with pytest.raises(ValueError, match="cik: expected string, found nothing"):
        d.check_schema(good.drop("cik"), d.FILING)


def test_work_path(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = d.work_path(spark, "x"), d.work_path(spark, "x")
    assert first != second and first.startswith(root)


VALUES = ["a", "", None, "x,y", 'say "so"', "two\nlines", "three\n\nmore\n", '"', '"\n"', " s ", "é\n€", "NA", ",", "\n"]


@pytest.fixture
def small_pieces(spark):
    """Files are cut into pieces of some hundred bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key in keys:
        spark.conf.unset(key)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_one_csv_file_with_line_breaks_is_read_by_many_tasks(spark, tmp_path, small_pieces, ending):
    rng = random.Random(3)
    rows = [[str(i), rng.choice(VALUES) or "", rng.choice(VALUES) or "", "z" * rng.randint(0, 30)] for i in range(900)]
    path = tmp_path / "one.csv"
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator=ending)
        writer.writerows([["n", "a b", "c", "d"], *rows])
    df = d.scan_table(spark, str(path))
    got = sorted(([r[0]] + [v or "" for v in r[1:]] for r in df.collect()), key=lambda r: int(r[0]))
    assert got == rows and df.columns == ["n", "a b", "c", "d"]
    assert len({r[0] for r in spark.read.text(str(path)).select(F.spark_partition_id()).collect()}) > 20
    tasks = {r[0] for r in df.select(F.spark_partition_id()).collect()}
    assert len(tasks) > 1


def test_csv_in_pieces_reads_as_whole_files_do(spark, tmp_path, small_pieces):
    rng = random.Random(4)
    rows = [(i, rng.choice(VALUES), rng.choice(VALUES), "y" * rng.randint(0, 2000) + "\n" + "w") for i in range(300)]
    path = str(tmp_path / "many.csv")
    df = spark.createDataFrame(rows, "n int, a string, b string, c string").repartition(4)
    d.write_table(df, path)
    pieces, whole = d.scan_table(spark, path), d.scan_table(spark, path, multiline=True)
    assert sorted(map(repr, pieces.collect())) == sorted(map(repr, whole.collect()))
    assert pieces.count() == 300


def test_csv_without_line_breaks_is_read_plainly(spark, tmp_path):
    path = str(tmp_path / "plain.csv")
    d.write_table(spark.createDataFrame([(1, 'a "b"'), (2, None)], "n int, a string"), path)
    df = d.scan_table(spark, path)
    assert "Exchange" not in physical(df)
    assert sorted(map(tuple, df.collect())) == [("1", 'a "b"'), ("2", None)]


def test_compaction_packs_parts_by_size_without_moving_rows(spark, tmp_path):
    """Uneven parts, some a hundred times others, become files of like size."""
    source, target = str(tmp_path / "parts"), str(tmp_path / "table")
    rng = random.Random(6)
    sizes = [rng.choice([20, 50, 400, 2000]) for _ in range(120)]
    rows = [(i, k, f"{rng.random()}{rng.random()}") for i, n in enumerate(sizes) for k in range(n)]
    spark.createDataFrame(rows, "i int, k int, noise string").write.partitionBy("i").parquet(source)
    total = sum(r.bytes for r in d.list_parts(spark, source).collect())
    assert d.compact(spark, source, target, file_bytes=total // 6) == len(rows)
    files = [r.bytes for r in d.list_parts(spark, target).collect()]
    assert 5 <= len(files) <= 9
    # All but the last are near their size; columns of longer files compress a little better.
    assert min(sorted(files)[1:]) * 2 > max(files)
    assert spark.read.parquet(target).agg(F.sum("k")).first()[0] == sum(k for _, k, _ in rows)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "134217728b"


def test_compaction_plans_no_exchange(spark, tmp_path, monkeypatch):
    source = str(tmp_path / "parts")
    spark.range(100).repartition(5).write.parquet(source)
    plans = []
    write = type(spark.range(1).write).parquet

    def noted(self, path, *rest, **options):
        plans.append(physical(self._df))
        return write(self, path, *rest, **options)

    monkeypatch.setattr(type(spark.range(1).write), "parquet", noted)
    assert d.compact(spark, source, str(tmp_path / "table")) == 100
    assert plans and not any("Exchange" in plan for plan in plans)
