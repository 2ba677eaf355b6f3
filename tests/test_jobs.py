"""The pipeline's steps end to end, in batch and as streams."""

import pytest
from pyspark.sql import functions as F

import docketflow as d
from docketflow.session import settings

from .test_index import HEADER, line, write_listing

SITE = "https://www.sec.gov/Archives/"


@pytest.fixture(scope="module")
def listings(tmp_path_factory):
    folder = tmp_path_factory.mktemp("listings")
    for quarter in (1, 2):
        rows = [
            line(f"CO {i}", "10-K" if i % 2 else "8-K", str(i), f"2020-0{3 * quarter}-1{i}",
                 f"edgar/data/{i}/{quarter}-{i}.txt")
            for i in range(8)
        ]
        write_listing(folder, f"2020_QTR{quarter}_company.idx", [*HEADER, *rows])
    return str(folder)


@pytest.fixture(scope="module")
def tables(spark, listings, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    filings, annual = str(folder / "filings.parquet"), str(folder / "annual.parquet")
    first = d.index_job(spark, listings, filings)
    second = d.annual_job(spark, filings, annual)
    return first, second, filings, annual


def test_index_and_annual_jobs(spark, listings, tables):
    first, second, filings, annual = tables
    assert first == {"written": True, "rows": 16, "sources": 2}
    assert second.pop("parts") >= 1
    assert second == {"written": True, "rows_in": 16, "rows_out": 8, "undated": 0}
    assert d.check_schema(d.scan_table(spark, filings), d.FILING).count() == 16
    assert d.index_job(spark, listings, filings, if_exists="skip") == {"written": False}


def test_annual_job_on_csv_and_first_batch(spark, tables, tmp_path):
    source = str(tmp_path / "f.csv")
    d.write_table(d.scan_table(spark, tables[2]), source)
    counts = d.annual_job(spark, source, str(tmp_path / "out"), max_batches=1)
    assert counts == {"written": True, "rows_in": 8, "rows_out": 4, "undated": 0, "parts": 1}
    none = d.scan_table(spark, tables[2]).filter("form_type = '8-K'")
    d.write_table(none, str(tmp_path / "none.parquet"))
    target = str(tmp_path / "nothing")
    assert d.annual_job(spark, str(tmp_path / "none.parquet"), target) == {"written": False}
    assert not d.output_exists(spark, target)


@pytest.mark.parametrize("rows_per_part", [None, 7])
def test_parts_follow_from_the_rows(spark, tmp_path, rows_per_part):
    """One file that many tasks share, of which only some meet its rows."""
    source, target = str(tmp_path / "f.parquet"), str(tmp_path / "out")
    rows = [("CO", "10-K", str(i), "2020-03-01", f"edgar/data/{i}/a.txt", 2020, "QTR1", "2020_QTR1_company.idx", i) for i in range(40)]
    d.write_table(spark.createDataFrame(rows, d.FILING).coalesce(1), source)
    d.write_table(spark.createDataFrame(rows, d.FILING).coalesce(1), source, if_exists="append")
    with settings(spark, spark__sql__files__openCostInBytes=0, spark__sql__files__maxPartitionBytes=1000):
        counts = d.annual_job(spark, source, target, rows_per_part=rows_per_part)
    sizes = sorted(r["count"] for r in spark.read.parquet(target).groupBy(F.input_file_name()).count().collect())
    assert sizes == ([3] + [7] * 11 if rows_per_part else [40, 40])
    assert counts == {"written": True, "rows_in": 80, "rows_out": 80, "undated": 0, "parts": len(sizes)}
    assert {r.line_no for r in spark.read.parquet(target).collect()} == set(range(40))


def test_fetch_job(spark, tables, tmp_path):
    annual = d.scan_table(spark, tables[3])
    urls = [SITE + r.filename for r in annual.orderBy(*d.FILING_ORDER).collect()]
    landed = [(u, 1, 200, f"<body>{i}<script>x</script></body>") for i, u in enumerate(urls) if i != 2]
    responses = spark.createDataFrame(landed, d.RESPONSE)
    target = str(tmp_path / "fetched")
    counts = d.fetch_job(spark, annual, responses, target, per_part=3)
    assert counts == {"written": True, "seen": 8, "ok": 7, "parts": 3}
    out = spark.read.parquet(target).orderBy("sourcefile", "line_no").collect()
    assert [r.part for r in out] == [0, 0, 0, 0, 1, 1, 1, 2]
    assert [r.cleaned_text for r in out] == ["0", "1", None, "3", "4", "5", "6", "7"]
    assert out[2].status == "⚠️ Exception: no response landed" and out[2].filing_text is None
    stored = spark.read.parquet(target).drop("part")
    assert d.check_schema(stored, d.FETCHED)
    assert d.fetch_job(spark, annual, responses, target, if_exists="skip") == {"written": False}
    with pytest.raises(ValueError, match="output exists"):
        d.fetch_job(spark, annual, responses, target)


def test_fetch_job_goes_on_where_it_stopped(spark, tables, tmp_path):
    annual = d.scan_table(spark, tables[3])
    landed = [(SITE + r.filename, 1, 200, "<p>x</p>") for r in annual.collect()]
    responses = spark.createDataFrame(landed, d.RESPONSE)
    target = str(tmp_path / "fetched")

    def run(**options):
        return d.fetch_job(
            spark, annual, responses, target, per_part=2, if_exists="append", **options
        )

    assert run(max_filings=3) == {"written": True, "seen": 3, "ok": 3, "parts": 2}
    assert run() == {"written": True, "seen": 5, "ok": 5, "parts": 3}
    assert run() == {"written": False}
    out = spark.read.parquet(target).orderBy("sourcefile", "line_no").collect()
    assert [r.part for r in out] == [0, 0, 1, 2, 2, 3, 3, 4]


def test_documents_job(spark, tables, tmp_path):
    filings = d.scan_table(spark, tables[2])
    index = '<table class="tableFile"><tr></tr><tr><td><td><td><a href="/{}.htm"><td>10-K</tr></table>'
    landed = []
    for r in d.select_filings(filings).collect():
        stem = r.filename.split("/")[-1].removesuffix(".txt")
        folder = f"{SITE}edgar/data/{r.cik}/{stem.replace('-', '')}/"
        landed.append((f"{folder}{stem}-index.htm", 1, 200, index.format(stem)))
        if r.cik != "7":
            landed.append((f"https://www.sec.gov/{stem}.htm", 2, 200, f"<p>{stem}</p>"))
    responses = spark.createDataFrame(landed, d.RESPONSE)
    store = str(tmp_path / "store")
    counts = d.documents_job(spark, filings, responses, store, ciks=["1", "7"])
    assert {k: counts[k] for k in ("written", "ok", "skipped", "fail", "selected", "companies")} == {
        "written": True, "ok": 2, "skipped": 0, "fail": 2, "selected": 4, "companies": 2,
    }
    assert counts["years"] == sorted(set(counts["years"])) != []
    done = d.scan_documents(spark, store, columns=None).toDF("key_cik", "key_year", "key_accession")
    counts = d.documents_job(spark, filings, responses, store, all=True, stored=done)
    assert (counts["ok"], counts["skipped"], counts["fail"], counts["selected"]) == (4, 2, 2, 8)
    counts = d.documents_job(spark, filings, responses, str(tmp_path / "few"), all=True, max_filings=3)
    assert counts["selected"] == 3
    assert d.documents_job(spark, filings, responses, store, ciks=["99"]) == {"written": False}
    bodies = {r.accession: r.body for r in d.scan_documents(spark, store).collect()}
    assert bodies == {f"{q}-{i}": f"<p>{q}-{i}</p>" for q in (1, 2) for i in (1, 3, 5)}


def test_clean_job(spark, tmp_path):
    pages = spark.createDataFrame([("<p>a</p>",)], "html string")
    assert d.clean_job(spark, pages, str(tmp_path / "clean"))
    assert spark.read.parquet(str(tmp_path / "clean")).first().cleaned_text == "a"


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_stream_resumes_where_it_stopped(spark, tables, tmp_path, fmt):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    filings = d.scan_table(spark, tables[2])
    halves = [filings.filter(F.col("quarter") == q) for q in ("QTR1", "QTR2")]

    def run():
        return d.stream_filter(spark, source, target, progress, fmt=fmt, files_per_batch=1)

    d.write_table(halves[0].repartition(3), source, fmt)
    assert len([p for p in run().recentProgress if p["numInputRows"]]) >= 2
    assert sum(p["numInputRows"] for p in run().recentProgress) == 0
    d.write_table(halves[1], source, fmt, if_exists="append")
    assert sum(p["numInputRows"] for p in run().recentProgress) > 0
    key = ["sourcefile", "line_no"]
    got = sorted(tuple(r) for r in spark.read.parquet(target).select(*key).collect())
    assert got == sorted(tuple(r) for r in d.filter_annual(filings).select(*key).collect())


def test_stream_of_pages(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = "page_id int, html string"
    spark.createDataFrame([(1, "<p>a</p>"), (2, None)], schema).write.parquet(source)
    d.stream_clean(spark, source, target, progress, schema)
    d.stream_clean(spark, source, target, progress, schema)
    assert {(r.page_id, r.cleaned_text) for r in spark.read.parquet(target).collect()} == {
        (1, "a"), (2, None),
    }
