import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import docketflow as d


def line(name, form, cik, date, path):
    return f"{name:<62}{form:<12}{cik:<12}{date:<12}{path}"


HEADER = [
    "Description:           Master Index",
    "Last Data Received:    March 31, 2020",
    "Comments:              x",
    "Anonymous FTP:         y",
    "", "", "",
    line("Company Name", "Form Type", "CIK", "Date Filed", "File Name"),
    "-" * 140,
]
ACME = "edgar/data/320193/0000320193-20-000096.txt"


def write_listing(folder, name, lines, newline="\n"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(newline.join(lines).encode("latin-1"))


def names(df):
    return [r.company_name for r in df.orderBy("sourcefile", "line_no").collect()]


@pytest.fixture
def listing(tmp_path):
    lines = [
        *HEADER,
        line("ACME CORP", "10-K", "320193", "2020-02-03", ACME),
        line("TWO WORDS", "SC 13D", "7", "2020-02-04", "edgar/data/7/x.txt"),
        "ONE SPACE 10-K    7   2020-02-03  edgar/data/7/x.txt",
        line("CAF\xc9\x85 INC", "10-Q", "8", "2020-02-05", "edgar/data/8/y.txt"),
        line("NBSP\xa0\xa0CO", "8-K", "9", "2020-02-06", "edgar/data/9/z.txt   "),
        "company name repeated   10-K   1   2020-01-01   edgar/a.txt",
        "Description:   something",
        "",
    ]
    write_listing(tmp_path, "2020_QTR1_company.idx", lines)
    return tmp_path


def test_pattern_layout(spark, listing):
    rows = (
        d.parse_index(d.scan_index(spark, str(listing))).orderBy("line_no").collect()
    )
    assert [(r.company_name, r.form_type, r.filename) for r in rows] == [
        ("ACME CORP", "10-K", ACME),
        ("INC", "10-Q", "edgar/data/8/y.txt"),
        ("NBSP\xa0\xa0CO", "8-K", "edgar/data/9/z.txt"),
    ]
    assert {(r.year, r.quarter, r.sourcefile) for r in rows} == {
        (2020, "QTR1", "2020_QTR1_company.idx")
    }


def test_fixed_layout_keeps_two_word_forms(spark, tmp_path):
    body = [
        line("ACME CORP", "10-K", "320193", "2020-02-03", ACME),
        line("TWO WORDS", "SC 13D", "7", "2020-02-04", "edgar/data/7/x.txt"),
        line("NO PATH", "10-K", "7", "2020-02-04", ""),
    ]
    write_listing(tmp_path, "listing.idx", [*HEADER, *body])
    rows = d.parse_index(d.scan_index(spark, str(tmp_path)), "fixed").orderBy("line_no").collect()
    assert [(r.company_name, r.form_type) for r in rows] == [
        ("ACME CORP", "10-K"), ("TWO WORDS", "SC 13D"),
    ]
    assert {(r.year, r.quarter) for r in rows} == {(None, None)}


def test_unknown_layout(spark, listing):
    with pytest.raises(ValueError):
        d.parse_index(d.scan_index(spark, str(listing)), "other")


def test_flat_and_recursive_scan(spark, tmp_path):
    row = line("A", "10-K", "1", "2020-01-02", "edgar/data/1/a.txt")
    write_listing(tmp_path, "2020_QTR1_company.idx", [row])
    write_listing(tmp_path, "2020_QTR2_COMPANY.IDX", [row])
    write_listing(tmp_path / "deep", "2020_QTR3_company.idx", [row])
    write_listing(tmp_path, "notes.txt", [row])
    flat = d.scan_index(spark, str(tmp_path))
    assert {r.sourcefile for r in flat.collect()} == {"2020_QTR1_company.idx"}
    deep = d.scan_index(spark, str(tmp_path), recursive=True)
    assert {r.sourcefile for r in deep.collect()} == {
        "2020_QTR1_company.idx", "2020_QTR2_COMPANY.IDX", "2020_QTR3_company.idx",
    }


def test_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        d.scan_index(spark, str(tmp_path / "none"))


def test_a_file_lost_after_listing(spark, tmp_path):
    for n in (1, 2):
        write_listing(tmp_path, f"2020_QTR{n}_company.idx", ["a", "b"])
    scanned = d.scan_index(spark, str(tmp_path))
    passing = d.scan_index(spark, str(tmp_path), skip_unreadable=True)
    (tmp_path / "2020_QTR1_company.idx").unlink()
    assert {r.sourcefile for r in passing.collect()} == {"2020_QTR2_company.idx"}
    with pytest.raises(Exception, match="does not exist"):
        scanned.collect()


def test_a_file_cut_by_a_fault_is_left_out_whole(spark, tmp_path):
    lines = [f"row {i}" for i in range(2000)]
    write_listing(tmp_path, "plain.idx", lines)
    write_listing(tmp_path, "2020_QTR1_company.idx", ["a", "b"])
    # The file system keeps checksums of what it copies, and so notices the fault.
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(str(tmp_path)).getFileSystem(spark._jsc.hadoopConfiguration())
    bad = tmp_path / "bad.idx"
    files.copyFromLocalFile(path(str(tmp_path / "plain.idx")), path(str(bad)))
    data = bytearray(bad.read_bytes())
    data[-700] ^= 1
    bad.write_bytes(bytes(data))
    found = d.unreadable_files(spark, str(tmp_path)).collect()
    assert [r.path.rsplit("/", 1)[1] for r in found] == ["bad.idx"]
    assert found[0].bytes == len(data) > found[0].bytes_read
    kept = d.scan_index(spark, str(tmp_path), skip_unreadable=True).groupBy("sourcefile").count()
    assert {r.sourcefile: r["count"] for r in kept.collect()} == {"plain.idx": 2000, "2020_QTR1_company.idx": 2}
    with pytest.raises(Exception, match="[Cc]hecksum"):
        d.scan_index(spark, str(tmp_path)).collect()


def test_line_numbers_across_splits_and_breaks(spark, tmp_path):
    lines = [f"row {i}" + ("\x85half" if i % 7 == 0 else "") for i in range(3000)]
    write_listing(tmp_path, "big.idx", lines, newline="\r\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        scanned = d.scan_index(spark, str(tmp_path))
        got = [r.line for r in scanned.orderBy("line_no").collect()]
        numbers = sorted(r.line_no for r in scanned.collect())
        splits = d.scan_index(spark, str(tmp_path), numbered=False).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert splits > 5
    expected = "\r\n".join(lines).splitlines()
    assert got == expected and numbers == list(range(len(expected)))


def test_same_listing_landed_in_pieces(spark, tmp_path):
    folder = tmp_path / "sourcefile=2020_QTR1_company.idx"
    write_listing(folder, "part-00000.idx", ["a", "b"])
    write_listing(folder, "part-00001.idx", ["c"])
    for recursive in (False, True):
        rows = d.scan_index(spark, str(tmp_path), recursive).orderBy("line_no").collect()
        assert [(r.sourcefile, r.line_no, r.line) for r in rows] == [
            ("2020_QTR1_company.idx", i, t) for i, t in enumerate("abc")
        ]


FIELD = st.text("Ab1-/ .\t\x1f\xa0", min_size=0, max_size=12)
LINES = st.lists(
    st.builds(
        "".join,
        st.tuples(
            FIELD, st.sampled_from([" ", "  ", "\t\xa0", "   \x1f "]),
            st.sampled_from(["10-K", "8-K/A", "SC 13D", ""]), st.sampled_from([" ", "   ", ""]),
            st.sampled_from(["123", "0007", "x1", ""]), st.sampled_from([" ", "\xa0 ", ""]),
            st.sampled_from(["2020-01-02", "2020-1-2", "-----"]), st.sampled_from([" ", "  ", ""]),
            FIELD,
        ),
    ),
    min_size=30, max_size=60,
)


# What a listing line looks like: name, form, company id, date, path.
LINE_PATTERN = r"^(.+?)\s{2,}(\S+)\s+(\d+)\s+(\d{4}-\d{2}-\d{2})\s+(.+)$"


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(LINES)
def test_fast_pattern_equals_plain_pattern(spark, lines):
    """The pattern written to fail fast accepts and captures what the plain one does."""
    df = spark.createDataFrame(list(enumerate(lines)), "line_no bigint, line string")
    df = df.withColumn("sourcefile", F.lit("s.idx"))
    got = {
        r.line_no: (r.company_name, r.form_type, r.cik, r.date_filed, r.filename)
        for r in d.parse_index(df).collect()
    }
    expected = {}
    for i, text in enumerate(lines):
        if text.strip() and not text.startswith("-----"):
            match = re.match(LINE_PATTERN, text)
            if match:
                expected[i] = tuple(g.strip() for g in match.groups())
    assert got == expected
