import datetime
import re

import pytest
from pyspark.sql import functions as F

import docketflow as d
from docketflow.fixed import LINE_BREAK, WHITESPACE_CHARS
from docketflow.functions.fields import month_name


def apply(spark, fn, values, dtype="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {dtype}")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_fixed_characters_are_those_of_python():
    every = [chr(i) for i in range(0x110000)]
    assert set(WHITESPACE_CHARS) == {c for c in every if c.isspace()}
    breaks = {c for c in every if len(f"a{c}b".splitlines()) == 2}
    assert breaks == {c for c in every if re.match(LINE_BREAK, c)}


def test_strip_matches_python(spark):
    values = [" a b　", "\x1fx\x1c", "\t\r\n", " mid dle ", "", "\x85q\x0b"]
    assert apply(spark, d.strip, values) == [v.strip() for v in values]


def test_split_lines_matches_python(spark):
    text = "a\rb\r\nc\x0bd\x0ce\x1cf\x1dg\x1eh\x85i j k\nl"
    assert apply(spark, d.split_lines, [text]) == [text.splitlines()]


def test_parse_date(spark):
    feb3 = datetime.date(2020, 2, 3)
    cases = {
        "2020-02-03": feb3,
        " 2020-02-03 ": feb3,
        "02/03/2020": feb3,
        "20200203": feb3,
        "Feb 3, 2020": feb3,
        "FEB 3, 2020": feb3,
        "2020-02-03T10:11:12": feb3,
        "2020-02-03 10:11": feb3,
        "2020": datetime.date(2020, 1, 1),
        "2020-02-30": None,
        "------------": None,
        "2020-02-03 junk": None,
        "2020-02-03T25:00:00": None,
        "1066-10-14": None,
        "9999-01-01": None,
        "": None,
        "soon": None,
        None: None,
    }
    assert apply(spark, d.parse_date, list(cases)) == list(cases.values())


def test_cik_forms_years(spark):
    assert apply(spark, d.clean_cik, ["320193.0", " 0007 ", None]) == ["320193", "0007", None]
    assert apply(spark, d.normalize_cik, [" 320193.0 ", "CIK-0007", None, "x"]) == [
        "320193", "0007", "", "",
    ]
    assert apply(spark, d.normalize_form, [" 10-k/a ", None]) == ["10-K/A", None]
    years = ["2020.0", "2020", " 2020 ", "x", None, "", "2020.5", "NaN", "1e3"]
    assert apply(spark, d.coerce_year, years) == [2020, 2020, 2020, None, None, None, None, None, 1000]


def test_period_names(spark):
    names = ["2020_QTR1_company.idx", "2020_qtr4_COMPANY.IDX", "old_1999_QTR2_company.idx",
             "listing.idx", "2020_QTR5_company.idx", "2020_QTR1_company.idx.gz"]
    assert apply(spark, d.period_year, names) == [2020, 2020, 1999, None, None, None]
    assert apply(spark, d.period_quarter, names) == ["QTR1", "QTR4", "QTR2", None, None, None]


def test_month_name(spark):
    assert apply(spark, month_name, [1, 9, 12, None], "int") == ["Jan", "Sept", "Dec", None]


def test_accession_parts(spark):
    good = "edgar/data/320193/0000320193-20-000096.txt"
    site = "https://www.sec.gov/Archives/edgar/data/320193/000032019320000096/"
    expected = ("320193", "0000320193-20-000096", site + "0000320193-20-000096-index.htm")
    got = apply(spark, d.accession_parts, [good, " " + good.replace("/", " / "), "a/b", None])
    assert [tuple(g) for g in got] == [expected, expected, (None,) * 3, (None,) * 3]


def test_fetch_target(spark):
    site = "https://www.sec.gov/Archives/"
    cases = {
        "edgar/data/1/x.TXT": ("direct", site + "edgar/data/1/x.TXT", None),
        "//edgar/y.html": ("direct", site + "edgar/y.html", None),
        "edgar/data/1/2": ("index", site + "edgar/data/1/2/index.html", None),
        "edgar/data/1/2/z.pdf": ("index", site + "edgar/data/1/2/index.html", None),
        "a/b": ("none", None, "⚠️ Invalid path: a/b"),
        "  ": ("none", None, "❌ Missing or invalid Filename"),
        None: ("none", None, "⚠️ Invalid path: None"),
    }
    assert [tuple(r) for r in apply(spark, d.fetch_target, list(cases))] == list(cases.values())


def test_links(spark):
    site = "https://www.sec.gov/"
    links = ["https://h/x", "http://h/x", "/x", "x", " /x "]
    assert apply(spark, d.absolute_url, links) == [
        "https://h/x", "http://h/x", site + "x", site + "x", site + "x",
    ]
    by_b = apply(spark, lambda c: d.absolute_url(c, "B"), ["https://h/x", "//x", "x"])
    assert by_b == [site + "https://h/x", site + "x", site + "x"]
    viewer = ["https://www.sec.gov/ix?doc=/A/x.htm", "https://www.sec.gov/A/x.htm", None]
    assert apply(spark, d.fix_viewer_url, viewer) == [site + "A/x.htm", site + "A/x.htm", None]


def test_period_arguments():
    assert d.year_list([2021, 2020, 2021]) == [2021, 2020]
    assert d.year_list(start_year=2019, end_year=2021) == [2019, 2020, 2021]
    for quarters in (None, []):
        assert d.quarter_list(quarters) == ["QTR1", "QTR2", "QTR3", "QTR4"]
    assert d.quarter_list(["qtr3", "QTR1", "qtr3"]) == ["QTR3", "QTR1"]
    for bad in (dict(), dict(start_year=2021, end_year=2020), dict(start_year=2020)):
        with pytest.raises(ValueError):
            d.year_list(**bad)
    with pytest.raises(ValueError):
        d.quarter_list(["QTR5"])


def test_plan_periods(spark):
    landed = spark.createDataFrame([("2021_QTR2_company.idx",)], "filename string")
    years = d.years_table(spark, [2021, 2020])
    plan = d.plan_periods(years, ["QTR2", "QTR1"], landed).orderBy("pos", "quarter").collect()
    assert [(r.year, r.quarter) for r in plan] == [(2021, "QTR1"), (2020, "QTR1"), (2020, "QTR2")]
    assert plan[0].url == "https://www.sec.gov/Archives/edgar/full-index/2021/QTR1/company.idx"


def test_layouts_of_dates(spark):
    given = [
        "2020/02/03", "February 3, 2020", "3 Feb 2020", "03-Feb-2020", "2020-02-03T10:00:00Z", "2020-02-03 10:00:00+05:30",
        "2/3/20", "2/3/98", "2020-02", "Febuary 3, 2020", "13/13/20", "3 Foo 2020",
    ]
    got = [str(v) if v else None for v in apply(spark, d.parse_date, given)]
    assert got == ["2020-02-03"] * 7 + ["1998-02-03", "2020-02-01", None, None, None]


def test_only_plain_numbers_are_years(spark):
    given = ["2020", " 2020.0 ", "2.02e3", "2020d", "2020f", "0x1p3", "NaN", "Infinity", "", None]
    assert apply(spark, d.coerce_year, given) == [2020, 2020, 2020] + [None] * 7
