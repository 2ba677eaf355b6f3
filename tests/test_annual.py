import pytest
from pyspark.sql import functions as F

import docketflow as d

from .plans import physical

ROWS = [
    ("A", " 10-k ", "1.0", "2020-02-03", "edgar/data/1/a.txt", 2019),
    ("B", "10-K/A", "2", "02/30/2020", "edgar/data/2/b.txt", 2020),
    ("C", "10-K405", "3", "2020-01-01", "edgar/data/3/c.txt", 2020),
    ("D", None, "4", "2020-01-01", "edgar/data/4/d.txt", 2020),
    ("E", "10-KT", "5", "2020-01-01", "edgar/data/5/e.txt", None),
    ("F", "10-K/A\xa0", "CIK 006", "Jan 5, 2021", "edgar/data/6/f.txt", None),
    ("G", "10-K", "7", "------------", "edgar/data/7/g.txt", 2021),
]
SCHEMA = "company_name string, form_type string, cik string, date_filed string, filename string, year int"


@pytest.fixture(scope="module")
def filings(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def found(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_filter_annual(filings):
    got = found(d.filter_annual(filings), "company_name", "form_type", "date_filed", "year")
    assert got == [("A", "10-K", "2020-02-03", 2020), ("F", "10-K/A", "2021-01-05", 2021)]
    assert d.filter_annual(filings).columns == filings.columns


def test_form_filter_alone(filings):
    assert found(d.keep_annual_forms(filings), "company_name") == [("A",), ("B",), ("F",), ("G",)]
    without = filings.drop("form_type")
    assert d.keep_annual_forms(without, optional=True).count() == len(ROWS)
    with pytest.raises(ValueError, match="form_type"):
        d.keep_annual_forms(without)


def test_sentinel_dates(filings, spark):
    assert d.drop_sentinel_dates(filings).count() == len(ROWS) - 1
    nulls = spark.createDataFrame([(None,), ("------------",)], "date_filed string")
    assert found(d.drop_sentinel_dates(nulls), "date_filed") == [(None,)]


@pytest.mark.parametrize(
    "selection, expected",
    [
        ({}, "ABFG"),
        ({"ciks": ["1", "06"]}, "A"),
        ({"ciks": "006"}, "F"),
        ({"ciks": 1}, "A"),
        ({"years": 2021}, "G"),
        ({"years": ["2019", 2020]}, "AB"),
        ({"ciks": [1, 2], "years": [2020]}, "B"),
        ({"ciks": [1], "years": [2020], "all": True}, "ABFG"),
        ({"ciks": [], "years": []}, "ABFG"),
    ],
)
def test_select_filings(filings, selection, expected):
    got = found(d.select_filings(filings, **selection), "company_name")
    assert "".join(r[0] for r in got) == expected


def test_select_by_tables(spark, filings):
    ciks = spark.createDataFrame([(1,), (1,), (7,)], "cik bigint")
    years = spark.createDataFrame([("2021",)], "year string")
    got = d.select_filings(filings, ciks=ciks, years=years)
    assert found(got, "company_name") == [("G",)] and got.columns == filings.columns


def test_missing_columns(filings):
    with pytest.raises(ValueError, match=r"\['cik', 'year'\]"):
        d.select_filings(filings.drop("cik", "year"))


def test_filters_reach_the_scan(spark, filings, tmp_path):
    path = str(tmp_path / "f.parquet")
    d.write_table(filings, path)
    stored = d.scan_table(spark, path)
    canonical = physical(d.keep_annual_forms(stored, canonical=True))
    assert "PushedFilters: [In(form_type, [10-K,10-K/A])" in canonical
    plain = physical(d.monthly_counts(d.filter_annual(stored)))
    assert "StringContains(form_type,10-)" in plain
    assert "ReadSchema: struct<form_type:string,date_filed:string>" in plain


def test_dates_are_parsed_once(filings):
    out = d.filter_annual(filings).filter((F.col("year") > 2000) & (F.col("date_filed") > "2"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_to_date") == 1


def test_months(filings):
    rows = d.monthly_counts(d.filter_annual(filings)).collect()
    assert [tuple(r) for r in rows] == [(1, "Jan", 1), (2, "Feb", 1)]


def test_summaries(spark, filings):
    assert [tuple(r) for r in d.describe_text(filings, "form_type").collect()] == [
        ("form_type", 6, 6, " 10-k ", 1)
    ]
    twice = filings.unionByName(filings.filter("company_name = 'G'"))
    assert d.describe_text(twice, "company_name").first().top == "G"
    empty = d.describe_text(filings.limit(0), "cik").first()
    assert tuple(empty) == ("cik", 0, 0, None, None)
    assert {tuple(r) for r in d.count_distinct(filings, "year", "cik").collect()} == {
        ("year", 3), ("cik", 7),
    }
    assert d.count_distinct(filings, "cik", approximate=True).first().distinct_values == 7
    assert [tuple(r) for r in d.year_preview(filings, 2).collect()] == [(2019, True), (2020, True)]
    assert [tuple(r) for r in d.year_preview(filings, 3).collect()] == [
        (2019, False), (2020, False), (2021, False),
    ]
    assert tuple(d.shape(filings).first()) == (7, 6)
    profile = {r.column_name: (r.dtype, r.non_null) for r in d.profile(filings).collect()}
    assert profile["form_type"] == ("string", 6) and profile["year"] == ("int", 5)
