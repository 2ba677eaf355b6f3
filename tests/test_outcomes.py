import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import docketflow as d
from docketflow.operators.joins import filtering_join

from .plans import physical

SITE = "https://www.sec.gov/"
ATTEMPTS = "filing_key bigint, attempt int, status_code int, body string"
RESPONSE = "url string, attempt int, status_code int, body string"


def resolved(spark, rows, **options):
    df = spark.createDataFrame([(1, *r) for r in rows], ATTEMPTS)
    r = d.resolve_attempts(df, ["filing_key"], **options).first()
    return r.attempt, r.status_code, r.body, r.ok


def test_attempts(spark):
    tries = [(1, 503, None), (2, 200, "x"), (3, 200, "y")]
    assert resolved(spark, tries) == (2, 200, "x", True)
    assert resolved(spark, tries, retry_limit=1) == (1, 503, None, False)
    assert resolved(spark, tries, retry_limit=0) == (None, None, None, False)
    assert resolved(spark, [(1, 200, ""), (2, 404, None)]) == (2, 404, None, False)
    assert resolved(spark, [(1, 200, ""), (2, 200, "z")]) == (2, 200, "z", True)
    # Error pages have bodies too: they neither win nor count as text.
    busy = [(1, 503, "<p>busy</p>"), (2, 200, "<p>real</p>")]
    assert resolved(spark, busy) == (2, 200, "<p>real</p>", True)
    assert resolved(spark, [(1, 404, "<p>no</p>")]) == (1, 404, None, False)
    early = resolved(spark, [(1, 200, ""), (2, 200, "z")], wins="status")
    assert early == (1, 200, "", False)
    assert resolved(spark, [(1, 200, "b"), (1, 200, "a")]) == (1, 200, "a", True)


def test_attempts_combine_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, 200, "x")], ATTEMPTS)
    plan = physical(d.resolve_attempts(df, ["filing_key"]))
    before, after = plan.split("Exchange", 1)
    assert "partial_min" in after and "Window" not in plan


def nodes(df, name):
    """The lines of the plan that name such a node, without the nodes' numbers."""
    return [line for line in physical(df).split("Initial Plan")[0].splitlines() if re.search(rf"[-+ ]{name}\b", line)]


@pytest.mark.parametrize("rule", ["A", "B"])
def test_bodies_pass_one_exchange_and_no_sort(spark, responses, splitting, rule):
    filings = spark.createDataFrame([(f, i) for i, f in enumerate(CASES)], "filename string, n int")
    for found in (d.resolve_documents(filings, responses, rule), d.resolve_attempts(responses)):
        plan = found._jdf.queryExecution().executedPlan()
        lines = plan.toString().splitlines()
        # Below an exchange or a sort stands what it works on.
        carrying = [i for i, line in enumerate(lines) if re.search(r"Exchange|Sort ", line) and re.search(r"\bbody#", lines[i + 1])]
        assert len(carrying) == 1 and "Exchange hashpartitioning(__place" in lines[carrying[0]]
        for kind in ("SortAggregate", "Sort", "SortMergeJoin"):
            assert not any(re.search(r"\bbody#", line) for line in nodes(found, kind))
        assert "ShuffledHashJoin" in plan.toString()


def test_equal_attempts_give_one_outcome(spark):
    again = [(1, 200, "same")] * 3 + [(1, 200, "x" * 40 + c) for c in "ab"]
    assert resolved(spark, again) == (1, 200, "same", True)
    longer = {resolved(spark, [(1, 200, "x" * 40 + c) for c in order])[2] for order in ("ab", "ba")}
    assert len(longer) == 1
    df = spark.createDataFrame([(1, *r) for r in again * 2], ATTEMPTS).repartition(3)
    assert d.resolve_attempts(df, ["filing_key"]).count() == 1


INDEX = '<table class="tableFile"><tr><th>h</th></tr><tr><td>1</td><td>d</td><td>{}</td><td>10-K</td></tr></table>'
CASES = {
    "edgar/data/1/d1.txt": ("✅ Success (direct)", "Archives/edgar/data/1/d1.txt", "<p>one</p>"),
    "edgar/data/1/d2.txt": ("❌ Filing fetch failed: 404", "Archives/edgar/data/1/d2.txt", None),
    "edgar/data/1/d3.txt": ("✅ Success (direct)", "Archives/edgar/data/1/d3.txt", None),
    "edgar/data/1/d4.txt": (
        "⚠️ Exception: no response landed", "Archives/edgar/data/1/d4.txt", None),
    "edgar/data/2/i1": ("✅ Success (index)", "Archives/x.htm", "<p>two</p>"),
    "edgar/data/2/i2": ("❌ Index fetch failed: 500", "Archives/edgar/data/2/i2/index.html", None),
    "edgar/data/2/i3": ("⚠️ No document table found", "Archives/edgar/data/2/i3/index.html", None),
    "edgar/data/2/i4": (
        "⚠️ No primary .htm/.html link found", "Archives/edgar/data/2/i4/index.html", None),
    "edgar/data/2/i5": ("❌ Filing fetch failed: 403", "Archives/y.htm", None),
    "edgar/data/2/i6": (
        "⚠️ Exception: no response landed", "Archives/edgar/data/2/i6/index.html", None),
    "a/b": ("⚠️ Invalid path: a/b", None, None),
    " ": ("❌ Missing or invalid Filename", None, None),
    None: ("⚠️ Invalid path: None", None, None),
}
LANDED = [
    ("Archives/edgar/data/1/d1.txt", 1, 503, None),
    ("Archives/edgar/data/1/d1.txt", 2, 200, "<p>one</p>"),
    ("Archives/edgar/data/1/d2.txt", 1, 404, None),
    ("Archives/edgar/data/1/d3.txt", 1, 200, ""),
    ("Archives/edgar/data/2/i1/index.html", 1, 200, "<p>come back</p>"),
    ("Archives/edgar/data/2/i1/index.html", 2, 200, INDEX.format('<a href="/Archives/x.htm">')),
    ("Archives/x.htm", 1, 200, "<p>two</p>"),
    ("Archives/edgar/data/2/i2/index.html", 1, 500, "<p>error</p>"),
    ("Archives/edgar/data/2/i3/index.html", 1, 200, "<p>moved</p>"),
    ("Archives/edgar/data/2/i4/index.html", 1, 200, INDEX.format('<a href="/Archives/x.pdf">')),
    ("Archives/edgar/data/2/i5/index.html", 1, 200, INDEX.format('<a href="/Archives/y.htm">')),
    ("Archives/y.htm", 1, 403, "<p>no</p>"),
]


@pytest.fixture(scope="module")
def responses(spark):
    return spark.createDataFrame([(SITE + u, *rest) for u, *rest in LANDED], RESPONSE)


def test_every_outcome(spark, responses):
    filings = spark.createDataFrame([(f, i) for i, f in enumerate(CASES)], "filename string, n int")
    found = d.resolve_documents(filings, responses).orderBy("n").collect()
    expected = [(s, SITE + u if u else None, b) for s, u, b in CASES.values()]
    assert [(r.status, r.filing_url, r.body) for r in found] == expected
    assert [r.ok for r in found] == [b is not None for _, _, b in CASES.values()]


def test_shared_addresses_and_repeats_are_all_answered(spark, responses):
    filings = spark.createDataFrame(
        [("edgar/data/2/i1",)] * 50 + [("a/b",)] * 50 + [(None,)] * 50, "filename string"
    )
    found = d.resolve_documents(filings, responses)
    counts = {r.status: r["count"] for r in found.groupBy("status").count().collect()}
    assert counts == {
        "✅ Success (index)": 50, "⚠️ Invalid path: a/b": 50, "⚠️ Invalid path: None": 50,
    }


def test_rule_a_goes_by_the_filing_index(spark):
    filings = spark.createDataFrame(
        [("edgar/data/7/0007-20-1.txt",), ("edgar/data/7/0007-20-2.txt",), ("a/b",)], "filename string"
    )
    index = SITE + "Archives/edgar/data/7/0007201/0007-20-1-index.htm"
    landed = spark.createDataFrame(
        [(index, 4, 200, INDEX.format('<a href="doc.htm">')), (SITE + "doc.htm", 1, 200, "<p>d</p>")],
        RESPONSE,
    )
    found = d.resolve_documents(filings, landed, "A", retry_limit=5).orderBy("filename").collect()
    assert [(r.filing_url, r.body, r.ok) for r in found] == [
        (None, None, False), (SITE + "doc.htm", "<p>d</p>", True), (None, None, False),
    ]


def test_outcome_records(spark):
    rows = [("A", "u1", "<p>x</p>", True, "✅ Success (index)"), ("B", "u2", None, False, "❌ no"),
            ("C", None, "", None, "✅ Success (direct)")]
    df = spark.createDataFrame(
        rows, "`Company Name` string, filing_url string, body string, ok boolean, status string"
    )
    out = d.outcome_records(df)
    assert out.columns == ["status", "filing_url", "filing_text", "cleaned_text", "company_name"]
    assert sorted(tuple(r) for r in out.collect()) == sorted([
        ("✅ Success", "u1", "<p>x</p>", "x", "A"), ("❌ no", "u2", None, None, "B"),
        ("✅ Success (direct)", None, None, None, "C"),
    ])
    counts = {r.status: r.records for r in d.status_counts(out).collect()}
    assert counts == {"✅ Success": 1, "❌ no": 1, "✅ Success (direct)": 1}


def test_pending(spark):
    items = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    done = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    for repeats in (False, True):
        left = d.pending(items, done, ["k", "v"], repeats).collect()
        assert sorted((r.k, r.v or "") for r in left) == [(1, "b"), (2, "")]


def test_repeated_keys_meet_no_task(spark, splitting):
    """One done key stands a hundred thousand times; each task gets it once."""
    items = spark.range(1000).selectExpr("concat('k', id) as k", "id")
    done = spark.range(0, 100_000, 1, 10).selectExpr("if(id % 10 = 0, concat('k', id div 10 % 500), 'k7') as k")
    left = d.pending(items, done, ["k"], repeats=True)
    assert left.count() == 500
    scanned = [f for f in left.inputFiles() if "keys-" in f]
    assert scanned and spark.read.parquet(*scanned).groupBy("k").count().filter("count > 1").isEmpty()


@pytest.fixture
def splitting(spark):
    """Adaptive execution that splits already small partitions, without broadcasts."""
    settings = {
        "autoBroadcastJoinThreshold": "-1", "adaptive.coalescePartitions.enabled": "false",
        "shuffle.partitions": "16", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "adaptive.advisoryPartitionSizeInBytes": "16k", "adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in settings.items():
        spark.conf.set("spark.sql." + key, value)
    yield
    for key in settings:
        spark.conf.unset("spark.sql." + key)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_hot_address_is_split_over_tasks(spark, responses, splitting):
    """A third of all filings share one index page, a third have no usable path."""
    name = (
        "case id % 3 when 0 then 'edgar/data/2/i1' when 1 then 'a/b' "
        "else concat('edgar/data/3/n', id, '.txt') end as filename"
    )
    filings = spark.range(0, 90_000, 1, 12).selectExpr(name, "id as line_no")
    found = d.resolve_documents(filings, responses).withColumn("task", F.spark_partition_id())
    totals, per_task = Counter(), Counter()
    # All columns are asked for: Spark goes by the size of what it moves.
    whole = [F.count(F.lit(1)).alias("count"), F.max("filename"), F.sum("line_no"), F.max("body"), F.max("filing_url")]
    for r in found.groupBy("task", "status").agg(*whole).collect():
        totals[r.status] += r["count"]
        per_task[r.task] += r["count"]
    assert totals == {
        "✅ Success (index)": 30_000, "⚠️ Invalid path: a/b": 30_000,
        "⚠️ Exception: no response landed": 30_000,
    }
    assert max(per_task.values()) < 30_000


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_filtering_join(spark, how):
    rows = [("hot", i) for i in range(50)] + [("cold", 0), ("b", 1), (None, 2), (None, 3)]
    left = spark.createDataFrame(rows, "k string, n int")
    right = spark.createDataFrame([("hot",)] * 20 + [("b",), (None,), ("zz",)], "k string")
    got = filtering_join(left, right, ["k"], how)
    kept = [r for r in rows if (r[0] in ("hot", "b")) == (how == "left_semi")]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, kept))
    assert got.columns == left.columns


def test_equal_rows_of_one_key_are_split_over_tasks(spark, splitting):
    left = spark.range(0, 100_000, 1, 20).selectExpr("'same' as k", "7 as n")
    right = spark.range(0, 3000, 1, 4).selectExpr("cast(id as string) as k")
    kept = filtering_join(left, right, ["k"], "left_anti").withColumn("task", F.spark_partition_id())
    per_task = [r["count"] for r in kept.groupBy("task").count().collect()]
    assert sum(per_task) == 100_000 and len(per_task) > 3


def test_filtering_join_shuffles_its_left_side_once(spark, splitting, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("cast(id as string) as k", "id as n").write.parquet(path)
    right = spark.range(5).selectExpr("cast(id as string) as k", "id as other")
    plan = physical(filtering_join(spark.read.parquet(path), right, ["k"], "left_semi"))
    assert plan.count("Exchange hashpartitioning") == 2 and "other" not in plan
