import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import docketflow as d
from docketflow.operators import ranges

from .plans import inputs_of_single_partitions, physical


@pytest.fixture(scope="module")
def skewed(spark):
    """One file holds most rows; positions have gaps; order on disk is random."""
    rng = random.Random(7)
    rows = [("hot.idx", n * rng.choice([1, 1, 3]) + 5 * n, rng.random() < 0.7) for n in range(4000)]
    rows = list({(s, n): (s, n, ok) for s, n, ok in rows}.values())
    rows += [(f"f{i}.idx", n, rng.random() < 0.5) for i in range(9) for n in range(i * 7)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "sourcefile string, line_no bigint, ok boolean")
    return sorted(rows), df.repartition(8).persist()


def brute_parts(rows, n):
    part, in_part, parts = 0, 0, {}
    for source, line, ok in rows:
        parts[source, line] = part
        in_part += ok
        if in_part == n:
            part, in_part = part + 1, 0
    return parts


@pytest.mark.parametrize("range_rows", [1, 64, 65536])
@pytest.mark.parametrize("n", [1, 37])
def test_parts_close_after_the_nth_success(skewed, n, range_rows):
    rows, df = skewed
    got = d.assign_part(df, "line_no", F.col("ok"), n, "sourcefile", range_rows).collect()
    assert {(r.sourcefile, r.line_no): r.part for r in got} == brute_parts(rows, n)


def test_part_needs_a_success():
    with pytest.raises(ValueError):
        d.assign_part(None, "line_no", None, 0)


@pytest.mark.parametrize("range_rows", [16, 65536])
def test_row_index_restarts_per_file(skewed, range_rows):
    rows, df = skewed
    expected, count = {}, {}
    for source, line, _ in rows:
        expected[source, line] = count.setdefault(source, 0)
        count[source] += 1
    got = d.row_index(df, range_rows=range_rows).collect()
    assert {(r.sourcefile, r.line_no): r.row_index for r in got} == expected


def test_rows_without_group_or_position_are_kept(spark):
    rows = [(None, 0), (None, 1), ("a", 0), ("a", None)]
    df = spark.createDataFrame(rows, "sourcefile string, line_no bigint")
    got = {(r.sourcefile, r.line_no): r.row_index for r in d.row_index(df).collect()}
    assert got == {(None, 0): 0, (None, 1): 1, ("a", 0): 0, ("a", None): None}


def test_positions_beyond_double_precision(spark):
    base = 1 << 60
    df = spark.createDataFrame([("a", base + i) for i in range(5)], "sourcefile string, line_no bigint")
    got = {r.line_no - base: r.row_index for r in d.row_index(df).collect()}
    assert got == {i: i for i in range(5)}


def test_no_window_over_all_records(spark, tmp_path):
    """Nothing meets in one task: sums by range are known when rows are numbered."""
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("'s' as sourcefile", "id as line_no", "true as ok").write.parquet(path)
    for range_rows in (10, 65536):
        numbered = d.assign_part(spark.read.parquet(path), "line_no", F.col("ok"), 10, "sourcefile", range_rows)
        assert not inputs_of_single_partitions(numbered)
        assert physical(numbered).count("Exchange") == 1


def test_records_are_shuffled_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr(
        "'s' as sourcefile", "id as line_no", "true as ok", "repeat('x', 50) as body"
    ).write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = d.assign_part(spark.read.parquet(path), "line_no", F.col("ok"), 10, "sourcefile")
        plan = physical(numbered)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    carrying = [
        i for i, line in enumerate(lines)
        if "Exchange" in line and any("body#" in below for below in lines[i + 1 : i + 3])
    ]
    assert len(carrying) == 1


def test_first_nth_and_batches(skewed):
    rows, df = skewed
    assert [tuple(r) for r in d.first_n(df, 5).collect()] == rows[:5]
    assert d.first_n(df, 0).count() == len(rows)
    assert d.first_batches(df, 0).count() == len(rows)
    names = sorted({r[0] for r in rows})[:2]
    kept = {tuple(r) for r in d.first_batches(df, 2).collect()}
    assert kept == {r for r in rows if r[0] in names}
    third = {tuple(r) for r in d.nth_record(df, 3).collect()}
    by_file = {}
    for r in rows:
        by_file.setdefault(r[0], []).append(r)
    assert third == {v[3] for v in by_file.values() if len(v) > 3}


def test_union_by_name_in_order(spark):
    a = spark.createDataFrame([("b.idx", 1, "x")], "sourcefile string, line_no bigint, cik string")
    b = spark.createDataFrame([(0, "b.idx"), (5, "a.idx")], "line_no bigint, sourcefile string")
    got = [tuple(r) for r in d.union_all([a, b]).collect()]
    assert got == [("a.idx", 5, None), ("b.idx", 0, None), ("b.idx", 1, "x")]
    with pytest.raises(ValueError):
        d.union_all([])


@pytest.mark.parametrize("n", [1, 99, 100, 1234, 4000, 10**6])
def test_first_n_by_ranges(skewed, n):
    rows, df = skewed
    got = d.first_n(df, n, range_rows=50)
    assert [tuple(r) for r in got.collect()] == rows[:n]


def test_first_n_of_many_leaves_no_task_with_all(spark):
    df = spark.range(200_000).selectExpr("'f' as sourcefile", "pmod(hash(id), 1000000000) as line_no", "id")
    chosen = d.first_n(df, 150_000, range_rows=10_000)
    assert chosen.count() == 150_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in chosen.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < 100_000
    last = chosen.agg(F.max("line_no")).first()[0]
    assert df.filter(F.col("line_no") < last).count() < 150_000 <= df.filter(F.col("line_no") <= last).count()


def test_very_many_groups(spark):
    df = spark.range(30_000).selectExpr("concat('g', id div 3) as sourcefile", "id * 7 as line_no", "id")
    got = d.row_index(df, range_rows=1000)
    assert got.filter("row_index <> id % 3").count() == 0
    assert not inputs_of_single_partitions(got)
    parts = d.assign_part(df, "line_no", F.lit(True), 10, "sourcefile", 1000)
    order = [r.part for r in parts.orderBy("sourcefile", "line_no").collect()]
    assert order == [i // 10 for i in range(30_000)]


def test_positions_all_over_64_bits_and_equal_ranges(spark):
    """Nine in ten positions lie close together, the others far apart."""
    rows = [("a", i if i % 10 else (i - 5000) * 10**14) for i in range(10_000)]
    df = spark.createDataFrame(rows, "sourcefile string, line_no bigint").repartition(5)
    expected = {position: i for i, (_, position) in enumerate(sorted(rows))}
    got = d.row_index(df, range_rows=100)
    assert {r.line_no: r.row_index for r in got.collect()} == expected


@given(st.lists(st.tuples(st.one_of(st.none(), st.text(max_size=2)), st.integers(-5, 5)), max_size=30))
@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
def test_a_key_falls_between_its_bounds(spark, keys):
    df = spark.createDataFrame(keys, "a string, b bigint")
    bounds = ranges.find_bounds(df, ["a", "b"], 2)
    number = ranges.range_of(df, ["a", "b"], bounds)
    order = lambda key: (key[0] is not None, (key[0] or "").encode(), key[1])
    for row in df.withColumn("r", number).collect():
        assert row.r == sum(order(b) <= order((row.a, row.b)) for b in bounds)


def test_bounds_of_very_many_ranges(spark):
    """Places times ranges pass 32 bits."""
    keys = spark.range(140_000).select(F.col("id").alias("key"))
    bounds = ranges.find_bounds(keys, ["key"], 1)
    assert len(bounds) == ranges.MOST_RANGES - 1
    gaps = [b[0] - a[0] for a, b in zip(bounds, bounds[1:])]
    assert min(gaps) >= 8 and max(gaps) <= 9
