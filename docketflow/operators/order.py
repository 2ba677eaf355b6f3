"""Order-dependent operators without a global sort.

Spark has no row order and a window without partitions moves every row into one
task; a window per source file moves a large file's rows into one task. Running totals
here go by ranges cut where the data say so (`ranges.py`): each range is summed on its own,
and what comes before it is one number. No task holds more than a range, whatever the skew.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schemas import FILING_ORDER
from .ranges import constants, find_bounds, range_of

RANGE_ROWS = 65_536


def running_total(df, value, order, out, group=None, restart=True, range_rows=RANGE_ROWS):
    """Add `out`: the sum of `value` over all rows before this one.

    `order` names an integer column, unique within `group`; a row without a position
    gets no number. With `restart` the total
    starts anew in each group, otherwise it runs on through the groups by name. Choose
    `range_rows` so that this many rows with their payload fit a task comfortably.

    The rows are counted, sampled and summed by range at once, over the columns concerned;
    numbering them is then one shuffle.
    """
    key = F.coalesce(F.col(group).cast("string"), F.lit("\0")) if group else F.lit("")
    df = df.withColumns({"__value": value.cast("bigint"), "__group": key, "__order": F.col(order).cast("bigint")})
    names = ["__group", "__order"]
    placed = df.filter(F.col("__order").isNotNull()).select(*names, "__value")
    bounds = find_bounds(placed, names, range_rows)
    before, first = _carried(placed, names, bounds, restart)

    # Rows without a position get no number; they stay with the task that has read them.
    apart = -1 - F.spark_partition_id()
    ranged = df.withColumn("__range", F.when(F.col("__order").isNotNull(), range_of(df, names, bounds)).otherwise(apart))
    by = ["__range", "__group"] if restart else ["__range"]
    within = W.partitionBy(*by).orderBy("__group", "__order").rowsBetween(W.unboundedPreceding, -1)
    total = F.coalesce(F.sum("__value").over(within), F.lit(0))
    carried = F.get(constants(before, "bigint"), F.col("__range"))
    if restart:
        goes_on = F.get(constants(first, "string"), F.col("__range")) == F.col("__group")
        carried = F.when(goes_on, carried).otherwise(0)
    number = F.when(F.col("__range") >= 0, total + carried)
    return ranged.withColumn(out, number).drop("__value", "__group", "__order", "__range")


def _carried(placed, names, bounds, restart):
    """For each range, what is summed up before it, and the group that this belongs to.

    With `restart` that is what earlier ranges hold of the range's first group.
    """
    if not bounds:
        return [0], [None]
    ranged = placed.withColumn("__range", range_of(placed, names, bounds))
    if restart:
        # Only the groups at both ends of a range matter to others.
        groups = ranged.groupBy("__range", "__group").agg(F.sum("__value").alias("n"))
        ends = F.struct("__group", F.col("n"))
        sums = groups.groupBy("__range").agg(F.min("__group").alias("first"), F.max(ends).alias("last"))
    else:
        sums = ranged.groupBy("__range").agg(F.struct(F.lit(None).cast("string"), F.sum("__value").alias("n")).alias("last"))
        sums = sums.withColumn("first", F.lit(None).cast("string"))
    before, first = [0] * (len(bounds) + 1), [None] * (len(bounds) + 1)
    group, total = None, 0
    for row in sorted(sums.collect(), key=lambda row: row["__range"]):  # one row for each range
        last, n = row["last"][0], row["last"][1] or 0
        first[row["__range"]] = row["first"]
        before[row["__range"]] = total if not restart or row["first"] == group else 0
        total = total + n if last == group else n
        group = last
    return before, first


def row_index(df, batch="sourcefile", order="line_no", out="row_index", range_rows=RANGE_ROWS):
    """Dense position from 0 of each row within its batch."""
    return running_total(df, F.lit(1), order, out, group=batch, range_rows=range_rows)


def nth_record(df, i, batch="sourcefile", order="line_no"):
    """The record at position `i` of every batch."""
    placed = row_index(df, batch, order, out="__at")
    return placed.filter(F.col("__at") == i).drop("__at")


def first_n(df, n, order=FILING_ORDER, range_rows=RANGE_ROWS):
    """The first `n` rows in order, or all when `n` is 0; filters come before it.

    Up to `range_rows` rows are kept by every task and then by one. Of more, the range that
    the cut falls into is found from counts by range: the ranges before it are kept
    whole, and of itself, which has about `range_rows` rows, the rows before the cut.
    """
    if not n or n <= range_rows:
        return df.orderBy(*order).limit(n) if n else df
    names = list(order)
    bounds = find_bounds(df, names, range_rows)
    ranged = df.withColumn("__range", range_of(df, names, bounds))
    counts = {row["__range"]: row["n"] for row in ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).collect()}
    left, cut = n, 0
    while cut <= len(bounds) and left >= counts.get(cut, 0):
        left, cut = left - counts.get(cut, 0), cut + 1
    kept = ranged.filter(F.col("__range") < cut)
    last = ranged.filter(F.col("__range") == cut).orderBy(*names).limit(left)
    return kept.unionByName(last).drop("__range").orderBy(*names)


def first_batches(df, n, batch="sourcefile"):
    """All rows of the first `n` batches by name, or all when `n` is 0."""
    if not n:
        return df
    names = df.select(batch).distinct().orderBy(batch).limit(n)
    # At most n names, so they go to the rows rather than the rows to them.
    return df.join(F.broadcast(names), batch, "left_semi").select(*df.columns)


def ordered(df, order=FILING_ORDER):
    """Rows in file order; the sort is by range, so a large file spans partitions."""
    return df.orderBy(*order)


def union_all(dfs, order=FILING_ORDER):
    """Tables stacked by column name; columns one of them lacks are null there."""
    stacked = None
    for df in dfs:
        stacked = df if stacked is None else stacked.unionByName(df, allowMissingColumns=True)
    if stacked is None:
        raise ValueError("nothing to union")
    return ordered(stacked, order)


def assign_part(df, order, ok, n, group=None, range_rows=RANGE_ROWS, out="part"):
    """Number the output part of each record; a part closes after its `n`-th success.

    Failures ride along uncounted: part = successes strictly before the row, over n.
    """
    if n < 1:
        raise ValueError("a part needs at least one success")
    counted = running_total(
        df, F.coalesce(ok.cast("int"), F.lit(0)), order, "__ok_before", group, False, range_rows
    )
    return counted.withColumn(out, F.expr(f"__ok_before div {n}")).drop("__ok_before")
