"""Ranges of a table's order, cut where the data say so.

Spark has no row order. To number rows without sorting them all, they are cut into ranges
of about equal size by bounds found in a sample of their keys. A row finds its range by
itself, by a binary search in an expression, so that nothing is moved for it; what has to
be known of each range is one row.
"""

import json
import math

from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: There are never more ranges, and sampled keys for each.
MOST_RANGES, SAMPLED = 1 << 14, 32
_SPREAD = 1 << 40


def _kept(n, wanted):
    """Rows of a sample of about `wanted` out of `n`; the same ones whenever it is taken."""
    return int(_SPREAD * min(1.0, wanted / max(n, 1)))


def find_bounds(keys, names, range_rows, rows=None):
    """The first keys of all ranges but the first, in order, as tuples.

    Ranges hold about `range_rows` rows each, more where that would take over
    `MOST_RANGES`. Equal keys are never parted.
    """
    n = keys.count() if rows is None else rows
    wanted = min(math.ceil(n / range_rows), MOST_RANGES)
    if wanted <= 1:
        return []
    part = F.pmod(F.xxhash64(*names), F.lit(_SPREAD))
    sample = keys.filter(part < _kept(n, wanted * SAMPLED)).select(*names)
    # A sample has at most some MOST_RANGES * SAMPLED keys, so one task puts them in order.
    # As a long: places times ranges pass 32 bits.
    nth = F.row_number().over(W.orderBy(*names)).cast("bigint") - 1
    many = F.count(F.lit(1)).over(W.partitionBy())
    placed = sample.select(*names, nth.alias("__nth"), many.alias("__many"))
    range_of_nth = F.floor(F.col("__nth") * wanted / F.col("__many"))
    before = F.floor((F.col("__nth") - 1) * wanted / F.col("__many"))
    first = placed.filter((F.col("__nth") > 0) & (range_of_nth > before))
    return sorted({tuple(row) for row in first.select(*names).collect()}, key=_in_order)


def _in_order(key):
    return [(value is not None, value.encode() if isinstance(value, str) else value) for value in key]


def _literal(values, schema):
    """Values as one constant, whatever their number."""
    return F.from_json(F.lit(json.dumps(values, default=str)), schema)


def constants(values, dtype):
    """An array of constants to look up by number."""
    return _literal(values, f"array<{dtype}>")


def range_of(df, names, bounds):
    """The number of the range that a row's key falls in: how many bounds are not above it."""
    if not bounds:
        return F.lit(0)
    fields = ", ".join(f"k{i}: {df.schema[name].dataType.simpleString()}" for i, name in enumerate(names))
    listed = _literal([{f"k{i}": v for i, v in enumerate(key)} for key in bounds], f"array<struct<{fields}>>")
    key = F.struct(*[F.col(f"`{name}`").alias(f"k{i}") for i, name in enumerate(names)])
    steps = len(bounds).bit_length()

    def step(at, size):
        above = F.get(listed, at + size - 1)
        return F.when(above <= key, at + size).otherwise(at)

    # Beyond the last bound there is null, which is not below anything.
    sizes = F.array(*[F.lit(1 << s) for s in reversed(range(steps))])
    return F.aggregate(sizes, F.lit(0), step)
