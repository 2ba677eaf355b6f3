"""Computed columns that Spark evaluates once per row."""

from pyspark.sql import functions as F


def with_once(df, name, col, keep=None):
    """Add or replace column `name`, computed exactly once for each row.

    Catalyst inlines a computed column into every later expression and pushes later
    filters below it, which repeats a costly expression many times over. A generator
    is a boundary for both, and stays within code generation. `keep`, a condition on
    the new column, is applied to the finished value.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != name]
    computed = df.select(*others, F.explode(F.array(col)).alias(name))
    return computed if keep is None else computed.filter(keep(F.col(name)))
