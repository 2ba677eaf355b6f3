"""Counts, profiles and previews. All are map-side combined before any shuffle."""

from pyspark.sql import functions as F

from .annual import add_month_year, drop_sentinel_dates


def monthly_counts(df, by="month"):
    """Filings per month, months present only: (month, month_name, filings).

    In calendar order, or ascending by count with `by="count"`.
    """
    dated = add_month_year(drop_sentinel_dates(df)).filter(F.col("month").isNotNull())
    counts = dated.groupBy("month", "month_name").agg(F.count(F.lit(1)).alias("filings"))
    return counts.orderBy("filings", "month") if by == "count" else counts.orderBy("month")


def describe_text(df, col):
    """Count, distinct values, most frequent value and its frequency of a text column.

    Of equally frequent values the smallest is reported.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(
        F.count(F.lit(1)).alias("n")
    )
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("v").alias("v")))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        best.alias("best"),
    ).select(
        F.lit(col).alias("column_name"),
        "count",
        "unique",
        F.col("best.v").alias("top"),
        (-F.col("best.rank")).cast("bigint").alias("freq"),
    )


def count_distinct(df, *cols, approximate=False):
    """Distinct non-null values per column, one row per column, in one pass."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    wide = df.agg(*[count(F.col(c)).alias(c) for c in cols])
    return _unpivot(wide, cols, lambda c: [F.col(c).alias("distinct_values")])


def _unpivot(wide, cols, values):
    rows = [F.struct(F.lit(c).alias("column_name"), *values(c)) for c in cols]
    return wide.select(F.inline(F.array(*rows)))


def year_preview(df, n=10):
    """The first `n` distinct years ascending, each with whether there are more."""
    years = df.select(F.col("year").cast("int").alias("year")).dropna().distinct()
    # At most n + 1 values reach the last step.
    head = years.orderBy("year").limit(n + 1).agg(F.sort_array(F.collect_list("year")).alias("ys"))
    return head.select(
        F.explode(F.slice("ys", 1, n)).alias("year"), (F.size("ys") > n).alias("more")
    )


def status_counts(df):
    """Records per outcome."""
    return df.groupBy("status").agg(F.count(F.lit(1)).alias("records"))


def profile(df):
    """Type and non-null count of every column, in one pass over the table."""
    types = dict(df.dtypes)
    wide = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    return _unpivot(
        wide,
        df.columns,
        lambda c: [F.lit(types[c]).alias("dtype"), F.col(c).alias("non_null")],
    )


def shape(df):
    """Number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns))
    )


def batch_counts(df, kept, batch="sourcefile"):
    """Rows in and rows kept per batch; `kept` is the condition of the filter."""
    return df.groupBy(batch).agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_if(kept).alias("rows_out")
    )
