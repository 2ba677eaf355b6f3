"""Which periods to land and which filings are still to be stored."""

from pyspark.sql import functions as F

from ..fixed import LISTING_BASE, QUARTERS
from ..session import staged
from .joins import filtering_join


def quarter_list(quarters=None):
    """Quarters in the order asked for, without repeats; none given means all four."""
    asked = [q.upper() for q in quarters or QUARTERS]
    unknown = [q for q in asked if q not in QUARTERS]
    if unknown:
        raise ValueError(f"invalid quarters {unknown}: use {', '.join(QUARTERS)}")
    return list(dict.fromkeys(asked))


def year_list(years=None, start_year=None, end_year=None):
    """Years in the order asked for, without repeats, or those of an inclusive range."""
    if not years:
        if start_year is None or end_year is None or start_year > end_year:
            raise ValueError("give years, or a start_year that is not after end_year")
        years = range(start_year, end_year + 1)
    return list(dict.fromkeys(years))


def years_table(spark, years):
    """A list of years as the table `plan_periods` takes, in list order."""
    return spark.createDataFrame(list(enumerate(years)), "pos bigint, year int")


def plan_periods(years, quarters=None, landed=None):
    """Listings to fetch: (pos, year, quarter, filename, url), landed ones left out.

    `years` is a table (pos, year): repeats keep their first position. `landed` is a
    table with a `filename` column.
    """
    first = years.groupBy("year").agg(F.min("pos").alias("pos"))
    listing = [F.lit(q) for q in quarter_list(quarters)]
    # Each year carries its quarters: an explode, not a join.
    plan = first.select(
        "pos", F.col("year").cast("int").alias("year"), F.explode(F.array(*listing)).alias("quarter")
    ).withColumns(
        {
            "filename": F.concat_ws("_", F.col("year"), F.col("quarter"), F.lit("company.idx")),
            "url": F.concat(
                F.lit(LISTING_BASE), F.col("year"), F.lit("/"), "quarter", F.lit("/company.idx")
            ),
        }
    )
    if landed is None:
        return plan
    return plan.join(landed.select("filename").distinct(), "filename", "left_anti").select(
        *plan.columns
    )


def pending(items, done, keys, repeats=False):
    """Items whose keys are not among `done`; items with a missing key are pending.

    `repeats` says that `done` may hold one key very many times: its keys are then written
    once to the shared working folder, each one time, and joined from there.
    """
    if repeats:
        done = staged(done.select(*keys).distinct(), "keys")
    return filtering_join(items, done, keys, "left_anti")
