"""Which filings are annual reports, and which of them are wanted."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import ANNUAL_FORMS, SENTINEL_DATE
from ..functions.fields import (
    coerce_year,
    month_name,
    normalize_cik,
    normalize_form,
    parse_date,
)
from ..functions.once import with_once
from .joins import filtering_join

# Columns a selection of filings relies on.
SELECTION_COLUMNS = ("filename", "form_type", "cik", "year")


def keep_annual_forms(df, optional=False, canonical=False):
    """Keep the annual forms, compared stripped and in upper case.

    `canonical=True` says the stored forms are already in that shape: the filter then
    reaches the Parquet scan whole. Otherwise a necessary condition that does not
    depend on case or padding is pushed down, which skips row groups without it.
    `optional=True` lets a table without a form column pass unchanged.
    """
    if "form_type" not in df.columns:
        if optional:
            return df
        require_columns(df, ["form_type"])
    if canonical:
        return df.filter(F.col("form_type").isin(*ANNUAL_FORMS))
    return (
        df.filter(F.col("form_type").contains("10-"))
        .withColumn("form_type", normalize_form(F.col("form_type")))
        .filter(F.col("form_type").isin(*ANNUAL_FORMS))
    )


def add_filing_year(df):
    """Replace `year` by the filing year and `date_filed` by ISO text; bad dates drop."""
    columns = df.columns if "year" in df.columns else [*df.columns, "year"]
    dated = with_once(
        df, "__date", parse_date(F.col("date_filed")), keep=lambda day: day.isNotNull()
    )
    return (
        dated.withColumn("year", F.year("__date").cast("int"))
        .withColumn("date_filed", F.date_format("__date", "yyyy-MM-dd"))
        .select(*columns)
    )


def filter_annual(df, canonical=False):
    """Annual filings with a valid date, their year being the filing year."""
    return add_filing_year(keep_annual_forms(df, canonical=canonical))


def drop_sentinel_dates(df):
    """Drop rule lines taken for filings; rows without a date stay."""
    return df.filter(~F.col("date_filed").eqNullSafe(F.lit(SENTINEL_DATE)))


def add_month_year(df):
    """Filing date as a date, with month number, month label and year."""
    columns = [c for c in df.columns if c not in ("month", "year", "month_name")]
    dated = with_once(df, "date_filed", parse_date(F.col("date_filed")))
    return (
        dated.withColumn("month", F.month("date_filed").cast("int"))
        .withColumn("year", F.year("date_filed").cast("int"))
        .withColumn("month_name", month_name(F.col("month")))
        .select(*columns, "month", "year", "month_name")
    )


def require_columns(df, names):
    """Fail when `df` lacks any of `names`; checked on the schema, no job runs."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"input lacks required columns: {missing}")
    return df


def normalize_keys(df):
    """Form, company id and year in the shape selections compare."""
    require_columns(df, SELECTION_COLUMNS)
    return (
        df.withColumn("form_type", normalize_form(F.col("form_type")))
        .withColumn("cik", normalize_cik(F.col("cik")))
        .withColumn("year", coerce_year(F.col("year")))
    )


def _digits(values):
    texts = (str(v).strip().removesuffix(".0") for v in values)
    return sorted({"".join(filter(str.isdecimal, t)) for t in texts})


def select_filings(df, ciks=None, years=None, all=False):
    """Annual filings of the given companies and years; no list means no restriction.

    Either selector may be a list, a single value or, when it is large, a DataFrame
    with a `cik` or `year` column, which becomes a semi join. `all=True` ignores both.
    """
    chosen = normalize_keys(keep_annual_forms(df))
    if all:
        return chosen
    if isinstance(ciks, DataFrame):
        wanted = ciks.select(normalize_cik(F.col("cik").cast("string")).alias("cik"))
        chosen = filtering_join(chosen, wanted, ["cik"], "left_semi")
    elif ciks:
        listed = [ciks] if isinstance(ciks, (int, str)) else ciks
        chosen = chosen.filter(F.col("cik").isin(_digits(listed)))
    if isinstance(years, DataFrame):
        wanted = years.select(coerce_year(F.col("year")).alias("year"))
        chosen = filtering_join(chosen, wanted, ["year"], "left_semi")
    elif years:
        listed = [years] if isinstance(years, (int, str)) else years
        chosen = chosen.filter(F.col("year").isin(sorted({int(y) for y in listed})))
    return chosen
