"""Expressions for the single fields of a filing."""

from pyspark.sql import functions as F

from ..fixed import CLOCK_YEARS, DATE_LAYOUTS, MONTH_NAMES, NAMED_MONTH, PERIOD_NAME, PLAIN_NUMBER
from .text import strip



def period_year(name):
    """Year of the period a listing file covers; null for other names."""
    return F.nullif(F.regexp_extract(name, PERIOD_NAME, 1), F.lit("")).cast("int")


def period_quarter(name):
    """Quarter (`QTR1`..`QTR4`) of the period a listing file covers, or null."""
    return F.upper(F.nullif(F.regexp_extract(name, PERIOD_NAME, 2), F.lit("")))


def clean_cik(col):
    """Company id as text without the `.0` left by number-typed columns."""
    return strip(F.regexp_replace(col, r"\.0$", ""))


def normalize_cik(col):
    """Company id reduced to its digits; a missing id becomes empty text."""
    digits = F.regexp_replace(clean_cik(strip(col)), r"[^\p{Nd}]", "")
    return F.coalesce(digits, F.lit(""))


def normalize_form(col):
    return F.upper(strip(col))


def parse_date(col):
    """Lenient date: any accepted layout becomes a date, everything else null.

    Layouts are brought to ISO order by patterns, so a bad value costs no exception,
    and the input appears twice only: Spark repeats it when it pushes filters down.
    """
    text = strip(col)
    iso = text
    for layout, replacement in DATE_LAYOUTS:
        iso = F.regexp_replace(iso, layout, replacement)
    # A month's name stands where its number would; three letters of it are enough.
    named = F.initcap(F.regexp_replace(F.regexp_extract(iso, NAMED_MONTH, 0), r"(?<=-[A-Za-z]{3})[A-Za-z]+", ""))
    iso = F.regexp_extract(iso, rf"^{CLOCK_YEARS}(?:-\d{{1,2}}-\d{{1,2}})?$", 0)
    return F.coalesce(iso.try_cast("date"), F.try_to_date(named, "yyyy-MMM-d"))


def month_name(month):
    """Label of a month number, `Sept` included."""
    return F.get(F.array(*[F.lit(m) for m in MONTH_NAMES]), month - 1)


def coerce_year(col):
    """Year text as a whole number; `2020.0` counts, anything else is null."""
    text = strip(col.cast("string"))
    # A cast alone would also take suffixes of type and hexadecimal numbers.
    number = F.when(text.rlike(PLAIN_NUMBER), text).try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("bigint"))
