"""Listing lines to filings."""

from pyspark.sql import functions as F

from ..fixed import (
    FIXED_BOUNDS,
    HEADER_LINES,
    HEADING_START,
    RULE_START,
    WHITESPACE_CHARS,
)
from ..functions.fields import period_quarter, period_year
from ..functions.once import with_once
from ..functions.text import strip
from ..schemas import FILING

FIELDS = ("company_name", "form_type", "cik", "date_filed", "filename")
# The line pattern, written to fail fast. White space is spelled out for Latin-1
# text, runs never give back what they took (the next field could not use it), and a
# name is only ended where a run of white space starts.
_S = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0]"
_N = _S.replace("[", "[^")
_FAST_PATTERN = (
    rf"^(.+?)(?:(?<={_N})|(?<=^.)){_S}{{2,}}+({_N}++){_S}++(\d++){_S}++"
    rf"(\d{{4}}-\d{{2}}-\d{{2}}){_S}+(.+)$"
)
# Cannot occur in Latin-1 text.
_MARK = "\ue000"


def is_data_line(col):
    """True unless the line is blank, a rule or the column heading."""
    return (
        col.rlike(f"[^{WHITESPACE_CHARS}]")
        & ~col.startswith(RULE_START)
        & ~F.lower(col).startswith(HEADING_START)
    )


def strip_all(df):
    """Strip whitespace from every text column."""
    text = {name for name, dtype in df.dtypes if dtype == "string"}
    return df.select(*[strip(F.col(c)).alias(c) if c in text else F.col(c) for c in df.columns])


def parse_index(lines, layout="pattern"):
    """Filings from lines (sourcefile, line[, line_no]); a narrow, shuffle-free plan.

    `pattern` keeps lines of the shape name, one-word form, digits, ISO date, path.
    `fixed` cuts at column bounds, skips the header lines and needs `line_no`.
    """
    if layout == "pattern":
        # One regular-expression pass marks the field bounds, a cheap split cuts there.
        marked = F.regexp_replace("line", _FAST_PATTERN, _MARK.join(f"${i}" for i in range(1, 6)))
        parts = F.split(marked, _MARK, -1)
        rows = with_once(
            lines.filter(is_data_line(F.col("line"))),
            "parts",
            parts,
            keep=lambda p: F.size(p) == len(FIELDS),
        )
        fields = [F.get("parts", F.lit(i)) for i in range(len(FIELDS))]
    elif layout == "fixed":
        rows = lines.filter(F.col("line_no") >= HEADER_LINES)
        fields = [
            F.substring("line", start + 1, (end or 1 << 30) - start) for start, end in FIXED_BOUNDS
        ]
    else:
        raise ValueError(f"unknown layout {layout!r}: use 'pattern' or 'fixed'")

    named = [strip(value).alias(name) for name, value in zip(FIELDS, fields)]
    kept = [F.col("line_no").cast("bigint").alias("line_no")] if "line_no" in lines.columns else []
    parsed = rows.select(
        *named,
        period_year(F.col("sourcefile")).alias("year"),
        period_quarter(F.col("sourcefile")).alias("quarter"),
        "sourcefile",
        *kept,
    )
    return parsed.filter(F.col("filename") != "") if layout == "fixed" else parsed


FILING_COLUMNS = tuple(FILING.fieldNames())
