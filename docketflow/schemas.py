"""Declared table schemas. Column names are snake_case from the start."""

from pyspark.sql import types as T

FILING = T.StructType(
    [
        T.StructField("company_name", T.StringType()),
        T.StructField("form_type", T.StringType()),
        T.StructField("cik", T.StringType()),
        T.StructField("date_filed", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("quarter", T.StringType()),
        T.StructField("sourcefile", T.StringType()),
        T.StructField("line_no", T.LongType()),
    ]
)

# One landed answer to one request. `attempt` counts from 1 per url.
RESPONSE = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("body", T.StringType()),
    ]
)

FETCHED = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("filing_url", T.StringType()),
        T.StructField("filing_text", T.StringType()),
        T.StructField("cleaned_text", T.StringType()),
    ]
    + FILING.fields
)

# A total order of filings: source file name, then position in that file.
FILING_ORDER = ("sourcefile", "line_no")


def check_schema(df, schema):
    """Fail early when `df` lacks a declared column or has it in another type."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, found "
        f"{actual[f.name].simpleString() if f.name in actual else 'nothing'}"
        for f in schema.fields
        if actual.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError("schema mismatch: " + "; ".join(wrong))
    return df
