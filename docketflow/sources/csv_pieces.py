"""CSV files whose values hold line breaks, read in pieces by many tasks.

A line break belongs to a value when an odd number of quotes stands before it in its file,
as quotes stand around values or are doubled inside them. So each piece of a file (a
split) counts its quotes; how many come before a piece is a running total over the
pieces, a row each; and within a piece lines become records by their parity. A record that
goes on in the next piece is put together by its number.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

_OPTIONS = {"escape": '"'}


def _lines(spark, path):
    """Lines with their place: file, piece and order in the piece, and how many quotes they hold."""
    text = F.col("value")
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("piece"),
            F.monotonically_increasing_id().alias("nth"),
            # Lines may end with a carriage return as well.
            F.regexp_replace(text, "\r$", "").alias("line"),
            (F.length(text) - F.length(F.replace(text, F.lit('"')))).alias("quotes"),
        )
    )


def has_line_breaks(spark, path):
    """Whether any value in the files under `path` holds a line break: some line has odd quotes."""
    return not _lines(spark, path).filter(F.col("quotes") % 2 == 1).isEmpty()


def _placed(lines):
    """Lines with the number of their record: the piece that it begins in, and its place there."""
    key = ["file", "piece"]
    before = (W.unboundedPreceding, -1)
    inner = W.partitionBy(*key).orderBy("nth")
    local = lines.withColumn("odd", F.coalesce(F.sum("quotes").over(inner.rowsBetween(*before)), F.lit(0)) % 2)
    # A piece does not know yet how it begins, so it counts its records for both cases.
    pieces = local.groupBy(*key).agg(
        (F.sum("quotes") % 2).alias("turns"), F.count_if(F.col("odd") == 0).alias("even"), F.count_if(F.col("odd") == 1).alias("uneven")
    )
    earlier = W.partitionBy("file").orderBy("piece").rowsBetween(*before)
    pieces = pieces.withColumn("inside", F.coalesce(F.sum("turns").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("uneven"))
    last = F.when(begun > 0, F.struct(F.col("piece").alias("piece"), begun.alias("number")))
    pieces = pieces.withColumn("open", F.last(last, ignorenulls=True).over(earlier)).select(*key, "inside", "open")

    joined = local.join(pieces, key)
    begins = (F.col("odd") + F.col("inside")) % 2 == 0
    number = F.sum(begins.cast("int")).over(inner.rowsBetween(W.unboundedPreceding, 0))
    own = F.struct(F.col("piece").alias("piece"), number.alias("number"))
    record = F.when(number > 0, own).otherwise(F.col("open"))
    return joined.select(
        "file", "nth", "line", record.alias("record"), (begins & (F.col("quotes") % 2 == 0)).alias("whole")
    )


def _records(lines):
    """Rows (file, record, text): every record's text with its line breaks."""
    placed = _placed(lines)
    whole = placed.filter("whole").select("file", "record", F.col("line").alias("text"))
    # Only records of several lines are moved to be put together.
    parts = placed.filter(~F.col("whole")).groupBy("file", "record").agg(F.collect_list(F.struct("record", "nth", "line")).alias("parts"))
    joined = F.array_join(F.transform(F.array_sort("parts"), lambda p: p["line"]), "\n")
    return whole.unionByName(parts.select("file", "record", joined.alias("text")))


def scan_csv_pieces(spark, path):
    """The CSV files under `path`, each with a header, as text columns; records may span lines."""
    schema = spark.read.options(header=True, multiLine=True, **_OPTIONS).csv(path).schema
    records = _records(_lines(spark, path))
    head = (F.col("record")["piece"] == 0) & (F.col("record")["number"] == 1)
    rows = records.filter(~head & (F.trim("text") != ""))
    parsed = rows.select(F.from_csv("text", F.lit(_ddl(schema)), _OPTIONS).alias("r"))
    return parsed.select(*[F.col("r")[f.name].alias(f.name) for f in schema])


def _ddl(schema):
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
