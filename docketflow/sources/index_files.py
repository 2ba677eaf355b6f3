"""Reading period listings: many text files to one table of numbered lines."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import split_lines


def unreadable_files(spark, path, recursive=False):
    """Listings under `path` that cannot be read to their end: (path, bytes, bytes_read).

    What a reader that passes over faults gets of each file is held against its length.
    """
    name = "*.[iI][dD][xX]" if recursive else "*.idx"
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", name)
        .option("recursiveFileLookup", recursive)
        .option("ignoreMissingFiles", True)
        .load(path)
        .select("path", F.col("length").alias("bytes"))
    )
    # With the line feed alone as separator nothing is taken off the lines.
    lines = _reader(spark, recursive, passing=True).option("lineSep", "\n").text(path)
    read = (
        lines.select(F.col("_metadata.file_path").alias("path"), F.octet_length("value").alias("n"))
        .groupBy("path")
        .agg((F.sum("n") + F.count(F.lit(1))).alias("bytes_read"))
    )
    both = listed.join(read, "path", "left").withColumn("bytes_read", F.coalesce("bytes_read", F.lit(0)))
    # The last line may lack its line feed.
    return both.filter(F.col("bytes_read") < F.col("bytes"))


def _reader(spark, recursive, passing=False):
    return (
        spark.read.option("pathGlobFilter", "*.[iI][dD][xX]" if recursive else "*.idx")
        .option("recursiveFileLookup", recursive)
        .option("ignoreCorruptFiles", passing)
        .option("ignoreMissingFiles", passing)
    )


def scan_index(spark, path, recursive=False, numbered=True, skip_unreadable=False):
    """Lines of every listing under `path`: (sourcefile, line[, line_no]).

    `recursive=False` takes `*.idx` directly in the folder; `recursive=True` descends
    and ignores the case of the extension. A listing may also be landed in pieces
    under `sourcefile=<name>/`, which then names it.

    A file that cannot be read fails the job. With `skip_unreadable` such files are left
    out whole; `unreadable_files` lists them.

    Listings are read as splittable text, so one listing of any size spreads over
    many tasks. `line_no` counts from 0 within a listing. It costs one shuffle by
    file split, so a group is never larger than a split, and a second, counting scan;
    `numbered=False` leaves a narrow plan.
    """
    reader = _reader(spark, recursive, passing=skip_unreadable)
    folder = F.regexp_extract(F.col("path"), r"/sourcefile=([^/]+)/", 1)
    raw = reader.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row_id"),
        # Listings are Latin-1; the text reader hands their bytes over unchanged.
        F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("text"),
    )
    lines = raw.select(
        F.coalesce(F.nullif(folder, F.lit("")), F.col("file_name")).alias("sourcefile"),
        "path",
        "split_start",
        "row_id",
        F.posexplode(split_lines(F.col("text"))).alias("piece", "line"),
    )
    if skip_unreadable:
        lines = lines.join(unreadable_files(spark, path, recursive).select("path"), "path", "left_anti")
    if not numbered:
        return lines.select("sourcefile", "line")
    return _number_lines(lines)


def _number_lines(lines):
    """Position in the listing = lines in earlier splits + position in the split."""
    split = ["path", "split_start"]
    before = W.partitionBy("sourcefile").orderBy(*split).rowsBetween(W.unboundedPreceding, -1)
    starts = (
        lines.groupBy("sourcefile", *split)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*split, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_no"))
    )
    within = W.partitionBy(*split).orderBy("row_id", "piece")
    placed = lines.withColumn("nth", F.row_number().over(within) - 1)
    return placed.join(starts, split).select(
        "sourcefile", (F.col("first_no") + F.col("nth")).alias("line_no"), "line"
    )
