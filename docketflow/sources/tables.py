"""Reading and writing tables of filings, documents and parts."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..functions.urls import storage_key
from ..operators.annual import require_columns
from ..operators.ranges import constants
from ..session import settings
from .csv_pieces import has_line_breaks, scan_csv_pieces

_PARQUET_GLOB = "*.[pP][aA][rR][qQ][uU][eE][tT]"
#: Tasks for each core that list folders of parts.
LISTING_TASKS = 4
#: What adaptive execution merges for a task that writes folders: opening a part's file costs
#: more than its bytes, so that tasks merged to one a core would end far apart.
FOLDERS_TASK = "4m"
_MODES = {
    "error": "errorifexists",
    "skip": "ignore",
    "overwrite": "overwrite",
    "append": "append",
}


def _format_of(path):
    low = path.rstrip("/").lower()
    for fmt in ("csv", "parquet"):
        if low.endswith("." + fmt):
            return fmt
    raise ValueError(f"cannot tell the format of {path!r}: name it .csv or .parquet")


def scan_table(spark, path, fmt=None, multiline=None):
    """A table by its extension, or by `fmt`. CSV columns are all text, empty is null.

    Files are read in bounded pieces (`spark.sql.files.maxPartitionBytes`), CSV as well,
    whose values may hold line breaks between quotes: one pass over the text tells
    whether any does, and if so records are put together from lines (`csv_pieces.py`).
    `multiline=False` says that none does, and saves the pass. `multiline=True` reads each CSV
    file in one task, which also copes with quotes that stand alone inside a value.
    """
    fmt = fmt or _format_of(path)
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "csv":
        if multiline is None and has_line_breaks(spark, path):
            return scan_csv_pieces(spark, path)
        return spark.read.option("header", True).option("escape", '"').option("multiLine", bool(multiline)).csv(path)
    raise ValueError(f"unknown format {fmt!r}: use 'csv' or 'parquet'")


def output_exists(spark, path):
    """True when there is something at `path`; its file system is asked."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def may_write(df, path, if_exists="error"):
    """False when the output is to be left alone or there are no rows to write.

    Looking for a row stops at the first one found.
    """
    if if_exists not in _MODES:
        raise ValueError(f"unknown if_exists {if_exists!r}: use {', '.join(_MODES)}")
    if if_exists == "skip" and output_exists(df.sparkSession, path):
        return False
    return not df.isEmpty()


def write_table(df, path, fmt=None, if_exists="error", check=True):
    """Write a table as Parquet or CSV; returns whether anything was written.

    `if_exists`: `error`, `skip` (an existing output stays as it is), `append` or
    `overwrite`. `check=False` leaves out the look at emptiness and existing output
    where the caller has done it.
    """
    fmt = (fmt or _format_of(path)).strip().lower()
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown format {fmt!r}: use 'csv' or 'parquet'")
    if check and not may_write(df, path, if_exists):
        return False
    writer = df.write.mode(_MODES[if_exists])
    if fmt == "csv":
        # The writer would otherwise strip the white space around values, and times of
        # what is below a millisecond.
        (
            writer.option("header", True)
            .option("escape", '"')
            .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    else:
        writer.option("compression", "snappy").parquet(path)
    return True


def write_parts(
    df, path, rows_per_part=None, compression="snappy", if_exists="error", check=True, folders=False
):
    """Write numbered parts; returns whether anything was written.

    Spark numbers the files and `rows_per_part` bounds their size; a `part` column (see
    `assign_part`) is written like any other. With `folders=True` each part becomes a
    folder `part=000000` that holds exactly its rows, which suits runs of some thousand
    parts. Neither moves rows: a part's rows already lie together, and a part larger
    than one task is written by several.
    """
    if check and not may_write(df, path, if_exists):
        return False
    numbered = folders and "part" in df.columns
    if numbered:
        df = df.withColumn("part", F.format_string("%06d", F.col("part")))
    writer = df.write.mode(_MODES[if_exists]).option("compression", compression)
    if rows_per_part:
        writer = writer.option("maxRecordsPerFile", rows_per_part)
    if numbered:
        with settings(df.sparkSession, spark__sql__adaptive__advisoryPartitionSizeInBytes=FOLDERS_TASK):
            writer.partitionBy("part").parquet(path)
    else:
        writer.parquet(path)
    return True


def scan_parts(spark, path, columns):
    """The parts written by `write_parts(folders=True)`; `columns` declares those stored, `part` is text.

    Folders are listed by a few tasks a core. Spark would start a task for each, up to 10,000,
    and starting one takes longer than listing a folder.
    """
    tasks = LISTING_TASKS * spark.sparkContext.defaultParallelism
    with settings(spark, spark__sql__sources__parallelPartitionDiscovery__parallelism=tasks):
        return spark.read.schema(f"{columns}, part string").parquet(path)


def in_full_parts(df, rows_per_part):
    """Rows dealt to tasks so that files of `rows_per_part` are full, all but the last.

    Rows keep their order. Each task's rows are counted first: what comes before a task is one
    number, and a part's rows meet in one task by its number. `df` is read twice and should
    give the same rows in the same tasks, as files do.
    """
    counted = df.select(F.spark_partition_id().alias("at")).groupBy("at").count().collect()
    tasks = {row["at"]: row["count"] for row in counted}
    before, n = [], 0
    for at in range(max(tasks, default=-1) + 1):
        before.append(n)
        n += tasks.get(at, 0)
    place = F.get(constants(before, "bigint"), F.spark_partition_id()) + F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    parts = max(1, -(-n // rows_per_part))
    wanted = max(1, min(parts, len(tasks)))
    numbered = df.withColumn("__place", place)
    task = F.expr(f"cast((__place div {rows_per_part}) * {wanted} div {parts} as int)")
    return numbered.repartitionById(wanted, task).sortWithinPartitions("__place").drop("__place")


def document_keys(df):
    """Add the storage key columns of a document: key_cik, key_year, key_accession."""
    require_columns(df, ["cik", "year", "filename"])
    key = storage_key(F.col("cik"), F.col("year"), F.col("filename"))
    return (
        df.withColumn("__key", key)
        .withColumns({f"key_{n}": F.col(f"__key.{n}") for n in ("cik", "year", "accession")})
        .drop("__key")
    )


def write_documents(df, path, by=("year",), if_exists="error", check=True):
    """Store documents gzip-compressed, addressed by cik, year and accession.

    All three are columns of the store. `by` says which of them become folders: years
    by default, with rows in order of company inside each file, so that a look-up of
    one company skips row groups by their bounds. `("cik", "year")` gives every company
    its own folders, which suits small stores: most would hold one or two documents.

    Rows are rebalanced by the folder keys: adaptive execution merges small folders'
    partitions and splits those that hold far more than others.
    """
    keyed = document_keys(df).select(
        F.coalesce(F.nullif("key_cik", F.lit("")), F.lit("unknown")).alias("cik"),
        F.col("key_year").alias("year"),
        F.col("key_accession").alias("accession"),
        *[c for c in df.columns if c not in ("cik", "year", "accession")],
    )
    if check and not may_write(keyed, path, if_exists):
        return False
    (
        keyed.hint("rebalance", *by)
        .sortWithinPartitions(*by, *[c for c in ("cik", "accession") if c not in by])
        .write.mode(_MODES[if_exists])
        .partitionBy(*by)
        .option("compression", "gzip")
        .parquet(path)
    )
    return True


def scan_documents(spark, path, ciks=None, years=None, columns="body string"):
    """The document store written by `write_documents`, keys as text.

    `ciks` and `years` restrict it: folders are pruned, the rest is skipped by bounds.
    `columns` declares the stored columns wanted beside the keys.
    """
    keys = "cik string, year string, accession string"
    stored = spark.read.schema(f"{keys}, {columns}" if columns else keys).parquet(path)
    first = ["cik", "year", "accession"]
    stored = stored.select(*first, *[c for c in stored.columns if c not in first])
    if ciks:
        stored = stored.filter(F.col("cik").isin([str(c) for c in ciks]))
    if years:
        stored = stored.filter(F.col("year").isin([str(y) for y in years]))
    return stored


def list_parts(spark, path):
    """Parquet files under `path`, any depth, by name: (path, bytes). Opens none."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", _PARQUET_GLOB)
        .load(path)
        .select("path", F.col("length").alias("bytes"))
        .orderBy("path")
    )


def compact(spark, source, target, compression="snappy", if_exists="error", file_bytes=128 << 20):
    """Combine many parts under `source`, any depth, into one table of even files.

    Parts must agree in schema: it is merged over all parts, and types that do not fit
    together fail before anything is written. Rows are not moved: parts are packed by their sizes,
    the largest first, into tasks of `file_bytes`, each of which writes one file; parts
    that are larger are cut between their row groups. Returns the number of rows; with none, or an output to be left
    alone, nothing is written.
    """
    parts = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", _PARQUET_GLOB)
        .option("mergeSchema", True)
        .parquet(source)
    )
    if not may_write(parts, target, if_exists):
        return 0
    seen = Observation()
    files = "spark__sql__files__"
    packed = {f"{files}maxPartitionBytes": file_bytes, f"{files}openCostInBytes": 0, f"{files}minPartitionNum": 1}
    with settings(spark, **packed):
        counted = parts.observe(seen, F.count(F.lit(1)).alias("n"))
        counted.write.mode(_MODES[if_exists]).option("compression", compression).parquet(target)
    return seen.get["n"]
