"""Incremental runs of the same operators with Structured Streaming.

Each run takes what arrived since the last one and stops. Spark commits output and
position together per micro-batch, so an interrupted run resumes without losing or
repeating rows, and a run with nothing new adds nothing.
"""

from pyspark.sql import functions as F

from ..operators.annual import filter_annual, keep_annual_forms
from ..operators.outcomes import clean_pages, outcome_records
from ..plans.jobs import numbered_outcomes
from ..schemas import FILING
from ..session import discard
from ..sources.tables import output_exists


def _files(spark, source, schema, fmt, files_per_batch, glob):
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(source)


def _run(stream, target, checkpoint):
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def stream_filter(
    spark, source, target, checkpoint, schema=FILING, fmt="parquet", files_per_batch=None, glob=None
):
    """New files of filings under `source` to annual filings; returns the finished query.

    `files_per_batch` bounds how much one micro-batch takes.
    """
    stream = _files(spark, source, schema, fmt, files_per_batch, glob)
    return _run(filter_annual(stream), target, checkpoint)


def stream_clean(
    spark, source, target, checkpoint, schema, html="html", files_per_batch=None, glob=None
):
    """New files of pages under `source` to pages with readable text.

    Returns the finished query, whose progress tells what each micro-batch did.
    """
    stream = _files(spark, source, schema, "parquet", files_per_batch, glob)
    return _run(clean_pages(stream, html), target, checkpoint)


def _next_part(spark, target, batch):
    """The part after the last one of all batches before this one."""
    if not output_exists(spark, target):
        return 0
    earlier = spark.read.schema("part bigint, batch bigint").parquet(target).filter(F.col("batch") < batch)
    last = earlier.agg(F.max("part")).first()[0]
    return 0 if last is None else last + 1


def stream_fetch(
    spark, source, responses, target, checkpoint, retry_limit=2, per_part=200, schema=FILING, fmt="parquet",
    files_per_batch=None, glob=None
):
    """New files of filings with landed responses to outcome records in numbered parts.

    Returns the finished query. A micro-batch is a folder `batch=<number>` of the output and closes its last part.
    Its number and its files are fixed before it begins, and its parts go on from those of earlier
    batches: a run that ended midway does the batch again, over what it left, and every filing
    has one record and parts no gap. `responses` is read again for each batch.
    """

    def write(filings, batch):
        annual = keep_annual_forms(filings)
        path = f"{target.rstrip('/')}/batch={batch}"
        numbered, tables = numbered_outcomes(annual, responses, retry_limit, per_part, _next_part(spark, target, batch))
        if numbered is not None:
            outcome_records(numbered).write.mode("overwrite").parquet(path)
            discard(*tables)

    query = (
        _files(spark, source, schema, fmt, files_per_batch, glob)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
