"""The corpus pipeline: stages applied to `documents`, each written before the next reads it.

A document that is toxic goes, then all of a group of near copies but one, then what leaks
a benchmark passage; personal data are replaced in the rest, which is then encoded.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.llm import bpe, decontam, jaccard, pii, toxicity
from docketflow.llm.components import stored
from docketflow.session import work_path

#: SQL cannot express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None

#: Near copies share four fifths of their shingles of five words.
SHINGLE_WORDS, PERCENT = 5, 80
#: Key of surrogates here; a user keeps one secret.
SURROGATE_KEY = "documents"
#: Bytes of the rows that an executor hands to a Python worker at once; both hold them.
BATCH_BYTES = 4 << 20
#: Text that is encoded at once, beside all that the stages before have left in an executor.
ENCODED_BYTES = 1 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_batches(stage: Stage) -> Stage:
    """The stage with batches of `BATCH_BYTES`: a setting of the session that stays, as its result is read later."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run


def _renamed(docs: DataFrame) -> tuple[DataFrame, str]:
    """Documents under names that no operator adds, and that of the text."""
    names = [f"column_{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), names[docs.columns.index("text")]


@in_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of a toxic grade is less than one half."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), toxicity.toxic_grade())
    own, text = _renamed(docs)
    kept = toxicity.severity(own, model, text).where(~F.col("toxic"))
    return kept.select(*own.columns).toDF(*docs.columns)


@in_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id.

    Documents without words are in no group and stay, as do those without an id. Rows that
    share an id are one document and stay or go together.
    """
    linked = jaccard.link(docs, SHINGLE_WORDS, PERCENT)
    gone = linked.where("component_id <> doc_id").select(F.col("doc_id").alias("gone_id"))
    gone = stored(gone.distinct(), "pipeline-near-copies")
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


@in_batches
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    own, text = _renamed(docs)
    found = decontam.contamination(own, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), text, item_text="text")
    return found.where(~F.col("contaminated")).select(*own.columns).toDF(*docs.columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and secrets replaced by surrogates; n_chars follows."""
    own, text = _renamed(docs)
    replaced = pii.replace(own, SURROGATE_KEY, text).select(*own.columns).toDF(*docs.columns)
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.length("text").cast("long"))
    return replaced


@in_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with `ids`, `n_tokens` and `decoded`, the text that the ids stand for.

    Columns that have these names already are replaced.
    """
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode_and_decode(docs, path, public_tokenizers.PATTERN, group=ENCODED_BYTES)
    return coded.withColumns({"n_tokens": F.size("ids").cast("long"), "decoded": F.decode("decoded", "utf-8")})


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("PII", replace_personal_data),
    ("byte-level BPE encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
