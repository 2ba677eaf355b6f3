"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, collocations, decontam, jaccard, lexical_search, main_text, passages, pii, ppm, quality, token_counts, top_k, toxicity,
)


#: Key of surrogates here; a user keeps one secret.
SURROGATE_KEY = "documents"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's component of links by shingles of three words."""
    return jaccard.link(_table(spark, folder, "documents"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, with the benchmark items that it leaks."""
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return decontam.contamination(documents, _table(spark, folder, "benchmark")).drop("text")


def op3_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 best other vectors of every query vector, by whole-number inner product."""
    return top_k.top_k(_table(spark, folder, "embeddings"), 5, F.col("vec_id") % 50 == 0)


def op4_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with personal data and secrets replaced by surrogates."""
    return pii.replace(_table(spark, folder, "documents"), SURROGATE_KEY).select("doc_id", "text", "n_replaced")


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again: count of ids and hashes of both ways."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op6_toxic_severity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's expected severity of toxic language."""
    documents = _table(spark, folder, "documents")
    model = toxicity.train(documents, _table(spark, folder, "labels"), toxicity.toxic_grade())
    return toxicity.severity(documents.select("doc_id", "text"), model).drop("text")


def op7_partial_matching(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's log probability by partial matching, learned outside one fold."""
    return ppm.score(_table(spark, folder, "documents"))


def op8_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the passages of 50 words that an earlier one holds."""
    return passages.remove_repeats(_table(spark, folder, "documents"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's count of tokens, from counts of its distinct pre-tokens."""
    counts = token_counts.count_tokens(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's main text and its length."""
    return main_text.main_text(_table(spark, folder, "pages").select("page_id", "url", "html"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """Every language's 2000 best phrases of 2 to 4 words."""
    return collocations.collocations(_table(spark, folder, "documents"))


def op12_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's chance of good quality, learned outside one fold."""
    stats = quality.statistics(_table(spark, folder, "documents"))
    model = quality.train(stats, _table(spark, folder, "labels"), where=~quality.held_out())
    return quality.scored(stats, model).withColumn("held_out", quality.held_out())


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item's 10 best documents."""
    return lexical_search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_decontamination": op2_decontamination,
    "op3_top_k": op3_top_k,
    "op4_surrogates": op4_surrogates,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_toxic_severity": op6_toxic_severity,
    "op7_partial_matching": op7_partial_matching,
    "op8_repeated_passages": op8_repeated_passages,
    "op9_token_counts": op9_token_counts,
    "op10_main_text": op10_main_text,
    "op11_collocations": op11_collocations,
    "op12_quality": op12_quality,
    "op13_lexical_search": op13_lexical_search,
}

ORACLES: dict[str, str] = {
    "op3_top_k": """
        with v as (
          select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as value
          from embeddings
          where embedding is not null and len(embedding) > 0
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        scored as (
          select q.vec_id as query_id, v.vec_id,
            cast(list_sum(list_transform(list_zip(q.value, v.value), lambda x: x[1] * x[2])) as bigint) as score
          from v q join v on q.vec_id <> v.vec_id and len(q.value) = len(v.value)
          where q.vec_id % 50 = 0
        ),
        ranked as (
          select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank
          from scored
        )
        select query_id, rank, vec_id, score from ranked where rank <= 5
    """,
    "op11_collocations": r"""
        with split as (
          select coalesce(lang, 'und') as lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
          from documents
        ),
        pieces as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from split),
        totals as (select lang, cast(sum(len(w)) as bigint) as n from pieces group by lang),
        placed as (
          select lang, k, w, unnest(range(1, len(w) - k + 2)) as i from pieces, (values (1), (2), (3), (4)) s(k)
        ),
        found as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as a from placed group by all),
        candidates as (select *, string_split(phrase, ' ') as w from found where k >= 2 and a >= 30),
        inside as (
          select lang, a, w, s.k, unnest(range(1, c.k - s.k + 2)) as i from candidates c, (values (2), (3)) s(k) where s.k < c.k
        ),
        inner_parts as (select lang, array_to_string(w[i:i + k - 1], ' ') as phrase, max(a) as most from inside group by all),
        places as (select lang, phrase, a, k, w, unnest(range(1, k)) as j from candidates),
        parts as (
          select lang, phrase, a, j, array_to_string(w[1:j], ' ') as head, array_to_string(w[j + 1:k], ' ') as tail from places
        ),
        cuts as (
          select c.lang, c.phrase, c.a, x.a as l, y.a as r, j,
            cast((cast(2000000 as hugeint) * c.a) // (x.a + y.a) as bigint) as score
          from parts c join found x on x.lang = c.lang and x.phrase = c.head join found y on y.lang = c.lang and y.phrase = c.tail
        ),
        lowest as (
          select * from cuts qualify row_number() over (partition by lang, phrase order by score, j) = 1
        ),
        ranked as (
          select c.lang, row_number() over (partition by c.lang order by score desc, a desc, encode(c.phrase)) as rank,
            c.phrase, a, l, r, score
          from lowest c left join inner_parts p on p.lang = c.lang and p.phrase = c.phrase
          where p.most is null or 100 * p.most < 80 * c.a
        )
        select r.lang, rank, phrase, a, l, r, n, score from ranked r join totals t on t.lang = r.lang where rank <= 2000
    """,
    "op13_lexical_search": r"""
        with words as (
          select row_number() over () as doc, doc_id, regexp_extract_all(translate(text,
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
          from documents
        ),
        asked as (
          select distinct item, item_id, unnest(regexp_extract_all(translate(text,
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
          from (select row_number() over () as item, * from benchmark)
        ),
        corpus as (
          select cast(count(*) as bigint) as n_docs, cast(sum(len(terms)) as bigint) as n_terms from words where len(terms) > 0
        ),
        sized as (
          select doc, doc_id, terms, 100 - 90 + (90 * len(terms) * n_docs) // n_terms as m from words, corpus where len(terms) > 0
        ),
        times as (
          select doc, term, count(*) as tf from (select doc, unnest(terms) as term from sized)
          where term in (select term from asked) group by all
        ),
        weights as (
          select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as w
          from times, corpus group by term, n_docs
        ),
        scored as (
          select item, item_id, s.doc, s.doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
          from asked join weights using (term) join times using (term) join sized s using (doc) group by all
        ),
        ranked as (
          select *, cast(row_number() over (partition by item order by score desc, doc_id) as integer) as rank from scored where score > 0
        )
        select item_id, rank, doc_id, score from ranked where rank <= 10
    """,
}
