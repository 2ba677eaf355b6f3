"""What operators hold while they work on large batches."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

import corpus_pipeline
from docketflow.llm import bpe, decontam, kernel, toxicity


def test_working_memory_of_text_is_bounded():
    """What a worker holds beside its batch follows the pieces worked on, not the batch."""
    rng = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(3000)])
    column = pa.array([" ".join(rng.choice(words, 400)) for _ in range(2000)])
    items = decontam._part([(k, next(decontam.texts(pa.array([" ".join(rng.choice(words, 40))])))[2]) for k in range(1500)])
    columns = decontam._random_columns(items.size)
    product, held = np.zeros((items.size, decontam.RANK)), np.zeros(items.size, np.int64)
    search = decontam.Search(items, decontam.Space(columns))
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    bpe.vocabulary(path)
    batch = pa.record_batch({"text": pa.array(["the cat sat on the mat " * 100] * 6000)})
    peaks = {}
    for name, work in {
        "count": lambda: decontam._counted(column, items.table, columns, product, held),
        "search": lambda: [search.candidates(hashes, first) for _, _, hashes, first in decontam.texts(column.slice(0, 400))],
        "bpe": lambda: [b.num_rows for b in bpe._encoding(iter([batch]), path, public_tokenizers.PATTERN, "text", "ids")],
    }.items():
        tracemalloc.start()
        work()
        peaks[name] = tracemalloc.get_traced_memory()[1] >> 20
        tracemalloc.stop()
    assert peaks["count"] < 32 and peaks["search"] < 80 and peaks["bpe"] < 90, peaks


def _peak(work) -> int:
    tracemalloc.start()
    work()
    peak = tracemalloc.get_traced_memory()[1] >> 20
    tracemalloc.stop()
    return peak


def test_memory_of_toxicity_follows_the_pieces():
    """Neither the fit nor the scoring holds all features of its texts."""
    rng = np.random.default_rng(7)
    words = np.array([f"word{i}" for i in range(3000)])
    texts = pa.array([" ".join(rng.choice(words, 300)) + (" vile" if i % 5 == 0 else "") for i in range(2000)] * 3)
    grades = (np.arange(6000) % 5 == 0).astype(np.int64)
    toxicity.pretokens.classes()
    models = []
    peaks = [_peak(lambda: models.append(toxicity.fit(texts, grades))), _peak(lambda: [None for _ in toxicity.features(texts)])]
    assert len(models[0].places) and peaks[0] < 90 and peaks[1] < 30, peaks


def test_encoding_puts_tokens_together_piece_by_piece():
    texts = pa.array(["the cat sat on the mat " * 100] * 1600)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    vocab, found = bpe.vocabulary(path), []
    peak = _peak(lambda: found.append(bpe.encode_texts(texts, vocab, public_tokenizers.PATTERN)))
    ids, bounds = found[0]
    own = bpe.encode_texts(texts.slice(0, 1), vocab, public_tokenizers.PATTERN)[0]
    assert (ids == np.tile(own, 1600)).all() and (np.diff(bounds) == len(own)).all()
    assert peak < 30, peak


def test_a_worker_keeps_no_powers_and_no_vocabulary():
    kernel.span_hashes(np.zeros(1000, np.uint8), np.array([0]), np.array([1000]))
    bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    bpe.release()
    assert not kernel._held and not bpe.vocabulary.cache_info().currsize


def test_rows_travel_to_workers_in_small_batches(spark):
    """The pipeline's stages bound a batch by its bytes; its rows are long."""
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        docs = corpus_pipeline.in_batches(lambda s, d, _: d)(spark, spark.range(0, 400, 1, 1).selectExpr("repeat('x', 100000) as text"), "")
        sizes = docs.mapInArrow(lambda found: (pa.record_batch({"n": [b.nbytes]}) for b in found), "n long").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
    assert sum(r.n for r in sizes) >= 40_000_000 and max(r.n for r in sizes) < 2 * corpus_pipeline.BATCH_BYTES


def test_ids_do_not_follow_the_size_of_a_group():
    """A smaller group holds less at once, and gives the same ids in the same rows."""
    rng = np.random.default_rng(3)
    batch = pa.record_batch({"text": pa.array([*("".join(map(chr, rng.integers(32, 900, 300))) for _ in range(60)), None, ""])})
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    found = [[b for b in bpe._encoding(iter([batch]), path, pattern, "text", "ids", group)] for group in (4096, bpe.GROUP_BYTES)]
    assert len(found[0]) > 3 and len(found[1]) == 1
    assert pa.Table.from_batches(found[0]).to_pylist() == found[1][0].to_pylist()


def _new_words(batches, group):
    """Ids of all texts in groups of this size, and how many words were merged for each group."""
    path, merged = public_tokenizers.path("byte_bpe_50k.tiktoken"), []
    vocab = bpe.vocabulary(path)
    merge, vocab.merge = vocab.merge, lambda words: merged.append(len(words)) or merge(words)
    try:
        found = list(bpe._encoding(iter(batches), path, public_tokenizers.PATTERN, "text", "ids", group))
    finally:
        del vocab.merge
    return pa.Table.from_batches(found).column("ids").to_pylist(), merged


def _batches_of_words(n):
    rng = np.random.default_rng(11)
    words = np.array(["".join(map(chr, rng.integers(97, 123, 9))) for _ in range(n)])
    return [pa.record_batch({"text": pa.array([" ".join(rng.permutation(words)) for _ in range(5)])}) for _ in range(3)]


def test_a_task_merges_a_word_once():
    """Groups and batches that follow meet the same words; time follows the new ones."""
    batches = _batches_of_words(2000)
    expected, alone = _new_words(batches, 1 << 30)
    found, merged = _new_words(batches, 1 << 14)
    assert found == expected and len(merged) == 15 and len(alone) == 3
    # Each word with a space before it, and those that begin a text.
    assert sum(merged) <= 2000 + 15 and sum(alone) <= 2000 + 15, (merged, alone)


def test_words_that_a_task_keeps_are_bounded(monkeypatch):
    """Beyond the bound the last group's words stay, or none where these are too many; the ids are the same."""
    batches = _batches_of_words(300)
    expected, _ = _new_words(batches, 1 << 30)
    vocab, pattern = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
    for bound in (100, 1500, 2000):
        monkeypatch.setattr(bpe, "KNOWN_IDS", bound)
        assert _new_words(batches, 1 << 11)[0] == expected
        known = bpe.Known()
        for batch in batches:
            for text in batch.column("text"):
                own = bpe.encode_texts(pa.array([text.as_py()]), vocab, pattern)[0]
                ids, _ = bpe.encode_texts(pa.array([text.as_py(), f"{text} new{len(known.ids)}x"]), vocab, pattern, known)
                assert (ids[: len(own)] == own).all() and len(known.ids) <= bound
