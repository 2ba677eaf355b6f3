"""Collocations, quality and lexical search against brute force, with all odd cases."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docketflow.llm import collocations, kernel, lexical_search, quality, top_k

SCHEMA = "doc_id long, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
VOCABULARY = ["of", "the", "The", "state", "É", "é", "x\x00y", "2:a", "(a)", "a-b", " ", "New", "York"]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) + rng.choice(["", "", "", ".", ",", "\n", "\t", ";x"]) for _ in range(n))


def corpus():
    rows = [(i, prose(i, 60), random.Random(i).choice(["en", "de", None, "und", "", "2:en"])) for i in range(60)]
    rows += [(i, "new york state of the art " * 12, "en") for i in (3, 100, 101)]
    rows += [(200, None, "en"), (201, "", "fr"), (202, " \t\n.,", "fr"), (203, "one", "fr"), (None, "new york state", None)]
    rows += [(204, "long " * 40_000, "en"), (205, "y" * 50_000, "en"), (206, "New  York\tstate", "en"), (207, "Ünïcode ½ ²", "de")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, 1, "x", 2.0, 3) for r in corpus()]
    columns = SCHEMA + ", bucket int, phrase string, score double, rank int"
    return spark.createDataFrame(rows, columns).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def phrases(rows, least, longest, top, share):
    counts, total = {}, collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, collections.Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        inner = {p[i : i + k]: 0 for p in found for k in range(2, len(p)) for i in range(len(p) - k + 1)}
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inner[p[i : i + k]] = max(inner[p[i : i + k]], a)
        ranked = []
        for p, a in found.items():
            if 100 * inner.get(p, 0) >= share * a:
                continue
            cuts = [(2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), " ".join(p), left, right))
        for i, (score, a, _, p, left, right) in enumerate(sorted(ranked)[:top]):
            out.append((lang, i + 1, p, -a, left, right, total[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("least, longest, top, share", [(3, 4, 2000, 80), (2, 3, 7, 50), (5, 2, 2000, 100), (2, 6, 50, 80)])
def test_phrases_are_those_of_brute_force(docs, least, longest, top, share):
    got = collocations.collocations(docs, least, longest, top, share)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == phrases(corpus(), least, longest, top, share)


def test_phrases_do_not_depend_on_buckets_or_blocks(docs, monkeypatch):
    monkeypatch.setattr(collocations, "BUCKETS_LEAST", 3)
    monkeypatch.setattr(collocations.blocks, "BLOCK_BYTES", 500)
    got = collocations.collocations(docs, 3)
    assert sorted(map(tuple, got.collect())) == phrases(corpus(), 3, 4, 2000, 80)


def test_scores_do_not_pass_over_64_bits(spark):
    big = spark.createDataFrame([(2**44, 2**44, 2**44)], "a long, l long, r long")
    score = "(cast(2000000 as decimal(19,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"
    assert big.selectExpr(score).first()[0] == 1_000_000


def test_no_texts_no_phrases(none, spark):
    assert collocations.collocations(none).count() == 0
    empty = spark.createDataFrame([(1, None, "en"), (2, "", None), (3, " ", "en")], SCHEMA)
    assert collocations.collocations(empty, 1).count() == 0


def ranked(docs, items, top):
    docs = [(i, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    n = sum(bool(x) for _, x in docs)
    total = sum(sum(x.values()) for _, x in docs)
    holding = collections.Counter(t for _, x in docs for t in x)
    out = []
    for item, text in items:
        found = []
        for i, x in docs:
            m = 100 - 90 + (90 * sum(x.values()) * n) // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * holding[t] + 1))) * ((10**9 * x[t]) // (1000 * x[t] + 8 * m))
                for t in set(TERM.findall((text or "").translate(LOWER))) if t in x
            )
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(found, key=lambda f: f[:2] + (f[2] or 0,))[:top])]
    return out


ITEMS = [(1, "New York state"), (2, "new york STATE, of the art"), (3, None), (4, ""), (5, ".,"), (6, "absent"), (7, "long y"), (7, "é É the"),
         (None, "Ünïcode"), (9, "state " * 3000 + "x"), (10, prose(77, 200)), (10, prose(77, 200))]


@pytest.mark.parametrize("top, coordinates", [(10, 4096), (3, 4096), (10, 2), (100, 64)])
def test_search_ranks_as_brute_force(spark, docs, top, coordinates):
    items = spark.createDataFrame([(*i, 1, 2.0) for i in ITEMS], "item_id long, text string, doc_id int, score double")
    got = lexical_search.search(docs, items, top, coordinates=coordinates)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    key = lambda row: tuple((x is None, x or 0) for x in row)
    want = ranked([(i, t) for i, t, _ in corpus()], ITEMS, top)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_search_in_batches_gives_the_same(spark, docs, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = sorted(map(str, lexical_search.search(docs, items).collect()))
    monkeypatch.setattr(lexical_search, "BATCH_BYTES", 2000)
    assert sorted(map(str, lexical_search.search(docs, items).collect())) == whole


def test_search_of_or_in_nothing(spark, docs, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.search(none, items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0


def test_bounds_are_never_below_scores():
    texts = [t for _, t, _ in corpus() if t and len(t) < 5000]
    data, offsets = kernel.text_bytes(pa.array(texts))
    asked = lexical_search._Asked.of(["of the new york state", "x y z"])
    sketched = lexical_search._Sketched(kernel.lower_ascii(data), offsets, asked, len(texts), 5000, 64)
    for numbers in asked.of_items:
        places = (asked.hashes[numbers] % np.uint64(64)).astype(np.int64)
        weights = np.arange(1, len(numbers) + 1)
        scores = sketched.scores(np.arange(len(texts)), numbers, weights)
        assert (sketched.bounds(places, weights) >= scores).all()


def test_a_term_of_another_ones_hash_is_told_apart():
    asked = lexical_search._Asked.of(["abc abd"])
    data = np.frombuffer(b"abc xyz abd", np.uint8)
    starts, ends = np.array([0, 4, 8]), np.array([3, 7, 11])
    hashes = asked.hashes[[0, 0, 1]]
    at, number = asked.matches(data, starts, ends, hashes)
    letters = [asked.letters[asked.starts[n] :][:3].tobytes() for n in number]
    assert [data[starts[i] : ends[i]].tobytes() for i in at] == letters and 1 not in at


def good(rng):
    return ". ".join(" ".join(rng.choice(["plain", "words", "of", "a", "letter", "read", "with", "care"]) for _ in range(9)).capitalize() for _ in range(rng.randint(3, 9)))


def bad(rng):
    kind = rng.randint(0, 2)
    words = good(rng).split()
    return " ".join(w.upper() + "!!" for w in words) if kind == 0 else " | ".join(words) if kind == 1 else " ".join(w for w in words for _ in range(6))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    rows = [(i, good(rng) if i % 3 else bad(rng), int(i % 3 > 0)) for i in range(900)]
    docs = [(i, t) for i, t, _ in rows] + [(1000, None), (1001, ""), (None, "no id"), (1002, "x" * 200_000), (1, rows[1][1])]
    labels = [(i, q, 0) for i, _, q in rows] + [(1, 1, 0), (2000, 0, 0), (5, None, 0), (None, 0, 0), (8, 7, 0)]
    documents = spark.createDataFrame([(*d, 1.0, 0) for d in docs], "doc_id long, text string, x double, label int").repartition(4)
    return documents, spark.createDataFrame(labels, "doc_id long, quality int, text int"), rows


def test_quality_of_held_out_texts(labelled):
    documents, labels, rows = labelled
    stats = quality.statistics(documents)
    model = quality.train(stats, labels, where=~quality.held_out())
    got = quality.scored(stats, model).withColumn("held_out", quality.held_out()).collect()
    assert len(got) == documents.count()
    quality_of = {i: q for i, _, q in rows}
    held = [(quality_of[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in quality_of]
    assert len(held) > 100 and np.mean([q == p for q, p in held]) > 0.97
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_labels_of_the_held_out_fold_teach_nothing(labelled):
    documents, labels, _ = labelled
    stats = quality.statistics(documents)
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    models = [quality.train(stats, own, where=~quality.held_out()) for own in (labels, turned)]
    for label in (0, 1):
        assert np.allclose(models[0].classes[label][1], models[1].classes[label][1])


def test_scores_are_the_densities_of_two_normal_distributions(labelled):
    documents, labels, rows = labelled
    model = quality.train(quality.statistics(documents), labels)
    quality_of = {i: q for i, _, q in rows}
    # Labels that say nothing leave the others as they are; a text that stands twice counts twice.
    texts = [(quality_of[i], t) for i, t, _ in rows] + [(quality_of[1], rows[1][1])]
    data, offsets = kernel.text_bytes(pa.array([t for _, t in texts]))
    x, own = quality._statistics(data, offsets), np.array([q for q, _ in texts])
    labels_of = {label: x[own == label] for label in (0, 1)}
    common = sum((v - v.mean(0)).T @ (v - v.mean(0)) for v in labels_of.values()) / len(x)
    log = {}
    for label, v in labels_of.items():
        cov = (1 - quality.TO_COMMON) * np.cov(v.T, bias=True) + quality.TO_COMMON * common
        cov = (1 - quality.TO_DIAGONAL) * cov + quality.TO_DIAGONAL * np.diag(np.diag(cov)) + quality.LEAST_VARIANCE * np.eye(len(cov))
        away = x - v.mean(0)
        log[label] = np.log(len(v) / len(x)) - 0.5 * (np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away) + np.linalg.slogdet(cov)[1])
    want = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
    assert np.allclose(model.chance(x), want, atol=1e-6)


def test_statistics_do_not_depend_on_neighbours():
    texts = ["", "Plain words. Here.", "A!! B!!\nA!! B!!", None, "x", "é é é", " \n \n", "| a | b |\n1 2 3"]
    data, offsets = kernel.text_bytes(pa.array(texts))
    whole = quality._statistics(data, offsets)
    for text, row in zip(texts, whole):
        data, offsets = kernel.text_bytes(pa.array([text], pa.string()))
        assert np.allclose(quality._statistics(data, offsets)[0], row)


def test_quality_without_labels_or_texts(spark, labelled, none):
    documents, labels, _ = labelled
    stats = quality.statistics(documents)
    assert {r.predicted for r in quality.scored(stats, quality.train(stats, labels.limit(0))).collect()} == {1}
    assert {r.score for r in quality.scored(stats, quality.train(stats, labels.where("quality = 0"))).collect()} == {0.0}
    empty = quality.statistics(none)
    assert quality.scored(empty, quality.train(empty, labels)).count() == 0


def test_top_k_of_very_large_components_and_ids(spark):
    near = 2**53
    vectors = {0: (1.0, 2.0), 1: (1e7, 0.0), 2: (3.0, 1.0), near: (3.0, 1.0), near + 1: (3.0, 1.0), -near - 1: (-1e7, 3e6), 50: (4e9, -5e9)}
    rows = [(i, list(v)) for i, v in vectors.items()] + [(None, [3.0, 1.0]), (60, [float("inf"), 1.0]), (61, None), (62, [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    got = {}
    for r in top_k.top_k(df, 6, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    whole = {i: [math.floor(256 * x) for x in v] for i, v in [*vectors.items(), (None, (3.0, 1.0))]}
    for query in (0, 50):
        scored = [(i, sum(x * y for x, y in zip(whole[query], v))) for i, v in whole.items() if i != query]
        scored = [(i, max(min(s, 2**63 - 1), -(2**63))) for i, s in scored]
        assert got[query] == sorted(scored, key=lambda x: (-x[1], x[0] is None, x[0] or 0))[:6]
    huge = spark.createDataFrame([(0, [1e308, 1e308]), (1, [1e308, 0.0]), (2, [-1e308, 0.0])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, r.score) for r in top_k.top_k(huge, 5, F.col("vec_id") == 0).orderBy("rank").collect()] == [(1, 2**63 - 1), (2, -(2**63))]
