"""The pipeline's stages on planted cases."""

import random

import pytest

import corpus_pipeline

from .test_llm import SCHEMA, prose, toxic_rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    words = [w + str(random.Random(1).randrange(9)) for w in prose(9, 120).split()]
    near = " ".join(words[:50] + ["other"] + words[51:])
    item = " ".join(f"{w}{k}" for k, w in enumerate(prose(77, 30).split()))
    graded = toxic_rows(300, 4)
    rows = [(i + 1000, t) for i, t, _ in graded] + [
        (1, " ".join(words)), (2, near), (3, prose(8, 60) + " " + item + " " + prose(7, 60)), (4, prose(6, 80) + " mail a.b@c.example.com now"),
        (5, None), (6, ""), (None, prose(5, 70)),
    ]
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in rows], SCHEMA + ", lang string, source string, n_chars long, toxic string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i + 1000, 1, int(g > 0)) for i, _, g in graded], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, {i + 1000: g > 0 for i, _, g in graded}


def test_stages(spark, folder):
    path, toxic = folder
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "n-gram Jaccard join", "benchmark decontamination", "PII", "byte-level BPE encoding and decoding",
    ]
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, path).collect()}
    clean = {i for i, bad in toxic.items() if not bad}
    assert set(rows) >= {1, 4, 5, 6, None} and not set(rows) & {2, 3}
    assert len(clean & set(rows)) >= 0.97 * len(clean) and len(set(rows) & set(toxic) - clean) <= 3
    assert "a.b@c.example.com" not in rows[4].text and rows[4].n_chars == len(rows[4].text)
    assert all(r.decoded == (r.text or "") and r.n_tokens == len(r.ids) and r.toxic == "x" for r in rows.values())


def test_stages_on_empty_tables(spark, folder, tmp_path):
    path = str(tmp_path)
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder[0]}/{name}.parquet").where("false").write.parquet(f"{path}/{name}.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []
