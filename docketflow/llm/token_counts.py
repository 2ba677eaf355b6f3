"""Tokens per document without ids: pieces are counted once per distinct pre-token.

Documents are cut into pre-tokens and packed into blocks (`blocks.py`). A block's distinct
pre-tokens travel to the bucket of their hash; there the tokenizer counts the pieces of
each once, however many blocks and documents hold it; the counts travel back and are
summed by each document's frequencies. The number of buckets follows the bytes of all texts,
and a bucket that more than `blocks.FAN_OUT` blocks ask is dealt to several tasks.

Defined results: a null or empty text has 0 bytes and 0 tokens; equal rows, also those
with equal ids, give a row each; a null id stays null; no rows give none. Only the columns
named are read.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from . import blocks, kernel, pretokens

#: Buckets of pre-tokens at least.
BUCKETS = 128


@functools.cache
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@functools.cache
def _special(path: str) -> bytes | None:
    """The one special string that the tokenizer takes out of texts before cutting them."""
    with open(path) as config:
        added = json.load(config)["added_tokens"]
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in added)
    if len(added) > 1 or not plain:
        raise ValueError("expects a tokenizer with at most one special string, taken as it stands")
    return added[0]["content"].encode() if added else None


def _splitter(path: str):
    cut = _tokenizer(path).pre_tokenizer

    def exact(text: str) -> list[str]:
        # Offsets are in characters; pieces of one character may share them.
        spans = [span for _, span in cut.pre_tokenize_str(text)]
        return [text[a:b] for a, b in spans]

    return exact


def _beginnings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers in the order of the first eight bytes: neighbours in it compress well."""
    out = np.zeros(len(starts), np.uint64)
    for i in range(8):
        at = starts + i
        out |= np.where(at < ends, data[np.minimum(at, len(data) - 1)], 0).astype(np.uint64) << np.uint64(56 - 8 * i)
    return out


def _gaps(pairs: np.ndarray) -> dict[str, np.ndarray]:
    """Ascending numbers as their gaps, the bytes that are nearly always 0 apart."""
    gap = np.diff(pairs, prepend=0)
    return {"gap": (gap & 0xFFFF).astype(np.uint16), "far": blocks.narrow(gap >> 16)}


def _pairs(own: dict[str, pa.Array]) -> np.ndarray:
    return np.cumsum(blocks.numbers(own["gap"]).astype(np.int64) | blocks.numbers(own["far"]).astype(np.int64) << 16)


def _block(ids: pa.Array, data: np.ndarray, offsets: np.ndarray, path: str, buckets: int):
    starts, ends, first = pretokens.split(data, offsets, _splitter(path), _special(path))
    hashes, place, number = pretokens.distinct(data, starts, ends)
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((_beginnings(data, starts[place], ends[place]), bucket))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    pairs, times = np.unique(doc * max(len(hashes), 1) + rank[number], return_counts=True)
    size = np.bincount(pairs // max(len(hashes), 1), minlength=len(offsets) - 1)
    home = blocks.pack(
        doc_id=ids, n_bytes=blocks.narrow(np.diff(offsets)), n_distinct=blocks.narrow(size),
        **_gaps(pairs), times=blocks.narrow(times), n_items=np.array([len(hashes)]),
    )
    raw, place, bucket = data.tobytes(), place[order], bucket[order]
    found = [raw[a:b] for a, b in zip(starts[place], ends[place])]
    size = (ends - starts)[place]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]) if len(bucket) else [0]
    entries = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        letters = np.frombuffer(b"".join(found[a:b]), np.uint8)
        entries.append((int(bucket[a]), int(a), blocks.pack(size=blocks.narrow(size[a:b]), letters=letters)))
    return home, entries


def count_tokens(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens) for a byte-level BPE tokenizer's .json file.

    `buckets` deals the distinct pre-tokens; without it there are `BUCKETS`, or more by the
    bytes of the texts.
    """
    buckets = buckets or blocks.buckets_for(df, text, BUCKETS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = blocks.numbered()
        for batch in batches:
            ids, column = batch.columns
            data, offsets = kernel.text_bytes(column)
            for a, b in kernel.chunks(offsets, blocks.BLOCK_BYTES):
                part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                yield blocks.rows(next(number), *_block(ids.slice(a, b - a), part, own, path, buckets))

    def reply():
        tokenizer, known, of = _tokenizer(path), {}, [None]

        def answering(bucket: int, asked: dict[str, pa.Array]) -> bytes:
            if of[0] != bucket:
                of[0] = bucket
                known.clear()
            ends = np.cumsum(blocks.numbers(asked["size"]).astype(np.int64)).tolist()
            letters = blocks.numbers(asked["letters"]).tobytes()
            items = [letters[a:b].decode() for a, b in zip([0, *ends], ends)]
            new = [x for x in items if x not in known]
            if new:
                known.update(zip(new, map(len, tokenizer.encode_batch(new, add_special_tokens=False))))
            return blocks.pack(n=blocks.narrow(np.array([known[x] for x in items], np.int64)))

        return answering

    def finish(block_number: int, own: dict[str, pa.Array], answers: list[tuple[int, dict[str, pa.Array]]]) -> pa.RecordBatch:
        n = np.zeros(int(blocks.numbers(own["n_items"])[0]), np.int64)
        for start, got in answers:
            n[start : start + len(got["n"])] = blocks.numbers(got["n"])
        sums = np.concatenate([[0], np.cumsum(n[_pairs(own) % max(len(n), 1)] * blocks.numbers(own["times"]).astype(np.int64))])
        bounds = np.concatenate([[0], np.cumsum(blocks.numbers(own["n_distinct"]).astype(np.int64))])
        total = sums[bounds[1:]] - sums[bounds[:-1]]
        size = pa.array(blocks.numbers(own["n_bytes"]).astype(np.int64))
        return pa.RecordBatch.from_arrays([own["doc_id"], size, pa.array(total)], names=["doc_id", "n_bytes", "n_tokens"])

    kind = df.schema[doc_id].dataType.simpleString()
    staged = blocks.stage(df.select(doc_id, text).mapInArrow(cut, blocks.SCHEMA), "token-counts")
    answers = blocks.answer(blocks.entries(staged), blocks.homes(staged).count(), reply)
    return blocks.bring_home(blocks.homes(staged), answers, finish, f"doc_id {kind}, n_bytes long, n_tokens long")
