"""Substring dedup: Rabin-Karp hashes of every window of words, counted over the corpus.

A window whose words also stand in an earlier document is removed from the later one; windows that
overlap or touch merge into maximal intervals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import BLOCK_BYTES, exchange, ordered_blocks, read_answers, texts_of, with_answers

WINDOW = 13
#: Odd, so that it can be undone modulo 2^64; about 2^64 / golden ratio.
BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread all bits over the word, one to one."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def rabin_karp(words: np.ndarray, window: int) -> np.ndarray:
    """Of every ``window`` consecutive numbers, the polynomial with them as coefficients, modulo 2^64."""
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = words[:n].copy()
    for k in range(1, window):
        total = total * BASE + words[k:n + k]
    return mix(total)


def windows_of(texts: list[bytes], window: int) -> tuple[list[list[bytes]], np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, the first word of each text in all, and of each window its hash and first word."""
    words = [text.split() for text in texts]
    firsts = np.cumsum([0, *map(len, words)])
    hashes = np.fromiter((xxhash.xxh64_intdigest(word) for text in words for word in text), dtype=np.uint64, count=int(firsts[-1]))
    rolled = rabin_karp(hashes, window)
    left = np.repeat(firsts[1:], np.diff(firsts))[:len(rolled)] - np.arange(len(rolled))
    at = np.flatnonzero(left >= window)
    return words, firsts, rolled[at], at


def _ranks(ids: list) -> np.ndarray:
    """Rank of each id among the different ones of a sorted list."""
    return np.cumsum([0, *(a != b for a, b in zip(ids, ids[1:]))])


def _repeated(ids: list, sizes: list[int], payload: bytes, answers: list[dict] | None, window: int,
              bits: int) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words, first words, and for each word of the block whether it is to be removed."""
    words, firsts, hashes, at = windows_of(texts_of(sizes, payload), window)
    by_hash = np.argsort(hashes, kind="stable")
    ordered = hashes[by_hash]
    first = np.r_[True, ordered[1:] != ordered[:-1]][:len(ordered)]
    group = np.cumsum(first) - 1
    rank = np.repeat(_ranks(ids), np.diff(firsts))[at][by_hash]
    earlier = rank > rank[first][group] if len(ordered) else np.zeros(0, dtype=bool)
    elsewhere = read_answers(answers, ordered[first], bits) > 0
    removed = at[by_hash[earlier | elsewhere[group]]]
    change = np.zeros(int(firsts[-1]) + 1, dtype=np.int64)
    np.add.at(change, removed, 1)
    np.add.at(change, removed + window, -1)
    return words, firsts, np.cumsum(change[:-1]) > 0


def remove_repeated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: id, n_words, kept (the words left, joined by one space), removed
    (maximal intervals of word positions, ends exclusive).

    Ids are of any type that Spark can sort, but for nested ones.  Words are the runs between ASCII white space,
    unchanged.  A null text has no words; a text of any length is one value in one task.  A null id
    counts as smaller than any other; rows with equal ids, nulls included, are never earlier than
    each other, and each is judged against the smaller ids.  Texts shorter than a window stay
    whole.  An empty table gives an empty result; further columns are not read.  Equality is that of
    64-bit hashes: among n different windows about n^2 / 2^65 pairs share one by chance.
    """
    blocks = ordered_blocks(docs, id_column, text_column, block_bytes)
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    total = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0] or 0

    def hashes(ids: list, sizes: list[int], payload: bytes) -> np.ndarray:
        return np.unique(windows_of(texts_of(sizes, payload), window)[2])

    # Words are about six bytes long; the answer is yes for all but the first block with a window.
    answers, bits = exchange(blocks, hashes, total // 6, lambda first: ~first, by_id=True)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_type = batch.schema.field("ids").type.value_type
            for row in batch.to_pylist():
                words, firsts, gone = _repeated(row["ids"], row["sizes"], row["payload"], row["answers"], window, bits)
                kept, spans = [], []
                for text, begin, end in zip(words, firsts, firsts[1:]):
                    flags = gone[begin:end]
                    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0)) if flags.any() else ()
                    spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])])
                    kept.append(b" ".join(text if not len(edges) else [word for word, flag in zip(text, flags) if not flag]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], id_type), pa.array([len(text) for text in words], pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                    [id_column, "n_words", "kept", "removed"])

    return with_answers(blocks, answers).mapInArrow(
        cut, f"`{id_column}` {kind}, n_words long, kept string, removed array<struct<start:int,end:int>>")
