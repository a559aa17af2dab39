"""Maximal periodic runs of words, found by string synchronising sets at dyadic scales.

At scale t (1, 2, 4, ...) a position is chosen if the least hash of the t-word strings that begin in
[i, i + t] is that of the first or of the last of them.  Whether it is chosen depends on the 2t words from
it on alone, so a run with a period q in [t, 2t) repeats its chosen positions, with equal contexts of 2t
words, every q words: such pairs propose periods, and comparing words settles how far each holds.  Strings
with a period of at most t / 4 are left out of the minimum, else every position of "a a a a" would be
chosen at every scale; the regions of such strings are runs of smaller periods, which the scales below
have found.  Of any t places that do not all lie in such a region one is chosen, hence every run of four
periods or more holds a pair: with S empty on [s, s + q], s to s + q + 2t would have a period of at most
t / 4 and the period q, so q would not be the smallest.  Words decide how far a period holds, so no run is made up;
two contexts of one text with equal 64-bit hashes could hide one, a chance of n^2 / 2^65 in a text of n words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from millrace.llm.common import narrow
from millrace.session import ship_package

#: Runs have this many periods and words at least.  The search is built for four periods or more.
EXPONENT, LEAST = 4, 6
#: Bytes of text that a task looks at in one go, if no text is longer.
SLICE_BYTES = 4 << 20
#: Up to this scale pairs are found by comparing at each distance, above it by sorting contexts.
SMALL_SCALE = 4

NEVER = np.uint64(2**64 - 1)


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


def window_min(values: np.ndarray, scale: int) -> np.ndarray:
    """Least of the ``scale`` + 1 values from each position on; ``scale`` is a power of two."""
    step = 1
    while step < scale:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return np.minimum(values[:-1], values[1:])


def _covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    change = np.zeros(size + 1, dtype=np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def _proposals(chosen: np.ndarray, context: np.ndarray, text: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of pairs of chosen positions of a text with equal contexts."""
    if scale <= SMALL_SCALE:
        found = [(np.flatnonzero(chosen[:-d] & chosen[d:] & (context[:-d] == context[d:])), d) for d in range(scale, 2 * scale)]
        first = np.concatenate([at for at, _ in found])
        distance = np.concatenate([np.full(len(at), d, dtype=np.int64) for at, d in found])
    else:
        at = np.flatnonzero(chosen)
        by_context = np.argsort(context[at], kind="stable")
        at, same = at[by_context], context[at][by_context]
        distance = np.diff(at)
        ok = (same[1:] == same[:-1]) & (distance >= scale) & (distance < 2 * scale)
        first, distance = at[:-1][ok], distance[ok]
    ok = text[first] == text[first + distance]
    return first[ok], distance[ok]


def _agree(one: np.ndarray, two: np.ndarray) -> int:
    """How many values agree from the start, looking at ever larger parts."""
    done, step = 0, 16
    while done < len(one):
        differ = one[done:done + step] != two[done:done + step]
        at = int(differ.argmax()) if len(differ) else 0
        if len(differ) and differ[at]:
            return done + at
        done, step = done + step, step * 2
    return len(one)


def find_runs(words: np.ndarray, firsts: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Of texts that stand one after the other, each run as (text, start in the text, length, smallest period).

    ``words`` holds a number a word, equal for equal words, and text k is words[firsts[k]:firsts[k + 1]].
    All runs of four periods and four words or more, in no order.
    """
    sizes, text_of = np.diff(firsts), np.arange(len(firsts) - 1)
    words, firsts = words.astype(np.int64), firsts.astype(np.int64)
    hashed = mix(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    runs: dict[tuple[int, int, int], int] = {}
    first_of = dict(zip(text_of.tolist(), firsts.tolist()))
    scale = 1
    while len(sizes) and EXPONENT * scale <= sizes.max():
        long = sizes >= EXPONENT * scale
        if sizes[long].sum() < 0.8 * len(words):
            stay = np.repeat(long, sizes)
            words, hashed, sizes, text_of = words[stay], hashed[stay], sizes[long], text_of[long]
            firsts = np.concatenate([[0], np.cumsum(sizes)])
            first_of = dict(zip(text_of.tolist(), firsts.tolist()))
        size, row = len(words), np.repeat(np.arange(len(sizes)), sizes)
        ends = firsts[1:][row]
        order = hashed >> np.uint64(1)
        flat = [(first_of[t] + s, first_of[t] + s + n - scale + 1) for (t, s, n), p in runs.items()
                if EXPONENT * p <= scale <= n and t in first_of]
        if flat:
            begin, stop = np.array(flat, dtype=np.int64).T
            order = np.where(_covered(begin, stop, size), NEVER, order)
        least = window_min(order, scale)
        # Hashes of 2 * scale words; those that reach over the end of a text are never used.
        context = hashed.copy()
        context[:-scale] = mix(hashed[:-scale] * np.uint64(0xA0761D6478BD642F) + hashed[scale:])
        chosen = np.zeros(size, dtype=bool)
        chosen[:-scale] = ((order[:-scale] == least) | (order[scale:] == least)) & (least != NEVER)
        chosen &= np.arange(size) + 2 * scale <= ends
        at, distance = _proposals(chosen, context, row, scale)
        by = np.lexsort((at, distance))
        at, distance = at[by], distance[by]
        # Pairs at the same distance that overlap by a period say the same.
        new = np.ones(len(at), dtype=bool)
        new[1:] = (distance[1:] != distance[:-1]) | (at[1:] - at[:-1] > 2 * scale) | (row[at[1:]] != row[at[:-1]])
        heads = np.flatnonzero(new)
        for k, last in zip(heads.tolist(), [*heads[1:].tolist(), len(at)]):
            while k < last:
                low, d, here = int(at[k]), int(distance[k]), int(row[at[k]])
                if not np.array_equal(words[low:low + 2 * scale], words[low + d:low + d + 2 * scale]):
                    k += 1  # equal hashes of different words
                    continue
                begin, stop = int(firsts[here]), int(firsts[here + 1])
                high = low + _agree(words[low:stop - d], words[low + d:stop]) + d
                low -= _agree(words[begin:low][::-1], words[begin + d:low + d][::-1])
                if high - low >= EXPONENT * d:
                    key = (int(text_of[here]), low - begin, high - low)
                    runs[key] = min(d, runs.get(key, d))
                k += 1 + int(np.searchsorted(at[k + 1:last], high - d - 2 * scale, side="right"))
        hashed, scale = context, 2 * scale
    return [(*key, period) for key, period in runs.items()]


def split_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and the number of words before each text and in all."""
    lists = pc.ascii_split_whitespace(texts.fill_null(""))
    values, offsets = lists.flatten(), np.asarray(lists.offsets, dtype=np.int64)
    real = np.asarray(pc.not_equal(values, ""), dtype=bool)
    before = np.concatenate([[0], np.cumsum(real)])
    return values.filter(pa.array(real)), before[offsets - offsets[0]]


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most so many bytes, or one row."""
    begin, total = 0, 0
    for row, size in enumerate(sizes):
        if row > begin and total + size > most:
            yield begin, row
            begin, total = row, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def collapse_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", exponent: int = EXPONENT,
                  least: int = LEAST, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Per row of ``docs``: id, n_words, kept, runs.

    runs has a struct (start, length, period) for each maximal stretch of words with smallest period p and
    at least max(``least``, ``exponent`` * p) words, by start, then period; ``exponent`` is four or more.
    kept is the text without the words that some run holds after its first period, joined by one space.

    Words are the runs between ASCII white space, unchanged.  A null or empty text has no words, no runs and
    an empty kept; ids may be null or repeated and of any type, each row is judged by itself.  An empty table
    gives an empty result; further columns are not read.  Nothing is exchanged.  A task holds a slice of
    ``slice_bytes`` or one text, at about a hundred bytes a word.
    """
    if exponent < EXPONENT:
        raise ValueError(f"exponent must be at least {EXPONENT}")
    ship_package(docs.sparkSession)
    chosen = narrow(docs, id_column, text_column)
    kind = chosen.schema[id_column].dataType.simpleString()
    span = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def judge(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        words, firsts = split_texts(texts)
        numbers = words.dictionary_encode().indices.to_numpy()
        found = sorted((text, start, period, length) for text, start, length, period in find_runs(numbers, firsts)
                       if length >= max(least, exponent * period))
        at = np.array([(firsts[text] + start + period, firsts[text] + start + length) for text, start, period, length in found], dtype=np.int64).reshape(-1, 2)
        stays = ~_covered(at[:, 0], at[:, 1], len(numbers))
        before = np.concatenate([[0], np.cumsum(stays)])
        lists = pa.ListArray.from_arrays(pa.array(before[firsts], pa.int32()), words.filter(pa.array(stays)))
        runs: list[list[dict]] = [[] for _ in range(len(ids))]
        for text, start, period, length in found:
            runs[text].append({"start": start, "length": length, "period": period})
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(np.diff(firsts), pa.int64()), pc.binary_join(lists, " "), pa.array(runs, pa.list_(span))],
            [id_column, "n_words", "kept", "runs"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).tolist()
            for begin, end in slices(sizes, slice_bytes):
                yield judge(batch.column(0).slice(begin, end - begin), texts.slice(begin, end - begin))

    return chosen.mapInArrow(
        work, f"`{id_column}` {kind}, n_words long, kept string, runs array<struct<start:long,length:long,period:long>>")
