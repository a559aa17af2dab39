"""Suffix-array dedup of repeated byte strings, with a sparse suffix array.

Every string of MATCH bytes holds an anchor, chosen by its content alone: the place of the smallest
hash among its grams of half that length.  Equal strings have equal anchors, so it is enough to sort
the suffixes that start at anchors, one place in fifty, and to look at the bytes before them too.

1. Documents are packed into blocks.  Each block sends the hashes of its texts, of its anchors' grams
   and of their contexts (the bytes that any string around the anchor can cover), and learns which
   occur elsewhere.  Most anchors end here: their gram is unique, or their whole context is repeated.
2. For the others, one copy of each context travels.  Splitters sampled from leading bytes
   deal them to buckets by range; a bucket sorts its suffixes by multikey quicksort, and the contexts'
   beginnings likewise from the anchor backwards.  Common prefixes of neighbours then tell, for every
   place before the anchor, whether the string from there occurs twice.  Splitters cut between grams,
   never inside one: suffixes on either side of a boundary differ within the first gram, too early
   for a match, so that comparing across a boundary always ends there.
3. A gram that very many blocks share would fill one bucket.  Its contexts stay in their blocks, which
   send the hashes of their strings instead, as sorted runs, so that no bucket is hot.
4. Each block marks its covered bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import (
    BLOCK_BYTES, exchange, pack_blocks, pack_bytes, pack_run, read_answers, texts_of, unpack_bytes, unpack_run, with_answers)
from millrace.llm.substring_dedup import mix
from millrace.session import materialise

MATCH = 200
#: Places hashed at once.
SLAB = 1 << 18
#: Blocks that must share a gram for its strings to be compared by hashes.
CROWDED = 32
#: Leading bytes that splitters look at, blocks they are sampled from, text a bucket in bytes.
LEAD, SAMPLED_BLOCKS, BUCKET_BYTES = 24, 32, 8 << 20
BASE = 0xD6E8FEB86659FD93

REPEATED, MANY, FIRST = 1, 2, 4


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    up, down = np.full(n, BASE, dtype=np.uint64), np.full(n, pow(BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _salted(values: np.ndarray, salt: int) -> np.ndarray:
    return mix(values ^ np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64)))


class Anchors:
    """The anchors of a block: places, gram and context hashes, bytes before and after that count."""

    def __init__(self, texts: list[bytes], match: int) -> None:
        self.match, self.gram_size = match, match // 2
        self.reach = match - self.gram_size  # places before the anchor at which a string may start
        self.data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.ends = np.cumsum([len(text) for text in texts], dtype=np.int64)
        self.starts = self.ends - np.array([len(text) for text in texts], dtype=np.int64)
        found = [self._slab(at) for at in range(0, len(self.data), SLAB)]
        places, grams, contexts = (np.concatenate([part[i] for part in found]) if found else np.zeros(0, dtype=np.int64 if i == 0 else np.uint64) for i in range(3))
        self.places, index = np.unique(places, return_index=True)
        self.grams, self.contexts = grams[index], contexts[index]
        self.left, self.right = self._sides(self.places)
        self.whole = np.fromiter((xxhash.xxh64_intdigest(text, 1) for text in texts), dtype=np.uint64, count=len(texts))
        self.doc = np.searchsorted(self.ends, self.places, side="right")

    def _sides(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        doc = np.searchsorted(self.ends, places, side="right")
        return np.minimum(places - self.starts[doc], self.reach), np.minimum(self.ends[doc] - places, self.match)

    def _slab(self, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
        window, n = self.reach + 1, len(self.data)
        stop = min(at + SLAB, n - self.match + 1)
        if stop <= at:
            return none
        low, high = max(0, at - self.reach), min(n, stop + self.reach + self.match)
        up, down = _powers(SLAB + 4 * self.match)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum((self.data[low:high].astype(np.uint64) + np.uint64(1)) * up[:high - low], out=sums[1:])
        first, last = at - low, stop - 1 + self.reach - low  # of the grams, counted from low
        grams = mix((sums[first + self.gram_size:last + self.gram_size + 1] - sums[first:last + 1]) * down[first:last + 1])
        # The hash's upper bits, then the place: the smallest is the leftmost of equal grams.
        keys = (grams & ~np.uint64((1 << 20) - 1)) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        least = keys
        while width * 2 <= window:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = window - width
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        docs = np.arange(np.searchsorted(self.ends, at, side="right"), np.searchsorted(self.ends, stop - 1, side="right") + 1)
        inside = np.minimum(self.ends[docs], stop) - np.maximum(self.starts[docs], at)
        valid = np.repeat(self.ends[docs], inside) - np.arange(at, stop) >= self.match
        picked = np.unique(least[valid] & np.uint64((1 << 20) - 1)).astype(np.int64)
        places = picked + at
        left, right = self._sides(places)
        begin, end = places - left - low, places + right - low
        contexts = (sums[end] - sums[begin]) * down[begin]
        return places, _salted(grams[picked], 2), _salted(contexts + left.astype(np.uint64) * np.uint64(BASE) + right.astype(np.uint64), 3)

    def hashes(self) -> np.ndarray:
        return np.unique(np.concatenate([_salted(self.whole, 1), self.grams, self.contexts]))

    def read(self, answers: list[dict] | None, bits: int) -> None:
        """What the other blocks say: which texts are copied, which contexts repeated, and for which
        anchors this block sends the context to be sorted or the strings to be hashed."""
        values = self.hashes()
        codes = read_answers(answers, values, bits)

        def of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            at = np.searchsorted(values, hashes)
            _, first, inverse, count = np.unique(at, return_index=True, return_inverse=True, return_counts=True)
            here = np.zeros(len(at), dtype=bool)
            here[first] = True
            repeated = (codes[at] & REPEATED > 0) | (count[inverse] > 1)
            speaks = here & ((codes[at] & REPEATED == 0) | (codes[at] & FIRST > 0))
            return repeated, speaks, codes[at] & MANY > 0

        self.copied, _, _ = of(_salted(self.whole, 1))
        gram_repeated, _, crowded = of(self.grams)
        context_repeated, speaks, _ = of(self.contexts)
        counts = self.left + self.right >= self.match
        self.known = context_repeated & counts
        # One copy of a repeated context stands for all wherever others share its gram.
        sends = gram_repeated & speaks & counts
        self.sorted_anchors = np.flatnonzero(sends & ~crowded)
        self.hashed_anchors = np.flatnonzero(sends & crowded)

    def context(self, i: int) -> bytes:
        return self.data[self.places[i] - self.left[i]:self.places[i] + self.right[i]].tobytes()

    def leads(self, index: np.ndarray) -> np.ndarray:
        """The first bytes of the suffixes at anchors, as fixed strings."""
        take = self.places[index][:, None] + np.arange(LEAD)
        return np.ascontiguousarray(self.data[np.minimum(take, len(self.data) - 1)]).view(f"S{LEAD}").ravel()

    def strings(self) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of every string around the crowded anchors, each start once."""
        if not len(self.hashed_anchors):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        size = self.reach + self.match
        up, down = _powers(SLAB + 4 * self.match)
        starts, hashes = [], []
        for at in range(0, len(self.hashed_anchors), 4096):
            index = self.hashed_anchors[at:at + 4096]
            begin = self.places[index] - self.reach
            take = np.clip(begin[:, None] + np.arange(size), 0, len(self.data) - 1)
            sums = np.zeros((len(index), size + 1), dtype=np.uint64)
            np.cumsum((self.data[take].astype(np.uint64) + np.uint64(1)) * up[:size], axis=1, out=sums[:, 1:])
            offset = np.arange(self.reach + 1)
            rolled = (sums[:, offset + self.match] - sums[:, offset]) * down[offset]
            fits = (offset >= (self.reach - self.left[index])[:, None]) & (offset + self.match <= (self.reach + self.right[index])[:, None])
            starts.append((begin[:, None] + offset)[fits])
            hashes.append(_salted(rolled[fits], 4))
        starts, hashes = np.concatenate(starts), np.concatenate(hashes)
        starts, index = np.unique(starts, return_index=True)
        return starts, hashes[index]


def _marks(first: np.ndarray, crowded: int) -> np.ndarray:
    """Codes for sorted values of several blocks, each block's distinct."""
    begin = np.flatnonzero(first)
    size = np.diff(np.r_[begin, len(first)])
    several = np.repeat(size > 1, size)
    return (several * REPEATED + np.repeat(size >= crowded, size) * MANY + (several & first) * FIRST).astype(np.uint8)


def multikey_sort(rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows (zero-padded, with true ``sizes``) and common prefixes of neighbours.

    Multikey quicksort by words of eight bytes: only rows that are equal so far are compared in the
    next word, all such sets at once; sizes decide last.
    """
    n, width = rows.shape
    words = np.zeros((n, -(-width // 8) * 8), dtype=np.uint8)
    words[:, :width] = rows
    words = words.view(">u8").astype(np.uint64)
    order, group = np.arange(n), np.zeros(n, dtype=np.int64)
    for column in [*range(words.shape[1]), None]:
        tied = np.zeros(n, dtype=bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        at = np.flatnonzero(tied)
        if not len(at):
            break
        key = sizes if column is None else words[:, column]
        part = order[at][np.lexsort((key[order[at]], group[at]))]
        order[at] = part
        values, groups = key[part], group[at]
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = ~same
        inner = (groups[1:] == groups[:-1]) & (values[1:] != values[:-1])
        fresh[at[1:][inner]] = True
        group = np.cumsum(fresh) - 1
    common = np.zeros(n, dtype=np.int64)
    for at in range(1, n, 1 << 14):
        a, b = order[at - 1:at - 1 + (1 << 14)], order[at:at + (1 << 14)]
        a = a[:len(b)]
        differ = rows[a] != rows[b]
        shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        common[at:at + len(b)] = np.minimum(shared, np.minimum(sizes[a], sizes[b]))
    return order, common


def repeated_offsets(contexts: list[bytes], left: np.ndarray, match: int) -> tuple[np.ndarray, np.ndarray]:
    """Per context the least and the greatest distance before its anchor at which a string of
    ``match`` bytes starts that another context has too at the same distance; -1 if none."""
    n, reach = len(contexts), match - match // 2
    right = np.array([len(c) for c in contexts], dtype=np.int64) - left
    after, before = np.zeros((n, match), dtype=np.uint8), np.zeros((n, reach), dtype=np.uint8)
    for i, (text, k) in enumerate(zip(contexts, left)):
        row = np.frombuffer(text, dtype=np.uint8)
        after[i, :len(row) - k] = row[k:]
        before[i, :k] = row[:k][::-1]
    suffix, common = multikey_sort(after, right)
    prefix, shared = multikey_sort(before, left)
    place_after, place_before = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    place_after[suffix], place_before[prefix] = np.arange(n), np.arange(n)
    least, most = np.full(n, -1, dtype=np.int16), np.full(n, -1, dtype=np.int16)
    for distance in range(reach + 1):
        able = np.flatnonzero((left >= distance) & (right >= match - distance))
        if len(able) < 2:
            continue
        key = np.cumsum(common < match - distance)[place_after[able]] * n + np.cumsum(shared < distance)[place_before[able]]
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        twice = able[count[inverse] > 1]
        most[twice] = distance
        least[twice] = np.where(least[twice] < 0, distance, least[twice])
    return least, most


def _messages(anchors: Anchors, splitters: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket, its contexts) of a block."""
    index = anchors.sorted_anchors
    bucket = np.searchsorted(splitters, anchors.leads(index), side="right") if len(index) else index
    for part in np.unique(bucket):
        chosen = index[bucket == part]
        sizes = np.stack([anchors.left[chosen], anchors.right[chosen]]).astype("<i4")
        yield int(part), pack_bytes(len(chosen).to_bytes(4, "little") + sizes.tobytes() + b"".join(anchors.context(i) for i in chosen))


def _read_message(data: bytes) -> tuple[list[bytes], np.ndarray]:
    data = unpack_bytes(data)
    n = int.from_bytes(data[:4], "little")
    left, right = np.frombuffer(data, dtype="<i4", count=2 * n, offset=4).reshape(2, n).astype(np.int64)
    ends = 4 + 8 * n + np.cumsum(left + right)
    return [data[end - size:end] for end, size in zip(ends, left + right)], left


def remove_repeated_bytes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", match: int = MATCH,
                          block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES, crowded: int = CROWDED) -> DataFrame:
    """Per row of ``docs``: id, n_bytes, kept (the UTF-8 bytes left, as binary), removed (maximal runs
    of byte positions, ends exclusive).

    A byte goes if a string of ``match`` bytes over it also starts anywhere else, in the same text
    too; strings never cross texts.  A null text is empty; texts shorter than ``match`` stay whole.
    Ids are only carried along: null ids and repeated rows are texts of their own (a repeated text of
    ``match`` bytes goes entirely, in every row).  An empty table gives an empty result; further
    columns are not read.  Texts, contexts and crowded strings are equal if their 64-bit hashes
    are; what the buckets compare is compared byte by byte.
    """
    blocks = pack_blocks(docs, id_column, text_column, block_bytes)
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    total = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0] or 0

    def hashes(ids: list, sizes: list[int], payload: bytes) -> np.ndarray:
        return Anchors(texts_of(sizes, payload), match).hashes()

    # One anchor in about fifty bytes, with two hashes.
    answers, bits = exchange(blocks, hashes, total * 4 // match, lambda first: _marks(first, crowded))
    informed = with_answers(blocks, materialise(answers, "answers"))

    # Splitters: quantiles of the leading bytes of all anchors in some blocks.  They decide the balance
    # of buckets, nothing else.
    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = Anchors(texts_of(row["sizes"], row["payload"]), match)
                leads = found.leads(np.arange(0, len(found.places), 16)) if len(found.places) else []
                yield pa.RecordBatch.from_arrays([pa.array([bytes(x).ljust(LEAD, b"\0") for x in leads], pa.binary())], ["lead"])

    buckets = max(total // bucket_bytes, 1)
    # Blocks are chosen by number first, so that no task reads more of them than these.
    some = [row[0] for row in blocks.select("block").orderBy(F.xxhash64("block")).limit(SAMPLED_BLOCKS).collect()] if buckets > 1 else []
    sampled = blocks.filter(F.col("block").isin(some)).mapInArrow(lead, "lead binary") if some else None
    leads = np.sort(np.array([bytes(row[0]) for row in sampled.collect()], dtype=f"S{LEAD}")) if sampled is not None else np.zeros(0, dtype=f"S{LEAD}")
    splitters = np.unique(leads[np.arange(1, buckets) * len(leads) // buckets]) if len(leads) else leads
    ranges = len(splitters) + 1

    # Ranges of hashes have negative numbers, buckets of suffixes the others.
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = Anchors(texts_of(row["sizes"], row["payload"]), match)
                found.read(row["answers"], bits)
                messages = list(_messages(found, splitters))
                values = np.unique(found.strings()[1])
                cut = np.searchsorted(values, np.arange(1, ranges, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // ranges))
                messages += [(-1 - k, pack_run(run)) for k, run in enumerate(np.split(values, cut)) if len(run)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(messages), pa.int64()), pa.array([part for part, _ in messages], pa.int32()),
                     pa.array([data for _, data in messages], pa.binary())], ["block", "part", "message"])

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block", kind="stable")
        out = []
        if frame["part"].iloc[0] < 0:
            runs = [unpack_run(run) for run in frame["message"]]
            values = np.concatenate(runs)
            _, inverse, count = np.unique(values, return_inverse=True, return_counts=True)
            results = (count[inverse] > 1).astype(np.uint8)
            sizes = [len(run) for run in runs]
        else:
            read = [_read_message(message) for message in frame["message"]]
            contexts = [context for each, _ in read for context in each]
            least, most = repeated_offsets(contexts, np.concatenate([left for _, left in read]), match)
            results, sizes = np.stack([least, most], axis=1), [len(each) for each, _ in read]
        at = 0
        for size in sizes:
            out.append(pack_bytes(np.ascontiguousarray(results[at:at + size]).tobytes(), 1))
            at += size
        return frame[["block", "part"]].assign(answer=out)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_type = batch.schema.field("ids").type.value_type
            for row in batch.to_pylist():
                yield _cut_block(row, match, bits, splitters, id_type, id_column)

    replies = informed.mapInArrow(send, "block long, part int, message binary").groupBy("part").applyInPandas(
        compare, "block long, part int, answer binary")
    told = replies.groupBy("block").agg(F.collect_list(F.struct("part", "answer")).alias("replies"))
    return informed.join(told, "block", "left").mapInArrow(
        cut, f"`{id_column}` {kind}, n_bytes long, kept binary, removed array<struct<start:int,end:int>>")


def _cut_block(row: dict, match: int, bits: int, splitters: np.ndarray, id_type: pa.DataType, id_column: str) -> pa.RecordBatch:
    texts = texts_of(row["sizes"], row["payload"])
    found = Anchors(texts, match)
    found.read(row["answers"], bits)
    change = np.zeros(len(found.data) + 1, dtype=np.int32)

    def cover(begin: np.ndarray, end: np.ndarray) -> None:
        np.add.at(change, begin, 1)
        np.add.at(change, end, -1)

    whole = found.copied & (found.ends - found.starts >= match)
    cover(found.starts[whole], found.ends[whole])
    known = np.flatnonzero(found.known)
    cover(found.places[known] - found.left[known], found.places[known] + found.right[known])
    replies = {reply["part"]: unpack_bytes(reply["answer"]) for reply in row["replies"] or ()}
    # Contexts in the order in which they were sent, bucket by bucket.
    index = found.sorted_anchors
    bucket = np.searchsorted(splitters, found.leads(index), side="right") if len(index) else index
    for part in np.unique(bucket):
        chosen = index[bucket == part]
        least, most = np.frombuffer(replies[int(part)], dtype=np.int16).reshape(-1, 2).T
        hit = least >= 0
        cover(found.places[chosen[hit]] - most[hit], found.places[chosen[hit]] - least[hit] + match)
    starts, hashes = found.strings()
    if len(starts):
        values, inverse, count = np.unique(hashes, return_inverse=True, return_counts=True)
        said = np.concatenate([np.frombuffer(replies[part], dtype=np.uint8) for part in sorted((p for p in replies if p < 0), reverse=True)])
        again = (said > 0)[inverse] | (count[inverse] > 1)
        cover(starts[again], starts[again] + match)
    gone = np.cumsum(change[:-1]) > 0
    kept, spans = [], []
    for text, begin, end in zip(texts, found.starts, found.ends):
        flags = gone[begin:end]
        if not flags.any():
            kept.append(text)
            spans.append([])
            continue
        edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0)).tolist()
        spans.append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])])
        kept.append(found.data[begin:end][~flags].tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(row["ids"], id_type), pa.array(row["sizes"], pa.int64()), pa.array(kept, pa.binary()),
         pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
        [id_column, "n_bytes", "kept", "removed"])
