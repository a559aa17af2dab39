"""Suffix, substring and SimHash dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash

from millrace.llm import simhash, substring_dedup, suffix_dedup
from millrace.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def corpus(seed: int, n: int = 60) -> list[tuple[int | None, str | None]]:
    """Texts that share passages, with copies, empties, nulls and a run of one letter."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdé ", k=rng.randint(1, 6))) + " " for _ in range(400)]
    passages = ["".join(rng.choices(vocabulary, k=90)) for _ in range(4)]
    rows: list[tuple[int | None, str | None]] = [(None, passages[0]), (7000, None), (7001, ""), (7002, " \n "), (7003, "a" * 900), (7004, "xy" * 300)]
    for i in range(n):
        parts = ["".join(rng.choices(vocabulary, k=rng.randint(0, 150)))]
        if rng.random() < 0.5:
            parts.insert(rng.randint(0, 1), rng.choice(passages))
        rows.append((i, "".join(parts)))
    rows += [(2000 + i, rows[10][1]) for i in range(5)] + [rows[12]] * 3
    rng.shuffle(rows)
    return rows


def brute_bytes(rows, match):
    texts = [(key, (text or "").encode()) for key, text in rows]
    count = Counter(data[i:i + match] for _, data in texts for i in range(len(data) - match + 1))
    out = []
    for key, data in texts:
        gone = [False] * len(data)
        for i in range(len(data) - match + 1):
            if count[data[i:i + match]] > 1:
                gone[i:i + match] = [True] * match
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((key, len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone) if not g))))
    return sorted(out, key=repr)


def brute_words(rows, window):
    first: dict[tuple, int] = {}
    rank = {key: -1 if key is None else key for key, _ in rows}
    for key, text in rows:
        words = WORD.findall(text or "")
        for i in range(len(words) - window + 1):
            gram = tuple(words[i:i + window])
            first[gram] = min(first.get(gram, rank[key]), rank[key])
    out = []
    for key, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if first[tuple(words[i:i + window])] < rank[key]:
                gone[i:i + window] = [True] * window
        out.append((key, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g).encode())))
    return sorted(out, key=repr)


def brute_marks(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    marks = []
    for _, text in rows:
        words = WORD.findall((text or "").translate(lower))
        grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(gram.encode(), 42) for gram in grams]
        marks.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least: dict[int, int | None] = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((key, f"{mark:016x}", least.get(find(i))) for i, ((key, _), mark) in enumerate(zip(rows, marks))), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 3000, "bucket_bytes": 2000}, {"block_bytes": 3000, "bucket_bytes": 2000, "crowded": 2}])
@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(docs, seed, sizes):
    rows = corpus(seed)
    cut = suffix_dedup.remove_repeated_bytes(docs(rows).repartition(3), match=60, **sizes)
    got = [(r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.removed), len(r.removed), sha(r.kept)) for r in cut.collect()]
    assert sorted(got, key=repr) == brute_bytes(rows, 60)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("ordered", [True, False])
def test_words(docs, seed, ordered):
    rows = corpus(seed)
    table = docs(rows).orderBy("doc_id").coalesce(1) if ordered else docs(rows).repartition(5)
    cut = substring_dedup.remove_repeated(table, block_bytes=3000)
    got = [(r.doc_id, r.n_words, sum(s.end - s.start for s in r.removed), sha(r.kept.encode())) for r in cut.collect()]
    assert sorted(got, key=repr) == brute_words(rows, 13)


def test_intervals_are_maximal(docs):
    words = [f"w{i}" for i in range(40)]
    cut = substring_dedup.remove_repeated(docs([(1, " ".join(words[:30])), (2, "x " + " ".join(words[:30]) + " y")]))
    assert [[(s.start, s.end) for s in r.removed] for r in cut.orderBy("doc_id").collect()] == [[], [(1, 31)]]


@pytest.mark.parametrize("seed", [3, 4])
def test_marks(docs, seed):
    rows = corpus(seed)
    base = WORD.findall(rows[0][1] or "") or ["a"] * 50
    long = (base * 40)[:400]
    rows += [(500 + i, " ".join([*long[:i], f"new{i}", *long[i + 1:]])) for i in range(60)]
    got = [tuple(r) for r in simhash.near_duplicates(docs(rows)).collect()]
    assert sorted(got, key=repr) == brute_marks(rows)


def test_anchors_meet():
    """Whatever three bits differ, some anchor holds both, for one of them as its home."""
    import numpy as np
    rng = np.random.default_rng(5)
    for _ in range(300):
        mark = rng.integers(0, 1 << 63, dtype=np.uint64) * np.uint64(2) + np.uint64(rng.integers(0, 2))
        other = mark
        for bit in rng.choice(64, 3, replace=False):
            other ^= np.uint64(1 << int(bit))
        key, of, home = simhash.anchors(np.array([mark, other]))
        assert set(key[(of == 0) & home]) & set(key[of == 1])


def test_crowds_are_cut(spark):
    """Anchors with more members than one task compares give the same components."""
    import numpy as np
    rng = np.random.default_rng(6)
    marks = np.unique(rng.integers(0, 1 << 12, 900, dtype=np.uint64) << np.uint64(40))
    frame = spark.createDataFrame([(int(m),) for m in marks.view(np.int64)], "fingerprint long")
    want = components_of(simhash.links(frame), marks)
    assert components_of(simhash.links(frame, crowd=50), marks) == want
    assert len(set(want.values())) < len(marks)


def components_of(links, marks):
    root = {int(m): int(m) for m in marks}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for row in links.collect():
        a, b = sorted((find(row.a), find(row.b)))
        root[b] = a
    return {m: find(m) for m in root}


def test_empty_tables(docs):
    empty = docs([(1, "a")]).limit(0)
    assert suffix_dedup.remove_repeated_bytes(empty).count() == 0
    assert substring_dedup.remove_repeated(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0


def test_queries_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]

    def got(name, *columns):
        return sorted((tuple(r) for r in QUERIES[name](spark, FOLDER).select(*columns).collect()), key=repr)

    assert got("op1_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(rows, 200)
    assert got("op3_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") == brute_words(rows, 13)
    assert got("op4_simhash", "doc_id", "fingerprint", "component_id") == brute_marks(rows)


@pytest.mark.parametrize("kind", [
    "date_add(date'2020-01-01', cast(doc_id as int))", "cast(doc_id as decimal(20, 2)) - 100", "timestamp_seconds(doc_id * 1000)", "cast(doc_id as double) - 50.5",
    "concat('d', lpad(cast(doc_id as string), 8, '0'))", "encode(lpad(cast(doc_id as string), 8, '0'), 'utf-8')", "cast(doc_id as smallint)"])
def test_substring_dedup_by_ids_of_other_types(docs, kind):
    """Ids in the same order give the same cuts, over several blocks."""
    rows = corpus(11, 40)
    table = docs(rows).selectExpr("*", f"{kind} AS own").repartition(3)
    want = substring_dedup.remove_repeated(table, "doc_id", block_bytes=2000).select("kept").collect()
    got = substring_dedup.remove_repeated(table, "own", block_bytes=2000).select("kept").collect()
    assert sorted(r.kept for r in got) == sorted(r.kept for r in want)
