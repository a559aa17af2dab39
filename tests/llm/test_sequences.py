"""Periodic runs, token files and the conversation trie against brute force and exact round trips."""

from __future__ import annotations

import hashlib
import json
import random
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import periodic_runs, prefix_trie, token_files
from millrace.llm.queries import QUERIES, public_tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"
CLASH = ("_row", "_tie", "ids", "n_tokens", "runs", "kept", "_k", "key", "sizes", "place", "code", "part", "ref")


def clashing(frame):
    """The same table with further columns, named like inner ones."""
    return frame.selectExpr("*", *[f"'x' AS `{name}`" for name in CLASH if name not in frame.columns])


# Periodic runs

def brute_runs(words, exponent=4, least=1):
    found = {}
    for p in range(1, len(words) // exponent + 1):
        i = 0
        while i < len(words) - p:
            j = i
            while j < len(words) - p and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, exponent * p):
                found.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted((start, length, p) for (start, length), p in found.items())


def brute_kept(words, runs):
    gone = {i for start, length, p in runs for i in range(start + p, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def random_text(rng):
    letters = "abcdefgh"[:rng.choice([1, 2, 2, 3, 8])]
    if rng.random() < 0.3:
        return [rng.choice(letters) for _ in range(rng.randint(0, 150))]
    words = []
    for _ in range(rng.randint(1, 12)):
        root = [rng.choice(letters) for _ in range(rng.randint(1, 14))]
        if rng.random() < 0.4:  # a root with periods of its own
            root = root * rng.randint(1, 5) + [rng.choice(letters)]
        words += root * rng.randint(1, 7) + root[:rng.randint(0, len(root))]
    return words


@pytest.mark.parametrize("seed", range(40))
def test_runs_are_those_of_brute_force(seed):
    rng = random.Random(seed)
    texts = [random_text(rng) for _ in range(rng.randint(1, 12))]
    firsts = np.concatenate([[0], np.cumsum([len(text) for text in texts])]).astype(np.int64)
    found = defaultdict(list)
    for text, *run in periodic_runs.find_runs(np.array([ord(c) for text in texts for c in text], dtype=np.int64), firsts):
        found[text].append(tuple(run))
    for at, text in enumerate(texts):
        assert sorted(found[at]) == brute_runs(text), text


def test_equal_hashes_make_up_no_run(monkeypatch):
    """With hashes of two bits almost every pair is a false one; what is found is periodic and cannot be extended."""
    monkeypatch.setattr(periodic_runs, "mix", lambda values: values & np.uint64(3))
    for seed in range(30):
        text = random_text(random.Random(seed))
        runs = periodic_runs.find_runs(np.array([ord(c) for c in text], dtype=np.int64), np.array([0, len(text)]))
        for _, start, length, p in runs:
            end = start + length
            assert length >= 4 * p and text[start:end - p] == text[start + p:end]
            assert (start == 0 or text[start - 1] != text[start - 1 + p]) and (end == len(text) or text[end] != text[end - p])


def test_collapse(docs):
    rng = random.Random(7)
    rows = [(i, " ".join(random_text(rng))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, " \n\t "), (None, "a " * 9), (None, "a " * 9), (1, "x\x0by\x85 z" * 5), (903, "é é " * 4),
             (904, "lorem " * 60_000), (905, " ".join(f"w{i % 500}" for i in range(40_000)))]
    for small in (1 << 20, 300):
        got = sorted(map(repr, periodic_runs.collapse_runs(clashing(docs(rows)), slice_bytes=small).collect()))
        want = []
        for key, text in rows:
            words = WORD.findall(text or "")
            runs = {904: [(0, 60_000, 1)], 905: [(0, 40_000, 500)]}.get(key) or brute_runs(words, least=6)
            want.append(repr((key, len(words), brute_kept(words, runs), runs)))
        assert sorted(repr((r[0], r[1], r[2], [tuple(run) for run in r[3]])) for r in
                      periodic_runs.collapse_runs(docs(rows), slice_bytes=small).collect()) == sorted(want) and len(got) == len(rows)
    assert periodic_runs.collapse_runs(docs(rows).limit(0)).count() == 0
    fifth = periodic_runs.collapse_runs(docs([(1, "a b a b a b a b a")]), exponent=5).first()
    assert fifth.runs == [] and fifth.kept == "a b a b a b a b a"
    with pytest.raises(ValueError):
        periodic_runs.collapse_runs(docs(rows), exponent=3)


def test_runs_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, FOLDER).collect()}
    assert len(got) == len(texts)
    repeated = 0
    for key, text in texts.items():
        words, h = WORD.findall(text or ""), zlib.crc32(str(key).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p, repeated = 1 + (n - a) // (3 + g % 8), repeated + 1
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs, row = brute_runs(words, least=6), got[key]
        best = max(runs, key=lambda run: (run[1], -run[0], -run[2]), default=(None, None, None))
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(brute_kept(words, runs).encode()).hexdigest()
    assert repeated > 5


# Token files

@pytest.mark.parametrize("block_ids", [1, 7, 128, 1024])
@pytest.mark.parametrize("percentile", [0.5, 0.9, 1.0])
def test_blocks_come_back(block_ids, percentile):
    rng = random.Random(block_ids)
    for top in (0, 1, 300, 50_000, 1 << 31, (1 << 32) - 1):
        n = rng.randint(0, 3000)
        ids = np.array([rng.randint(0, top) if rng.random() < 0.05 else rng.randint(0, min(top, 90)) for _ in range(n)], dtype=np.uint32)
        docs = pa.record_batch([pa.array([n], pa.int64()), pa.array([n], pa.int64())], ["id", "n_tokens"])
        file = token_files.TokenFile(token_files.make_file(2, 5, ids, docs, block_ids, percentile) + b"\n")
        assert (file.part, file.number, file.n_ids, file.n_docs) == (2, 5, n, 1) and file.docs().to_pylist() == [{"id": n, "n_tokens": n}]
        assert file.ids(0, n).tolist() == ids.tolist()
        for _ in range(5):
            begin = rng.randint(0, n)
            end = rng.randint(begin, n)
            assert file.ids(begin, end).tolist() == ids[begin:end].tolist()
        with pytest.raises(ValueError):
            file.ids(0, n + 1)


def test_rare_large_ids_do_not_widen_a_block():
    ids = np.arange(1024, dtype=np.uint32) % 16 + 40_000
    ids[[5, 900]] = 4_000_000_000
    (narrow,), (wide,) = token_files.pack_ids(ids, percentile=0.98), token_files.pack_ids(ids, percentile=1.0)
    assert token_files.BLOCK.unpack_from(narrow) == (40_000, 4, 2) and len(narrow) == 7 + 512 + 2 * 6
    assert token_files.BLOCK.unpack_from(wide) == (40_000, 32, 0)
    with pytest.raises(ValueError):
        token_files.TokenFile(b"MILLTOK1" + bytes(60))


def test_words_are_encoded_as_whole_texts_are():
    definition = public_tokenizer("word_bpe_49k.json")
    tool, rng = token_files.Encoder(definition), random.Random(3)
    assert tool.by_words and not token_files.parts_at_blanks(json.loads(public_tokenizer("byte_bpe_50k.json")))
    parts = ["a", "B", "É", "é", "́", "Σ", "ς", "İ", "ß", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", " ", "1", "23", "'s", "'T", ",", "...",
             "<|endoftext|>", "<|ENDOFTEXT|>", "日本", "​", "﻿", "😀", "Hello", "WORLD", "don't", "\x00", "ΑΣ", "K", "Å"]
    for _ in range(60):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(20)] + [None, ""]
        ids, counts = tool.encode(pa.array(texts, pa.string()))
        each = np.split(ids, np.cumsum(counts)[:-1])
        assert [own.tolist() for own in each] == [tool.tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]


def changed_tokenizer(**parts):
    return json.dumps(json.loads(public_tokenizer("word_bpe_49k.json")) | parts)


@pytest.mark.parametrize("definition", [
    public_tokenizer("word_bpe_49k.json"),
    changed_tokenizer(normalizer={"type": "Sequence", "normalizers": [{"type": "NFD"}, {"type": "Lowercase"}]}),
    changed_tokenizer(normalizer=None),
    changed_tokenizer(pre_tokenizer={"type": "WhitespaceSplit"}),
    changed_tokenizer(added_tokens=[]),
])
def test_pieces_of_all_small_code_points_are_encoded_as_whole_texts_are(definition, monkeypatch):
    tool, rng = token_files.Encoder(definition), random.Random(8)
    assert tool.by_words
    monkeypatch.setattr(token_files, "KNOWN_WORDS", 500)  # so that words are forgotten on the way
    signs = [chr(code) for code in range(0x250)] + ["\u0301", "\u2126", "\u3042", "\U0001f600", "<|endoftext|>", "the", "The", "É", "12", "'s"]
    texts = ["".join(near) for near in zip(signs, signs[1:], signs[2:])] + [f"x{one}Y {one}" for one in signs]
    texts += ["".join(rng.choice(signs[32:127] + signs[0xC0:0x180] + [" "]) for _ in range(rng.randint(0, 30))) for _ in range(600)]
    texts += [None, "", " ", "a", " a", "a ", "a", "\n"]
    for begin in range(0, len(texts), 200):
        some = pa.array(texts, pa.string()).slice(begin, 200)
        ids, counts = tool.encode(some)
        each = np.split(ids, np.cumsum(counts)[:-1])
        assert ids.dtype == np.uint32 and len(counts) == len(some)
        assert [own.tolist() for own in each] == [tool.tokenizer.encode(text or "", add_special_tokens=False).ids for text in some.to_pylist()]
    for nothing in ([], [None], ["", " "]):
        ids, counts = tool.encode(pa.array(nothing, pa.string()))
        assert len(ids) == 0 and counts.tolist() == [0] * len(nothing)


def test_words_of_the_same_pieces_are_learnt_once(monkeypatch):
    tool = token_files.Encoder(public_tokenizer("word_bpe_49k.json"))
    batches = []
    monkeypatch.setattr(tool, "_batch", lambda words, plain=tool._batch: batches.extend(words) or plain(words))
    tool.encode(pa.array(["Word word, WORD. (word) Élève élève, ÉLÈVE", "word; Élève. word,"]))
    assert sorted(tool.known) == sorted(["word", "élève", ",", ".", "(", ")", ";"])
    tool.encode(pa.array(["words, Élèves. été"]))
    assert len(tool.known) == 10 and not any(word.isalpha() for word in batches)  # letters go to the model as they are


def token_rows(frame):
    return sorted((repr(r.doc_id), r.start, r.n_tokens, r.ids) for r in frame.collect())


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_files_hold_all_documents_in_order(spark, docs, tmp_path, name):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["to", "Be", "or,", "not", "quite?"]) for _ in range(rng.randint(0, 60)))) for i in rng.sample(range(-500, 500), 300)]
    rows += [(None, "same text")] * 150 + [(None, None), (7_000, ""), (7_001, "many words " * 20_000)] + [(1, "twice")] * 3
    definition = public_tokenizer(name)
    token_files.write_tokens(clashing(docs(rows).repartition(7)), f"{tmp_path}/a", definition, end_id=1, block_ids=64, file_ids=500)
    back = token_files.read_tokens(spark, f"{tmp_path}/a").collect()
    tool = token_files.Encoder(definition).tokenizer
    want = [(key, [*tool.encode(text or "", add_special_tokens=False).ids, 1]) for key, text in rows]
    assert sorted((repr(r.doc_id), bytes(r.ids)) for r in back) == sorted((repr(key), struct.pack(f"<{len(ids)}I", *ids)) for key, ids in want)
    back.sort(key=lambda r: r.start)
    assert [r.doc_id is not None for r in back] == sorted(r.doc_id is not None for r in back)
    keys, at = [r.doc_id for r in back if r.doc_id is not None], 0
    assert keys == sorted(keys)
    for row in back:
        assert row.start == at and row.n_tokens * 4 == len(row.ids)
        at += row.n_tokens
    whole = b"".join(bytes(row.ids) for row in back)
    index = token_files.read_index(spark, f"{tmp_path}/a").orderBy("first_id").collect()
    assert len(index) > 20 and sum(r.n_docs for r in index) == len(rows) and index[-1].first_id + index[-1].n_ids == at
    few = token_files.read_stretch(spark, f"{tmp_path}/a", 499, 502)
    assert len(few.inputFiles()) <= 2  # no other file is opened
    for begin, end in ((0, at), (0, 1), (499, 502), (at - 3, at), (1000, 9000), (5, 5)):
        parts = sorted((r["at"], bytes(r.ids)) for r in token_files.read_stretch(spark, f"{tmp_path}/a", begin, end).collect())
        assert b"".join(ids for _, ids in parts) == whole[4 * begin:4 * end]


def test_files_of_texts_as_ids_and_of_nothing(spark, docs, tmp_path):
    definition = public_tokenizer("word_bpe_49k.json")
    named = docs([(i, f"text {i}") for i in range(50)]).withColumn("doc_id", F.concat(F.lit("doc-"), F.col("doc_id")))
    token_files.write_tokens(named, f"{tmp_path}/b", definition)
    back = token_files.read_tokens(spark, f"{tmp_path}/b", "string").orderBy("start").collect()
    assert [r.doc_id for r in back] == sorted(f"doc-{i}" for i in range(50))
    token_files.write_tokens(docs([(1, "x")]).limit(0), f"{tmp_path}/c", definition, end_id=1)
    assert token_files.read_tokens(spark, f"{tmp_path}/c").count() == 0 and token_files.read_index(spark, f"{tmp_path}/c").count() == 0


def test_token_query(spark):
    tool = token_files.Encoder(public_tokenizer("word_bpe_49k.json")).tokenizer
    want, at = [], 0
    for row in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect():
        ids = [*tool.encode(row.text or "", add_special_tokens=False).ids, 1]
        want.append((row.doc_id, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    got = QUERIES["op12_token_files"](spark, FOLDER).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want


# Conversation trie

def brute_trie(sequences):
    """From {conv_id: [(role, text)]}; null ids count as the least and are written as nothing."""
    order = lambda c: (c is not None, c or 0)
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    least = {path: min(convs, key=order) for path, convs in members.items()}
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    rows, sums = [], {}
    for path in sorted(members, key=len, reverse=True):
        saved = (len(members[path]) - 1) * (len(path[-1][1].encode()) if path else 0) + sum(sums[kid][0] for kid in kids[path])
        leaves = sum(sums[kid][1] for kid in kids[path]) or 1
        sums[path] = saved, leaves
        ids = ",".join("" if c is None else str(c) for c in sorted(ends[path], key=order))
        rows.append((least[path], len(path), least[path[:-1]] if path else None, len(members[path]), len(kids[path]), leaves, saved,
                     hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(rows, key=repr)


def conversations(spark, sequences, shuffle=None):
    rows = [(c, t, role, text) for c, turns in sequences.items() for t, (role, text) in enumerate(turns)]
    if shuffle:
        shuffle.shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("seed, range_turns, fan", [(0, 1 << 19, 64), (1, 40, 2), (2, 5, 2), (3, 10, 3), (4, 1, 2)])
def test_trie(spark, seed, range_turns, fan):
    rng = random.Random(seed)
    texts = ["", "a", "ééé", "long text " * 5]
    sequences = {c * 3 - 200: [(rng.choice("ua"), rng.choice(texts)) for _ in range(rng.choice([1, 2, 2, 3, 5, 9]))] for c in range(200)}
    sequences |= {c + 1000: [("u", "hot"), ("a", "same")] for c in range(120)}  # many equal ones, over several ranges
    sequences |= {c + 2000: [("u", "hot"), ("a", "same"), *[("u", "again")] * (c % 40)] for c in range(60)}
    sequences[None] = [("u", "hot")]
    table = clashing(conversations(spark, sequences, rng)).withColumn("turn", F.expr("nullif(turn, 0)"))
    got = prefix_trie.conversation_trie(table, range_turns, fan)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(sequences)


def test_trie_of_little(spark):
    assert prefix_trie.conversation_trie(conversations(spark, {1: [("u", "x")]}).limit(0)).count() == 0
    one = {5: [("u", None), (None, "x")]}
    got = prefix_trie.conversation_trie(conversations(spark, one)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_trie({5: [("u", ""), ("", "x")]})
    assert prefix_trie.conversation_trie(conversations(spark, {1: [("a", "b:"), ("ab", ":")], 2: [("ab", ":")]})).count() == 4
    long = {1: [("u", str(i)) for i in range(3000)], 2: [("u", str(i)) for i in range(2500)]}
    got = prefix_trie.conversation_trie(conversations(spark, long)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_trie(long)
    with pytest.raises(TypeError):
        prefix_trie.conversation_trie(conversations(spark, one).withColumn("conv_id", F.lit("x")))


def test_trie_query(spark):
    original = defaultdict(list)
    for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").orderBy("conv_id", "turn").collect():
        original[r.conv_id].append((r.role or "", r.text or ""))
    rebuilt = {}
    for c, turns in list(original.items()):
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = original.get(c - c % 5, [])[:h] + turns[h:]
    got = QUERIES["op13_prefix_trie"](spark, FOLDER).collect()
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r[name] for name in names) for r in got), key=repr) == brute_trie(rebuilt)
