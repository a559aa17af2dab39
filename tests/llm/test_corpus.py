"""Mixing, the language model, decontamination and the pipeline against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import decontaminate, kneser_ney, mixing
from millrace.llm.queries import QUERIES, trusted_ids

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"


# Mixing

def brute_targets(sizes):
    """Share by weight, cut at the cap, reshare the excess until none is above."""
    names = sorted((name for name in sizes if name is not None), key=lambda name: [ord(c) for c in name]) + [None] * (None in sizes)
    weights = {name: (5, 2, 1)[i % 3] for i, name in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        level = left / sum(weights[n] for n in open_)
        full = {n for n in open_ if level * weights[n] > 2 * sizes[n]}
        for n in full or open_:
            target[n] = 2 * sizes[n] if full else level * weights[n]
            left -= target[n]
        open_ -= full or set(open_)
    return target


@pytest.mark.parametrize("seed", range(6))
def test_knapsack_fits_what_can_be_fitted(seed):
    rng = random.Random(seed)
    lengths = np.array(sorted(rng.sample(range(1, 60), rng.randint(1, 6))))
    counts = np.array([rng.randint(1, 5) for _ in lengths])
    sums = {0}
    for length, n in zip(lengths, counts):
        sums = {s + k * int(length) for s in sums for k in range(n + 1)}
    for budget in range(0, int((lengths * counts).sum()) + 3, 7):
        for program in (1 << 16, 40):
            taken = mixing.fit_counts(lengths, counts, budget, program)
            assert (taken >= 0).all() and (taken <= counts).all() and (lengths * taken).sum() <= budget
            if program > budget:
                assert (lengths * taken).sum() == max(s for s in sums if s <= budget)


@pytest.mark.parametrize("seed", range(3))
def test_mix(docs, seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 7, 7, 7, rng.randint(1, 400)])), rng.choice(["a", "b", "ab", "é", None])) for i in range(600)]
    rows += [(900, None, "a"), (901, None, "empty"), (1, "x y z", "b"), (None, "n n", None)]
    table = docs(rows)
    mixed = mixing.mix_sources(table).collect()
    assert len(mixed) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    target, taken = brute_targets(sizes), Counter()
    for r in mixed:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source], rel_tol=1e-9, abs_tol=1e-6)
        assert 0 <= r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    again = mixing.mix_sources(table.repartition(5)).collect()
    def view(found):
        return sorted((str(r.doc_id), r.size, r.taken) for r in found if r.doc_id != 1)

    assert view(mixed) == view(again)
    assert mixing.mix_sources(table.limit(0)).count() == 0


def test_hot_length_is_cut(docs, monkeypatch):
    """Documents of one length and source, ranked in ranges of the hash."""
    monkeypatch.setattr(mixing, "RANKED", 10)
    rows = [(i, "a b c", "hot") for i in range(500)] + [(600 + i, "d e", "z") for i in range(100)]
    mixed = mixing.mix_sources(docs(rows)).collect()
    hot = [r for r in mixed if r.source == "hot"]
    assert abs(sum(r.taken for r in hot) - hot[0].target) <= 3 and len(hot) == 500


# The language model

def brute_model(texts):
    """Interpolated modified Kneser-Ney over trigrams, from the definition."""
    def grams(text):
        line = [kneser_ney.START] * 2 + kneser_ney.symbols(text).tolist()
        return [tuple(line[i:i + 3]) for i in range(len(line) - 2)]

    three = Counter(g for text in texts for g in grams(text))
    two = Counter((b, c) for _, b, c in three)
    one = Counter(c for _, c in two)
    levels = [Counter({(c,): n for c, n in one.items()}), two, three]

    def discounts(counts):
        n = [0] + [sum(v == k for v in counts.values()) for k in (1, 2, 3, 4)]
        out = []
        for k in (1, 2, 3):
            if n[1] and n[2] and n[k]:
                y = n[1] / (n[1] + 2 * n[2])
                out.append(max(kneser_ney.LEAST_DISCOUNT, min(k, k - (k + 1) * y * n[k + 1] / n[k])))
            else:
                out.append(0.5 * k)
        return out

    d = [discounts(counts) for counts in levels]

    def probability(gram):
        if not gram:
            return 1 / (len(one) + 1)
        order = len(gram) - 1
        own = {g: n for g, n in levels[order].items() if g[:-1] == gram[:-1]}
        lower = probability(gram[1:])
        if not own:
            return lower
        cut = {g: min(n, d[order][min(n, 3) - 1]) for g, n in own.items()}
        free = sum(cut.values())
        mine = own.get(gram, 0)
        return (max(mine - d[order][min(mine, 3) - 1], 0) * (mine > 0) + free * lower) / sum(own.values())

    return grams, probability


def test_perplexity(docs):
    rows = [(i, t) for i, t in enumerate(["abra cadabra", "abba baba ab", "cab bac cabba", "zz zz zz q", "", None, "ab ab ab", "dabra ✓"])]
    table = docs(rows).withColumnRenamed("spans", "perplexity")
    trusted = table.filter("doc_id < 3").select("doc_id", "n_words")
    grams, probability = brute_model([t for i, t in rows if i < 3])
    for r in kneser_ney.classify_quality(table, trusted, block_characters=20).collect():
        text = rows[r.doc_id][1] or ""
        if not text:
            assert r.perplexity is None and r.kept
            continue
        want = math.exp(-sum(math.log(probability(g)) for g in grams(text)) / len(grams(text)))
        assert math.isclose(r.perplexity, want, rel_tol=1e-9), (text, r.perplexity, want)
        assert r.kept == (r.perplexity <= r.threshold)


def test_probabilities_add_up():
    grams, probability = brute_model(["abra cadabra", "abba baba ab"])
    symbols = {g[2] for text in ("abra cadabra", "abba baba ab") for g in grams(text)}
    for context in [(97, 98), (98, 97), (7, 8)]:
        unknown = probability((*context, 9999))
        assert math.isclose(sum(probability((*context, c)) for c in symbols) + unknown, 1, rel_tol=1e-9)


def test_model_of_odd_tables(docs):
    table = docs([(1, "a b c"), (None, "d"), (1, "a b c"), (3, None)])
    nobody = table.limit(0).select("doc_id")
    assert all(r.kept and r.perplexity is None for r in kneser_ney.classify_quality(table, nobody).collect())
    assert kneser_ney.classify_quality(table.limit(0), table.select("doc_id")).count() == 0
    exchanged = kneser_ney.classify_quality(table, table.select("doc_id"), broadcast_bytes=0).collect()
    assert sorted(r.trusted for r in exchanged) == [False, True, True, True]


def test_held_out_accuracy(spark, tmp_path):
    """Trained on every second labelled document; judged on the others."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = kneser_ney.classify_quality(
        spark.read.parquet(f"{folder}/documents.parquet"), trusted_ids(spark, folder).filter("doc_id % 2 = 0"))
    rows = judged.join(labels, "doc_id").filter("doc_id % 2 = 1").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.93 and sum(bad) / len(bad) < 0.25


def test_rarity(docs):
    """The perplexity of the rarest trigrams alone, repeated ones counted."""
    rows = [(i, t) for i, t in enumerate(["abra cadabra", "abba baba ab", "cab bac cabba", "zz zz zz q", "", None, "ab", "abra zuz abba zuz abra"])]
    table = docs(rows).withColumnRenamed("spans", "perplexity")
    grams, probability = brute_model([t for i, t in rows if i < 3])
    for r in kneser_ney.classify_quality(table, table.filter("doc_id < 3").select("doc_id"), block_characters=20).collect():
        logp = sorted(math.log(probability(g)) for g in grams(rows[r.doc_id][1] or ""))[:kneser_ney.RAREST]
        assert (r.rarity is None and r.clean) if not logp else math.isclose(r.rarity, math.exp(-sum(logp) / len(logp)), rel_tol=1e-9)
        assert not logp or r.clean == (r.rarity <= r.rarity_threshold)


def test_held_out_toxic(spark):
    """Labelled good and toxic, told apart from good ones: the mean hardly shows them, the rarest trigrams most."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = kneser_ney.classify_quality(
        spark.read.parquet(f"{folder}/documents.parquet"), trusted_ids(spark, folder).filter("doc_id % 2 = 0"))
    rows = judged.join(labels, "doc_id").filter("doc_id % 2 = 1 AND quality = 1").collect()
    good, toxic = ([r for r in rows if r.toxic == t] for t in (0, 1))
    assert sum(r.clean for r in good) > 0.95 * len(good) and sum(r.clean for r in toxic) < 0.45 * len(toxic)


# Decontamination

def brute_leaks(docs, items, threshold=0.8):
    def grams(words, size):
        return [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]

    found = {}
    for key, text in items:
        words = (text or "").encode().lower().split()
        if not words:
            continue
        size = min(5, len(words))
        wanted, k = Counter(grams(words, size)), len(words) - size + 1
        for doc, body in docs:
            have = grams((body or "").encode().lower().split(), size)
            if not set(have) & set(wanted):
                continue
            best = 0.0
            for at in range(len(have) - k + 1):
                shared = sum((Counter(have[at:at + k]) & wanted).values())
                best = max(best, shared / (2 * k - shared))
            if best >= threshold:
                found[doc, key] = max(best, found.get((doc, key), 0))
    return found


def test_leaks(spark, docs):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(20, 50)))) for i in range(12)]
    items += [(50, "one two three"), (51, None), (52, ""), (53, items[0][1]), (None, "null item " * 9)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 120)))) for i in range(40)]
    for i in range(60):
        passage = rng.choice(items[:12])[1].split()
        for _ in range(i % 3):
            passage[rng.choice([0, 1, -1, -2, len(passage) // 2])] = "new"
        rows.append((100 + i, " ".join([*rng.choices(words, k=5), *passage, *rng.choices(words, k=9)]).title()))
    rows += [(900, None), (901, ""), (902, "ONE two Three"), (902, "ONE two Three"), (None, "null item " * 9), (903, "one two four")]
    table = docs(rows).withColumnRenamed("spans", "similarity")
    bench = spark.createDataFrame([(*item, "q") for item in items], "item_id long, text string, n string")
    found = decontaminate.find_contamination(table, bench, radius=24).collect()
    got = {(r.doc_id, r.item_id): r.similarity for r in found}
    want = brute_leaks(rows, items)
    assert len(found) == len(got) and got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k]) for k in want)
    # With the production radius exact passages and nearly all changed ones are found.
    fewer = {(r.doc_id, r.item_id) for r in decontaminate.find_contamination(table, bench).collect()}
    assert fewer <= want.keys() and {k for k, v in want.items() if v == 1} <= fewer and len(fewer) >= 0.95 * len(want)
    assert decontaminate.find_contamination(table.limit(0), bench).count() == 0
    assert decontaminate.find_contamination(table, bench.limit(0)).count() == 0


def test_leaks_in_documents_shorter_than_the_item(spark, docs):
    """They are one window: truncated at either end or with words missing, but not inside longer documents."""
    def whole(body, item):
        one, other = (Counter(tuple(text.split()[i:i + 5]) for i in range(len(text.split()) - 4)) for text in (body, item))
        shared = sum((one & other).values())
        return shared / (one.total() + other.total() - shared)

    rng = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rng.choices(words, k=n))) for i, n in enumerate([33, 33, 40, 25, 60, 9])] + [(9, "again and again and " * 8)]
    rows = []
    for key, text in items:
        own = text.split()
        for cut in range(1, 14):
            rows += [(" ".join(own[:-cut])), (" ".join(own[cut:])), (" ".join(own[cut // 2:len(own) - cut // 2])), (" ".join(own[:7] + own[7 + cut:]))]
    # The same words as part of a longer document are judged by windows of the item's length.
    short = " ".join(items[0][1].split()[:-5])
    rows = [(i, text) for i, text in enumerate(rows)] + [(5000, short), (5001, short + " " + " ".join(rng.choices(words, k=20)))]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_contamination(
        docs(rows), spark.createDataFrame(items, "item_id long, text string"), radius=24).collect()}
    want = {(doc, key): whole(body, text) for doc, body in rows for key, text in items if len(body.split()) < len(text.split())}
    want = {k: v for k, v in want.items() if v >= 0.8} | {k: v for k, v in brute_leaks(rows, items).items()}
    assert got.keys() == want.keys() and all(math.isclose(r.similarity, want[k]) for k, r in got.items())
    assert len(want) > 50 and (5000, 0) in got and (5001, 0) not in got
    assert math.isclose(whole(" ".join(items[0][1].split()[:30]), items[0][1]), 26 / 29) and got[8, 0].start == 0 and got[8, 0].n_words == 33


def test_leak_query(spark):
    def rows(name, key):
        return [(r[key], r.text) for r in spark.read.parquet(f"{FOLDER}/{name}.parquet").collect()]

    got = {(r.doc_id, r.item_id) for r in QUERIES["op7_decontaminate"](spark, FOLDER).collect()}
    assert got == set(brute_leaks(rows("documents", "doc_id"), rows("benchmark", "item_id")))


# Pipeline

def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    whole = {r.doc_id: r for r in docs.collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "pii", "mix"]
    left = [docs]
    for _, stage in corpus_pipeline.STAGES:
        left.append(spark.createDataFrame(
            stage(spark, left[-1], FOLDER).collect(), stage(spark, left[-1].limit(0), FOLDER).schema))
    sets = [{r.doc_id for r in frame.collect()} for frame in left]
    assert all(later <= earlier for earlier, later in zip(sets, sets[1:]))
    assert all(frame.columns == docs.columns for frame in left[:-1])
    rejected = {r.doc_id for r in kneser_ney.classify_quality(docs, trusted_ids(spark, FOLDER)).filter("NOT accepted").collect()}
    assert sets[1] == set(whole) - rejected
    from test_dedup import brute_marks
    component = {key: least for key, _, least in brute_marks([(r.doc_id, r.text) for r in left[1].collect()])}
    assert sets[2] == {key for key, least in component.items() if key == least}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaks = brute_leaks([(r.doc_id, r.text) for r in left[2].collect()], bench)
    assert sets[3] == sets[2] - {key for key, _ in leaks} and sets[4] == sets[3]
    copies = defaultdict(list)
    for r in left[5].collect():
        copies[r.doc_id].append(r.mix_copy)
        assert r.n_chars == len(r.text)
    want = {r.doc_id: r.copies for r in mixing.mix_sources(left[4]).collect() if r.copies}
    assert {key: len(c) for key, c in copies.items()} == want and all(sorted(c) == list(range(1, len(c) + 1)) for c in copies.values())
    ran = Counter(r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert ran == Counter({key: len(c) for key, c in copies.items()})


def test_key_of_the_pseudonyms(spark):
    """A run's own key gives other pseudonyms, and the same ones each time."""
    docs = spark.createDataFrame([(1, "mail ann.lee@example.org now")], "doc_id long, text string")
    public = corpus_pipeline.pseudonymous(spark, docs, FOLDER).first().text
    spark.conf.set(corpus_pipeline.KEY_SETTING, "own")
    try:
        own = [corpus_pipeline.pseudonymous(spark, docs, FOLDER).first().text for _ in range(2)]
    finally:
        spark.conf.unset(corpus_pipeline.KEY_SETTING)
    assert own[0] == own[1] != public and "ann.lee" not in own[0] + public


def test_stages_on_odd_tables(spark, docs):
    table = docs([(1, "a b c"), (1, "a b c"), (None, None), (None, ""), (5, "ip 10.0.0.1 and more words")]).withColumnsRenamed(
        {"block": "mix_copy", "spans": "_rows"}).withColumn("n_chars", corpus_pipeline.F.length("text"))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, table.limit(0), FOLDER).count() == 0, name
        found = stage(spark, table, FOLDER)
        if name != "mix":
            assert found.columns == table.columns
        found.collect()
    once = corpus_pipeline.one_of_near_duplicates(spark, table, FOLDER).collect()
    assert sorted(str(r.doc_id) for r in once) == ["1", "5", "None", "None"]
