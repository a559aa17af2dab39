from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from millrace.functions.hashing import leading_one, murmur3_32, register_bits
from millrace.operators import sketches
from millrace.plans.reports import distinct_words


def plain_murmur3(key: bytes, seed: int) -> int:
    """The published algorithm, one key at a time."""
    def turn(x, by):
        return (x << by | x >> 32 - by) % 2**32

    def scramble(word):
        return turn(word * 0xCC9E2D51 % 2**32, 15) * 0x1B873593 % 2**32

    whole = len(key) - len(key) % 4
    state = seed
    for at in range(0, whole, 4):
        state = (turn(state ^ scramble(int.from_bytes(key[at:at + 4], "little")), 13) * 5 + 0xE6546B64) % 2**32
    state ^= scramble(int.from_bytes(key[whole:], "little")) ^ len(key)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        state = (state ^ state >> shift) * factor % 2**32
    return state ^ state >> 16


def hashes(spark, keys, seed):
    frame = spark.createDataFrame([(i, key) for i, key in enumerate(keys)], "i int, key string")
    return [row.h for row in murmur3_32(frame, "key", seed).orderBy("i").collect()]


def test_published_values(spark):
    assert hashes(spark, ["test", "hello"], 0) == [0xBA6BD213, 0x248BFA47]
    assert plain_murmur3(b"hello", 0) == 0x248BFA47


@pytest.mark.parametrize("seed", [0, 1, 42, 0x418B6C16, 0x7FFFFFFF, 0x80000000, 0xFFFFFFFF])
def test_any_seed_and_length(spark, seed):
    rng = random.Random(seed)
    keys = ["", "å", "\U0001f600", "\x00", "\x00\x00\x00\x00", "ÿÿÿ"]
    keys += ["".join(rng.choice("aZ9 é東") for _ in range(n)) for n in list(range(1, 40)) + [1000, 70001]]
    assert hashes(spark, keys, seed) == [plain_murmur3(key.encode(), seed) for key in keys]


def test_binary_keys_null_and_wide_seed(spark):
    frame = spark.createDataFrame([(bytearray(b"\xff\x80\x00\x7f\x81"),), (None,)], "key binary")
    got = [row.h for row in murmur3_32(frame, "key", 0xEE418B6C16).collect()]
    assert got == [plain_murmur3(b"\xff\x80\x00\x7f\x81", 0x418B6C16), None]


def test_hash_stays_in_generated_code(spark):
    keys = spark.range(10).select(F.col("id").cast("string").alias("key"))
    plan = murmur3_32(keys, "key")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and all(line.lstrip(" :+-").startswith("*(1)") for line in plan.strip().splitlines())


def test_leading_one_at_every_power_of_two(spark):
    values = sorted({0, 2**32 - 1} | {2**p + d for p in range(32) for d in (-1, 0, 1) if 0 <= 2**p + d < 2**32})
    frame = spark.createDataFrame([(v,) for v in values], "h long")
    for row in frame.select("h", leading_one(F.col("h")).alias("r")).collect():
        assert row.r == (33 - row.h.bit_length() if row.h else 0)


def test_register_and_rank_of_a_known_hash(spark):
    frame = spark.createDataFrame([(0x70FFEC73,)], "h long")
    from millrace.functions.hashing import register_index
    row = frame.select(register_index(F.col("h"), 1024), leading_one(F.col("h"))).first()
    assert tuple(row) == (115, 2)


@pytest.mark.parametrize("bad", [0, -4, 3, 1000])
def test_register_count_must_be_a_power_of_two(bad):
    with pytest.raises(ValueError):
        register_bits(bad)


def plain_estimate(ranks):
    m = len(ranks)
    bias = {16: 0.673, 32: 0.697, 64: 0.709}.get(m, 0.7213 / (1 + 1.079 / m))
    raw = bias * m * m / sum(2.0**-r for r in ranks)
    empty = ranks.count(0)
    if raw <= 2.5 * m and empty:
        return m * math.log(m / empty)
    return -(2**32) * math.log(1 - raw / 2**32) if raw > 2**32 / 30 else raw


@pytest.mark.parametrize("m, ranks", [
    (16, [0] * 16), (16, [1] + [0] * 15), (32, [3] * 32), (64, [4] * 63 + [0]), (128, [22] * 128), (16, [26] * 16),
])
def test_estimate_in_all_ranges(spark, m, ranks):
    reached = spark.createDataFrame([(j, r) for j, r in enumerate(ranks)], "j int, r int")
    want = plain_estimate(ranks)
    assert sketches.hll_estimate(reached, m).first().estimate == pytest.approx(want)
    assert sketches.hll_estimate(reached.filter("r > 0"), m).first().estimate == pytest.approx(want)


def test_distinct_words_end_to_end(spark):
    texts = [" ".join(f"w{(i * 7 + j) % 5000}" for j in range(50)) for i in range(1000)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    words = {w for t in texts for w in t.split()}
    ranks = [0] * 256
    for word in words:
        h = plain_murmur3(word.encode(), 7)
        ranks[h & 255] = max(ranks[h & 255], 33 - h.bit_length())
    got = distinct_words(docs, 256, 7).first().estimate
    assert got == pytest.approx(plain_estimate(ranks))
    assert got == pytest.approx(len(words), rel=0.25)
    assert distinct_words(docs.repartition(5), 256, 7).first().estimate == got


def test_distinct_words_of_nothing_and_of_one(spark):
    docs = spark.createDataFrame([("same same",)], "text string")
    assert distinct_words(docs.limit(0)).first().estimate == 0.0
    assert distinct_words(docs).first().estimate == pytest.approx(1.0, abs=0.01)


def test_builtin_estimate(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    assert sketches.builtin_distinct(keys, "key").first().estimate == pytest.approx(5000, rel=0.1)


def test_histogram_and_quality(spark):
    keys = [f"key{i}" for i in range(40)] + ["key0"]
    frame = spark.createDataFrame([(key,) for key in keys], "key string")
    filled = [0] * 128
    for key in keys:
        filled[plain_murmur3(key.encode(), 9) & 127] += 1
    histogram = sketches.hash_histogram(frame, "key", 128, 9)
    assert {row.bucket: row.n for row in histogram.collect()} == dict(enumerate(filled))
    row = sketches.hash_quality(histogram).first()
    pairs = sum(n * (n - 1) // 2 for n in filled)
    assert (row["keys"], int(row["collisions"])) == (41, pairs)
    assert row["mean"] == pytest.approx(41 / 128) and row["deviation"] == pytest.approx(statistics.pstdev(filled))
    assert row["probability"] == pytest.approx(pairs / (41 * 40 / 2))


def test_quality_of_huge_buckets_does_not_overflow(spark):
    histogram = spark.createDataFrame([(0, 10**13), (1, 10**13)], "bucket long, n long")
    row = sketches.hash_quality(histogram).first()
    assert int(row["collisions"]) == 10**13 * (10**13 - 1)
    assert row["probability"] == pytest.approx(0.5)


def test_stored_sketches_roll_up_to_the_whole(spark, tmp_path):
    """Per day, appended day by day with a day twice, and rolled up without the keys."""
    keys = spark.range(6000).selectExpr("concat('k', id % 2500) AS word", "concat('d', id % 7) AS day", "id")
    for part in (0, 1, 1):
        sketches.hll_sketches(keys.filter(F.col("id") % 2 == part), "word", "day", 256, 5).write.mode("append").parquet(f"{tmp_path}/s")
    stored = spark.read.parquet(f"{tmp_path}/s")
    whole = sketches.hll_registers(keys, "word", 256, 5)
    rolled = sketches.merge_sketches(stored)
    assert sorted(map(tuple, rolled.collect())) == sorted(map(tuple, whole.collect()))
    assert sketches.hll_estimate(rolled, 256).first() == sketches.hll_estimate(whole, 256).first()
    days = {r.day: r.estimate for r in sketches.hll_estimate(sketches.merge_sketches(stored, "day"), 256, "day").collect()}
    for day in days:
        alone = sketches.hll_registers(keys.filter(F.col("day") == day), "word", 256, 5)
        assert days[day] == sketches.hll_estimate(alone, 256).first().estimate
    assert len(days) == 7
