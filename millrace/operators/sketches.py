"""HyperLogLog distinct counts and hash quality, from seeded hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import leading_one, murmur3_32, register_bits, register_index


def register_updates(keys: DataFrame, key: str, registers: int, seed: int = 0) -> DataFrame:
    """Add ``h, j, r``: hash, register and rank of each key.

    The rank looks at all 32 bits, also at those which pick the register.
    """
    register_bits(registers)
    hashed = murmur3_32(keys, key, seed, "h")
    return hashed.withColumn("j", register_index(F.col("h"), registers)).withColumn(
        "r", leading_one(F.col("h")))


def hll_registers(keys: DataFrame, key: str, registers: int, seed: int = 0) -> DataFrame:
    """Highest rank per register that was reached: ``j, r``.

    Each task sends at most one row per register, however many keys it reads.
    """
    updates = register_updates(keys, key, registers, seed)
    return updates.groupBy("j").agg(F.max("r").alias("r"))


def hll_sketches(keys: DataFrame, key: str, by: str, registers: int, seed: int = 0) -> DataFrame:
    """Registers per group, such as a day or a language: ``by, j, r``.

    Store it, and append the sketches of later days: rows of the same group and register may repeat,
    ``merge_sketches`` brings them together.  The keys are not needed again.  Rows without a group are
    a group of their own.
    """
    updates = register_updates(keys.select(by, key), key, registers, seed)
    return updates.groupBy(by, "j").agg(F.max("r").alias("r"))


def merge_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches rolled up to the groups ``by``, or to one: the highest rank of each register."""
    return sketches.groupBy(*by, "j").agg(F.max("r").alias("r"))


def bias_correction(registers: int) -> float:
    # The published bias corrections of HyperLogLog.
    small = {16: 0.673, 32: 0.697, 64: 0.709}
    return small.get(registers, 0.7213 / (1 + 1.079 / registers))


def hll_estimate(reached: DataFrame, registers: int, *by: str) -> DataFrame:
    """Distinct keys estimated from ``j, r``: one row ``estimate``, or one for each group ``by``.

    Registers that are absent, or hold 0, count as empty.
    """
    register_bits(registers)
    m, space = float(registers), float(1 << 32)
    # A group of empty registers is a group.
    rank = F.when(F.col("r") > 0, F.col("r"))
    used = (reached.groupBy(*by) if by else reached).agg(
        F.count(rank).alias("filled"),
        F.coalesce(F.sum(F.pow(F.lit(2.0), -rank)), F.lit(0.0)).alias("harmonic"),
    )
    empty = F.lit(m) - F.col("filled")
    raw = F.lit(bias_correction(registers) * m * m) / (F.col("harmonic") + empty)
    few = F.lit(m) * F.log(F.lit(m) / F.nullif(F.col("empty"), F.lit(0.0)))
    many = F.lit(-space) * F.log(F.lit(1.0) - F.col("raw") / F.lit(space))
    chosen = (
        F.when((F.col("raw") <= 2.5 * m) & (F.col("empty") > 0), few)
        .when(F.col("raw") > space / 30, many)
        .otherwise(F.col("raw"))
    )
    return used.select(*by, raw.alias("raw"), empty.alias("empty")).select(*by, chosen.alias("estimate"))


def builtin_distinct(keys: DataFrame, key: str, relative_error: float = 0.02) -> DataFrame:
    """Spark's own HyperLogLog++ beside ours; another hash, so other numbers."""
    return keys.agg(F.approx_count_distinct(key, relative_error).alias("estimate"))


def hash_histogram(keys: DataFrame, key: str, buckets: int = 128, seed: int = 0) -> DataFrame:
    """Keys per value of the hash's low bits, empty buckets included: ``bucket, n``."""
    register_bits(buckets)
    hashed = murmur3_32(keys, key, seed, "h")
    filled = hashed.groupBy(
        F.col("h").bitwiseAND(F.lit(buckets - 1)).alias("bucket")
    ).agg(F.count(F.lit(1)).alias("n"))
    every = keys.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("bigint").alias("n"))
    return every.unionByName(filled).groupBy("bucket").agg(F.sum("n").alias("n"))


def hash_quality(histogram: DataFrame) -> DataFrame:
    """Spread of a histogram and the chance that two keys share a bucket.

    Pairs are counted in decimals: their number can pass 64 bits.
    """
    def pairs(n):
        wide = n.cast("decimal(19,0)")
        return wide * (wide - F.lit(1)) / F.lit(2)

    row = histogram.agg(
        F.sum("n").alias("keys"),
        F.avg("n").alias("mean"),
        F.stddev_pop("n").alias("deviation"),
        F.sum(pairs(F.col("n"))).cast("decimal(38,0)").alias("collisions"),
    )
    all_pairs = F.nullif(F.col("keys").cast("double") * (F.col("keys") - 1) / 2, F.lit(0.0))
    return row.withColumn("probability", F.col("collisions").cast("double") / all_pairs)
