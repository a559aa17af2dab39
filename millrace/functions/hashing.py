"""Seeded 32-bit murmur3 of a column, without leaving generated code.

Spark's ``hash`` is murmur3 too, but with the fixed seed 42, with its own rule for
the last one to three bytes, and signed.  Each of the three can be mended:

* ``hash(a, b)`` uses the hash of ``a`` as seed for ``b``.  Hashing one integer is a
  bijection, so for every seed there is one integer ``a`` that yields it.
* Padded with zeros to a multiple of four bytes, a key has no last bytes left, and
  the padding does not change the word that the standard makes of them.
* The final mixing is a bijection as well.  Undoing it gives the state after the
  padded word; taking back the part of the step which the standard leaves out for
  a last word, and mixing anew with the true length, gives the standard result.

All of it is integer arithmetic on one ``bigint`` column.  The steps are separate
projections so that no operand is written out twice in the plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASK = 0xFFFFFFFF

# The constants of 32-bit murmur3.
WORD_FACTOR_1 = 0xCC9E2D51
WORD_FACTOR_2 = 0x1B873593
WORD_ROTATION = 15
STATE_ROTATION = 13
STATE_FACTOR = 5
STATE_TERM = 0xE6546B64
FINAL_FACTOR_1 = 0x85EBCA6B
FINAL_FACTOR_2 = 0xC2B2AE35

SPARK_SEED = 42


def _inverse(odd: int) -> int:
    return pow(odd, -1, MASK + 1)


def _chained_integer(seed: int) -> int:
    """The integer whose Spark hash, as an unsigned number, is ``seed``."""
    def turn_right(x: int, by: int) -> int:
        return ((x >> by) | (x << (32 - by))) & MASK

    x = seed ^ (seed >> 16)
    x = x * _inverse(FINAL_FACTOR_2) & MASK
    x ^= (x >> 13) ^ (x >> 26)
    x = x * _inverse(FINAL_FACTOR_1) & MASK
    x ^= (x >> 16) ^ 4
    x = turn_right((x - STATE_TERM) * _inverse(STATE_FACTOR) & MASK, STATE_ROTATION)
    x = (x ^ SPARK_SEED) * _inverse(WORD_FACTOR_2) & MASK
    x = turn_right(x, WORD_ROTATION) * _inverse(WORD_FACTOR_1) & MASK
    return x - (1 << 32) if x >> 31 else x


def _times(x: Column, factor: int) -> Column:
    """x * factor modulo 2**32; in two halves, since the product can pass 2**63."""
    high = F.shiftleft((x * F.lit(factor >> 16)).bitwiseAND(F.lit(0xFFFF)), 16)
    return (x * F.lit(factor & 0xFFFF) + high).bitwiseAND(F.lit(MASK))


def _fold(x: Column, *shifts: int) -> Column:
    folded = x
    for shift in shifts:
        folded = folded.bitwiseXOR(F.shiftright(x, shift))
    return folded


def murmur3_32(df: DataFrame, key: str, seed: int = 0, out: str = "h") -> DataFrame:
    """Add the unsigned 32-bit murmur3 of a string or binary column as a ``bigint``.

    The seed is taken modulo 2**32.  A null key gives null.
    """
    raw, size, gap, state = (f"__{out}_{part}" for part in ("raw", "size", "gap", "state"))
    x, n, pad = F.col(state), F.col(size), F.col(gap)

    df = df.withColumn(raw, F.col(key).cast("binary"))
    df = df.withColumn(size, F.octet_length(raw).cast("bigint"))
    df = df.withColumn(gap, F.pmod(-n, F.lit(4).cast("bigint")))
    zeros = F.substring(F.lit(bytes(3)), F.lit(1), pad.cast("int"))
    chained = F.hash(F.lit(_chained_integer(seed & MASK)), F.concat(F.col(raw), zeros))
    df = df.withColumn(state, chained.cast("bigint").bitwiseAND(F.lit(MASK))).drop(raw)

    def rotated_back(y: Column) -> Column:
        turned = F.shiftright(y, STATE_ROTATION).bitwiseOR(F.shiftleft(y, 32 - STATE_ROTATION))
        return turned.bitwiseAND(F.lit(MASK))

    undo_final: list[Callable[[Column], Column]] = [
        lambda y: _fold(y, 16),
        lambda y: _times(y, _inverse(FINAL_FACTOR_2)),
        lambda y: _fold(y, 13, 26),
        lambda y: _times(y, _inverse(FINAL_FACTOR_1)),
        lambda y: _fold(y, 16).bitwiseXOR(n + pad),
    ]
    undo_last_word: list[Callable[[Column], Column]] = [
        lambda y: F.when(pad == 0, y).otherwise((y + F.lit(MASK + 1 - STATE_TERM)).bitwiseAND(F.lit(MASK))),
        lambda y: F.when(pad == 0, y).otherwise(_times(y, _inverse(STATE_FACTOR))),
        lambda y: F.when(pad == 0, y).otherwise(rotated_back(y)).bitwiseXOR(n),
    ]
    final: list[Callable[[Column], Column]] = [
        lambda y: _fold(y, 16),
        lambda y: _times(y, FINAL_FACTOR_1),
        lambda y: _fold(y, 13),
        lambda y: _times(y, FINAL_FACTOR_2),
        lambda y: _fold(y, 16),
    ]
    for step in undo_final + undo_last_word + final:
        df = df.withColumn(state, step(x))
    return df.withColumn(out, x).drop(size, gap, state)


def leading_one(h: Column) -> Column:
    """1-based position, from the left, of the first 1 in 32 bits; 0 for zero.

    Half a unit is added before the logarithm so that exact powers of two cannot
    fall to the wrong side by rounding.
    """
    return F.when(h == 0, F.lit(0)).otherwise(
        F.lit(32) - F.floor(F.log2(h + F.lit(0.5)))
    ).cast("int")


def register_bits(registers: int) -> int:
    """log2 of the register count, which must be a positive power of two."""
    if registers <= 0 or registers & (registers - 1):
        raise ValueError(f"the number of registers must be a positive power of two, not {registers}")
    return registers.bit_length() - 1


def register_index(h: Column, registers: int) -> Column:
    """The low bits of the hash which pick the register."""
    register_bits(registers)
    return h.bitwiseAND(F.lit(registers - 1)).cast("int")
