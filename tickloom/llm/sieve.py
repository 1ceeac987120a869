"""A bitmap over keys, to keep rows that can't match out of a shuffle.

``sieve`` sets one bit per key; ``may_hold`` keeps the rows whose bit is set, through a join with the words of the
bitmap, which may always be broadcast: it has 2**22 bits (65,536 words, 1 MB), or about 16 per key where
their number is given, 2**25 at most. It lets some other rows pass, so an exact join follows; with very many
keys it passes everything and costs a look-up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise

LEAST_WORDS, MOST_WORDS = 1 << 16, 1 << 19


@dataclass(frozen=True)
class Sieve:
    table: DataFrame
    words: int


def fresh(columns: list[str], *names: str) -> list[str]:
    """``names``, longer by as many underscores as it takes to be none of ``columns``."""
    taken, made = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        made.append(name)
    return made


def _place(words: int, *key: Column | str) -> tuple[Column, Column]:
    h = F.xxhash64(F.lit("sieve"), *key)
    return F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(words - 1)), h.bitwiseAND(F.lit(63)).cast("int")


def sieve(rows: DataFrame, *key: str, expected: int = 0) -> Sieve:
    """``expected`` is the number of different keys, where known."""
    words = min(MOST_WORDS, max(LEAST_WORDS, 1 << (expected // 4).bit_length()))
    word, bit = _place(words, *key)
    bits = rows.select(word.alias("sieve_word"), F.expr("1L").alias("one"), bit.alias("bit"))
    table = bits.groupBy("sieve_word").agg(F.bit_or(F.call_function("shiftleft", "one", "bit")).alias("sieve_bits"))
    return Sieve(materialise(table, "sieve"), words)


def _tested(rows: DataFrame, held: Sieve, how: str, *key: Column | str) -> tuple[DataFrame, Column]:
    """Rows joined with their word of the bitmap, and whether their bit is set."""
    # The rows keep their own columns, whatever their names.
    word, bit, bits = fresh(rows.columns, "sieve_word", "sieve_bit", "sieve_bits")
    at, place = _place(held.words, *key)
    table = held.table.withColumnsRenamed({"sieve_word": word, "sieve_bits": bits})
    tested = rows.withColumns({word: at, bit: place}).join(F.broadcast(table), word, how)
    return tested, F.coalesce(F.call_function("bit_get", bits, bit), F.lit(0)) == 1


def may_hold(rows: DataFrame, held: Sieve, *key: Column | str) -> DataFrame:
    tested, on = _tested(rows, held, "inner", *key)
    return tested.where(on).select(*rows.columns)


def holds(rows: DataFrame, held: Sieve, name: str, *key: Column | str) -> DataFrame:
    """All rows, with whether ``may_hold`` keeps them as the column ``name``."""
    tested, on = _tested(rows, held, "left", *key)
    return tested.withColumn(name, on).select(*rows.columns, name)


def may_not_hold(rows: DataFrame, held: Sieve, *key: Column | str) -> DataFrame:
    """The rows that ``may_hold`` leaves out."""
    tested, on = _tested(rows, held, "left", *key)
    return tested.where(~on).select(*rows.columns)
