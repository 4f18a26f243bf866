"""Reduction of a large table to the keys of a small one before it is shuffled."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bloom:
    """Size of a Bloom filter: `1 << bits` bits, whatever it is filled with, in words
    of 64. A key sets `hashes` bits of one word, so a test reads one number. At 8
    bits a key, about one key in twenty passes in error."""

    bits: int = 23
    hashes: int = 3

    @property
    def words(self) -> int:
        return 1 << max(self.bits - 6, 0)

    def word(self, key: str | Column) -> Column:
        return F.xxhash64(key).bitwiseAND(F.lit(self.words - 1)).cast("int")

    def mask(self, key: str | Column) -> Column:
        """The bits of a key within its word."""
        drawn = F.xxhash64(key, F.lit(1))
        ones = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(drawn, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(self.hashes)]
        return reduce(Column.bitwiseOR, ones)


def key_filter(keys: DataFrame, column: str, bloom: Bloom = Bloom()) -> Callable[[str | Column], Column]:
    """A test that every key of the column passes, and few others do.

    The filter is one array of fixed size, or-ed together from the tasks and read
    as a scalar subquery, so it is there before the table that it reduces is
    scanned. A NULL passes nothing. Keys must be equal as bytes.
    """
    spark, known = keys.sparkSession, keys.where(F.col(column).isNotNull())
    set_ = known.groupBy(bloom.word(column).cast("long").alias("id")).agg(F.bit_or(bloom.mask(column)).alias("word"))
    every = spark.range(0, bloom.words, 1, 1).join(set_, "id", "left").select("id", F.coalesce("word", F.lit(0)).alias("word"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("id", "word"))), lambda x: x["word"])
    words = every.agg(ordered.alias("words")).scalar()

    def may_hold(key: str | Column) -> Column:
        mask = bloom.mask(key)
        return (F.get(words, bloom.word(key)).bitwiseAND(mask) == mask) & (F.col(key) if isinstance(key, str) else key).isNotNull()

    return may_hold
