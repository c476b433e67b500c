"""A Bloom filter of keys as a small table, tested by column expressions.

The filter is cut into buckets of ``WORDS`` words of 64 bits.  A key belongs to
one bucket and sets one bit in each word, so testing a row is one look into a
broadcast table and a few bit operations, all in generated code.  A key that was
put in is always found; another one is found by chance, about one in a hundred
at ``BITS_PER_KEY`` and more where the filter may not be as large as it would like.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tamiz.session import checkpointed

WORDS, BITS_PER_KEY = 8, 12
#: Of a bucket in a broadcast table: its words, its number, and what holds them.
BUCKET_BYTES = 8 * (WORDS + 1) + 48
_BUCKET, _WORD = "__bucket", "__word_"


def _masks(hashed: Column) -> list[Column]:
    """The bit that a key sets in each word: six bits of a second hash tell which."""
    spread, one = F.xxhash64(hashed, F.lit(WORDS)), F.lit(1).cast("bigint")
    place = lambda word: F.shiftrightunsigned(spread, 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return [F.call_function("shiftleft", one, place(word)) for word in range(WORDS)]


@dataclass(frozen=True)
class KeyFilter:
    """``table`` has a row for each bucket that holds a key, ``buckets`` at most."""

    table: DataFrame
    buckets: int

    def flag(self, rows: DataFrame, hashed: Column, flag: str) -> DataFrame:
        """``rows`` plus a boolean: false where the key of ``hashed`` is surely not in
        the filter.  No row is shuffled."""
        words = [F.col(f"{_WORD}{word}") for word in range(WORDS)]
        held = [word.bitwiseAND(mask) != 0 for word, mask in zip(words, _masks(hashed))]
        joined = rows.join(F.broadcast(self.table), F.pmod(hashed, F.lit(self.buckets)) == F.col(_BUCKET), "left")
        possible = F.coalesce(reduce(Column.__and__, held), F.lit(False))
        return joined.select(*rows.columns, possible.alias(flag))


def key_filter(keys: DataFrame, hashed: Column, how_many: int, most_bytes: int) -> KeyFilter:
    """The filter of ``how_many`` keys, of which ``hashed`` is a hash of 64 bits; its
    table is never larger than ``most_bytes``, or one bucket.  Bits combine before
    the shuffle, so a bucket is one row per task."""
    wanted = math.ceil(how_many * BITS_PER_KEY / (64 * WORDS))
    buckets = max(1, min(wanted, most_bytes // BUCKET_BYTES))
    bits = [mask.alias(f"{_WORD}{word}") for word, mask in enumerate(_masks(hashed))]
    table = (
        keys.select(F.pmod(hashed, F.lit(buckets)).alias(_BUCKET), *bits)
        .groupBy(_BUCKET)
        .agg(*[F.bit_or(f"{_WORD}{word}").alias(f"{_WORD}{word}") for word in range(WORDS)])
    )
    return KeyFilter(checkpointed(table), buckets)
