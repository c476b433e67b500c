"""Repeated rows: flag the later ones by key, or drop exact copies.

Neither operator uses ``row_number`` over the key: a window sends a whole key
to one task, and one key may be a third of the feed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tamiz.operators.membership import key_filter
from tamiz.session import checkpointed

_FIRST, _COPIES, _SPREAD = "__first_seq", "__copies", "__spread"
_HOT_FIRST, _COLD_FIRST, _COLD_KEY = "__hot_first", "__cold_first", "__cold_key"
_POSSIBLE = "__possible"


@dataclass(frozen=True)
class RepeatLimits:
    """``broadcast_bytes``: largest key table sent to every executor.
    ``hot_rows``: a key with this many rows or more is never shuffled as a group.
    ``filter_bytes``: largest Bloom filter of keys sent to every executor."""

    broadcast_bytes: int = 32 << 20
    hot_rows: int = 1_000_000
    filter_bytes: int = 32 << 20


def repeated_keys(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """Keys seen more than once, with their first sequence and number of rows.

    Reads two columns; the count and minimum combine before the shuffle, so a
    hot key reaches its reducer as one small row per input task.  ``count(key)``
    is 0 for the NULL key, which therefore needs no filter of its own (one on
    the key would be pushed down and make Spark derive the key twice).
    """
    return (
        rows.groupBy(F.col(key).alias(_COLD_KEY))
        .agg(F.min(seq).alias(_FIRST), F.count(key).alias(_COPIES))
        .where(F.col(_COPIES) > 1)
    )


def _size_in_bytes(keys: DataFrame) -> int:
    width = F.octet_length(F.col(_COLD_KEY).cast("string")) + F.lit(32)
    return keys.agg(F.sum(width)).first()[0] or 0


def flag_repeats(
    rows: DataFrame,
    key: str,
    seq: str,
    flag: str = "is_repeat",
    limits: RepeatLimits = RepeatLimits(),
) -> DataFrame:
    """``rows`` plus a boolean: true on every row of a key but the first.

    "First" is the lowest ``seq`` (unique, deterministic).  A NULL key never
    repeats.  The key table holds repeated keys only and is materialised so its
    size can be measured:

    * small enough: broadcast, and the rows themselves are never shuffled;
    * too large: keys with ``hot_rows`` rows or more are broadcast (there are at
      most ``rows / hot_rows`` of them, and their size is checked as well); the
      rest are joined by shuffle, where no key can be hot any more.  Rows that
      need no match (NULL or hot key) are spread by their own hash, so they do
      not pile up in one partition.
    """
    keys = checkpointed(repeated_keys(rows, key, seq))
    if _size_in_bytes(keys) <= limits.broadcast_bytes:
        small = keys.select(F.col(_COLD_KEY), F.col(_FIRST).alias(_HOT_FIRST))
        joined = rows.join(
            F.broadcast(small), F.col(key) == F.col(_COLD_KEY), "left"
        ).drop(_COLD_KEY)
        first_seen = F.col(_HOT_FIRST)
    else:
        joined = _join_hot_and_cold(rows, keys, key, seq, limits)
        first_seen = F.coalesce(_HOT_FIRST, _COLD_FIRST)
    flagged = F.coalesce(F.col(seq) > first_seen, F.lit(False))
    return joined.select(*rows.columns, flagged.alias(flag))


def _join_hot_and_cold(
    rows: DataFrame, keys: DataFrame, key: str, seq: str, limits: RepeatLimits
) -> DataFrame:
    hot_rows = limits.hot_rows
    hot = keys.where(F.col(_COPIES) >= hot_rows)
    while _size_in_bytes(hot) > limits.broadcast_bytes:
        hot_rows *= 4
        hot = keys.where(F.col(_COPIES) >= hot_rows)
    hot = hot.select(F.col(_COLD_KEY).alias("__hot_key"), F.col(_FIRST).alias(_HOT_FIRST))
    cold = keys.where(F.col(_COPIES) < hot_rows).select(
        _COLD_KEY, F.col(_FIRST).alias(_COLD_FIRST), F.xxhash64(_COLD_KEY).alias("__cold_spread")
    )

    with_hot = rows.join(F.broadcast(hot), F.col(key) == F.col("__hot_key"), "left")
    settled = F.col(key).isNull() | F.col(_HOT_FIRST).isNotNull()
    # A second join column: the hash of the key where a match is looked for, of
    # the row where it is not.
    spread = with_hot.select(
        *rows.columns,
        _HOT_FIRST,
        F.when(~settled, F.col(key)).alias("__open_key"),
        F.when(settled, F.xxhash64(seq)).otherwise(F.xxhash64(key)).alias(_SPREAD),
    )
    return spread.join(
        cold,
        (F.col("__open_key") == F.col(_COLD_KEY)) & (F.col(_SPREAD) == F.col("__cold_spread")),
        "left",
    )


def drop_copies(
    rows: DataFrame,
    keys: Sequence[Column],
    seq: str,
    copies: str = "copies",
    limits: RepeatLimits = RepeatLimits(),
) -> DataFrame:
    """One row per key, the one with the lowest ``seq`` as it was spelled, and
    how many rows it stands for.

    A hash aggregate, whose copies combine on the map side, finds the keys of
    more than one row; a group of identical rows is one row per input task
    before the shuffle.  Only these keys are kept.  While their measured table
    is small it is broadcast and the rows stay where they are; a row whose key
    is not in it has no copies.  Beyond that a Bloom filter of these keys is
    broadcast, and only the rows that it lets through are shuffled.
    """
    names = [f"__key_{position}" for position in range(len(keys))]
    named = [key.alias(name) for key, name in zip(keys, names)]
    grouped = rows.groupBy(*named).agg(
        F.min(seq).alias(_FIRST), F.count(F.lit(1)).alias(_COPIES)
    )
    repeated = checkpointed(grouped.where(F.col(_COPIES) > 1))
    size, how_many = _key_size(repeated, names)
    same = [key.eqNullSafe(F.col(name)) for key, name in zip(keys, names)]
    first_or_only = F.col(_FIRST).isNull() | (F.col(seq) == F.col(_FIRST))
    copied = F.coalesce(_COPIES, F.lit(1).cast("bigint")).alias(copies)
    if size <= limits.broadcast_bytes:
        joined = rows.join(F.broadcast(repeated), same, "left")
        return joined.where(first_or_only).select(*rows.columns, copied)

    known = key_filter(repeated, F.xxhash64(*names), how_many, limits.filter_bytes)
    flagged = known.flag(rows, F.xxhash64(*keys), _POSSIBLE)
    alone = flagged.where(~F.col(_POSSIBLE)).select(*rows.columns, F.lit(1).cast("bigint").alias(copies))
    # Of a key with many rows all but the first go before anything is shuffled.
    hot = _hot_copies(repeated, names, limits)
    same_hot = [key.eqNullSafe(F.col(f"__hot{name}")) for key, name in zip(keys, names)]
    settled = F.col(_HOT_FIRST).isNull() | (F.col(seq) == F.col(_HOT_FIRST))
    possible = (
        flagged.where(_POSSIBLE).join(F.broadcast(hot), same_hot, "left").where(settled).select(*rows.columns)
    )
    joined = possible.join(repeated.hint("merge"), same, "left")
    return alone.unionByName(joined.where(first_or_only).select(*rows.columns, copied))


def _key_size(repeated: DataFrame, names: Sequence[str]) -> tuple[int, int]:
    """Bytes of a table of keys, and how many there are."""
    width = sum((F.coalesce(F.octet_length(F.col(n).cast("string")), F.lit(0)) for n in names), F.lit(48))
    size, how_many = repeated.agg(F.sum(width), F.count(F.lit(1))).first()
    return size or 0, how_many


def _hot_copies(repeated: DataFrame, names: Sequence[str], limits: RepeatLimits) -> DataFrame:
    """The keys with the most rows, as many as may be broadcast."""
    hot_rows = limits.hot_rows
    hot = repeated.where(F.col(_COPIES) >= hot_rows)
    while _key_size(hot, names)[0] > max(limits.broadcast_bytes, limits.filter_bytes):
        hot_rows *= 4
        hot = repeated.where(F.col(_COPIES) >= hot_rows)
    return hot.select(*[F.col(n).alias(f"__hot{n}") for n in names], F.col(_FIRST).alias(_HOT_FIRST))
