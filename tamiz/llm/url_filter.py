"""URL filters: a blocked Bloom filter in front of an exact hash join.

Two kinds of entries are listed: canonical URLs, which block that URL alone, and
rules (a host with its subdomains, and a path prefix), of which the longest that
fits decides.  The keys of all entries fill a blocked Bloom filter: one hash
picks a block of 512 bits, the others the bits inside it, so a look-up touches
one cache line.  A URL's possible keys are tested against the filter in the
scan; only hits go to the exact join with the entries, which removes the false
ones.  URLs without a hit are never shuffled.

The filter has ``BITS_PER_KEY`` bits for each key but never more than
``FILTER_BYTES``, so what is broadcast is bounded; a longer list only lets more
false hits through to the join.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tamiz.llm.frames import broadcast_if_small, scratch_of

BITS_PER_KEY, FILTER_BYTES = 16, 32 << 20
BLOCK_WORDS = 8  # of 64 bits
PROBES = 6

ALLOW, BLOCK = "allow", "block"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or
    the end, A-Z lower-cased; '' for a null or without ``://``."""
    return F.coalesce(_lower(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host and path, without scheme, query and fragment; null without a host.
    A path of '/' and none are the same."""
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(path)))


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- the filter -----------------------------------------------------------------


def _places(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a key, and its bits inside (word * 64 + bit), from two hashes."""
    first, second = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    return F.pmod(first, F.lit(blocks)), [
        F.pmod(F.shiftright(second, 9 * n), F.lit(BLOCK_WORDS * 64)) for n in range(PROBES)
    ]


class BloomFilter:
    """Bits of a blocked Bloom filter, filled from and tested with Spark hashes."""

    def __init__(self, keys: DataFrame, key: str):
        count = keys.count()
        bits = min(max(1, count) * BITS_PER_KEY, FILTER_BYTES * 8)
        self.blocks = -(-bits // (BLOCK_WORDS * 64))
        block, places = _places(F.col(key), self.blocks)
        one = keys.select(block.alias("block"), F.array(*places).alias("places"))
        # Each word is the OR of its keys' bits, combined before the shuffle.
        words = [
            F.bit_or(
                F.aggregate(
                    F.filter("places", lambda p: F.floor(p / 64) == w),
                    F.lit(0).cast("bigint"),
                    lambda held, p: held.bitwiseOR(_bit(p)),
                )
            ).alias(f"w{w}")
            for w in range(BLOCK_WORDS)
        ]
        table = one.groupBy("block").agg(*words).toArrow()  # at most FILTER_BYTES
        self.words = np.zeros((self.blocks, BLOCK_WORDS), np.uint64)
        at = table["block"].to_numpy()
        for word in range(BLOCK_WORDS):
            self.words[at, word] = table[f"w{word}"].to_numpy().view(np.uint64)

    def test(self, spark: SparkSession):
        """A function of a key column: true for every listed key and a few others."""
        shared = spark.sparkContext.broadcast(self.words)

        def hit(block: pd.Series, second: pd.Series) -> pd.Series:
            words, block = shared.value, block.to_numpy()
            second, found = second.to_numpy(), np.ones(len(second), bool)
            for n in range(PROBES):
                place = (second >> (9 * n)) % (BLOCK_WORDS * 64)
                word = words[block, place >> 6]
                found &= ((word >> (place & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
            return pd.Series(found)

        hit = F.pandas_udf(hit, "boolean")
        blocks = self.blocks
        return lambda key: hit(F.pmod(F.xxhash64(key), F.lit(blocks)), F.xxhash64(key, F.lit(1)))


def _bit(place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(1 << n if n < 63 else -(1 << 63)) for n in range(64)]), (place % 64 + 1).cast("int"))


# -- judging URLs -----------------------------------------------------------------


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    listed: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``pages``.

    ``rules`` has (host, path, verdict): a rule fits a URL whose host is the
    rule's or ends with a dot and it, and whose path is the rule's path after a
    ``/`` or starts with it.  The longest rule decides, of equal ones that with
    the longer host, then block before allow.  Otherwise a URL is blocked if its
    canonical form is in ``listed`` (column ``url``; any spelling of it), else
    allowed.  Null URLs and those without ``://`` have no host, fit nothing and
    are allowed.  Null and repeated entries of either list change nothing.
    """
    spark, scratch = pages.sparkSession, scratch_of(pages)
    rule_keys = rules.where("host is not null and path is not null and host <> ''").select(
        _rule_key(F.col("host"), F.concat(F.lit("/"), F.col("path"))).alias("key"),
        F.concat(F.col("host"), F.lit("/"), F.col("path")).alias("rule"),
        "verdict",
        F.length("host").alias("host_length"),
        (F.length("path") + 1).alias("path_length"),
    )
    url_keys = listed.select(canonical(host_of(F.col("url")), path_of(F.col("url"))).alias("url"))
    url_keys = url_keys.where("url is not null").select(
        _url_key(F.col("url")).alias("key"), F.lit(None).cast("string").alias("rule"), F.lit(BLOCK).alias("verdict"),
        F.lit(0).alias("host_length"), F.lit(0).alias("path_length"),
    )
    entries = rule_keys.unionByName(url_keys).groupBy("key").agg(
        F.max("rule").alias("rule"), F.max("verdict").alias("verdict"),
        F.max("host_length").alias("host_length"), F.max("path_length").alias("path_length"),
    )
    entries = scratch.stage(entries, "entries")
    lengths = [r[0] for r in entries.where("rule is not null").select("path_length").distinct().collect()]
    hit = BloomFilter(entries, "key").test(spark)

    judged = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    judged = judged.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = scratch.stage(judged.withColumn("row", F.monotonically_increasing_id()), "urls")
    keys = judged.where("host <> ''").select("row", F.explode(_possible_keys(lengths)).alias("key"))
    hits = scratch.stage(keys.where(hit(F.col("key"))), "hits")
    exact = hits.join(broadcast_if_small(entries, 512), "key")
    # Rules before listed URLs; a row has as many hits as rules fit it.
    rank = F.struct(F.col("rule").isNotNull(), F.length("rule"), "host_length", "verdict")
    best = exact.groupBy("row").agg(F.max_by(F.struct("rule", "verdict"), rank).alias("best"))
    return judged.join(best, "row", "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(ALLOW)).alias("verdict"),
    )


def _rule_key(host: Column, path: Column) -> Column:
    return F.concat(F.lit("r "), host, F.lit(" "), path)


def _url_key(url: Column) -> Column:
    return F.concat(F.lit("u "), url)


def _possible_keys(lengths: list[int]) -> Column:
    """Keys that could be listed for a row's (host, path): its canonical URL, and
    its host and the hosts above it with the path cut to each length of a rule's."""
    labels = F.split("host", r"\.", -1)
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.concat_ws(".", F.slice(labels, n, F.size(labels) - n + 1)),
    )
    starts = F.filter(
        F.array(*[F.when(F.length("path") >= n, F.left(F.col("path"), F.lit(n))) for n in sorted(lengths)])
        .cast("array<string>"),
        lambda start: start.isNotNull(),
    )
    pairs = F.flatten(F.transform(above, lambda h: F.transform(starts, lambda p: _rule_key(h, p))))
    return F.array_distinct(F.concat(F.array(_url_key(canonical(F.col("host"), F.col("path")))), pairs))
