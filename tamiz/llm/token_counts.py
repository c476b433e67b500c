"""Token counts through a digest cache.

The cache is a Parquet table of (content digest, tokenizer digest, n_tokens).
A run digests the normalised content of every text and the bytes of the
tokenizer file, looks the pairs up, encodes each distinct missing content once,
and appends the new counts.  Changing the tokenizer file changes its digest, so
old counts are never taken for new ones.

Normalising must not change the count: a null is an empty text, nothing else is
touched unless the caller passes an expression that the tokenizer ignores.

Copies are found on digests.  A text itself is shuffled only if it is the first
of its content and not in the cache, once, and spread by its own row number.

Missing contents are encoded by the encoder of ``token_shards``: the library sees
each word once in a while, not at each of its places, where the tokenizer file
allows to tell words apart exactly, and the whole text elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tamiz.llm.bpe import read_file
from tamiz.llm.frames import broadcast_if_small, scratch_of
from tamiz.llm.token_shards import SLICE_CHARS, encoder_of

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens bigint"
#: Largest table of missing digests that is sent to the texts; beyond it they are
#: joined by shuffle.
DIGEST_BYTES = 24 << 20


def _counted(file) -> Callable:
    """(content, n_tokens) as the library's own tokenizer counts them, nothing added or cut off."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(file.value)
        for batch in batches:
            counts, held, size = [], [], 0
            for text in batch.column("text"):
                held.append(text.as_py() or "")
                size += len(held[-1])
                if size >= SLICE_CHARS:
                    counts.append(encoder.encode(held)[1])
                    held, size = [], 0
            counts.append(encoder.encode(held)[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("content"), pa.array(np.concatenate(counts))], ["content", "n_tokens"]
            )
        pa.default_memory_pool().release_unused()

    return run


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalised: Column | None = None,
) -> DataFrame:
    """(id, n_bytes, n_tokens) for every row of ``docs``; ``cache_path`` is read,
    and the counts of contents that it lacks are appended.

    A null or empty text has 0 bytes and 0 tokens.  Repeated rows are counted
    from one encoding.  A cache that does not exist yet is an empty one; two runs
    that append the same content at once leave two equal rows, which are one.
    """
    spark, scratch = docs.sparkSession, scratch_of(docs)
    with open(tokenizer_path, "rb") as opened:
        version = hashlib.sha256(opened.read()).hexdigest()
    text = F.coalesce(F.col(text_col) if normalised is None else normalised, F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    content = F.unhex(F.sha2("text", 256))
    digests = scratch.stage(
        rows.select("id", F.octet_length("text").cast("bigint").alias("n_bytes"), content.alias("content")), "digests"
    )

    known = _read_cache(spark, cache_path).where(F.col("tokenizer") == version)
    known = known.groupBy("content").agg(F.min("n_tokens").alias("n_tokens"))
    contents = digests.groupBy("content").agg(F.count(F.lit(1)).alias("rows"))
    missing = scratch.stage(contents.join(known, "content", "left_anti"), "missing")
    fresh = _first_texts(rows.select("text", content.alias("content")), missing, scratch)
    counted = fresh.mapInArrow(_counted(read_file(spark, tokenizer_path)), "content binary, n_tokens bigint")
    counted = scratch.stage(counted, "counted")
    counted.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)

    # The counts this run needs: those it made, and those of the cache that it met.
    met = known.join(contents.join(missing, "content", "left_anti"), "content", "left_semi")
    needed = scratch.stage(counted.groupBy("content").agg(F.min("n_tokens").alias("n_tokens")).unionByName(met), "needed")
    found = digests.join(needed, "content")
    return found.select(F.col("id").alias(id_col), "n_bytes", "n_tokens")


def _read_cache(spark, path: str) -> DataFrame:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def _first_texts(rows: DataFrame, missing: DataFrame, scratch) -> DataFrame:
    """Each missing content once with its text.

    Contents of one row are found where they are read.  Of those with copies one
    text per reading task is passed on (the first of a content, combined before
    the shuffle), so a group of copies of any size is a few rows.
    """
    missing = missing.select("content", (F.col("rows") > 1).alias("copied"))
    marked = rows.join(broadcast_if_small(missing, 48, DIGEST_BYTES), "content")
    single = marked.where("not copied").select("content", "text")
    copied = marked.where("copied").groupBy("content").agg(F.first("text").alias("text"))
    return single.unionByName(copied)
