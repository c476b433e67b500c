"""A corpus pipeline of five stages over ``documents``.

Each stage takes what its predecessor kept, decides about every row, and writes
its result as Parquet for the next one:

1. language ID: texts without a language (``und``) or with a posterior below
   ``LEAST_POSTERIOR`` go;
2. toxicity: texts with a probability of a grade above 0 from ``TOXIC_FROM`` go;
3. n-gram Jaccard join: of each group of near copies the smallest doc_id stays;
4. benchmark decontamination: texts that overlap a benchmark item go;
5. BPE: the kept texts' token ids, and the digests of ids and decoded text.

Models are fitted on the stage's own input.  Rows with null text have no
language and go first; repeated rows are one group of copies, of which one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tamiz.llm.bpe import encode_and_decode
from tamiz.llm.decontaminate import mark_overlaps
from tamiz.llm.frames import broadcast_if_small, scratch_of
from tamiz.llm.jaccard_join import jaccard_components
from tamiz.llm.language_id import UNKNOWN, predict_languages
from tamiz.llm.queries import TOXIC_FROM, WORD_BPE, digests, language_model, table, toxicity_model
from tamiz.llm.toxicity import score_toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_POSTERIOR = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = predict_languages(docs, language_model(docs), keep=COLUMNS)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_POSTERIOR)).select(*COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs.select(*COLUMNS), model).where(F.col("p_toxic") < TOXIC_FROM).select(*COLUMNS)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row with the smallest id stays; rows that
    repeat whole, id included, are kept once.  Rows without id all stay."""
    scratch = scratch_of(docs)
    docs = docs.select(*COLUMNS)
    counts = docs.where("doc_id is not null").groupBy("doc_id").count()
    repeated = scratch.stage(counts.where("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        groups = scratch.stage(jaccard_components(docs), "groups")
        dropped = scratch.stage(groups.where("doc_id <> component_id").select("doc_id"), "dropped")
        return docs.join(broadcast_if_small(dropped, 16), "doc_id", "left_anti").select(*COLUMNS)
    # An id may be that of several texts: rows are told apart by id and content.
    content = F.xxhash64(*COLUMNS, *[F.col(name).isNull() for name in COLUMNS])  # nulls alone are skipped
    rows = docs.withColumn("content", content)
    keyed = rows.select(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "content")).alias("key"), "text")
    groups = scratch.stage(jaccard_components(keyed, "key"), "groups")
    dropped = scratch.stage(groups.where("key <> component_id").select("key.*").distinct(), "dropped")
    kept = rows.join(broadcast_if_small(dropped, 24), ["doc_id", "content"], "left_anti")
    twice = broadcast_if_small(repeated, 16)
    once = kept.join(twice, "doc_id", "left_semi").dropDuplicates()
    return kept.join(twice, "doc_id", "left_anti").unionByName(once).select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked = mark_overlaps(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return marked.where(F.size("overlaps") == 0).select(*COLUMNS)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digests(encode_and_decode(docs.select("doc_id", "text"), WORD_BPE).select("doc_id", "bpe.*"))


STAGES = [
    ("language_id", language_stage),
    ("toxicity", toxicity_stage),
    ("ngram_jaccard_join", near_copies_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("bpe", bpe_stage),
]

#: SQL has no twin of the learned stages; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = scratch_of(docs)
    for name, stage in STAGES:
        docs = scratch.stage(stage(spark, docs, sf_dir), name)
    return docs
