"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tamiz.llm.bpe import decode_ids, encode_texts
from tamiz.llm.decontaminate import mark_overlaps
from tamiz.llm.frames import scratch_of
from tamiz.llm.hard_negatives import hard_negatives
from tamiz.llm.jaccard_join import jaccard_components
from tamiz.llm.language_id import LanguageModel, fit_languages, predict_languages
from tamiz.llm.lattice_lm import lattice_scores, read_pieces
from tamiz.llm.period_runs import periodic_runs
from tamiz.llm.projection_forest import near_embeddings
from tamiz.llm.token_counts import count_tokens
from tamiz.llm.token_shards import read_documents, write_shards
from tamiz.llm.toxicity import OrdinalModel, fit_toxicity, score_toxicity
from tamiz.llm.url_filter import ALLOW, BLOCK, judge_urls
from tamiz.llm.warc import ID_PREFIX, PAYLOAD_LENGTH, read_warc, write_warc

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 1024
#: Ends every document in the token files.
END_ID = 2
#: (host, path, verdict); the longest that fits decides.
URL_RULES = (
    ("org", "", ALLOW),
    ("example.org", "es/", BLOCK),
    ("example.org", "en/1", BLOCK),
    ("com", "fr/", ALLOW),
    ("com", "de/", BLOCK),
)
#: Pages whose id is divisible by this are the listed ones.
LISTED_EVERY = 10
#: A text is rejected as toxic from this probability of a grade above 0 on.
TOXIC_FROM = 0.5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, folds: int) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % folds


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(decode_ids(encode_texts(documents, WORD_BPE).drop("text"), WORD_BPE))


def digests(decoded: DataFrame) -> DataFrame:
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def toxicity_model(docs: DataFrame, labels: DataFrame) -> OrdinalModel:
    """Grades from the two labels: 0 not toxic, 1 toxic, 2 toxic and of low quality."""
    grade = F.when(F.col("toxic") == 0, 0).when(F.col("quality") == 0, 2).when(F.col("toxic") == 1, 1)
    return fit_toxicity(docs, labels.select("doc_id", grade.alias("grade")))


def toxicity_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(documents, table(spark, sf_dir, "labels"))
    return score_toxicity(documents, model).select(
        "doc_id", "severity", "p_toxic", (F.col("p_toxic") >= TOXIC_FROM).alias("is_toxic")
    )


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return lattice_scores(documents, read_pieces(PIECES), fold("doc_id", 7) != 2)


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no list of URLs, so the URLs of every tenth page are the
    listed ones; the list grows with the table."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(pages, rules, pages.where(F.col("page_id") % LISTED_EVERY == 0).select("url"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts with a cache of its own, so every distinct content is a miss once."""
    documents = table(spark, sf_dir, "documents")
    counted = count_tokens(documents, BYTE_BPE, scratch_of(documents).path("token_counts"))
    return counted.select("*", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def language_model(docs: DataFrame) -> LanguageModel:
    learning = docs.where(fold("doc_id", 4) != 2)
    return fit_languages(learning, "text", "lang", F.xxhash64("doc_id"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language_model(documents)
    return predict_languages(documents, model, keep=("doc_id",)).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def embedding_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"))


def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archives = scratch_of(pages).path("archives")
    write_warc(pages, archives)
    records = read_warc(spark, archives).where("problem is null")
    header = lambda name: F.col("headers")[name]
    page = lambda name: F.regexp_extract(header(name), f"<{ID_PREFIX}(-?[0-9]+)>", 1).try_cast("bigint")
    kind = header("WARC-Type")
    return records.select(
        page("WARC-Record-ID").alias("page_id"),
        F.when(kind == "response", F.octet_length("payload").cast("bigint"))
        .otherwise(header(PAYLOAD_LENGTH).cast("bigint"))
        .alias("payload_bytes"),
        F.substring_index(header("WARC-Payload-Digest"), ":", -1).alias("payload_digest"),
        kind.alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
    )


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = mark_overlaps(documents, table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        (F.size("overlaps") > 0).alias("contaminated"),
        F.col("overlaps.item_id").alias("item_ids"),
        F.col("overlaps.matched").alias("matched_words"),
    )


def hard_negative_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row has a label that is not its own; components are whole 256ths."""
    embeddings = table(spark, sf_dir, "embeddings")
    component = lambda x: x.cast("double")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(component(x)) < float("inf")))
    rows = embeddings.where(finite).select(
        "vec_id",
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: F.floor(F.lit(256.0) * component(x))).alias("vector"),
    )
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


def with_planted_periods(documents: DataFrame) -> DataFrame:
    """Texts whose id has a checksum divisible by 10 repeat themselves from one of
    their words on; the other texts are as they are."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(checksum / 10)
    words = F.when(checksum % 10 == 0, F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1)))
    split = documents.select("doc_id", "text", words.alias("words"), g.alias("g"))
    split = split.withColumn("n", F.coalesce(F.size("words"), F.lit(0)))
    split = split.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    split = split.withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8)))
    repeated = F.expr(
        "array_join(transform(words, (w, i) -> if(i < a, w, words[int(a + (i - a) % p)])), ' ')"
    )
    return split.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def periodic_run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = with_planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs(documents)
    better = F.expr(
        "array_sort(runs, (x, y) -> case when x.length * y.period > y.length * x.period then -1"
        " when x.length * y.period < y.length * x.period then 1"
        " when x.start <> y.start then int(sign(x.start - y.start)) else int(sign(x.period - y.period)) end)"
    )
    best = F.try_element_at(better, F.lit(1))
    lines = F.expr(
        "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best.alias("best"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def token_shard_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    folder = scratch_of(documents).path("shards")
    write_shards(documents, folder, BYTE_BPE, end_id=END_ID)
    return read_documents(spark, folder).select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_round_trip": bpe_round_trip,
    "op2_toxicity_severity": toxicity_severity,
    "op3_lattice_lm": lm_scores,
    "op4_ngram_jaccard_join": ngram_jaccard_join,
    "op5_url_filter": url_filter,
    "op6_token_counts": token_counts,
    "op7_language_id": language_id,
    "op8_embedding_near_copies": embedding_near_copies,
    "op9_warc_round_trip": warc_round_trip,
    "op10_benchmark_decontamination": benchmark_decontamination,
    "op11_hard_negatives": hard_negative_rows,
    "op12_periodic_runs": periodic_run_rows,
    "op13_token_shards": token_shard_round_trip,
}
