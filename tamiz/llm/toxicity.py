"""Toxicity as a severity grade: cumulative-link ordinal regression.

One weight vector serves all thresholds: the odds that a text's grade is above
k are ``exp(w.x - t_k)`` with ``t_0 <= t_1 <= ...``.  The output is the expected
grade, the sum of ``P(grade > k)`` over the thresholds.

Features are sparse: the words of a text (runs of letters and digits, A-Z
lower-cased) and the first ``PREFIX_BYTES`` bytes of longer ones, each with the
logarithm of its rate in the text, whole words with ``PRESENCE`` more.  Of the features of the training texts, the
``FEATURES`` that tell grade 0 from the others best are kept.

The model is fitted on about ``TRAIN_DOCS`` labelled texts at most for each
grade, drawn by a hash of the id and weighted back to the grades' true shares.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tamiz.llm.frames import forget_in_worker, scratch_of, ship_package
from tamiz.llm.words import NOT_ALPHANUMERIC, HashTable, hashes_of, mixed, text_slices, word_spans

TRAIN_DOCS = 3000
FEATURES, LEAST_DOCS = 4096, 4
PREFIX_BYTES = (5, 7)
#: What a whole word adds to its feature however long the text is.
PRESENCE = 0.5
#: Fitting: penalty on the squared weights, steps, step size.
PENALTY, STEPS, RATE = 1e-4, 300, 0.1

_U = np.uint64


def text_features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct features and their values."""
    for _, data, offsets in text_slices(column):
        starts, ends = word_spans(data, offsets, NOT_ALPHANUMERIC)
        begins = np.searchsorted(starts, offsets)
        begins[-1] = len(starts)
        kinds = [hashes_of(data, starts, ends)]
        for size in PREFIX_BYTES:
            longer = ends - starts > size
            prefix = np.zeros(len(starts), _U)
            prefix[longer] = mixed(hashes_of(data, starts[longer], starts[longer] + size) + _U(size))
            kinds.append(prefix)
        for begin, end in zip(begins[:-1], begins[1:]):
            words, times = np.unique(kinds[0][begin:end], return_counts=True)
            cut = np.concatenate([kind[begin:end] for kind in kinds[1:]])
            cut, cut_times = np.unique(cut[cut != 0], return_counts=True)
            rate = np.concatenate([times, cut_times]) / max(1, end - begin)
            value = np.log1p(100 * rate)
            value[: len(words)] += PRESENCE
            yield np.concatenate([words, cut]), value


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = list(text_features(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("grade"),
                pa.array([keys.view(np.int64) for keys, _ in found], pa.list_(pa.int64())),
                pa.array([values for _, values in found], pa.list_(pa.float64())),
            ],
            ["grade", "keys", "vals"],
        )


@dataclass
class OrdinalModel:
    """Features (hashes), their weights, and the thresholds between grades."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for every score and threshold."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -40, 40)))


def fit_ordinal(
    rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, weight: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by gradient steps (Adam) on the penalised
    likelihood; ``rows`` hold (feature numbers, values).  Thresholds are a first
    one plus positive gaps, so they stay in order."""
    levels = int(grades.max()) if len(grades) else 0
    if not levels:
        return np.zeros(size), np.empty(0)
    at = np.concatenate([r[0] for r in rows]).astype(np.int64)
    value = np.concatenate([r[1] for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    above = grades[:, None] > np.arange(levels)
    share = (weight[:, None] * above).sum(axis=0) / weight.sum()
    first = -np.log(share[0] / (1 - share[0]) + 1e-9)
    state = np.concatenate([np.zeros(size), [first], np.zeros(levels - 1)])
    mean, square = np.zeros_like(state), np.zeros_like(state)
    weight = weight / weight.sum()
    for step in range(1, STEPS + 1):
        w, gaps = state[:size], np.exp(state[size + 1 :])
        thresholds = state[size] + np.concatenate([[0], np.cumsum(gaps)])
        score = np.bincount(owner, w[at] * value, len(rows))
        upper = 1 / (1 + np.exp(-np.clip(score[:, None] - thresholds, -40, 40)))
        # P(grade = g) = P(> g - 1) - P(> g)
        bounds = np.concatenate([np.ones((len(rows), 1)), upper, np.zeros((len(rows), 1))], axis=1)
        slope = bounds * (1 - bounds)
        one = np.arange(len(rows))
        chance = np.maximum(bounds[one, grades] - bounds[one, grades + 1], 1e-12)
        pull = weight * (slope[one, grades] - slope[one, grades + 1]) / chance
        by_threshold = np.zeros((len(rows), levels + 2))
        by_threshold[one, grades] -= weight * slope[one, grades] / chance
        by_threshold[one, grades + 1] += weight * slope[one, grades + 1] / chance
        by_threshold = by_threshold[:, 1:-1].sum(axis=0)
        gradient = np.empty_like(state)
        gradient[:size] = np.bincount(at, pull[owner] * value, size) - PENALTY * w
        gradient[size] = by_threshold.sum()
        for gap in range(levels - 1):
            gradient[size + 1 + gap] = by_threshold[gap + 1 :].sum() * gaps[gap]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        state += RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    gaps = np.exp(state[size + 1 :])
    return state[:size], state[size] + np.concatenate([[0], np.cumsum(gaps)])


def _of_known(shared) -> Callable:
    """(grade, at, val): numbers and values of the features that are in the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = HashTable(shared.value)
        for batch in batches:
            at, value = [], []
            for keys, values in zip(batch.column("keys"), batch.column("vals")):
                found = table.find(keys.values.to_numpy().view(_U))
                at.append(found[found >= 0])
                value.append(values.values.to_numpy()[found >= 0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade"), pa.array(at, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float64()))],
                ["grade", "at", "val"],
            )

    return run


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    grade_col: str = "grade",
    train_docs: int = TRAIN_DOCS,
) -> OrdinalModel:
    """The model from the texts whose id has a grade (0, 1, 2, ...) in ``labels``.

    Rows without id, text or grade teach nothing; without grades of both kinds,
    0 and above, every text is expected 0.  The drawn ids, about ``train_docs``
    for each grade, are sent to the texts, so texts are not shuffled.
    """
    scratch, spark = scratch_of(docs), docs.sparkSession
    graded = labels.select(
        F.col(id_col).alias("id"), F.col(grade_col).cast("int").alias("grade"), F.xxhash64(id_col).alias("draw")
    ).where("id is not null and grade >= 0")
    counts = {r["grade"]: r["count"] for r in graded.groupBy("grade").count().collect()}  # one row per grade
    share = F.lit(0)
    for grade, count in counts.items():
        share = F.when(F.col("grade") == grade, min(1 << 30, (train_docs << 30) // count)).otherwise(share)
    drawn = graded.where(F.pmod("draw", F.lit(1 << 30)) < share).select("id", "grade").distinct()
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = texts.join(F.broadcast(drawn), "id").select("text", "grade")
    listed = scratch.stage(texts.mapInArrow(_listed, "grade int, keys array<bigint>, vals array<double>"), "drawn")
    taken = {r["grade"]: r["count"] for r in listed.groupBy("grade").count().collect()}
    clean = taken.get(0, 0)
    toxic = sum(taken.values()) - clean
    if not clean or not toxic:
        return OrdinalModel(np.empty(0, _U), np.empty(0), np.empty(0))
    seen = listed.select("grade", F.explode("keys").alias("key")).groupBy("key").agg(
        F.count_if(F.col("grade") == 0).alias("c"), F.count_if(F.col("grade") > 0).alias("t")
    ).where(F.col("c") + F.col("t") >= LEAST_DOCS)
    rate = (F.col("c") + F.col("t") + 1) / (clean + toxic + 2)
    z = F.abs(F.col("t") / toxic - F.col("c") / clean) / F.sqrt(rate * (1 - rate))
    best = seen.orderBy(z.desc(), "key").limit(FEATURES).select("key").toArrow()["key"].to_numpy().view(_U)
    # Of the drawn texts only the chosen features come to the driver.
    table = listed.mapInArrow(
        _of_known(spark.sparkContext.broadcast(best)), "grade int, at array<int>, val array<double>"
    ).toArrow()
    found = [(np.array(a, np.int64), np.array(v)) for a, v in zip(table["at"].to_pylist(), table["val"].to_pylist())]
    grades = table["grade"].to_numpy().astype(np.int64)
    weight = np.array([counts[g] / taken[g] for g in grades.tolist()])
    weights, thresholds = fit_ordinal(found, grades, weight, len(best))
    return OrdinalModel(best, weights, thresholds)


def _scored(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_in_worker()
        model = shared.value
        table = HashTable(model.features)
        for batch in batches:
            scores = []
            for keys, values in text_features(batch.column("text")):
                at = table.find(keys)
                scores.append(float((model.weights[at[at >= 0]] * values[at >= 0]).sum()))
            above = model.probabilities(np.array(scores))
            above = above if above.shape[1] else np.zeros((len(scores), 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(above.sum(axis=1)), pa.array(above[:, 0])],
                [*batch.schema.names, "severity", "p_toxic"],
            )

    return run


def score_toxicity(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``severity`` (the expected grade) and ``p_toxic`` (the
    probability of a grade above 0).  A null or empty text is scored as a text
    without features.  Columns of these two names are replaced, all others kept."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c not in (text_col, "severity", "p_toxic")]
    rows = docs.select(
        *[docs[f"`{c}`"].alias(f"col_{n}") for n, c in enumerate(others)], docs[f"`{text_col}`"].alias("text")
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
    found = rows.mapInArrow(_scored(shared), ", ".join([*fields, "severity double, p_toxic double"]))
    return found.select(
        *[F.col(f"col_{n}").alias(c) for n, c in enumerate(others)], F.col("text").alias(text_col), "severity", "p_toxic"
    )
