"""Language-model scores from a subword lattice.

A text is its words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased) and one end.  A
word, with a mark before it, can be cut into pieces of an existing vocabulary in
many ways; its probability is the sum over all of them of the product of the
piece probabilities, by a forward recursion in log space.  Pieces never cross
words, so the log probability of a text is the sum over its words, plus the end.
A character without a piece of its own is spelled in byte pieces.

Piece probabilities: the vocabulary's own scores (ranks, read as Zipf weights)
weight all segmentations of the training words; the expected piece counts, from
the forward-backward recursion over the whole training vocabulary, plus
``PRIOR_COUNT`` observations of the weights give the probabilities.

The lattice is the back-off of a word model: a word seen c times in training has
``(c - d) / N`` of its own, with one discount d for all, and what the discounts
set free is spread over all words by the lattice, scaled to sum to 1.  So the
probabilities of all texts sum to 1, and no word has none.

Beside it the plain unigram score with add-one smoothing is returned.

The lattice is computed once for each distinct word.  Scores of the commonest
``HEAD_WORDS`` words (a bound on rows and so on bytes) are sent to all tasks;
the other words of a text are joined with the score table by shuffle.  Words
are matched by 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tamiz.llm.frames import scratch_of
from tamiz.llm.language_id import _letter_tables
from tamiz.llm.words import HashTable, _powers_up_to, mixed, text_slices, word_hashes

PRIOR_COUNT = 10_000.0
HEAD_WORDS = 400_000
MARK = "▁"
#: Spans of words looked at together.
SPANS = 1 << 20
#: Texts whose words are counted together before they are passed on.
COUNT_BYTES = 8 << 20

_U = np.uint64


@dataclass
class PieceVocabulary:
    """Pieces with their log weights; ``byte_logs`` are those of the 256 byte
    pieces and ``end_log`` that of the end of a text."""

    pieces: list[str]
    logs: np.ndarray
    byte_logs: np.ndarray
    end_log: float


def read_pieces(path: str) -> PieceVocabulary:
    """The usable pieces of a sentencepiece file: a mark only in front, no control
    pieces, weight by rank of the score."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    known = [
        (model.id_to_piece(n), model.get_score(n))
        for n in range(model.get_piece_size())
        if not (model.is_control(n) or model.is_unknown(n) or model.is_byte(n) or model.is_unused(n))
    ]
    known = sorted((p for p in known if MARK not in p[0][1:]), key=lambda p: (-p[1], p[0]))
    weight = 1 / (np.arange(len(known) + 257) + 2.0)
    logs = np.log(weight / weight.sum())
    return PieceVocabulary([p for p, _ in known], logs[: len(known)], logs[len(known) : -1], float(logs[-1]))


class Lattice:
    """Forward and forward-backward recursions for many words at once."""

    def __init__(self, vocabulary: PieceVocabulary):
        self.logs, self.byte_logs = vocabulary.logs, vocabulary.byte_logs
        self.letters = _letter_tables()[0]
        lengths = np.array([len(p) for p in vocabulary.pieces])
        points, starts = self._points(vocabulary.pieces)
        self.table = HashTable(self._hashes(self._sums(points), starts, starts + lengths))
        self.longest = int(lengths.max())

    def _points(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        return points, np.cumsum([0] + [len(w) for w in words])[:-1]

    def _sums(self, points: np.ndarray) -> np.ndarray:
        power, _ = _powers_up_to(len(points))
        return np.concatenate([np.zeros(1, _U), np.cumsum(self.letters[points] * power[: len(points)])])

    def _hashes(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        _, inverse = _powers_up_to(len(sums))
        return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U))

    def _groups(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(which words, piece of each span, fallback of each character), words of
        one length together.  Spans are laid out [word, end, size]; -1 is no piece."""
        lengths = np.array([len(w) + 1 for w in words])
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(lengths[order]) != 0, True])
        for low, high in zip(cuts[:-1], cuts[1:]):
            length = int(lengths[order[low]])
            step = max(1, SPANS // (length * min(length, self.longest)))
            for at in range(low, high, step):
                which = order[at : min(at + step, high)]
                points, starts = self._points([MARK + words[n] for n in which])
                sums, widest = self._sums(points), min(length, self.longest)
                piece = np.full((len(which), length, widest), -1, np.int32)
                for size in range(1, widest + 1):
                    first = (starts[:, None] + np.arange(length - size + 1)).ravel()
                    found = self.table.find(self._hashes(sums, first, first + size))
                    piece[:, size - 1 :, size - 1] = found.reshape(len(which), -1)
                yield which, piece, self._fallback(points.reshape(len(which), length), piece[:, :, 0])

    def _fallback(self, points: np.ndarray, single: np.ndarray) -> np.ndarray:
        out = np.full(points.shape, -np.inf)
        bare = single < 0
        if bare.any():
            chars, at = np.unique(points[bare], return_inverse=True)
            spelled = [self.byte_logs[list(chr(c).encode("utf-8", "surrogatepass"))].sum() for c in chars.tolist()]
            out[bare] = np.array(spelled)[at]
        return out

    def _steps(self, piece: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        step = np.where(piece >= 0, self.logs[piece], -np.inf)
        step[:, :, 0] = np.maximum(step[:, :, 0], spelled)
        return step

    @staticmethod
    def _forward(step: np.ndarray) -> np.ndarray:
        """Log weight of all ways to spell the first i characters, for every i."""
        words, length, widest = step.shape
        total = np.full((words, length + 1), -np.inf)
        total[:, 0] = 0
        for end in range(1, length + 1):
            sizes = min(widest, end)
            ways = step[:, end - 1, :sizes] + total[:, end - sizes : end][:, ::-1]
            total[:, end] = _log_sum(ways)
        return total

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        out = np.empty(len(words))
        for which, piece, spelled in self._groups(words):
            out[which] = self._forward(self._steps(piece, spelled))[:, -1]
        return out

    def expected_counts(self, words: list[str], times: np.ndarray) -> np.ndarray:
        """How often each piece is used over all segmentations of the words, each
        counted ``times``; the 256 byte pieces come last."""
        counts = np.zeros(len(self.logs) + 256)
        for which, piece, spelled in self._groups(words):
            step = self._steps(piece, spelled)
            forward, (n, length, widest) = self._forward(step), step.shape
            back = np.full((n, length + 1), -np.inf)
            back[:, length] = 0
            for first in range(length - 1, -1, -1):
                sizes = np.arange(1, min(widest, length - first) + 1)
                ways = step[:, first + sizes - 1, sizes - 1] + back[:, first + sizes]
                back[:, first] = _log_sum(ways)
            start = np.arange(1, length + 1)[:, None] - np.arange(1, widest + 1)
            before = np.where(start >= 0, forward[:, np.maximum(start, 0)], -np.inf)
            share = np.exp(before + step + back[:, 1:, None] - forward[:, -1][:, None, None])
            share *= times[which][:, None, None]
            real = piece >= 0
            counts[: len(self.logs)] += np.bincount(piece[real], share[real], len(self.logs))
            bare = (piece[:, :, 0] < 0) & (share[:, :, 0] > 0)
            for row, place in zip(*np.nonzero(bare)):
                char = words[which[row]][place - 1] if place else MARK
                for byte in char.encode("utf-8", "surrogatepass"):
                    counts[len(self.logs) + byte] += share[row, place, 0]
        return counts


def _log_sum(ways: np.ndarray) -> np.ndarray:
    top = ways.max(axis=1)
    safe = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(ways - safe[:, None]).sum(axis=1))


# -- counting words -------------------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n, c): times in all texts of a batch, and in training texts."""
    for batch in batches:
        texts = batch.column("text")
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            before = sizes[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(sizes, before + COUNT_BYTES, "right")))
            part, trains = texts.slice(first, last - first), batch.column("training").slice(first, last - first)
            for training in (True, False):
                some = part.filter(pc.equal(trains, training))
                words = pc.list_flatten(pc.ascii_split_whitespace(pc.ascii_lower(some.cast(pa.large_string()))))
                found = pc.value_counts(words.filter(pc.not_equal(words, "")))
                counts = found.field(1)
                none = pa.array(np.zeros(len(counts), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [found.field(0).cast(pa.string()), counts, counts if training else none], ["word", "n", "c"]
                )
                del some, words, found, counts, none
                pa.default_memory_pool().release_unused()
            first = last


def _expected(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, counts = Lattice(shared.value), None
        for batch in batches:
            for first in range(0, batch.num_rows, 20_000):
                part = batch.slice(first, 20_000)
                found = lattice.expected_counts(part.column("word").to_pylist(), part.column("c").to_numpy())
                counts = found if counts is None else counts + found
        if counts is not None:
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["piece", "n"])

    return run


def _word_scores(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, own, free = shared.value
        lattice = Lattice(vocabulary)
        for batch in batches:
            for first in range(0, batch.num_rows, 20_000):
                part = batch.slice(first, 20_000)
                words = part.column("word")
                spelled = math.log(free) + lattice.log_probabilities(words.to_pylist())
                with np.errstate(divide="ignore"):
                    seen = np.log(np.maximum(part.column("c").to_numpy() - own[0], 0) / own[1])
                hashes = [word_hashes(data, offsets)[0] for _, data, offsets in text_slices(words)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(hashes).view(np.int64)),
                        part.column("n"),
                        part.column("c"),
                        pa.array(np.logaddexp(seen, spelled) / math.log(10)),
                    ],
                    ["word", "n", "c", "log10"],
                )

    return run


# -- scoring texts ----------------------------------------------------------------


def _summed(shared, size: float, end: tuple[int, float]) -> Callable:
    """Sums over the head words and the end of each text, and its other words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, logs = shared.value
        table = HashTable(keys)
        base = np.log10((counts + 1) / size)
        end_known, end_base, end_log = int(end[0] > 0), math.log10((end[0] + 1) / size), end[1]
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], []]
            for _, data, offsets in text_slices(batch.column("text")):
                words, begins = word_hashes(data, offsets)
                rows = len(begins) - 1
                text = np.repeat(np.arange(rows), np.diff(begins))
                at = table.find(words)
                head = at >= 0
                of, at = text[head], at[head]
                columns[0].append(np.diff(begins) + 1)
                columns[1].append(np.bincount(of, counts[at] > 0, rows).astype(np.int64) + end_known)
                columns[2].append(np.bincount(of, base[at], rows) + end_base)
                columns[3].append(np.bincount(of, logs[at], rows) + end_log)
                rest, of = words[~head], text[~head]
                cuts = np.searchsorted(of, np.arange(rows + 1))
                for low, high in zip(cuts[:-1], cuts[1:]):
                    key, n = np.unique(rest[low:high], return_counts=True)
                    columns[4].append(key.view(np.int64))
                    columns[5].append(n)
            sums = [np.concatenate(c) if c else np.empty(0) for c in columns[:4]]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in range(2)],
                    *[pa.array(s, kind) for s, kind in zip(sums, (pa.int64(), pa.int64(), pa.float64(), pa.float64()))],
                    pa.array(columns[4], pa.list_(pa.int64())),
                    pa.array(columns[5], pa.list_(pa.int64())),
                ],
                ["id", "training", "n_tokens", "n_known", "base_score", "score", "words", "times"],
            )

    return run


def lattice_scores(
    docs: DataFrame, vocabulary: PieceVocabulary, training: Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """For every row: id, whether it was trained on, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score`` (both log10 of probabilities).

    A null or empty text is one end.  Rows that repeat count and are scored each.
    A row for which ``training`` is null is not trained on.  Without training
    texts all words are unknown and the vocabulary's own weights are used.
    """
    spark, scratch = docs.sparkSession, scratch_of(docs)
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(training, F.lit(False)).alias("training"), F.col(text_col).alias("text")
    )
    counted = rows.select("training", "text").mapInArrow(_counted, "word string, n bigint, c bigint")
    words = scratch.stage(counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c")), "words")
    ends = rows.where("training").count()
    total = words.agg(
        F.sum("c").alias("c"), *[F.count_if(F.col("c") >= n).alias(f"v{n}") for n in (1, 2, 3)]
    ).first()
    train_tokens = (total["c"] or 0) + ends
    distinct = (total["v1"] or 0) + (1 if ends else 0)

    if ends:
        vocabulary = _trained(spark, words.where("c > 0"), vocabulary, ends)
    # The discount that fits the numbers of words seen once and twice.
    once, twice = (total["v1"] or 0) - (total["v2"] or 0), (total["v2"] or 0) - (total["v3"] or 0)
    discount = min(0.95, max(0.05, once / max(1, once + 2 * twice)))
    free = discount * (total["v1"] or 0) / train_tokens if total["v1"] else 1.0
    end_log10 = math.log10(ends / train_tokens) if ends else vocabulary.end_log / math.log(10)
    starts = np.array([piece.startswith(MARK) for piece in vocabulary.pieces])
    begun = np.exp(vocabulary.logs[starts]).sum()
    spread = free * (begun + math.exp(vocabulary.end_log)) / begun  # the lattice alone sums to less than 1
    shared = spark.sparkContext.broadcast((vocabulary, (discount, max(1, train_tokens)), spread))
    scored = scratch.stage(
        words.mapInArrow(_word_scores(shared), "word bigint, n bigint, c bigint, log10 double"), "scored"
    )
    least = _least_count(scored)
    head = scored.where(F.col("n") >= least).select("word", "c", "log10").toArrow()  # at most HEAD_WORDS rows
    head = tuple(head[name].to_numpy() for name in ("word", "c", "log10"))
    head = spark.sparkContext.broadcast((head[0].view(_U), head[1], head[2]))
    size = float(train_tokens + distinct + 1)
    kind = dict(rows.dtypes)["id"]
    summed = rows.mapInArrow(
        _summed(head, size, (ends, end_log10)),
        f"id {kind}, training boolean, n_tokens bigint, n_known bigint, base_score double, score double, "
        "words array<bigint>, times array<bigint>",
    )
    summed = scratch.stage(summed.withColumn("row", F.monotonically_increasing_id()), "summed")
    rest = summed.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.times").alias("times")
    )
    rest = rest.join(scored.where(F.col("n") < least), "word").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * F.log10((F.col("c") + 1) / F.lit(size))).alias("base"),
        F.sum(F.col("times") * F.col("log10")).alias("log10"),
    )
    own = summed.drop("words", "times").join(rest, "row", "left")
    return own.select(
        F.col("id").alias(id_col),
        (~F.col("training")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("log10", F.lit(0.0))).alias("score"),
    )


def _trained(spark: SparkSession, words: DataFrame, prior: PieceVocabulary, ends: int) -> PieceVocabulary:
    parts = words.mapInArrow(_expected(spark.sparkContext.broadcast(prior)), "piece int, n double")
    table = parts.groupBy("piece").agg(F.sum("n").alias("n")).toArrow()  # a row per piece
    logs = np.concatenate([prior.logs, prior.byte_logs, [prior.end_log]])
    counts = PRIOR_COUNT * np.exp(logs)
    counts[table["piece"].to_numpy()] += table["n"].to_numpy()
    counts[-1] += ends
    logs, kept = np.log(counts / counts.sum()), len(prior.pieces)
    return PieceVocabulary(prior.pieces, logs[:kept], logs[kept:-1], float(logs[-1]))


def _least_count(scored: DataFrame) -> int:
    """The smallest count that at most ``HEAD_WORDS`` words reach, from the
    numbers of words by the power of two (in eighths) of their count."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 8)
    sizes = {r["step"]: r["count"] for r in scored.groupBy(step.alias("step")).count().collect()}  # under 512 rows
    held, least = 0, max(sizes, default=0) + 1
    for level in sorted(sizes, reverse=True):
        held += sizes[level]
        if held > HEAD_WORDS:
            break
        least = level
    return math.ceil(2 ** (least / 8) - 1e-9)
