"""Language identification, words first, character n-grams for unseen words.

A word (a run of letters, lower-cased) that was seen in training adds the
logarithm of its smoothed frequency in each language.  Any other word is scored
by its character 5-grams, or if none of those was seen by its 4-grams, and so on
down to single letters: the mean over those that were seen.  The prediction is
the language with the largest sum, its score the posterior under equal priors.

The model is fitted on at most ``TRAIN_DOCS`` texts of each language, drawn by a
hash of the id, so the table that every task holds has a bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tamiz.llm.frames import kept_in_worker, ship_package
from tamiz.llm.words import HashTable, hashes_of, mixed

#: Expected number of training texts per language, at most.
TRAIN_DOCS = 2000
LONGEST_GRAM = 5
#: Added to every count; letters of texts worked on at once.
SMOOTHING, SLICE_LETTERS = 0.5, 1 << 19
UNKNOWN = "und"

_U = np.uint64
_letters: list[np.ndarray] = []


def _letter_tables() -> list[np.ndarray]:
    """For every code point: its hash value, and whether it is a letter."""
    if not _letters:
        points = np.arange(0x110000)
        _letters.append(mixed(points.astype(_U) + _U(0x9E3779B97F4A7C15)))
        _letters.append(np.array([chr(p).isalpha() for p in points.tolist()]))
    return _letters


class Words:
    """The words of some texts: code points, spans, and the text each belongs to."""

    def __init__(self, texts: list[str | None]):
        lowered = [(text or "").lower() for text in texts]
        # A blank after each text keeps words apart.
        points = np.frombuffer(" ".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
        self.values, is_letter = _letter_tables()
        self.points = points
        inside = np.concatenate([[False], is_letter[points], [False]])
        self.starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        self.ends = np.flatnonzero(inside[:-1] & ~inside[1:])
        bounds = np.cumsum([len(text) + 1 for text in lowered])
        self.text = np.searchsorted(bounds, self.starts, "right")

    def hashes(self) -> np.ndarray:
        return hashes_of(self.points, self.starts, self.ends, self.values)

    def grams(self, size: int, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all ``size``-grams of the given words, and the place in
        ``which`` of the word each is from."""
        count = np.maximum(self.ends[which] - self.starts[which] - size + 1, 0)
        owner = np.repeat(np.arange(len(which)), count)
        first = np.repeat(self.starts[which] - np.cumsum(count) + count, count) + np.arange(len(owner))
        return hashes_of(self.points, first, first + size, self.values), owner


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        first = held = 0
        for row, text in enumerate(texts):
            held += len(text or "")
            if held >= SLICE_LETTERS or row == len(texts) - 1:
                yield batch.slice(first, row + 1 - first), texts[first : row + 1]
                first, held = row + 1, 0


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(size, gram, lang, n): words have size 0."""
    for batch, texts in _sliced(batches):
        langs = batch.column("lang").to_pylist()
        for lang in sorted(set(langs)):
            words = Words([text for text, of in zip(texts, langs) if of == lang])
            everything = np.arange(len(words.starts))
            for size in range(LONGEST_GRAM + 1):
                keys = words.grams(size, everything)[0] if size else words.hashes()
                keys, counts = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(keys), size, np.int32)),
                        pa.array(keys.view(np.int64)),
                        pa.array([lang] * len(keys), pa.string()),
                        pa.array(counts.astype(np.int64)),
                    ],
                    ["size", "gram", "lang", "n"],
                )


@dataclass
class LanguageModel:
    """For words (0) and each gram size: the known hashes and, for each of them,
    the log frequency in every language."""

    langs: list[str]
    tables: list[tuple[np.ndarray, np.ndarray]]

    def scorer(self) -> Callable[[list[str | None]], tuple[np.ndarray, np.ndarray]]:
        found = [(HashTable(keys), logs) for keys, logs in self.tables]

        def score(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
            """Log likelihoods (texts x languages) and number of words."""
            words, kinds = Words(texts), len(self.langs)
            of_word = np.zeros((len(words.starts), kinds))
            table, logs = found[0]
            at = table.find(words.hashes())
            of_word[at >= 0] = logs[at[at >= 0]]
            unseen = np.flatnonzero(at < 0)
            for size in range(LONGEST_GRAM, 0, -1):
                if not len(unseen):
                    break
                table, logs = found[size]
                grams, owner = words.grams(size, unseen)
                at = table.find(grams)
                owner, at = owner[at >= 0], at[at >= 0]
                seen = np.bincount(owner, minlength=len(unseen))
                hit = seen > 0
                for lang in range(kinds):
                    total = np.bincount(owner, logs[at, lang], len(unseen))
                    of_word[unseen[hit], lang] = total[hit] / seen[hit]
                unseen = unseen[~hit]
            sums = np.zeros((len(texts), kinds))
            for lang in range(kinds):
                sums[:, lang] = np.bincount(words.text, of_word[:, lang], len(texts))
            return sums, np.bincount(words.text, minlength=len(texts))

        return score


def fit_languages(docs: DataFrame, text_col: str, lang_col: str, draw: Column) -> LanguageModel:
    """The model from the labelled texts of ``docs``; ``draw`` is a long hash by
    which texts are drawn.  Rows without text or label teach nothing."""
    ship_package(docs.sparkSession)
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), draw.alias("draw"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    share = F.lit(0)
    for lang, count in counts.items():
        kept = min(1 << 30, (TRAIN_DOCS << 30) // count)
        share = F.when(F.col("lang") == lang, kept).otherwise(share)
    drawn = rows.where(F.pmod("draw", F.lit(1 << 30)) < share).select("text", "lang")
    parts = drawn.mapInArrow(_counted, "size int, gram bigint, lang string, n bigint")
    table = parts.groupBy("size", "gram", "lang").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(counts)
    number = {lang: n for n, lang in enumerate(langs)}
    sizes, grams = table["size"].to_numpy(), table["gram"].to_numpy().view(_U)
    lang = np.array([number[x] for x in table["lang"].to_pylist()], np.int64)
    n = table["n"].to_numpy()
    tables = []
    for size in range(LONGEST_GRAM + 1):
        here = sizes == size
        keys, at = np.unique(grams[here], return_inverse=True)
        count = np.full((len(keys), len(langs)), SMOOTHING)
        np.add.at(count, (at, lang[here]), n[here])
        tables.append((keys, np.log(count / count.sum(axis=0)) if len(keys) else count))
    return LanguageModel(langs, tables)


def _predicted(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scorer = kept_in_worker(("languages", id(model)), model.scorer)
        for batch, texts in _sliced(batches):
            logs, words = scorer(texts)
            if model.langs:
                best = logs.argmax(axis=1)
                top = logs[np.arange(len(texts)), best]
                score = 1 / np.exp(logs - top[:, None]).sum(axis=1)
                lang = np.array(model.langs, object)[best]
            else:
                score, lang = np.zeros(len(texts)), np.full(len(texts), UNKNOWN, object)
            lang = np.where(words > 0, lang, UNKNOWN)
            score = np.where(words > 0, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score)], ["row", "lang_pred", "score"]
            )
        pa.default_memory_pool().release_unused()

    return run


def predict_languages(
    docs: DataFrame, model: LanguageModel, text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` plus ``lang_pred`` and ``score``.

    Null texts and texts without a letter are ``und`` with score 0, as is every
    text if nothing was learned.  Equal sums go to the first language by name.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"].alias(f"col_{n}") for n, c in enumerate(keep)], F.lit(0).alias("none")).alias("row"),
        docs[f"`{text_col}`"].alias("text"),
    )
    kind = rows.schema["row"].dataType.simpleString()
    found = rows.mapInArrow(_predicted(shared), f"row {kind}, lang_pred string, score double")
    return found.select(*[F.col(f"row.col_{n}").alias(c) for n, c in enumerate(keep)], "lang_pred", "score")
