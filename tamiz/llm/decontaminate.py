"""Benchmark decontamination by spaced seeds.

A seed is the hash of the words at the 1s of a mask laid over a text at every
position; words under a 0 may be anything, so a passage with substituted words
still shares seeds.  Seeds of the training texts are joined with those of the
benchmark items.  Around each hit the two texts are compared word by word along
their common diagonal: the best stretch, by matches less twice the mismatches,
is the overlap.  Words that repeat give ranges of diagonals, which are united
before any is compared, so a text never has more than its words and the item's.  An overlap counts if it has ``ENOUGH_WORDS`` equal words, or
``ENOUGH_SHARE`` of the item's.

The benchmark is a stated query set: it is read in blocks of about
``BLOCK_WORDS`` words, each a table of bounded size that all tasks get, and
every block is compared with every whole text.  Training texts are not shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tamiz.llm.frames import kept_in_worker, ship_package
from tamiz.llm.words import NOT_ALPHANUMERIC, HashTable, mixed, text_slices, word_hashes

MASKS = ("110110011", "1010011011", "11001010101")
ENOUGH_WORDS, ENOUGH_SHARE = 13, 0.6
MISMATCH = 2
BLOCK_WORDS = 1_000_000
#: Ranges of diagonals made together, before those that meet are united.
LANES = 1 << 20

_U = np.uint64
OVERLAP = "array<struct<item_id:{kind},matched:int,item_words:int,first_word:int>>"


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """The seed at every position where the mask fits into ``words``."""
    count = max(0, len(words) - len(mask) + 1)
    out = np.full(count, mixed(np.array([int(mask, 2) + (len(mask) << 32)], _U))[0])
    for place, used in enumerate(mask):
        if used == "1":
            out = (out ^ words[place : place + count]) * _U(0x9E3779B97F4A7C15)
            out ^= out >> _U(31)
    return mixed(out)


def _sequences(places: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each stretch of rows whose places count up by one while
    all of ``same`` stay as they are."""
    cut = np.diff(places) != 1
    for values in same:
        cut |= values[1:] != values[:-1]
    inner = np.flatnonzero(cut)
    some = [0] if len(places) else []
    starts = np.concatenate([some, inner + 1]).astype(np.int64)
    return starts, np.concatenate([inner, [len(places) - 1] if some else []]).astype(np.int64)


def _united(lanes: np.ndarray) -> np.ndarray:
    """The same diagonals, each once: ranges of one text and item that meet are one range."""
    if not lanes.shape[1]:
        return lanes
    text, item, first, last = lanes[:, np.lexsort(lanes[[2, 1, 0]])]
    pair = np.concatenate([[0], np.cumsum((text[1:] != text[:-1]) | (item[1:] != item[:-1]))])
    width = int(last.max() - first.min()) + 3
    low, high = first - first.min() + pair * width, np.maximum.accumulate(last - first.min() + pair * width)
    starts = np.concatenate([[0], np.flatnonzero(low[1:] > high[:-1] + 1) + 1])
    ends = np.concatenate([starts[1:] - 1, [len(low) - 1]])
    return np.stack([text[starts], item[starts], first[starts], high[ends] - pair[ends] * width + first.min()])


@dataclass
class BenchmarkIndex:
    """Words of the items one after another, and (seed, item, places) rows; a seed that
    stands at places in sequence, as within a repeated word, is one row."""

    item_ids: list
    words: np.ndarray
    begins: np.ndarray
    masks: list[str]

    def build(self) -> None:
        found, items, places = [], [], []
        for item, (begin, end) in enumerate(zip(self.begins[:-1], self.begins[1:])):
            for mask in self._masks_for(end - begin):
                keys = seeds(self.words[begin:end], mask)
                found.append(keys)
                items.append(np.full(len(keys), item))
                places.append(np.arange(len(keys)))
        keys = np.concatenate([*found, np.empty(0, _U)])
        order = np.argsort(keys, kind="stable")
        items = np.concatenate([*items, np.empty(0, np.int64)]).astype(np.int64)[order]
        places = np.concatenate([*places, np.empty(0, np.int64)]).astype(np.int64)[order]
        starts, ends = _sequences(places, keys[order], items)
        self.items, self.low, self.high = items[starts], places[starts], places[ends]
        keys, self.first, self.count = np.unique(keys[order][starts], return_index=True, return_counts=True)
        self.table = HashTable(keys)

    @staticmethod
    def _masks_for(size: int) -> list[str]:
        """The masks that fit; an item shorter than all of them is one solid seed."""
        fitting = [mask for mask in MASKS if len(mask) <= size]
        return fitting or (["1" * size] if size else [])

    @classmethod
    def of(cls, item_ids: list, texts: pa.Array) -> BenchmarkIndex:
        words, begins = [np.empty(0, _U)], [np.zeros(1, np.int64)]
        for _, data, offsets in text_slices(texts):
            hashes, some = word_hashes(data, offsets, NOT_ALPHANUMERIC)
            begins.append(some[1:] + sum(len(w) for w in words))
            words.append(hashes)
        begins = np.concatenate(begins)
        sizes = set(np.diff(begins).tolist())
        return cls(item_ids, np.concatenate(words), begins, sorted({m for s in sizes for m in cls._masks_for(s)}))

    def overlaps(self, words: np.ndarray, begins: np.ndarray) -> dict[int, dict[int, tuple[int, int, int]]]:
        """For each text with overlaps: item -> (matched words, words of the item, first word in the text)."""
        text_of = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
        lanes = np.empty((4, 0), np.int64)
        for mask in self.masks:
            at = self.table.find(seeds(words, mask))
            hit = np.flatnonzero(at >= 0)
            hit = hit[text_of[hit] == text_of[hit + len(mask) - 1]]
            starts, ends = _sequences(hit, at[hit], text_of[hit])
            low, high = hit[starts], hit[ends]
            upto = np.cumsum(self.count[at[low]])
            begin = 0
            while begin < len(low):
                before = upto[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(upto, before + LANES, "right")))
                lanes = _united(np.concatenate([lanes, self._lanes(text_of, at, low[begin:end], high[begin:end])], axis=1))
                begin = end
        found: dict[int, dict[int, tuple[int, int, int]]] = {}
        # From the last diagonal up; nothing before one on which the whole item is equal can be better.
        for text, item, first, last in lanes.T[::-1].tolist():
            for shift in range(last, first - 1, -1):
                best = found.get(text, {}).get(item, (0,))
                if best[0] == self.begins[item + 1] - self.begins[item]:
                    break
                overlap = self._compare(words, begins[text], begins[text + 1], item, shift)
                if overlap and overlap > best:
                    found.setdefault(text, {})[item] = overlap
        return found

    def _lanes(self, text_of: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """(text, item, first and last diagonal) rows of sequences of equal hits from ``low`` to ``high``."""
        count = self.count[at[low]]
        entry = np.repeat(self.first[at[low]] - np.cumsum(count) + count, count) + np.arange(count.sum())
        low, high = np.repeat(low, count), np.repeat(high, count)
        return np.stack([text_of[low], self.items[entry], low - self.high[entry], high - self.low[entry]])

    def _compare(self, words: np.ndarray, begin: int, end: int, item: int, shift: int):
        """Best stretch of the item laid over the text with its first word at ``shift``."""
        own = self.words[self.begins[item] : self.begins[item + 1]]
        low, high = max(0, begin - shift), min(len(own), end - shift)
        equal = own[low:high] == words[low + shift : high + shift]
        score = np.concatenate([[0], np.cumsum(np.where(equal, 1, -MISMATCH))])
        lowest = np.minimum.accumulate(score)
        last = int((score - lowest).argmax())
        first = int(score[: last + 1].argmin())
        matched = int(equal[first:last].sum())
        if matched >= ENOUGH_WORDS or matched >= ENOUGH_SHARE * len(own):
            return matched, len(own), int(low + first + shift - begin)
        return None


def _compared(shared, kind: pa.DataType) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        kept_in_worker(("benchmark", id(index)), lambda: index.build() or index)
        struct = pa.struct([("item_id", kind), ("matched", pa.int32()), ("item_words", pa.int32()), ("first_word", pa.int32())])
        for batch in batches:
            lists: list = []
            for _, data, offsets in text_slices(batch.column("text")):
                words, begins = word_hashes(data, offsets, NOT_ALPHANUMERIC)
                found = index.overlaps(words, begins)
                for text in range(len(begins) - 1):
                    lists.append([(index.item_ids[i], *o) for i, o in sorted(found.get(text, {}).items())])
            found = pa.array(
                [[dict(zip(("item_id", "matched", "item_words", "first_word"), o)) for o in one] for one in lists],
                pa.list_(struct),
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "found"])

    return run


def mark_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    out: str = "overlaps",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` plus an array of the benchmark items that each text overlaps:
    item id, equal words, words of the item, position of the first word.

    Words are runs of ASCII letters and digits and of all other non-ASCII
    characters, A-Z lower-cased.  Null and empty texts and items overlap
    nothing; an empty benchmark leaves every array empty; items that repeat are
    reported each.  All columns of ``docs`` are kept, whatever their names, but one
    named like ``out``, which is replaced.  Of stretches that tie, the last in the
    text is reported.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kind = dict(benchmark.dtypes)[item_id]
    items = benchmark.select(F.col(item_id).alias("item"), F.col(item_text).alias("text"))
    # About one word in six bytes; only the size of a block depends on it.
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (6 * block_words)))
    others = [c for c in docs.columns if c not in (text_col, out)]
    rows = docs.select(
        *[docs[f"`{c}`"].alias(f"col_{n}") for n, c in enumerate(others)],
        docs[f"`{text_col}`"].alias("text"),
    )
    found = rows.withColumn("all_found", F.array().cast(OVERLAP.format(kind=kind)))
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        table = own.toArrow()  # one block of the benchmark
        index = BenchmarkIndex.of(table["item"].to_pylist(), table["text"].combine_chunks())
        shared = spark.sparkContext.broadcast(index)
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema]
        passed = found.mapInArrow(
            _compared(shared, table.schema.field("item").type),
            ", ".join([*fields, f"found {OVERLAP.format(kind=kind)}"]),
        )
        found = passed.withColumn("all_found", F.concat("all_found", "found")).drop("found")
    return found.select(
        *[F.col(f"col_{n}").alias(c) for n, c in enumerate(others)],
        F.col("text").alias(text_col),
        F.col("all_found").alias(out),
    )
