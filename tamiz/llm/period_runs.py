"""Periodic runs of words: stretches that repeat themselves at a fixed distance.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are the same) and at least ``max(least_words, repeats * q)`` words, which no
neighbouring word extends keeping that period.

1. *Recursive frequency splitting.*  A run holds each of its words at least
   ``repeats`` times, so a word that is rarer within the current segment (at
   first the whole text) is in none and splits it; parts of fewer than
   ``least_words`` words go.  The parts are counted anew until none changes.  All
   texts of a slice are split together; prose is gone after a round or two.
2. *Lag scan.*  In a segment that is left, every lag up to its length by
   ``repeats`` is scanned.  A run of period ``q`` matches itself ``q`` words further on
   over ``max(least_words, repeats * q) - q`` words, so it is enough to look at
   positions a little less than that apart, comparing a few words at each.  A
   match is extended to both sides as far as it goes.
3. A longer lag that falls on a multiple of the period of a known run, with a
   whole lag inside it, would give the same run and is passed over.  So every
   run is found at its smallest period, first and once.

Words are compared by 64-bit hashes as they are spelled; two different words of
n share one with a probability of about n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tamiz.llm.frames import ship_package
from tamiz.llm.words import BLANKS, exact_hashes, joined, mixed, text_slices, word_spans

LEAST_WORDS, REPEATS = 24, 3
#: Words compared at each position of the lag scan.
WINDOW = 8
#: Positions looked at together.
PAIRS = 1 << 18
#: Rounds of splitting after which what is left is scanned as it is (the scan alone is exact).
ROUNDS = 64
#: Known runs, the longest first, that are held against a whole block of positions at once.
LONGEST = 4

_RUNS = "array<struct<start bigint, length bigint, period bigint>>"
_RUN_TYPE = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))


def surviving_segments(
    words: np.ndarray, begins: np.ndarray, least_words: int = LEAST_WORDS, repeats: int = REPEATS
) -> np.ndarray:
    """(begin, end) of the segments that frequency splitting leaves of texts whose
    words are ``words[begins[t] : begins[t + 1]]``, in order."""
    place = np.arange(len(words))
    segment = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    settled = []
    for _ in range(ROUNDS):
        if not len(place):
            break
        # Equal keys are equal words of one segment; a false one would only keep a word longer.
        key = mixed(words[place] ^ mixed(segment.astype(np.uint64)))
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        kept = count[which] >= repeats
        cuts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        whole = np.logical_and.reduceat(kept, cuts)
        sizes = np.diff(np.r_[cuts, len(place)])
        settled.append(np.stack([place[cuts], place[cuts] + sizes], axis=1)[whole & (sizes >= least_words)])
        left = kept & ~np.repeat(whole, sizes)
        place, segment = place[left], segment[left]
        if not len(place):
            break
        breaks = np.r_[True, (place[1:] != place[:-1] + 1) | (segment[1:] != segment[:-1])]
        segment = np.cumsum(breaks) - 1
        long = np.bincount(segment) >= least_words
        place, segment = place[long[segment]], segment[long[segment]]
    if len(place):
        cuts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1], True])
        settled.append(np.stack([place[cuts[:-1]], place[cuts[1:] - 1] + 1], axis=1))
    found = np.concatenate(settled) if settled else np.empty((0, 2), np.int64)
    return found[np.argsort(found[:, 0])]


class _Known:
    """The runs found so far in one segment."""

    def __init__(self):
        self.runs: list[tuple[int, int, int]] = []  # begin, end, period
        self._array = np.empty((0, 3), np.int64)

    def add(self, begin: int, end: int, period: int) -> None:
        self.runs.append((begin, end, period))

    def _table(self) -> np.ndarray:
        if len(self._array) != len(self.runs):
            self._array = np.array(self.runs, np.int64).reshape(-1, 3)
        return self._array

    def longest(self) -> np.ndarray:
        table = self._table()
        return table[np.argsort(table[:, 0] - table[:, 1], kind="stable")[:LONGEST]]

    def covers(self, places: np.ndarray, lag: int) -> np.ndarray:
        """Whether a run whose period divides ``lag`` holds a whole lag from each place on.
        Two such runs overlap by less than a lag, so the last one that begins
        before a place also ends last."""
        table = self._table()
        table = table[(lag % table[:, 2] == 0) & (table[:, 1] - table[:, 0] >= lag)]
        if not len(table):
            return np.zeros(len(places), bool)
        table = table[np.argsort(table[:, 0], kind="stable")]
        last = np.searchsorted(table[:, 0], places, "right") - 1
        return (last >= 0) & (table[np.maximum(last, 0), 1] >= places + lag)


def _reach(words: np.ndarray, place: int, lag: int) -> tuple[int, int]:
    """The stretch around ``place`` whose words are the same ``lag`` words further on."""
    begin, size = place, 64
    while begin > 0:
        low = max(0, begin - size)
        differ = np.flatnonzero(words[low:begin] != words[low + lag : begin + lag])
        if len(differ):
            begin = low + int(differ[-1]) + 1
            break
        begin, size = low, size * 2
    end, size, last = place, 64, len(words) - lag
    while end < last:
        high = min(last, end + size)
        differ = np.flatnonzero(words[end:high] != words[end + lag : high + lag])
        if len(differ):
            end += int(differ[0])
            break
        end, size = high, size * 2
    return begin, end


def scan_lags(
    words: np.ndarray, least_words: int = LEAST_WORDS, repeats: int = REPEATS
) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words``, by start, then period."""
    lags = np.arange(1, len(words) // repeats + 1)
    match = np.maximum(least_words, repeats * lags) - lags
    lags, match = lags[match + lags <= len(words)], match[match + lags <= len(words)]
    if not len(lags):
        return []
    window = min(WINDOW, int(match.min()))
    several, step = joined(words, window), match - window + 1
    counts = (len(words) - window - lags) // step + 1
    upto = np.cumsum(counts)
    known = _Known()
    first = 0
    while first < len(lags):
        base = upto[first] - counts[first]
        last = max(first + 1, int(np.searchsorted(upto, base + PAIRS, "right")))
        here = slice(first, last)
        row = np.repeat(np.arange(first, last), counts[here])
        place = (np.arange(len(row)) - (upto[row] - counts[row] - base)) * step[row]
        lag = lags[row]
        hit = several[place] == several[place + lag]
        place, lag = place[hit], lag[hit]
        for begin, end, period in known.longest():
            rest = ~((lag % period == 0) & (place >= begin) & (place + lag <= end))
            place, lag = place[rest], lag[rest]
        cuts = np.flatnonzero(np.r_[True, lag[1:] != lag[:-1]]) if len(lag) else []
        for at, to in zip(cuts, [*cuts[1:], len(lag)]):
            _take(words, place[at:to], int(lag[at]), known, least_words, repeats)
        first = last
    return sorted((begin, end - begin, period) for begin, end, period in known.runs)


def _take(
    words: np.ndarray, places: np.ndarray, lag: int, known: _Known, least_words: int, repeats: int
) -> None:
    done = -1
    for place in places[~known.covers(places, lag)]:
        if place < done:
            continue
        begin, done = _reach(words, int(place), lag)
        if done + lag - begin >= max(least_words, repeats * lag):
            known.add(begin, done + lag, lag)


def _dropped(runs: list[tuple[int, int, int]], size: int) -> np.ndarray:
    """Words that any run holds after its first period."""
    change = np.zeros(size + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


def _joined_words(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, kept: np.ndarray, rows: int
) -> pa.Array:
    """The kept words of each text, joined by one space: the byte after a word that
    is not its text's last one is a separator, and becomes the space."""
    starts, ends, owner = starts[kept], ends[kept], owner[kept]
    more = owner[:-1] == owner[1:]
    spaces = ends[:-1][more]
    take = np.zeros(len(data) + 1, np.int8)
    take[starts] += 1
    take[ends] -= 1
    taken = np.cumsum(take[:-1], dtype=np.int8).astype(bool)
    taken[spaces] = True
    out = data.copy()
    out[spaces] = 0x20
    sizes = np.bincount(owner, weights=ends - starts, minlength=rows).astype(np.int64)
    sizes += np.bincount(owner[:-1][more], minlength=rows)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return pa.LargeStringArray.from_buffers(rows, pa.py_buffer(offsets), pa.py_buffer(out[taken]))


def _runs_of(least_words: int, repeats: int) -> Callable:
    """(id, n_words, runs, collapsed) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_slices(batch.column("text")):
                rows = len(offsets) - 1
                starts, ends = word_spans(data, offsets, BLANKS)
                words = exact_hashes(data, starts, ends)
                begins = np.searchsorted(starts, offsets)
                begins[-1] = len(starts)
                found: list[list[tuple[int, int, int]]] = [[] for _ in range(rows)]
                kept = np.ones(len(words), bool)
                for begin, end in surviving_segments(words, begins, least_words, repeats):
                    runs = scan_lags(words[begin:end], least_words, repeats)
                    if runs:
                        text = int(np.searchsorted(begins, begin, "right")) - 1
                        shift = int(begin - begins[text])
                        found[text] += [(start + shift, length, period) for start, length, period in runs]
                        kept[begin:end] &= ~_dropped(runs, int(end - begin))
                owner = np.repeat(np.arange(rows), np.diff(begins))
                structs = [
                    [{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(row, rows),
                        pa.array(np.diff(begins), pa.int64()),
                        pa.array(structs, _RUN_TYPE),
                        _joined_words(data, starts, ends, owner, kept, rows).cast(pa.string()),
                    ],
                    ["id", "n_words", "runs", "collapsed"],
                )

    return run


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = LEAST_WORDS,
    repeats: int = REPEATS,
) -> DataFrame:
    """(id, n_words, runs, collapsed) for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  ``runs`` holds (start, length,
    period) by start, then period; ``collapsed`` is the text without the words that
    any run holds after its first period, joined by one space.

    A null or empty text, and one of separators only, has no words, no runs and
    an empty ``collapsed``.  Rows are worked on one by one: repeated rows and ids
    and a null id change nothing.  Two runs that begin at the same word (ties) are
    ordered by period.  Columns other than the two are not read, whatever their
    names.  There is no shuffle; a text of any length is one task's work.
    """
    if repeats < 3 or least_words < 2:
        raise ValueError("a run repeats at least three times and has two words or more")
    ship_package(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(
        _runs_of(least_words, repeats), f"id {kind}, n_words bigint, runs {_RUNS}, collapsed string"
    )
    return found.select(F.col("id").alias(id_col), "n_words", "runs", "collapsed")
