"""Equal row ranges of a feed, found without sorting it.

A slice is a run of ``ceil(rows / slices)`` consecutive rows in feed order; the
last one may be shorter, and an empty feed has one empty slice.  Reading is
split by Spark on its own; slices are for rules that count per range of the
feed, such as the quality gate.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

_COUNTED = 1 << 16


@dataclass(frozen=True)
class Slice:
    number: int
    first_row: int  # 1-based, inclusive
    last_row: int
    last_seq: int | None  # sequence of the last row; None for an empty slice


def row_ranges(rows: int, slices: int) -> list[tuple[int, int]]:
    """1-based inclusive row ranges; ``[(1, 0)]`` for an empty feed."""
    if rows <= 0:
        return [(1, 0)]
    size = -(-rows // slices)
    return [(start, min(start + size - 1, rows)) for start in range(1, rows + 1, size)]


def slice_feed(feed: DataFrame, seq: str, slices: int) -> list[Slice]:
    """The slices of ``feed`` in ``seq`` order (unique, not negative, any gaps).

    Each boundary is the exact ``seq`` at a known rank.  It is narrowed down by
    histograms: one pass counts rows in equal-width ranges, the next looks only
    inside the ranges that hold a boundary, until a range is one value wide.
    A pass is a map-side combined count over one column; the driver sees at
    most ``_COUNTED`` counts, whatever the size of the feed.
    """
    rows, low, high = feed.agg(F.count(seq), F.min(seq), F.max(seq)).first()
    ranges = row_ranges(rows, slices)
    if rows == 0:
        return [Slice(0, 1, 0, None)]
    # Rank of each boundary -> (range it lies in, rows of the feed before that range).
    found = {last: (low, high, 0) for _, last in ranges[:-1]}
    while any(start < end for start, end, _ in found.values()):
        found = _narrow(feed, seq, found)
    ends = [found[last][0] for _, last in ranges[:-1]] + [high]
    return [
        Slice(number, first, last, end)
        for number, ((first, last), end) in enumerate(zip(ranges, ends))
    ]


def _narrow(feed: DataFrame, seq: str, found: dict) -> dict:
    """One histogram pass: every open range shrinks to one of its buckets."""
    open_ranges = sorted({(start, end) for start, end, _ in found.values() if start < end})
    buckets = max(2, _COUNTED // len(open_ranges))
    value = F.col(seq)
    number, bucket, inside = F.lit(None).cast("int"), F.lit(None).cast("long"), F.lit(False)
    widths = []
    for position, (start, end) in enumerate(open_ranges):
        width = -(-(end - start + 1) // buckets)
        widths.append(width)
        here = value.between(start, end)
        inside = inside | here
        number = F.when(here, F.lit(position)).otherwise(number)
        offset = F.call_function("div", value - F.lit(start), F.lit(width))
        bucket = F.when(here, offset).otherwise(bucket)
    counts = (
        feed.where(inside)
        .groupBy(number.alias("number"), bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    histograms = []
    for position in range(len(open_ranges)):
        filled = sorted((row["bucket"], row["rows"]) for row in counts if row["number"] == position)
        histograms.append(([b for b, _ in filled], list(accumulate(n for _, n in filled))))

    narrowed = {}
    for rank, (start, end, before) in found.items():
        if start < end:
            position = open_ranges.index((start, end))
            filled, upto = histograms[position]
            hit = bisect_left(upto, rank - before)
            first = start + filled[hit] * widths[position]
            last = min(first + widths[position] - 1, end)
            narrowed[rank] = (first, last, before + (upto[hit - 1] if hit else 0))
        else:
            narrowed[rank] = (start, end, before)
    return narrowed


def slice_of(seq: Column, slices: list[Slice]) -> Column:
    """Number of the slice a row lies in: a literal comparison, no join."""
    ends = [F.lit(part.last_seq) for part in slices[:-1]]
    return reduce(lambda total, end: total + (seq > end).cast("int"), ends, F.lit(0))


def slice_of_index(index: Column, rows: int, slices: int) -> Column:
    """The same for rows numbered 0, 1, 2 ... without gaps."""
    size = max(1, -(-rows // slices))
    return F.call_function("div", index, F.lit(size)).cast("int")


def slice_table(spark: SparkSession, slices: list[Slice]) -> DataFrame:
    """Slices as rows; their number is a setting, not a function of the data."""
    schema = StructType(
        [
            StructField(name, LongType(), False)
            for name in ("particion", "linea_inicial", "linea_final")
        ]
    )
    rows = [(part.number, part.first_row, part.last_row) for part in slices]
    return spark.createDataFrame(rows, schema)
