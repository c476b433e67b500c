"""Hard negatives by Fagin's threshold algorithm.

Every row is a vector of integers with a label; a row's score for an anchor is
their inner product.  For an anchor, its best rows of the same label are the
positives, and for each positive the best rows of other labels whose score lies
within a window around the positive's are its hard negatives.

Rows stand in blocks.  A block holds its vectors by row (for random access) and,
for every dimension, its rows sorted by that component (for sorted access).  For
one anchor the lists are read from the end at which the anchor's sign makes the
products largest, a few rows of every list at a time.  Rows that are met are
scored whole.  The threshold is the sum of the products at the depth reached: no
row that was not met scores more.  A window is settled once the threshold falls
strictly below its k-th best score (an equal score may still win by a smaller
id), or below its lower end; the block is left when all windows are settled.

Blocks are dealt to at most ``LANES`` lanes; a task takes one lane and one group of
anchors, and what it has found in its earlier blocks counts in the later ones.
So the rows between the two steps are anchors times lanes, whatever the size of
the table, and no task holds more than a group of anchors and one block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tamiz.llm.frames import Workspace, scratch_of

#: Rows of a block (an index of two bytes tells them apart), and anchors of a group.
BLOCK_ROWS, GROUP_ANCHORS = 8192, 4096
#: Most lanes that the blocks are dealt to.
LANES = 16
#: Rows read from every list before the threshold is looked at again.
STEP_ROWS = 64
#: Largest integers whose sums of products a double, and a long, hold exactly.
_DOUBLE, _LONG = 1 << 53, (1 << 63) - 1

_BLOCK = "block bigint, rows int, dims int, width int, row binary, id binary, label binary, vector binary, lists binary"
_HELD = ("rows", "dims", "width", "row", "id", "label", "vector", "lists")
_FOUND = "row bigint, slot int, id bigint, score bigint"


# -- blocks ---------------------------------------------------------------------


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors as rows; a shorter one is filled up with zeros."""
    out = np.zeros((len(column), dims), np.int64)
    lengths = np.diff(column.offsets.to_numpy())
    owner = np.repeat(np.arange(len(column)), lengths)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[owner, place] = column.flatten().to_numpy()
    return out


def _blocks(dims: int, block_rows: int) -> Callable:
    """One row for each block of a partition: ids, labels and vectors, and the rows
    of each dimension sorted by its component, ascending."""

    def close(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        vectors = _matrix(table.column("vector"), dims)
        lists = np.argsort(vectors, axis=0, kind="stable").T.astype("<u2")
        width = next(w for w in (2, 4, 8) if w == 8 or np.abs(vectors).max(initial=0) < 1 << (8 * w - 1))
        row = table.column("row").to_numpy()
        parts = [row, table.column("id").to_numpy(), table.column("label").to_numpy(), vectors.astype(f"<i{width}"), lists]
        arrays = [pa.array([int(row[0])]), *(pa.array([n], pa.int32()) for n in (len(row), dims, width))]
        arrays += [pa.array([part.tobytes()], pa.binary()) for part in parts]
        return pa.RecordBatch.from_arrays(arrays, ["block", *_HELD])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, block_rows - size))
                size += held[-1].num_rows
                batch = batch.slice(held[-1].num_rows)
                if size == block_rows:
                    yield close(held)
                    held, size = [], 0
        if held:
            yield close(held)

    return run


class Block:
    """The rows of one block for the threshold algorithm."""

    def __init__(self, row: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, lists: np.ndarray):
        self.row, self.id, self.label = row, ids, labels
        self.vectors = vectors
        self.lists = lists  # (dims, rows), ascending by the component
        self._reached = np.take_along_axis(vectors.T, lists.astype(np.int64), axis=1)

    @staticmethod
    def of(held: dict) -> Block:
        rows, dims = held["rows"], held["dims"]
        long = lambda name: np.frombuffer(held[name], "<i8")
        vectors = np.frombuffer(held["vector"], f"<i{held['width']}").astype(np.int64).reshape(rows, dims)
        lists = np.frombuffer(held["lists"], "<u2").reshape(dims, rows)
        return Block(long("row"), long("id"), long("label"), vectors, lists)

    def exact(self, largest: int) -> None:
        """Makes scores with anchors whose components are at most ``largest`` exact: doubles
        where they are, else longs, else Python's integers."""
        own = max(int(self.vectors.max(initial=0)), -int(self.vectors.min(initial=0)))
        most = own * largest * max(1, self.vectors.shape[1])
        kind = np.float64 if most < _DOUBLE else np.int64 if most <= _LONG else object
        self.vectors, self._reached = self.vectors.astype(kind), self._reached.astype(kind)

    def search(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[Best], step: int = STEP_ROWS) -> int:
        """Adds the block's ``allowed`` rows to the windows they belong to; returns how
        many rows were met."""
        rows = len(self.id)
        anchor = anchor.astype(self.vectors.dtype)
        used = np.flatnonzero(anchor)
        # The anchor's sign decides from which end a list is read.
        falling = anchor[used] > 0
        met = np.zeros(rows, bool)
        depth = 0
        while depth < rows:
            to = min(rows, depth + step)
            step *= 2  # few looks at the threshold, at most twice the rows that were needed
            fresh = np.zeros(rows, bool)
            fresh[self.lists[used[falling], rows - to : rows - depth].ravel()] = True
            fresh[self.lists[used[~falling], depth:to].ravel()] = True
            if not len(used):
                fresh[:], to = True, rows  # every row scores 0
            fresh &= ~met
            met |= fresh
            chosen = np.flatnonzero(fresh & allowed)
            if len(chosen):
                score = (self.vectors[chosen] @ anchor).astype(np.int64)
                for window in windows:
                    window.add(score, self.id[chosen])
            at = np.where(falling, rows - to, to - 1)
            threshold = int((self._reached[used, at] * anchor[used]).sum()) if len(used) else 0
            if all(window.settled(threshold) for window in windows):
                break
            depth = to
        return int(met.sum())


class Best:
    """The ``size`` best (score, id) from ``low`` to ``high``: higher scores first, then smaller ids."""

    def __init__(self, size: int, low: int | None = None, high: int | None = None):
        self.size, self.low, self.high = size, low, high
        self.score, self.id = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        keep = np.ones(len(score), bool)
        if self.low is not None:
            keep &= score >= self.low
        if self.high is not None:
            keep &= score <= self.high
        if len(self.score) == self.size:
            keep &= score >= self.score[-1]
        if not keep.any():
            return
        score, ids = np.concatenate([self.score, score[keep]]), np.concatenate([self.id, ids[keep]])
        first = np.lexsort((ids, -score))[: self.size]
        self.score, self.id = score[first], ids[first]

    def settled(self, threshold: int) -> bool:
        if self.low is not None and (threshold < self.low or (self.high is not None and self.low > self.high)):
            return True
        return len(self.score) == self.size and threshold < self.score[-1]


# -- the two searches --------------------------------------------------------------


def _largest(vectors: list) -> int:
    return max((abs(x) for vector in vectors for x in vector), default=0)


def _searched(size: int, same_label: bool, low: tuple[int, int], high: tuple[int, int]) -> Callable:
    """(row, slot, id, score): what one lane has for each of its anchors.  Rows come
    by cell, the cell's anchors before its blocks."""

    def windows_of(anchor: dict) -> list[Best]:
        if same_label:
            return [Best(size)]
        return [
            Best(size, -((-low[0] * score) // low[1]), (high[0] * score) // high[1]) for score in anchor["scores"]
        ]

    def finished(anchors: list, windows: list[list[Best]]) -> pa.RecordBatch:
        parts = [
            (anchor["row"], slot, best) for anchor, own in zip(anchors, windows) for slot, best in enumerate(own)
        ]
        counts = [len(best.id) for _, _, best in parts]
        whole = lambda arrays: np.concatenate([np.empty(0, np.int64), *arrays])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array([row for row, _, _ in parts], np.int64), counts)),
                pa.array(np.repeat(np.array([slot for _, slot, _ in parts], np.int32), counts)),
                pa.array(whole(best.id for _, _, best in parts)),
                pa.array(whole(best.score for _, _, best in parts)),
            ],
            ["row", "slot", "id", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, anchors, windows, vectors, largest = None, [], [], [], 0
        for batch in batches:
            for n in range(batch.num_rows):
                held = {name: batch.column(name)[n].as_py() for name in ("cell", "anchor", "held")}
                if held["cell"] != cell:
                    if anchors:
                        yield finished(anchors, windows)
                    cell, anchors, windows, vectors, largest = held["cell"], [], [], [], 0
                if held["anchor"] is not None:
                    anchors.append(held["anchor"])
                    windows.append(windows_of(held["anchor"]))
                    vectors.append(np.array(held["anchor"]["vector"], np.int64))
                    largest = max(largest, _largest([held["anchor"]["vector"]]))
                    continue
                block = Block.of(held["held"])
                block.exact(largest)
                for anchor, vector, own in zip(anchors, vectors, windows):
                    vector = np.pad(vector, (0, block.vectors.shape[1] - len(vector)))
                    same = block.label == anchor["label"]
                    allowed = same & (block.row != anchor["row"]) if same_label else ~same
                    if allowed.any():
                        block.search(vector, allowed, own)
        if anchors:
            yield finished(anchors, windows)

    return run


def _best(
    anchors: DataFrame, blocks: DataFrame, lanes: int, groups: int, size: int, search: Callable, scratch: Workspace
) -> DataFrame:
    """(row, slot, rank, id, score): the best of all lanes for every anchor's window."""
    lane = F.pmod(F.xxhash64("block"), F.lit(lanes))
    every = lambda name, count: F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
    anchor = F.struct("row", "label", "vector", *(["scores"] if "scores" in anchors.columns else [])).alias("anchor")
    held = F.struct(*_HELD).alias("held")
    asked = anchors.select(F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("group"), anchor, every("lane", lanes))
    kept = blocks.select(held, lane.cast("int").alias("lane"), every("group", groups), "block")
    cells = asked.select("group", "lane", "anchor", F.lit(None).cast(kept.schema["held"].dataType).alias("held"),
                         F.lit(-1).cast("bigint").alias("place")).unionByName(
        kept.select("group", "lane", F.lit(None).cast(asked.schema["anchor"].dataType).alias("anchor"), "held",
                    F.col("block").alias("place"))
    )
    cell = (F.col("group") * lanes + F.col("lane")).alias("cell")
    dealt = cells.select(cell, "place", "anchor", "held").repartition(groups * lanes, "cell")
    found = dealt.sortWithinPartitions("cell", "place").select("cell", "anchor", "held").mapInArrow(search, _FOUND)
    found = scratch.stage(found, "found")
    # At most ``size`` rows of each lane meet here.
    order = Window.partitionBy("row", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "vector",
    positives: int = 5,
    negatives: int = 10,
    low: tuple[int, int] = (30, 100),
    high: tuple[int, int] = (90, 100),
    block_rows: int = BLOCK_ROWS,
    group_anchors: int = GROUP_ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vector_col`` holds integers (array<bigint>).  An anchor's positives are the
    first ``positives`` other rows of its label; for each of them, the first
    ``negatives`` rows of other labels with
    ``low * positive_score <= negative_score <= high * positive_score`` are returned
    (``low`` and ``high`` as numerator and denominator).  Higher scores come first,
    equal ones (ties) by smaller id.

    Rows with a null id, label or vector, or a null in it, take no part.  A shorter
    vector stands for one that ends in zeros, an empty one scores 0 with all.  Rows
    are told apart as rows: copies of an anchor, its id included, are other rows of
    its label, and an anchor that stands there twice is two anchors with the same
    results.  Without anchors, other rows of a label, or rows in a window there is
    nothing to return.  An inner product that does not fit into a long raises.  Labels
    that are no integers are compared by 64-bit hashes.  Columns other than the three are not read, but by ``is_anchor``.
    """
    spark, scratch = rows.sparkSession, scratch_of(rows)
    whole = dict(rows.dtypes)[label_col] in ("tinyint", "smallint", "int", "bigint")
    label = F.col(label_col).cast("bigint") if whole else F.xxhash64(label_col)
    complete = ~F.exists(vector_col, lambda x: x.isNull())
    taking = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & complete)
    staged = taking.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("bigint").alias("id"),
        label.alias("label"),
        F.col(vector_col).cast("array<bigint>").alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    staged = scratch.stage(staged, "rows")
    count, asked, dims = staged.agg(F.count(F.lit(1)), F.count_if("is_anchor"), F.max(F.size("vector"))).first()
    result = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not asked:
        return spark.createDataFrame([], result)
    # Blocks are as full as the rows allow; a partition that is read alone may end with a smaller one.
    parts = staged.select("row", "id", "label", "vector").coalesce(max(1, math.ceil(count / block_rows)))
    blocks = scratch.stage(parts.mapInArrow(_blocks(dims, block_rows), _BLOCK), "blocks")
    lanes = min(LANES, blocks.count())
    groups = math.ceil(asked / group_anchors)
    anchors = staged.where("is_anchor").select("row", "id", "label", "vector")

    best = _best(anchors, blocks, lanes, groups, positives, _searched(positives, True, low, high), scratch)
    chosen = best.select("row", F.struct("rank", "id", "score").alias("positive")).groupBy("row").agg(
        F.array_sort(F.collect_list("positive")).alias("positives")  # at most ``positives`` of them
    )
    chosen = scratch.stage(chosen, "positives")
    with_scores = anchors.join(chosen, "row").select(
        "row", "label", "vector", F.col("positives.score").alias("scores")
    )
    found = _best(with_scores, blocks, lanes, groups, negatives, _searched(negatives, False, low, high), scratch)
    named = chosen.join(anchors.select("row", F.col("id").alias("anchor_id")), "row").select(
        "row", "anchor_id", F.posexplode("positives").alias("slot", "positive")
    )
    return found.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).join(named, ["row", "slot"]).select(
        "anchor_id",
        F.col("positive.id").alias("positive_id"),
        "rank",
        "negative_id",
        F.col("positive.score").alias("positive_score"),
        "negative_score",
    )
