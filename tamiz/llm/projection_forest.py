"""Near-duplicate embeddings by a forest of random-projection trees.

Every tree splits the vectors by random directions, one for each level, near the
median of the node; vectors closer to the cut than ``SPILL`` (in units of
1/sqrt(dimensions)) go to both sides.  Vectors that share a leaf of any tree are
compared, in double precision; pairs from ``threshold`` on are links, and links
are united.  Pairs below are never linked, so only recall depends on the trees.

The depth follows the number of vectors, and the number of trees the depth, so
that a pair at the threshold is expected to share a leaf with ``RECALL``.  A node
is cut only where that saves more comparisons than it parts such pairs: a dense
group, whose spread is of the size of the margin, stays whole in one leaf.

The cuts are fitted on about ``SAMPLE`` vectors; all vectors are put into the
trees.  Where a node holds too few sampled ones, those of its nearest ancestor
with enough of them are used: such a cut does not follow the node, so it is as
likely to part a pair there as anywhere.  Equal vectors are one node.  A leaf
above ``LEAF_NODES`` nodes is cut into parts, and every pair of parts is a task of
its own.  A pair counts in the first leaf that holds both, so links are summed in
the tasks and never listed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tamiz.llm.components import components
from tamiz.llm.frames import broadcast_if_small, scratch_of, whole_groups
from tamiz.session import Scratch

#: Fewest trees, and the share of pairs at the threshold that the trees are to find.
TREES, RECALL, SPILL = 4, 0.95, 0.15
#: Where a node may be cut, and the most comparisons, as a share of those of the
#: uncut node, that a cut may leave after ``KEPT_POWER`` has weighed its losses.
QUANTILES, MOST_LEFT, KEPT_POWER = np.array([0.5, 0.4, 0.6, 0.3, 0.7, 0.2, 0.8, 0.1, 0.9]), 0.9, 2
#: Vectors a leaf is meant to hold, and most that one task holds of a leaf.
LEAF, LEAF_NODES = 600, 4096
SAMPLE, LEAST_SAMPLE = 20_000, 32
#: Share of a node's vectors that each side gets, spill included.
SIDE_SHARE = 0.57
SEED = 20_240_501


def _nodes(threshold_type: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            nodes, held, sizes = [], [], []
            for named, vector in zip(batch.column("id").is_valid().to_pylist(), column):
                values = None
                if named and vector.is_valid and len(vector.values) and not vector.values.null_count:
                    values = vector.values.to_numpy().astype(threshold_type)
                    if not np.isfinite(values).all() or not values.any():
                        values = None
                if values is None:
                    nodes.append(None), held.append(None), sizes.append(None)
                    continue
                raw = (values + 0.0).tobytes()  # -0.0 is 0.0
                digest = hashlib.blake2b(raw, digest_size=8).digest()
                nodes.append(int.from_bytes(digest, "little", signed=True))
                held.append(raw)
                sizes.append(len(values))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(held, pa.binary())],
                ["id", "node", "dims", "vector"],
            )

    return run


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Unit vectors in double precision."""
    raw = np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(np.float64)
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)  # squares cannot overflow
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


_Z = np.linspace(-8, 8, 4001)
_TAIL = np.array([0.5 * math.erfc(z / math.sqrt(2)) for z in _Z])


class Forest:
    """Directions of every level and cuts of every node of each tree; an infinite
    cut leaves the node whole."""

    def __init__(self, sample: np.ndarray, vectors: int, dims: int, threshold: float):
        self.depth = max(0, math.ceil(math.log(max(1, vectors) / LEAF) / -math.log(SIDE_SHARE)))
        self.margin = SPILL / math.sqrt(dims)
        #: Deviation, along a direction, of the difference of a pair at the threshold.
        self.apart = max(1e-12, math.sqrt(max(0.0, 2 - 2 * threshold) / dims))
        self.trees, self.least_kept = 1, 1.0
        if self.depth:
            normal = np.linspace(-4, 4, 2001)
            weight = np.exp(-normal * normal / 2)
            parted = (self._parted(normal / math.sqrt(dims), np.zeros(1))[:, 0] * weight).sum() / weight.sum()
            missed = 1 - (1 - parted) ** self.depth
            self.trees = max(TREES, math.ceil(math.log(1 - RECALL) / math.log(missed)) if missed else 1)
            self.least_kept = 1 - (1 - RECALL) ** (1 / self.trees)
        draw = np.random.default_rng([SEED, dims])
        self.directions = draw.standard_normal((self.trees, self.depth, dims))
        self.directions /= np.linalg.norm(self.directions, axis=2, keepdims=True)
        self.cuts = [self._fit(tree, sample) for tree in range(self.trees)]

    def _parted(self, along: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Chance that a cut puts a vector and its pair at the threshold on two sides."""
        off = np.abs(along[:, None] - cuts)
        return np.where(off > self.margin, np.interp((off + self.margin) / self.apart, _Z, _TAIL), 0.0)

    def _fit(self, tree: int, sample: np.ndarray) -> list[np.ndarray]:
        along = sample @ self.directions[tree].T
        whole = (None, 0.0)
        nodes, cuts = [(np.arange(len(sample)), 1.0)], []
        for level in range(self.depth):
            cut, below, known = np.full(len(nodes), np.inf), [], {}
            for node, (rows, kept) in enumerate(nodes):
                found = None
                if rows is not None:
                    if id(rows) not in known:  # nodes below the same ancestor
                        known[id(rows)] = self._cut(along[rows, level], kept)
                    found = known[id(rows)]
                if found is None:
                    below += [whole, whole]
                    continue
                cut[node], kept = found
                past = along[rows, level] - cut[node]
                for side in (rows[past <= self.margin], rows[past >= -self.margin]):
                    below.append((side if len(side) >= LEAST_SAMPLE else rows, kept))
            cuts.append(cut)
            nodes = below
        return cuts

    def _cut(self, along: np.ndarray, kept: float) -> tuple[float, float] | None:
        """Where to cut a node, and the chance that a pair at the threshold is still
        together after that, or None if the node is to stay whole."""
        if not len(along):
            return None
        some = np.sort(along[:2000])
        at = QUANTILES * (len(some) - 1)
        cuts = (some[np.floor(at).astype(int)] + some[np.ceil(at).astype(int)]) / 2
        kept = kept * (stays := 1 - self._parted(some, cuts).mean(axis=0))
        low = np.searchsorted(some, cuts + self.margin, "right") / len(some)
        high = 1 - np.searchsorted(some, cuts - self.margin, "left") / len(some)
        left = np.where(kept < self.least_kept, np.inf, (low * low + high * high) / stays**KEPT_POWER)
        best = int(np.argmin(left))
        return (float(cuts[best]), float(kept[best])) if left[best] < MOST_LEFT else None

    def leaves(self, vectors: np.ndarray, trees: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(tree, rows, leaf of each): a row comes once for every leaf it is in."""
        for tree in range(self.trees if trees is None else trees):
            along = vectors @ self.directions[tree].T
            rows, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
            for level in range(self.depth):
                past = along[rows, level] - self.cuts[tree][level][node]
                low, high = past <= self.margin, past >= -self.margin
                rows = np.concatenate([rows[low], rows[high]])
                node = np.concatenate([node[low] * 2, node[high] * 2 + 1])
            yield tree, rows, node


def _placed(shared, kind: str, with_vectors: bool) -> Callable:
    """A row for every leaf that a node is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            for size in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == size))
                forest = shared.value[size]
                for first in range(0, part.num_rows, 2000):
                    some = part.slice(first, 2000)
                    for tree, rows, leaf in forest.leaves(_matrix(some.column("vector"), kind)):
                        key = (leaf * forest.trees + tree) * 65_536 + size % 65_536
                        columns = [pa.array(key)]
                        if with_vectors:
                            columns += [some.column(name).take(pa.array(rows)) for name in ("node", "rows", "vector")]
                        names = ["leaf", "node", "rows", "vector"][: len(columns)]
                        yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _linked(shared, threshold: float, kind: str) -> Callable:
    """(a, b, n) of each task: with ``b``, a link, of which there are enough to
    connect what the task connects; without, ``a`` is linked with ``n`` rows of
    other nodes.  A pair counts only in the first leaf that holds both nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "task"):
            task, leaf, side = (table[name].to_numpy() for name in ("task", "leaf", "side"))
            node, rows = table["node"].to_numpy(), table["rows"].to_numpy()
            vectors = table["vector"].combine_chunks()
            cuts = np.flatnonzero(np.r_[True, task[1:] != task[:-1], True])
            for begin, end in zip(cuts[:-1], cuts[1:]):
                if end - begin < 2:
                    continue
                here = np.arange(begin, end)
                sizes = np.array([len(v.as_buffer()) for v in vectors.slice(begin, end - begin)])
                halves = (side[here] == 1).any()
                for size in np.unique(sizes):
                    own = here[sizes == size]
                    matrix = _matrix(vectors.take(pa.array(own)), kind)
                    forest = shared.value[size // np.dtype(kind).itemsize]
                    left, right = np.flatnonzero(side[own] == 0), np.flatnonzero(side[own] == 1)
                    earlier, above = None, list(range(len(own)))
                    others, joins = np.zeros(len(own), np.int64), []
                    for x, y in _products(matrix, left, right if halves else None, threshold):
                        if earlier is None:
                            earlier = list(_earlier_leaves(forest, matrix, int(leaf[begin]) >> 16))
                        new = _first_met(x, y, earlier)
                        x, y = x[new], y[new]
                        for p, q in ((x, y), (y, x)):
                            others += np.bincount(p, rows[own[q]], len(own)).astype(np.int64)
                        joins += _spanning(x, y, above)
                    linked = np.flatnonzero(others)
                    if not len(linked):
                        continue
                    p, q = node[own[[x for x, _ in joins]]], node[own[[y for _, y in joins]]]
                    none = pa.nulls(len(linked), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate([np.minimum(p, q), node[own[linked]]])),
                            pa.concat_arrays([pa.array(np.maximum(p, q)), none]),
                            pa.array(np.concatenate([np.zeros(len(p), np.int64), others[linked]])),
                        ],
                        ["a", "b", "n"],
                    )

    return run


def _products(matrix: np.ndarray, left: np.ndarray, right: np.ndarray | None, threshold: float):
    """Row numbers of the pairs, in blocks; left with right, or left with itself if
    that is None."""
    other = left if right is None else right
    for first in range(0, len(left), 1024):
        x, y = np.nonzero(matrix[left[first : first + 1024]] @ matrix[other].T >= threshold)
        x = x + first
        if right is None:
            x, y = x[x < y], y[x < y]
        if len(x):
            yield left[x], other[y]


def _earlier_leaves(forest: Forest, matrix: np.ndarray, key: int) -> Iterator[np.ndarray]:
    """For every tree, a bit for each leaf before that of ``key`` a row is in."""
    last_leaf, last_tree = divmod(key, forest.trees)
    for tree, rows, leaf in forest.leaves(matrix, last_tree + 1):
        if tree == last_tree:
            rows, leaf = rows[leaf < last_leaf], leaf[leaf < last_leaf]
        leaves, number = np.unique(leaf, return_inverse=True)
        bits = np.zeros((len(matrix), -(-len(leaves) // 8)), np.uint8)
        np.bitwise_or.at(bits, (rows, number >> 3), (1 << (number & 7)).astype(np.uint8))
        if len(leaves):
            yield bits


def _first_met(x: np.ndarray, y: np.ndarray, earlier: list[np.ndarray]) -> np.ndarray:
    """Positions of the pairs that share none of the earlier leaves."""
    new = np.arange(len(x))
    for bits in earlier:
        step = max(1, (16 << 20) // bits.shape[1])
        met = [
            (bits[x[some]] & bits[y[some]]).any(axis=1)
            for some in (new[first : first + step] for first in range(0, len(new), step))
        ]
        new = new[~np.concatenate(met)] if met else new
    return new


def _spanning(x: np.ndarray, y: np.ndarray, above: list[int]) -> list[tuple[int, int]]:
    """Those of the pairs that connect what ``above`` does not yet; adds them there."""

    def root(n: int) -> int:
        while above[n] != n:
            above[n] = above[above[n]]
            n = above[n]
        return n

    joins = []
    first = np.unique(y, return_index=True)[1]  # one pair of each row leaves few others to try
    for rest in (False, True):
        if rest:
            label = np.array([root(n) for n in range(len(above))])
            first = np.flatnonzero(label[x] != label[y])
        for p, q in zip(x[first].tolist(), y[first].tolist()):
            low, high = sorted((root(p), root(q)))
            if low != high:
                above[high] = low
                joins.append((p, q))
    return joins


def near_embeddings(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row.

    ``n_links`` counts the other rows linked directly, copies among them.
    Vectors that are null, empty or zero, or hold null or non-finite components,
    and rows without id have no links; a vector links only with vectors of as
    many components.  Repeated rows are rows of one node.
    """
    scratch = scratch_of(vectors)
    spark = vectors.sparkSession
    kind = "<f4" if dict(vectors.dtypes)[vector_col] == "array<float>" else "<f8"
    source = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    if kind == "<f8":
        source = source.withColumn("vector", F.col("vector").cast("array<double>"))
    id_type = dict(source.dtypes)["id"]
    rows = scratch.stage(
        source.mapInArrow(_nodes(kind), f"id {id_type}, node bigint, dims int, vector binary"), "rows"
    )
    nodes = scratch.stage(
        rows.where("node is not null").groupBy("node").agg(
            F.min("id").alias("low"), F.count(F.lit(1)).alias("rows"),
            F.first("dims").alias("dims"), F.first("vector").alias("vector"),
        ),
        "nodes",
    )
    found = _links(nodes, threshold, kind, scratch)
    united = components(found.where("b is not null"), "a", "b", scratch)
    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    linked = nodes.select("node", "low", "rows").join(united, "node").join(links, "node")
    lowest = linked.groupBy("component").agg(F.min("low").alias("component_id"))
    linked = linked.join(lowest, "component").select("node", "component_id", (F.col("others") + F.col("rows") - 1).alias("n"))
    alone = nodes.where("rows > 1").join(united, "node", "left_anti").select(
        "node", F.col("low").alias("component_id"), (F.col("rows") - 1).alias("n")
    )
    label = scratch.stage(linked.unionByName(alone), "labels")
    found = rows.select("id", "node").join(broadcast_if_small(label, 40), "node", "left")
    component = F.coalesce("component_id", "id")
    return found.select(
        F.col("id").alias(id_col),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def _links(nodes: DataFrame, threshold: float, kind: str, scratch: Scratch) -> DataFrame:
    forests = {}
    for dims, count in nodes.groupBy("dims").count().collect():  # one row per vector length
        share = min(1 << 30, (SAMPLE << 30) // count)
        drawn = nodes.where((F.col("dims") == dims) & (F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < share))
        held = drawn.select("node", "vector").toArrow().sort_by("node")["vector"].combine_chunks()
        sample = _matrix(held, kind) if len(held) else np.empty((0, dims))
        forests[dims] = Forest(sample, count, dims, threshold)
    shared = nodes.sparkSession.sparkContext.broadcast(forests)
    slim = nodes.select("dims", "node", "rows", "vector")
    sizes = slim.mapInArrow(_placed(shared, kind, False), "leaf bigint").groupBy("leaf").count()
    large = scratch.stage(
        sizes.where(F.col("count") > LEAF_NODES).select(
            "leaf", F.ceil(F.col("count") / (LEAF_NODES // 2)).alias("parts")
        ),
        "large",
    )
    placed = slim.mapInArrow(
        _placed(shared, kind, True), "leaf bigint, node bigint, rows bigint, vector binary"
    ).join(broadcast_if_small(large, 24), "leaf", "left")
    parts = F.coalesce("parts", F.lit(1))
    part = F.pmod(F.xxhash64("node"), parts)
    cut = placed.select(
        "leaf", "node", "rows", "vector", part.alias("part"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("other"),
    )
    low, high = F.least("part", "other"), F.greatest("part", "other")
    tasks = cut.select(
        F.xxhash64("leaf", low, high).alias("task"), "leaf", (F.col("part") > F.col("other")).cast("int").alias("side"),
        "node", "rows", "vector",
    )
    near = tasks.repartition("task").sortWithinPartitions("task").mapInArrow(
        _linked(shared, threshold, kind), "a bigint, b bigint, n bigint"
    )
    return scratch.stage(near, "links")
