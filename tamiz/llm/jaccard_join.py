"""N-gram Jaccard join by count-vector R-trees.

A text is the set of its 5-word shingles (words ``[^\\x20\\x09-\\x0D]+``, A-Z
lower-cased; a text with fewer words is one shingle, a text without words has
none and links with nothing; nor does a row without id).  Two texts link when
``100 * |a & b| >= 75 * |a | b|``.

1. Shingles are hashed into groups.  The groups' document counts over the whole
   corpus (a table of fixed size) give every shingle the same global order,
   rare groups first.
2. Linked texts share one of the first ``n - ceil(0.75 n) + 1`` shingles of that
   order, so texts that share such a shingle form a block.  Blocks with the same
   texts are one block; texts with the same set are one node.  Common shingles
   come last in the order and so make no large blocks.
3. In a block each node is a point, its shingle counts by (coarser) group.  The
   points are packed into an R-tree.  The overlap of two points, or of all
   points in two boxes, is at most the sum of the coordinate minima (of the
   upper corners), and linked sets overlap by 3/7 of their sizes' sum, so pairs
   of boxes below that are left out with all their points.
4. Surviving pairs are verified on the shingle sets, a quarter of them first, and
   links united.

This is done twice: first every node against the oldest ones of its blocks, then,
only in blocks that still fall into several components, all nodes whose
components differ.  Near copies share many blocks, but no pair is written for
each of them: the first time (oldest, node) are made distinct before the trees;
the second time every node carries its smallest blocks, and a pair that has one
in common is left to the smallest.  A group above ``BLOCK_NODES`` nodes is cut into
parts and every pair of parts is its own task; no link is lost, no group is in one task.

A shingle is a 64-bit hash: two of n different ones collide with a probability
of about n^2 / 2^65.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tamiz.llm.components import components
from tamiz.llm.frames import Workspace, broadcast_if_small, forget_in_worker, scratch_of, whole_groups
from tamiz.llm.words import joined, mixed, text_slices, word_hashes

SHINGLE_WORDS = 5
#: Shingle groups whose document counts order the shingles, and coordinates of a point.
ORDER_GROUPS, POINT_GROUPS = 1 << 18, 256
#: Largest count a coordinate is kept with.
FULL = 0xFF
#: Points in a leaf of the tree, and children of an inner node.
FAN_OUT = 16
#: Largest array of the shingles of several texts that is sent to all tasks; a
#: larger one is joined by shuffle.
SHARED_BYTES = 48 << 20
#: Most nodes of a block, or of two parts of one, that one task holds.
BLOCK_NODES = 4096

#: Blocks that a node carries to tell which of its pairs were met in a smaller one.
CARRIED = 16

_U = np.uint64


def shingle_sets(column: pa.Array, size: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    for _, data, offsets in text_slices(column):
        words, begins = word_hashes(data, offsets)
        runs = joined(words, size)
        for begin, end in zip(begins[:-1], begins[1:]):
            if end - begin >= size:
                yield np.unique(runs[begin : end - size + 1])
            elif end > begin:
                yield joined(words[begin:end], end - begin)
            else:
                yield np.empty(0, _U)


def _count_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget_in_worker()
    counts = np.zeros(ORDER_GROUPS, np.int64)
    for batch in batches:
        sets = list(shingle_sets(batch.column(0)))
        if sets:
            group = (np.concatenate(sets) & _U(ORDER_GROUPS - 1)).astype(np.int64)
            counts += np.bincount(group, minlength=ORDER_GROUPS)
    groups = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(groups.astype(np.int32)), pa.array(counts[groups])], ["grp", "n"]
    )


def group_counts(texts: DataFrame) -> np.ndarray:
    """How many (text, shingle) pairs fall into each of the ``ORDER_GROUPS`` groups."""
    parts = texts.mapInArrow(_count_groups, "grp int, n bigint")
    # ORDER_GROUPS rows whatever the corpus.
    table = parts.groupBy("grp").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(ORDER_GROUPS, np.int64)
    counts[table["grp"].to_numpy()] = table["n"].to_numpy()
    return counts


def _point(shingles: np.ndarray) -> bytes:
    group = (mixed(shingles) % _U(POINT_GROUPS)).astype(np.int64)
    counts = np.bincount(group, minlength=POINT_GROUPS)
    return np.minimum(counts, FULL).astype(np.uint8).tobytes()


def _points(column: pa.ChunkedArray) -> np.ndarray:
    """Count vectors; a full count stands for any larger one, so bounds stay bounds."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), POINT_GROUPS)
    return np.where(raw == FULL, 1 << 30, raw).astype(np.int32)


def _node_of(shingles: np.ndarray) -> int:
    digest = hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _signatures(order) -> Callable:
    """(id, n_shingles, node, rare, point) of each text; the last three are null
    for an empty one and for a row without id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_in_worker()
        rank = order.value
        for batch in batches:
            sizes, nodes, rare, points = [], [], [], []
            named = batch.column(0).is_valid().to_pylist()
            for has_id, shingles in zip(named, shingle_sets(batch.column(1))):
                size = len(shingles)
                sizes.append(size)
                if not size or not has_id:
                    nodes.append(None), rare.append(None), points.append(None)
                    continue
                place = rank[(shingles & _U(ORDER_GROUPS - 1)).astype(np.int64)]
                needed = (75 * size + 99) // 100
                first = np.lexsort((shingles, place))[: size - needed + 1]
                nodes.append(_node_of(shingles))
                rare.append(shingles[first].view(np.int64))
                points.append(_point(shingles))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array(rare, pa.list_(pa.int64())),
                    pa.array(points, pa.binary()),
                ],
                ["id", "n_shingles", "node", "rare", "point"],
            )

    return run


# -- the tree ---------------------------------------------------------------


class CountTree:
    """An R-tree over count vectors, bulk-loaded by sort-tile over the sizes and
    the coordinates that differ most.  ``upper`` holds the upper corners and
    ``least`` the smallest set size of the nodes of each level, leaves first."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = self._tiled(points, sizes)
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.upper, self.least = [self.points], [self.sizes]
        while len(self.upper[-1]) > 1:
            cuts = np.arange(0, len(self.upper[-1]), FAN_OUT)
            self.upper.append(np.maximum.reduceat(self.upper[-1], cuts, axis=0))
            self.least.append(np.minimum.reduceat(self.least[-1], cuts))

    @staticmethod
    def _tiled(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Point order in which neighbours are alike: slabs by size, within a
        slab by the most varied coordinate, within those by the next one."""
        count = len(sizes)
        if count <= FAN_OUT:
            return np.arange(count)
        slabs = max(1, round((count / FAN_OUT) ** (1 / 3)))
        varied = np.argsort(-points.var(axis=0))[:2]
        slab = np.empty(count, np.int64)
        slab[np.argsort(sizes, kind="stable")] = np.arange(count) * slabs // count
        by_first = np.lexsort((points[:, varied[0]], slab))
        tile = np.empty(count, np.int64)
        tile[by_first] = np.arange(count) * slabs * slabs // count
        return np.lexsort((points[:, varied[1]], tile))

    def pairs_with(self, other: CountTree) -> tuple[np.ndarray, np.ndarray]:
        """Positions (in the points as given) of all pairs that the bound lets through,
        found by going down both trees together."""
        level_a, level_b = len(self.upper) - 1, len(other.upper) - 1
        a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while True:
            a, b = self._kept(other, level_a, level_b, a, b)
            if not len(a) or level_a == level_b == 0:
                return self.order[a], other.order[b]
            if level_a >= level_b:
                level_a -= 1
                a, b = _children(a, b, len(self.upper[level_a]))
            else:
                level_b -= 1
                b, a = _children(b, a, len(other.upper[level_b]))

    def _kept(self, other: CountTree, level_a: int, level_b: int, a: np.ndarray, b: np.ndarray):
        upper_a, upper_b = self.upper[level_a], other.upper[level_b]
        least_a, least_b = self.least[level_a], other.least[level_b]
        keep = np.empty(len(a), bool)
        for at in range(0, len(a), 16384):
            x, y = a[at : at + 16384], b[at : at + 16384]
            most = np.minimum(upper_a[x], upper_b[y]).sum(axis=1, dtype=np.int64)
            keep[at : at + 16384] = 175 * most >= 75 * (least_a[x] + least_b[y])
        if self is other and level_a == level_b:
            keep &= a < b if level_a == 0 else a <= b
        return a[keep], b[keep]


def _children(parents: np.ndarray, others: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    below = parents[:, None] * FAN_OUT + np.arange(FAN_OUT)
    others = np.broadcast_to(others[:, None], below.shape)
    real = below < count
    return below[real], others[real]


_PAIRS = "a bigint, b bigint"


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _met_before(first: np.ndarray, other: np.ndarray, block: int) -> np.ndarray:
    """Whether two nodes both carry a block smaller than ``block``, by row; a pair
    of nodes is always left to the smallest block that holds both."""
    out = np.zeros(len(first), bool)
    for at in range(0, len(first), 4096):
        x, y = first[at : at + 4096, :, None], other[at : at + 4096, None, :]
        out[at : at + 4096] = ((x == y) & (x < block)).any(axis=(1, 2))
    return out


def _carried(column: pa.ChunkedArray) -> np.ndarray:
    """The blocks that each node carries, filled up with the largest number."""
    out = np.full((len(column), CARRIED), np.iinfo(np.int64).max)
    for row, blocks in enumerate(column.to_pylist()):
        out[row, : len(blocks)] = blocks
    return out


def _tree_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Surviving pairs of each block part, from rows (task, side, node, size,
    component, block, carried, point) sorted by task.  Sides 0 and 1 are joined with
    each other, or 0 with itself where there is no 1; pairs of one component are
    left out, and those that a smaller block holds."""
    forget_in_worker()
    for table in whole_groups(batches, "task"):
        task = table["task"].to_numpy()
        side, node = table["side"].to_numpy(), table["node"].to_numpy()
        size, component = table["size"].to_numpy(), table["component"].to_numpy()
        point, block = _points(table["point"]), table["block"].to_numpy()
        carried = _carried(table["carried"])
        cuts = np.flatnonzero(np.r_[True, task[1:] != task[:-1], True])
        found_a, found_b = [], []
        for begin, end in zip(cuts[:-1], cuts[1:]):
            here = np.arange(begin, end)
            left, right = here[side[here] == 0], here[side[here] == 1]
            if not len(left):
                continue
            tree = CountTree(point[left], size[left])
            if len(right):
                x, y = tree.pairs_with(CountTree(point[right], size[right]))
                x, y = left[x], right[y]
            else:
                x, y = tree.pairs_with(tree)
                x, y = left[x], left[y]
            open_pair = component[x] != component[y]
            x, y = x[open_pair], y[open_pair]
            here_first = ~_met_before(carried[x], carried[y], block[begin])
            found_a.append(node[x[here_first]])
            found_b.append(node[y[here_first]])
        if found_a:
            yield _pair_batch(np.concatenate(found_a), np.concatenate(found_b))


def _pairs(tasks: DataFrame, scratch: Workspace) -> DataFrame:
    rows = tasks.repartition("task").sortWithinPartitions("task")
    return scratch.stage(rows.mapInArrow(_tree_pairs, _PAIRS).distinct(), "pairs")


# -- verification -------------------------------------------------------------


def _packed(shingles: np.ndarray) -> bytes:
    """The upper 48 bits of each hash: two sets of n shingles meet in a false one
    with a probability of n^2 / 2^48."""
    return np.ascontiguousarray(shingles.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def _unpacked(held: pa.Scalar) -> np.ndarray:
    whole = np.zeros((len(held.as_buffer()) // 6, 8), np.uint8)
    whole[:, 2:] = np.frombuffer(held.as_buffer(), np.uint8).reshape(-1, 6)
    return whole.view("<u8").ravel()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of each text that is the node asked for (ids may repeat), once per task."""
    forget_in_worker()
    done: set[int] = set()
    for batch in batches:
        nodes, quarter, rest = [], [], []
        for node, shingles in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1))):
            if node not in done and len(shingles) and _node_of(shingles) == node:
                done.add(node)
                nodes.append(node)
                first = (shingles & _U(3)) == 0
                quarter.append(_packed(shingles[first]))
                rest.append(_packed(shingles[~first]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array(quarter, pa.binary()), pa.array(rest, pa.binary())],
            ["node", "quarter", "rest"],
        )


def _met(x: pa.Scalar, y: pa.Scalar) -> tuple[int, int, int]:
    x, y = _unpacked(x), _unpacked(y)
    return len(np.intersect1d(x, y)), len(x), len(y)


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that can still link once a quarter of their shingles is compared:
    of the rest at most all of the smaller one are shared."""
    forget_in_worker()
    for batch in batches:
        kept, shared = [], []
        columns = [batch.column(name) for name in ("x", "y", "x_rest", "y_rest")]
        for x, y, x_rest, y_rest in zip(*columns):
            both, a, b = _met(x, y)
            x_rest, y_rest = x_rest.as_py(), y_rest.as_py()
            most = both + min(x_rest, y_rest)
            kept.append(100 * most >= 75 * (a + b + x_rest + y_rest - most))
            shared.append([both, a + b - both])
        keep = pa.array(kept, pa.bool_())
        shared = np.array(shared, np.int64).reshape(-1, 2)[np.array(kept, bool)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("a").filter(keep), batch.column("b").filter(keep), pa.array(shared[:, 0]), pa.array(shared[:, 1])],
            ["a", "b", "both", "either"],
        )


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose whole sets pass the threshold."""
    forget_in_worker()
    for batch in batches:
        keep = []
        columns = [batch.column(name) for name in ("x", "y", "both", "either")]
        for x, y, both, either in zip(*columns):
            more, a, b = _met(x, y)
            keep.append(100 * (both.as_py() + more) >= 75 * (either.as_py() + a + b - more))
        keep = pa.array(keep, pa.bool_())
        yield _pair_batch(batch.column("a").filter(keep), batch.column("b").filter(keep))


def _beside(pairs: DataFrame, sets: DataFrame, part: str, scratch: Workspace) -> DataFrame:
    """The pairs with ``part`` of both sets, as x and y.  The pairs go to the sets
    of their second nodes, and from there to those of their first ones."""
    size = (F.octet_length("rest") / 6).cast("bigint")
    with_b = sets.select(F.col("node").alias("b"), F.col(part).alias("y"), size.alias("y_rest")).join(
        broadcast_if_small(pairs, 32), "b"
    )
    centres = scratch.stage(pairs.select(F.col("a").alias("node")).distinct(), "centres")
    first = sets.join(broadcast_if_small(centres, 8), "node", "left_semi")
    return with_b.join(first.select(F.col("node").alias("a"), F.col(part).alias("x"), size.alias("x_rest")), "a")


def _verified(pairs: DataFrame, sets: DataFrame, scratch: Workspace) -> DataFrame:
    """The pairs that link: compared on a quarter of the shingles, which leaves out
    most others without moving their whole sets, then on the rest."""
    quarter = _beside(pairs, sets, "quarter", scratch).select("a", "b", "x", "y", "x_rest", "y_rest")
    possible = scratch.stage(
        quarter.mapInArrow(_possible, "a bigint, b bigint, both bigint, either bigint"), "possible"
    )
    whole = _beside(possible, sets, "rest", scratch).select("a", "b", "x", "y", "both", "either")
    return scratch.stage(whole.mapInArrow(_linked, _PAIRS), "links")


# -- the operator -------------------------------------------------------------


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id that links reach, itself included.  Null
    and empty texts have no shingles and are components of their own; a row
    without id has its ``n_shingles`` and no component.  Rows that repeat are
    separate rows of one component.
    Columns other than the two are not read, whatever their names.
    """
    scratch = scratch_of(docs)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = group_counts(texts.select("text"))
    order = docs.sparkSession.sparkContext.broadcast(counts)
    kind = dict(texts.dtypes)["id"]
    signatures = scratch.stage(
        texts.mapInArrow(
            _signatures(order),
            f"id {kind}, n_shingles bigint, node bigint, rare array<bigint>, point binary",
        ),
        "signatures",
    )
    rows = scratch.stage(signatures.drop("rare"), "rows")
    links = _links(texts, rows, signatures.where("node is not null").select("node", "rare"), scratch)
    united = components(links, "a", "b", scratch)
    return _labelled(rows, united, id_col, scratch)


def _only_known(shared) -> Callable:
    """(shingle, node) for the shingles that are in a sorted array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            lists = batch.column("rare")
            values = lists.flatten().to_numpy()
            owner = np.repeat(batch.column("node").to_numpy(), pc.list_value_length(lists).to_numpy())
            if len(known):
                hit = known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values
                yield pa.RecordBatch.from_arrays([pa.array(values[hit]), pa.array(owner[hit])], ["shingle", "node"])

    return run


def _links(texts: DataFrame, rows: DataFrame, signed: DataFrame, scratch: Workspace) -> DataFrame:
    """(a, b) links that connect whatever links there are; ``signed`` has (node, rare)."""
    postings = signed.select(F.explode("rare").alias("shingle"), "node")
    # Most shingles occur once.  Counting alone keeps the one large shuffle narrow.
    shared = scratch.stage(
        postings.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("shingle"), "shared"
    )
    if shared.count() * 8 <= SHARED_BYTES:
        known = np.sort(shared.toArrow()["shingle"].to_numpy())
        sent = texts.sparkSession.sparkContext.broadcast(known)
        postings = signed.mapInArrow(_only_known(sent), "shingle bigint, node bigint")
    else:
        postings = postings.join(shared, "shingle")
    postings = scratch.stage(postings, "postings")
    blocks = postings.groupBy("shingle").agg(
        F.min("node").alias("low"), F.max("node").alias("high"),
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(F.shiftright("node", by).bitwiseAND(F.lit((1 << 31) - 1))).alias(f"mark_{by}") for by in (0, 31)],
    ).where("low < high")
    # Near copies share many rare shingles: one block stands for all with the same texts.
    blocks = scratch.stage(
        blocks.groupBy("low", "high", "rows", "mark_0", "mark_31").agg(F.min("shingle").alias("block")), "blocks"
    )
    scratch.drop("shared", "signatures")
    of_two = blocks.where("rows = 2").select("block", F.explode(F.array("low", "high")).alias("node"))
    larger = blocks.where("rows > 2").select("block")
    members = postings.join(
        broadcast_if_small(larger, 16), F.col("shingle") == F.col("block")
    ).select("block", "node").distinct()
    members = scratch.stage(of_two.unionByName(members), "members")
    nodes = rows.where("node is not null").join(
        broadcast_if_small(scratch.stage(members.select("node").distinct(), "met"), 16), "node", "left_semi"
    ).groupBy("node").agg(
        F.min("id").alias("oldest"), F.first("n_shingles").alias("size"), F.first("point").alias("point")
    )
    nodes = scratch.stage(nodes, "nodes")
    scratch.drop("postings")
    members = scratch.stage(members.join(nodes.select("node", "oldest"), "node"), "members")
    heads = members.groupBy("block").agg(
        F.count(F.lit(1)).alias("nodes"),
        F.min_by("node", F.struct(F.col("oldest").isNull(), "oldest", "node")).alias("centre"),
    )
    members = scratch.stage(_with_heads(members, scratch.stage(heads, "heads")), "members")

    first = _pairs(_first_tasks(members, nodes, scratch), scratch)
    met = first.select(F.explode(F.array("a", "b")).alias("node"))
    sets = _sets_of(texts, rows, met, scratch)
    links = _verified(first, sets, scratch)
    scratch.drop("sets")

    # Larger blocks that the first links leave in pieces.
    large = members.where(F.col("nodes") > 2)
    labels = components(links, "a", "b", scratch)
    large = large.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    torn = large.groupBy("block").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low < high").select("block")
    torn = broadcast_if_small(scratch.stage(torn, "torn"), 8)
    open_members = scratch.stage(large.join(torn, "block", "left_semi"), "open")
    second = _pairs(_second_tasks(open_members, nodes), scratch)
    if second.isEmpty():
        return links
    sets = _sets_of(texts, rows, second.select(F.explode(F.array("a", "b")).alias("node")), scratch)
    return links.unionByName(_verified(second, sets, scratch))


def _with_heads(members: DataFrame, heads: DataFrame) -> DataFrame:
    """The members with their block's size and oldest node.  Where the blocks are too many
    to send to all tasks, that is done for large blocks only (a part of the members
    by ``BLOCK_NODES`` at most), so no block of any size is moved into one task."""
    small = broadcast_if_small(heads, 32)
    if small is not heads:
        return members.join(small, "block")
    large = heads.where(F.col("nodes") > BLOCK_NODES)
    of_large = members.join(broadcast_if_small(large, 32), "block")
    others = members.join(broadcast_if_small(large.select("block"), 16), "block", "left_anti")
    return of_large.unionByName(others.join(heads, "block"))


def _with_points(tasks: DataFrame, nodes: DataFrame) -> DataFrame:
    return tasks.join(nodes.select("node", "size", "point"), "node").select(
        "task", "side", "node", "size", "component", "block", "carried", "point"
    )


_NO_BLOCKS = "cast(array() as array<bigint>)"


def _first_tasks(members: DataFrame, nodes: DataFrame, scratch: Workspace) -> DataFrame:
    """Of every block the oldest node against the others, in slices.  The oldest one is
    mostly that of other blocks too, so pairs stay about as many as nodes."""
    pairs = members.where("node <> centre").select("centre", "node").distinct()
    pairs = scratch.stage(pairs, "first")
    crowds = scratch.stage(pairs.groupBy("centre").count().where(F.col("count") > BLOCK_NODES), "crowds")
    pairs = pairs.join(broadcast_if_small(crowds, 24), "centre", "left")
    parts = F.coalesce(F.ceil(F.col("count") / BLOCK_NODES), F.lit(1).cast("bigint"))
    others = pairs.select(
        F.xxhash64("centre", F.pmod(F.xxhash64("node"), parts)).alias("task"), F.lit(1).alias("side"), "node"
    )
    centre = pairs.select("centre", parts.alias("parts")).distinct().select(
        F.col("centre").alias("node"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part")
    ).select(F.xxhash64("node", "part").alias("task"), F.lit(0).alias("side"), "node")
    tasks = others.unionByName(centre).select(
        "*", F.col("node").alias("component"), F.lit(0).cast("bigint").alias("block"), F.expr(_NO_BLOCKS).alias("carried")
    )
    return _with_points(tasks, nodes)


def _second_tasks(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every pair of parts (i <= j) of each block as a task of its own."""
    parts = F.ceil(F.col("nodes") / (BLOCK_NODES // 2))
    # As many blocks as a text has rare shingles at most.
    carried = members.groupBy("node").agg(
        F.slice(F.array_sort(F.collect_set("block")), 1, CARRIED).alias("carried")
    )
    cut = members.select("block", "node", "component", parts.alias("parts"), F.pmod(F.xxhash64("node"), parts).alias("part"))
    with_part = cut.select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("other")
    )
    low, high = F.least("part", "other"), F.greatest("part", "other")
    tasks = with_part.select(
        F.xxhash64("block", low, high).alias("task"),
        (F.col("part") > F.col("other")).cast("int").alias("side"),
        "node", "component", "block",
    )
    return _with_points(tasks.join(carried, "node"), nodes)


def _sets_of(texts: DataFrame, rows: DataFrame, met: DataFrame, scratch: Workspace) -> DataFrame:
    """Shingle sets of the nodes in ``met``, each from one of its texts, read again."""
    met = scratch.stage(met.distinct(), "met")
    chosen = rows.join(broadcast_if_small(met, 16), "node", "left_semi")
    chosen = scratch.stage(chosen.groupBy("node").agg(F.min("id").alias("id")), "chosen")
    wanted = texts.join(broadcast_if_small(chosen, 24), "id")
    sets = wanted.select("node", "text").mapInArrow(_sets, "node bigint, quarter binary, rest binary")
    sets = scratch.stage(sets, "sets")
    # Only rows that repeat whole give a node twice; sets are wide, so they are not shuffled without need.
    unique = sets.groupBy("node").count().where("count > 1").isEmpty()
    return sets if unique else scratch.stage(sets.dropDuplicates(["node"]), "sets")


def _labelled(rows: DataFrame, united: DataFrame, id_col: str, scratch: Workspace) -> DataFrame:
    found = rows.select("id", "n_shingles", "node")
    smallest = found.where("node is not null").groupBy("node").agg(
        F.min("id").alias("low"), F.count(F.lit(1)).alias("rows")
    )
    linked = smallest.join(united, "node")
    of_component = linked.groupBy("component").agg(F.min("low").alias("component_id"))
    label = linked.join(of_component, "component").select("node", "component_id").unionByName(
        smallest.where("rows > 1").join(united, "node", "left_anti").select("node", F.col("low").alias("component_id"))
    )
    label = scratch.stage(label, "labels")
    labelled = found.join(broadcast_if_small(label, 32), "node", "left")
    return labelled.select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id")
    )
