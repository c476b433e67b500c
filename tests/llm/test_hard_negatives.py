"""Hard negatives against brute force over all rows, and edge cases."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tamiz.llm")
pytest.importorskip("public_tokenizers")

from tamiz.llm import hard_negatives as hn  # noqa: E402
from tamiz.llm.hard_negatives import Best, Block, hard_negatives  # noqa: E402
from tamiz.llm.oracle import ORACLE  # noqa: E402
from tamiz.llm.queries import QUERIES  # noqa: E402

MEDIUM, LARGE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
SCHEMA = "vec_id bigint, label string, vector array<bigint>, rank int, row string"


def brute(rows, is_anchor, positives=5, negatives=10, low=(30, 100), high=(90, 100)):
    taking = [r for r in rows if None not in r[:3] and None not in r[2]]
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    out = []
    for n, a in enumerate(taking):
        if not is_anchor(a):
            continue
        same = [(-score(a, b), b[0]) for m, b in enumerate(taking) if m != n and b[1] == a[1]]
        others = sorted((-score(a, b), b[0]) for b in taking if b[1] != a[1])
        for p, positive in sorted(same)[:positives]:
            inside = [(-s, i) for s, i in others if low[0] * -p <= low[1] * -s and high[1] * -s <= high[0] * -p]
            out += [(a[0], positive, r + 1, i, -p, s) for r, (s, i) in enumerate(inside[:negatives])]
    return sorted(out)


def made_rows(rng, count, dims=6, spread=9):
    return [
        (n, rng.choice("abc"), [rng.randrange(-spread, spread + 1) for _ in range(dims)], 1, "x") for n in range(count)
    ]


def found(frame, condition, **options):
    return sorted(tuple(r) for r in hard_negatives(frame, condition, **options).collect())


def test_ties_windows_and_lanes_equal_brute_force(spark):
    rows = made_rows(random.Random(1), 400, spread=3)  # few values: ties everywhere
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute(rows, lambda r: r[0] % 7 == 0)
    assert len(want) > 500
    assert found(frame, F.col("vec_id") % 7 == 0) == want
    # Many small blocks, several groups of anchors.
    assert found(frame, F.col("vec_id") % 7 == 0, block_rows=16, group_anchors=9) == want


def test_other_windows_and_counts(spark):
    rows = made_rows(random.Random(2), 150)
    frame = spark.createDataFrame(rows, SCHEMA)
    options = {"positives": 2, "negatives": 3, "low": (-1, 2), "high": (7, 5)}
    assert found(frame, F.col("vec_id") < 20, **options) == brute(rows, lambda r: r[0] < 20, **options)


def test_nulls_empty_short_repeated_and_huge(spark):
    rows = [
        (1, "a", [3, 4], 1, "x"), (1, "a", [3, 4], 1, "x"), (1, "b", [3, 3], 1, "x"), (2, "a", [1, 2, 9], 1, "x"),
        (3, "b", [2], 1, "x"), (4, "b", [], 1, "x"), (5, "a", [], 1, "x"), (6, None, [9, 9], 1, "x"),
        (None, "b", [2, 2], 1, "x"), (7, "b", None, 1, "x"), (8, "b", [2, None], 1, "x"), (9, "b", [-2, -2], 1, "x"),
        (10, "b", [2, 1], 1, "x"), (10, "b", [2, 1], 1, "x"), (11, "b", [1 << 31, 0], 1, "x"), (13, "a", [1, -(1 << 30)], 1, "x"), (12, "c", [0, 0], 1, "x"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert found(frame, F.lit(True)) == brute(rows, lambda r: True)
    assert found(frame, F.col("vec_id") == 5) == brute(rows, lambda r: r[0] == 5)
    assert found(frame, F.lit(False)) == found(frame.limit(0), F.lit(True)) == []
    assert found(frame, F.lit(None).cast("boolean")) == []
    with pytest.raises(Exception, match="OverflowError"):
        found(spark.createDataFrame([(1, "a", [1 << 40], 1, "x"), (2, "a", [1 << 40], 1, "x")], SCHEMA), F.lit(True))


def test_threshold_stops_early_and_exactly():
    """One row far ahead in every list is found without meeting the others."""
    rng = np.random.default_rng(3)
    vectors = rng.integers(0, 100, (5000, 4))
    vectors[77] = 1000
    lists = np.argsort(vectors, axis=0, kind="stable").T.astype("<u2")
    block = Block(np.arange(5000), np.arange(5000), np.zeros(5000, np.int64), vectors, lists)
    block.exact(3)
    best = Best(1)
    met = block.search(np.array([3, 2, 1, 1]), np.ones(5000, bool), [best])
    assert best.id.tolist() == [77] and met < 5000 / 4
    # With equal scores at the threshold the search goes on to the smaller id.
    same = np.full((300, 2), 5)
    lists = np.stack([np.arange(300), np.arange(300)]).astype("<u2")
    block = Block(np.arange(300), np.arange(300)[::-1].copy(), np.zeros(300, np.int64), same, lists)
    block.exact(1)
    best = Best(2)
    block.search(np.array([1, 1]), np.ones(300, bool), [best], step=1)
    assert best.id.tolist() == [0, 1]


def test_scores_beyond_doubles_are_exact(spark):
    rng = random.Random(5)
    rows = [(n, "ab"[n % 2], [rng.randrange(1 << 31) - (1 << 30) for _ in range(3)], 1, "x") for n in range(60)]
    rows.append((60, "a", [(1 << 62) + 1, 0, 0], 1, "x"))  # beyond a long with most rows, but not with the anchor
    rows.append((61, "b", [1, 0, 0], 1, "x"))
    frame = spark.createDataFrame(rows, SCHEMA)
    assert found(frame, F.col("vec_id") == 61) == brute(rows, lambda r: r[0] == 61)
    rows = rows[:60]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert found(frame, F.col("vec_id") < 6) == brute(rows, lambda r: r[0] < 6)


def test_rows_between_the_steps_do_not_multiply(spark):
    """Blocks beyond the lanes share them: what lanes return is bounded by the anchors."""
    rows = made_rows(random.Random(6), 600)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert hn.LANES <= 16
    assert found(frame, F.col("vec_id") % 60 == 0, block_rows=4) == brute(rows, lambda r: r[0] % 60 == 0)


@pytest.mark.parametrize("folder", [MEDIUM, LARGE])
def test_query_equals_sql(spark, folder):
    con = duckdb.connect()
    con.sql(f"create view embeddings as from '{folder}/embeddings.parquet'")
    result = QUERIES["op11_hard_negatives"](spark, folder)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert result.dtypes == [(n, "int" if n == "rank" else "bigint") for n in names]
    want = con.sql(ORACLE["op11_hard_negatives"]).fetchall()
    assert sorted(tuple(r) for r in result.collect()) == sorted(want) and want


def test_query_leaves_out_incomplete_vectors(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rng = random.Random(9)
    rows = [(n, [rng.uniform(-1, 1) for _ in range(4)], rng.randrange(10)) for n in range(300)]
    rows += [(300, None, 1), (400, [1.0, nan, 0.0, 0.0], 2), (500, [inf, 1.0, 1.0, 1.0], 3), (601, [None, 1.0], 4)]
    rows += [(700, [0.5, 0.5, 0.5, 0.5], None)]
    path = tmp_path / "embeddings.parquet"
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").coalesce(1).write.parquet(str(path))
    con = duckdb.connect()
    con.sql(f"create view embeddings as from '{path}/*.parquet'")
    result = QUERIES["op11_hard_negatives"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in result) == sorted(con.sql(ORACLE["op11_hard_negatives"]).fetchall()) and result
