import random

import pytest
from conftest import in_order, physical_plan
from pyspark.sql import functions as F

from tamiz.operators import histogram, quality, rules, slices
from tamiz.operators.membership import BUCKET_BYTES, key_filter
from tamiz.operators.repeats import RepeatLimits, drop_copies, flag_repeats

# --- rules --------------------------------------------------------------------


def test_messages_keep_rule_order_and_null_conditions_do_not_hold(spark):
    rows = spark.createDataFrame([(0, 1, None), (1, 5, 5), (2, 9, 1)], "n int, a int, b int")
    found = [
        rules.Rule(F.col("b") > 3, F.lit("b alto")),
        rules.Rule(F.col("a") > 3, F.lit("a alto")),
    ]
    judged = rows.select(
        "n",
        rules.any_holds(found).alias("alguno"),
        rules.all_messages(found).alias("notas"),
    )
    assert in_order(judged, "alguno", "notas") == [
        (False, None),
        (True, "b alto; a alto"),
        (True, "a alto"),
    ]


def test_first_reject_wins_and_split_loses_nothing(spark):
    rows = spark.createDataFrame(
        [(0, "x", None), (1, "a", None), (2, "a", 1), (3, None, 1)], "n int, t string, v int"
    )
    judged = rules.with_outcome(
        rows,
        [
            rules.Reject(rules.not_in(F.col("t"), ("a",)), F.lit("tipo"), "Cat"),
            rules.Reject(F.col("v").isNull(), F.lit("valor"), "Amt"),
        ],
    )
    assert [r for (r,) in in_order(judged, "reject_reason")] == [
        "Cat: tipo",
        "Amt: valor",
        None,
        "Cat: tipo",
    ]
    kept, rejected = rules.split(judged)
    assert [n for (n,) in in_order(kept, "n")] == [2]
    assert [n for (n,) in in_order(rejected, "n")] == [0, 1, 3]


# --- repeats ------------------------------------------------------------------


def skewed_rows(spark, how_many=6000, seed=7):
    """A third of the rows on one key, a sixth without key, the rest spread."""
    pick = random.Random(seed)
    rows = []
    for seq in pick.sample(range(10 * how_many), how_many):
        roll = pick.random()
        key = "hot" if roll < 1 / 3 else None if roll < 1 / 2 else f"k{pick.randrange(how_many)}"
        rows.append((seq, key))
    return spark.createDataFrame(rows, "seq long, clave string").repartition(8), rows


def brute_force_flags(rows):
    first = {}
    for seq, key in sorted(rows):
        first.setdefault(key, seq)
    return {seq: key is not None and seq > first[key] for seq, key in rows}


LIMITS = {
    "all broadcast": RepeatLimits(),
    "hot keys broadcast, the rest joined": RepeatLimits(broadcast_bytes=500, hot_rows=50),
    "nothing broadcast": RepeatLimits(broadcast_bytes=0, hot_rows=10_000),
    "hot keys do not fit either": RepeatLimits(broadcast_bytes=40, hot_rows=2),
}


@pytest.mark.parametrize("limits", LIMITS.values(), ids=LIMITS)
def test_flag_repeats_is_the_same_by_every_route(spark, limits):
    frame, rows = skewed_rows(spark)
    flagged = flag_repeats(frame, "clave", "seq", "repetida", limits)
    assert flagged.columns == ["seq", "clave", "repetida"]
    assert {r["seq"]: r["repetida"] for r in flagged.collect()} == brute_force_flags(rows)


def test_flag_repeats_spreads_rows_without_a_match(spark):
    """On the shuffle route neither the NULL key nor a hot key may gather in
    one partition."""
    frame, _ = skewed_rows(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        limits = RepeatLimits(broadcast_bytes=500, hot_rows=50)
        flagged = flag_repeats(frame, "clave", "seq", "repetida", limits)
        sizes = [r["count"] for r in flagged.groupBy(F.spark_partition_id()).count().collect()]
        plan = physical_plan(flagged)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Window" not in plan
    assert max(sizes) < 2 * sum(sizes) / 8


def test_flag_repeats_leaves_rows_unshuffled_when_few_keys_repeat(spark):
    frame, _ = skewed_rows(spark)
    plan = physical_plan(flag_repeats(frame, "clave", "seq"))
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan and "Window" not in plan


def test_flag_repeats_of_nothing(spark):
    empty = spark.createDataFrame([], "seq long, clave string")
    assert flag_repeats(empty, "clave", "seq").count() == 0


def test_drop_copies_keeps_the_first_spelling_and_counts(spark):
    pick = random.Random(3)
    rows = []
    for seq in pick.sample(range(50_000), 5000):
        name = "same" if pick.random() < 1 / 3 else f"n{pick.randrange(900)}"
        rows.append((seq, pick.choice([name, name.upper()]), str(pick.randrange(3))))
    frame = spark.createDataFrame(rows, "seq long, a string, b string").repartition(8)
    expected = {}
    for seq, a, b in sorted(rows):
        row = expected.setdefault((a.lower(), b), [seq, a, b, 0])
        row[3] += 1
    dropped = drop_copies(frame, [F.lower("a"), F.col("b")], "seq", "copias")
    assert sorted(map(list, dropped.collect())) == sorted(expected.values())
    assert "Window" not in physical_plan(dropped)


@pytest.mark.parametrize(
    "limits",
    [
        RepeatLimits(broadcast_bytes=0),
        RepeatLimits(broadcast_bytes=0, hot_rows=50),
        RepeatLimits(broadcast_bytes=0, filter_bytes=0),
        RepeatLimits(broadcast_bytes=0, filter_bytes=2000, hot_rows=2),
    ],
)
def test_drop_copies_beyond_the_broadcast_limit(spark, limits):
    pick = random.Random(5)
    rows = []
    for seq in pick.sample(range(90_000), 6000):
        name = "same" if pick.random() < 1 / 3 else pick.choice([None, f"n{pick.randrange(9000)}", ""])
        # Rows with a null in one place or in the other have equal hashes.
        rows.append((seq, *pick.choice([(name, "x"), ("x", name), (name, None), (None, name)])))
    frame = spark.createDataFrame(rows, "seq long, a string, b string").repartition(8)
    expected = {}
    for seq, a, b in sorted(rows):
        row = expected.setdefault((a and a.lower(), b), [seq, a, b, 0])
        row[3] += 1
    dropped = drop_copies(frame, [F.lower("a"), F.col("b")], "seq", "copias", limits)
    in_seq = lambda row: row[0]
    assert sorted(map(list, dropped.collect()), key=in_seq) == sorted(expected.values(), key=in_seq)
    assert dropped.columns == ["seq", "a", "b", "copias"]


def test_drop_copies_shuffles_possible_copies_only(spark, tmp_path):
    """30,000 lines alone, 3,000 twice, one key 9,000 times."""
    unique = spark.range(30_000).selectExpr("id as seq", "concat('u', id) as a")
    twice = spark.range(6000).selectExpr("id + 30000 as seq", "concat('t', id % 3000) as a")
    hot = spark.range(9000).selectExpr("id + 36000 as seq", "'hot' as a")
    unique.union(twice).union(hot).repartition(4).write.parquet(str(tmp_path / "rows"))
    frame = spark.read.parquet(str(tmp_path / "rows"))
    limits = RepeatLimits(broadcast_bytes=0, hot_rows=1000)
    dropped = drop_copies(frame, [F.col("a")], "seq", "copias", limits)
    assert [tuple(r) for r in dropped.groupBy("copias").count().orderBy("copias").collect()] == [
        (1, 30_000), (2, 3000), (9000, 1)
    ]
    dropped.collect()
    plan = dropped._jdf.queryExecution().executedPlan().executedPlan()
    while plan.nodeName() != "Union":
        plan = plan.plan() if plan.nodeName() == "ResultQueryStage" else plan.children().apply(0)
    alone, open_rows = (plan.children().apply(side) for side in (0, 1))
    assert "Exchange hashpartitioning" not in alone.toString()
    written = shuffled_rows(open_rows)
    # Both sides of the join: keys that repeat, and rows that may be one of them.
    assert 0 < written < 3001 + 6001 + 0.05 * 30_000


def shuffled_rows(plan):
    """Rows that the exchanges of an executed plan wrote."""
    if plan.nodeName() in ("AdaptiveSparkPlan",):
        return shuffled_rows(plan.executedPlan())
    if plan.nodeName() in ("ShuffleQueryStage", "AQEShuffleRead", "BroadcastQueryStage"):
        inner = plan.child() if plan.nodeName() == "AQEShuffleRead" else plan.plan()
        return shuffled_rows(inner)
    found = 0
    if plan.nodeName() == "Exchange":
        found = plan.metrics().apply("shuffleRecordsWritten").value()
    return found + sum(shuffled_rows(plan.children().apply(side)) for side in range(plan.children().size()))


def test_key_filter_finds_every_key_and_few_others(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("h"))
    known = key_filter(keys, F.col("h"), 20_000, 32 << 20)
    flagged = known.flag(spark.range(60_000), F.xxhash64("id"), "posible")
    assert flagged.where("id < 20000 and not posible").isEmpty()
    assert flagged.where("id >= 20000 and posible").count() < 0.02 * 40_000
    # It never grows beyond what it may have, and none is found in an empty one.
    assert key_filter(keys, F.col("h"), 20_000, 10 * BUCKET_BYTES).table.count() == 10
    none = key_filter(keys.limit(0), F.col("h"), 0, 0)
    assert none.flag(spark.range(5), F.xxhash64("id"), "posible").where("posible").isEmpty()


# --- slices -------------------------------------------------------------------


def test_row_ranges():
    assert slices.row_ranges(10, 4) == [(1, 3), (4, 6), (7, 9), (10, 10)]
    assert slices.row_ranges(0, 4) == [(1, 0)]
    assert slices.row_ranges(2, 4) == [(1, 1), (2, 2)]
    assert slices.row_ranges(9, 4) == [(1, 3), (4, 6), (7, 9)]  # three slices, not four


@pytest.mark.parametrize("counted", [4, 64, 1 << 16])
@pytest.mark.parametrize("parts", [1, 4, 7])
def test_slices_agree_with_sorting(spark, monkeypatch, counted, parts):
    monkeypatch.setattr(slices, "_COUNTED", counted)
    pick = random.Random(counted * parts)
    seqs = pick.sample(range(400), 130) + pick.sample(range(10_000_000, 10_003_000), 50)
    frame = spark.createDataFrame([(seq,) for seq in seqs], "seq long")
    found = slices.slice_feed(frame, "seq", parts)
    size = -(-len(seqs) // parts)
    expected = {seq: place // size for place, seq in enumerate(sorted(seqs))}
    placed = frame.withColumn("slice", slices.slice_of(F.col("seq"), found))
    assert {r["seq"]: r["slice"] for r in placed.collect()} == expected
    assert [(s.first_row, s.last_row) for s in found] == slices.row_ranges(len(seqs), parts)


def test_slices_of_an_empty_feed(spark):
    found = slices.slice_feed(spark.createDataFrame([], "seq long"), "seq", 4)
    assert [(s.number, s.first_row, s.last_row) for s in found] == [(0, 1, 0)]


def test_slice_of_index(spark):
    rows = spark.range(10).withColumn("slice", slices.slice_of_index(F.col("id"), 10, 4))
    assert [r["slice"] for r in rows.orderBy("id").collect()] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3]


# --- quality ------------------------------------------------------------------


def gate(spark, rejects):
    rows = spark.createDataFrame(
        [(n, n < rejects) for n in range(10)], "n int, mala boolean"
    )
    return quality.rejects_by_slice(rows, F.lit(0), F.col("mala"), 3)


def test_gate_lets_exactly_the_limit_pass(spark):
    quality.enforce_gate(gate(spark, 3), 3)
    with pytest.raises(quality.QualityGateError, match="slice 0: 4"):
        quality.enforce_gate(gate(spark, 4), 3)


def test_counters_of_an_empty_feed(spark):
    nothing = spark.createDataFrame([], "copias long, rejected boolean")
    row = quality.run_counters("j", "s", nothing, F.col("rejected"), "copias").first()
    assert (row["leidos"], row["escritos"], row["filtrados"], row["total_saltados"]) == (0, 0, 0, 0)


def test_reject_log_truncates(spark):
    rows = spark.createDataFrame([(1, "r" * 2000, "i" * 2000)], "seq long, reject_reason string, i string")
    log = quality.reject_log(rows, "job", "step", F.col("i")).first()
    assert len(log["detalle_item"]) == len(log["mensaje_error"]) == 1000
    assert (log["job_name"], log["step_name"], log["etapa"]) == ("job", "step", "PROCESS")


def test_newest_first(spark):
    log = spark.sql(
        "select timestamp'2024-01-01 00:00:00' + make_dt_interval(id) as ocurrido_en, id "
        "from range(5)"
    )
    assert [r["id"] for r in quality.newest_first(log).collect()] == [4, 3, 2, 1, 0]


def test_rows_per_worker(spark):
    rows = spark.range(0, 100, 1, 5).withColumn("procesado_por_hilo", histogram.worker_name())
    counts = histogram.rows_per_worker(rows).collect()
    assert sorted((r["procesado_por_hilo"], r["cantidad"]) for r in counts) == [
        (f"particion-{n}", 20) for n in range(5)
    ]
