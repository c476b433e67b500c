"""Periodic runs against a brute force over all periods, and edge cases."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tamiz.llm")
pytest.importorskip("public_tokenizers")

from tamiz.llm import period_runs  # noqa: E402
from tamiz.llm.period_runs import periodic_runs, scan_lags, surviving_segments  # noqa: E402
from tamiz.llm.queries import QUERIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_runs(words, least=24, repeats=3):
    """Every lag over all words; a stretch with a smaller period was met at that one."""
    found, seen = [], set()
    for period in range(1, len(words) // repeats + 1):
        same = [words[n] == words[n + period] for n in range(len(words) - period)] + [False]
        begin = None
        for n, hit in enumerate(same):
            if hit and begin is None:
                begin = n
            if not hit and begin is not None:
                run = (begin, n + period)
                if n + period - begin >= max(least, repeats * period) and run not in seen:
                    seen.add(run)
                    found.append((begin, n + period - begin, period))
                begin = None
    return sorted(found)


def brute_collapsed(words, runs):
    dropped = {n for start, length, period in runs for n in range(start + period, start + length)}
    return " ".join(w for n, w in enumerate(words) if n not in dropped)


def made_words(rng):
    """A few words with planted repetitions, nested and side by side."""
    words = []
    while len(words) < rng.randrange(1, 400):
        kind = rng.randrange(5)
        base = [rng.choice("abcdefgh" if kind else "xyzuvw") + str(rng.randrange(1 + 3 * kind)) for _ in range(rng.randrange(1, 30))]
        times = rng.choice([1, 1, 2, 3, 3, 4, 9, 30])
        stretch = base * times
        if rng.random() < 0.3:  # a repetition of repetitions
            stretch = (stretch + [str(rng.random())] * rng.randrange(2)) * rng.choice([1, 3, 4])
        words += stretch[: rng.randrange(1, len(stretch) + 1)]
    return words


@pytest.mark.parametrize("seed", range(60))
def test_runs_equal_brute_force(seed):
    words = made_words(random.Random(seed))
    numbers = {w: n for n, w in enumerate(dict.fromkeys(words))}
    values = np.array([numbers[w] for w in words], np.uint64)
    found = []
    for begin, end in surviving_segments(values, np.array([0, len(values)])):
        found += [(s + begin, n, q) for s, n, q in scan_lags(values[begin:end])]
    assert sorted(found) == brute_runs(words)
    assert scan_lags(values) == brute_runs(words)  # splitting loses nothing


@pytest.mark.parametrize("least, repeats", [(2, 3), (5, 3), (24, 4), (60, 5)])
def test_other_lengths(least, repeats):
    rng = random.Random(least)
    for _ in range(15):
        words = made_words(rng)
        numbers = {w: n for n, w in enumerate(dict.fromkeys(words))}
        values = np.array([numbers[w] for w in words], np.uint64)
        assert scan_lags(values, least, repeats) == brute_runs(words, least, repeats)


def test_splitting_is_recursive_and_a_bound_on_rounds_changes_no_run(monkeypatch):
    # "x" is frequent in the text, but rare in every part that the single words leave.
    words = []
    for n in range(12):
        words += [f"only{n}", "x"] + ["a", "b", "c"] * 9
    numbers = {w: n for n, w in enumerate(dict.fromkeys(words))}
    values = np.array([numbers[w] for w in words], np.uint64)
    parts = surviving_segments(values, np.array([0, len(values)]))
    assert [(b - a) for a, b in parts] == [27] * 12
    monkeypatch.setattr(period_runs, "ROUNDS", 1)
    whole = surviving_segments(values, np.array([0, len(values)]))
    assert [(b - a) for a, b in whole] == [28] * 12
    for a, b in whole:
        assert [(s + a, n, q) for s, n, q in scan_lags(values[a:b])] == [(a + 1, 27, 3)]


def test_one_word_a_million_times():
    assert scan_lags(np.full(300_000, 7, np.uint64)) == [(0, 300_000, 1)]
    two = np.tile(np.arange(1000, dtype=np.uint64), 200)
    assert scan_lags(two) == [(0, 200_000, 1000)]


def test_small_blocks_of_positions_give_the_same(monkeypatch):
    monkeypatch.setattr(period_runs, "PAIRS", 7)
    monkeypatch.setattr(period_runs, "LONGEST", 0)
    for seed in range(100, 110):
        words = made_words(random.Random(seed))
        numbers = {w: n for n, w in enumerate(dict.fromkeys(words))}
        values = np.array([numbers[w] for w in words], np.uint64)
        assert scan_lags(values) == brute_runs(words)


def test_edges(spark):
    run = "q " * 30
    texts = [
        (1, None), (2, ""), (3, " \t\n\x0b "), (4, "a" * 100_000), (5, run), (5, run), (None, run),
        (6, "Ab " * 12 + "ab " * 12), (7, "é é " * 24 + "end"), (8, run + "z " + run),
        (9, "\x1c   " * 40), (10, "w " * 23), (11, "w " * 24),
    ]
    frame = spark.createDataFrame(
        [(i, t, 1, "x", 0) for i, t in texts], "doc_id bigint, text string, runs int, collapsed string, n_words int"
    )
    found = periodic_runs(frame).collect()
    assert len(found) == len(texts)
    want = []
    for i, text in texts:
        words = words_of(text)
        runs = brute_runs(words)
        want.append((i, len(words), runs, brute_collapsed(words, runs)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found]
    key = lambda row: (row[0] is None, row[0], row[3])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert periodic_runs(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(frame, repeats=2)


def test_no_shuffle(spark):
    from conftest import physical_plan

    frame = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert "Exchange" not in physical_plan(periodic_runs(frame))


def brute_row(doc_id, text):
    words = words_of(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        doc_id, len(runs), best[0], best[1], best[2],
        1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest(),
    )


def test_query_equals_brute_force(spark, tmp_path):
    """The registered query over a fixture: rewritten and other texts, ties, nulls."""
    rng = random.Random(11)
    rows = [(n, " ".join(made_words(rng))) for n in range(150)]
    rows += [(n, None) for n in range(150, 170)] + [(n, " \n ") for n in range(170, 190)]
    rows += [(n, ("k l " * 20 + f"stop{n} ") * 2) for n in range(190, 200)]  # two runs of one exponent
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 10
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    found = QUERIES["op12_periodic_runs"](spark, str(tmp_path)).select(*columns)
    assert [t for _, t in found.dtypes][:6] == ["bigint"] * 6
    assert sorted(tuple(r) for r in found.collect()) == sorted(brute_row(i, t) for i, t in rows)


def test_query_over_the_table(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").where(F.length("text") < 4000)
    want = {r.doc_id: brute_row(r.doc_id, r.text) for r in documents.collect()}
    found = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, SMALL).collect()}
    assert len(found) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for doc_id, row in want.items():
        assert tuple(found[doc_id])[:8] == row
