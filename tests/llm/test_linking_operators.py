"""Jaccard join, embedding forest, URL filter, WARC and the pipeline against
brute force and edge cases."""

import base64
import gzip
import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tamiz.llm")
pytest.importorskip("public_tokenizers")

from tamiz.llm import components as united, jaccard_join, projection_forest, warc  # noqa: E402
from tamiz.llm.frames import scratch_of  # noqa: E402
from tamiz.llm.jaccard_join import CountTree, jaccard_components  # noqa: E402
from tamiz.llm.oracle import ORACLE  # noqa: E402
from tamiz.llm.projection_forest import near_embeddings  # noqa: E402
from tamiz.llm.queries import QUERIES, URL_RULES  # noqa: E402
from tamiz.llm.url_filter import BloomFilter, judge_urls  # noqa: E402
from tamiz.llm.warc import read_warc, salvage, write_warc  # noqa: E402

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def brute_components(nodes, links):
    above = {n: n for n in nodes}

    def root(n):
        while above[n] != n:
            n = above[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        above[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    links = [(n, n + 1) for n in range(100, 160)] + [(5, n) for n in range(20, 60)] + [(7, 7)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r.node: r.component for r in united.components(frame, "a", "b", scratch_of(frame)).collect()}
    want = brute_components({n for l in links for n in l}, links)
    assert found == {n: c for n, c in want.items() if n != 7}
    assert united.components(frame.limit(0), "a", "b", scratch_of(frame)).count() == 0


# -- Jaccard join --


def shingles(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
    if not words:
        return set()
    return {tuple(words[n : n + 5]) for n in range(max(1, len(words) - 4))}


def brute_jaccard(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = []
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    component = brute_components(ids, links)
    return {i: (len(sets[i]), component[i]) for i in ids}


def varied_texts(seed):
    """Originals, chains of edited copies, exact copies, and a passage in many texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 4)))
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(25):
        text = [word() for _ in range(rng.choice([3, 6, 30, 90, 300]))]
        texts.append(text)
        for _ in range(rng.choice([0, 1, 6, 20])):
            text = list(text)
            for _ in range(max(1, len(text) // rng.choice([20, 60, 200]))):
                text[rng.randrange(len(text))] = word()
            texts.append(text)
    texts += [passage + [word() for _ in range(rng.choice([2, 10, 40]))] for _ in range(40)]
    texts += [texts[0]] * 15
    rng.shuffle(texts)
    return [(n, " ".join(t) if n % 5 else "\t".join(t).upper()) for n, t in enumerate(texts)]


def near_copies(rng, copies, words=120, edits=6):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randrange(edits)):
            text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


def test_a_group_of_near_copies_writes_each_pair_about_once(spark, monkeypatch):
    """300 near copies share hundreds of blocks with slightly different members."""
    rng = random.Random(12)
    texts = near_copies(rng, 300) + near_copies(rng, 40, edits=20) + near_copies(rng, 3) + [f"own {n} text" for n in range(9)]
    rows = list(enumerate(texts))
    counted = []

    def pairs(tasks, scratch):
        raw = scratch.stage(
            tasks.repartition("task").sortWithinPartitions("task").mapInArrow(jaccard_join._tree_pairs, "a bigint, b bigint"),
            "raw",
        )
        found = raw.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        counted.append((raw.count(), found.count()))
        return raw.distinct()

    monkeypatch.setattr(jaccard_join, "_pairs", pairs)
    found = jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute_jaccard(rows)
    assert counted and all(raw <= 2 * distinct for raw, distinct in counted), counted


@pytest.mark.parametrize("limit", ["BLOCK_NODES", "BROADCAST_BYTES"])
def test_the_far_side_of_the_join_limits(spark, monkeypatch, limit):
    from tamiz.llm import frames

    monkeypatch.setattr(jaccard_join if limit == "BLOCK_NODES" else frames, limit, 8 if limit == "BLOCK_NODES" else 0)
    if limit == "BROADCAST_BYTES":
        monkeypatch.setattr(frames.broadcast_if_small, "__defaults__", (0,))
    rng = random.Random(13)
    rows = list(enumerate(near_copies(rng, 60) + near_copies(rng, 5, edits=30)))
    found = jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute_jaccard(rows)



@pytest.mark.parametrize("block_nodes,shared_bytes", [(4096, 1 << 20), (8, 0)])
def test_same_components_as_all_pairs(spark, monkeypatch, block_nodes, shared_bytes):
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", block_nodes)
    monkeypatch.setattr(jaccard_join, "SHARED_BYTES", shared_bytes)
    rows = varied_texts(block_nodes)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()}
    assert found == brute_jaccard(rows)


def test_jaccard_edges(spark):
    rows = [(3, None), (4, ""), (5, " \t"), (6, "a b"), (2, "A  B"), (7, "a b c"), (8, "w " * 30_000), (9, "W " * 30_001),
            (None, "a b"), (1, "one two three four five six"), (1, "one two three four five six")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("node", F.lit("clash"))
    found = sorted(((r.doc_id or 0), r.n_shingles, r.component_id or 0) for r in jaccard_components(docs).collect())
    assert found == [(0, 1, 0), (1, 2, 1), (1, 2, 1), (2, 1, 2), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 2), (7, 1, 7), (8, 1, 8), (9, 1, 8)]
    assert jaccard_components(docs.limit(0)).count() == 0


def test_tree_leaves_out_no_pair_within_the_bound():
    rng = np.random.default_rng(1)
    base = rng.poisson(4, (30, 64))
    points = np.concatenate([np.maximum(base[rng.integers(30, size=300)] + rng.integers(-1, 2, (300, 64)) * (rng.random((300, 64)) < 0.1), 0)])
    sizes = points.sum(axis=1)
    tree = CountTree(points, sizes)
    a, b = tree.pairs_with(tree)
    found = {(min(p), max(p)) for p in zip(a.tolist(), b.tolist())}
    most = np.minimum(points[:, None], points[None]).sum(axis=2)
    want = {(p, q) for p in range(300) for q in range(p + 1, 300) if 175 * most[p, q] >= 75 * (sizes[p] + sizes[q])}
    assert found == want and len(found) == len(a) < 300 * 299 / 4


# -- embeddings --


def brute_embeddings(rows, threshold=0.9):
    ids = [i for i, v in rows if v is not None]
    x = np.array([v for _, v in rows if v is not None], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= threshold
    np.fill_diagonal(close, False)
    links = [(ids[p], ids[q]) for p, q in zip(*np.nonzero(close)) if p < q]
    component = brute_components(ids, links)
    return {i: (int(n), component[i]) for i, n in zip(ids, close.sum(axis=1))}


@pytest.mark.parametrize("leaf_nodes", [4096, 64])
def test_recall_of_the_forest(spark, monkeypatch, leaf_nodes):
    monkeypatch.setattr(projection_forest, "LEAF", 50)
    monkeypatch.setattr(projection_forest, "LEAF_NODES", leaf_nodes)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(400, 32))
    near = centres[rng.integers(400, size=800)] + rng.normal(size=(800, 32)) * rng.choice([0.05, 0.3, 0.45], (800, 1))
    near = np.concatenate([centres, near, near[:20], centres[0] + rng.normal(size=(150, 32)) * 0.1]).astype(np.float32)
    rows = [(n, [float(v) for v in vector]) for n, vector in enumerate(near)]
    found = {r.vec_id: r for r in near_embeddings(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()}
    want = brute_embeddings(rows)
    assert all(found[i].n_links <= n for i, (n, _) in want.items())  # none below the threshold
    assert sum(r.n_links for r in found.values()) >= 0.95 * sum(n for n, _ in want.values())
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    assert np.mean([found[i].component_id == c for i, (_, c) in want.items()]) > 0.95


def test_recall_of_each_group_with_a_dense_third(spark, tmp_path):
    """Constants as they are; the dense group's vectors all differ."""
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    alone, turn = unit(rng.normal(size=(15_000, 64))), unit(rng.normal(size=(1000, 64)))
    turn = unit(turn - (turn * alone[:1000]).sum(axis=1, keepdims=True) * alone[:1000])
    twins = 0.901 * alone[:1000] + math.sqrt(1 - 0.901**2) * turn
    dense = unit(rng.normal(size=(1, 64))) * math.sqrt(0.92) + unit(rng.normal(size=(8000, 64))) * math.sqrt(0.08)
    x = np.concatenate([alone, twins, dense]).astype(np.float32)
    order = rng.permutation(len(x))
    table = pa.table({"vec_id": order, "embedding": pa.FixedSizeListArray.from_arrays(x[order].ravel(), 64).cast(pa.list_(pa.float32()))})
    pq.write_table(table, f"{tmp_path}/v.parquet", row_group_size=3000)
    found = near_embeddings(spark.read.parquet(f"{tmp_path}/v.parquet")).toArrow().sort_by("vec_id")
    n_links = found["n_links"].to_numpy()
    x = unit(x.astype(np.float64))
    want = np.concatenate([(x[n : n + 2000] @ x.T >= 0.9).sum(axis=1) - 1 for n in range(0, len(x), 2000)])
    assert (n_links <= want).all()
    for group in (slice(0, 16_000), slice(16_000, None)):
        assert n_links[group].sum() >= 0.95 * want[group].sum()
    assert len(np.unique(found["component_id"].to_numpy()[16_000:])) < 80


@pytest.mark.parametrize("vectors", [20_000, 10**6, 10**8])
def test_trees_follow_the_depth(monkeypatch, vectors):
    monkeypatch.setattr(projection_forest.Forest, "_fit", lambda *_: [])
    forest = projection_forest.Forest(np.empty((0, 64)), vectors, 64, 0.9)
    rng, at = np.random.default_rng(6), 1 / math.sqrt(64)
    a = rng.normal(size=(4000, forest.trees, forest.depth)) * at
    b = 0.9 * a + math.sqrt(1 - 0.81) * rng.normal(size=a.shape) * at
    met = (np.minimum(a, b) >= -forest.margin) | (np.maximum(a, b) <= forest.margin)
    assert met.all(axis=2).any(axis=1).mean() > 0.93


def test_embedding_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0]), (5, None), (6, []), (7, [0.0, 0.0]),
            (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [None, 1.0]), (11, [1.0]), (12, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]),
            (13, [1e300, 1e300]), (14, [1e-300, 1e-300]), (1, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("rows", F.lit(1))
    found = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in near_embeddings(frame).collect())
    alone = [(n, 0, n, True) for n in (4, 5, 6, 7, 8, 9, 10, 11, 12)]
    assert found == sorted([(0, 0, 0, False), (1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False),
                            (13, 1, 13, True), (14, 1, 13, False), *alone])
    assert near_embeddings(frame.limit(0)).count() == 0


# -- URLs --


def test_rules_lists_and_odd_urls(spark):
    urls = {1: "http://A.Example.org/es/x", 2: "https://org", 3: "http://org/", 4: "http://example.org/en/123?x", 5: None,
            6: "no scheme", 7: "http://x.com/de/1", 8: "http://xcom/de/1", 9: "ftp://u.net/listed#a", 10: "http://u.net/other",
            11: "http://u.net", 12: "http://x.com/fr/" + "a" * 20_000, 13: "://", 14: "http://a\nb.net/x\ny", 15: "http://notexample.org/es/"}
    pages = spark.createDataFrame([(i, u, "x") for i, u in urls.items()], "page_id int, url string, host string")
    pages = pages.unionByName(pages.where("page_id = 1"))
    rules = spark.createDataFrame([*URL_RULES, (None, "a", "block"), ("com", None, "block"), URL_RULES[0]], "host string, path string, verdict string")
    listed = spark.createDataFrame([("http://u.net/listed?q",), ("gopher://U.NET/",), (None,), ("junk",)], "url string")
    rows = judge_urls(pages, rules, listed).collect()
    found = {r.page_id: (r.rule, r.verdict) for r in rows}
    assert len(rows) == 16 and found == {
        1: ("example.org/es/", "block"), 2: (None, "allow"), 3: ("org/", "allow"), 4: ("example.org/en/1", "block"),
        5: (None, "allow"), 6: (None, "allow"), 7: ("com/de/", "block"), 8: (None, "allow"), 9: (None, "block"),
        10: (None, "allow"), 11: (None, "block"), 12: ("com/fr/", "allow"), 13: (None, "allow"), 14: (None, "allow"),
        15: ("org/", "allow")}
    parts = {r.page_id: (r.host, r.path) for r in rows}
    assert parts[1] == ("a.example.org", "/es/x") and parts[5] == ("", "") and parts[14] == ("a\nb.net", "/x\ny")
    assert {r.verdict for r in judge_urls(pages, rules.limit(0), listed.limit(0)).collect()} == {"allow"}
    assert judge_urls(pages.limit(0), rules, listed).count() == 0


def test_the_filter_has_no_false_negatives_and_few_hits(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    hit = BloomFilter(keys, "key").test(spark)
    assert keys.where(hit(F.col("key"))).count() == 3000
    others = spark.range(20_000).select(F.concat(F.lit("o"), "id").alias("key"))
    assert others.where(hit(F.col("key"))).count() < 400


def test_url_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{MEDIUM}/pages.parquet'")
    want = con.execute(ORACLE["op5_url_filter"]).fetchall()
    found = QUERIES["op5_url_filter"](spark, MEDIUM).collect()
    key = lambda r: r[0]
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


# -- WARC --


def test_round_trip_with_revisits(spark, tmp_path):
    rows = [(1, "http://a b/\r\nX: y", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (None, "u", "same"),
            (5, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"), (6, "u", "é" * 50_000), (2, None, "same")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(0))
    write_warc(pages, f"{tmp_path}/w")
    found = read_warc(spark, f"{tmp_path}/w").collect()
    assert all(r.problem is None for r in found) and len(found) == 8
    by_kind = sorted((r.headers["WARC-Record-ID"], r.headers["WARC-Type"], r.headers.get("WARC-Refers-To")) for r in found)
    name = "<urn:x-page:{}>".format
    assert by_kind == sorted([(name(1), "response", None), (name(2), "revisit", name(1)), (name(2), "revisit", name(1)),
                              (name(3), "response", None), (name(4), "revisit", name(3)), (name(""), "response", None),
                              (name(5), "response", None), (name(6), "response", None)])
    payload = {r.headers["WARC-Record-ID"]: r.payload.decode() for r in found if r.headers["WARC-Type"] == "response"}
    assert payload == {name(1): "same", name(3): "", name(""): "same", name(5): rows[5][2], name(6): rows[6][2]}
    write_warc(pages.where("page_id < 3"), f"{tmp_path}/l", least_bytes=5)
    assert {r.headers["WARC-Type"] for r in read_warc(spark, f"{tmp_path}/l").collect()} == {"response"}
    write_warc(pages.limit(0), f"{tmp_path}/e")
    assert read_warc(spark, f"{tmp_path}/e").count() == 0


def test_long_urls_come_back(spark, tmp_path):
    rows = [(1, "http://a/" + "x" * 400_000, "same"), (2, "u", "same"), (3, "http://a/" + " " * 30_000, "other")]
    write_warc(spark.createDataFrame(rows, "page_id bigint, url string, html string"), f"{tmp_path}/w")
    found = read_warc(spark, f"{tmp_path}/w").collect()
    assert len(found) == 3 and all(r.problem is None for r in found)
    urls = {r.headers["WARC-Record-ID"]: r.headers["WARC-Target-URI"] for r in found}
    assert urls == {f"<urn:x-page:{n}>": u.replace(" ", "%20") for n, u, _ in rows}


def test_files_are_bounded_by_bytes(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "FILE_BYTES", 4_000_000)
    rows = spark.range(0, 60, 1, 1).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"),
        F.concat("id", F.repeat(F.lit("x"), F.when(F.col("id") % 2 == 0, 300_000).otherwise(10).cast("int"))).alias("html"),
    )
    write_warc(rows, f"{tmp_path}/w")
    found = read_warc(spark, f"{tmp_path}/w").groupBy("path").agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    assert sum(r.n for r in found) == 60 and max(r.bytes for r in found) <= 4_000_000
    write_warc(spark.createDataFrame([(1, "u", "x" * 5_000_000), (2, "u", "y")], "page_id bigint, url string, html string"), f"{tmp_path}/o")
    assert read_warc(spark, f"{tmp_path}/o").where("problem is null").count() == 2


def record(number, body):
    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x-page:{number}>\r\nWARC-Block-Digest: sha1:{digest}\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_records_after_damage_are_recovered_and_gaps_logged(pack):
    bodies = [b"one", b"WARC/1.1 inside " * 10, bytes(range(256)) * 20, b"", b"last"]
    parts = [pack(record(n, b)) for n, b in enumerate(bodies)]
    starts = np.cumsum([0] + [len(p) for p in parts])
    whole = b"".join(parts)
    assert [r[3]["WARC-Record-ID"][-2] for r in salvage(whole)] == list("01234")
    for damage in range(0, len(whole), max(1, len(whole) // 60)):
        broken = bytearray(whole)
        broken[damage] ^= 0x5A
        hit = int(np.searchsorted(starts, damage, "right")) - 1
        found = list(salvage(bytes(broken)))
        kept = {r[3]["WARC-Record-ID"][-2] for r in found if r[2] is None and r[4] in bodies}
        assert kept >= set("01234") - {str(hit)}
        gaps = [(r[0], r[0] + r[1]) for r in found if r[2]]
        assert gaps in ([], [(starts[hit], starts[hit + 1])]), (damage, gaps)
        assert sum(r[1] for r in found) == len(whole)
    cut = list(salvage(b"junk" + whole[:-3]))
    assert cut[0][:2] == (0, 4) and cut[-1][2] and [r[3]["WARC-Record-ID"][-2] for r in cut[1:-1]] == list("0123")
    assert list(salvage(b"")) == [] and len(list(salvage(b"x" * 1000))) == 1


def test_records_of_a_gzip_member_survive_a_bad_one():
    bodies = [bytes(np.random.default_rng(n).integers(256, size=3000, dtype=np.uint8)) for n in range(6)]
    parts = [record(n, b) for n, b in enumerate(bodies)]
    ids = lambda found: "".join(r[3]["WARC-Record-ID"][-2] for r in found if r[2] is None)
    bad = bytearray(parts[2])
    bad[-100] ^= 1
    member = gzip.compress(b"".join([*parts[:2], bytes(bad), *parts[3:]]))
    found = list(salvage(member))
    assert ids(found) == "01345" and [r[4] for r in found if not r[2]] == [b for n, b in enumerate(bodies) if n != 2]
    assert [r[2] for r in found if r[2]] == [f"bytes {2 * len(parts[0])} to {3 * len(parts[0])} of a gzip member: block digest differs"]
    whole = gzip.compress(b"".join(parts))
    after = gzip.compress(record(7, b"after")) + record(8, b"plain")
    cut = list(salvage(whole[: len(whole) * 6 // 10]))
    assert ids(cut) == "012" and cut[-1][2].endswith("cut gzip member")
    assert ids(salvage(whole[:-8] + b"bad sum!" + after)) == "01234578"
    for level, least in ((0, 7), (6, 4)):  # stored records are found once
        for damage in (len(whole) // 2, len(whole) - 50):
            broken = bytearray(gzip.compress(b"".join(parts), level))
            broken[damage] ^= 0x5A
            found = list(salvage(bytes(broken) + after))
            assert len(ids(found)) == len(set(ids(found))) >= least and ids(found).endswith("78")
            assert all(r[4] in [*bodies, b"after", b"plain"] for r in found if r[2] is None)


def test_warc_query(spark):
    pages = {r.page_id: r.html or "" for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    first = {}
    for page in sorted(pages):
        first.setdefault(pages[page], page)
    for r in QUERIES["op9_warc_round_trip"](spark, SMALL).collect():
        html = pages.pop(r.page_id)
        assert r.payload_bytes == len(html.encode())
        assert r.payload_digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        assert (r.record_type, r.refers_to) == (("response", None) if first[html] == r.page_id else ("revisit", first[html]))
    assert not pages


# -- pipeline --


def test_ids_of_several_texts_keep_one_row_of_each_group(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    a, b, c, d, e = (" ".join(f"{name}{n}" for n in range(60)) for name in "abcde")
    rows = [(5, a, "en", "s", 1), (5, b, "en", "s", 1), (3, b + " more", "en", "s", 1),
            (7, c, "en", "s", 1), (7, c + " more", "en", "s", 1),
            (8, d, None, "s", 1), (8, d, "s", None, 1), (9, e, "en", "s", 1), (9, e, "en", "s", 1),
            (4, "", "en", "s", 0), (4, "", "de", "s", 0), (None, a, "en", "s", 1), (None, a, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = [tuple(r) for r in pipeline.near_copies_stage(spark, docs, MEDIUM).collect()]
    assert sorted((r[0] or 0) for r in found) == [0, 0, 3, 4, 4, 5, 7, 8, 9] and set(found) <= set(rows)
    assert rows[0] in found and {rows[9], rows[10]} <= set(found)


def test_pipeline_stages_on_whole_input(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    odd = spark.createDataFrame(
        [(-1, None, None, None, None), (-2, "", "en", "s", 0), (-3, "The of and to", None, "s", 5), (-3, "The of and to", None, "s", 5), (None, "The of and", "en", None, 5)],
        docs.schema,
    )
    kept, scratch = docs.unionByName(odd), scratch_of(docs)
    sizes = []
    for name, stage in pipeline.STAGES:
        before = kept
        kept = scratch.stage(stage(spark, kept, MEDIUM), name)
        sizes.append(kept.count())
        if name != "bpe":
            assert kept.columns == list(pipeline.COLUMNS)
            assert kept.exceptAll(before).isEmpty()
        if name == "language_id":
            assert sizes[0] >= docs.count() - 2
        if name == "ngram_jaccard_join":
            rows = [(r.doc_id, r.text) for r in before.collect() if r.doc_id is not None]
            left = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
            assert left == sorted({c for _, c in brute_jaccard(rows).values()})
        if name == "benchmark_decontamination":
            norm = lambda t: " " + " ".join(re.findall(r"[a-z0-9]+", t.lower())) + " "
            items = [norm(r.text) for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()]
            assert not any(item in norm(r.text) for r in kept.collect() for item in items)
    assert sizes == sorted(sizes, reverse=True) and set(kept.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), MEDIUM).count() == 0
