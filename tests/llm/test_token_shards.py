"""Wavelet matrix files against plain arrays, encoding against the library, and
the registered query against a brute force."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("tamiz.llm")
P = pytest.importorskip("public_tokenizers")

from tokenizers import Tokenizer  # noqa: E402

from tamiz.llm import token_shards as ts, wavelet  # noqa: E402
from tamiz.llm.queries import BYTE_BPE, QUERIES, WORD_BPE  # noqa: E402
from tamiz.llm.token_shards import (  # noqa: E402
    LibraryEncoder, count_occurrences, find_occurrences, read_documents, tokens_at, write_shards,
)
from tamiz.llm.wavelet import DamagedShard, TokenShard, shard_bytes  # noqa: E402

MEDIUM = "/root/testdata/sf0.01"


class Opened:
    """Bytes with the two methods a shard is read by; counts what was read."""

    def __init__(self, data):
        self.data, self.bytes_read = data, 0

    def size(self):
        return len(self.data)

    def read_at(self, count, offset):
        self.bytes_read += count
        return self.data[offset : offset + count]


def listed(counts):
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(counts)), pa.int64()), pa.array(counts, pa.int64())], ["id", "n_tokens"]
    )


@pytest.mark.parametrize("size", [0, 1, 7, 63, 64, 65, 128, 1000, 4096, 5003])
@pytest.mark.parametrize("top, kind", [(1, np.uint16), (2, np.uint16), (50_000, np.uint16), (200_000, np.uint32)])
def test_access_count_locate(size, top, kind):
    rng = np.random.default_rng(size + top)
    ids = np.minimum(rng.zipf(1.3, size), top - 1).astype(kind)
    shard = TokenShard(Opened(shard_bytes(ids, listed([size]), block_bits=64)))
    assert (shard.ids() == ids).all() and shard.size == size
    assert shard.documents()["n_tokens"].to_pylist() == [size]
    places = rng.integers(0, size, 50) if size else np.empty(0, np.int64)
    assert (shard.access(places) == ids[places]).all()
    for token in {0, 1, 2, 5, top - 1, top, 1 << 20, *ids[:5].tolist()}:
        want = np.flatnonzero(ids == token)
        assert (shard.locate(token) == want).all()
        assert (shard.locate(token, 1, 3) == want[1:3]).all()
        for begin, end in [(0, size), (0, None), (size // 3, size // 2), (size, size), (3, 2), (-4, size + 9)]:
            assert shard.count(token, begin, end) == ((want >= begin) & (want < (size if end is None else end))).sum()
    with pytest.raises(IndexError):
        shard.access([size])


def test_a_question_reads_a_part_of_the_file():
    ids = np.random.default_rng(1).integers(0, 40_000, 2_000_000).astype(np.uint16)
    opened = Opened(shard_bytes(ids, listed([len(ids)])))
    shard = TokenShard(opened)
    opened.bytes_read = 0
    assert shard.access([123_456]).tolist() == [ids[123_456]]
    assert 0 < opened.bytes_read < len(opened.data) / 10


def test_files_are_smaller_than_the_ids():
    ids = np.minimum(np.random.default_rng(2).zipf(1.2, 500_000), 50_000).astype(np.uint16)
    assert len(shard_bytes(ids, listed([len(ids)]))) < 0.9 * ids.nbytes


def test_damage_is_found():
    data = shard_bytes(np.arange(5000, dtype=np.uint16), listed([5000]))
    for broken in (b"", data[:20], data[:-1], data[1:], b"x" * 100):
        with pytest.raises(DamagedShard):
            TokenShard(Opened(broken))
    flipped = bytearray(data)
    flipped[40] ^= 1
    with pytest.raises(DamagedShard):
        TokenShard(Opened(bytes(flipped))).ids()
    in_directory = bytearray(data)
    in_directory[data.rindex(b'{"tokens"') - 3] ^= 1
    with pytest.raises(DamagedShard):
        TokenShard(Opened(bytes(in_directory)))


# -- encoding --


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


ODD = [
    "", " ", "  ", "   a", "a ", "a  ", " a", "a  b", "a   b", "a \n b", "a\n b", "a \t\tb", "a  b", "a  b",
    "a　　b c", "don't can't 'll I'll x's", "a <|endoftext|> b", "a  <|endoftext|>  b", "<|endoftext|>",
    "x<|endoftext|>y z", "a\x1c b", "a \x1c b", "a \x85b", "a​ b", "﻿a b", "é è ê  ñ", "日本 語 の  文",
    "1 22  333   4444", "!!  ?? ..", "a" * 3000, "\U0001f600 \U0001f600  x", "\r\n \r\n a", "a ᠎ b", "   x",
]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_encoding_equals_the_library(path, monkeypatch):
    rng = random.Random(3)
    pieces = ["a", "the", "don't", " ", "  ", "\n", "\t", " ", "1", "!", "é", "\x1c", "\x85", "<|endoftext|>", "ß", " "]
    texts = ODD + ["".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(3000)]
    monkeypatch.setattr(ts, "KEPT_WORDS", 500)
    with open(path, encoding="utf-8") as file:
        encoder = LibraryEncoder(file.read())
    encode = library(path)
    want = [encode(text) for text in texts]
    for first in range(0, len(texts), 97):
        ids, counts = encoder.encode(texts[first : first + 97])
        found = [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]
        assert found == want[first : first + 97]
    assert [part.tolist() for part in encoder.encode([])] == [[], []]


# -- corpora --


def brute(rows, encode, end=None):
    """(id, start, ids) by id, nulls first."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = encode(text) + ([] if end is None else [end])
        out.append((doc_id, start, ids))
        start += len(ids)
    return out


def opened(rows):
    return [(r[0], r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in rows.collect()]


def test_words_put_together_of_letters_and_the_rest(monkeypatch):
    """Signs, letters of other scripts and digits at the border of letters, met in any order
    and again after rare words were forgotten."""
    monkeypatch.setattr(ts, "KEPT_WORDS", 200)
    monkeypatch.setattr(ts, "NEW_WORDS", 7)
    with open(BYTE_BPE) as file:
        spec = file.read()
    library, encoder = Tokenizer.from_str(spec), LibraryEncoder(spec)
    letters = ["a", "The", "enth", "ñé", "l\u00d7", "x\u00b2", "\u03b1", "\u01c0", "e\u0301", "\u4f60", "_", ""]
    signs = [",", "'s", "'", ".\n", "5", "\u00bd", "%%%", "<|endoftext|>", "\x00", "", "", "\n\n", "\u3000"]
    chosen = random.Random(3)
    for _ in range(150):
        words = ["".join(chosen.choice(kind) for kind in [letters, signs] * chosen.randint(1, 3)) for _ in range(40)]
        texts = [chosen.choice([" ", " ", "  ", "\n "]).join(chosen.sample(words, chosen.randint(0, 9))) for _ in range(9)]
        expected = [library.encode(text, add_special_tokens=False).ids for text in texts]
        ids, counts = encoder.encode(texts)
        assert counts.tolist() == [len(one) for one in expected]
        assert ids.tolist() == [number for one in expected for number in one]


def test_round_trip_and_questions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ts, "LEAST_TASK_BYTES", 10_000)
    rng = random.Random(8)
    rows = [(n * 7 % 211, " ".join(rng.choice(["red", "green", "blue\n", "  x", "<|endoftext|>"]) for _ in range(rng.randrange(60)))) for n in range(211)]
    rows += [(500, None), (501, ""), (None, "no id"), (502, "word " * 20_000)]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, start int, ids string")
    folder = str(tmp_path / "corpus")
    catalog = write_shards(frame.repartition(5), folder, BYTE_BPE, end_id=2, shard_tokens=500)
    want = brute(rows, library(BYTE_BPE), 2)
    assert catalog.count() > 5 and catalog.select("task").distinct().count() > 1
    assert catalog.agg({"tokens": "sum"}).first()[0] == sum(len(w[2]) for w in want)
    key = lambda row: (row[0] is not None, row[0] or 0)
    assert sorted(opened(read_documents(spark, folder)), key=key) == want
    flat = [t for w in want for t in w[2]]
    asked = [2, flat[0], 50256, 49_999, 10**6]
    counts = {r.token: r.occurrences for r in count_occurrences(spark, folder, asked).collect()}
    assert counts == {t: flat.count(t) for t in asked}
    found = {(r.place, r.doc_id, r.position) for r in find_occurrences(spark, folder, 50256).collect()}
    assert found == {(w[1] + n, w[0], n) for w in want for n, t in enumerate(w[2]) if t == 50256} and found
    places = [0, 5, 1000, len(flat) - 1, len(flat), -1]
    assert {r.place: r.token for r in tokens_at(spark, folder, places).collect()} == {p: flat[p] for p in places[:4]}
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        write_shards(frame, folder, BYTE_BPE)


def test_repeated_ids_and_rows_and_text_ids(spark, tmp_path):
    rows = [("b", "one two"), ("a", "x y z"), ("a", "x y z"), ("b", "three"), ("c", None), ("c", None)] * 3
    frame = spark.createDataFrame(rows, "doc_id string, text string").repartition(4)
    write_shards(frame, str(tmp_path / "c"), WORD_BPE)
    found = sorted(opened(read_documents(spark, str(tmp_path / "c"), "string")), key=lambda r: (r[1], r[0]))
    encode = library(WORD_BPE)
    assert sorted((r[0], tuple(r[2])) for r in found) == sorted((i, tuple(encode(t))) for i, t in rows)
    start = 0
    for name, at, ids in found:  # starts are gapless in order of the ids
        assert at == start
        start += len(ids)
    assert [r[0] for r in found] == sorted(r[0] for r in rows)


def test_empty_table(spark, tmp_path):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert write_shards(frame, str(tmp_path / "none"), BYTE_BPE).count() == 0
    assert read_documents(spark, str(tmp_path / "none")).count() == 0
    assert [tuple(r) for r in count_occurrences(spark, str(tmp_path / "none"), [5]).collect()] == [(5, 0)]


def test_a_lost_attempt_leaves_nothing_to_read(spark, tmp_path):
    """A file that the catalog does not list, whole or cut off, changes no answer."""
    frame = spark.createDataFrame([(1, "a b c"), (2, "d")], "doc_id bigint, text string")
    folder = tmp_path / "c"
    write_shards(frame, str(folder), BYTE_BPE)
    before = sorted(opened(read_documents(spark, str(folder))))
    (folder / "shards" / "part-000000-0000-other.twm").write_bytes(b"half a fi")
    assert sorted(opened(read_documents(spark, str(folder)))) == before


def test_query_equals_brute_force(spark):
    documents = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()
    want = [
        (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for i, at, ids in brute([tuple(r) for r in documents], library(BYTE_BPE), 2)
    ]
    found = QUERIES["op13_token_shards"](spark, MEDIUM)
    assert found.dtypes == [(n, "bigint") for n in ("doc_id", "start", "n_tokens", "ids_crc32")]
    assert sorted(tuple(r) for r in found.collect()) == want
