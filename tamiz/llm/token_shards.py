"""Token ids of a corpus as wavelet matrix files.

Documents are dealt out by ranges of their id, sorted, encoded and written in
one pass: every task writes the files of its range, one after another, each of
about ``shard_tokens`` tokens and whole documents.  Texts move through one shuffle,
nothing else does; a file is built in the memory of its task.

A task names its files anew at every attempt, and the catalog, a Parquet table
written by Spark, lists the files that count.  So an attempt that is lost or
runs twice leaves files that nobody reads, and a reader never sees half a file.
The catalog also tells where each file begins in the whole sequence.

Files are opened through ``pyarrow.fs``, which knows local and shared folders,
HDFS and object stores by the scheme of the path.

Byte-level BPE files whose split is the usual one are encoded word by word: their
split always cuts before a space that a non-space follows, so what stands between
two such cuts is encoded by the library once and then looked up.  Texts with
special strings, and files with other rules, are encoded whole.
"""

from __future__ import annotations

import codecs
import json
import math
import os
import re
import uuid
from array import array
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tamiz.llm.bpe import read_file
from tamiz.llm.frames import scratch_of, ship_package
from tamiz.llm.wavelet import DamagedShard, TokenShard, shard_bytes

#: Tokens from which on a file is closed.
SHARD_TOKENS = 1 << 24
#: Bytes of text of one task, and the least that a further task is worth.
TASK_BYTES, LEAST_TASK_BYTES = 32 << 20, 4 << 20
#: Characters encoded together; words remembered, and characters of them.
SLICE_CHARS, KEPT_WORDS, KEPT_CHARS = 1 << 22, 1 << 19, 1 << 24
#: New words encoded as one text.
NEW_WORDS = 1 << 10
#: Bytes of ids handed on together by a reader.
BATCH_BYTES = 4 << 20

_SPACED = re.compile(r" \s")
_CUT = re.compile(r"(?= \S)")
#: Latin letters, and the rest of a word if an ASCII sign that is no letter follows them.
_LETTERS = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]++)([\x00-@\\[-`{-\x7f].*)?", re.DOTALL)
#: What a byte-level vocabulary calls the bytes of letters and of the space before them; lines stay lines.
_BYTE_NAMES = "".join(
    chr(byte + 0x100 if byte <= 0x20 else byte + 0xA2 if 0x7F <= byte <= 0xA0 else 0x143 if byte == 0xAD else byte)
    for byte in range(256)
).replace("\u010a", "\n")
_CATALOG = "task int, shard int, file string, documents bigint, tokens bigint, bytes bigint"


# -- encoding ------------------------------------------------------------------


def _stretches(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of stretches, one stretch after another."""
    upto = np.cumsum(lengths)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(begins - upto + lengths, lengths)


def _unspaced(words: pa.Array) -> list[str]:
    """The words, none of which has a space, as a list; read as one text, which is faster."""
    if not len(words):
        return []
    one = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    return pc.binary_join(one, pa.scalar(" ", words.type))[0].as_py().split(" ")


class _Numbers(dict):
    """Number of each piece of text; a new one is put down to be encoded."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class LibraryEncoder:
    """Ids of texts as the ``tokenizers`` library gives them, nothing added or cut off."""

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(spec)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        spec = json.loads(spec)
        split, model, added = spec.get("pre_tokenizer") or {}, spec["model"], spec.get("added_tokens") or []
        self._by_words = (
            model.get("type") == "BPE"
            and not model.get("dropout")
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not spec.get("normalizer")
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
            and not any(re.search(r"\s", t["content"]) for t in added)
        )
        self._special = [t["content"] for t in added]
        # Byte-level tokens have a character for each byte; other files are not read by words.
        vocabulary = model["vocab"] if self._by_words else {}
        self._bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self._bytes[list(vocabulary.values())] = [len(token) for token in vocabulary]
        self._forget()

    def _forget(self) -> None:
        # What a text begins with, and what follows a space.
        self._first, self._rest = _Numbers(), _Numbers()
        self._known = {id(numbers): (array("I"), array("q", [0])) for numbers in (self._first, self._rest)}
        self._uses, self._chars = np.empty(0, np.int64), 0

    def _forget_rare(self) -> None:
        """Keeps the words that were met most, at most half of what may be kept."""
        words, uses, least = self._rest, self._uses, 2
        while np.count_nonzero(uses >= least) * 2 > KEPT_WORDS:
            least *= 2
        kept = np.flatnonzero(uses >= least)
        ids, ends = (np.array(part) for part in self._known[id(words)])
        lengths = ends[kept + 1] - ends[kept]
        of_word = list(words)
        self._forget()
        self._rest.update((of_word[number], at) for at, number in enumerate(kept.tolist()))
        known, known_ends = self._known[id(self._rest)]
        known.frombytes(ids[_stretches(ends[kept], lengths)].tobytes())
        known_ends.frombytes(np.cumsum(lengths).tobytes())
        self._uses = np.zeros(len(kept), np.int64)
        self._chars = sum(map(len, self._rest))
        if self._chars * 2 > KEPT_CHARS:
            self._forget()

    def _is_plain(self, text: str) -> bool:
        """Whether every space of a text is a cut and begins a word."""
        return self._by_words and _SPACED.search(text) is None and not any(part in text for part in self._special)

    def _parts(self, text: str) -> list[str]:
        if not self._by_words or any(special in text for special in self._special):
            return [text]
        first, *rest = _CUT.split(text)
        return [first, *[part[1:] for part in rest]]

    def _numbered(self, parts: pa.ListArray, read: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the texts' first parts, of their other parts, and how many others each has.
        A part is looked up once, however often it is met; ``read`` makes a list of an array."""
        ends = np.asarray(parts.offsets).astype(np.int64)
        inner = np.ones(ends[-1], bool)
        inner[ends[:-1]] = False
        firsts = [self._first[part] for part in parts.values.take(pa.array(ends[:-1])).to_pylist()]
        others = parts.values.filter(pa.array(inner)).dictionary_encode()
        numbers = np.fromiter(map(self._rest.__getitem__, read(others.dictionary)), np.int64)
        return np.array(firsts, np.int64), numbers[np.asarray(others.indices)], np.diff(ends) - 1

    def _lists(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.array([len(ids) for ids in found], np.int64)
        return np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum())), counts

    def _letter_lists(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters only that follow a space: the split leaves them whole,
        so the library's model takes them as they are, which spares the split."""
        named, _ = codecs.charmap_decode((" " + "\n ".join(words)).encode(), "strict", _BYTE_NAMES)
        tokenize, ids, counts = self._tokenizer.model.tokenize, [], []
        for word in named.split("\n"):
            found = [token.id for token in tokenize(word)]
            ids += found
            counts.append(len(found))
        return np.array(ids, np.uint32), np.array(counts, np.int64)

    def _joined_lists(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for what follows spaces: encoded as one text, which is cut before
        every word anyway, and told apart by the bytes that tokens stand for."""
        texts = [f" {word}" for word in words]
        ids, _ = self._lists(["".join(texts)])
        ends = np.cumsum(self._bytes[np.minimum(ids, len(self._bytes) - 1)])
        wanted = np.cumsum([len(text.encode()) for text in texts])
        last = np.searchsorted(ends, wanted)
        if len(ends) and ends[-1] == wanted[-1] and (ends[np.minimum(last, len(ends) - 1)] == wanted).all():
            return ids, np.diff(last + 1, prepend=0)
        return self._lists(texts)

    def _in_parts(self, words: list[str], encode: Callable) -> tuple[np.ndarray, np.ndarray]:
        found = [encode(words[first : first + NEW_WORDS]) for first in range(0, len(words), NEW_WORDS)]
        self._chars += sum(map(len, words))
        if not found:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        ids, counts = zip(*found)
        return np.concatenate(ids), np.concatenate(counts)

    def _remember(self, numbers: _Numbers, ids: np.ndarray, counts: np.ndarray) -> None:
        known, ends = self._known[id(numbers)]
        known.frombytes(ids.astype(np.uint32).tobytes())
        ends.frombytes((np.cumsum(counts) + ends[-1]).tobytes())
        numbers.new.clear()

    def _held(self, numbers: _Numbers) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array(part) for part in self._known[id(numbers)])

    def _encode_new(self) -> None:
        """Encodes what is new.  Letters that a sign follows are cut there in any case, so such
        words are put together of their letters and the rest, which are met more often."""
        words = self._rest.new
        compound, heads, tails, other = (array("q") for _ in range(4))
        for at, found in enumerate(map(_LETTERS.fullmatch, words.copy())):
            if not found:
                other.append(at)
            elif found[2]:
                compound.append(at)
                heads.append(self._rest[found[1]])  # may be a new word itself
                tails.append(self._first[found[2]])
        compound, heads, tails, other = (np.array(part) for part in (compound, heads, tails, other))
        self._remember(self._first, *self._in_parts(self._first.new, self._lists))
        whole, letters = np.ones((2, len(words)), bool)
        whole[compound] = letters[compound] = letters[other] = False
        simple, counts = self._in_parts([word for word, one in zip(words, letters) if one], self._letter_lists)
        if len(other):
            others, other_counts = self._in_parts([words[at] for at in other.tolist()], self._joined_lists)
            place = np.argsort(np.concatenate([np.flatnonzero(letters), other]))
            counts = np.concatenate([counts, other_counts])
            simple = np.concatenate([simple, others])[_stretches((np.cumsum(counts) - counts)[place], counts[place])]
            counts = counts[place]
        if not len(compound):
            return self._remember(self._rest, simple, counts)
        (known, ends), (first_known, first_ends) = self._held(self._rest), self._held(self._first)
        old = len(ends) - 1
        # Of every word, old or new and whole: where its ids begin and how many they are.
        begins, lengths = np.zeros((2, old + len(words)), np.int64)
        begins[:old], lengths[:old] = ends[:-1], np.diff(ends)
        begins[old:][whole], lengths[old:][whole] = np.cumsum(counts) - counts + len(known), counts
        # Of every new word: its head, which is all of a whole one, and its tail.
        head, pieces = np.arange(old, old + len(words)), np.zeros((len(words), 2, 2), np.int64)
        head[compound] = heads
        pieces[:, 0, 0], pieces[:, 0, 1] = begins[head], lengths[head]
        pieces[compound, 1, 0] = first_ends[tails] + len(known) + len(simple)
        pieces[compound, 1, 1] = first_ends[tails + 1] - first_ends[tails]
        source = _stretches(*pieces.reshape(-1, 2).T)
        ids = np.concatenate([known, simple, first_known])[source]
        self._remember(self._rest, ids, pieces[:, :, 1].sum(axis=1))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text."""
        if not texts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        plain = np.array([self._is_plain(text) for text in texts])
        split = pc.split_pattern(pa.array([t for t, p in zip(texts, plain) if p], pa.large_string()), pattern=" ")
        other = pa.array([self._parts(t) for t, p in zip(texts, plain) if not p], pa.list_(pa.large_string()))
        # Numbered apart, then put in the order of the texts again.
        numbered = [self._numbered(split, _unspaced), self._numbered(other, pa.Array.to_pylist)]
        place = np.argsort(np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)]))
        firsts, rests, sizes = (np.concatenate(kind) for kind in zip(*numbered))
        begins = (np.cumsum(sizes) - sizes)[place]
        firsts, sizes = firsts[place], sizes[place]
        rests = rests[_stretches(begins, sizes)]
        self._encode_new()
        ids, counts = self._gathered(firsts, rests, sizes)
        uses = np.bincount(rests, minlength=len(self._rest))
        uses[: len(self._uses)] += self._uses
        self._uses = uses
        if len(self._first) + len(self._rest) > KEPT_WORDS or self._chars > KEPT_CHARS:
            self._forget_rare()
        return ids, counts

    def _gathered(self, firsts: np.ndarray, rests: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The remembered ids of each text's first part and of its other ones."""
        (first_ids, first_ends), (rest_ids, rest_ends) = (
            tuple(np.frombuffer(part, kind) if len(part) else np.empty(0, kind) for part, kind in zip(held, (np.uint32, np.int64)))
            for held in (self._known[id(self._first)], self._known[id(self._rest)])
        )
        known, ends = np.concatenate([first_ids, rest_ids]), np.concatenate([first_ends, rest_ends + len(first_ids)])
        numbers = np.insert(rests + len(first_ends), np.cumsum(sizes) - sizes, firsts)
        lengths = ends[numbers + 1] - ends[numbers]
        return known[_stretches(ends[numbers], lengths)], np.add.reduceat(lengths, np.cumsum(sizes + 1) - sizes - 1)


_loaded: dict[int, LibraryEncoder] = {}


def encoder_of(spec: str) -> LibraryEncoder:
    """The encoder of a file, kept by a worker until it needs another one."""
    if hash(spec) not in _loaded:
        _loaded.clear()
        _loaded[hash(spec)] = LibraryEncoder(spec)
    return _loaded[hash(spec)]


def _with_ends(ids: np.ndarray, counts: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    if end_id is None:
        return ids, counts
    ends = np.cumsum(counts + 1) - 1
    out = np.empty(len(ids) + len(ends), ids.dtype)
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner], out[ends] = ids, end_id
    return out, counts + 1


# -- files ---------------------------------------------------------------------


def _file_system(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path; Hadoop writes local ones with one slash."""
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", folder))


def _text_slices(batch: pa.RecordBatch, chars: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids, texts) of consecutive rows of about ``chars`` characters."""
    texts, first, size = [], 0, 0
    for row, text in enumerate(batch.column("text")):
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= chars:
            yield batch.column("id").slice(first, row + 1 - first), texts
            texts, first, size = [], row + 1, 0
    if texts:
        yield batch.column("id").slice(first), texts


def _written(file, folder: str, end_id: int | None, shard_tokens: int) -> Callable:
    """Writes the documents of a task, which come in order; one row a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = encoder_of(file.value), TaskContext.get().partitionId()
        files, path = _file_system(folder)
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size, shard = 0, 0
        attempt = uuid.uuid4().hex

        def close() -> pa.RecordBatch:
            nonlocal size, shard
            ids = np.concatenate([part[1] for part in held])
            documents = pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([part[0] for part in held]),
                    pa.array(np.concatenate([part[2] for part in held])),
                ],
                ["id", "n_tokens"],
            )
            held.clear()
            stored = shard_bytes(ids, documents)
            name = f"part-{task:06d}-{shard:04d}-{attempt}.twm"
            files.create_dir(path, recursive=True)
            with files.open_output_stream(f"{path}/{name}") as out:
                out.write(stored)
            row = {
                "task": task, "shard": shard, "file": name, "documents": documents.num_rows,
                "tokens": len(ids), "bytes": len(stored),
            }
            size, shard = 0, shard + 1
            types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types)], list(row))

        for batch in batches:
            for named, texts in _text_slices(batch, min(SLICE_CHARS, 4 * shard_tokens)):
                ids, counts = _with_ends(*encoder.encode(texts), end_id)
                held.append((named, ids if int(ids.max(initial=0)) >> 16 else ids.astype(np.uint16), counts))
                size += len(ids)
                if size >= shard_tokens:
                    yield close()
        if held:
            yield close()
        pa.default_memory_pool().release_unused()

    return run


def write_shards(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = None,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Writes the ids of all texts, by ascending id, to ``folder``; returns the
    catalog: (task, shard, file, documents, tokens, bytes, start).

    A null text is an empty one; ``end_id``, if given, ends every document.  A null
    id comes first.  Rows of one id (ties) are ordered by a hash of their texts;
    equal rows are interchangeable, and are split among tasks like others.  An
    empty table gives an empty catalog and no file.  ``folder`` must be new.
    Columns other than the two are not read, whatever their names.
    """
    spark, scratch = docs.sparkSession, scratch_of(docs)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.xxhash64(text_col).alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    )
    size = docs.agg(F.sum(F.octet_length(text_col).cast("bigint"))).first()[0] or 0
    tasks = max(
        math.ceil(size / TASK_BYTES), min(spark.sparkContext.defaultParallelism, math.ceil(size / LEAST_TASK_BYTES)), 1
    )
    order = ("id", "tie", "row")
    dealt = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("id", "text")
    shards = f"{folder.rstrip('/')}/shards"
    written = dealt.mapInArrow(_written(read_file(spark, tokenizer_path), shards, end_id, shard_tokens), _CATALOG)
    written = scratch.stage(written, "written")
    # One row a task of this job, a list that the driver holds anyway to run it.
    totals = written.groupBy("task").agg(F.sum("tokens").alias("tokens"))
    before_task = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("task", F.coalesce(F.sum("tokens").over(before_task), F.lit(0)).alias("before"))
    in_task = Window.partitionBy("task").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("tokens").over(in_task), F.lit(0))
    catalog = written.join(totals, "task").select(*written.columns, start.alias("start"))
    catalog.coalesce(1).sortWithinPartitions("start").write.parquet(f"{folder.rstrip('/')}/catalog")
    return read_catalog(spark, folder)


# -- reading ---------------------------------------------------------------------


def read_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{_CATALOG}, start bigint").parquet(f"{folder.rstrip('/')}/catalog")


def _for_shards(
    spark: SparkSession, folder: str, answer: Callable[[TokenShard, int], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``answer`` for every file of the catalog, with the place it begins at."""
    ship_package(spark)
    catalog = read_catalog(spark, folder)
    files = catalog.count()
    shards = f"{folder.rstrip('/')}/shards"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, path = _file_system(shards)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                with found.open_input_file(f"{path}/{name}") as opened:
                    yield from answer(TokenShard(opened), start)

    tasks = max(1, min(files, 32 * spark.sparkContext.defaultParallelism))
    return catalog.select("file", "start").repartition(tasks).mapInArrow(run, schema)


def _documents(shard: TokenShard, start: int) -> Iterator[pa.RecordBatch]:
    listed, ids = shard.documents(), shard.ids()
    counts = listed["n_tokens"].to_numpy()
    ends = np.cumsum(counts)
    if (ends[-1] if len(ends) else 0) != len(ids):
        raise DamagedShard("documents and tokens do not fit")
    named = listed["id"].combine_chunks()
    first = 0
    while first < len(ends):
        begin = int(ends[first] - counts[first])
        last = max(first + 1, int(np.searchsorted(ends, begin + BATCH_BYTES // 4, "right")))
        offsets = np.concatenate([[begin], ends[first:last]]) - begin
        data = ids[begin : int(ends[last - 1])].astype("<u4")
        binary = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), last - first, [None, pa.py_buffer(offsets * 4), pa.py_buffer(data)]
        )
        yield pa.RecordBatch.from_arrays(
            [named.slice(first, last - first), pa.array(offsets[:-1] + begin + start), binary.cast(pa.binary())],
            ["id", "start", "ids"],
        )
        first = last


def read_documents(spark: SparkSession, folder: str, id_type: str = "bigint", id_col: str = "doc_id") -> DataFrame:
    """(id, start, ids) of every document: ``ids`` are its tokens as little-endian
    unsigned 32-bit integers, ``start`` the tokens of all documents before it.
    Every byte of a file is checked; a damaged one raises."""
    found = _for_shards(spark, folder, _documents, f"id {id_type}, start bigint, ids binary")
    return found.select(F.col("id").alias(id_col), "start", "ids")


def count_occurrences(spark: SparkSession, folder: str, tokens: Sequence[int]) -> DataFrame:
    """(token, occurrences) of each of a few tokens in the whole corpus; of each file
    only the blocks on the way to the tokens are read."""
    wanted = sorted(set(tokens))

    def answer(shard: TokenShard, _: int) -> Iterator[pa.RecordBatch]:
        counts = [shard.count(token) for token in wanted]
        yield pa.RecordBatch.from_arrays(
            [pa.array(wanted, pa.int64()), pa.array(counts, pa.int64())], ["token", "occurrences"]
        )

    asked = spark.createDataFrame([(t, 0) for t in wanted], "token bigint, occurrences bigint")
    found = _for_shards(spark, folder, answer, "token bigint, occurrences bigint")
    return found.unionByName(asked).groupBy("token").agg(F.sum("occurrences").alias("occurrences"))


def find_occurrences(
    spark: SparkSession, folder: str, token: int, id_type: str = "bigint", id_col: str = "doc_id"
) -> DataFrame:
    """(id, position, place) of every occurrence of a token: its position in the
    document and its place in the whole sequence."""

    def answer(shard: TokenShard, start: int) -> Iterator[pa.RecordBatch]:
        places = shard.locate(token)
        listed = shard.documents()
        ends = np.cumsum(listed["n_tokens"].to_numpy())
        row = np.searchsorted(ends, places, "right")
        begins = ends - listed["n_tokens"].to_numpy()
        for at in range(0, len(places), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [
                    listed["id"].combine_chunks().take(pa.array(row[part])),
                    pa.array(places[part] - begins[row[part]]),
                    pa.array(places[part] + start),
                ],
                ["id", "position", "place"],
            )

    found = _for_shards(spark, folder, answer, f"id {id_type}, position bigint, place bigint")
    return found.select(F.col("id").alias(id_col), "position", "place")


def tokens_at(spark: SparkSession, folder: str, places: Sequence[int]) -> DataFrame:
    """(place, token) at a few places of the whole sequence; places beyond it have no row."""
    wanted = np.array(sorted(set(places)), np.int64)

    def answer(shard: TokenShard, start: int) -> Iterator[pa.RecordBatch]:
        here = wanted[(wanted >= start) & (wanted < start + shard.size)]
        yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(shard.access(here - start))], ["place", "token"])

    return _for_shards(spark, folder, answer, "place bigint, token bigint")
