"""BPE encoding by backtracking, decoding by an offset table.

A token sequence is what the merges give exactly if each token is what they
give for its own text and no two neighbours are incompatible, that is, no merge
reaches across their seam while they are built.  So a word is encoded without
merging: an Aho-Corasick automaton over the vocabulary finds the longest token
at every position; the longest compatible token is taken, then shorter ones,
and where none fits the last token is taken back.  The compatible sequence up to
a position is unique, so a position that failed once is never tried again and
the work is linear in the word.  Pair compatibility is a table filled on use.

Read from a ``tokenizers`` file of byte-level BPE, with or without a word-end
suffix, special tokens, NFC / white space / lower-case normalisation.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from tamiz.llm.frames import kept_in_worker, ship_package

#: Words kept with their tokens in a worker, in two generations of this size;
#: when the newer one is full, the older one is forgotten.
CACHED_WORDS = 1 << 16
#: Rows handed on together.
ROWS = 256
NO_IDS = np.empty(0, np.int32)
#: Most tokens decoded at once.
DECODE_TOKENS = 1 << 18

# The split of byte-level files that name none, and white space as
# Unicode defines it (Python's own split also takes U+001C to U+001F).
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PRINTABLE = re.compile("[!-~]*")
NOT_SPACE_BUT_SPLIT_BY_PYTHON = regex.compile("[\x1c-\x1f]")

_NEVER = 1 << 60
_FINAL = 0x2000  # added to the last character of a word, where the file has a word-end suffix


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if it is printable
    Latin-1, else the next free one from 256 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in set(kept)]
    names = {byte: chr(byte) for byte in kept} | {byte: chr(256 + n) for n, byte in enumerate(rest)}
    return [names[byte] for byte in range(256)]


class BpeTokenizer:
    """Encodes and decodes with the vocabulary and merges of one file."""

    def __init__(self, text: str, encodes: bool = True):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("dropout"):
            raise ValueError("only byte-level BPE without dropout or fallback is read")
        self.suffix = model.get("end_of_word_suffix") or ""
        self._alphabet = byte_alphabet()
        self._read_decoding(spec, model)
        if not encodes:
            return
        self._read_text_rules(spec)
        self._read_merges(model)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = regex.compile(
            "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) or "(?!)"
        )
        self._pairs: dict[tuple[int, int], bool] = {}
        self._cache: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    # -- reading the file --

    def _read_text_rules(self, spec: dict) -> None:
        normalizer = spec.get("normalizer") or {"normalizers": []}
        steps = normalizer.get("normalizers", [normalizer])
        self._nfc = self._lower = self._squeeze = False
        for step in steps:
            if step["type"] == "NFC":
                self._nfc = True
            elif step["type"] == "Lowercase":
                self._lower = True
            elif step["type"] == "Replace" and step["pattern"] == {"Regex": "\\s+"} and step["content"] == " ":
                self._squeeze = True
            else:
                raise ValueError(f"unknown normalisation {step}")
        before = spec["pre_tokenizer"]
        before = before.get("pretokenizers", [before])
        if before[0]["type"] == "Split" and before[0]["behavior"] == "Removed" and before[0]["invert"]:
            split, self._by_space = before[0]["pattern"]["Regex"], True
        elif before[0]["type"] == "ByteLevel" and before[0]["use_regex"] and not before[0]["add_prefix_space"]:
            split, self._by_space = BYTE_LEVEL_SPLIT, False
        else:
            raise ValueError(f"unknown split {before}")
        split = split.replace("[^\\s", f"[^{WHITE_SPACE}").replace("\\s", f"[{WHITE_SPACE}]")
        self._split = regex.compile(split.replace("\\S", f"[^{WHITE_SPACE}]"))

    def _symbols(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            token = token[: -len(self.suffix)]
            return token[:-1] + chr(ord(token[-1]) + _FINAL)
        return token

    def _read_merges(self, model: dict) -> None:
        ids = {self._symbols(token): number for token, number in model["vocab"].items()}
        size = max(ids.values()) + 1
        self._born, self._left, self._right = [-1] * size, [-1] * size, [-1] * size
        self._length = [0] * size
        self._merge: dict[tuple[int, int], int] = {}
        for symbols, number in ids.items():
            self._length[number] = len(symbols)
        made = [number for symbols, number in ids.items() if len(symbols) == 1]
        for rank, (a, b) in enumerate(m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            left, right = model["vocab"][a], model["vocab"][b]
            whole = model["vocab"][a + b]
            if max(self._born[left], self._born[right]) >= rank or self._born[whole] >= 0:
                raise ValueError("the merges do not build every token once, from earlier ones")
            # A token that other merges would tear apart is never made.
            if self.compatible(left, right):
                made.append(whole)
            self._merge[left, right] = rank
            self._born[whole], self._left[whole], self._right[whole] = rank, left, right
        by_number = {number: symbols for symbols, number in ids.items()}
        marks = (0, _FINAL) if self.suffix else (0,)
        if any(chr(ord(c) + mark) not in ids for c in self._alphabet for mark in marks):
            raise ValueError("the vocabulary lacks a byte")
        self._automaton = ahocorasick.Automaton()
        usable = {by_number[number]: number for number in made}
        for symbols, number in usable.items():
            self._automaton.add_word(symbols, number)
        self._automaton.make_automaton()
        self._shorter = [-1] * size
        for symbols, number in usable.items():
            for end in range(len(symbols) - 1, 0, -1):
                if symbols[:end] in usable:
                    self._shorter[number] = usable[symbols[:end]]
                    break

    def _read_decoding(self, spec: dict, model: dict) -> None:
        names = {number: token for token, number in model["vocab"].items()}
        names |= {t["id"]: t["content"] for t in spec["added_tokens"]}
        decoder = spec.get("decoder")
        if decoder and decoder["type"] != "ByteLevel":
            raise ValueError(f"unknown decoder {decoder}")
        self.lossy = bool(decoder)
        byte_of = {ord(c): byte for byte, c in enumerate(self._alphabet)}
        pieces = []
        for number in range(max(names) + 1):
            name = names.get(number, "")
            if decoder and all(ord(c) in byte_of for c in name):
                pieces.append(bytes(byte_of[ord(c)] for c in name))
            else:
                # Without a decoder the tokens are written out, a blank between them.
                pieces.append(name.encode() + (b"" if decoder else b" "))
        self._text = np.frombuffer(b"".join(pieces), np.uint8)
        self._offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        self._between = 0 if decoder else 1

    # -- encoding --

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave the seam between ``a`` and ``b`` alone.

        Walks back through the building of both: the pieces that touch the seam
        at a time, until each is a single byte.  A merge of the two touching
        pieces happens if it comes before the one that uses up either; of equal
        merges the one further left comes first.
        """
        merge, born = self._merge, self._born
        a_used = b_used = _NEVER
        while True:
            rank = merge.get((a, b))
            if rank is not None and rank < a_used and rank <= b_used:
                return False
            if born[a] > born[b]:
                a_used, a = born[a], self._right[a]
            elif born[b] >= 0:
                b_used, b = born[b], self._left[b]
            else:
                return True

    def _fits(self, a: int, b: int) -> bool:
        known = self._pairs.get((a, b))
        if known is None:
            if len(self._pairs) >= 2 * CACHED_WORDS:
                self._pairs.clear()
            known = self._pairs[a, b] = self.compatible(a, b)
        return known

    def encode_word(self, word: str) -> list[int]:
        """Token ids of one piece of text that the split rule does not divide."""
        if PRINTABLE.fullmatch(word):
            symbols = word  # each of these characters stands for itself
        else:
            symbols = "".join([self._alphabet[byte] for byte in word.encode()])
        if self.suffix and symbols:
            symbols = symbols[:-1] + chr(ord(symbols[-1]) + _FINAL)
        size, lengths = len(symbols), self._length
        longest = [-1] * (size + 1)
        for end, number in self._automaton.iter(symbols):
            longest[end - lengths[number] + 1] = number  # ends only grow: the last is the longest
        found: list[int] = []
        failed = bytearray(size + 1)
        at, token = 0, longest[0]
        while at < size:
            while token >= 0:
                end = at + lengths[token]
                if not failed[end] and (not found or self._fits(found[-1], token)):
                    break
                token = self._shorter[token]
            if token >= 0:
                found.append(token)
                at = end
                token = longest[at]
            else:
                failed[at] = 1
                last = found.pop()
                at -= lengths[last]
                token = self._shorter[last]
        return found

    def _ids_of(self, word: str) -> bytes:
        ids = self._cache.get(word)
        if ids is None:
            ids = self._older.get(word)
            if ids is None:
                pieces = self._split.findall(word) if self._by_space else [word]
                if len(pieces) == 1 and pieces[0] == word:
                    ids = array("i", self.encode_word(word)).tobytes()
                else:
                    ids = b"".join([self._ids_of(piece) for piece in pieces])
            if len(word) <= 64:
                if len(self._cache) >= CACHED_WORDS:
                    self._cache, self._older = {}, self._cache
                self._cache[word] = ids
        return ids

    def _plain(self, text: str) -> list[bytes]:
        if self._nfc:
            text = unicodedata.normalize("NFC", text)
        if self._lower:
            # Letter by letter: no final sigma.
            text = text.replace("Σ", "σ").lower()
        if not self._by_space:
            pieces = self._split.findall(text)
        elif NOT_SPACE_BUT_SPLIT_BY_PYTHON.search(text):
            pieces = self._split.findall(text)
        else:
            pieces = text.split()  # no piece of the split rule holds white space
        ids = self._ids_of
        return [ids(piece) for piece in pieces]

    def encode(self, text: str | None) -> bytes:
        """Token ids as little-endian 32-bit integers; special tokens written in
        the text are recognised, none is added."""
        if not text:
            return b""
        found, at = [], 0
        for match in self._special.finditer(text):
            found += self._plain(text[at : match.start()])
            found.append(np.array([self.special[match[0]]], "<i4").tobytes())
            at = match.end()
        found += self._plain(text[at:] if at else text)
        return b"".join(found)

    # -- decoding --

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of a token sequence: slices of one array, by the offset table."""
        parts = []
        for at in range(0, len(ids), DECODE_TOKENS):
            some = ids[at : at + DECODE_TOKENS]
            starts = self._offsets[some]
            lengths = self._offsets[some + 1] - starts
            ends = np.cumsum(lengths)
            index = np.repeat(starts - ends + lengths, lengths)
            index += np.arange(len(index))
            parts.append(self._text[index].tobytes())
        whole = b"".join(parts)
        if self._between and whole:
            whole = whole[: -self._between]
        return whole.decode(errors="replace").encode() if self.lossy else whole


def tokenizer_of(text: str) -> BpeTokenizer:
    """The tokenizer of a file's text, built once in a worker."""
    return kept_in_worker(("bpe", hash(text)), lambda: BpeTokenizer(text))


def read_file(spark: SparkSession, path: str):
    """The text of a tokenizer file as a broadcast variable (a few MB)."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def _encoded(file) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(file.value)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                rows = batch.slice(first, ROWS)
                texts = [tokenizer.encode(text) for text in rows.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*rows.columns, _id_lists(texts)], [*rows.schema.names, "ids"])
        pa.default_memory_pool().release_unused()

    return run


def _id_lists(texts: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(t) // 4 for t in texts])]).astype(np.int32)
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(texts))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _decoded(file) -> Callable:
    """``file`` holds the decoding side of a tokenizer: its offset table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = file.value
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                rows = batch.slice(first, ROWS)
                texts = [tokenizer.decode(ids.values.to_numpy() if ids.is_valid else NO_IDS) for ids in rows.column("ids")]
                decoded = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*rows.columns, decoded], [*rows.schema.names, "decoded"])

    return run


def _both(file) -> Callable:
    """Encodes and decodes in one worker; the ids are handed on beside the text they give."""
    encoded = _encoded(file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(file.value)
        for batch in encoded(batches):
            texts = [tokenizer.decode(ids.values.to_numpy()) for ids in batch.column("ids")]
            pair = pa.StructArray.from_arrays(
                [batch.column("ids"), pa.array(texts, pa.binary()).cast(pa.string())], ["ids", "decoded"]
            )
            kept = batch.drop_columns(["ids"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pair], [*kept.schema.names, "pair"])

    return run


def encode_and_decode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", out: str = "bpe") -> DataFrame:
    """``docs`` plus a struct of each whole text's token ids and the text they decode to,
    made in one Python worker; null and '' give an empty list and ''."""
    return _mapped(docs, tokenizer_path, _both, {text_col: "text"}, out, "pair", "struct<ids:array<int>,decoded:string>")


def encode_texts(docs: DataFrame, tokenizer_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` plus the token ids of each whole text (an empty list for null or ''). """
    return _mapped(docs, tokenizer_path, _encoded, {text_col: "text"}, ids_col, "ids", "array<int>")


def decode_ids(docs: DataFrame, tokenizer_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` plus the text of each token list ('' for null or an empty list)."""
    return _mapped(docs, tokenizer_path, _decoded, {ids_col: "ids"}, text_col, "decoded", "string")


def _mapped(docs: DataFrame, path: str, make: Callable, renamed: dict, out: str, made: str, kind: str) -> DataFrame:
    """Columns pass through under numbered names, so none can clash."""
    ship_package(docs.sparkSession)
    file = read_file(docs.sparkSession, path)
    if make is _decoded:
        file = docs.sparkSession.sparkContext.broadcast(BpeTokenizer(file.value, encodes=False))
    (source, name), = renamed.items()
    others = [c for c in docs.columns if c not in (source, out)]
    inner = docs.select(
        *[docs[f"`{c}`"].alias(f"col_{n}") for n, c in enumerate(others)], docs[f"`{source}`"].alias(name)
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema]
    found = inner.mapInArrow(make(file), ", ".join([*fields, f"{made} {kind}"]))
    return found.select(
        *[F.col(f"col_{n}").alias(c) for n, c in enumerate(others)], F.col(name).alias(source), F.col(made).alias(out)
    )
