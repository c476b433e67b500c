"""A wavelet matrix of token ids in one compressed file.

The ids are kept as bit planes, the highest bit first; each plane is in the
order that the planes above it sort the ids into, zeros before ones, stably.
A plane is cut into blocks of ``BLOCK_BITS`` bits, each compressed if that makes it
smaller, and a directory tells where each block is and how many ones stand
before it.  So rank (ones before a place) reads one block, and with it the file
answers, without being read whole:

* which token stands at a place (``access``),
* how often a token occurs between two places (``count``),
* where the k-th occurrence of a token is, by select (``locate``).

Layout, all numbers little-endian:

    magic | blocks of plane 0, 1, ... | documents | directory | footer | length of the footer | magic

``documents`` is a compressed Arrow stream of (id, n_tokens) in file order, the
directory three arrays (offset, stored bytes, ones before) of one entry a block,
the footer JSON with the sizes, the places of the parts and their CRC-32s.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
import zstandard

MAGIC = b"TAMIZWM1"
#: Bits of a plane in one block.
BLOCK_BITS = 1 << 17
#: Ids sorted together.
STRETCH = 1 << 15
_TAIL_BYTES = len(MAGIC) + 4


class DamagedShard(ValueError):
    """A file that is no shard, or whose bytes are not those that were written."""


def _sorted_by(ids: np.ndarray, ones: np.ndarray, zeros: int) -> np.ndarray:
    """``ids`` with those at zeros first, stably; in stretches that stay in a cache."""
    out = np.empty_like(ids)
    low, high = 0, zeros
    for begin in range(0, len(ids), STRETCH):
        here, bits = ids[begin : begin + STRETCH], ones[begin : begin + STRETCH]
        up, down = np.flatnonzero(bits), np.flatnonzero(~bits)
        # The places are all there: "clip" only spares a copy.
        here.take(down, out=out[low : low + len(down)], mode="clip")
        here.take(up, out=out[high : high + len(up)], mode="clip")
        low, high = low + len(down), high + len(up)
    return out


def _sorted_back(ids: np.ndarray, ones: np.ndarray, zeros: int) -> np.ndarray:
    """What ``_sorted_by`` was given."""
    out = np.empty_like(ids)
    low, high = 0, zeros
    for begin in range(0, len(ids), STRETCH):
        here, bits = out[begin : begin + STRETCH], ones[begin : begin + STRETCH]
        up, down = np.flatnonzero(bits), np.flatnonzero(~bits)
        here[down], here[up] = ids[low : low + len(down)], ids[high : high + len(up)]
        low, high = low + len(down), high + len(up)
    return out


def planes_of(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    """The bit planes of the wavelet matrix, each packed eight bits a byte."""
    planes = []
    for bit in range(bits - 1, -1, -1):
        ones = (ids & ids.dtype.type(1 << bit)) != 0
        planes.append(np.packbits(ones, bitorder="little"))
        if bit:
            ids = _sorted_by(ids, ones, len(ids) - int(np.count_nonzero(ones)))
    return planes


def ids_of(planes: list[np.ndarray], size: int) -> np.ndarray:
    """The ids whose planes these are, from the lowest plane up."""
    ids = np.zeros(size, np.uint16 if len(planes) <= 16 else np.uint32)
    for bit, plane in enumerate(reversed(planes)):
        ones = np.unpackbits(plane, count=size, bitorder="little").view(bool)
        if bit:
            ids = _sorted_back(ids, ones, size - int(np.count_nonzero(ones)))
        ids |= ones.astype(ids.dtype) << ids.dtype.type(bit)
    return ids


def shard_bytes(
    ids: np.ndarray, documents: pa.RecordBatch, block_bits: int = BLOCK_BITS, level: int = 1
) -> bytes:
    """The file of ``ids`` (unsigned), which are those of ``documents`` (id, n_tokens) in order;
    ``block_bits`` is a multiple of 8."""
    squeeze = zstandard.ZstdCompressor(level=level).compress
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    parts, offset = [MAGIC], len(MAGIC)
    directory, zeros = [], []
    for plane in planes_of(ids, bits):
        before = 0
        for begin in range(0, len(plane), block_bits // 8):
            raw = plane[begin : begin + block_bits // 8].tobytes()
            stored = min(raw, squeeze(raw), key=len)
            directory.append((offset, len(stored), before))
            before += int.from_bytes(raw, "little").bit_count()
            parts.append(stored)
            offset += len(stored)
        zeros.append(len(ids) - before)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, documents.schema) as stream:
        stream.write_batch(documents)
    documents_part = squeeze(sink.getvalue().to_pybytes())
    directory_part = squeeze(np.array(directory, "<i8").reshape(-1, 3).T.tobytes())
    planes_crc = 0
    for part in parts[1:]:
        planes_crc = zlib.crc32(part, planes_crc)
    footer = json.dumps(
        {
            "tokens": len(ids),
            "documents": documents.num_rows,
            "bits": bits,
            "zeros": zeros,
            "block_bits": block_bits,
            "documents_at": [offset, len(documents_part), zlib.crc32(documents_part)],
            "directory_at": [offset + len(documents_part), len(directory_part), zlib.crc32(directory_part)],
            "planes_crc": planes_crc,
        }
    ).encode()
    tail = [documents_part, directory_part, footer, len(footer).to_bytes(4, "little"), MAGIC]
    return b"".join(parts + tail)


class TokenShard:
    """Reads one file; ``opened`` has ``size()`` and ``read_at(count, offset)``, as the
    files of ``pyarrow.fs`` have.  Only the blocks that a question needs are read."""

    def __init__(self, opened):
        self._file = opened
        size = opened.size()
        end = size - _TAIL_BYTES
        tail = self._read(end, _TAIL_BYTES) if end >= len(MAGIC) else b""
        if tail[4:] != MAGIC or self._read(0, len(MAGIC)) != MAGIC:
            raise DamagedShard("not a shard, or cut off")
        length = min(end, int.from_bytes(tail[:4], "little"))
        try:
            footer = json.loads(self._read(end - length, length))
            self.size, self.bits, self.zeros = footer["tokens"], footer["bits"], footer["zeros"]
            self._documents_at, self._planes_crc = footer["documents_at"], footer["planes_crc"]
            self._block_bits, directory_at = footer["block_bits"], footer["directory_at"]
        except (ValueError, KeyError, TypeError) as problem:
            raise DamagedShard("the footer cannot be read") from problem
        directory = np.frombuffer(self._part(directory_at), "<i8")
        self._offset, self._stored, self._before = directory.reshape(3, self.bits, -1)
        self._held: tuple[tuple[int, int], np.ndarray] | None = None

    # -- bytes --

    def _read(self, offset: int, count: int) -> bytes:
        return bytes(self._file.read_at(count, offset))

    def _part(self, place: list[int]) -> bytes:
        offset, length, crc = place
        stored = self._read(offset, length)
        if zlib.crc32(stored) != crc:
            raise DamagedShard("a part has other bytes than were written")
        return zstandard.ZstdDecompressor().decompress(stored, max_output_size=1 << 31)

    def _opened_block(self, stored: bytes, plane: int, block: int) -> np.ndarray:
        wanted = min(self._block_bits, self.size - block * self._block_bits)
        if len(stored) != (wanted + 7) // 8:
            try:
                stored = zstandard.ZstdDecompressor().decompress(stored, max_output_size=(wanted + 7) // 8)
            except zstandard.ZstdError as problem:
                raise DamagedShard(f"block {block} of plane {plane}") from problem
        return np.unpackbits(np.frombuffer(stored, np.uint8), count=wanted, bitorder="little")

    def _block(self, plane: int, block: int) -> np.ndarray:
        """The bits of one block; the last one is kept."""
        if self._held is None or self._held[0] != (plane, block):
            stored = self._read(int(self._offset[plane, block]), int(self._stored[plane, block]))
            self._held = (plane, block), self._opened_block(stored, plane, block)
        return self._held[1]

    # -- rank and select --

    def _rank(self, plane: int, places: np.ndarray) -> np.ndarray:
        """Ones of the plane before each place (0 to ``size``)."""
        out = np.empty(len(places), np.int64)
        blocks = np.minimum(places // self._block_bits, max(0, self._offset.shape[1] - 1))
        for block in np.unique(blocks):
            here = blocks == block
            ones = np.concatenate([[0], np.cumsum(self._block(plane, int(block)), dtype=np.int64)])
            out[here] = self._before[plane, block] + ones[places[here] - block * self._block_bits]
        return out

    def _select(self, plane: int, bit: int, ordinals: np.ndarray) -> np.ndarray:
        """Place of the ordinal-th (from 0) ``bit`` of the plane."""
        starts = np.arange(self._offset.shape[1]) * self._block_bits
        before = self._before[plane] if bit else starts - self._before[plane]
        blocks = np.searchsorted(before, ordinals, "right") - 1
        out = np.empty(len(ordinals), np.int64)
        for block in np.unique(blocks):
            here = blocks == block
            found = np.flatnonzero(self._block(plane, int(block)) == bit)
            out[here] = starts[block] + found[ordinals[here] - before[block]]
        return out

    # -- questions --

    def access(self, places) -> np.ndarray:
        """The tokens at the places (0 to ``size`` - 1)."""
        places = np.asarray(places, np.int64)
        if len(places) and not (0 <= places.min() and places.max() < self.size):
            raise IndexError("no such place")
        tokens = np.zeros(len(places), np.int64)
        for plane in range(self.bits):
            ones = self._rank(plane, places)
            bit = self._rank(plane, places + 1) - ones
            places = np.where(bit == 1, self.zeros[plane] + ones, places - ones)
            tokens = tokens * 2 + bit
        return tokens

    def _range(self, token: int, begin: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` from ``begin`` to ``end`` stand after the last plane."""
        if token < 0 or token >> self.bits:
            return 0, 0
        for plane in range(self.bits):
            if begin == end:
                break
            low, high = self._rank(plane, np.array([begin, end])).tolist()
            if token >> (self.bits - 1 - plane) & 1:
                begin, end = self.zeros[plane] + low, self.zeros[plane] + high
            else:
                begin, end = begin - low, end - high
        return begin, end

    def count(self, token: int, begin: int = 0, end: int | None = None) -> int:
        """How often ``token`` stands at ``begin`` to ``end`` - 1."""
        end = self.size if end is None else min(end, self.size)
        low, high = self._range(token, min(max(0, begin), end), end)
        return high - low

    def locate(self, token: int, first: int = 0, last: int | None = None) -> np.ndarray:
        """Places of the occurrences ``first`` to ``last`` - 1 of ``token``, ascending; those that
        the file does not hold are left out."""
        low, high = self._range(token, 0, self.size)
        if low >= high:
            return np.empty(0, np.int64)
        places = np.arange(low, high)[max(0, first) : last]
        for plane in range(self.bits - 1, -1, -1):
            if token >> (self.bits - 1 - plane) & 1:
                places = self._select(plane, 1, places - self.zeros[plane])
            else:
                places = self._select(plane, 0, places)
        return places

    # -- the whole file --

    def documents(self) -> pa.Table:
        """(id, n_tokens) of the documents in file order."""
        return pa.ipc.open_stream(self._part(self._documents_at)).read_all()

    def ids(self) -> np.ndarray:
        """All tokens in order; the planes are read in one piece and checked."""
        if not self.size:
            return np.empty(0, np.uint16)
        begin = len(MAGIC)
        raw = self._read(begin, self._documents_at[0] - begin)
        if zlib.crc32(raw) != self._planes_crc:
            raise DamagedShard("the planes have other bytes than were written")
        planes = []
        for plane in range(self.bits):
            blocks = []
            for block in range(self._offset.shape[1]):
                offset = int(self._offset[plane, block]) - begin
                stored = raw[offset : offset + int(self._stored[plane, block])]
                wanted = (min(self._block_bits, self.size - block * self._block_bits) + 7) // 8
                if len(stored) != wanted:
                    stored = zstandard.ZstdDecompressor().decompress(stored, max_output_size=wanted)
                blocks.append(stored)
            planes.append(np.frombuffer(b"".join(blocks), np.uint8))
        return ids_of(planes, self.size)
