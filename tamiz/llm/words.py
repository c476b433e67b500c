"""Words of whole texts as 64-bit hashes, computed for many texts at once.

A batch of texts is one array of UTF-8 bytes (Arrow's own buffer, not copied)
plus offsets.  The hash of a word is a polynomial in its bytes, taken from one
running sum over the batch, so no Python object is made per word.  Different
words share a hash with a probability of about n^2 / 2^65 for n distinct words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked on in slices of about this many bytes (one longer text is a slice of its own).
SLICE_BYTES = 1 << 20
_U = np.uint64
_BASE, _STEP = _U(0x9E3779B97F4A7C15), _U(0xD1342543DE82EF95)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of SplitMix64)."""
    values = values ^ (values >> _U(30))
    values = values * _U(0xBF58476D1CE4E5B9)
    values = values ^ (values >> _U(27))
    values = values * _U(0x94D049BB133111EB)
    return values ^ (values >> _U(31))


def lowered(values: np.ndarray) -> np.ndarray:
    """Byte values with A-Z as a-z."""
    return np.where((values >= 65) & (values <= 90), values + 32, values)


def separators(spaces_only: bool) -> np.ndarray:
    """Which byte values end a word: blanks only, or all ASCII but letters and digits."""
    byte = np.arange(256)
    blank = (byte == 0x20) | ((byte >= 0x09) & (byte <= 0x0D))
    if spaces_only:
        return blank
    kept = (byte >= 0x80) | ((byte >= 48) & (byte <= 57)) | ((lowered(byte) >= 97) & (lowered(byte) <= 122))
    return ~kept


BLANKS, NOT_ALPHANUMERIC = separators(True), separators(False)
_LETTER = mixed(lowered(np.arange(256)).astype(_U) + _BASE)

_EXACT_LETTER = mixed(np.arange(256).astype(_U) + _BASE)
#: Powers are kept for this many bytes; longer texts are hashed piece by piece.
_PIECE = 1 << 18


def _powers_of(factor: int, count: int) -> np.ndarray:
    """The first ``count`` powers of ``factor`` modulo 2^64."""
    return np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(count - 1, factor, _U)]))


_INVERSE = pow(int(_STEP), -1, 1 << 64)
_POWER, _INVERSE_POWER = _powers_of(int(_STEP), _PIECE), _powers_of(_INVERSE, _PIECE)


def _powers_up_to(size: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``size`` powers of the step, and of its inverse; only the first ones are kept."""
    if size <= _PIECE:
        return _POWER, _INVERSE_POWER
    return _powers_of(int(_STEP), size), _powers_of(_INVERSE, size)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, offsets


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets from 0) of consecutive runs of texts of about ``limit`` bytes."""
    data, offsets = text_buffers(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, rows)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = BLANKS
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased (A-Z) words of each text in order, and the
    position in that array at which each text begins (one more entry at the end)."""
    starts, ends = word_spans(data, offsets, separator)
    begins = np.searchsorted(starts, offsets)
    begins[-1] = len(starts)
    return hashes_of(data, starts, ends), begins


def word_spans(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; a word never runs from one text into the next."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~separator[data]
    starts = inside[1:] & ~inside[:-1]
    ends = inside[:-1] & ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    through = cuts[inside[cuts] & inside[cuts + 1]]
    starts[through] = True
    ends[through] = True
    return np.flatnonzero(starts), np.flatnonzero(ends)


def hashes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, letters: np.ndarray = _LETTER) -> np.ndarray:
    """Hash of each span of ``data``, whose values are looked up in ``letters``."""
    pieces = len(data) // _PIECE + 1
    piece_power = _powers_of(pow(int(_STEP), _PIECE, 1 << 64), pieces)
    piece_inverse = _powers_of(pow(_INVERSE, _PIECE, 1 << 64), pieces)
    sums = np.zeros(len(data) + 1, _U)
    for piece, factor in enumerate(piece_power):
        begin, end = piece * _PIECE, min(len(data), (piece + 1) * _PIECE)
        values = letters[data[begin:end]] * _POWER[: end - begin]
        sums[begin + 1 : end + 1] = sums[begin] + np.cumsum(values * factor if piece else values, dtype=_U)
    inverse = _INVERSE_POWER[starts % _PIECE] * piece_inverse[starts // _PIECE]
    return mixed((sums[ends] - sums[starts]) * inverse + (ends - starts).astype(_U))


def exact_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of ``data`` as it is spelled, capitals and all."""
    return hashes_of(data, starts, ends, _EXACT_LETTER)


def joined(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive values."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, _U)
    out = np.full(count, _U(size))
    for shift in range(size):
        out = (out ^ hashes[shift : shift + count]) * _BASE
        out ^= out >> _U(29)
    return mixed(out)


class HashTable:
    """Vectorised look-up of 64-bit keys in a fixed set: open addressing, numpy only."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.asarray(keys, _U)
        bits = max(4, int(np.ceil(np.log2(max(1, len(self.keys)) * 2.5))))
        self.shift = _U(64 - bits)
        self.mask = (1 << bits) - 1
        self.slot = np.full(1 << bits, -1, np.int32)
        place = self._place(self.keys)
        left = np.arange(len(self.keys), dtype=np.int32)
        while len(left):
            free = self.slot[place] < 0
            self.slot[place[free]] = left[free]
            placed = self.slot[place] == left
            left, place = left[~placed], (place[~placed] + 1) & self.mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _BASE) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key in the set, -1 if it is not there."""
        out = np.full(len(keys), -1, np.int32)
        if not len(self.keys):
            return out
        place, rest = self._place(keys), np.arange(len(keys))
        while len(rest):
            at = self.slot[place]
            hit = (at >= 0) & (self.keys[at] == keys[rest])
            out[rest[hit]] = at[hit]
            on = (at >= 0) & ~hit
            rest, place = rest[on], (place[on] + 1) & self.mask
        return out
