"""Texts as byte arrays inside a task: words, polynomial hashes, Arrow columns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Fixed values of the contracts: white space that parts words, and the bytes of
# benchmark words (digits, letters, everything beyond ASCII).
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def space_words() -> np.ndarray:
    """Which bytes belong to words ``[^\\x20\\x09-\\x0D]+``."""
    table = np.ones(256, bool)
    table[list(SPACES)] = False
    return table


def plain_words() -> np.ndarray:
    """Which bytes belong to words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    table = np.zeros(256, bool)
    table[0x30:0x3A] = table[0x61:0x7B] = table[0x80:] = True
    return table


def lowered(buf: np.ndarray) -> np.ndarray:
    """A-Z as a-z, all other bytes unchanged."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    return table[buf]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column and the offset of each; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    offs = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offs = offs.astype(np.int64)
    if data is None or not len(offs) or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def blocks(offs: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``size`` bytes; a longer text is a range of its own."""
    at, n = 0, len(offs) - 1
    while at < n:
        to = int(np.searchsorted(offs, offs[at] + size, "right")) - 1
        to = min(n, max(to, at + 1))
        yield at, to
        at = to


def text_blocks(batches, column: str = "text", size: int = 1 << 20):
    """(batch rows, bytes, offsets) for ranges of whole texts of each Arrow batch."""
    for batch in batches:
        buf, offs = text_bytes(batch.column(column))
        for i, j in blocks(offs, size):
            yield batch.slice(i, j - i), buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]


def word_spans(buf: np.ndarray, offs: np.ndarray, table: np.ndarray):
    """Start and end byte of each word, and the first word of each text (one more at the end)."""
    n = len(buf)
    inside = table[buf]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    if n:
        before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _tables(n: int, which: int):
    if which not in _powers or len(_powers[which][0]) < n:
        size = max(n, 1 << 16)
        up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
        up[1:] = _BASES[which]
        down[1:] = pow(_BASES[which], -1, 1 << 64)
        _powers[which] = np.cumprod(up), np.cumprod(down)
    return _powers[which]


# Runs of so many symbols get a digest: sums modulo 2**64 are equal for some regular strings of
# two symbols (such as Thue-Morse), for any odd base, from about 1,024 symbols on.
DIGEST_FROM = 512


class Rolling:
    """Hashes of any run of a sequence of 64-bit symbols, from prefix sums modulo 2**64; long runs by a digest."""

    def __init__(self, symbols: np.ndarray, which: int = 0):
        self.symbols, self.person = symbols, bytes([which])
        up, self.down = _tables(len(symbols) + 1, which)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * up[:len(symbols)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the symbols from ``start`` up to ``end`` (exclusive)."""
        length = (np.asarray(end) - start).astype(np.uint64)
        out = mixed((self.sums[end] - self.sums[start]) * self.down[start] + length)
        for i in np.flatnonzero(length >= DIGEST_FROM).tolist():
            data = np.ascontiguousarray(self.symbols[start[i]:end[i]]).tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(data, digest_size=8, person=self.person).digest(), "little")
        return out


def byte_symbols(buf: np.ndarray, which: int = 0) -> np.ndarray:
    seeds = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASES[which] | 1))
    return seeds[buf]


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    return Rolling(byte_symbols(buf, which), which).of(starts, ends)


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the half-open ranges, and the range that each comes from."""
    size = np.maximum(np.asarray(ends) - starts, 0)
    which = np.repeat(np.arange(len(size)), size)
    first = np.cumsum(size) - size
    return np.arange(int(size.sum())) - first[which] + np.asarray(starts)[which], which


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Mask over n places: which lie in any of the half-open ranges."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


def longs(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64) if h.dtype == np.uint64 else h.astype(np.int64))
