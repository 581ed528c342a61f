"""Terms of texts in numpy, without a Python object per term.

A batch of texts is one byte array; a term is a run of bytes of an alphabet, with A-Z lower-cased.  Terms
are kept in buckets by length: of up to 8 bytes as one uint64, of up to 16 as two, longer ones as
zero-padded byte strings of 32, 64, 128, ... bytes, so a bucket holds at most twice its terms' bytes.  No
alphabet has the zero byte, so padding cannot make two terms equal.  Words are big-endian: their order
is that of the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text taken at a time; a longer text is taken by itself, whole.
SLICE_BYTES = 8 << 20
WORD = 8
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def alphabet(digits: bool) -> np.ndarray:
    """Bytes of terms: ASCII letters, all of other characters, and digits if wanted."""
    keep = np.arange(256) >= 0x80
    keep[ord("A") : ord("Z") + 1] = keep[ord("a") : ord("z") + 1] = True
    keep[ord("0") : ord("9") + 1] = digits
    return keep


def pattern(digits: bool) -> str:
    """The same terms as a regular expression over characters."""
    return r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+" if digits else r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def slices(texts: pa.Array, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of ``texts`` with about ``most`` (SLICE_BYTES) bytes of text each."""
    most = most or SLICE_BYTES
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    end = np.cumsum(size)
    at = 0
    while at < len(size):
        to = int(np.searchsorted(end, (end[at - 1] if at else 0) + most, side="right"))
        to = max(to, at + 1)
        yield at, to
        at = to


@dataclass
class Terms:
    """Terms in text order: ``row`` of the batch, first byte in ``raw`` and length in bytes."""

    raw: np.ndarray
    row: np.ndarray
    start: np.ndarray
    length: np.ndarray

    def words(self, at: np.ndarray, n: int) -> list[np.ndarray]:
        """The first ``n`` words of the terms ``at``, zero-padded."""
        out = []
        for k in range(n):
            first = self.start[at] + k * WORD
            window = np.lib.stride_tricks.sliding_window_view(self.raw, WORD)
            word = window[np.minimum(first, len(window) - 1)].copy().view(">u8").ravel().astype(np.uint64)
            over = np.clip((k + 1) * WORD - self.length[at], 0, WORD)
            # a shift by all 64 bits is done as two of 32
            half = (over * 4).astype(np.uint64)
            out.append((word >> half >> half) << half << half)
        return out

    def strings(self, at: np.ndarray, width: int) -> np.ndarray:
        """The terms ``at`` as an array of byte strings of ``width``."""
        out = np.zeros((len(at), width), np.uint8)
        for i, (a, n) in enumerate(zip(self.start[at].tolist(), self.length[at].tolist())):
            out[i, :n] = self.raw[a : a + n]
        return out.view(f"S{width}").ravel()

    def buckets(self) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
        """(width in bytes, positions of its terms, their words or byte strings)."""
        width = np.full(len(self.length), WORD, np.int64)
        while True:
            small = width < self.length
            if not small.any():
                break
            width[small] *= 2
        for w in np.unique(width).tolist():
            at = np.flatnonzero(width == w)
            yield w, at, self.words(at, w // WORD) if w <= 2 * WORD else [self.strings(at, w)]


def split(texts: pa.Array, keep: np.ndarray) -> Terms:
    """All terms of ``texts`` (null: none)."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    text = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = np.zeros(len(text) + 1, bool)
    inside[:-1] = keep[text]
    first = np.zeros(len(text) + 1, bool)
    first[offsets[:-1]] = True  # a term ends with its text
    before = np.roll(inside, 1)
    before[0] = False
    start = np.flatnonzero(inside & (~before | first))
    # it ends where the byte is outside, or where the next text starts
    stop = np.flatnonzero(before & (~inside | first))
    raw = np.zeros(len(text) + 2 * WORD, np.uint8)
    raw[: len(text)] = _LOWER[text]
    row = np.searchsorted(offsets, start, side="right") - 1
    return Terms(raw, row, start, stop - start)


def radix_order(columns: list[np.ndarray]) -> np.ndarray:
    """Stable order by unsigned integer columns, the most significant first: digits of 16 bits, least
    significant first (numpy's stable sort of 16-bit numbers is a radix sort); digits in which all
    agree are skipped."""
    order = np.arange(len(columns[0]))
    for c in reversed(columns):
        if not len(c):
            break
        spread = int(np.bitwise_or.reduce(c ^ c[0]))
        for shift in range(0, c.dtype.itemsize * 8, 16):
            if (spread >> shift) & 0xFFFF:
                digit = ((c >> c.dtype.type(shift)) & c.dtype.type(0xFFFF)).astype(np.uint16)
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def order_of(columns: list[np.ndarray]) -> np.ndarray:
    """Stable order by the columns: integers by radix, byte strings by comparison."""
    if all(c.dtype.kind == "u" for c in columns):
        return radix_order(columns)
    order = np.argsort(columns[-1], kind="stable")
    return order[radix_order([c[order] for c in columns[:-1]])] if len(columns) > 1 else order


def runs(columns: list[np.ndarray]) -> np.ndarray:
    """Starts of the runs of equal rows of sorted columns."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def as_binary(columns: list[np.ndarray]) -> pa.Array:
    """Words or byte strings as an Arrow column of bytes without their padding."""
    if columns[0].dtype.kind == "u":
        both = np.stack(columns, axis=1).astype(">u8", order="C")
        columns = [both.view(f"S{WORD * len(columns)}").ravel()]
    size = np.char.str_len(columns[0])
    width = columns[0].dtype.itemsize
    flat = columns[0].view(np.uint8).reshape(len(size), width)
    data = flat[np.arange(width) < size[:, None]]
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    large = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    return large.cast(pa.binary())
