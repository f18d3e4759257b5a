"""Words of whole texts as numpy arrays, for tasks that receive Arrow batches.

A batch's text column is seen as one byte buffer; words are runs of word bytes inside a
document. All separators used here are ASCII, so runs of UTF-8 bytes are runs of
characters. Work goes in pieces of about ``PIECE`` bytes (whole documents), so memory
does not follow the batch size; a longer document makes a piece of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PIECE = 1 << 21
LONG_WORD = 64          # bytes; longer words are hashed one by one

#: bytes of words [^\x20\x09-\x0D]+
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
LETTERS_DIGITS = np.zeros(256, bool)
LETTERS_DIGITS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_LANE = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer (a bijection of 64-bit values)."""
    h = h ^ (h >> np.uint64(30))
    h *= _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return h


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values, offsets); null is empty."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64)[col.offset: col.offset + len(col) + 1]
    buf = np.frombuffer(data, np.uint8)[offs[0]: offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


def pieces(batch: pa.RecordBatch, col: str, limit: int = PIECE):
    """Slices of ``batch`` of whole rows with about ``limit`` text bytes each, with the
    slice's bytes and offsets."""
    buf, offs = flat(batch.column(batch.schema.get_field_index(col)))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at), buf[offs[at]: offs[to]], offs[at: to + 1] - offs[at]
        at = to


class Words:
    """Words of a piece: ``start``/``end`` byte positions, ``doc`` row of each word,
    ``first`` index of each document's first word (one entry more than documents)."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, lower: bool, word_bytes: np.ndarray = NON_SPACE):
        if lower:
            buf = LOWER[buf]
        self.buf, n = buf, len(buf)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = word_bytes[buf]
        cut = np.zeros(n + 1, bool)         # a document border also ends a word
        cut[offs] = True
        before, after = inside[:-1], inside[1:]
        self.start = np.flatnonzero(after & (~before | cut))
        self.end = np.flatnonzero(before & (~after | cut))
        self.first = np.searchsorted(self.start, offs)
        self.n_words = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offs) - 1), self.n_words)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes, eight bytes at a time."""
        padded = np.concatenate([self.buf, np.zeros(8, np.uint8)])
        lanes = np.ndarray(shape=(len(self.buf) + 1,), dtype="<u8", buffer=padded, strides=(1,))
        size = self.end - self.start
        h = mix((lanes[self.start] & _LANE[np.minimum(size, 8)]) + size.astype(np.uint64) * _M3)
        at = 8
        live = np.flatnonzero(size > at)
        while len(live) and at < LONG_WORD:
            left = np.minimum(size[live] - at, 8)
            h[live] = mix(h[live] * _M3 + (lanes[self.start[live] + at] & _LANE[left]))
            at += 8
            live = live[size[live] > at]
        for i in live:
            h[i] = xxhash.xxh64_intdigest(self.buf[self.start[i]: self.end[i]].tobytes())
        return h

    def ends(self, size: int) -> np.ndarray:
        """64-bit hash of each word's last ``size`` (at most 8) bytes."""
        padded = np.concatenate([self.buf, np.zeros(8, np.uint8)])
        lanes = np.ndarray(shape=(len(self.buf) + 1,), dtype="<u8", buffer=padded, strides=(1,))
        n = np.minimum(self.end - self.start, size)
        return mix((lanes[self.end - n] & _LANE[n]) + n.astype(np.uint64) * _M3)

    def text(self, i: int) -> bytes:
        return self.buf[self.start[i]: self.end[i]].tobytes()


def ngrams(h: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all runs of ``k`` consecutive entries of ``h`` (len - k + 1)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    if k == 1:
        return h
    half = k // 2
    a = ngrams(h, half)
    two = mix(a[: len(a) - half] * _M3 + a[half:])
    return two if k % 2 == 0 else mix(two[: len(two) - 1] * _M3 + h[k - 1:])


def in_one_doc(doc: np.ndarray, k: int) -> np.ndarray:
    """Whether each run of ``k`` words lies in one document."""
    return doc[k - 1:] == doc[: len(doc) - k + 1] if len(doc) >= k else np.zeros(0, bool)
