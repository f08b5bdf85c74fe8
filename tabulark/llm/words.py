"""Texts inside Arrow tasks: null-safe bytes, bounded chunks, words, hashes.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r; no such byte
occurs inside a multi-byte UTF-8 sequence, so byte positions suffice.
Chunks bound the arrays held at once (a chunk is one text at least), so memory
follows the longest text and not the Arrow batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

CHUNK_BYTES = 2 << 20
_LONG = 128  # bytes; words beyond are hashed one by one

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)
_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as the empty text."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [lo, hi) of consecutive texts with about ``limit`` bytes in all."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser, element by element (wraps modulo 2**64)."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of several texts, as byte ranges of one buffer.

    ``first[d] : first[d + 1]`` are the words of text d; ``raw`` is the buffer.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.raw = b"\n".join(texts) + b"\n"
        if lower:
            self.raw = self.raw.lower()  # bytes.lower() changes A-Z alone
        buf = np.frombuffer(self.raw, dtype=np.uint8)
        solid = np.empty(len(buf) + 1, dtype=np.int8)
        solid[0] = 0
        np.logical_not(WHITE[buf], out=solid[1:].view(bool))
        step = np.diff(solid)
        self.start = np.flatnonzero(step == 1)
        self.end = np.flatnonzero(step == -1)
        at = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=at[1:])
        self.text_at = at
        self.first = np.searchsorted(self.start, at)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        """Text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.end[i]]

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word: whole 8-byte pieces, mixed in turn."""
        return hash_ranges(self.raw, self.start, self.end)


def hash_ranges(raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range ``raw[start:end]``; equal bytes give
    equal hashes whatever buffer they stand in."""
    size = end - start
    h = mix(size.astype(np.uint64) * _M1 + _M1)
    padded = raw + bytes(8)
    eights = np.ndarray((len(raw) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    if len(start):
        h = mix(h ^ (eights[start] & _TAIL[np.minimum(size, 8)]))
        live = np.flatnonzero(size > 8)
        done = 8
        while len(live):
            longer = live[size[live] <= _LONG] if done == 8 else live
            if done == 8 and len(longer) < len(live):
                for i in live[size[live] > _LONG]:
                    digest = hashlib.blake2b(raw[start[i]:end[i]], digest_size=8).digest()
                    h[i] = int.from_bytes(digest, "little")
                live = longer
                if not len(live):
                    break
            part = eights[start[live] + done] & _TAIL[np.minimum(size[live] - done, 8)]
            h[live] = mix(h[live] * _M1 ^ part)
            done += 8
            live = live[size[live] > done]
    return h


def combine(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive values (len(h) - n + 1 of them)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = h[:m].copy()
    for k in range(1, n):
        out = mix(out * _M1 + h[k:k + m])
    return out
