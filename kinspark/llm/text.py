"""Whole batches of UTF-8 text as NumPy arrays: words, span hashes and runs without a Python step for each word."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time inside a batch; a longer document makes a chunk of its own.
CHUNK_BYTES = 1 << 19

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Two primes under 2**31 with a base each: spans are hashed as polynomials modulo both.
_PRIMES = (2**31 - 1, 2**31 - 19)
_BASES = tuple(int(b) for b in np.random.Generator(np.random.PCG64(20240607)).integers(2**20, 2**31 - 20, 2))
#: Bytes that are summed before a remainder is taken: 2**8 * 2**31 * 2**24 stays under 2**64.
_SUMMED = 1 << 24
_CODES = np.arange(1, 257, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def frees_memory(run: Callable) -> Callable:
    """At the end of a task, give memory back to the system: a worker stays alive while others run beside it."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return task


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts are Python strings at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_of(base: int, prime: int, n: int) -> np.ndarray:
    """base**k modulo prime for k < n; kept, and doubled when more are needed."""
    out = _powers.get(base, np.ones(1, dtype=np.uint64))
    while len(out) < n:
        step = np.uint64(pow(base, len(out), prime))
        out = np.concatenate([out, out * step % np.uint64(prime)])
    if len(out) <= 2 * CHUNK_BYTES:
        _powers[base] = out
    return out


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str, size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with about ``size`` bytes of text, each with the bytes and offsets of its rows."""
    at, n = batch.schema.get_field_index(column), batch.num_rows
    _, offsets = utf8(batch.column(at))
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        part = batch.slice(first, last - first)
        data, own = utf8(part.column(at))
        yield part, data, own
        first = last


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of some documents: byte spans, document of each, and 64-bit hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data, self.offsets = (_LOWER[data] if lower else data), offsets
        inside = ~_SPACE[data]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = offsets[1:-1]
        before[edges[edges < len(data)]] = False
        after[edges[edges > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.inside = inside
        self.document = np.searchsorted(offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.document, minlength=len(offsets) - 1).astype(np.int64)
        self.firsts = np.concatenate([[0], np.cumsum(self.counts)])

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)


def _prefix_sums(data: np.ndarray, powers: np.ndarray, prime: int) -> np.ndarray:
    """Sums of (byte + 1) * powers, right modulo ``prime``."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    for k in range(0, len(data), _SUMMED):
        part = _CODES[data[k : k + _SUMMED]]
        part *= powers[k : k + len(part)]
        own = sums[k + 1 : k + 1 + len(part)]
        np.cumsum(part, out=own)
        if k:
            own += sums[k] % np.uint64(prime)
    return sums


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte spans that depend on the bytes alone: 62 bits of remainders modulo two primes, and the length, mixed.

    (Modulo a power of two, strings such as Thue and Morse's would meet whatever the base.)"""
    out = (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, (base, prime) in enumerate(zip(_BASES, _PRIMES, strict=True)):
        p = np.uint64(prime)
        sums = _prefix_sums(data, _powers_of(base, prime, len(data)), prime)
        value = (sums[ends] - sums[starts]) % p if len(data) <= _SUMMED else (sums[ends] % p + p - sums[starts] % p) % p
        value = value * _powers_of(pow(base, -1, prime), prime, len(data) + 1)[starts] % p
        out = mix(out + (value << np.uint64(31 * shift)))
    return out


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of ``size`` consecutive words, whatever documents they belong to."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + n]
    return mix(out)


def marked(spans_from: np.ndarray, spans_to: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places some half-open span covers."""
    edges = np.bincount(spans_from, minlength=n + 1)[: n + 1] - np.bincount(spans_to, minlength=n + 1)[: n + 1]
    return np.cumsum(edges)[:n] > 0
