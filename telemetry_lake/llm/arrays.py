"""Numpy helpers for whole Arrow batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
#: A random number for each byte, and an odd multiplier with its inverse modulo 2**64.
_BYTE = np.random.default_rng(20).integers(0, 2**64, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)
#: Bytes of text handled at once.
BLOCK = 4 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below n."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_kept: dict[int, np.ndarray] = {}


def _steps(base: int, n: int) -> np.ndarray:
    """``powers(base, n)``, kept for the next block: a process holds no more of them than its blocks ask for."""
    if n > BLOCK + 1:
        return powers(base, n)
    if len(_kept.get(base, ())) < n:
        _kept[base] = powers(base, min(2 * n, BLOCK + 1))
    return _kept[base][:n]


class Words:
    """The words of several texts: ``starts`` and ``ends`` in ``data`` (bytes), ``docs`` (text of each
    word), ``firsts`` (first word of each text, and the number of words)."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.texts = texts
        sizes = np.array([len(t) for t in texts], np.int64)
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8) if texts else np.zeros(0, np.uint8)
        if lower:
            self.data = _LOWER[self.data]
        inside = ~_SPACE[self.data]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.firsts = np.searchsorted(self.starts, self.offsets)
        self.docs = np.repeat(np.arange(len(texts)), np.diff(self.firsts))

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes.

        A polynomial over random numbers for the bytes, shifted to the word's start, then scrambled
        together with the length.
        """
        if not len(self):
            return np.zeros(0, np.uint64)
        n = len(self.data)
        sums = np.zeros(n + 1, np.uint64)
        shifted = _BYTE[self.data]
        shifted *= _steps(_STEP, n)
        np.cumsum(shifted, dtype=np.uint64, out=sums[1:])
        h = (sums[self.ends] - sums[self.starts]) * _steps(_BACK, n + 1)[self.starts]
        return mix64(h + mix64((self.ends - self.starts).astype(np.uint64)))


def text_blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", block: int = BLOCK
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Pieces of batches of about ``block`` bytes of text (one text at least), with the texts' bytes."""
    for batch in batches:
        texts = batch.column(column).cast(pa.binary())
        sizes = np.array([0 if v is None else v for v in pa.compute.binary_length(texts).to_pylist()], np.int64)
        at = 0
        while at < batch.num_rows:
            n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), block, side="right")))
            piece = batch.slice(at, n)
            yield piece, [b"" if v is None else v for v in texts.slice(at, n).to_pylist()]
            at += n
