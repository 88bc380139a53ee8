"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow column.

The texts of a batch lie one after the other in a single buffer, so finding words,
lower-casing and hashing are a few passes over arrays instead of a loop over texts.
All hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
SPACES = bytes([0x20, *range(0x09, 0x0E)])
PUNCTUATION = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0xD6E8FEB86659FD93
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x2545F4914F6CDD1D)
_powers: tuple[np.ndarray, np.ndarray] | None = None


@dataclass
class Chunk:
    """Rows ``first`` to ``first + len(offsets) - 2`` of a batch; null texts are empty."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """``text``: row within the chunk; ``starts``, ``ends``: bytes within the chunk."""

    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray
    firsts: np.ndarray


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Runs of rows of about ``most`` bytes together; a longer text is a run of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(bounds, bounds[low] + most, side="right")) - 1
        high = min(len(texts), max(low + 1, high))
        yield Chunk(low, whole[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])
        low = high


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A one-to-one scattering of 64-bit values, another one for each seed."""
    out = values ^ np.uint64(seed * 0xA24BAED4963EE407 % (1 << 64))
    shifted = out >> np.uint64(32)
    out ^= shifted
    out *= _MIX
    out ^= np.right_shift(out, np.uint64(29), out=shifted)
    out *= _STEP
    out ^= np.right_shift(out, np.uint64(32), out=shifted)
    return out


def words(chunk: Chunk, separators: bytes = SPACES, lower: bool = True) -> Words:
    """The maximal runs of bytes that are no separators, never across two texts."""
    data = _LOWER[chunk.data] if lower else chunk.data
    n = len(data)
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    inside = inside[data]
    edge = np.zeros(n + 1, bool)
    edge[chunk.offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    text = np.searchsorted(chunk.offsets, starts, side="right") - 1
    counts = np.bincount(text, minlength=chunk.rows)
    return Words(
        text, starts, ends, _hashes(data, starts, ends), counts, np.cumsum(counts) - counts
    )


def prefixes(chunk: Chunk, found: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Text row and hash of the first ``length`` bytes of each word that has more."""
    longer = found.ends - found.starts > length
    starts = found.starts[longer]
    return found.text[longer], mix(_hashes(_LOWER[chunk.data], starts, starts + length), length)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Differences of a running polynomial, brought to power 0 and mixed with the length."""
    global _powers
    n = len(data)
    if _powers is None or len(_powers[0]) <= n:
        size = max(n, CHUNK_BYTES) + 1
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    up, down = _powers
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text row and hash of each distinct run of ``size`` words, by row and then hash.

    A text of fewer words, but at least one, has its whole sequence as its only run.
    """
    runs = max(0, len(found.hashes) - size + 1)
    hashes = np.zeros(runs, np.uint64)
    for k in range(size):
        hashes = hashes * _STEP + found.hashes[k : k + runs]
    whole = found.text[:runs] == found.text[size - 1 : size - 1 + runs]
    short = np.flatnonzero((found.counts > 0) & (found.counts < size))
    sequence = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        has = found.counts[short] > k
        sequence[has] = sequence[has] * _STEP + found.hashes[found.firsts[short[has]] + k]
    sequence = mix(sequence, 7) + found.counts[short].astype(np.uint64)
    text = np.concatenate([found.text[:runs][whole], short])
    hashes = mix(np.concatenate([hashes[whole], sequence]), 1)
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[first], hashes[first]


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of each run of ``counts`` values; 0 for an empty run."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), values.dtype)
    np.cumsum(values, axis=0, out=total[1:])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]
