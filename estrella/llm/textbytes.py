"""Vectorised work on the UTF-8 bytes of many texts at once, inside a task.

A column of texts is taken as one byte array with row offsets. Runs of bytes (words,
tokenizer chunks) are found by byte class, and each run gets a 64-bit hash, all in
numpy; Python objects are made only for distinct runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 18
_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
_rng = np.random.Generator(np.random.PCG64(20240607))
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64): spreads every input bit over the output."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash multiplier and of its inverse modulo 2**64."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        inv = np.uint64(pow(int(_MULT), -1, 2**64))
        for key, base in (("up", _MULT), ("down", inv)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[key] = np.multiply.accumulate(p)
    return _powers["up"][:n], _powers["down"][:n]


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null counts as empty."""
    col = pc.fill_null(col, "") if col.null_count else col
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(col.type) else np.int32)
    off = off[col.offset : col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def row_blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes each; a longer row has its own range."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def lowered(buf: np.ndarray) -> np.ndarray:
    """A-Z as a-z, every other byte unchanged."""
    return _LOWER[buf]


def runs(buf: np.ndarray, offsets: np.ndarray, classes: np.ndarray, breaks: np.ndarray):
    """(starts, ends) of runs: ``classes`` gives each byte a class, 0 lies between runs;
    ``breaks[c, d]`` says whether a run ends between classes c and d. Rows end runs."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    k = classes[buf]
    cut = np.zeros(n + 1, bool)
    width = breaks.shape[1]
    cut[1:n] = breaks.ravel()[k[:-1] * np.uint8(width) + k[1:]]
    cut[offsets] = True
    at = np.flatnonzero(cut)
    starts, ends = at[:-1], at[1:]
    word = k[starts] != 0
    return starts[word], ends[word]


def run_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run's bytes; the same bytes have the same hash anywhere."""
    up, down = powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_VALUE[buf] * up[: len(buf)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def per_row(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of each row's first run, with the number of runs at the end."""
    return np.searchsorted(starts, offsets, "left")


def runs_with(mark: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ascending numbers of the runs that hold a marked byte."""
    at = np.flatnonzero(mark)
    if not at.size or not len(starts):
        return np.zeros(0, np.int64)
    r = np.searchsorted(starts, at, "right") - 1
    r = r[(r >= 0) & (at < ends[r])]
    return r[np.concatenate([[True], r[1:] != r[:-1]])] if r.size else r
