"""Exact token ids of whole texts, with each distinct chunk of text encoded once.

The tokenizer drops white space and never merges across it, nor across a border
between an ASCII letter and an ASCII punctuation mark other than the apostrophe, so
the ids of a text are the ids of its chunks in a row. Chunks of a block of texts are
found and hashed in numpy, and only chunks not yet known to the task go through the
tokenizers library. A text that holds one of the tokenizer's added tokens is encoded
by the library as a whole.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa

from estrella.llm import textbytes as tb

# Chunks one task keeps; the table is started anew beyond that (same ids, more work).
KNOWN_CHUNKS = 300_000

_CLASSES = np.full(256, 3, np.uint8)  # digits, apostrophe, controls, non-ASCII: no inner border
_CLASSES[[9, 10, 11, 12, 13, 32]] = 0
_CLASSES[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = 2
_CLASSES[[c for c in range(128) if chr(c).isalpha()]] = 1
_BREAKS = np.zeros((4, 4), bool)
_BREAKS[0, 1:] = _BREAKS[1:, 0] = True
_BREAKS[1, 2] = _BREAKS[2, 1] = True


class Encoder:
    """Ids of texts by a tokenizer's JSON definition (one object per task)."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)).encode()) if added else None
        # whether a lower-case ASCII word goes to the model as it is: checked, not assumed
        word = "abcdefghijklmnopqrstuvwxyz"
        self.words_direct = [t.id for t in self.tokenizer.model.tokenize(word)] == self.tokenizer.encode(
            word, add_special_tokens=False
        ).ids and self.tokenizer.encode(word.upper(), add_special_tokens=False).ids == self.tokenizer.encode(
            word, add_special_tokens=False
        ).ids
        self.forget()

    def forget(self) -> None:
        self.table = np.zeros(1 << 16, np.uint64)  # open addressing by chunk hash; 0 is free
        self.slots = np.zeros(1 << 16, np.int32)
        self.count = 0
        self.lengths = np.zeros(1 << 14, np.int32)
        self.firsts = np.zeros(1 << 14, np.int64)
        self.pool = np.zeros(1 << 16, np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        self.used = 0

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each chunk hash, -1 where it is not known."""
        mask = np.uint64(len(self.table) - 1)
        at = (hashes & mask).astype(np.int64)
        held = self.table[at]
        out = np.where(held == hashes, self.slots[at], -1)
        left = np.flatnonzero((held != hashes) & (held != 0))
        while left.size:
            at[left] = (at[left] + 1) & int(mask)
            held = self.table[at[left]]
            same = held == hashes[left]
            out[left[same]] = self.slots[at[left[same]]]
            left = left[~same & (held != 0)]
        return out

    def _enter(self, hashes: np.ndarray, slots: np.ndarray) -> None:
        """Put distinct new hashes into the table, which is kept at most half full."""
        if 2 * (self.count + len(hashes)) > len(self.table):
            old = np.flatnonzero(self.table)
            hashes = np.concatenate([self.table[old], hashes])
            slots = np.concatenate([self.slots[old], slots])
            size = 1 << int(np.ceil(np.log2(3 * len(hashes) + 1)))
            self.table, self.slots = np.zeros(size, np.uint64), np.zeros(size, np.int32)
        mask = len(self.table) - 1
        at = (hashes & np.uint64(mask)).astype(np.int64)
        left = np.arange(len(hashes))
        while left.size:
            free = left[self.table[at[left]] == 0]
            place, one = np.unique(at[free], return_index=True)
            self.table[place] = hashes[free[one]]
            self.slots[place] = slots[free[one]]
            left = left[self.table[at[left]] != hashes[left]]
            at[left] = (at[left] + 1) & mask

    def _encode(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk. An ASCII lower-case word is one piece to the tokenizer, so
        its model is asked directly; other chunks are encoded many to a call, one a line."""
        ids: list[list[int]] = [[]] * len(chunks)
        other = []
        tokenize = self.tokenizer.model.tokenize
        for i, c in enumerate(chunks):
            if self.words_direct and c.isascii() and c.isalpha():
                ids[i] = [t.id for t in tokenize(c)]
            else:
                other.append(i)
        for lo in range(0, len(other), 256):
            part = other[lo : lo + 256]
            starts = np.cumsum([0] + [len(chunks[i]) + 1 for i in part])
            found = self.tokenizer.encode("\n".join(chunks[i] for i in part), add_special_tokens=False)
            flat = found.ids
            where = np.fromiter((o[0] for o in found.offsets), np.int64, len(flat))
            cut = np.searchsorted(where, starts, "left")
            for k, i in enumerate(part):
                ids[i] = flat[cut[k] : cut[k + 1]]
        return ids

    def _learn(self, hashes: np.ndarray, chunks: list[str]) -> np.ndarray:
        ids = self._encode(chunks)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), self.pool.dtype, int(sizes.sum()))
        base = self.count
        while base + len(ids) > len(self.lengths):
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
            self.firsts = np.concatenate([self.firsts, np.zeros_like(self.firsts)])
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(flat)] = flat
        self.lengths[base : base + len(ids)] = sizes
        self.firsts[base : base + len(ids)] = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)
        slots = np.arange(base, base + len(ids), dtype=np.int32)
        self._enter(hashes, slots)
        self.count += len(ids)
        return slots

    def block(self, buf: np.ndarray, offsets: np.ndarray, ids_too: bool = True):
        """(ids, row offsets into ids) of the texts in ``buf``; ids None if not wanted."""
        starts, ends = tb.runs(buf, offsets, _CLASSES, _BREAKS)
        # pure ASCII chunks are lower-cased first, as the tokenizer does, to be known sooner
        low = tb.lowered(buf)
        hashes = tb.run_hashes(low, starts, ends)
        odd = tb.runs_with(buf >= 128, starts, ends)
        cased = odd[np.isin(odd, tb.runs_with(low != buf, starts, ends), assume_unique=True)]
        if cased.size:
            hashes[cased] = tb.run_hashes(buf, starts[cased], ends[cased])
        if self.count > KNOWN_CHUNKS:
            self.forget()
        slots = self._find(hashes)
        missing = np.flatnonzero(slots < 0)
        if missing.size:
            seen, first, which = np.unique(hashes[missing], return_index=True, return_inverse=True)
            at = missing[first]
            plain = ~np.isin(at, odd)
            raw, folded = buf.tobytes(), low.tobytes()
            chunks = [
                (folded if p else raw)[s:e].decode("utf-8", "replace")
                for s, e, p in zip(starts[at].tolist(), ends[at].tolist(), plain.tolist())
            ]
            slots[missing] = self._learn(seen, chunks)[which]
        sizes = self.lengths[slots].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(sizes)])
        rows = total[tb.per_row(starts, offsets)]
        if not ids_too:
            return None, rows
        place = np.arange(total[-1])
        place += np.repeat(self.firsts[slots] - total[:-1], sizes)
        return self.pool[place], rows

    def texts(self, col: pa.Array, ids_too: bool = True):
        """Yield (ids or None, n) of every text of a string column, in order; null is empty."""
        buf, offsets = tb.text_buffer(col)
        for lo, hi in tb.row_blocks(offsets):
            part = buf[offsets[lo] : offsets[hi]]
            at = offsets[lo : hi + 1] - offsets[lo]
            ids, rows = self.block(part, at, ids_too)
            whole = self._whole(part, at)
            for i in range(hi - lo):
                if i in whole:
                    yield (whole[i] if ids_too else None), len(whole[i])
                else:
                    yield (ids[rows[i] : rows[i + 1]] if ids_too else None), int(rows[i + 1] - rows[i])

    def _whole(self, part: np.ndarray, at: np.ndarray) -> dict[int, np.ndarray]:
        """Ids of the rows that hold an added token's string."""
        if self.added is None:
            return {}
        raw = part.tobytes()
        rows = {int(np.searchsorted(at, m.start(), "right")) - 1 for m in self.added.finditer(raw)}
        return {
            r: np.array(
                self.tokenizer.encode(raw[at[r] : at[r + 1]].decode("utf-8", "replace"), add_special_tokens=False).ids,
                np.uint32,
            )
            for r in rows
        }


_encoders: dict[int, Encoder] = {}


def encoder(definition: str) -> Encoder:
    """The task's encoder for a tokenizer definition, made once per Python worker."""
    key = zlib.crc32(definition.encode())
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(definition)
    return _encoders[key]


def release() -> None:
    """Let go of a reused Python worker's encoder, for tasks that need none."""
    _encoders.clear()


def read_definition(path: str) -> str:
    """A tokenizer's JSON, read on the driver and sent to the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
