"""Vectorised words of a batch of texts: places, 64-bit hashes, rolling windows.

A word is ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 text. Everything is numpy over the bytes of a batch;
no Python object is made for a word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from foldmark.llm.common import offsets_of

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_BYTE = (np.random.default_rng(20_240_607).integers(0, 2**63, 256, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WINDOW = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # one past its last byte
    first: np.ndarray  # for each text the number of its first word; one more entry at the end

    @property
    def n(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.n)

    def hashes(self, prefix: int | None = None, lower: bool = False) -> np.ndarray:
        """A hash of each word, or of its first ``prefix`` bytes (of the word where it is shorter)."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        if prefix is None:
            # bytes from each word to the next one; those of white space count nothing
            at = np.arange(self.starts[0], len(self.data), dtype=np.int64)
            gaps = np.diff(np.append(self.starts, len(self.data)))
            at -= np.repeat(self.starts, gaps)
            power = np.cumprod(np.full(int(at.max()) + 1, _BASE, np.uint64))
            body = self.data[self.starts[0] :]
            value = _BYTE[_fold(body) if lower else body] * power[at]
            value[at >= np.repeat(self.ends - self.starts, gaps)] = 0
            return mix(np.add.reduceat(value, self.starts - self.starts[0]))
        out = np.zeros(len(self.starts), np.uint64)
        power = np.cumprod(np.full(prefix, _BASE, np.uint64))
        folded = _fold(self.data) if lower else self.data
        for k in range(prefix):
            at = self.starts + k
            inside = at < self.ends
            out[inside] += _BYTE[folded[at[inside]]] * power[k]
        return mix(out)

    def trimmed(self) -> Words:
        """The words without the ASCII marks at their ends, four on either side at most; one of marks only keeps its last."""
        starts, ends = self.starts.copy(), self.ends.copy()
        last = max(0, len(self.data) - 1)
        for _ in range(4):
            ends -= (ends - starts > 1) & _MARK[self.data[np.maximum(ends - 1, 0)]]
            starts += (ends - starts > 1) & _MARK[self.data[np.minimum(starts, last)]]
        return Words(self.data, starts, ends, self.first)


def _fold(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    # Latin-1 capitals are C3 80..C3 9E in UTF-8
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    upper |= after & (data >= 0x80) & (data <= 0x9E)
    return data + upper.astype(np.uint8) * 32


def words_of(texts: pa.Array, space: np.ndarray = _SPACE, spelling: np.ndarray | None = None) -> Words:
    """Words of each text; a null text has none. ``space`` marks the bytes between words, after ``spelling`` maps them."""
    offsets = offsets_of(texts)
    if texts.null_count:
        texts = texts.fill_null("")
        offsets = offsets_of(texts)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if spelling is not None:
        data = spelling[data]
    space = space[data]
    before = np.ones(len(data) + 1, bool)
    before[1:] = space
    before[offsets] = True
    starts = np.flatnonzero(~space & before[:-1])
    after = np.ones(len(data) + 1, bool)
    after[:-1] = space
    after[offsets] = True
    ends = np.flatnonzero(~space & after[1:]) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def rolling(word: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each place on, over one line of words; shorter by ``size`` - 1."""
    if len(word) < size:
        return np.zeros(0, np.uint64)
    out, done, step, block = None, 0, 1, word
    base = _WINDOW
    n = len(word) - size + 1
    while step <= size:
        if size & step:
            part = block[done : done + n]
            out = part.copy() if out is None else out * base + part
            done += step
        if 2 * step <= size:
            block = block[:-step] * base + block[step:]
            base = np.uint64(int(base) ** 2 % 2**64)
        step *= 2
    return mix(out + np.uint64(size))


def valid(first: np.ndarray, size: int) -> np.ndarray:
    """Places of :func:`rolling` whose window lies in one text."""
    n = np.diff(first)
    total = int(first[-1])
    keep = np.ones(max(0, total - size + 1), bool)
    for back in range(1, size):
        at = first[1:][n > 0] - back
        keep[at[(at >= 0) & (at < len(keep))]] = False
    return keep
