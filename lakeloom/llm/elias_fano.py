"""Elias-Fano sequences on numpy arrays, made to be memory-mapped and asked in batches.

A non-decreasing sequence of n values below a bound is split into low bits, packed one
after another, and high parts, written in unary into a bit vector: value i sets the bit
``high + i``.  Directories count the ones before every 512th bit.
"""

from __future__ import annotations

import json

import numpy as np

U = np.uint64
_BLOCK_WORDS = 8


def _pack(bits: np.ndarray) -> np.ndarray:
    """Bit positions as 64-bit words, whole blocks, one block spare."""
    words = np.zeros((int(bits[-1]) // 64 if len(bits) else 0) // _BLOCK_WORDS * _BLOCK_WORDS + 2 * _BLOCK_WORDS, U)
    np.bitwise_or.at(words, bits >> 6, U(1) << (bits & 63).astype(U))
    return words


def encode(values: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays of a non-decreasing sequence of non-negative integers."""
    values = np.asarray(values, np.int64)
    n = len(values)
    top = int(values[-1]) + 1 if n else 1
    width = max(0, (top // max(n, 1)).bit_length() - 1)
    words = _pack((values >> width) + np.arange(n))
    ones = np.cumsum(np.bitwise_count(words).reshape(-1, _BLOCK_WORDS).sum(axis=1, dtype=np.int64))
    low = np.zeros((n * width >> 6) + 2, U)
    if width:
        part, at = (values & (1 << width) - 1).astype(U), np.arange(n) * width
        np.bitwise_or.at(low, at >> 6, part << (at & 63).astype(U))
        over = (at & 63) + width > 64
        np.bitwise_or.at(low, (at[over] >> 6) + 1, part[over] >> (64 - (at[over] & 63)).astype(U))
    return {"high": words, "ones": np.concatenate([[0], ones]), "low": low, "shape": np.array([n, width], np.int64)}


def _select_in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th set bit (from 0) of each word."""
    at = np.zeros(len(word), np.int64)
    word = word.copy()
    for width in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(word & U((1 << width) - 1)).astype(np.int64)
        right = k >= below
        k = np.where(right, k - below, k)
        at += np.where(right, width, 0)
        word = np.where(right, word >> U(width), word)
    return at


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray]):
        self.high, self.ones, self.low = arrays["high"], arrays["ones"], arrays["low"]
        self.n, self.width = (int(x) for x in arrays["shape"])

    def _select(self, k: np.ndarray, bit: int) -> np.ndarray:
        """Position of the k-th one or zero."""
        before = self.ones if bit else np.arange(len(self.ones)) * (64 * _BLOCK_WORDS) - self.ones
        block = np.searchsorted(before, k, side="right") - 1
        left, word_at = k - before[block], block * _BLOCK_WORDS
        word = self.high[word_at] if bit else ~self.high[word_at]
        count = np.bitwise_count(word).astype(np.int64)
        go = np.flatnonzero(left >= count)
        while len(go):
            left[go] -= count[go]
            word_at[go] += 1
            nxt = self.high[word_at[go]]
            word[go] = nxt if bit else ~nxt
            count[go] = np.bitwise_count(word[go])
            go = go[left[go] >= count[go]]
        return (word_at << 6) + _select_in_word(word, left)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.int64)
        at = i * self.width
        word, shift = at >> 6, (at & 63).astype(U)
        both = self.low[word] >> shift | (self.low[word + 1] << (U(63) - shift)) << U(1)
        return (both & U((1 << self.width) - 1)).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at positions ``i``."""
        i = np.asarray(i, np.int64)
        return (self._select(i, 1) - i << self.width) | self._low(i)

    def successor(self, value: np.ndarray) -> np.ndarray:
        """Position of the first element that is not less than each value; n if there is none."""
        value = np.asarray(value, np.int64)
        high, low = value >> self.width, value & (1 << self.width) - 1
        zeros = len(self.high) * 64 - self.n
        at = np.full(len(value), self.n, np.int64)
        go = np.flatnonzero(high < zeros)
        # the elements with this high part stand between the zero that ends the part before and its own
        h = high[go]
        first = np.zeros(len(go), np.int64)
        first[h > 0] = self._select(h[h > 0] - 1, 0) + 1 - h[h > 0]
        end = self._select(h, 0) - h
        at[go], last = first, np.zeros(len(value), np.int64)
        last[go] = end
        # among them, by halves on the low bits: a frequent context's successors crowd into few high parts
        go = go[first < end]
        while len(go):
            middle = (at[go] + last[go]) >> 1
            less = self._low(middle) < low[go]
            at[go] = np.where(less, middle + 1, at[go])
            last[go] = np.where(less, last[go], middle)
            go = go[at[go] < last[go]]
        return np.minimum(at, self.n)


def write(path: str, arrays: dict[str, np.ndarray]) -> None:
    """A file of named arrays; the header names their places."""
    at, header = 0, {}
    for name, a in arrays.items():
        header[name] = (a.dtype.str, at, len(a))
        at += -(-a.nbytes // 8) * 8
    head = json.dumps(header).encode()
    head += b" " * (-len(head) % 8)
    with open(path, "wb") as f:
        f.write(len(head).to_bytes(8, "little") + head)
        for a in arrays.values():
            f.write(a.tobytes() + b"\0" * (-a.nbytes % 8))


def open_mapped(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, memory-mapped."""
    whole = np.memmap(path, np.uint8, "r")
    size = int.from_bytes(whole[:8].tobytes(), "little")
    base = 8 + size
    return {name: np.asarray(whole[base + at:base + at + n * np.dtype(kind).itemsize]).view(kind)
            for name, (kind, at, n) in json.loads(whole[8:base].tobytes()).items()}
