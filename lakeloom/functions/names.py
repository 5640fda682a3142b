"""Similarity of names in batches (F19): the ratio of ``difflib.SequenceMatcher``, 2 * matches / total length.

The matches of two names are their longest common run (the first one in the first name, then
in the second), and then those left and right of it.  Here all pairs of a batch look for their longest run at
once: one array operation per character of the first names, over pairs times characters of the second."""

from __future__ import annotations

import difflib

import numpy as np

#: Bins of a letter histogram (the low bits of the code points), and the longest name that has one.
BINS, LONGEST = 128, 255
#: From this length on the standard library ignores popular characters of the second name.
POPULAR = 200


def letters(names: list[str]) -> list[bytes]:
    """How often each bin's letters occur in a name, a byte each; empty for a very long name."""
    out = []
    for name in names:
        codes = np.frombuffer(name.encode("utf-32-le", "surrogatepass"), np.uint32)
        out.append(np.bincount(codes % BINS, minlength=BINS).astype(np.uint8).tobytes() if len(codes) <= LONGEST else b"")
    return out


def may_reach(a: list[bytes], b: list[bytes], lengths: np.ndarray, cutoff: float) -> np.ndarray:
    """Whether the letters that two names share, whatever their order, allow a ratio of ``cutoff``.  lengths: of both together."""
    known = np.array([len(x) == len(y) == BINS for x, y in zip(a, b, strict=True)], bool)
    out = np.ones(len(a), bool)
    at = np.flatnonzero(known)
    if len(at):
        x, y = (np.frombuffer(b"".join(s[i] for i in at), np.uint8).reshape(-1, BINS) for s in (a, b))
        out[at] = 2.0 * np.minimum(x, y).sum(axis=1, dtype=np.int64) >= cutoff * lengths[at] - 1e-9
    return out


def _padded(names: list[str], pad: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(n) for n in names], np.int64)
    out = np.full((len(names), int(sizes.max(initial=0)) + 1), pad, np.int32)
    flat = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.int32)
    out[np.repeat(np.arange(len(names)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out, sizes


def _longest(a: np.ndarray, b: np.ndarray, pair: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(size, start in a, start in b) of the longest common run of each pair's spans (a from, to, b from, to)."""
    a_from, a_to, b_from, b_to = spans
    width = int((b_to - b_from).max())
    at = b_from[:, None] + np.arange(width)
    own = np.where(at < b_to[:, None], b[pair[:, None], np.minimum(at, b.shape[1] - 1)], -2)
    run = np.zeros((len(pair), width + 1), np.int32)  # of the runs that end at each character of b, one column on
    size, i, j = (np.zeros(len(pair), np.int64) for _ in range(3))
    for step in range(int((a_to - a_from).max())):
        here = a_from + step
        letter = np.where(here < a_to, a[pair, np.minimum(here, a.shape[1] - 1)], -1)
        run[:, 1:] = np.where(own == letter[:, None], run[:, :-1] + 1, 0)
        end = run[:, 1:].argmax(axis=1)
        most = run[np.arange(len(pair)), end + 1]
        better = most > size
        size[better] = most[better]
        i[better] = (here - most + 1)[better]
        j[better] = (b_from + end - most + 1)[better]
    return size, i, j


def matched(a: list[str], b: list[str]) -> np.ndarray:
    """The number of matching characters of each pair of names."""
    x, x_size = _padded(a, -1)
    y, y_size = _padded(b, -2)
    total, pair = np.zeros(len(a), np.int64), np.flatnonzero((x_size > 0) & (y_size > 0))
    spans = np.stack([np.zeros(len(pair), np.int64), x_size[pair], np.zeros(len(pair), np.int64), y_size[pair]])
    while len(pair):
        size, i, j = _longest(x, y, pair, spans)
        np.add.at(total, pair, size)
        left, right = np.stack([spans[0], i, spans[2], j]), np.stack([i + size, spans[1], j + size, spans[3]])
        found = size > 0
        pair, spans = np.concatenate([pair[found], pair[found]]), np.concatenate([left[:, found], right[:, found]], axis=1)
        some = (spans[1] > spans[0]) & (spans[3] > spans[2])
        pair, spans = pair[some], spans[:, some]
    return total


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    """The ratio of every pair; two empty names are alike."""
    total = np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)], np.float64)
    out = np.ones(len(a))
    plain = np.array([len(y) < POPULAR and len(x) < POPULAR for x, y in zip(a, b, strict=True)], bool)
    at = np.flatnonzero(plain & (total > 0))
    if len(at):
        out[at] = 2.0 * matched([a[i] for i in at], [b[i] for i in at]) / total[at]
    for i in np.flatnonzero(~plain):
        out[i] = difflib.SequenceMatcher(None, a[i], b[i]).ratio()
    return out
