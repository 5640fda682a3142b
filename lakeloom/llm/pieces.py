"""Cutting texts into the pieces of the public byte-level pattern, vectorised over a batch.

The pattern is ``public_tokenizers.PATTERN``: contractions, then an optional blank with a
run of letters, of numbers or of other characters, then white space, whose last character
is left to the next piece.  Cut positions follow from character classes alone, so a whole
batch of texts is cut by a few array operations on its bytes.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import regex

LETTER, NUMBER, OTHER, WHITE = 0, 1, 2, 3
#: The characters with the White_Space property.
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: The letters and numbers of Unicode 16, the version of both tokenizer libraries, that the interpreter's
#: tables (15.1) don't have yet.
NEWER = ((0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65), (0x10D6F, 0x10D85),
         (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
         (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BE0),
         (0x11BF0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139), (0x16D40, 0x16D6C),
         (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5FA))
_BLANK, _QUOTE = 32, 39
#: What may follow the apostrophe of a contraction.
_SHORT, _LONG = b"stmd", (b"re", b"ve", b"ll")


def _runs() -> tuple[np.ndarray, np.ndarray]:
    """(class, length) of the runs of code points of one class, in order; these few travel with a task."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(cp))[0], OTHER) for cp in range(0x110000)], np.uint8)
    for low, high in NEWER:
        for cp in range(low, high + 1):
            out[cp] = LETTER if regex.match(r"\p{L}", chr(cp)) else NUMBER
    out[list(WHITE_SPACE)] = WHITE
    at = np.concatenate([[0], np.flatnonzero(np.diff(out)) + 1])
    return out[at], np.diff(np.append(at, len(out)))


_RUNS = _runs()
_table: dict[str, np.ndarray] = {}


def classes() -> np.ndarray:
    """The class of every code point."""
    if not _table:
        _table["of"] = np.repeat(*_RUNS)
    return _table["of"]


def byte_classes(buf: np.ndarray) -> np.ndarray:
    """The class of the character that each byte belongs to."""
    table = classes()
    out = table[buf]  # right for ASCII; the rest follows
    lead = np.flatnonzero(buf >= 0xC0)
    if len(lead):
        b = buf[lead].astype(np.int64)
        size = 2 + (b >= 0xE0) + (b >= 0xF0)
        last = len(buf) - 1
        c1, c2, c3 = (buf[np.minimum(lead + k, last)].astype(np.int64) & 0x3F for k in (1, 2, 3))
        cp = np.where(size == 2, (b & 0x1F) << 6 | c1, np.where(
            size == 3, (b & 0x0F) << 12 | c1 << 6 | c2, (b & 0x07) << 18 | c1 << 12 | c2 << 6 | c3))
        kind = table[cp]
        for k in range(4):
            m = size > k
            out[lead[m] + k] = kind[m]
    return out


def cut(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start positions of all pieces of the texts ``buf[offsets[i]:offsets[i + 1]]``, ascending."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64)
    kind = byte_classes(buf)
    first = np.zeros(n + 1, bool)  # first byte of a text
    first[offsets] = True
    run = np.empty(n, bool)        # first byte of a run of one class
    run[0] = True
    run[1:] = kind[1:] != kind[:-1]
    run |= first[:n]
    start = run.copy()
    # a run that follows a single blank takes it along; a white run's last character is cut off unless the text ends
    at = np.flatnonzero(run)
    ends = np.append(at[1:], n)
    white = kind[at] == WHITE
    inner = white & ~first[ends]           # white runs followed by something in the same text
    w_end = ends[inner]
    last = w_end - 1                       # back to the last character's first byte
    for _ in range(3):
        last = np.where((buf[last] & 0xC0) == 0x80, last - 1, last)
    start[last] = True
    start[w_end[buf[last] == _BLANK]] = False
    # contractions: an apostrophe that a piece starts with
    quote = np.flatnonzero((buf == _QUOTE) & run)
    quote = quote[start[quote]]
    if len(quote):
        pad = np.concatenate([buf, np.zeros(2, np.uint8)])
        limit = offsets[np.searchsorted(offsets, quote, side="right")]  # end of the text
        a, b = pad[quote + 1], pad[quote + 2]
        room = limit - quote
        size = np.where(np.isin(a, np.frombuffer(_SHORT, np.uint8)) & (room > 1), 1, 0)
        for pair in _LONG:
            size[(a == pair[0]) & (b == pair[1]) & (room > 2)] = 2
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        after = quote + 1 + size
        inside = after < n
        start[after[inside]] |= ~run[after[inside]]  # rest of the letters; a run that starts there keeps its own rule
        # a run that starts right after a contraction and was not joined to a blank is a start already
    return np.flatnonzero(start)
