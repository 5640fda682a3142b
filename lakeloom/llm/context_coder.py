"""Context-mixing range coder for id sequences, over many blocks at once.

Every block starts from the same state and is coded on its own, so blocks are the lanes of
numpy arrays: one step codes the next id of all blocks.

Predictions of an id come from order 2 (the id that last followed the same two ids in the
block), order 1 (that last followed the same one) and order 0 (the file's frequencies).
Each remembered prediction has a confidence, and each lane learns how often predictions of
a confidence hold; these learned rates are the weights of the mixture
``w2 [order 2] + (1 - w2) (w1 [order 1] + (1 - w1) order 0)``, whose intervals drive a
carry-less range coder with 64-bit state and 16-bit output words.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
MIX_BITS, ORDER0_BITS = 16, 18
TABLE_BITS, LEVELS = 8, 8
_WORD, _TOP, _BOTTOM = U(16), U(1 << 48), U(1 << 40)
_ID_BITS = 24                      # of a table entry; the confidence stands above
_ID_MASK = (1 << _ID_BITS) - 1     # also the entry "nothing yet"
_MORE = 1 << _ID_BITS
_RATE = 5
_AIM = np.array([64, (1 << MIX_BITS) - 1024], np.int32)  # where rates go after a miss and a hit
_ONE, _ONE0 = 1 << MIX_BITS, 1 << ORDER0_BITS
#: An interval of order 0 in one number: its start above its width.
_PACKED = U(ORDER0_BITS + 1)
_WIDTH = U((1 << ORDER0_BITS + 1) - 1)


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct ids, their frequencies), at least 1 each and 2^ORDER0_BITS in total."""
    total = 1 << ORDER0_BITS
    if len(ids) and ids.max() < total:  # counting is cheaper than sorting
        counts = np.bincount(ids)
        values = np.flatnonzero(counts)
        counts = counts[values]
    else:
        values, counts = np.unique(ids, return_counts=True)
    if len(values) > total:
        raise ValueError(f"a file can hold {total} different ids")
    freq = 1 + counts * (total - len(values)) // max(int(counts.sum()), 1)
    if len(values):
        freq[np.argmax(freq)] += total - int(freq.sum())
    return values, freq


class _Lanes:
    """Model and coder state of the lanes. Row 0 of a pair of rows is order 1, row 1 is order 2.

    Numbers are as narrow as they may be (an id's low 16 bits decide its place in the tables), and most operations write
    where their numbers lie, which saves half of their time."""

    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, U), np.full(lanes, 2 ** 64 - 1, U)
        self.base = np.arange(2 * lanes).reshape(2, lanes) << TABLE_BITS
        self.rate_base = np.arange(2 * lanes).reshape(2, lanes) * LEVELS
        self.table = np.full(2 * lanes << TABLE_BITS, _ID_MASK, np.int32)
        self.rates = np.tile((np.linspace(0.15, 0.85, LEVELS) * _ONE).astype(np.int32), 2 * lanes)
        self.past = np.zeros((2, lanes), np.uint16)  # the last id, and the one before
        self.keys = np.zeros((2, lanes), np.uint16)
        self.hits = np.zeros((2, lanes), bool)  # whose prediction was right, order 1 asked or not

    def fewer(self, n: int) -> None:
        """Only the first n lanes go on."""
        self.low, self.range = self.low[:n], self.range[:n]
        self.base, self.rate_base, self.past, self.keys, self.hits = (
            x[:, :n] for x in (self.base, self.rate_base, self.past, self.keys, self.hits))

    def predict(self) -> None:
        """The predictions of both orders, and the widths of their intervals in the mixture."""
        np.multiply(self.past[0], np.uint16(40503), out=self.keys[0])
        np.multiply(self.past[1], np.uint16(30011), out=self.keys[1])
        self.keys[1] += self.keys[0]
        places = self.keys >> np.uint16(3)
        places &= np.uint16((1 << TABLE_BITS) - 1)
        self.slots = self.base + places
        self.entries = self.table.take(self.slots)
        self.guess, self.level = self.entries & _ID_MASK, self.entries >> _ID_BITS
        self.rate_at = self.rate_base + self.level
        self.p = self.rates.take(self.rate_at)
        self.wide2 = self.p[1]
        wide1 = (_ONE - 2 - self.wide2).view(np.uint32)
        wide1 *= self.p[0].view(np.uint32)
        wide1 >>= np.uint32(MIX_BITS)
        wide1 += np.uint32(1)
        self.wide1 = wide1.view(np.int32)
        self.upto1 = self.wide2 + self.wide1

    def narrow(self, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """To the interval of the order that predicted the id, or that of order 0."""
        two, one = hit2.astype(np.int32), hit1.astype(np.int32)  # products are much cheaper than choices
        width, none = _ONE - self.upto1, (~(hit2 | hit1)).astype(np.int32)
        width *= none
        one *= self.wide1
        width += one
        none *= self.wide1
        two *= self.wide2
        width += two
        start = self.wide2 - two
        start += none
        self.cut(start.astype(U), width.astype(U), MIX_BITS)

    def cut(self, start: np.ndarray, width: np.ndarray, bits: int) -> None:
        """``start`` is overwritten."""
        step = self.range >> U(bits)
        start *= step
        self.low += start
        np.multiply(step, width, out=self.range)

    def ready(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether each lane has a word to shift out: it is certain, or the range has become too small; which are not certain."""
        self.differ = self.low + self.range
        self.differ ^= self.low
        unsure = self.differ >= _TOP
        small = self.range < _BOTTOM
        return small | ~unsure, small & unsure

    def shift(self, go: np.ndarray, small: np.ndarray) -> np.ndarray:
        """Shift a word out of the lanes in ``go``; those that have another.  A range that is too small is cut to make it certain."""
        if small.any():
            at = np.flatnonzero(small)
            low = self.low[at]
            self.range[at] = width = (~low + U(1)) & (_BOTTOM - U(1))
            self.differ[at] = low ^ (low + width)
        by = go.astype(U)
        by <<= U(4)
        self.low <<= by
        self.range <<= by
        self.differ <<= by
        return np.flatnonzero((self.differ < _TOP) | (self.range < _BOTTOM))

    def shift_few(self, at: np.ndarray) -> np.ndarray:
        """``shift`` of the lanes numbered ``at``."""
        low, width = self.low[at], self.range[at]
        small = (low ^ (low + width)) >= _TOP
        if small.any():
            width = np.where(small, (~low + U(1)) & (_BOTTOM - U(1)), width)
        low, width = low << _WORD, width << _WORD
        self.low[at], self.range[at] = low, width
        return at[((low ^ (low + width)) < _TOP) | (width < _BOTTOM)]

    def learn(self, ids: np.ndarray) -> None:
        """From the ids (32-bit) and ``hits``: a confidence rises or falls; at the lowest, the id takes the place."""
        hits = self.hits.astype(np.int32)
        moves = hits * (_AIM[1] - _AIM[0])
        moves += _AIM[0]
        moves -= self.p
        moves >>= _RATE
        moves[0] *= 1 - hits[1]  # order 1 was not asked
        moves += self.p
        self.rates[self.rate_at] = moves
        some = self.entries >= _MORE  # confidence
        more = self.hits & (self.entries < (LEVELS - 1) * _MORE)
        less = some > self.hits
        entries = (more.view(np.int8) - less.view(np.int8)).astype(np.int32)
        entries *= _MORE
        entries += self.entries
        other = ids - self.entries
        other *= ~(some | self.hits)
        entries += other
        self.table[self.slots] = entries
        self.past[1] = self.past[0]
        self.past[0] = ids.astype(np.uint16)


def _turned(rows: np.ndarray) -> np.ndarray:
    """The transposed array, laid out anew a few columns at a time, so that cache lines are used whole."""
    out = np.empty(rows.shape[::-1], rows.dtype)
    for at in range(0, rows.shape[0], 16):
        out[:, at:at + 16] = rows[at:at + 16].T
    return out


def encode_blocks(ids: np.ndarray, block: int, values: np.ndarray, freq: np.ndarray) -> list[bytes]:
    """The payload of every block of ``block`` ids (the last one may be shorter)."""
    count = -(-len(ids) // block)
    if not count:
        return []
    last = len(ids) - (count - 1) * block
    columns = np.zeros((count, block), np.int32)
    columns.ravel()[:len(ids)] = ids
    columns = _turned(columns)
    top = int(values.max()) + 1  # stands for an id that was predicted: the whole of order 0
    order0 = np.full(top + 1, _ONE0, U)  # start and width of an id's interval
    order0[values] = (np.cumsum(freq) - freq).astype(U) << _PACKED | freq.astype(U)
    # the lanes' words of one position lie side by side; lanes are about as far as each other
    lanes, out = _Lanes(count), np.zeros((3 * block + 4) * count, np.uint16)
    pos, ends = np.arange(count), np.zeros(count, U)
    for t in range(block if count > 1 else last):
        if t == last:  # the last block is over
            ends[-1] = lanes.low[-1]
            lanes.fewer(count - 1)
        now, upto = columns[t, :len(lanes.low)], pos[:len(lanes.low)]
        lanes.predict()
        np.equal(lanes.guess, now, out=lanes.hits)
        hit2 = lanes.hits[1]
        hit1 = lanes.hits[0] & ~hit2
        lanes.narrow(hit2, hit1)
        told = (hit2 | hit1).astype(np.int32)
        known = order0.take(now + told * (top - now))
        lanes.cut(known >> _PACKED, known & _WIDTH, ORDER0_BITS)
        ready, small = lanes.ready()
        out[upto] = lanes.low >> U(48)  # of a lane that is not ready, written over later
        upto += ready * count
        go = lanes.shift(ready, small)
        while len(go):
            out[upto[go]] = lanes.low[go] >> U(48)
            upto[go] += count
            go = lanes.shift_few(go)
        lanes.learn(now)
    ends[:len(lanes.low)] = lanes.low
    for _ in range(4):
        out[pos] = ends >> U(48)
        pos += count
        ends = ends << _WORD
    words = pos // count
    width = int(words.max())
    data = _turned(out[:width * count].reshape(width, count).astype("<u2", copy=False)).tobytes()
    return [data[2 * width * i:2 * (width * i + n)] for i, n in enumerate(words.tolist())]


def decode_blocks(payloads: list[bytes], sizes: list[int], values: np.ndarray, freq: np.ndarray) -> np.ndarray:
    """The ids of all blocks in order; ``sizes`` are their numbers of ids, equal but for a shorter last one."""
    count = len(payloads)
    if not count:
        return np.zeros(0, np.int64)
    block, last = sizes[0], sizes[-1]
    width = max(map(len, payloads)) // 2 + 8
    words = np.zeros((count, width), np.uint16)
    for i, p in enumerate(payloads):
        words[i, :len(p) // 2] = np.frombuffer(p, "<u2")
    index = np.repeat(np.arange(len(values), dtype=np.uint16 if len(values) <= 1 << 16 else np.int32), freq)
    # after the values, one that stands for an id that was predicted: the whole of order 0
    starts, wide, value = (np.append(x, y).astype(U) for x, y in ((np.cumsum(freq) - freq, 0), (freq, _ONE0), (values, 0)))
    order0 = value << U(2 * int(_PACKED)) | starts << _PACKED | wide
    words = _turned(words)  # as in encoding, one position's words of all lanes side by side
    lanes, pos, code = _Lanes(count), np.arange(count) + 4 * count, np.zeros(count, U)
    for k in range(4):
        code = code << _WORD | words[k].astype(U)
    words = words.ravel()
    columns = np.zeros((block, count), np.int32)
    for t in range(block):
        if t == last and count > 1:
            lanes.fewer(count - 1)
            code, pos = code[:-1], pos[:-1]
        lanes.predict()
        v = np.minimum((code - lanes.low) // (lanes.range >> U(MIX_BITS)), U(_ONE - 1)).astype(np.int32)
        hit2 = v < lanes.wide2
        hit1 = (v < lanes.upto1) & ~hit2
        lanes.narrow(hit2, hit1)
        v = np.minimum((code - lanes.low) // (lanes.range >> U(ORDER0_BITS)), U(_ONE0 - 1)).view(np.int64)
        two, one = hit2.astype(np.int32), hit1.astype(np.int32)
        at = index.take(v).astype(np.int32)
        at += (two | one) * (len(values) - at)
        known = order0.take(at)
        now = lanes.guess[1] * two + lanes.guess[0] * one + (known >> U(2 * int(_PACKED))).astype(np.int32)
        lanes.cut(known >> _PACKED & _WIDTH, known & _WIDTH, ORDER0_BITS)
        ready, small = lanes.ready()
        word = words.take(pos, mode="clip")  # a damaged block may ask for more words
        word *= ready
        code <<= ready.astype(U) << U(4)
        code |= word.astype(U)
        pos += ready * count
        go = lanes.shift(ready, small)
        while len(go):
            code[go] = code[go] << _WORD | words.take(pos[go], mode="clip")
            pos[go] += count
            go = lanes.shift_few(go)
        np.equal(lanes.guess, now, out=lanes.hits)
        lanes.learn(now)
        columns[t, :len(now)] = now
    return _turned(columns).ravel()[:(count - 1) * block + last]
