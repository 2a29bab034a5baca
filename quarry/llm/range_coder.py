"""Adaptive context-mixing range coder for blocks of token ids.

Orders two and one predict the next id (the last one seen after the same one
or two ids, with the length of its run of hits as confidence).  A mixed model
codes which prediction holds, order two, order one or neither, from two
adaptive tables whose mixing weight follows the better one; the tables learn in
turns, one at each step, the weight every fourth.  After "neither"
order zero codes the id by the frequencies of a table (``OrderZero``) that the
blocks of one chunk share and that is stored once beside them.

Each block starts from nothing but that table and can be decoded without the
other blocks.  All blocks of a batch advance in step as numpy lanes; nothing
passes between lanes, and a lane's digits are written or read once a step.  Integers
only, so that every machine decodes alike.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np

BLOCK = 2048  # ids of a block
CONTEXTS = 10  # bits of the tables of orders one and two
ZERO_BITS = 20  # frequencies of order zero add up to 2**ZERO_BITS
_BITS = 16  # probabilities of the mixed model, in 2**-16
_LEAST = 64  # least probability that a distribution is pulled to
_RATE = 3  # a distribution moves 2**-RATE of the way at each symbol
_LOW32, _LOW48, _LEAST_RANGE = 2**32 - 1, 2**48 - 1, 2**32


class OrderZero:
    """Frequencies of ids below 65,536: ``symbols`` (ascending) and their
    ``widths`` (each at least 1, in sum 2**ZERO_BITS)."""

    def __init__(self, symbols, widths):
        self.symbols = np.asarray(symbols, np.int64)
        self.widths = np.asarray(widths, np.int64)
        self.width = np.zeros(1 << 16, np.int64)
        self.width[self.symbols] = self.widths
        self.below = np.cumsum(self.width) - self.width

    @classmethod
    def of(cls, ids: np.ndarray) -> OrderZero:
        """The table of the ids that it shall code."""
        if not len(ids):
            return cls([], [])
        counts = np.bincount(ids, minlength=1 << 16)
        symbols = np.flatnonzero(counts)
        n = counts[symbols]
        widths = 1 + n * ((1 << ZERO_BITS) - len(n)) // int(n.sum())
        widths[n.argmax()] += (1 << ZERO_BITS) - int(widths.sum())
        return cls(symbols, widths)

    @cached_property
    def at(self) -> np.ndarray:
        """The id of each of the 2**ZERO_BITS places."""
        return np.repeat(self.symbols.astype(np.uint16), self.widths)


class _Out:
    """Range encoder: 48-bit low and range, 16-bit digits, carries into digits
    already written."""

    def __init__(self, lanes: int, most: int, zero: OrderZero):
        self.low = np.zeros(lanes, np.int64)
        self.range = np.full(lanes, 1 << 48, np.int64)
        self.digits = np.zeros((lanes, 3 * most + 8), np.uint16)
        self.flat = self.digits.reshape(-1)
        self.first = np.arange(lanes) * self.digits.shape[1]
        self.at = self.first.copy()  # place of the next digit
        self.zero = zero

    def hit(self, k, first, second, one, two):
        """Codes which of three symbols follows in each of the first ``k`` lanes:
        whether it is at least the second one, and the third one."""
        r = self.range[:k] >> _BITS
        below, self.range[:k] = _interval(r * first, r * second, r << _BITS, one, two)
        self.low[:k] += below
        return one, two

    def id(self, lanes, x):
        r = self.range.take(lanes) >> ZERO_BITS
        self.low[lanes] += r * self.zero.below.take(x)
        self.range[lanes] = r * self.zero.width.take(x)
        return x

    def shift(self, k):
        """Writes the digits that are settled.  Between two calls a lane codes one
        symbol and one id: that leaves a range of 4 at least, and one carry."""
        low, range_ = self.low[:k], self.range[:k]
        over = (low > _LOW48).nonzero()[0]
        if len(over):
            low[over] &= _LOW48
            at = self.at[over] - 1
            while len(at):
                self.flat[at] += np.uint16(1)
                at = at[self.flat[at] == 0] - 1
        small = (range_ < _LEAST_RANGE).nonzero()[0]
        while len(small):
            at, now = self.at.take(small), low.take(small)
            self.flat[at] = now >> 32
            self.at[small] = at + 1
            low[small] = (now & _LOW32) << 16
            wider = range_.take(small) << 16
            range_[small] = wider
            small = small[wider < _LEAST_RANGE]

    def finish(self) -> list[bytes]:
        for shift in (32, 16, 0):
            self.flat[self.at] = self.low >> shift & 0xFFFF
            self.at += 1
        return [row[:n].astype("<u2").tobytes() for row, n in zip(self.digits, self.at - self.first)]


class _In:
    """Range decoder of what ``_Out`` wrote.  Damaged input decodes to wrong
    ids, which the caller's checksum finds."""

    def __init__(self, payloads: list[bytes], zero: OrderZero):
        most = max(len(p) // 2 for p in payloads) + 4
        self.digits = np.zeros((len(payloads), most), np.uint16)
        for i, p in enumerate(payloads):
            self.digits[i, :len(p) // 2] = np.frombuffer(p, "<u2")
        d = self.digits[:, :3].astype(np.int64)
        self.value = d[:, 0] << 32 | d[:, 1] << 16 | d[:, 2]
        self.range = np.full(len(payloads), 1 << 48, np.int64)
        self.last = np.arange(1, len(payloads) + 1) * most - 1
        self.at = self.last - most + 4
        self.digits = self.digits.reshape(-1)
        self.zero = zero

    def hit(self, k, first, second, one, two):
        r = self.range[:k] >> _BITS
        value = self.value[:k]
        first, second = r * first, r * second
        one, two = value >= first, value >= second
        below, self.range[:k] = _interval(first, second, r << _BITS, one, two)
        value -= below
        return one, two

    def id(self, lanes, x):
        r, value = self.range.take(lanes) >> ZERO_BITS, self.value.take(lanes)
        place = value.view(np.uint64) // r.view(np.uint64)  # faster than signed
        x = self.zero.at.take(np.minimum(place.view(np.int64), (1 << ZERO_BITS) - 1)).astype(np.int64)
        self.value[lanes] = value - r * self.zero.below.take(x)
        self.range[lanes] = r * self.zero.width.take(x)
        return x

    def shift(self, k):
        """Reads on where ``_Out`` wrote."""
        value, range_ = self.value[:k], self.range[:k]
        small = (range_ < _LEAST_RANGE).nonzero()[0]
        while len(small):
            at = self.at.take(small)
            value[small] = value.take(small) << 16 | self.digits.take(np.minimum(at, self.last.take(small)))
            self.at[small] = at + 1
            wider = range_.take(small) << 16
            range_[small] = wider
            small = small[(wider < _LEAST_RANGE) & (wider > 0)]


def _interval(first, second, every, one, two):
    """Lower edge and width, of ``every``, of the first symbol, or the second one
    (``one``), or the third one (also ``two``), between their inner edges."""
    below = np.where(two, second, np.where(one, first, 0))
    return below, np.where(two, every, np.where(one, second, first)) - below


class _Three:
    """Adaptive distributions of three symbols, as their two inner edges, which
    are held in one number."""

    #: edges that symbol 0, or another, and symbol 2, or another, pulls to
    FIRST = np.int32((1 << _BITS) - 2 * _LEAST), np.int32(_LEAST)
    SECOND = np.int32(2 * _LEAST), np.int32((1 << _BITS) - _LEAST)

    def __init__(self, rows: int):
        self.edges = np.full(rows, ((1 << _BITS) // 3) << _BITS | (2 << _BITS) // 3, np.uint32)

    def get(self, at):
        edges = self.edges.take(at)
        return (edges >> _BITS).view(np.int32), (edges & np.uint32((1 << _BITS) - 1)).view(np.int32)

    def update(self, at, first, second, one, two):
        first = first + (np.where(one, self.FIRST[1], self.FIRST[0]) - first >> _RATE)
        second = second + (np.where(two, self.SECOND[0], self.SECOND[1]) - second >> _RATE)
        self.edges[at] = (first << _BITS | second).view(np.uint32)


def _run(coder, sizes: np.ndarray, ids: np.ndarray | None) -> np.ndarray:
    """Codes ``ids`` (steps x lanes; None: decodes them).  ``sizes`` falls, so
    the lanes still at work are always the first ones."""
    lanes, steps = len(sizes), int(sizes[0])
    out = np.zeros((steps, lanes), np.uint16) if ids is None else ids
    every = np.arange(lanes)
    working = np.searchsorted(-sizes, -np.arange(steps), side="left")  # lanes with size > step
    last = np.int64((1 << CONTEXTS) - 1)
    seen = [np.zeros(lanes << CONTEXTS, np.uint32) for _ in range(2)]  # id << 2 | confidence
    by_trust = _Three(lanes * 32)  # by both confidences and agreement
    by_past = _Three(lanes * 9)  # by the last two outcomes
    weight = np.full(lanes, 32, np.int32)
    before, two_before, hit, past = (np.zeros(lanes, np.int64) for _ in range(4))
    k = 0
    for t in range(steps):
        if k != working[t]:
            k = int(working[t])
            start, trust_at, past_at = every[:k] << CONTEXTS, every[:k] << 5, every[:k] * 9
            before, two_before, past, weight, hit = (x[:k] for x in (before, two_before, past, weight, hit))
        key = before * 0x9E3779B1
        c1 = start + (key >> 7 & last)
        c2 = start + (key + two_before * 0x85EBCA6B >> 9 & last)
        e1, e2 = seen[0].take(c1), seen[1].take(c2)
        g1, g2 = e1 >> 2, e2 >> 2
        t1, t2 = e1 & 3, e2 & 3
        a = trust_at + ((t2 << 3) + (t1 << 1) + (g1 == g2))
        b = past_at + past
        b += hit
        past = hit * 3
        a1, a2 = by_trust.get(a)
        b1, b2 = by_past.get(b)
        one = two = None
        if ids is not None:
            now = ids[t, :k].astype(np.uint32)
            two = now == g2
            one = two | (now == g1)
        one, two = coder.hit(k, b1 + ((a1 - b1) * weight >> 6), b2 + ((a2 - b2) * weight >> 6), one, two)
        if t & 1:
            by_past.update(b, b1, b2, one, two)
        else:
            by_trust.update(a, a1, a2, one, two)
        if t & 3 == 3:
            better = np.sign(_interval(a1, a2, 1 << _BITS, one, two)[1] - _interval(b1, b2, 1 << _BITS, one, two)[1])
            weight = np.minimum(np.maximum(weight + 2 * better, 4), 60).astype(np.int32, copy=False)
        hit = one.astype(np.int64)
        hit += two
        miss = (~one).nonzero()[0]
        if ids is None:
            now = np.where(two, g2, g1)
        if len(miss):
            x = coder.id(miss, now.take(miss))
            if ids is None:
                now[miss] = x
        coder.shift(k)
        if ids is None:
            out[t, :k] = now
        fresh = now << 2 | 1
        seen[0][c1] = np.where(g1 == now, e1 + (t1 < 3), fresh)
        seen[1][c2] = np.where(g2 == now, e2 + (t2 < 3), fresh)
        before, two_before = now.astype(np.int64), before
    return out


def encode_blocks(blocks: list[np.ndarray], zero: OrderZero) -> list[bytes]:
    """Payloads of blocks of ids, each of up to ``BLOCK`` ids, all in ``zero``."""
    full = [i for i in np.argsort([-len(b) for b in blocks], kind="stable").tolist() if len(blocks[i])]
    out = [b""] * len(blocks)
    if full:
        sizes = np.array([len(blocks[i]) for i in full])
        ids = np.zeros((int(sizes[0]), len(full)), np.uint16)
        for lane, i in enumerate(full):
            ids[:sizes[lane], lane] = blocks[i]
        coder = _Out(len(full), int(sizes[0]), zero)
        _run(coder, sizes, ids)
        for i, p in zip(full, coder.finish()):
            out[i] = p
    return out


def decode_blocks(payloads: list[bytes], sizes: list[int], zero: OrderZero) -> list[np.ndarray]:
    """The blocks of ``encode_blocks`` again."""
    full = [i for i in np.argsort(-np.asarray(sizes, np.int64), kind="stable").tolist() if sizes[i]]
    out = [np.empty(0, np.uint16)] * len(payloads)
    if full:
        n = np.array([sizes[i] for i in full])
        ids = _run(_In([payloads[i] for i in full], zero), n, None).T
        for lane, i in enumerate(full):
            out[i] = ids[lane, :n[lane]].copy()
    return out
