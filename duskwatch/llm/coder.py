"""Adaptive context-mixing range coder for token ids, many blocks side by side.

A block of ``BLOCK`` ids is coded on its own: all statistics start empty. Every id has one
probability, a weighted sum over the models that know it: order 2 and order 1 each name the id that
last followed the same two (one) ids in the block, order 0 gives an id its share of the ids so far,
and what is left belongs to new ids, by their bit length. The weights depend on which predictions
exist, agree and came true last time; each id's credit is split over the models by what they gave it. Weights,
order-0 shares and lengths are learned anew at short steps, about every ``1 / STEPS`` of the coded part.

The interval of an id is the predicted ids first, then the other old ids in order (those of a
predicted id are taken out), then the new ones. A range coder with 64-bit range and 32-bit words
narrows to it. Encoder and decoder advance all blocks of a batch by one id at a time, as numpy columns.
"""

import numpy as np

BLOCK = 4096
FIRST = 16
STEPS = 4
PRECISION = 20
_TOTAL = 1 << PRECISION
_PLACE = BLOCK.bit_length() - 1
_SLOTS = 8192
_LOW32 = np.uint64(0xFFFFFFFF)
_U = np.uint64
#: Bits of the distribution of bit lengths of new ids, and lengths there are.
_LENGTH_BITS, _LENGTHS = 12, 21
#: States of the contexts: no prediction, order 1 only, order 2 only, two predictions, one by both; times how they did before.
_STATES = 20
#: The weights of a state in one number: order 1, order 2, one old id.
_W2, _UNIT, _ONE = PRECISION, 2 * PRECISION, _TOTAL - 1
#: Credit of one id.
_CREDIT = 64


def _epochs(width: int) -> list[tuple[int, int]]:
    edges = [0]
    at = FIRST
    while at < width:
        edges.append(at)
        at += max(FIRST, at // STEPS)
    return list(zip(edges, edges[1:] + [width], strict=True))


class _Model:
    """What encoder and decoder know of all blocks, and the distribution of their next ids."""

    def __init__(self, blocks: int, width: int):
        self.blocks = blocks
        self.lane = np.arange(blocks, dtype=np.int64)
        self.base, self.row = self.lane * _SLOTS, self.lane * _STATES
        # Index of the last successor of a context in the tables below, whose row 0 stands for none.
        self.one, self.two = (np.tile(self.lane.astype(np.int32)[:, None], _SLOTS).ravel() for _ in range(2))
        # An id, and which orders named it (1: order 1, 2: order 2); its first place and count among the old ids.
        self.ids, self.ranks = np.full((width + 1, blocks), -4, np.int32), np.zeros((width + 1, blocks), np.int32)
        self.flat_ids, self.flat_ranks = self.ids.ravel(), self.ranks.ravel()
        self.last = self.before = np.zeros(blocks, np.int64)
        self.credit = np.zeros((blocks * _STATES, 4), np.int64)
        prior = np.array([[0, 0, 3, 5], [0, 3, 4, 4], [4, 0, 3, 3], [3, 1, 3, 3], [6, 2, 2, 2]])
        rows = np.repeat(prior, 4, axis=0)
        rows[1::4, 1] *= 2
        rows[3::4, 1] *= 2
        rows[2::4, 0] *= 3
        rows[3::4, 0] *= 3
        self.prior = np.tile(rows * _CREDIT // 4 + (rows > 0), (blocks, 1))
        self.lengths = np.ones((blocks, _LENGTHS), np.int64)

    def begin(self, a: int, size: int) -> None:
        """Settle the distribution for the next ``size`` ids; ``a`` are known."""
        self.a = a
        weight = self.credit + self.prior
        share = weight * (_TOTAL - 4096) // weight.sum(1, keepdims=True)
        # Units of one old id; the rest of the total, never nothing, goes to new ids.
        unit = np.maximum(share[:, 2] // a, 1) if a else np.zeros(len(share), np.int64)
        self.weights = share[:, 1] | share[:, 0] << _W2 | unit << _UNIT
        total = self.lengths.sum(1, keepdims=True)
        part = 1 + self.lengths * ((1 << _LENGTH_BITS) - _LENGTHS) // total
        self.length_start = np.zeros((self.blocks, _LENGTHS + 1), np.int64)
        np.cumsum(part, axis=1, out=self.length_start[:, 1:])
        self.length_start[:, -1] = 1 << _LENGTH_BITS
        self.seen_weights = np.empty((size, self.blocks), np.int64)
        self.rows = np.empty((size, self.blocks), np.int64)

    def predict(self, t: int) -> None:
        at = self.last * 40503
        self.at1 = (at >> 3 & _SLOTS - 1) + self.base
        at += self.before * 30011
        self.at2 = (at >> 3 & _SLOTS - 1) + self.base
        p1, p2 = self.one.take(self.at1), self.two.take(self.at2)
        c1, c2, r1, r2 = self.flat_ids.take(p1), self.flat_ids.take(p2), self.flat_ranks.take(p1), self.flat_ranks.take(p2)
        self.c1, self.c2 = c1 >> 2, c2 >> 2
        self.f1, self.f2, n1, self.n2 = r1 & BLOCK - 1, r2 & BLOCK - 1, r1 >> _PLACE, r2 >> _PLACE
        has1, other = c1 >= 0, self.c1 != self.c2
        named = has1 & ~other
        state = (has1.view(np.int8) + 2 * (c2 >= 0).view(np.int8) + named.view(np.int8)) * np.int8(4) + (c1 & 1) + (c2 & 2)
        row = self.row + state
        weights = self.weights.take(row)
        self.rows[t - self.a], self.seen_weights[t - self.a] = row, weights
        self.unit = unit = weights >> _UNIT
        w1 = weights & _ONE
        # One interval for an id that both name.
        self.n1 = n1 * other
        self.m2 = (weights >> _W2 & _ONE) + unit * self.n2 + w1 * named
        self.edge = self.m2 + (w1 + unit * n1) * other
        self.new = self.edge + unit * (self.a - self.n2 - self.n1)

    def learn(self, t: int, x: np.ndarray, is1: np.ndarray, is2: np.ndarray) -> None:
        """``x`` is at place ``t``, order 1 and 2 named it or not; its rank is set by the caller."""
        self.ids[t + 1] = (x << 2) + is1 + 2 * is2
        index = (t + 1) * self.blocks + self.lane
        self.one[self.at1] = index
        self.two[self.at2] = index
        self.before, self.last = self.last, x.astype(np.int64)

    def end(self, b: int) -> None:
        """Credit the models for the ids since ``begin``."""
        rows, weights = self.rows.ravel(), self.seen_weights.ravel()
        ids = self.ids[self.a + 1:b + 1].ravel()
        count = self.ranks[self.a + 1:b + 1].ravel() >> _PLACE
        gave = [(weights >> _W2 & _ONE) * (ids >> 1 & 1), (weights & _ONE) * (ids & 1), (weights >> _UNIT) * count]
        whole = gave[0] + gave[1] + gave[2]
        fresh = whole == 0
        whole += fresh
        n = self.blocks * _STATES
        for m, part in enumerate(gave):
            on = np.flatnonzero(part)
            self.credit[:, m] += np.bincount(rows[on], part[on] * _CREDIT // whole[on], n).astype(np.int64)
        at = np.flatnonzero(fresh)
        self.credit[:, 3] += np.bincount(rows[at], minlength=n) * _CREDIT
        length = _length(ids[at] >> 2)
        self.lengths += 2 * np.bincount(at % self.blocks * _LENGTHS + length, minlength=self.lengths.size).reshape(self.lengths.shape)


def _length(ids: np.ndarray) -> np.ndarray:
    """Bit lengths."""
    return np.frexp(ids.astype(np.float64))[1].astype(np.int64)


def _ranks(ids: np.ndarray, a: int, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all places of ``ids`` (one row per block): equal ids and lesser ids among the first ``a`` of the block as
    ``count * BLOCK + first``, with one column per block; all ids in order, block by block, and their numbers alike."""
    blocks, b = ids.shape
    kind = np.int32 if vocabulary <= 1 << 31 - _PLACE else np.int64
    key = ids.astype(kind)
    key <<= kind(_PLACE)
    key |= np.arange(b, dtype=kind)
    key.sort(axis=1)
    place = (key & kind(BLOCK - 1)).ravel()
    key >>= kind(_PLACE)
    head = np.ones(key.shape, bool)
    np.not_equal(key[:, 1:], key[:, :-1], out=head[:, 1:])
    start = np.flatnonzero(head)
    size = np.diff(start, append=head.size)
    if a == b:
        rank = (size << _PLACE) + start % b
    else:
        old = np.add.reduceat((place < a).view(np.int8), start, dtype=np.int32)
        rank = (old << _PLACE) + (np.cumsum(old) - old) - start // b * a
    rank = np.repeat(rank.astype(np.int32), size)
    out = np.empty((blocks, b), np.int32)
    at = place.reshape(blocks, b).astype(np.int64)
    at += np.arange(blocks)[:, None] * b
    out.ravel()[at.ravel()] = rank
    return out.T, key.ravel(), rank


def encode_blocks(ids: np.ndarray, vocabulary: int) -> list[np.ndarray]:
    """Code the rows of a matrix of ids, each on its own; the 32-bit words per row."""
    if vocabulary > 1 << 20 or (ids.size and int(ids.max()) >= vocabulary) or ids.shape[1] > BLOCK:
        raise ValueError("ids must lie below the vocabulary's size, 2^20 at most, and blocks hold BLOCK ids at most")
    blocks, width = ids.shape
    rows = ids.astype(np.int32)
    columns = np.ascontiguousarray(rows.T)
    model = _Model(blocks, width)
    low, span = np.zeros(blocks, _U), np.full(blocks, ~_U(0), _U)
    stride = 2 * width + 4
    out, end = np.zeros((blocks, stride), np.int64), np.zeros(blocks, np.int64)
    flat = out.ravel()

    def emit(on: np.ndarray) -> None:
        value = low[on]
        flat[on * stride + end[on]] = (value >> _U(32)).astype(np.int64)
        end[on] += 1
        low[on] = value << _U(32)

    def shift(on: np.ndarray) -> None:
        if len(on):
            emit(on)
            span[on] <<= _U(32)

    def raise_by(on: np.ndarray, by: np.ndarray) -> None:
        raised = low[on] + by
        carry = on[raised < by]
        flat[carry * stride + end[carry] - 1] += 1
        low[on] = raised

    for a, b in _epochs(width):
        if a:
            model.ranks[1:b + 1] = _ranks(rows[:, :b], a, vocabulary)[0]
        model.begin(a, b - a)
        for t in range(a, b):
            x = columns[t]
            model.predict(t)
            rank = model.ranks[t + 1]
            count, first = rank >> _PLACE, rank & BLOCK - 1
            is2 = model.c2 == x
            is1 = model.c1 == x
            unit, m2 = model.unit, model.m2
            inner = first - model.n2 * (model.f2 < first) - model.n1 * (model.f1 < first)
            start, size = model.edge + unit * inner, unit * count
            on = np.flatnonzero(is1)
            start[on], size[on] = m2[on], model.edge[on] - m2[on]
            on = np.flatnonzero(is2)
            start[on], size[on] = 0, m2[on]
            on = np.flatnonzero(size == 0)
            start[on], size[on] = model.new[on], _TOTAL - model.new[on]
            r = span >> _U(PRECISION)
            by = r * start.view(_U)
            low += by
            carry = np.flatnonzero(low < by)
            if len(carry):
                flat[carry * stride + end[carry] - 1] += 1
            span = r * size.view(_U)
            shift(np.flatnonzero(span <= _LOW32))
            if len(on):
                own = x[on]
                length = _length(own)
                r = span[on] >> _U(_LENGTH_BITS)
                start = model.length_start[on, length]
                raise_by(on, r * start.astype(_U))
                span[on] = r * (model.length_start[on, length + 1] - start).astype(_U)
                shift(on[span[on] <= _LOW32])
                bits = np.maximum(length - 1, 0)
                r = span[on] >> bits.astype(_U)
                raise_by(on, r * (own - np.where(length > 0, 1 << bits, 0)).astype(_U))
                span[on] = r
                shift(on[r <= _LOW32])
            model.learn(t, x, is1, is2)
        model.end(b)
    every = np.arange(blocks)
    emit(every)
    emit(every)
    carry = np.zeros(blocks, np.int64)
    for i in range(int(end.max()) - 1, -1, -1):
        value = out[:, i] + carry
        carry = value >> 32
        out[:, i] = value & 0xFFFFFFFF
    return [out[i, :end[i]].astype("<u4") for i in range(blocks)]


def decode_blocks(words: list[np.ndarray], width: int, vocabulary: int) -> np.ndarray:
    """The matrix of ids that ``encode_blocks`` coded; damaged words give some ids below the vocabulary's size."""
    blocks = len(words)
    longest = max(map(len, words), default=0) + 2
    source = np.zeros((blocks, longest), _U)
    for i, w in enumerate(words):
        source[i, :len(w)] = w
    flat = source.ravel()
    model = _Model(blocks, width)
    lane = model.lane
    code = (source[:, 0] << _U(32)) | source[:, 1]
    span = np.full(blocks, ~_U(0), _U)
    following, last = lane * longest + 2, lane * longest + longest - 1

    def shift(on: np.ndarray) -> None:
        if len(on):
            at = following[on]
            code[on] = (code[on] << _U(32)) | flat[np.minimum(at, last[on])]
            span[on] <<= _U(32)
            following[on] = at + 1

    for a, b in _epochs(width):
        if a:
            model.ranks[1:a + 1], seen, rank_of = _ranks(np.ascontiguousarray((model.ids[1:a + 1] >> 2).T), a, vocabulary)
        model.begin(a, b - a)
        base = lane * a
        for t in range(a, b):
            model.predict(t)
            m2, edge, unit = model.m2, model.edge, model.unit
            r = span >> _U(PRECISION)
            value = np.minimum(code // r, _U(_TOTAL - 1)).view(np.int64)
            is2, named, fresh = value < m2, value < edge, value >= model.new
            if a:
                inner = (value - edge) // unit
                # Back to the place among all old ids: the named ones were taken out.
                f1, n1, f2, n2 = model.f1, model.n1, model.f2, model.n2
                one = inner + n1 * (inner >= f1)
                two = inner + n2 * (inner >= f2)
                inner = np.where(f1 < f2, one + n2 * (one >= f2), two + n1 * (two >= f1))
                at = base + np.minimum(np.maximum(inner, 0), a - 1)
                x, rank = seen.take(at), rank_of.take(at)
                first = rank & BLOCK - 1
                start = edge + unit * (first - n2 * (f2 < first) - n1 * (f1 < first))
                size = unit * (rank >> _PLACE)
            else:
                x, rank = np.zeros(blocks, np.int32), np.zeros(blocks, np.int32)
                start, size = np.zeros(blocks, np.int64), np.zeros(blocks, np.int64)
            on = np.flatnonzero(named)
            start[on], size[on], x[on] = m2[on], edge[on] - m2[on], model.c1[on]
            rank[on] = model.n1[on] << _PLACE | model.f1[on]
            on = np.flatnonzero(is2)
            start[on], size[on], x[on] = 0, m2[on], model.c2[on]
            rank[on] = model.n2[on] << _PLACE | model.f2[on]
            on = np.flatnonzero(fresh)
            start[on], size[on], rank[on] = model.new[on], _TOTAL - model.new[on], 0
            code -= r * start.view(_U)
            span = r * size.view(_U)
            shift(np.flatnonzero(span <= _LOW32))
            if len(on):
                starts = model.length_start[on]
                r = np.maximum(span[on] >> _U(_LENGTH_BITS), _U(1))
                value = np.minimum(code[on] // r, _U((1 << _LENGTH_BITS) - 1)).astype(np.int64)
                length = (starts[:, 1:] <= value[:, None]).sum(1)
                row = np.arange(len(on))
                code[on] -= r * starts[row, length].astype(_U)
                span[on] = r * (starts[row, length + 1] - starts[row, length]).astype(_U)
                shift(on[span[on] <= _LOW32])
                bits = np.maximum(length - 1, 0)
                r = np.maximum(span[on] >> bits.astype(_U), _U(1))
                value = np.minimum(code[on] // r, ((1 << bits) - 1).astype(_U))
                code[on] -= r * value
                span[on] = r
                shift(on[r <= _LOW32])
                x[on] = np.minimum(value.astype(np.int64) + np.where(length > 0, 1 << bits, 0), vocabulary - 1)
            model.ranks[t + 1] = rank
            model.learn(t, x, model.c1 == x, model.c2 == x)
        model.end(b)
    return np.ascontiguousarray((model.ids[1:] >> 2).T)
