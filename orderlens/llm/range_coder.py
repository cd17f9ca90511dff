"""Context-mixing range coder for blocks of ids, many blocks in lockstep.

A block starts from an empty model. Three models predict the next id: the id
that last followed the two ids before (order 2), the one that last followed the
id before (order 1), and the adaptive frequencies of the block so far (order
0). Their weights are adaptive too: how often the predictions held in the past,
by how long each has held and by whether both agree, is the share of the next
interval each model gets; order 0 gets the rest, dealt by its frequencies. The
interval drives a carry-less range coder of 48 bits with 16-bit digits.

The blocks of a batch are the lanes of arrays; a step codes one id of each. All
of the model is integer arithmetic, so any machine decodes what another wrote.
"""

from __future__ import annotations

import numpy as np

#: Ids are below this; order 0 deals the interval to buckets of neighbouring ids, evenly inside a bucket.
ALPHABET = 49_408
BUCKET_BITS = 4
BUCKETS = ALPHABET >> BUCKET_BITS
#: Ids after which order 0 is dealt anew from the counts.
REFRESH = 256
SCALE = 17  # bits of the order-0 total
SLOTS1, SLOTS2 = 1 << 12, 1 << 13
RUN = 8  # lengths of a prediction's run that are told apart
_TOP = np.uint64(32)
_MASK = np.uint64((1 << 48) - 1)
_LOW32 = np.uint64((1 << 32) - 1)
_ONE, _16, _17 = np.uint64(1), np.uint64(16), np.uint64(SCALE)
#: Prior of order 0: a low id is a frequent one.
_PRIOR = (1 + (1 << 10) // (np.arange(BUCKETS) + 4)).astype(np.int32)
_STEP = np.arange(1, BUCKETS + 1, dtype=np.int32)
_INSIDE = (1 << BUCKET_BITS) - 1


class Model:
    """The state of ``lanes`` blocks."""

    def __init__(self, lanes: int):
        at = np.arange(lanes, dtype=np.int64)
        self.off1, self.off2, self.off_a, self.off_b = at * SLOTS1, at * SLOTS2, at * (RUN * 2), at * RUN
        self.off_c, self.off_n = at * (BUCKETS + 1), at * BUCKETS
        self.one = np.zeros(lanes * SLOTS1, np.int32)  # id + 1 and run of the prediction
        self.two = np.zeros(lanes * SLOTS2, np.int32)
        self.hit_two = np.full(lanes * RUN * 2, 8192, np.int32)
        self.hit_one = np.full(lanes * RUN, 8192, np.int32)
        self.counts = np.zeros((lanes, BUCKETS), np.int32)
        self.flat_counts = self.counts.ravel()
        self.cdf = np.zeros((lanes, BUCKETS + 1), np.int32)
        self.flat_cdf = self.cdf.ravel()
        self.before = np.zeros(lanes, np.int32)
        self.earlier = np.zeros(lanes, np.int32)

    def refresh(self, n: int) -> None:
        """Deal order 0 of the first ``n`` lanes from the counts: every id keeps one unit at least."""
        total = np.cumsum(self.counts[:n] * 8 + _PRIOR, axis=1, dtype=np.int32)
        # products and quotients of doubles are the same on every machine
        share = total * (((1 << SCALE - BUCKET_BITS) - BUCKETS) / total[:, -1:])
        self.cdf[:n, 1:] = share.astype(np.int32) + _STEP
        self.cdf[:n, -1] = 1 << SCALE - BUCKET_BITS

    def invert(self, n: int) -> None:
        """The bucket at each unit of order 0 in the first ``n`` lanes, for the decoder."""
        part = np.diff(self.cdf[:n], axis=1).ravel()
        self.bucket_of = np.repeat(np.tile(np.arange(BUCKETS, dtype=np.int16), n), part)

    def predict(self, n: int) -> None:
        """Predictions (id + 1) and interval sizes of the first ``n`` lanes."""
        p = self.before[:n]
        self.i1 = self.off1[:n] + (p & (SLOTS1 - 1))
        self.i2 = self.off2[:n] + ((p * 661 + self.earlier[:n]) & (SLOTS2 - 1))
        one, two = self.one.take(self.i1), self.two.take(self.i2)
        self.run1, self.run2 = one & (RUN - 1), two & (RUN - 1)
        self.p1, self.p2 = one >> 3, two >> 3
        agree = self.p1 == self.p2
        self.s2 = self.off_a[:n] + self.run2 * 2 + agree
        self.s1 = self.off_b[:n] + self.run1
        self.f2, self.b = self.hit_two.take(self.s2), self.hit_one.take(self.s1)
        self.f1 = ((65536 - self.f2) >> 2) * (self.b >> 2) >> 12
        self.f1 *= ~agree

    def update(self, n: int, x: np.ndarray, x1: np.ndarray, hit2: np.ndarray) -> None:
        """Learn the ids ``x`` (``x1``: plus one) of the first ``n`` lanes."""
        right = x1 == self.p1
        self.hit_two[self.s2] = self.f2 + ((hit2 * 63936 + 64 - self.f2) >> 4)
        self.hit_one[self.s1] = self.b + ((right * 59936 + 64 - self.b) >> 4)
        new = x1 << 3
        self.one[self.i1] = new + np.minimum(self.run1 + 1, RUN - 1) * right
        self.two[self.i2] = new + np.minimum(self.run2 + 1, RUN - 1) * hit2
        self.flat_counts[self.off_n[:n] + (x >> BUCKET_BITS)] += 1
        self.earlier, self.before = self.before, x


def _settled(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    return (low >> _TOP == (low + size - _ONE) >> _TOP) | (size <= _LOW32)


def _cut(low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The interval after its first digit has gone, cut at the digit's end where it straddled it."""
    end = np.uint64(1 << 32) - (low & _LOW32)
    size = np.minimum(size, end)
    return (low << _16) & _MASK, size << _16


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """The code of every block of ids."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    length = np.array([len(blocks[i]) for i in order], np.int64)
    out = [b""] * len(blocks)
    most = int(length[0]) if len(order) else 0
    if most == 0:
        return out
    lanes = int((length > 0).sum())
    ids = np.zeros((most, lanes), np.int32)
    for lane in range(lanes):
        ids[: length[lane], lane] = blocks[order[lane]]
    m = Model(lanes)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, _MASK, np.uint64)
    digits, used = np.empty((lanes, 3 * most + 8), np.uint16), np.zeros(lanes, np.int64)
    alive = np.searchsorted(-length[:lanes], -np.arange(1, most + 1), "right")
    for t in range(most):
        n = int(alive[t])
        if t % REFRESH == 0:
            m.refresh(n)
        x = ids[t, :n]
        x1 = x + 1
        m.predict(n)
        f1, f2 = m.f1, m.f2
        hit2 = x1 == m.p2
        hit1 = (x1 == m.p1) & (f1 > 0)
        at, wide = f2 + f1, 65536 - f2 - f1
        np.copyto(at, f2, where=hit1)
        np.copyto(wide, f1, where=hit1)
        np.copyto(at, 0, where=hit2)
        np.copyto(wide, f2, where=hit2)
        unit = size[:n] >> _16
        lo, sz = low[:n] + unit * at.astype(np.uint64), unit * wide.astype(np.uint64)
        free = np.flatnonzero(~(hit1 | hit2))
        y = x[free]
        c = m.off_c[free] + (y >> BUCKET_BITS)
        start = m.flat_cdf.take(c)
        part = m.flat_cdf.take(c + 1) - start
        unit = sz[free] >> _17
        lo[free] += unit * ((start << BUCKET_BITS) + part * (y & _INSIDE)).astype(np.uint64)
        sz[free] = unit * part.astype(np.uint64)
        go = np.flatnonzero(_settled(lo, sz))
        while len(go):
            g, s = lo[go], sz[go]
            digits[go, used[go]] = (g >> _TOP).astype(np.uint16)
            used[go] += 1
            g, s = _cut(g, s)
            lo[go], sz[go] = g, s
            go = go[_settled(g, s)]
        low[:n], size[:n] = lo, sz
        m.update(n, x, x1, hit2)
        if t + 1 == most or alive[t + 1] < n:
            for lane in range(int(alive[t + 1]) if t + 1 < most else 0, n):
                tail = [(int(low[lane]) >> k) & 0xFFFF for k in (32, 16, 0)]
                out[order[lane]] = np.concatenate([digits[lane, : used[lane]], np.array(tail, np.uint16)]).astype("<u2").tobytes()
    return out


def decode(codes: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The ids of every block, from its code and its number of ids."""
    order = sorted(range(len(codes)), key=lambda i: -lengths[i])
    length = np.array([lengths[i] for i in order], np.int64)
    out = [np.zeros(0, np.uint16)] * len(codes)
    most = int(length[0]) if len(order) else 0
    if most == 0:
        return out
    lanes = int((length > 0).sum())
    raw = [np.frombuffer(codes[order[k]], "<u2") for k in range(lanes)]
    digits = np.zeros((lanes, max(map(len, raw)) + 4), np.uint64)
    for k, r in enumerate(raw):
        digits[k, : len(r)] = r
    flat, stride = digits.ravel(), digits.shape[1]
    m = Model(lanes)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, _MASK, np.uint64)
    code = (digits[:, 0] << np.uint64(32)) | (digits[:, 1] << _16) | digits[:, 2]
    used = np.full(lanes, 3, np.int64)
    ids = np.zeros((most, lanes), np.uint16)
    alive = np.searchsorted(-length[:lanes], -np.arange(1, most + 1), "right")
    for t in range(most):
        n = int(alive[t])
        if t % REFRESH == 0:
            m.refresh(n)
            m.invert(n)
        m.predict(n)
        f1, f2 = m.f1, m.f2
        unit = size[:n] >> _16
        target = ((code[:n] - low[:n]) // unit).astype(np.int64)
        hit2 = target < f2
        hit1 = (target < f2 + f1) & ~hit2
        at, wide = f2 + f1, 65536 - f2 - f1
        np.copyto(at, f2, where=hit1)
        np.copyto(wide, f1, where=hit1)
        np.copyto(at, 0, where=hit2)
        np.copyto(wide, f2, where=hit2)
        lo, sz = low[:n] + unit * at.astype(np.uint64), unit * wide.astype(np.uint64)
        x1 = np.where(hit2, m.p2, m.p1)
        free = np.flatnonzero(~(hit1 | hit2))
        unit = sz[free] >> _17
        goal = np.minimum((code[free] - lo[free]) // unit, np.uint64((1 << SCALE) - 1)).astype(np.int32)
        whole = goal >> BUCKET_BITS
        base = m.off_c[free]
        k = m.bucket_of.take((free << SCALE - BUCKET_BITS) + whole).astype(np.int64)
        start = m.flat_cdf.take(base + k)
        part = m.flat_cdf.take(base + k + 1) - start
        inside = np.minimum((goal - (start << BUCKET_BITS)) // part, _INSIDE)
        lo[free] += unit * ((start << BUCKET_BITS) + part * inside).astype(np.uint64)
        sz[free] = unit * part.astype(np.uint64)
        x1[free] = (k << BUCKET_BITS) + inside + 1
        x = x1 - 1
        go = np.flatnonzero(_settled(lo, sz))
        while len(go):
            g, s = _cut(lo[go], sz[go])
            code[go] = ((code[go] << _16) & _MASK) | flat[go * stride + np.minimum(used[go], stride - 1)]
            used[go] += 1
            lo[go], sz[go] = g, s
            go = go[_settled(g, s)]
        low[:n], size[:n] = lo, sz
        ids[t, :n] = x
        m.update(n, x, x1, hit2)
    for lane in range(lanes):
        out[order[lane]] = ids[: length[lane], lane].copy()
    return out
