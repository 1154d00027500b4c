"""A range coder for token ids, with predictions of order 0 to 2, over many blocks in step.

Blocks know nothing of each other. They are coded side by side, one id of every block
per step, so that each step is a handful of array operations.

An id is coded as one of three events, whose shares adapt: the id that last followed the two
previous ids (order 2), the id that last followed the previous one (order 1), or another one. How much
each prediction is trusted is learned per block and per confidence of the two. Another id is coded by
adaptive frequencies of classes of neighbouring ids (order 0) and its place in its class.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 2048
LANES = 4096
SLOTS_1, SLOTS_2 = 10, 11  # bits of the order-1 and order-2 tables
EVENT_BITS, CLASS_BITS = 16, 10
REFRESH = 256  # steps between two rebuilds of the class frequencies
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
WORD = np.uint64(32)
BOTTOM = np.uint64(1 << 32)
LOWER_WORD = np.uint64(0xFFFFFFFF)
HASH_1, HASH_2 = np.uint32(2654435761), np.uint32(0x85EBCA6B)
TRUST_1, TRUST_2 = np.uint32(1911), np.uint32(1911 << 16)  # at most 1911 * 32 + 63 of 65,536 together
WHOLE = np.uint32(1 << EVENT_BITS)
ONE, NO_CLASS = np.uint8(1), np.uint8(255)  # their sum is 0 in 8 bits
FREQ_BITS = 11
FREQ_MASK, FREQ_SHIFT = np.uint32((1 << FREQ_BITS) - 1), np.uint32(FREQ_BITS)
# (first id, bits of a class) of the ranges of ids; low ids are the frequent ones.
RANGES = [(0, 4), (512, 6), (4096, 8), (16384, 12)]
MAX_ID = 1 << 17


def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first, bits = [], []
    for (low, b), high in zip(RANGES, [*[r[0] for r in RANGES[1:]], MAX_ID], strict=True):
        for start in range(low, high, 1 << b):
            first.append(start)
            bits.append(b)
    of_id = np.repeat(np.arange(len(first)), 1 << np.array(bits))
    return np.array(first, np.uint32), np.array(bits, np.uint64), of_id.astype(np.uint8)


CLASS_FIRST, CLASS_SIZE_BITS, CLASS_OF = _classes()
CLASSES = len(CLASS_FIRST)
PLACE_MASK = (1 << CLASS_SIZE_BITS.astype(np.uint32)) - np.uint32(1)  # classes begin at multiples of their size


class Model:
    """Predictions and their trust for a number of blocks, longest first.

    Tables hold the same slot of all blocks side by side: blocks often look at the same slots, the frequent ones.
    """

    def __init__(self, lanes: int, decodes: bool) -> None:
        # An entry is a predicted id and two bits of confidence.
        self.table_1 = np.zeros(lanes << SLOTS_1, np.uint32)
        self.table_2 = np.zeros(lanes << SLOTS_2, np.uint32)
        self.lanes, self.lane = lanes, np.arange(lanes)
        self.at_1, self.at_2 = self.lane, self.lane  # the entries for the next id
        # Shares of order 2 (upper half) and order 1 (lower half), in 65,536ths.
        self.trust = np.full(lanes * 32, 15296 << 16 | 7648, np.uint32)
        self.seen = np.full((CLASSES, lanes), 2, np.int32)
        self.lane_point = self.lane << CLASS_BITS
        self.recent = np.zeros((REFRESH, lanes), np.uint8)  # 1 + classes that came since the last refresh, or 0
        self.came = 0
        self.before = np.zeros(lanes, np.uint32)
        self.decodes = decodes
        self.refresh()

    def refresh(self) -> None:
        """Class frequencies that sum to 2^CLASS_BITS, and the class of every point."""
        seen = self.seen
        if self.came:
            places = self.recent[: self.came] * np.intp(self.lanes) + self.lane
            came = np.bincount(places.ravel(), minlength=seen.size + self.lanes)[self.lanes :]
            seen += came.astype(np.int32).reshape(seen.shape) * np.int32(24)
            self.came = 0
        total = seen.sum(axis=0)
        spare = (1 << CLASS_BITS) - CLASSES
        share = (seen * (spare / total)).astype(np.uint32) + np.uint32(1)
        share[seen.argmax(axis=0), self.lane] += ((1 << CLASS_BITS) - share.sum(axis=0)).astype(np.uint32)
        # Where a class begins, and its frequency in the lower bits.
        begin = np.cumsum(share, axis=0, dtype=np.uint32) - share
        self.bounds = (begin << FREQ_SHIFT | share).ravel()
        if self.decodes:
            self.point = np.repeat(np.tile(np.arange(CLASSES, dtype=np.uint8), self.lanes), share.T.ravel())
        heavy = total > 1 << 15
        if heavy.any():
            seen[:, heavy] -= seen[:, heavy] >> 1

    def predict(self, n: int) -> None:
        """The two predicted ids and the bounds of their events, for the first n blocks."""
        self.at_1, self.at_2 = self.at_1[:n], self.at_2[:n]
        self.e1, self.e2 = self.table_1.take(self.at_1), self.table_2.take(self.at_2)
        self.p1, self.p2 = self.e1 >> 2, self.e2 >> 2
        self.c1, self.c2 = self.e1 & 3, self.e2 & 3
        self.at_t = self.at((self.c2 << 3) + (self.c1 << 1) + (self.p1 == self.p2))
        self.shares = self.trust.take(self.at_t)
        self.a = self.shares >> 16
        self.ab = self.a + (self.shares & 65535)

    def at(self, slots: np.ndarray) -> np.ndarray:
        """Where these slots of the first blocks are in a table."""
        at = slots.astype(np.intp)
        at *= self.lanes
        at += self.lane[: len(at)]
        return at

    def learn(self, n: int, ids: np.ndarray, hits: np.ndarray, by_2: np.ndarray, classes: np.ndarray) -> None:
        """Take in the ids that came. hits: blocks whose event was a prediction, by_2: of order 2; classes: 1 + those used, or 0."""
        fresh = ids << 2 | 1
        new, by_1 = fresh.copy(), self.p1.take(hits) == ids.take(hits)
        new[hits] += by_2 * np.minimum(self.c2.take(hits), 2)
        fresh[hits] += by_1 * np.minimum(self.c1.take(hits), 2)
        self.table_2[self.at_2] = new
        self.table_1[self.at_1] = fresh
        # Both shares lose a 32nd.
        kept = self.shares - ((self.shares >> 5) & 0x07FF07FF)
        kept[hits] += np.where(by_2, TRUST_2, TRUST_1)
        self.trust[self.at_t] = kept
        self.recent[self.came, :n] = classes
        self.came += 1
        mixed = ids * HASH_1
        self.at_1 = self.at(mixed >> (32 - SLOTS_1))
        self.at_2 = self.at(self.before[:n] + mixed >> (32 - SLOTS_2))
        self.before = ids * HASH_2


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """The payload of every block of at most ``BLOCK`` ids."""
    out: list[bytes] = []
    for at in range(0, len(blocks), LANES):
        out += _encode(blocks[at : at + LANES])
    return out


def decode(payloads: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The ids of every block, as unsigned 32-bit integers."""
    out: list[np.ndarray] = []
    for at in range(0, len(payloads), LANES):
        out += _decode(payloads[at : at + LANES], lengths[at : at + LANES])
    return out


def _longest_first(lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the blocks by falling length, and how many are open at each step."""
    sizes = np.array(lengths, np.int64)
    order = np.argsort(-sizes, kind="stable")
    open_blocks = len(sizes) - np.searchsorted(sizes[order][::-1], np.arange(sizes.max(initial=0)), "right")
    return order, open_blocks


def _encode(blocks: list[np.ndarray]) -> list[bytes]:
    order, open_blocks = _longest_first([len(b) for b in blocks])
    lanes, steps = len(blocks), len(open_blocks)
    grid = np.zeros((steps, lanes), np.uint32)
    for lane, i in enumerate(order):
        if len(blocks[i]) and np.max(blocks[i]) >= MAX_ID:
            raise ValueError(f"ids must be below {MAX_ID}")
        grid[: len(blocks[i]), lane] = blocks[i]
    words = np.zeros((steps + 2) * lanes, np.uint32)  # the same word of all blocks side by side
    free = np.arange(lanes)  # where the next word of a block goes
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, FULL)
    model = Model(lanes, decodes=False)
    event, class_bits = np.uint64(EVENT_BITS), np.uint64(CLASS_BITS)
    for step, n in enumerate(open_blocks):
        if step and step % REFRESH == 0:
            model.refresh()
        ids = grid[step, :n]
        model.predict(n)
        hit_2 = model.p2 == ids
        hits = np.flatnonzero(hit_2 | (model.p1 == ids))
        by_2 = hit_2.take(hits)
        lo, r = low[:n], span[:n] >> event
        c = CLASS_OF.take(ids)
        place = c.astype(np.intp)
        bounds = model.bounds.take(model.at(place))
        span = r * (WHOLE - model.ab) >> class_bits
        begin = r * model.ab
        begin += span * (bounds >> FREQ_SHIFT)
        span *= bounds & FREQ_MASK
        span >>= CLASS_SIZE_BITS.take(place)
        begin += span * (ids & PLACE_MASK.take(place))
        r, a = r.take(hits), model.a.take(hits)
        begin[hits] = r * np.where(by_2, 0, a)
        span[hits] = r * np.where(by_2, a, model.ab.take(hits) - a)
        c[hits] = NO_CLASS
        lo += begin
        out, x = _settled(lo, span)
        to = free.take(out)
        words[to] = (x >> WORD).astype(np.uint32)
        free[out] = to + lanes
        model.learn(n, ids, hits, by_2, c + ONE)
    words[free], words[free + lanes] = low >> WORD, low & LOWER_WORD
    used = free // lanes + 2
    rows = words.reshape(-1, lanes)[: used.max()].T.astype("<u4", order="C")
    out_bytes: list[bytes] = [b""] * lanes
    for lane, i in enumerate(order):
        out_bytes[i] = rows[lane, : used[lane]].tobytes()
    return out_bytes


def _settled(lo: np.ndarray, sp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks whose upper word is known or must be, and their low ends.

    Their low ends move up by a word, so do their spans, cut where a carry could come.
    """
    out = np.flatnonzero(sp < BOTTOM)
    x = lo.take(out)
    lo[out] = x << WORD
    sp[out] = np.minimum(sp.take(out), BOTTOM - (x & LOWER_WORD)) << WORD
    return out, x


def _decode(payloads: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    order, open_blocks = _longest_first(lengths)
    lanes, steps = len(payloads), len(open_blocks)
    rows = np.zeros((lanes, max(2, max(len(p) for p in payloads) // 4) + 1), np.uint32)
    for lane, i in enumerate(order):
        packed = np.frombuffer(payloads[i], "<u4")
        rows[lane, : len(packed)] = packed
    words = rows.T.ravel()  # the same word of all blocks side by side
    free = np.arange(2 * lanes, 3 * lanes)  # where the next word of a block is
    code = rows[:, 0].astype(np.uint64) << WORD | rows[:, 1]  # less the low end
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, FULL)
    grid = np.zeros((steps, lanes), np.uint32)
    model = Model(lanes, decodes=True)
    event, class_bits = np.uint64(EVENT_BITS), np.uint64(CLASS_BITS)
    last_point = np.uint64((1 << CLASS_BITS) - 1)
    for step, n in enumerate(open_blocks):
        if step and step % REFRESH == 0:
            model.refresh()
        model.predict(n)
        lo, x, r = low[:n], code[:n], span[:n] >> event
        to_ab = r * model.ab
        hits = np.flatnonzero(x < to_ab)
        span = (r << event) - to_ab >> class_bits
        rest = x - to_ab  # from here to the place counts for misses alone
        c = model.point.take(model.lane_point[:n] + np.minimum(rest // span, last_point).view(np.int64))
        place = c.astype(np.intp)
        bounds, first_id, mask = model.bounds.take(model.at(place)), CLASS_FIRST.take(place), PLACE_MASK.take(place)
        begin = span * (bounds >> FREQ_SHIFT)
        span *= bounds & FREQ_MASK
        span >>= CLASS_SIZE_BITS.take(place)
        rest -= begin
        rest //= span
        place = np.minimum(rest, mask, out=rest)
        begin += to_ab
        begin += span * place
        ids = first_id + place.astype(np.uint32)
        to_a = r.take(hits) * model.a.take(hits)
        by_2 = x.take(hits) < to_a
        begin[hits] = np.where(by_2, 0, to_a)
        span[hits] = np.where(by_2, to_a, to_ab.take(hits) - to_a)
        ids[hits] = np.where(by_2, model.p2.take(hits), model.p1.take(hits))
        c[hits] = NO_CLASS
        lo += begin
        x -= begin
        out, _ = _settled(lo, span)
        at = free.take(out)
        x[out] = x.take(out) << WORD | words.take(at, mode="clip").astype(np.uint64)
        free[out] = at + lanes
        grid[step, :n] = ids
        model.learn(n, ids, hits, by_2, c + ONE)
    out_ids: list[np.ndarray] = [np.empty(0, np.uint32)] * lanes
    for lane, i in enumerate(order):
        out_ids[i] = grid[: lengths[i], lane].copy()
    return out_ids


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
