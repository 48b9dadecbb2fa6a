"""Adaptive context-mixing range coder for token ids, over many independent blocks at a time.

Each block is coded alone, from a fresh model. The model predicts the next id of a block by three
orders and mixes them into one distribution: order 0 is the frequencies of the block so far over a fixed
falling prior; orders 1 and 2 each name the id that came most recently after the last one or two
ids. Their weights are learned for each state of the two contexts: how often each was right in a row, up to
three, and whether they name one id. The named ids follow every id at once; frequencies and weights
take up what was seen at fixed places (`UPDATE_AT`). The mixture drives one step of a range coder for each id.
A decoder that runs the same model reads the ids back.

An encoder knows all ids, so it works out a block's intervals in bulk. A decoder steps through the blocks of a
call side by side, a handful of numpy operations over all of them for each place. Memory is about
300 kB for each block with a vocabulary of 50,000, for at most `LANES` blocks at a time.
"""

from __future__ import annotations

import math

import numpy as np

#: Ids of a full block, and blocks coded side by side.
BLOCK_IDS = 16384
LANES = 512
#: Bits of the order-0 distribution and of the weights; their sum is the total of the mixture.
ORDER0_BITS, WEIGHT_BITS = 20, 8
TOTAL_BITS = ORDER0_BITS + WEIGHT_BITS
#: The range is kept above this by moving out 16 bits at a time.
FLOOR = 1 << 48
#: Contexts of a block share this many slots.
SLOTS = 1 << 13
#: Larger vocabularies would leave too little beside the share that every id keeps.
MAX_VOCABULARY = 1 << 18
#: Places in a block where frequencies and weights take up all that came before.
UPDATE_AT = (128, 512, 1536, 4096, 8192, 12288)
#: Weights at the start for a context that was right 0 (never seen) to 3 or more times in a row, in 1/65536.
START_1 = (0, 3000, 12000, 20000)
START_2 = (0, 8000, 20000, 36000)
#: The weights at the start count as this many ids of each state.
START_COUNT = 32
#: Children of a node of the search tree over the order-0 distribution.
FAN = 16


class Orders:
    """What a block's model knows at its start, and how it takes up what came."""

    def __init__(self, vocabulary: int):
        if not 0 < vocabulary <= MAX_VOCABULARY:
            raise ValueError(f"a vocabulary has 1 to {MAX_VOCABULARY} ids, not {vocabulary}")
        self.vocabulary = vocabulary
        self.width = -(-(vocabulary + 2) // 4096) * 4096
        whole = 1 << ORDER0_BITS
        places = np.arange(vocabulary + 1)
        falling = np.log((places + 32) / 32) / math.log((vocabulary + 32) / 32)
        # Every id keeps at least one unit, so any id can be coded at any time.
        self.base = (places + np.floor(falling * (whole >> 4))).astype(np.int32)
        self.start = np.full(self.width, whole, np.int32)
        self.start[:vocabulary] = (places + np.floor(falling * (whole - vocabulary)))[:vocabulary]
        one, two = np.meshgrid(START_1, START_2)  # state = one + 4 * two, and 16 more where both name one id
        self.prior1 = np.concatenate([one.ravel(), np.zeros(16, int)])
        self.prior2 = np.concatenate([two.ravel(), np.maximum(one, two).ravel()])

    def cumulative(self, ids: np.ndarray) -> np.ndarray:
        """Starts of all ids in the order-0 distribution after these ids of the block."""
        n = self.vocabulary
        row = np.full(self.width, 1 << ORDER0_BITS, np.int32)
        row[0] = 0
        unit = ((1 << ORDER0_BITS) - int(self.base[n])) // len(ids)
        found, counts = np.unique(ids, return_counts=True)
        # Every start behind an id that came moves up by what came before it.
        moved = np.concatenate([[0], np.cumsum(counts * unit)]).astype(np.int32)
        row[:n] = np.repeat(moved, np.diff(np.concatenate([[0], found + 1, [n]])))[:n]
        row[1:n] += self.base[1:n]
        return row

    def weights(self, states: np.ndarray, right1: np.ndarray, right2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights of orders 1 and 2 in each state, in units of the mixture, after these steps of the block."""
        n = np.bincount(states, minlength=32) + START_COUNT
        hits1 = np.bincount(states[right1 & (states < 16)], minlength=32)  # an id that both name is order 2's
        hits2 = np.bincount(states[right2], minlength=32)
        return tuple(
            ((START_COUNT * prior + 65535 * hits) // n >> (16 - WEIGHT_BITS)) << ORDER0_BITS
            for prior, hits in ((self.prior1, hits1), (self.prior2, hits2)))


def slots(last1, last2):
    """Where the contexts of one and of two ids are kept."""
    return last1 & (SLOTS - 1), ((last1 * 0x9E3779B1 + last2 * 0x85EBCA6B) >> 15) & (SLOTS - 1)


def followers(slot: np.ndarray, ids: np.ndarray, unseen: int) -> np.ndarray:
    """For each place what its slot holds then: the id that came there last, times 4, and how often in a row (up to 3)."""
    n = len(ids)
    order = np.sort(slot * n + np.arange(n))
    at = order % n
    came, where = ids[at], order // n
    again = np.zeros(n, bool)
    again[1:] = (where[1:] == where[:-1]) & (came[1:] == came[:-1])
    place = np.arange(n)
    in_a_row = np.minimum(place - np.maximum.accumulate(np.where(again, 0, place)) + 1, 3)
    held = np.full(n, unseen)
    held[1:] = np.where(where[1:] == where[:-1], (came[:-1] << 2) | in_a_row[:-1], unseen)
    out = np.empty(n, np.int64)
    out[at] = held
    return out


def block_intervals(ids: np.ndarray, orders: Orders) -> tuple[np.ndarray, np.ndarray]:
    """Where each id of one block lies in the mixture that is predicted there, and how wide it is.

    The mixture begins with the id that order 1 names, then order 2's, then all ids by order 0. An id that lies there
    more than once is coded at its widest place.
    """
    ids = ids.astype(np.int64)
    n, unseen = len(ids), orders.vocabulary << 2
    last1, last2 = np.zeros(n, np.int64), np.zeros(n, np.int64)
    last1[1:], last2[2:] = ids[:-1], ids[:-2]
    slot1, slot2 = slots(last1, last2)
    has1, has2 = followers(slot1, ids, unseen), followers(slot2, ids, unseen)
    id1, id2 = has1 >> 2, has2 >> 2
    states = (has1 & 3) + ((has2 & 3) << 2) + ((id1 == id2) << 4)
    right1, right2 = id1 == ids, id2 == ids
    start, width = np.empty(n, np.uint32), np.empty(n, np.uint32)
    edges = [0, *(u for u in UPDATE_AT if u < n), n]
    for a, b in zip(edges, edges[1:]):
        row = orders.cumulative(ids[:a]) if a else orders.start
        w1, w2 = (w.take(states[a:b]) for w in orders.weights(states[:a], right1[:a], right2[:a]))
        w0 = (1 << WEIGHT_BITS) - ((w1 + w2) >> ORDER0_BITS)
        low = row.take(ids[a:b])
        at, wide = w1 + w2 + w0 * low, w0 * (row.take(ids[a:b] + 1) - low)
        for right, named_at, named_wide in ((right1, 0, w1), (right2, w1, w2)):
            better = right[a:b] & (named_wide > wide)
            at, wide = np.where(better, named_at, at), np.where(better, named_wide, wide)
        start[a:b], width[a:b] = at, wide
    return start, width


def block_lengths(n_ids: int, n_blocks: int) -> np.ndarray:
    """Lengths of blocks that differ by one at most, the longer ones first."""
    return np.full(n_blocks, n_ids // n_blocks) + (np.arange(n_blocks) < n_ids % n_blocks)


def blocks_for(n_ids: int, lanes: int = LANES, block_ids: int = BLOCK_IDS) -> int:
    """How many blocks hold n ids: full ones, or shorter ones as long as there are few."""
    return max(1, -(-n_ids // block_ids), min(lanes, n_ids // (block_ids // 4)))


def encode_blocks(ids: np.ndarray, n_blocks: int, vocabulary: int) -> list[bytes]:
    """The codes of `n_blocks` blocks that the ids make (`block_lengths`)."""
    lengths = block_lengths(len(ids), n_blocks)
    longest = int(lengths[0])
    orders = Orders(vocabulary)
    starts, widths = np.zeros((n_blocks, longest), np.uint32), np.zeros((n_blocks, longest), np.uint32)
    at = 0
    for k, length in enumerate(lengths):
        starts[k, :length], widths[k, :length] = block_intervals(ids[at:at + length], orders)
        at += length
    starts, widths = np.ascontiguousarray(starts.T), np.ascontiguousarray(widths.T)
    words = np.zeros((n_blocks, 2 * longest + 2), np.uint16)
    flat, put = words.reshape(-1), np.arange(n_blocks) * words.shape[1]
    row = put.copy()
    low, span = np.zeros(n_blocks, np.uint64), np.full(n_blocks, 2**64 - 1, np.uint64)

    def carry(at):
        while at.size:
            flat[at] += 1
            at = at[flat[at] == 0] - 1

    for step in range(longest):
        if step == longest - 1:
            live = int((lengths > step).sum())
            whole_low, whole_span, whole_put = low, span, put
            low, span, put = low[:live], span[:live], put[:live]
        span >>= TOTAL_BITS
        add = span * starts[step, :len(span)]
        low += add
        over = low < add
        if over.any():
            carry(put[over] - 1)
        span *= widths[step, :len(span)]
        out = np.flatnonzero(span < FLOOR)
        while out.size:
            flat[put[out]] = low[out] >> 48
            put[out] += 1
            low[out] <<= 16
            span[out] <<= 16
            out = out[span[out] < FLOOR]
    if longest:
        low, span, put = whole_low, whole_span, whole_put
    # One more word names a value inside every last range: what follows counts as zeros.
    last = low + (FLOOR - 1)
    carry(put[last < low] - 1)
    flat[put] = last >> 48
    n_words = put - row + 1
    return [words[k, :n_words[k]].astype("<u2").tobytes() for k in range(n_blocks)]


class Lanes:
    """The mixed prediction of the next id in each of several blocks, for a decoder."""

    def __init__(self, lanes: int, longest: int, orders: Orders):
        self.lanes, self.orders = lanes, orders
        self.ids = np.zeros((longest, lanes), np.int32)
        self.states = np.zeros((longest, lanes), np.uint8)
        self.right = np.zeros((longest, lanes), np.uint8)
        # The distribution as a tree: each level holds every 16th start of the one below, 16 in a node.
        self.levels = [np.empty((lanes, orders.width // FAN**k), np.int32) for k in range(3)]
        self.top = np.full((lanes, FAN * -(-orders.width // (4096 * FAN))), 1 << ORDER0_BITS, np.int32)
        self.nodes = [level.reshape(-1, FAN) for level in self.levels]
        self.cum = self.levels[0].reshape(-1)
        self.weights = np.empty((lanes, 32), np.int64)  # of order 1, and of order 2 in the upper half
        none = np.empty(0, np.int64)
        for lane in range(lanes):
            self.set_row(lane, orders.start)
        self.set_weights(slice(None), none, none)
        self.after1 = np.full(lanes * SLOTS, orders.vocabulary << 2, np.int32)
        self.after2 = self.after1.copy()
        lane = np.arange(lanes)
        self.at_cum, self.at_slot, self.at_state = lane * orders.width, lane * SLOTS, lane * 32
        self.last1, self.last2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.step = 0

    def set_row(self, lane: int, row: np.ndarray) -> None:
        for k, level in enumerate(self.levels):
            level[lane] = row[::FAN**k]
        self.top[lane, :self.orders.width // 4096] = row[::4096]

    def set_weights(self, lane, states: np.ndarray, right: np.ndarray) -> None:
        w1, w2 = self.orders.weights(states, right & 1 > 0, right & 2 > 0)
        self.weights[lane] = w1 | (w2 << 32)

    def keep(self, lanes: int) -> None:
        """Go on with the first blocks only: the others have ended."""
        for name in ("at_cum", "at_slot", "at_state", "last1", "last2"):
            setattr(self, name, getattr(self, name)[:lanes])
        self.lanes = lanes

    def predict(self) -> None:
        """The ids that orders 1 and 2 name, and the weights of the three orders."""
        slot1, slot2 = slots(self.last1, self.last2)
        self.slot1, self.slot2 = slot1 + self.at_slot, slot2 + self.at_slot
        self.has1, self.has2 = self.after1.take(self.slot1), self.after2.take(self.slot2)
        self.id1, self.id2 = self.has1 >> 2, self.has2 >> 2
        state = (self.has1 & 3) + ((self.has2 & 3) << 2) + ((self.id1 == self.id2) << 4)
        self.states[self.step, :self.lanes] = state
        weights = self.weights.take(state + self.at_state)
        self.w1 = weights & 0xFFFFFFFF
        self.named = self.w1 + (weights >> 32)
        self.w0 = (1 << WEIGHT_BITS) - (self.named >> ORDER0_BITS)

    def find(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids that hold the places `at` of the mixture, and where they lie and how wide they are there."""
        # Whole numbers below 2^28 by numbers up to 256: the floor of the quotient in doubles is exact.
        rest = np.maximum((at - self.named) / self.w0, 0).astype(np.int32)[:, None]
        found = self.count(self.top[:self.lanes], rest)
        for k in (2, 1, 0):
            found = found * FAN + self.count(self.nodes[k].take((self.at_cum >> 4 * (k + 1)) + found, axis=0), rest)
        place = self.at_cum + found
        low = self.cum.take(place)
        start, width = self.named + self.w0 * low, self.w0 * (self.cum.take(place + 1) - low)
        hit = np.flatnonzero(at < self.named)
        if hit.size:
            w1, named = self.w1[hit], self.named[hit]
            first = at[hit] < w1
            found[hit] = np.where(first, self.id1[hit], self.id2[hit])
            start[hit] = np.where(first, 0, w1)
            width[hit] = np.where(first, w1, named - w1)
        return found, start, width

    @staticmethod
    def count(nodes: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Which child of its node holds each place: how many starts are at or below it, less one."""
        ones = np.bitwise_count((nodes <= rest).view(np.uint64))
        found = ones[:, 0] + ones[:, 1]
        for more in range(2, ones.shape[1]):
            found = found + ones[:, more]
        return found.astype(np.int64) - 1

    def update(self, ids: np.ndarray) -> None:
        """Learn the ids that came."""
        right1, right2 = self.id1 == ids, self.id2 == ids
        self.ids[self.step, :self.lanes] = ids
        self.right[self.step, :self.lanes] = right1 + (right2.view(np.uint8) << 1)
        fresh = (ids << 2) | 1
        for after, slot, has, right in (
                (self.after1, self.slot1, self.has1, right1), (self.after2, self.slot2, self.has2, right2)):
            after[slot] = fresh
            hit = np.flatnonzero(right)
            held = has[hit]
            after[slot[hit]] = held + ((held & 3) < 3)
        self.last2, self.last1 = self.last1, ids
        self.step += 1
        if self.step in UPDATE_AT:
            ids, states, right = (x[:self.step].T.copy() for x in (self.ids, self.states, self.right))
            for lane in range(self.lanes):
                self.set_row(lane, self.orders.cumulative(ids[lane]))
                self.set_weights(lane, states[lane], right[lane])


def decode_blocks(codes: list[bytes], n_ids: int, vocabulary: int) -> np.ndarray:
    """The ids of blocks that `encode_blocks` made of n ids."""
    n_blocks = len(codes)
    lengths = block_lengths(n_ids, n_blocks)
    longest = int(lengths[0])
    model = Lanes(n_blocks, longest, Orders(vocabulary))
    # Beyond its end a code goes on with zeros, and a damaged one may ask for as many words as the longest.
    words = np.zeros((n_blocks, max(max(map(len, codes)) // 2, 2 * longest) + 8), np.uint16)
    for k, code in enumerate(codes):
        words[k, :len(code) // 2] = np.frombuffer(code, "<u2")
    flat = words.reshape(-1)
    at = np.arange(n_blocks) * words.shape[1]
    value, span = np.zeros(n_blocks, np.uint64), np.full(n_blocks, 2**64 - 1, np.uint64)
    for _ in range(4):
        value = (value << 16) | flat.take(at)
        at += 1
    for step in range(longest):
        if step == longest - 1:
            live = int((lengths > step).sum())
            model.keep(live)
            value, span, at = value[:live], span[:live], at[:live]
        model.predict()
        span >>= TOTAL_BITS
        place = np.minimum(value // span, (1 << TOTAL_BITS) - 1).astype(np.int64)
        now, start, width = model.find(place)
        value -= span * start.astype(np.uint64)
        span *= width.astype(np.uint64)
        more = np.flatnonzero(span < FLOOR)
        while more.size:
            value[more] = (value[more] << 16) | flat.take(at[more])
            at[more] += 1
            span[more] <<= 16
            more = more[span[more] < FLOOR]
        model.update(now)
    ids, short = model.ids, int(lengths[-1])
    longer = int((lengths > short).sum())
    parts = [ids[:, :longer].T.reshape(-1)] if longer else []
    return np.concatenate([*parts, ids[:short, longer:].T.reshape(-1)]).astype(np.uint32)
