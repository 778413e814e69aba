"""Blocks of token ids under an adaptive context-mixing range coder.

The probability of the next id is a mixture of three predictions: order 0 (how often ids
occurred), order 1 and order 2 (the id that last followed the previous one or two ids).  The mixture's
weights depend on how well the two contexts have predicted so far; the ids move them towards
the predictions that gave them their probability.  Counts, contexts and weights start anew in each
block, so a block can be decoded by itself; its ids carry a CRC-32.

A block is cut into lanes that are coded side by side as arrays and share the model: the ids at
one step of all lanes are coded by the state before the step, which then learns from all of them.
The coder is the range variant of asymmetric numeral systems: an id may own several stretches of the
mixture's total, one for each prediction that names it, so that its own probability is their sum and
decoding finds it by one look at the order-0 table.  Ids are put in from the last step to the first and come out in
their order; the lanes share one sequence of words.
All arithmetic is on integers, or on floating-point quotients that are exact enough to be cut to
integers, so that any machine decodes what another has written.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

U = np.uint64
LANES, LANE_IDS = 4096, 128       # at most so many lanes, of at least so many ids
BASE = 1 << 18                    # total of the order-0 frequencies
BITS = 26                         # of the mixture's total
SLOTS = 1 << 18                   # order-2 contexts
SURE = 7
PLACE = 7
MIXTURES = 1 << PLACE             # sureness of order 1 (0 to SURE), of order 2, and whether they agree
GONE = 1
LOW = U(1) << U(31)               # a lane's state is from LOW up to LOW << 32
LOW32 = U(0xFFFFFFFF)
HEAD = struct.Struct("<IIIII")    # ids, CRC-32, largest id + 1, lanes, words


def _changes(unit: int) -> np.ndarray:
    """What a miss, and one place on a hit, adds to a sureness counted in units; GONE: the guess was too unsure to stay."""
    by = np.zeros((SURE + 1) * unit, np.int32)
    for sure in range(SURE + 1):
        by[sure * unit] = ((sure >> 1) - sure) * unit if sure > 1 else GONE
        by[sure * unit + 1] = (min(sure + 1, SURE) - sure) * unit
    return by


CHANGE1, CHANGE2 = _changes(2 * (SURE + 1)), _changes(2)


class Model:
    """Order-0 to order-2 predictions and their mixture, for ``lanes`` ids at a time."""

    def __init__(self, kinds: int, lanes: int) -> None:
        if kinds * 2 > BASE:
            raise ValueError(f"ids up to {BASE // 2 - 1} can be coded")
        self.kinds = kinds
        self.count = np.zeros(kinds, np.int64)
        self.seen: list[np.ndarray] = []
        self.credit: list[tuple[np.ndarray, ...]] = []
        self.step, self.next_count, self.next_weights = 0, 1, 1
        # by context: guessed id * MIXTURES + sureness as it stands in the number of a mixture
        self.memory1, self.memory2 = np.zeros(kinds + 1, np.int32), np.zeros(SLOTS, np.int32)
        self.back1 = np.full(lanes, kinds, np.int64)      # no id yet
        self.slot = np.zeros(lanes, np.int64)
        # how much each prediction contributed, by mixture: sureness of order 1 and 2, and whether they agree
        self.share = np.ones((3, MIXTURES), np.int64) << 12
        self._recount()
        self._reweigh()

    def _recount(self) -> None:
        if self.seen:
            self.count += np.bincount(np.concatenate(self.seen), minlength=self.kinds)
            self.seen = []
        total = int(self.count.sum())
        freq = 1 + self.count * (BASE - self.kinds) // max(total, 1)
        freq[int(np.argmax(freq))] += BASE - int(freq.sum())
        self.freq, self.inverse = freq.astype(np.int32), None
        self.before = (np.cumsum(freq) - freq).astype(np.int32)

    def _reweigh(self) -> None:
        if self.credit:
            mixture, by1, by2 = map(np.concatenate, zip(*self.credit, strict=True))
            self.credit = []
            # sums of quotients in a fixed order, cut to integers
            got1, got2 = ((np.bincount(mixture, by, MIXTURES) * 4096).astype(np.int64) for by in (by1, by2))
            self.share += np.stack([np.maximum((np.bincount(mixture, minlength=MIXTURES) << 12) - got1 - got2, 0), got1, got2])
            large = self.share.sum(axis=0) > 1 << 24
            if large.any():
                self.share[:, large] = np.maximum(self.share[:, large] >> 1, 1)
        s0, s1, s2 = self.share
        most = (1 << BITS) // BASE
        weight0 = np.clip(s0 * most // (s0 + s1 + s2), 1, most)
        rest = (1 << BITS) - weight0 * BASE
        weight1 = rest * s1 // (s1 + s2)
        self.weight0, self.weight1, self.weight2 = (w.astype(np.int32) for w in (weight0, weight1, rest - weight1))

    def look(self, n: int) -> None:
        """Predictions and weights for the next id of the first ``n`` lanes."""
        self.c1, self.c2 = self.back1[:n], self.slot[:n]
        # in numpy, clipped places are looked up in half the time of checked ones; none is out of range
        self.m1, self.m2 = self.memory1.take(self.c1, mode="clip"), self.memory2.take(self.c2, mode="clip")
        self.p1, self.p2 = self.m1 >> PLACE, self.m2 >> PLACE
        self.s1, self.s2 = self.m1 & MIXTURES - 1, self.m2 & MIXTURES - 1
        self.mixture = np.add(self.s1, self.s2, dtype=np.int64)
        self.mixture += self.p1 == self.p2
        self.w0, self.w1, self.w2 = (w.take(self.mixture, mode="clip") for w in (self.weight0, self.weight1, self.weight2))
        self.floor = self.w0 * BASE               # order 0 has what is below; then come orders 1 and 2

    def stretches(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(width in all, width in order 0, place in order 0, place beyond minus the width in order 0) of ids."""
        self.ids = ids.astype(np.int32)
        self.hit1, self.hit2 = self.p1 == self.ids, self.p2 == self.ids
        of0, of1, of2 = self.w0 * self.freq.take(ids, mode="clip"), self.w1 * self.hit1, self.w2 * self.hit2
        width = of0 + of1 + of2
        self.credit.append((self.mixture, of1 / width, of2 / width))
        return width, of0, self.w0 * self.before.take(ids, mode="clip"), self.floor - of0 + (self.w1 - of1)

    def at(self, value: np.ndarray) -> np.ndarray:
        """The ids that own places of the mixture's total."""
        if self.inverse is None:
            self.inverse = np.repeat(np.arange(self.kinds, dtype=np.int32), self.freq)
        # quotients of integers this small are far enough from the next one for floating point
        ids = self.inverse.take((value / self.w0).astype(np.int64), mode="clip").astype(np.int64)
        over = np.flatnonzero(value >= self.floor)
        first = value[over] - self.floor[over] < self.w1[over]
        ids[over] = np.where(first, self.p1[over], self.p2[over])
        return ids

    def learn(self, ids: np.ndarray) -> None:
        """Take in the ids of this step; ``stretches`` has been called for them."""
        for hit, memory, at, old, sure, change in ((self.hit1, self.memory1, self.c1, self.m1, self.s1, CHANGE1),
                                                   (self.hit2, self.memory2, self.c2, self.m2, self.s2, CHANGE2)):
            by = change.take(sure + hit, mode="clip")
            memory[at] = old + by
            new = np.flatnonzero(by == GONE)      # a guess that was unsure and wrong makes room
            memory[at[new]] = self.ids[new] << PLACE
        n = len(ids)
        self.slot[:n] = self.c1 * 0x2F0B4C47 + ids & SLOTS - 1
        self.back1[:n] = ids
        self.seen.append(ids)
        self.step += 1
        if self.step >= self.next_weights:    # often at first, then every 8 steps
            self._reweigh()
            self.next_weights = self.step + min(self.step, 8)
        if self.step >= self.next_count:      # often at first, then every 64 steps
            self._recount()
            self.next_count = self.step + min(self.step, 64)


def _lanes(n: int) -> tuple[int, int]:
    """(lanes, ids of a full lane)."""
    lanes = max(1, min(LANES, n // LANE_IDS))
    return lanes, -(-n // lanes)


def encode_block(ids: np.ndarray) -> bytes:
    """A block of ids (unsigned 32-bit) with its header."""
    n = len(ids)
    raw = np.ascontiguousarray(ids, "<u4")
    if not n:
        return HEAD.pack(0, zlib.crc32(b""), 0, 0, 0)
    kinds = int(raw.max()) + 1
    lanes, length = _lanes(n)
    table = np.zeros(lanes * length, np.uint32)
    table[:n] = raw
    table = np.ascontiguousarray(table.reshape(lanes, length).T)
    model, plan = Model(kinds, lanes), np.zeros((length, 4, lanes), np.int32)
    for step in range(length):
        m = -(-(n - step) // length)           # lanes that still have an id
        x = table[step, :m].astype(np.int64)
        model.look(m)
        for row, part in zip(plan[step], model.stretches(x), strict=True):
            row[:m] = part
        model.learn(x)
    state, out = np.full(lanes, LOW), []
    for step in range(length - 1, -1, -1):
        m = -(-(n - step) // length)
        width, of0, start, beyond = plan[step, :, :m]
        s, wide = state[:m], width.astype(U)
        go = np.flatnonzero(s >= wide << U(63 - BITS))
        out.append((s[go] & LOW32).astype("<u4"))
        s[go] >>= U(32)
        whole = s // wide
        left = (s - whole * wide).astype(np.int32)
        s[:] = (whole << U(BITS)) + (left + np.where(left < of0, start, beyond)).astype(U)
    words = np.concatenate(out[::-1])
    return HEAD.pack(n, zlib.crc32(raw.tobytes()), kinds, lanes, len(words)) + state.astype("<u8").tobytes() + words.tobytes()


def block_size(head: bytes) -> int:
    """Bytes that follow a block's header."""
    _, _, _, lanes, words = HEAD.unpack(head)
    return 8 * lanes + 4 * words


def decode_block(head: bytes, body: bytes) -> np.ndarray:
    """The ids of a block; ``ValueError`` if they don't have the checksum that was written."""
    n, check, kinds, lanes, count = HEAD.unpack(head)
    if not n:
        return np.empty(0, np.uint32)
    length = _lanes(n)[1]
    state = np.frombuffer(body, "<u8", lanes).astype(U)
    # a damaged block may ask for more words than it has
    words, at = np.append(np.frombuffer(body, "<u4", count, 8 * lanes), np.zeros(lanes, np.uint32)).astype(U), 0
    model, mask = Model(kinds, lanes), U((1 << BITS) - 1)
    table = np.zeros((length, lanes), np.uint32)
    for step in range(length):
        m = -(-(n - step) // length)
        model.look(m)
        s = state[:m]
        value = (s & mask).astype(np.int32)
        x = model.at(value)
        width, of0, start, beyond = model.stretches(x)
        left = value - np.where(value < model.floor, start, beyond)
        s[:] = (s >> U(BITS)) * width.astype(U) + left.astype(U)
        go = np.flatnonzero(s < LOW)
        s[go] = s[go] << U(32) | words[at:at + len(go)]
        at = min(at + len(go), count)
        table[step, :m] = x
        model.learn(x)
    ids = table.T.reshape(-1)[:n].astype("<u4", copy=False)
    if zlib.crc32(ids.tobytes()) != check:
        raise ValueError("a block's checksum doesn't fit its ids")
    return ids
