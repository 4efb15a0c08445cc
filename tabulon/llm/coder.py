"""An adaptive range coder for token ids, in independent checksummed blocks.

Every id is predicted by three models and coded by one step of a carry-less range
coder. Order 2 (the last two ids) and order 1 (the last id) each name the id they
saw last in that context, with a confidence; order 0 is the frequency of every id
so far. The shares of the interval that the three get are mixed by what they
achieved so far at the same pair of confidences.

A block is cut into lanes of equal length that advance together, one id of each
lane per step, so that every step is a few numpy operations over all lanes. The
lanes share the models, which learn between steps, and each has a coder of its
own. The models start anew in each block: a block can be read without any other.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

#: Fixed layout: mark, ids, documents, lanes, ids of the alphabet, CRC-32 of all that follows.
HEADER = struct.Struct("<4sIIIII")
MARK = b"TRC1"

LANES, LANE_IDS = 8192, 128
BITS = 24
TOTAL = np.uint64(1 << BITS)
SHIFT = np.uint64(BITS)
TOP, LEAST = np.uint64(1 << 48), np.uint64(1 << 40)
WORD_BITS, HIGH = np.uint64(16), np.uint64(48)
ONE = np.uint64(1)
LEVELS = 16  # of confidence
ORDER_0_SHARE = TOTAL >> np.uint64(4)  # order 0 keeps at least this much of the interval
LEAST_WIDTH = 16  # so that an id keeps a width within that share
SLOT_BITS = 18
REBUILD = 16
FIND_BITS = 7  # values of order 0 that share an entry of the table where a search begins


#: Confidence after a wrong prediction (halved; 1 for the id that takes the place of a doubtful one) and after a right one.
_NEXT_TRUST = np.array([max(1, t >> 1) for t in range(LEVELS)] + [min(t + 1, LEVELS - 1) for t in range(LEVELS)], np.uint8)


class _Models:
    """The state that encoder and decoder bring forward in the same way."""

    def __init__(self, alphabet: int, lanes: int):
        self.alphabet = alphabet
        self.counts = np.ones(alphabet, np.int64)
        self.fresh: list[np.ndarray] = []
        self.named = [np.full(alphabet + 1, alphabet, np.int32), np.full(1 << SLOT_BITS, alphabet, np.int32)]
        self.trust = [np.zeros(len(x), np.uint8) for x in self.named]
        self.outcomes = np.zeros((2 * LEVELS * LEVELS, 3), np.int64)  # neither, order 2, only order 1 was right
        self.last = np.full(lanes, alphabet, np.int64)
        self.before = self.last.copy()
        self.step = 0
        self._rebuild()

    def _rebuild(self) -> None:
        if self.fresh:
            self.counts += 32 * np.bincount(np.concatenate(self.fresh), minlength=self.alphabet)
        self.fresh = []
        reached = np.concatenate([[0], np.cumsum(self.counts)])
        free = int(TOTAL) - LEAST_WIDTH * self.alphabet
        self.starts = None
        self.cumulated = (reached * free // reached[-1] + LEAST_WIDTH * np.arange(self.alphabet + 1)).astype(np.uint64)

    def find(self, value: np.ndarray) -> np.ndarray:
        """The id of order 0 whose part of the interval holds each value."""
        if self.starts is None:
            entries = 1 << BITS - FIND_BITS
            first = (self.cumulated + np.uint64((1 << FIND_BITS) - 1)) >> np.uint64(FIND_BITS)  # entry that begins there or later
            self.starts = np.cumsum(np.bincount(first.astype(np.intp), minlength=entries + 1)[:entries]) - 1
        found = self.starts.take((value >> np.uint64(FIND_BITS)).astype(np.intp))
        late = np.flatnonzero(self.cumulated[found + 1] <= value)
        while len(late):
            found[late] += 1
            late = late[self.cumulated[found[late] + 1] <= value[late]]
        return found

    def predict(self, lanes: int) -> None:
        """For the first ``lanes`` lanes: the ids named by order 1 and 2, and their shares."""
        last, before = self.last[:lanes], self.before[:lanes]
        slot = before * 0x9E3779B1
        slot += last * 0x85EBCA77
        slot >>= 7
        slot &= (1 << SLOT_BITS) - 1
        self.slots = (last, slot)
        self.id1, self.id2 = self.named[0].take(last), self.named[1].take(slot)
        self.trust1, self.trust2 = self.trust[0].take(last), self.trust[1].take(slot)
        confidence = self.trust2 * np.uint8(LEVELS)  # up to 255 with the next line
        confidence += self.trust1
        state = (self.id1 == self.id2).astype(np.intp)
        state *= LEVELS * LEVELS
        state += confidence
        self.state = state
        free = int(TOTAL - ORDER_0_SHARE)
        part = 2 * self.outcomes.sum(1) + 3
        shares = ((2 * self.outcomes[:, 1:] + 1) * free // part[:, None]).astype(np.uint64)
        self.share2, self.both = shares[:, 0].take(state), shares.sum(1).take(state)
        self.rest = TOTAL - self.both
        self.shares_left = bool(shares.all())  # no share was rounded down to nothing

    def learn(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """``hit1``: order 1 was right and order 2 was not."""
        outcome = self.state * 3
        outcome += hit2
        outcome += hit1 * np.uint8(2)
        self.outcomes += np.bincount(outcome, minlength=self.outcomes.size).reshape(self.outcomes.shape)
        for k, (name, trust) in enumerate(((self.id1, self.trust1), (self.id2, self.trust2))):
            right = name == ids
            # Of lanes in the same context the last one counts, in both directions.
            self.named[k][self.slots[k]] = np.where(right | (trust >= 2), name, ids)
            self.trust[k][self.slots[k]] = _NEXT_TRUST.take(right * np.uint8(LEVELS) + trust)
        lanes = len(ids)
        self.before[:lanes] = self.last[:lanes]
        self.last[:lanes] = ids
        self.fresh.append(ids)
        self.step += 1
        if self.step % REBUILD == 0 or self.step in (1, 2, 4, 8):
            self._rebuild()


def _lanes_of(n: int) -> tuple[int, int]:
    """Number of lanes and ids per lane; the last lane may be shorter."""
    lanes = max(1, min(LANES, n // LANE_IDS))
    length = -(-n // lanes) if n else 0
    return (-(-n // length) if n else 0), length


def _narrow(low: np.ndarray, size: np.ndarray, start: np.ndarray, width: np.ndarray) -> None:
    size >>= SHIFT
    low += start * size
    size *= width


def _full(low: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The lanes that have a word to give, and their ``low``, again and again until none has.

    A lane gives its top word when that can change no more, or when the interval is
    so narrow that it has to be cut where the top word would change. The caller
    moves the word while the lane still has its old ``low``.
    """
    at, lo, sz = None, low, size
    while True:
        same = lo + sz
        same ^= lo
        same = same < TOP
        some = np.flatnonzero(same | (sz < LEAST))
        if not len(some):
            return
        at, lo, sz = some if at is None else at[some], lo[some], sz[some]
        yield at, lo
        cut = np.flatnonzero(~same[some])
        if len(cut):
            sz[cut] = (~lo[cut] + ONE) & (LEAST - ONE)
        lo <<= WORD_BITS
        sz <<= WORD_BITS
        low[at], size[at] = lo, sz


def encode_ids(ids: np.ndarray, alphabet: int) -> tuple[np.ndarray, np.ndarray]:
    """The 16-bit words of all lanes one after the other, and each lane's number of words."""
    lanes, length = _lanes_of(len(ids))
    if not lanes:
        return np.empty(0, "<u2"), np.empty(0, "<u4")
    padded = np.zeros(lanes * length, np.int32)
    padded[: len(ids)] = ids
    steps = np.ascontiguousarray(padded.reshape(lanes, length).T)
    models = _Models(alphabet, lanes)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, ~np.uint64(0))
    words = np.zeros((lanes, 2 * length + 8), "<u2")
    used = np.zeros(lanes, np.int64)
    last_lane = len(ids) - (lanes - 1) * length
    for t in range(length):
        active = lanes if t < last_lane else lanes - 1
        x, lo, sz = steps[t, :active], low[:active], size[:active]
        place = x.astype(np.intp)
        models.predict(active)
        hit2, hit1 = models.id2 == x, models.id1 == x
        if not models.shares_left:
            hit2 &= models.share2 > 0
            hit1 &= models.both > models.share2
        hit1 &= ~hit2
        start = models.cumulated.take(place)
        start *= models.rest
        start >>= SHIFT
        width = models.cumulated[1:].take(place)
        width *= models.rest
        width >>= SHIFT
        width -= start
        start += models.both
        start = np.where(hit1, models.share2, start)
        start[hit2] = 0
        width = np.where(hit1, models.both - models.share2, width)
        width = np.where(hit2, models.share2, width)
        _narrow(lo, sz, start, width)
        for out, top in _full(lo, sz):
            at = used[out]
            if at.max() >= words.shape[1] - 4:
                words = np.pad(words, ((0, 0), (0, words.shape[1])))
            words[out, at] = top >> HIGH
            used[out] = at + 1
        models.learn(x, hit2, hit1)
    ending = low + np.uint64((1 << 32) - 1)  # two words that lie within what is left
    for k in (48, 32):
        words[np.arange(lanes), used] = (ending >> np.uint64(k)) & np.uint64(0xFFFF)
        used += 1
    kept = np.arange(words.shape[1]) < used[:, None]
    return words[kept], used.astype("<u4")


def decode_ids(words: np.ndarray, used: np.ndarray, n: int, alphabet: int) -> np.ndarray:
    """The ``n`` ids that :func:`encode_ids` was given."""
    lanes, length = _lanes_of(n)
    if not lanes:
        return np.empty(0, np.uint32)
    models = _Models(alphabet, lanes)
    stream = np.zeros((lanes, int(used.max()) + 8), np.uint16)
    stream[np.arange(stream.shape[1]) < used[:, None].astype(np.int64)] = words
    code = np.zeros(lanes, np.uint64)
    for k in range(4):
        code = code << WORD_BITS | stream[:, k].astype(np.uint64)
    place = np.full(lanes, 4)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, ~np.uint64(0))
    steps = np.zeros((length, lanes), np.int32)
    last_lane = n - (lanes - 1) * length
    for t in range(length):
        active = lanes if t < last_lane else lanes - 1
        lo, sz, cd = low[:active], size[:active], code[:active]
        models.predict(active)
        value = np.minimum((cd - lo) // (sz >> SHIFT), TOTAL - ONE)
        hit2 = value < models.share2
        named = value < models.both
        hit1 = named & ~hit2
        x = np.where(hit2, models.id2, models.id1)
        start, width = np.where(hit2, np.uint64(0), models.share2), np.where(hit2, models.share2, models.both - models.share2)
        other = np.flatnonzero(~named)
        if len(other):
            rest, both = models.rest[other], models.both[other]
            inside = value[other] - both + ONE
            found = models.find((inside * TOTAL - ONE) // rest)
            x[other] = found
            begin = models.cumulated.take(found) * rest >> SHIFT
            width[other] = (models.cumulated[1:].take(found) * rest >> SHIFT) - begin
            start[other] = begin + both
        _narrow(lo, sz, start, width)
        for out, _ in _full(lo, sz):
            at = place[out]
            cd[out] = cd[out] << WORD_BITS | stream[out, np.minimum(at, stream.shape[1] - 1)].astype(np.uint64)
            place[out] = at + 1
        steps[t, :active] = x
        models.learn(x, hit2, hit1)
    return steps.T.reshape(-1)[:n].astype(np.uint32)


def write_block(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One block: header, document ids (with a mark for null), counts, lane lengths, words."""
    alphabet = int(ids.max()) + 1 if len(ids) else 1
    words, used = encode_ids(ids, alphabet)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    table = zlib.compress(known.tobytes() + numbers.tobytes() + counts.astype("<u4").tobytes() + used.tobytes(), 1)
    body = struct.pack("<I", len(table)) + table + words.tobytes()
    return HEADER.pack(MARK, len(ids), len(doc_ids), len(used), alphabet, zlib.crc32(body)) + body


def read_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, counts and ids of a block; ValueError if the block is damaged."""
    mark, n, docs, lanes, alphabet, crc = HEADER.unpack_from(block)
    body = memoryview(block)[HEADER.size :]
    if mark != MARK or zlib.crc32(body) != crc:
        raise ValueError("damaged block")
    (size,) = struct.unpack_from("<I", body)
    table = zlib.decompress(body[4 : 4 + size])
    known = np.frombuffer(table, np.uint8, docs)
    numbers = np.frombuffer(table, "<i8", docs, docs)
    counts = np.frombuffer(table, "<u4", docs, 9 * docs).astype(np.int64)
    used = np.frombuffer(table, "<u4", lanes, 13 * docs)
    ids = decode_ids(np.frombuffer(body[4 + size :], "<u2"), used, n, alphabet)
    return [int(d) if k else None for d, k in zip(numbers, known)], counts, ids
