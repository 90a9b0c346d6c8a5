"""Range coder for token ids with an adaptive mixture of three predictions.

Blocks of ids are coded independently: every model starts afresh in each block
and a checksum of the ids ends its header.  The probability of an id is

    w2 [id = p2] + w1 [id = p1] + w0 P0(id)

* p2 and p1 are the ids last seen behind the two previous ids and behind the
  previous one (hashed tables with a small confidence each); their weights are
  the hit rates learnt for that confidence,
* P0 counts the ids of the block in rank classes (fine for the low ids that
  byte-pair tokenizers give to frequent tokens, coarse for high ones), spread
  evenly inside a class,
* one unit of every class is kept free, so any id can be coded.

All blocks of a call advance together, one id a step, as numpy vectors; the
arithmetic is integer, or the same float product in both directions.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"IDRC"
VERSION = 1
HEADER = struct.Struct("<4sBIII")  # magic, version, ids, crc32 of the ids, words
BLOCK = 4096
LANES = 2048
MAX_ID = 65_535

_WIDTH_LOG = np.concatenate([np.full(64, 2), np.full(64, 4), np.full(64, 6), np.full(59, 10)]).astype(np.int64)
_BASE = np.concatenate([[0], np.cumsum(1 << _WIDTH_LOG)]).astype(np.int64)
_CLASSES = len(_WIDTH_LOG)
_CLASS = np.repeat(np.arange(_CLASSES), 1 << _WIDTH_LOG).astype(np.int64)
_SLOTS = 4096
_FREE = 65_536 - _CLASSES
_SCALE = 10
_TOTAL_LOG = 16 + _SCALE
_START = np.array([6_000, 26_000, 42_000, 54_000], np.int64)
U64 = np.uint64


class _Model:
    def __init__(self, lanes: int):
        self.lane = np.arange(lanes)
        self.counts = np.ones((lanes, _CLASSES), np.int32)
        self.cum = np.zeros((lanes, _CLASSES + 1), np.int64)
        self.flat = self.cum.reshape(-1)
        self.cum_row = self.lane * (_CLASSES + 1)
        self.count_row = self.lane * _CLASSES
        self.table = [np.zeros(lanes * _SLOTS, np.int32) for _ in range(2)]
        self.rate = [np.tile(_START, lanes) for _ in range(2)]
        self.slot_row = self.lane * _SLOTS
        self.prev = np.zeros(lanes, np.int64)
        self.prev2 = np.zeros(lanes, np.int64)
        self.step = 0
        self._rebuild()

    def _rebuild(self) -> None:
        total = np.cumsum(self.counts, axis=1)
        self.cum[:, 1:] = total * (65_536.0 / total[:, -1:])
        self.cum[:, -1] = 65_536

    def predict(self) -> None:
        """The next step's predictions, weights and the bounds they share."""
        self.slot = [self.slot_row + (self.prev * 40_503 >> 3 & _SLOTS - 1),
                     self.slot_row + ((self.prev * 40_503 + self.prev2 * 30_011) >> 3 & _SLOTS - 1)]
        self.entry = [t[s].astype(np.int64) for t, s in zip(self.table, self.slot, strict=True)]
        self.guess = [e >> 2 for e in self.entry]
        self.cell = [self.lane * 4 + (e & 3) for e in self.entry]
        w2 = self.rate[1][self.cell[1]] * _FREE >> 16
        w1 = self.rate[0][self.cell[0]] * (_FREE - w2) >> 16
        self.weight = [w1, w2]
        self.w0 = _FREE - w1 - w2

    def _below(self, cls: np.ndarray) -> np.ndarray:
        """Units of the classes below ``cls`` without the guesses."""
        return cls + (self.w0 * self.flat[self.cum_row + cls] >> 16)

    def base(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cumulated frequency, frequency) of ids without the guesses."""
        cls = _CLASS[ids]
        low = self._below(cls)
        freq = (self._below(cls + 1) - low) << (_SCALE - _WIDTH_LOG[cls])
        return (low << _SCALE) + (ids - _BASE[cls]) * freq, freq

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, freq = self.base(ids)
        for guess, weight in zip(self.guess, self.weight, strict=True):
            mass = weight << _SCALE
            low = low + mass * (guess < ids)
            freq = freq + mass * (guess == ids)
        return low, freq

    def find(self, target: np.ndarray) -> np.ndarray:
        """The id whose interval holds ``target``: a guess's mass stands
        behind its base interval and folds into that interval's last unit."""
        swap = self.guess[0] > self.guess[1]
        first = np.where(swap, self.guess[1], self.guess[0]), np.where(swap, self.weight[1], self.weight[0])
        second = np.where(swap, self.guess[0], self.guess[1]), np.where(swap, self.weight[0], self.weight[1])
        for guess, weight in (first, second):
            low, freq = self.base(guess)
            over = target - (low + freq - 1)
            target = target - np.minimum(np.maximum(over, 0), weight << _SCALE)
        unit = target >> _SCALE
        cls = np.zeros(len(target), np.int64)
        jump = 128
        while jump:
            ahead = np.minimum(cls + jump, _CLASSES - 1)
            cls = np.where(self._below(ahead) <= unit, ahead, cls)
            jump >>= 1
        low = self._below(cls)
        freq = (self._below(cls + 1) - low) << (_SCALE - _WIDTH_LOG[cls])
        return _BASE[cls] + (target - (low << _SCALE)) // freq

    def update(self, ids: np.ndarray) -> None:
        for k in range(2):
            hit = self.guess[k] == ids
            rate = self.rate[k][self.cell[k]]
            self.rate[k][self.cell[k]] = rate + ((65_000 * hit - rate) >> 4)
            sure = self.entry[k] & 3
            keep = hit | (sure > 0)
            sure = np.where(hit, np.minimum(sure + 1, 3), np.maximum(sure - 1, 0))
            self.table[k][self.slot[k]] = (np.where(keep, self.guess[k], ids) << 2) + sure
        self.counts.reshape(-1)[self.count_row + _CLASS[ids]] += 24
        self.prev2, self.prev = self.prev, ids
        self.step += 1
        if self.step % 64 == 0 or self.step in (4, 8, 16, 32):
            self._rebuild()


def _carry(words: np.ndarray, used: np.ndarray, lanes: np.ndarray) -> None:
    back = 1
    while len(lanes):
        at = used[lanes] - back
        words[lanes, at] += np.uint32(1)
        lanes = lanes[words[lanes, at] == 0]
        back += 1


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """One self-contained byte string for each array of ids."""
    out: list[bytes] = []
    for lo in range(0, len(blocks), LANES):
        out += _encode(blocks[lo:lo + LANES])
    return out


def _encode(blocks: list[np.ndarray]) -> list[bytes]:
    lanes = len(blocks)
    size = np.array([len(b) for b in blocks], np.int64)
    steps = int(size.max(initial=0))
    ids = np.zeros((steps, lanes), np.int32)
    for i, b in enumerate(blocks):
        if len(b) and int(b.max()) > MAX_ID:
            raise ValueError(f"ids above {MAX_ID} have no code")
        ids[:len(b), i] = b
    words = np.zeros((lanes, steps + 4), np.uint32)
    used = np.zeros(lanes, np.int64)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, U64(2**64 - 1))
    model = _Model(lanes)
    for t in range(steps):
        model.predict()
        now = ids[t].astype(np.int64)
        start, freq = model.interval(now)
        unit = width >> U64(_TOTAL_LOG)
        add = unit * start.astype(np.uint64)
        low += add
        over = np.flatnonzero(low < add)
        if len(over):
            _carry(words, used, over)
        width = unit * freq.astype(np.uint64)
        full = np.flatnonzero(width < U64(2**32))
        if len(full):
            words[full, used[full]] = (low[full] >> U64(32)).astype(np.uint32)
            used[full] += 1
            low[full] <<= U64(32)
            width[full] <<= U64(32)
        model.update(now)
    rows = np.arange(lanes)
    for shift in (32, 0):
        words[rows, used] = (low >> U64(shift) & U64(2**32 - 1)).astype(np.uint32)
        used += 1
    return [HEADER.pack(MAGIC, VERSION, len(b), zlib.crc32(np.ascontiguousarray(b, "<u4").tobytes()), int(n))
            + words[i, :n].astype("<u4").tobytes() for i, (b, n) in enumerate(zip(blocks, used, strict=True))]


def decode_blocks(payloads: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; raises ValueError on a damaged one."""
    out: list[np.ndarray] = []
    for lo in range(0, len(payloads), LANES):
        out += _decode(payloads[lo:lo + LANES])
    return out


def _decode(payloads: list[bytes]) -> list[np.ndarray]:
    heads = []
    for p in payloads:
        if len(p) < HEADER.size:
            raise ValueError("block is cut short")
        magic, version, n, crc, n_words = HEADER.unpack_from(p)
        if magic != MAGIC or version != VERSION or len(p) != HEADER.size + 4 * n_words:
            raise ValueError("not a block of this format, or cut short")
        heads.append((n, crc, n_words))
    lanes, steps = len(payloads), max((h[0] for h in heads), default=0)
    words = np.zeros((lanes, max((h[2] for h in heads), default=0) + steps + 4), np.uint32)
    for i, (p, h) in enumerate(zip(payloads, heads, strict=True)):
        words[i, :h[2]] = np.frombuffer(p, "<u4", h[2], HEADER.size)
    value = (words[:, 0].astype(np.uint64) << U64(32)) | words[:, 1].astype(np.uint64)
    used = np.full(lanes, 2, np.int64)
    width = np.full(lanes, U64(2**64 - 1))
    ids = np.zeros((steps, lanes), np.int32)
    model = _Model(lanes)
    top = (1 << _TOTAL_LOG) - 1
    for t in range(steps):
        model.predict()
        unit = width >> U64(_TOTAL_LOG)
        target = np.minimum((value // unit).astype(np.int64), top)
        got = model.find(target)
        start, freq = model.interval(got)
        value -= unit * start.astype(np.uint64)
        width = unit * freq.astype(np.uint64)
        full = np.flatnonzero(width < U64(2**32))
        if len(full):
            value[full] = (value[full] << U64(32)) | words[full, used[full]].astype(np.uint64)
            used[full] += 1
            width[full] <<= U64(32)
        ids[t] = got
        model.update(got)
    out = []
    for i, (n, crc, _) in enumerate(heads):
        block = ids[:n, i].astype(np.uint32)
        if zlib.crc32(block.astype("<u4").tobytes()) != crc:
            raise ValueError("block fails its checksum")
        out.append(block)
    return out
