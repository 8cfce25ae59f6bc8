"""Token ids in compact files: an adaptive context-mixing range coder.

A block of ids is cut into lanes (equal stretches of the block). All lanes are
coded in step, one id of each at a time, with numpy over the lanes; they share
one adaptive model, which both coder and decoder update after every step with
the ids just seen, and each lane has its own range coder. Per id:

- the order-2 context (two ids before, hashed) and the order-1 context (the id
  before) each name the id they last saw follow, with a confidence;
- for either candidate the order-2, order-1 and order-0 predictions of "it is
  this id" are mixed in the logistic domain with learned weights;
- the range coder gives the order-2 candidate, then the order-1 candidate, their
  mixed probabilities, and every other id its adaptive order-0 share of the rest.

All model arithmetic is in integers, so every machine decodes alike. Blocks are
independent: the model starts anew in each, and each carries its own index of
documents, lane lengths, and checksums of ids and payload; damage to one leaves
the others readable, and a retried task writes the same bytes.

File format (little-endian). A file is a table of blocks in order; a block is
``magic "HCM1", u64 ids, u32 lanes, u32 alphabet, u32 documents, u32 crc32 of
the ids as u32, u32 crc32 of everything after this header``, then
u8[documents] (1: the doc_id is null), i64[documents] doc_ids,
u32[documents] lengths, u32[lanes] bytes per lane, then the lanes' bytes.

Cases: null or empty text is the end id alone; documents are ordered by doc_id
(nulls first), repeated ids by their place in the input; a document is never
split, so a very long one makes its block longer; an empty table gives no blocks
and no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from .common import small_batches, texts, with_package, written

MAGIC = b"HCM1"
HEAD = struct.Struct("<4sQIIIII")
LANES = 8192
BLOCK_IDS = 1 << 22
ORDER2_BITS = 18
U64 = np.uint64
TOP, BOT = U64(1 << 56), U64(1 << 48)           # a range is 2^48 or more before each id
ALL = (1 << 64) - 1
ID_BITS, ALL_BITS = U64(24), U64(40)            # order-0 shares; an id's share of the range
FLAG_TOTAL, ID_TOTAL = 1 << 16, 1 << 24
LEVELS = 16                                     # confidence levels
#: A slot's level after a miss (first half) and a hit; with the bits above set where its candidate stays.
RULE = np.r_[np.arange(LEVELS) >> 1, np.minimum(np.arange(LEVELS) + 1, LEVELS - 1)].astype(np.int32) | -LEVELS
RULE[:2] = 1
FIND_BITS = 8                                   # of an order-0 share that the decoder's first look leaves out
HASH1, HASH2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
HASH_SHIFT = U64(64 - ORDER2_BITS)


#: Bytes by kind: what parts chunks, what may follow a letter's chunk, and ASCII letters; the second bytes of the two-byte
#: letters (U+00C0 to U+00FF) that marks may follow, too.
SPACES, MARKS = b"\t\n\v\f\r ", b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
SPACE, MARK, LETTER = 1, 2, 3
KINDS = bytes(SPACE if c in SPACES else MARK if c in MARKS else LETTER * bytes([c]).isalpha() for c in range(256))
LATIN = np.isin(np.arange(256), [chr(c).encode()[1] for c in range(0xC0, 0x100) if chr(c).isalpha()])
#: Words (and spaces between them) that the normalizer leaves as they are and the pre-tokenizer leaves whole, and the letters
#: that it writes for bytes in place of their own.
PLAIN = re.compile("[a-z\xdf-\xf6\xf8-\xff ]+")
BYTE_LETTERS = dict(zip([*range(33), *range(127, 161), 173], map(chr, range(256, 512))))
del BYTE_LETTERS[ord(" ")]                      # parts words
#: Bytes of the texts whose chunks are looked up at a time, about.
PIECE_BYTES = 8 << 20


class BlockError(ValueError):
    """A block is damaged."""


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """squash: 1/256 nats -> 12-bit probability, at index nats + REACH, for any
    sum that the bounded weights can give; stretch: its inverse."""
    half = np.array([round(4096 / (1 + math.exp(-x / 256))) for x in range(-2047, 2048)])
    half = np.clip(half, 1, 4095).astype(np.int32)
    stretch = (np.searchsorted(half, np.arange(4096)) - 2047).clip(-2047, 2047).astype(np.int32)
    return half[np.clip(np.arange(-REACH, REACH + 1), -2047, 2047) + 2047], stretch


WEIGHT_MOST = 1 << 18                           # 1/65536
REACH = 3 * 2048 * (WEIGHT_MOST >> 16)
SQUASH, STRETCH = _tables()


def _hashes(n: int, seed: int) -> np.ndarray:
    """A fixed 64-bit hash of each id (an odd multiple, mixed once)."""
    x = (np.arange(n, dtype=U64) + U64(1)) * U64(seed)
    return (x ^ x >> U64(29)) * U64(0x9E3779B97F4A7C15)


def _mask(flags: np.ndarray) -> np.ndarray:
    """All bits where a flag is set, else none."""
    return (-flags.view(np.int8)).astype(np.int32)


def _turned(table: np.ndarray) -> np.ndarray:
    """The table's columns as rows, a few of its rows at a time (in cache)."""
    out = np.empty(table.shape[::-1], table.dtype)
    for i in range(0, len(table), 64):
        out[:, i:i + 64] = table[i:i + 64].T
    return out


class _Model:
    """What coder and decoder know before each step. Tables by context change
    after every step; weights, confidence rates and order-0 frequencies after
    every step at first and then after every eighth or sixteenth. Lanes are
    chosen by masks: np.where is slow where flags follow no pattern. All sums of weighted predictions fit 32 bits."""

    def __init__(self, alphabet: int) -> None:
        self.alphabet = alphabet
        self.slot2 = np.zeros(1 << ORDER2_BITS, np.int32)   # candidate << 4 | confidence
        self.slot1 = np.zeros(alphabet + 1, np.int32)
        self.hash1, self.hash2 = _hashes(alphabet + 1, HASH1), _hashes(alphabet + 1, HASH2)
        self.count = np.zeros(alphabet, np.int64)
        self.fresh_ids: list[np.ndarray] = []
        self.hits = np.ones((3, LEVELS), np.int64)          # order-2, order-1 beside it, order-1 alone
        self.tries = np.full((3, LEVELS), 4, np.int64)
        # 1/65536; order-2, order-1, order-0 where both candidates agree, where they differ, for the second
        self.w = [[30000, 20000, 6000], [30000, 0, 6000], [50000, 0, 6000]]
        self.steps = 0
        self.learn = True
        self._rates()
        self._frequencies()

    def _rates(self) -> None:
        """Predictions by confidence, and the weighted sums of them that depend on confidences alone."""
        self.rate = STRETCH[np.clip(self.hits * 4096 // self.tries, 1, 4095)]
        (s2, s1, s0), (d2, _, d0), (b1, _, b0) = self.w
        two, one, alone = self.rate
        differ = np.repeat(two * d2, LEVELS)
        self.mix = np.r_[differ, (two[:, None] * s2 + one * s1).ravel()].astype(np.int32)   # same, level 2, level 1
        self.second = (alone * b1).astype(np.int32)
        self.w_differ, self.w_more, self.w_second = np.int32(d0), np.int32(s0 - d0), np.int32(b0)     # of order-0

    def _frequencies(self) -> None:
        """Order-0 frequencies from the ids so far."""
        if self.fresh_ids:
            self.count += np.bincount(np.concatenate(self.fresh_ids), minlength=self.alphabet)
            self.fresh_ids.clear()
        spare = ID_TOTAL - self.alphabet
        total = int(self.count.sum())
        freq = 1 + self.count * spare // total if total else np.full(self.alphabet, ID_TOTAL // self.alphabet)
        freq[0] += ID_TOTAL - int(freq.sum())
        self.freq = freq.astype(np.int32)
        self.cum = np.zeros(self.alphabet + 1, np.int32)    # up to 2^24
        np.cumsum(self.freq, out=self.cum[1:])
        self.first: np.ndarray | None = None                # of ``find``
        self.odds = STRETCH[np.clip(freq >> 12, 1, 4095)]   # order-0 prediction of each id

    def predict(self, c1: np.ndarray, c2: np.ndarray) -> None:
        """Candidates and their code shares for contexts (c2, c1)."""
        self.h = (self.hash1.take(c1) + self.hash2.take(c2) >> HASH_SHIFT).view(np.int64)
        self.c1 = c1
        self.old2, self.old1 = slot2, slot1 = self.slot2.take(self.h), self.slot1.take(c1)
        self.a, self.b = slot2 >> 4, slot1 >> 4
        self.la, self.lb = slot2 & 15, slot1 & 15
        self.same = self.a == self.b
        same = _mask(self.same)
        self.xa0, self.xb0 = self.odds.take(self.a), self.odds.take(self.b)
        mixed = self.mix.take(same & LEVELS * LEVELS | self.la << 4 | self.lb)
        mixed += self.xa0 * ((same & self.w_more) + self.w_differ)
        self.pa = SQUASH.take((mixed >> 16) + REACH)
        self.pb = SQUASH.take((self.second.take(self.lb) + self.xb0 * self.w_second >> 16) + REACH)
        self.fa = self.pa << 4
        rest = FLAG_TOTAL - self.fa
        self.fb = np.maximum(rest * self.pb >> 12, 1) & ~same
        self.rest = rest - self.fb                          # an id that is no candidate has its part of this

    def flags(self, is_a: np.ndarray, is_b: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size, of 2^16, of the first candidate's share, the second's or what both leave (by masks)."""
        begin = (self.fa & ~is_a) + (self.fb & other)
        part = (self.fa & is_a) + (self.fb & is_b) + (self.rest & other)
        return begin.astype(U64), part.astype(U64)

    def shares(self, at: np.ndarray, begin: np.ndarray, part: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size, of 2^40, of the ids' shares, which are order-0 parts where no candidate is meant."""
        start = (begin << ID_BITS) + part * (self.cum.take(at) & other).astype(U64)
        return start, part * ((self.freq.take(at) - ID_TOTAL & other) + ID_TOTAL).astype(U64)

    def find(self, own: np.ndarray) -> np.ndarray:
        """The ids whose order-0 shares hold ``own``: by the first bits of it, then by halving."""
        if self.first is None:
            ahead = -(-self.cum.astype(np.int64) >> FIND_BITS)
            self.first = np.append(np.repeat(np.arange(self.alphabet, dtype=np.int32), np.diff(ahead)),
                                   np.int32(self.alphabet - 1))
        at = own >> FIND_BITS
        y = self.first.take(at)
        most = self.first.take(at + 1) - y
        open_ = np.flatnonzero(most)
        if len(open_):
            own, lo = own[open_], y[open_]
            for k in reversed(range(int(most.max()).bit_length())):
                lo += (self.cum.take(lo + (1 << k), mode="clip") <= own) * np.int32(1 << k)     # its last is above all
            y[open_] = lo
        return y

    def update(self, ids: np.ndarray, ids64: np.ndarray, hit_a: np.ndarray, hit_b: np.ndarray) -> None:
        """Learn the ids of this step (as int32, and as int64 for places); masks of
        whether they are the first and the second candidate."""
        own = ids << 4
        for slots, at, hit, old, level in ((self.slot2, self.h, hit_a, self.old2, self.la),
                                           (self.slot1, self.c1, hit_b, self.old1, self.lb)):
            rule = RULE.take(hit & LEVELS | level)
            slots[at] = own ^ (own ^ old) & (rule & -LEVELS) | rule & 15
        self.fresh_ids.append(ids64)
        if self.learn:
            self._learn(hit_a < 0, hit_b < 0)
        self.steps += 1
        self.learn = self.steps < 32 or self.steps % 8 == 0
        if self.steps & (self.steps - 1) == 0 or self.steps % 16 == 0:
            self._frequencies()

    def _learn(self, hit_a: np.ndarray, hit_b: np.ndarray) -> None:
        n, same = len(hit_a), self.same
        rest = ~hit_a & ~same
        xa2, xa1, xb = (rate.take(level) for rate, level in zip(self.rate, (self.la, self.lb, self.lb)))
        xa0, xb0 = self.xa0, self.xb0
        err = (hit_a.astype(np.int32) << 12) - self.pa
        err_b = ((hit_b.astype(np.int32) << 12) - self.pb) * rest
        for row, e, inputs in ((0, err * same, (xa2, xa1, xa0)), (1, err * ~same, (xa2, None, xa0)), (2, err_b, (xb, None, xb0))):
            e = e.astype(np.int64)
            for k, x in enumerate(inputs):
                if x is not None:
                    new = self.w[row][k] + int((e * x).sum()) // (n * 256)
                    self.w[row][k] = max(-WEIGHT_MOST, min(WEIGHT_MOST, new))
        for row, level, hit, mask in ((0, self.la, hit_a, True), (1, self.lb, hit_a, same), (2, self.lb, hit_b, rest)):
            case = level + hit * np.int32(LEVELS) + mask * np.int32(2 * LEVELS)
            misses, hits = np.bincount(case, minlength=4 * LEVELS)[2 * LEVELS:].reshape(2, LEVELS)
            self.tries[row] += misses + hits
            self.hits[row] += hits
        self._rates()


def _lanes(n: int) -> tuple[int, int]:
    """(lanes, steps) for n ids."""
    lanes = max(1, min(LANES, n // 256))
    steps = -(-n // lanes)
    return -(-n // steps), steps


class _Lanes:
    """Where the range coders of all lanes stand. A step settles the bytes on
    which both ends of a lane's range agree: up to four at once for all lanes,
    the rest, and ranges that got too small, lane by lane and byte by byte. Bytes pass a lane's
    buffer and come and go in words of four, big-endian, one row of words for
    all lanes."""

    def __init__(self, lanes: int, table: np.ndarray) -> None:
        self.low, self.rng = np.zeros(lanes, U64), np.full(lanes, (1 << 64) - 1, U64)
        self.words = table.reshape(-1)                      # u32, row by row
        self.row = np.arange(lanes)                         # of each lane's next word
        self.lanes = lanes
        self.buffer, self.held = np.zeros(lanes, U64), np.zeros(lanes, np.uint8)    # its last bytes count

    def narrow(self, start: np.ndarray, size: np.ndarray, r: np.ndarray) -> None:
        """Take the share ``start``, ``size`` of the first lanes' ranges (``r``: of their 2^-40)."""
        n = len(r)
        lo = self.low[:n] + start * r
        r = size * r
        apart = lo ^ (lo + r)
        # whole leading zero bytes, four at most, from the exponent of the first 53 bits
        bits = np.minimum(1075 - ((apart >> U64(11)).astype(float).view(np.int64) >> 52), 32) & 56
        k, bits = (bits >> 3).astype(np.uint8), bits.view(U64)
        self.move(n, lo, k, bits)
        lo <<= bits
        r <<= bits
        self.low[:n], self.rng[:n] = lo, r
        apart <<= bits
        for i in np.flatnonzero((r < BOT) | (apart < TOP)).tolist():     # few, so plain numbers are faster
            self.settle(i)

    def settle(self, i: int) -> None:
        """The rest of lane ``i``."""
        lo, r = int(self.low[i]), int(self.rng[i])
        while (ready := (lo ^ (lo + r & ALL)) < 1 << 56) or r < 1 << 48:
            r = r if ready else -lo & (1 << 48) - 1
            self.move_byte(i, lo >> 56)
            lo, r = lo << 8 & ALL, r << 8 & ALL
        self.low[i], self.rng[i] = lo, r


class _Writer(_Lanes):
    def __init__(self, lanes: int, steps: int) -> None:
        super().__init__(lanes, np.empty((6 * steps // 4 + 8, lanes), np.uint32))

    def move(self, n: int, lo: np.ndarray, k: np.ndarray, bits: np.ndarray) -> None:
        """Put out the top ``k`` bytes (``bits``) of ``lo`` of the first ``n`` lanes."""
        held = self.held[:n] + k
        self.buffer[:n] = buffer = self.buffer[:n] << bits | lo >> U64(64) - bits
        self.held[:n] = held & 3
        full = np.flatnonzero(held > 3)
        row = self.row[full]
        self.words[row] = (buffer[full] >> ((held[full] & 3) << 3).astype(U64)).astype(np.uint32)
        self.row[full] = row + self.lanes

    def move_byte(self, i: int, byte: int) -> None:
        held, buffer = int(self.held[i]) + 1, int(self.buffer[i]) << 8 & ALL | byte
        if held == 4:
            self.words[self.row[i]] = buffer & (1 << 32) - 1
            self.row[i] += self.lanes
        self.held[i], self.buffer[i] = held & 3, buffer

    def end(self) -> tuple[np.ndarray, np.ndarray]:
        """(bytes per lane, their bytes), with the whole of low behind."""
        low = self.low
        for _ in range(2):
            self.move(self.lanes, low, np.full(self.lanes, 4, np.uint8), np.full(self.lanes, 32, U64))
            low = low << U64(32)
        n = 4 * (self.row // self.lanes) + self.held
        self.words[self.row] = (self.buffer << ((4 - self.held) << 3).astype(U64)).astype(np.uint32)
        table = self.words.reshape(-1, self.lanes)[:-(-int(n.max()) // 4)]
        out = _turned(table).astype(">u4").view(np.uint8).reshape(self.lanes, -1)
        return n.astype("<u4"), out[np.arange(out.shape[1]) < n[:, None]]


class _Reader(_Lanes):
    def __init__(self, sizes: np.ndarray, payload: np.ndarray) -> None:
        lanes = len(sizes)
        rows = -(-int(sizes.max()) // 4) + 4                # zeros behind every lane's bytes
        out = np.zeros((lanes, 4 * rows), np.uint8)
        out[np.arange(4 * rows) < sizes[:, None]] = payload
        super().__init__(lanes, _turned(out.view(">u4").astype(np.uint32)))
        self.rows, self.sizes = rows, sizes.astype(np.int64)
        self.code = self.words[:lanes].astype(U64) << U64(32) | self.words[lanes:2 * lanes]
        self.row += 2 * lanes

    def move(self, n: int, lo: np.ndarray, k: np.ndarray, bits: np.ndarray) -> None:
        """Take the next ``k`` bytes (``bits``) of the first ``n`` lanes."""
        held, buffer = self.held[:n], self.buffer[:n]
        few = np.flatnonzero(held < 4)
        row = self.row[few]
        buffer[few] = buffer[few] << U64(32) | self.words.take(row, mode="clip")
        held[few] += 4
        self.row[few] = row + self.lanes
        held -= k
        self.code[:n] = self.code[:n] << bits | buffer >> (held << 3).astype(U64) & (U64(1) << bits) - U64(1)

    def move_byte(self, i: int, byte: int) -> None:
        held, buffer = int(self.held[i]), int(self.buffer[i])
        if held < 4:
            buffer = buffer << 32 & ALL | int(self.words[min(self.row[i], len(self.words) - 1)])
            self.row[i] += self.lanes
            held += 4
        self.held[i], self.buffer[i] = held - 1, buffer
        self.code[i] = int(self.code[i]) << 8 & ALL | buffer >> 8 * (held - 1) & 255

    def check(self) -> None:
        if (4 * (self.row // self.lanes) - self.held > self.sizes + 8).any():
            raise BlockError("lane overrun")


def encode_ids(ids: np.ndarray, alphabet: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes per lane, their bytes) of non-empty ids below ``alphabet``."""
    n = len(ids)
    lanes, steps = _lanes(n)
    flat = np.zeros(lanes * steps, np.int32)
    flat[:n] = ids
    grid = _turned(flat.reshape(lanes, steps))
    model = _Model(alphabet)
    out = _Writer(lanes, steps)
    c1 = np.full(lanes, alphabet, np.int64)
    c2 = c1.copy()
    for s in range(steps):
        act = (n - 1 - s) // steps + 1
        x = grid[s, :act]
        model.predict(c1[:act], c2[:act])
        hit_a, hit_b = _mask(x == model.a), _mask(x == model.b)     # where both are, the second's share is empty
        other = ~(hit_a | hit_b)
        at = x.astype(np.int64)
        out.narrow(*model.shares(at, *model.flags(hit_a, hit_b, other), other), out.rng[:act] >> ALL_BITS)
        model.update(x, at, hit_a, hit_b)
        c2, c1 = c1, at if act == lanes else np.concatenate([at, c1[act:]])
    return out.end()


def decode_ids(n: int, lanes: int, alphabet: int, words: np.ndarray, payload: np.ndarray) -> np.ndarray:
    if (lanes, -(-n // lanes)) != _lanes(n) or words.sum() != len(payload):
        raise BlockError("lane layout")
    steps = -(-n // lanes)
    if words.max() > 6 * steps + 16:
        raise BlockError("lane layout")
    lane = _Reader(words, payload)
    model = _Model(alphabet)
    grid = np.zeros((steps, lanes), np.int32)
    c1 = np.full(lanes, alphabet, np.int64)
    c2 = c1.copy()
    for s in range(steps):
        act = (n - 1 - s) // steps + 1
        model.predict(c1[:act], c2[:act])
        r = lane.rng[:act] >> ALL_BITS
        value = np.minimum((lane.code[:act] - lane.low[:act]) // r, U64((FLAG_TOTAL << 24) - 1))
        flag = (value >> ID_BITS).astype(np.int32)
        is_a, in_b = _mask(flag < model.fa), _mask(flag < model.fa + model.fb)
        is_b, other = in_b ^ is_a, ~in_b
        begin, part = model.flags(is_a, is_b, other)
        own = ((value - (begin << ID_BITS)).astype(float) / part).astype(np.int32)      # exact: 40 bits by 16
        x = (model.a & is_a) + (model.b & is_b) + (model.find(own) & other)
        at = x.astype(np.int64)
        lane.narrow(*model.shares(at, begin, part, other), r)
        grid[s, :act] = x
        model.update(x, at, _mask(x == model.a), _mask(x == model.b))
        c2, c1 = c1, at if act == lanes else np.concatenate([at, c1[act:]])
    lane.check()
    return _turned(grid).reshape(-1)[:n]


def write_block(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, alphabet: int) -> bytes:
    """A block of whole documents; ``ids`` is their ids end to end."""
    words, payload = encode_ids(ids, alphabet)
    null = np.array([d is None for d in doc_ids], np.uint8)
    own = np.array([d or 0 for d in doc_ids], "<i8")
    body = b"".join(x.tobytes() for x in (null, own, lengths.astype("<u4"), words, payload))
    return HEAD.pack(MAGIC, len(ids), len(words), alphabet, len(doc_ids), zlib.crc32(ids.astype("<u4").tobytes()),
                     zlib.crc32(body)) + body


def read_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc_ids, lengths, ids); BlockError if anything disagrees."""
    if len(block) < HEAD.size:
        raise BlockError("short block")
    magic, n, lanes, alphabet, docs, ids_crc, body_crc = HEAD.unpack_from(block)
    body = block[HEAD.size:]
    if magic != MAGIC or zlib.crc32(body) != body_crc:
        raise BlockError("checksum of the block")
    at = 0

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        x = np.frombuffer(body, kind, count, at)
        at += x.nbytes
        return x
    null, own, lengths, words = take("u1", docs), take("<i8", docs), take("<u4", docs), take("<u4", lanes)
    ids = decode_ids(n, lanes, alphabet, words, np.frombuffer(body, "u1", offset=at))
    if zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc or int(lengths.sum()) != n:
        raise BlockError("checksum of the ids")
    return [None if z else int(d) for z, d in zip(null, own)], lengths, ids


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of true flags begin and end; the last flag is false."""
    turn = np.flatnonzero(flags[1:] != flags[:-1]) + 1
    turn = np.r_[0, turn] if flags[0] else turn
    return turn[::2], turn[1::2]


class WordEncoder:
    """The tokenizer library behind a memory of white-space-free chunks: the
    pre-tokenizer never joins across white space, so the ids of a text are
    those of its chunks end to end. A chunk that ends in a letter and ASCII
    marks (no apostrophe) is cut before the marks: they are pre-tokens of their
    own. Chunks of letters alone are one pre-token each, whose last id carries
    the word-end mark; many of them go to the library as one text and are told
    apart by that mark. The memory numbers the chunks; their ids lie end to end."""

    WORD_END = "</w>"

    def __init__(self, path: str, entries: int = 1_300_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = WhitespaceSplit()
        self.alphabet = self.tokenizer.get_vocab_size()
        self.is_end = np.zeros(self.alphabet, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.is_end[i] = token.endswith(self.WORD_END)
        self.entries = entries
        self.cache: dict[bytes, int] = {}
        self.ids, self.ends = np.empty(1 << 16, "<u4"), np.zeros(1 << 16, np.int64)   # chunk k: from ends[k] to ends[k + 1]

    def _library(self, texts_: list[str]) -> list[np.ndarray]:
        """Ids of each text. Plain words need the tokenizer's model alone."""
        encode = self.tokenizer.encode_batch_fast
        if all(map(PLAIN.fullmatch, texts_)):
            encode = self.plain.encode_batch_fast
            texts_ = [t if t.isascii() else t.encode().decode("latin-1").translate(BYTE_LETTERS) for t in texts_]
        return [np.array(e.ids, "<u4") for e in encode(texts_, add_special_tokens=False)]

    def _keep(self, chunks: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        """Remember new chunks by their ids, which lie end to end."""
        k, at = len(self.cache), int(self.ends[len(self.cache)])
        if at + len(ids) > len(self.ids):
            self.ids = np.r_[self.ids, np.empty(len(self.ids) + len(ids), "<u4")]
        if k + len(chunks) >= len(self.ends):
            self.ends = np.r_[self.ends, np.empty(len(self.ends) + len(chunks), np.int64)]
        self.ids[at:at + len(ids)] = ids
        self.ends[k + 1:k + 1 + len(chunks)] = at + ends
        self.cache.update(zip(chunks, range(k, k + len(chunks))))

    def _learn(self, chunks: list[bytes]) -> None:
        """Ids of new chunks."""
        ascii_, plain, letters, others = [], [], [], []
        for w in chunks:
            if w.isalpha() and w.islower():
                ascii_.append(w)
            else:
                t = w.decode()
                (plain if PLAIN.fullmatch(t) else letters if t.isalpha() else others).append(w)
        for some in ascii_, plain, letters:
            groups = [some[i:i + 1000] for i in range(0, len(some), 1000)]
            for group, ids in zip(groups, self._library([b" ".join(g).decode() for g in groups])):
                ends = np.flatnonzero(self.is_end[ids]) + 1
                if len(ends) == len(group) and ends[-1] == len(ids):
                    self._keep(group, ids, ends)
                else:
                    others += group                              # a letter that falls apart when normalised
        if others:
            found = self._library([w.decode() for w in others])
            self._keep(others, np.concatenate(found), np.cumsum([len(x) for x in found]))

    def encode_all(self, batch: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian u32."""
        return self.encode_column(pa.array(batch, pa.large_string()))

    def encode_column(self, column: pa.Array) -> list[bytes]:
        """Ids of each text of an Arrow column."""
        table = pa.RecordBatch.from_arrays([column], ["text"])
        return [x for b in small_batches(table, limit=PIECE_BYTES) for x in self._encode(b.column("text").to_pylist())]

    def _chunks(self, texts_: list[str | None]) -> tuple[pa.Array, np.ndarray]:
        """All chunks of the texts, and the number of them before each text and in all."""
        every = [(t or "").encode() for t in texts_]
        special = [b"<|" in t for t in every]                    # may hold a special token's string
        data = b" ".join([*(t if s else t.lower() for t, s in zip(every, special)), b""])   # lower as in the tokenizer
        at = np.r_[0, np.cumsum(np.fromiter(map(len, every), np.int64, len(every)) + 1)]
        raw, kinds = np.frombuffer(data, np.uint8), np.frombuffer(data.translate(KINDS), np.uint8)
        (begin, end), (cut, stop) = _runs(kinds != SPACE), _runs(kinds == MARK)
        last = cut - 1                                           # before the first byte: the last one, a space
        cut = cut[(kinds[stop] == SPACE) & ((kinds[last] == LETTER) | LATIN[raw[last]] & (raw[cut - 2] == 0xC3))]
        if any(special):
            own = np.flatnonzero((raw[:-1] == ord("<")) & (raw[1:] == ord("|")))
            cut = cut[~np.isin(np.searchsorted(begin, cut), np.searchsorted(begin, own, "right"))]
        begin, end = (np.sort(np.r_[x, cut], kind="stable") for x in (begin, end))
        ends = np.r_[0, np.cumsum(end - begin)]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(
            data.translate(None, SPACES))]), np.searchsorted(begin, at)

    def _encode(self, texts_: list[str | None]) -> list[bytes]:
        """Each chunk of the texts is looked up once, then dealt to its places."""
        if not texts_:
            return []
        every, first = self._chunks(texts_)
        coded = every.dictionary_encode()
        _, at, data = coded.dictionary.buffers()
        at = np.frombuffer(at, np.int64, len(coded.dictionary) + 1).tolist()
        data = data.to_pybytes()
        chunks = [data[a:b] for a, b in zip(at, at[1:])]         # four times as fast as to_pylist()
        k = np.fromiter(map(self.cache.get, chunks, repeat(-1)), np.int64, len(chunks))
        gaps = np.flatnonzero(k < 0)
        if len(self.cache) + len(gaps) > self.entries:
            self.cache.clear()
            gaps = np.arange(len(chunks))
        if len(gaps):
            new = [chunks[i] for i in gaps.tolist()]
            self._learn(new)
            k[gaps] = np.fromiter(map(self.cache.__getitem__, new), np.int64, len(new))
        which = coded.indices.to_numpy()
        start = self.ends[k]
        n = (self.ends[k + 1] - start)[which]
        stop = np.cumsum(n)
        place = np.repeat(start[which] - (stop - n), n)
        place += np.arange(len(place))
        raw = self.ids.take(place).tobytes()
        ends = (4 * np.r_[0, stop][first]).tolist()
        return [raw[a:b] for a, b in zip(ends, ends[1:])]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_blocks(docs: DataFrame, path: str, end_id: int, partitions: int | None = None,
                 block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encode all texts in ascending doc_id order and write the blocks below
    the shared folder: ``part, seq, n_ids, block``."""
    own = texts(docs).withColumn("row", F.monotonically_increasing_id())   # splits a repeated id, too
    n = partitions or int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = own.repartitionByRange(n, "doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        enc = encoder(path)
        part, seq = TaskContext.get().partitionId(), 0
        ids, raw, size = [], [], 0

        def flush():
            nonlocal seq, ids, raw, size
            lengths = np.fromiter((len(x) // 4 for x in raw), np.int64, len(raw))
            flat = np.frombuffer(b"".join(raw), "<u4").astype(np.int32)
            block = write_block(ids, lengths, flat, enc.alphabet)
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                                              pa.array([len(flat)], pa.int64()), pa.array([block], pa.binary())],
                                             ["part", "seq", "n_ids", "block"])
            seq, ids, raw, size = seq + 1, [], [], 0
            return row
        for whole in batches:
            for b in small_batches(whole):
                for d, x in zip(b.column("doc_id").to_pylist(), enc.encode_column(b.column("text"))):
                    ids.append(d)
                    raw.append(x + end)
                    size += len(x) // 4 + 1
                    if size >= block_ids:
                        yield flush()
        if ids:
            yield flush()
    return written(with_package(ordered).mapInArrow(run, "part int, seq int, n_ids long, block binary"), "id-blocks")


def read_documents(blocks: DataFrame) -> DataFrame:
    """Read blocks back: ``doc_id, start, n_tokens, ids_crc32``. The start is
    the number of ids before: a running sum over the parts (one row each), one
    over the blocks of a part, and one inside the block."""
    sizes = blocks.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = parts.select("part", (F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
                                   - F.col("ids")).alias("part_start"))
    inside = sizes.select("part", "seq", (F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(
        Window.unboundedPreceding, 0)) - F.col("n_ids")).alias("block_start"))
    starts = inside.join(before, "part").select("part", "seq", (F.col("block_start") + F.col("part_start")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for part, seq, block in zip(*(b.column(c).to_pylist() for c in ("part", "seq", "block"))):
                doc_ids, lengths, ids = read_block(block)
                raw = ids.astype("<u4").tobytes()
                stop = np.cumsum(lengths.astype(np.int64))
                start = stop - lengths
                crc = [zlib.crc32(raw[4 * i:4 * j]) for i, j in zip(start.tolist(), stop.tolist())]
                k = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * k, pa.int32()), pa.array([seq] * k, pa.int32()), pa.array(doc_ids, pa.int64()),
                     pa.array(start), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())],
                    ["part", "seq", "doc_id", "own", "n_tokens", "ids_crc32"])
    got = with_package(blocks.select("part", "seq", "block")).mapInArrow(
        run, "part int, seq int, doc_id long, own long, n_tokens long, ids_crc32 long")
    return got.join(starts, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("own")).alias("start"),
                                                    "n_tokens", "ids_crc32")
