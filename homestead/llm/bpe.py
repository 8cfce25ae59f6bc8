"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token's bytes form a doubly linked list of parts. Each adjacent pair
whose joined bytes are in the vocabulary waits in the bucket of its rank; a
bucket is a list of positions. A three-level bitmap over all ranks (words of
64 bits) marks the buckets that hold entries, so the next rank to merge is
three find-first-set steps away, whatever the pre-token's length. A bucket is
worked off from the left until it is empty or a lower rank has come up; a wide
bucket of a token that can bring up no lower rank is worked off in one step.
Entries made stale by an earlier merge stay in their bucket and are skipped.
Work is O(n log n) for n bytes at worst; there is no rescan of the parts.

The results equal the published greedy rule: merge the lowest rank, leftmost
first, until no adjacent pair is in the vocabulary.

Cases: null or empty text gives no ids and the empty digests; repeated rows
give repeated results; an empty table gives an empty table; columns other than
``doc_id`` and ``text`` are ignored by :func:`encode_documents`. A text that is
not valid Unicode cannot occur in Spark strings.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import small_batches, texts, with_package

#: Pre-tokens remembered by a worker; when full, the memory starts anew.
CACHE_ENTRIES = 500_000
#: Texts beyond this length are split into pre-tokens in blocks.
LONG_TEXT = 1 << 20
#: Entries from which a bucket is worked off with numpy, all at once.
WIDE = 96


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one ``base64-token rank`` pair per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class ByteBPE:
    """Encoder and decoder for one rank table and pre-token pattern.

    The pre-tokens that a block of text brings for the first time go through
    the queue together: they lie end to end in one list, no pair spans two of
    them, and so every rank is opened once for the block instead of once for
    each pre-token.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str,
                 cache_entries: int = CACHE_ENTRIES) -> None:
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.split = regex.compile(pattern)
        self.cache_entries = cache_entries
        self.cache: dict[str, tuple[tuple[int, ...], str]] = {}
        words = (max(ranks.values(), default=0) >> 6) + 1
        self.low = [0] * words                       # a bit for each rank
        self.mid = [0] * ((words >> 6) + 1)          # a bit for each word of low
        self.buckets: dict[int, list[int]] = {}      # rank -> positions
        self._joins()

    def _joins(self) -> None:
        """The rank of every two parts that lie next to each other and join to
        a token, as a dict and as sorted arrays; and the tokens that can join a
        neighbour at a lower rank than their own."""
        ranks, unknown = self.ranks, max(self.ranks.values(), default=-1) + 1
        #: id of a single byte; a byte outside the vocabulary has one past the ranks until it is joined
        self.byte_ids = np.array([ranks.get(bytes([b]), unknown + b) for b in range(256)], np.int32)
        self.known, self.span = unknown, unknown + 256
        single, get, rows = self.byte_ids.tolist(), ranks.get, []
        for token, rank in ranks.items():
            end = len(token) - 1
            for cut in range(1, end + 1):
                left = get(token[:cut]) if cut > 1 else single[token[0]]
                right = get(token[cut:]) if cut < end else single[token[end]]
                if left is not None and right is not None:
                    rows.append((left * self.span + right, rank))
        rows.sort()
        self.join = dict(rows)
        self.keys = np.array([k for k, _ in rows] + [np.iinfo(np.int64).max], np.int64)
        self.values = np.array([r for _, r in rows] + [-1], np.int32)
        left, right = np.divmod(self.keys[:-1], self.span)
        sooner = [part[self.values[:-1] < part] for part in (left, right)]
        self.scalar_only = set(np.concatenate(sooner).tolist())

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each two parts joined, -1 where they do not join."""
        key = left.astype(np.int64) * self.span + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], -1).astype(np.int32)

    def merge_all(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each pre-token. The list lies in arrays that are read one
        entry at a time for a narrow bucket, and all entries of the bucket at
        once for a wide one."""
        if not pieces:
            return []
        low, mid, buckets = self.low, self.mid, self.buckets
        join, span, scalar_only = self.join.get, self.span, self.scalar_only
        top = 0                                      # a bit for each word of mid
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(raw)
        lengths = np.array([len(p) for p in pieces], np.int64)
        starts = np.cumsum(lengths) - lengths

        def shared(values, kind="i"):                # the same memory as an array and for numpy
            own = array(kind, values.tobytes())
            return own, np.frombuffer(own, values.dtype)

        after, v_after = shared(np.arange(1, n + 1, dtype=np.int32))       # start of the next part
        before, v_before = shared(np.arange(-1, n - 1, dtype=np.int32))    # start of the previous part
        part, v_part = shared(self.byte_ids[raw])                          # id of the part, -1: joined to another
        ends = np.zeros(n, np.uint8)
        ends[(starts + lengths)[lengths > 0] - 1] = 1
        last, v_last = shared(ends, "B")             # 1: the next part is another pre-token's
        head, v_head = shared(np.roll(ends, 1), "B")     # 1: the previous part is another pre-token's
        ranks = np.full(n, -1, np.int32)
        ranks[:-1] = np.where(ends[:-1] == 1, -1, self._joined(v_part[:-1], v_part[1:]))
        pair, v_pair = shared(ranks)                 # current rank of the pair that starts here
        waiting = np.argsort(ranks, kind="stable")[np.count_nonzero(ranks < 0):]
        opened, first = np.unique(ranks[waiting], return_index=True)
        for rank, bucket in zip(opened.tolist(), np.split(waiting, first[1:])):
            buckets[rank] = bucket.tolist()
            word = rank >> 6
            low[word] |= 1 << (rank & 63)
            mid[word >> 6] |= 1 << (word & 63)
            top |= 1 << (word >> 6)
        while top:
            group = (top & -top).bit_length() - 1    # find the first set bit, level by level
            bits = mid[group]
            word = group << 6 | (bits & -bits).bit_length() - 1
            bits = low[word]
            rank = word << 6 | (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) >= WIDE and rank not in scalar_only:
                at = np.unique(np.array(bucket, np.int64))
                bucket.clear()
                at = at[v_pair[at] == rank]          # the others are stale
                over = v_after[at]
                index = np.arange(len(at))
                if (run := at[1:] == over[:-1]).any():   # of pairs that overlap in a row, every other one
                    begun = np.maximum.accumulate(np.where(np.append(False, run), 0, index))
                    at, over = at[(index - begun) & 1 == 0], over[(index - begun) & 1 == 0]
                to = v_after[over]
                v_after[at] = to
                v_part[at] = rank
                v_part[over] = -1
                v_pair[over] = -1
                v_last[at] = v_last[over]
                goes_on = v_last[at] == 0
                v_before[to[goes_on]] = at[goes_on]
                near = np.unique(np.append(at, v_before[at[v_head[at] == 0]]))
                v_pair[near[v_last[near] == 1]] = -1
                near = near[v_last[near] == 0]
                new = self._joined(v_part[near], v_part[v_after[near]])
                fresh = (new >= 0) & (new != v_pair[near])
                v_pair[near] = new
                found = zip(new[fresh].tolist(), near[fresh].tolist())
                for new, h in found:
                    if new in buckets:
                        buckets[new].append(h)
                    else:
                        buckets[new] = [h]
                        w = new >> 6
                        low[w] |= 1 << (new & 63)
                        mid[w >> 6] |= 1 << (w & 63)
                        top |= 1 << (w >> 6)
            bucket.sort(reverse=True)
            lower = False
            while bucket and not lower:
                i = bucket.pop()
                if pair[i] != rank:
                    continue                         # stale
                j = after[i]
                k = after[j]
                after[i] = k
                part[i] = rank
                part[j] = pair[j] = -1
                changed = [i]
                if last[j]:                          # the part at i now ends its pre-token
                    last[i] = 1
                else:
                    before[k] = i
                if not head[i]:
                    changed.append(before[i])
                for h in changed:
                    if last[h]:
                        pair[h] = -1
                        continue
                    new = join(part[h] * span + part[after[h]], -1)
                    if new == pair[h]:
                        continue
                    pair[h] = new
                    if new < 0:
                        continue
                    if new in buckets:
                        buckets[new].append(h)
                    else:
                        buckets[new] = [h]
                        w = new >> 6
                        low[w] |= 1 << (new & 63)
                        mid[w >> 6] |= 1 << (w & 63)
                        top |= 1 << (w >> 6)
                    lower |= new < rank              # that one comes first
            if not bucket:
                del buckets[rank]
                low[word] &= ~(1 << (rank & 63))
                if not low[word]:
                    mid[group] &= ~(1 << (word & 63))
                    if not mid[group]:
                        top &= ~(1 << group)
        left = np.flatnonzero(v_part >= 0)
        ids = v_part[left]
        if len(ids) and int(ids.max()) >= self.known:
            raise KeyError(f"byte {int(ids.max()) - self.known} is not in the vocabulary")
        ids, cuts = ids.tolist(), np.searchsorted(left, np.append(starts, n)).tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def _blocks(self, text: str) -> Iterator[list[str]]:
        if len(text) <= LONG_TEXT:
            yield self.split.findall(text)
            return
        found = (m.group() for m in self.split.finditer(text))
        while block := list(islice(found, 1 << 16)):
            yield block

    def entries(self, block: list[str]) -> list[tuple[tuple[int, ...], str]]:
        """(ids, decimal ids joined by commas) of each pre-token of a block."""
        cache = self.cache
        new = [p for p in set(block) if p not in cache]
        if len(cache) + len(new) > self.cache_entries:
            cache.clear()
            new = list(set(block))
        ranks, merge = self.ranks, []
        for p in new:
            whole = ranks.get(p.encode())
            if whole is None:
                merge.append(p)
            else:
                cache[p] = (whole,), str(whole)
        for p, ids in zip(merge, self.merge_all([p.encode() for p in merge])):
            cache[p] = tuple(ids), ",".join(map(str, ids))
        found = [cache[p] for p in block]
        for p in merge:
            if len(p) > 256:                         # a long pre-token hardly comes again
                del cache[p]
        return found

    def encode_all(self, batch: list[str]) -> Iterator[Iterator[list[tuple[tuple[int, ...], str]]]]:
        """For each text its blocks of entries. Short texts that follow each
        other share a block, so their new pre-tokens are merged together."""
        at = 0
        while at < len(batch):
            if len(batch[at]) > LONG_TEXT:
                yield (self.entries(b) for b in self._blocks(batch[at]))
                at += 1
                continue
            size, split = 0, []
            while at < len(batch) and len(batch[at]) <= LONG_TEXT and size <= LONG_TEXT:
                split.append(self.split.findall(batch[at]))
                size += len(batch[at])
                at += 1
            found = iter(self.entries(list(chain.from_iterable(split))))
            for own in split:
                yield iter([list(islice(found, len(own)))])

    def encode(self, text: str) -> list[int]:
        return [i for block in self._blocks(text) for ids, _ in self.entries(block) for i in ids]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def digests(self, batch: list[str]) -> Iterator[tuple[int, str, str]]:
        """Of each text: number of ids, sha256 of the ids, sha256 of the
        decoded bytes; block by block, so memory is bounded by the text."""
        for blocks in self.encode_all(batch):
            n, ids_sha, raw_sha, comma = 0, hashlib.sha256(), hashlib.sha256(), b""
            for block in blocks:
                if not block:
                    continue
                ids = list(chain.from_iterable([e[0] for e in block]))
                n += len(ids)
                ids_sha.update(comma + ",".join([e[1] for e in block]).encode())
                comma = b","
                raw_sha.update(self.decode(ids))
            yield n, ids_sha.hexdigest(), raw_sha.hexdigest()


_CODERS: dict[tuple, ByteBPE] = {}


def coder(path: str, pattern: str) -> ByteBPE:
    """This process's coder for a rank file."""
    key = path, pattern
    if key not in _CODERS:
        _CODERS[key] = ByteBPE(load_ranks(path), pattern)
    return _CODERS[key]


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: ``doc_id, token_ids array<int>``."""
    def run(batches):
        own = coder(path, pattern)
        for whole in batches:
            for b in small_batches(whole):
                ids = [own.encode(t or "") for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))],
                                                 ["doc_id", "token_ids"])
    return with_package(texts(docs)).mapInArrow(run, "doc_id long, token_ids array<int>")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode every text, decode the ids again, and return per document
    ``doc_id, n_tokens, ids_sha256, decoded_sha256``. Narrow: no shuffle, one
    pass over the texts."""
    def run(batches):
        own = coder(path, pattern)
        for whole in batches:
            for b in small_batches(whole):
                rows = list(own.digests([t or "" for t in b.column("text").to_pylist()]))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return with_package(texts(docs)).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
