"""Phrase collocations by HAT-trie counting.

1. Each task turns its texts into word ids of its own and counts phrases of 1 to
   3 words in a trie: a node fans out by word id, and below it a hash container
   holds the counts of all suffixes. A container that grows past BURST entries
   bursts: words that begin enough of its suffixes get nodes of their own, the
   rest stays together. So the trie is shallow where phrases are rare and deep
   where they are frequent.
2. When the trie holds more than HOLD entries, its largest subtrees are spilled
   whole until half is left; each becomes sorted runs, one for every prefix
   partition it has phrases of. A run carries its own word list and columns of
   word numbers and counts (the shuffle compresses it).
3. A prefix partition is named by the hash of language and first two words, and
   four bits of the third, so even the followers of one very common pair lie in
   sixteen partitions. Runs travel by that number; a task merges those of its
   partition and keeps phrases found often enough, beside the total of words.
4. Scores come from joins of the frequent phrases with their parts (a part of a
   frequent phrase is as frequent) in exact decimals. Phrases inside a longer
   frequent one are dropped; the best of a language are ranked in two steps, so
   that no task ranks more than the best of a few slices.

Cases: null text has no words, null ``lang`` is 'und'; words are told apart by
bytes after A-Z are lower-cased; no phrase crosses ``.,;:!?`` or a line break;
repeated rows and ids count again (ids are not used); an empty table gives no
rows; other columns are ignored. A single text is split as a whole, counted in
stretches of STRETCH words that overlap, so none of its phrases is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, with_package, written

LONGEST = 3                             # words of a phrase that a code holds
BITS = 21                               # bits of a word id in a code
WORD = (1 << BITS) - 1
MOST_WORDS = WORD                       # of a word list
BURST, OWN_NODE = 1 << 17, 1 << 12      # entries that burst a container; that earn a word its node
HOLD = 3 << 19                          # entries of a task's tries before one spills
WORDS_HELD = 1 << 20                    # words in their word lists before one begins anew
STRETCH = 1 << 18                       # words counted at once
SLICES = 16                             # of a language when its best are ranked
BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
RUN = "part int, run binary"
U64 = np.uint64


class Words(dict):
    """Word -> id, from 2 on; 0 is nothing, 1 a break."""

    def __init__(self) -> None:
        super().__init__({b"": 0, b"\n": 1})

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


class HashContainer:
    """Counts of phrase codes as an array hash: entries lie in arrays by slot,
    that is in order of a multiplicative (so reversible) hash of the code. New
    entries wait until they outnumber those in place, then all are merged."""

    __slots__ = ("keys", "counts", "fresh", "waiting")
    FACTOR = U64(0x9E3779B97F4A7C15)
    INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

    def __init__(self, codes=(), counts=()) -> None:
        self.keys, self.counts, self.fresh, self.waiting = np.zeros(0, U64), np.zeros(0, np.int64), [], 0
        if len(codes):
            self.add(codes, counts)

    def __len__(self) -> int:
        return len(self.keys) + self.waiting

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.fresh.append((codes.view(U64) * self.FACTOR, counts))
        self.waiting += len(codes)
        if self.waiting > max(4096, len(self.keys)):
            self.merge()

    def merge(self) -> None:
        if self.fresh:
            keys = np.concatenate([self.keys, *[k for k, _ in self.fresh]])
            counts = np.concatenate([self.counts, *[c for _, c in self.fresh]])
            order = np.argsort(keys)
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            self.keys, self.counts = keys[first], np.add.reduceat(counts, first)
            self.fresh, self.waiting = [], 0

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        self.merge()
        return (self.keys * self.INVERSE).view(np.int64), self.counts


class Node:
    """A trie node at ``depth``: children by the word id at that depth, and one
    hash container for the phrases of all other words."""

    __slots__ = ("depth", "children", "rest", "burst_at")

    def __init__(self, depth: int) -> None:
        self.depth, self.children, self.rest, self.burst_at = depth, {}, HashContainer(), BURST

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        """Add sorted distinct codes with their counts."""
        if self.children:
            mine = np.ones(len(codes), bool)
            shift = BITS * (LONGEST - 1 - self.depth)
            at = codes >> shift & WORD                          # ascends, as all words before are equal
            for word, child in self.children.items():
                a, b = np.searchsorted(at, [word, word + 1])
                if a < b:
                    child.add(codes[a:b], counts[a:b])
                    mine[a:b] = False
            codes, counts = codes[mine], counts[mine]
        if len(codes):
            self.rest.add(codes, counts)
        if len(self.rest) > self.burst_at and self.depth < LONGEST - 1:
            self.burst()

    def burst(self) -> None:
        codes, counts = self.rest.entries()
        at = codes >> BITS * (LONGEST - 1 - self.depth) & WORD
        order = np.argsort(at, kind="stable")
        words, starts, sizes = np.unique(at[order], return_index=True, return_counts=True)
        earned = (sizes >= OWN_NODE) & (words > 0)
        for word, a, n in zip(words[earned].tolist(), starts[earned].tolist(), sizes[earned].tolist()):
            child = self.children[word] = Node(self.depth + 1)
            child.rest = HashContainer(codes[order[a:a + n]], counts[order[a:a + n]])
        if earned.any():
            stays = ~np.isin(at, words[earned])
            self.rest = HashContainer(codes[stays], counts[stays])
        self.burst_at = max(BURST, 2 * len(self.rest))          # few repeats: look again when it has doubled

    def size(self) -> int:
        return len(self.rest) + sum(c.size() for c in self.children.values())

    def entries(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield self.rest.entries()
        for child in self.children.values():
            yield from child.entries()


def word_hash(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), U64, len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> U64(31)) * U64(0x9E3779B97F4A7C15)
    return x ^ x >> U64(29)


def partition_of(hashes: np.ndarray, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, parts: int) -> np.ndarray:
    """Prefix partition of phrases given as places in ``hashes`` (0: no word)."""
    salt = np.where(w3 > 0, hashes[w3] & U64(15), U64(16))
    x = _mix(_mix(_mix(hashes[w1]) + hashes[w2] * (w2 > 0)) + salt)
    return (x % U64(parts)).astype(np.int32)


class PhraseTrie:
    """The phrases of one language in one task."""

    def __init__(self, lang: str, parts: int, longest: int) -> None:
        self.lang, self.parts, self.longest, self.size = lang, parts, longest, 0
        self.words, self.hashes = Words(), np.zeros(2, U64)
        self.root = Node(0)
        self.tokens: list[np.ndarray] = []
        self.waiting = 0

    def add_text(self, text: str | None) -> Iterator[tuple[int, bytes]]:
        """Count a text; yields what must go because word ids run out."""
        tokens = (text or "").encode().lower().translate(BREAKS).replace(b"\n", b" \n ").split(b" ")
        for i in range(0, len(tokens), STRETCH):
            part = tokens[i:i + STRETCH]
            if len(self.words) + len(part) > MOST_WORDS:              # ids run out
                yield from self.flush()
            ids = np.fromiter(map(self.words.__getitem__, part), np.int64, len(part))
            self.tokens.append(ids[ids > 0])
            self.waiting += len(part)
            last = i + STRETCH >= len(tokens)
            if last:
                self.tokens.append(np.ones(1, np.int64))
            if self.waiting >= STRETCH:
                self.count(last)

    def count(self, ended: bool = True) -> None:
        """Move waiting words into the trie. A text that goes on leaves its
        last words behind: phrases that begin there are counted with the next."""
        ids = np.concatenate([*self.tokens, np.ones(self.longest, np.int64)]) if ended else np.concatenate(self.tokens)
        keep = min(self.longest - 1, len(ids)) if not ended else 0
        begins = ids[:len(ids) - (keep or self.longest)]
        self.tokens = [ids[len(ids) - keep:]] if keep else []
        self.waiting = 0
        code, alive = np.zeros(len(begins), np.int64), np.ones(len(begins), bool)
        found = []
        for k in range(self.longest):
            word = ids[k:k + len(begins)]
            alive &= word > 1
            code = code | word << BITS * (LONGEST - 1 - k)
            found.append(code[alive])
        self.root.add(*np.unique(np.concatenate(found), return_counts=True))
        self.size = self.root.size()

    def spill(self, most: int) -> Iterator[tuple[int, bytes]]:
        """Spill the largest subtrees whole until ``most`` entries are left."""
        pieces = []
        for word, child in sorted(self.root.children.items(), key=lambda c: -c[1].size()):
            if self.size <= most:
                break
            self.size -= child.size()
            pieces += child.entries()
            del self.root.children[word]
        if self.size > most:                                    # the words without a node of their own go together
            self.size -= len(self.root.rest)
            pieces.append(next(self.root.entries()))
            self.root.rest, self.root.burst_at = HashContainer(), BURST
        yield from self.runs(pieces)

    def runs(self, pieces: list) -> Iterator[tuple[int, bytes]]:
        """Sorted runs of the entries, one per prefix partition."""
        codes = np.concatenate([np.zeros(0, np.int64), *[c for c, _ in pieces]])
        counts = np.concatenate([np.zeros(0, np.int64), *[n for _, n in pieces]])
        if not len(codes):
            return
        if len(self.words) > len(self.hashes):
            new = list(self.words)[len(self.hashes):]
            self.hashes = np.concatenate([self.hashes, word_hash(self.lang, new)])
        order = np.argsort(codes)
        codes, counts = codes[order], counts[order]
        w = [codes >> BITS * (LONGEST - 1 - k) & WORD for k in range(LONGEST)]
        part = partition_of(self.hashes, *w, self.parts)
        order = np.argsort(part.astype(np.min_scalar_type(self.parts)), kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(part[order]) > 0, True])
        names = list(self.words)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            at = order[a:b]
            yield int(part[at[0]]), write_run(self.lang, names, [x[at] for x in w], counts[at])

    def end(self) -> Iterator[tuple[int, bytes]]:
        """Count what waits, and everything as runs."""
        self.count()
        yield from self.flush()

    def flush(self) -> Iterator[tuple[int, bytes]]:
        """Everything as runs; ids begin anew (words of an open text stay)."""
        open_ids = np.concatenate([np.zeros(0, np.int64), *self.tokens])
        names = list(self.words)
        yield from self.runs(list(self.root.entries()))
        self.root, self.words, self.hashes, self.size = Node(0), Words(), np.zeros(2, U64), 0
        self.tokens = [np.array([self.words[names[i]] for i in open_ids.tolist()], np.int64)]


def write_run(lang: str, names: list[bytes], w: list[np.ndarray], counts: np.ndarray) -> bytes:
    """A run: its words, the places of each phrase's words among them (0: none)
    and the counts, each in the narrowest unsigned integers."""
    flags = np.zeros(len(names), bool)
    for x in w:
        flags[x] = True
    flags[0] = True
    used = np.flatnonzero(flags)
    kind = 2 if len(used) <= 1 << 16 else 4
    place = np.zeros(len(names), f"<u{kind}")
    place[used] = np.arange(len(used))
    words, head = b"\n".join([names[i] for i in used[1:].tolist()]), lang.encode()
    wide = next(k for k in (1, 2, 4, 8) if int(counts.max()) < 1 << 8 * k)
    return b"".join([np.array([len(head), len(words), len(counts), kind, wide], "<u4").tobytes(), head, words,
                     *[place[x].tobytes() for x in w], counts.astype(f"<u{wide}").tobytes()])


def read_run(run: bytes) -> tuple[str, list[bytes], np.ndarray, np.ndarray]:
    """(lang, words from place 1 on, places by column, counts)."""
    a, b, n, kind, wide = np.frombuffer(run, "<u4", 5).tolist()
    at = 20 + a + b
    w = np.frombuffer(run, f"<u{kind}", LONGEST * n, at).reshape(LONGEST, n)
    counts = np.frombuffer(run, f"<u{wide}", n, at + LONGEST * n * kind)
    return run[20:20 + a].decode(), run[20 + a:at].split(b"\n"), w, counts.astype(np.int64)


class Merger:
    """The runs of one prefix partition and language."""

    def __init__(self) -> None:
        self.words, self.held, self.size, self.merge_at = Words(), [], 0, 1 << 20

    def add(self, words: list[bytes], w: np.ndarray, counts: np.ndarray) -> None:
        ids = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        own = np.r_[0, ids].astype(np.int32)
        self.held.append((own[w], counts))
        self.size += len(counts)
        if self.size > self.merge_at:
            self.merge()
            self.merge_at = max(1 << 20, 2 * self.size)

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        w = np.concatenate([x for x, _ in self.held], axis=1)
        counts = np.concatenate([c for _, c in self.held])
        if len(self.words) <= WORD:
            order = np.argsort(w[0].astype(np.int64) << 2 * BITS | w[1].astype(np.int64) << BITS | w[2])
        else:
            order = np.lexsort(w[::-1])
        w, counts = w[:, order], counts[order]
        first = np.flatnonzero(np.r_[True, (np.diff(w, axis=1) != 0).any(axis=0)])
        self.held = [(w[:, first], np.add.reduceat(counts, first))]
        self.size = len(first)
        return self.held[0]


def phrase_runs(docs: DataFrame, longest: int, parts: int, hold: int = HOLD) -> DataFrame:
    """``part, run``: the sorted runs of every task's tries."""
    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                      F.col("text").cast("string").alias("text"))

    def run(batches):
        tries: dict[str, PhraseTrie] = {}

        def rows(got):
            got = list(got)
            if got:
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in got], pa.int32()),
                                                  pa.array([r for _, r in got], pa.binary())], ["part", "run"])
        for whole in batches:
            for b in small_batches(whole):
                for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                    if lang not in tries:
                        if len(tries) >= 16:                    # many languages: the one met first gives way
                            yield from rows(tries.pop(next(iter(tries))).end())
                        tries[lang] = PhraseTrie(lang, parts, longest)
                    yield from rows(tries[lang].add_text(text))
                    if sum(t.size for t in tries.values()) > hold:
                        yield from rows(max(tries.values(), key=lambda t: t.size).spill(hold // 4))
                    if sum(len(t.words) for t in tries.values()) > WORDS_HELD:
                        yield from rows(max(tries.values(), key=lambda t: len(t.words)).end())
        for trie in tries.values():
            yield from rows(trie.end())
    return with_package(own).mapInArrow(run, RUN)


def frequent_phrases(docs: DataFrame, longest: int, least: int, hold: int = HOLD) -> DataFrame:
    """``lang, k, w1, w2, w3, f`` of phrases found ``least`` times or more
    (``k`` words; unused words null), and with k = 0 the words in all of each
    language, a part of the sum per row."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = phrase_runs(docs, longest, parts, hold)
    dealt = runs.repartitionById(parts, F.col("part"))

    def run(batches):
        merged: dict[str, Merger] = {}
        for b in batches:
            for r in b.column("run").to_pylist():
                lang, words, w, counts = read_run(r)
                merged.setdefault(lang, Merger()).add(words, w, counts)
        for lang, m in merged.items():
            w, counts = m.merge()
            single = w[1] == 0
            names = list(m.words)
            at = np.flatnonzero(counts >= least)
            for i in range(0, len(at), 20_000):
                some = at[i:i + 20_000]
                cols = [[names[j].decode() if j else None for j in w[c][some].tolist()] for c in range(LONGEST)]
                yield batch(lang, (w[:, some] > 0).sum(axis=0).astype(np.int32), cols, counts[some])
            yield batch(lang, np.zeros(1, np.int32), [[None]] * LONGEST, np.array([counts[single].sum()]))

    def batch(lang, k, cols, f):
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(k)), pa.array(k), *[pa.array(c, pa.string()) for c in cols],
                                           pa.array(f, pa.int64())], ["lang", "k", "w1", "w2", "w3", "f"])
    return written(with_package(dealt).mapInArrow(run, "lang string, k int, w1 string, w2 string, w3 string, f long"),
                   "frequent-phrases")


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a² / (l r)), exactly, in decimals of 38 digits."""
    a, left, right = (f"CAST({c} AS DECIMAL(15,0))" for c in (a, left, right))
    return F.expr(f"CAST(1000000 AS DECIMAL(7,0)) * ({a} * {a}) div ({left} * {right})")


def scored(phrases: DataFrame) -> DataFrame:
    """``lang, w1, w2, w3, a, l, r, score`` of all phrases of two and three
    words, with the cut that scores least (ties: the earlier)."""
    one, two, three = (phrases.where(F.col("k") == k) for k in (1, 2, 3))

    def part(df, name, *words):
        return df.select("lang", *[F.col(f"w{i + 1}").alias(w) for i, w in enumerate(words)], F.col("f").alias(name))

    def whole(df):
        return df.select("lang", "w1", "w2", "w3", F.col("f").alias("a"))
    pairs = whole(two).join(part(one, "l", "w1"), ["lang", "w1"]).join(part(one, "r", "w2"), ["lang", "w2"])
    triples = (whole(three).join(part(one, "l1", "w1"), ["lang", "w1"]).join(part(two, "r1", "w2", "w3"), ["lang", "w2", "w3"])
               .join(part(two, "l2", "w1", "w2"), ["lang", "w1", "w2"]).join(part(one, "r2", "w3"), ["lang", "w3"])
               .withColumn("s1", _score("a", "l1", "r1")).withColumn("s2", _score("a", "l2", "r2")))
    early = F.col("s1") <= F.col("s2")
    return pairs.select("lang", "w1", "w2", "w3", "a", "l", "r", _score("a", "l", "r").alias("score")).unionByName(
        triples.select("lang", "w1", "w2", "w3", "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                       F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score")))


def outside_longer(found: DataFrame, share: int = 50) -> DataFrame:
    """Without pairs inside a triple that is found in ``share`` percent of the
    pair's places or more."""
    triples = found.where("w3 is not null")
    inside = triples.select("lang", "w1", "w2", "a").union(triples.select("lang", "w2", "w3", "a")).groupBy(
        "lang", "w1", "w2").agg(F.max("a").alias("most"))
    pairs = found.where("w3 is null").join(inside, ["lang", "w1", "w2"], "left").where(
        F.coalesce(100 * F.col("most") < share * F.col("a"), F.lit(True)))
    return pairs.select(found.columns).unionByName(triples)


def mine(docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, hold: int = HOLD) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases of 2 to {LONGEST} words")
    phrases = frequent_phrases(docs, longest, least, hold)
    n = phrases.where("k = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    found = written(scored(phrases), "scored-phrases").withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    sliced = Window.partitionBy("lang", "slice").orderBy(*best)
    few = outside_longer(found).withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES))).withColumn(
        "place", F.row_number().over(sliced)).where(F.col("place") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
