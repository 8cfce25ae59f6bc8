"""Language-model scores by prediction by partial matching.

A text is its lower-cased (A-Z) words joined by one space and closed by an end
byte. The model is a trie of byte contexts up to order 4, pretrained on the
learning documents: the frequency of every five-byte string, from which the
shorter contexts follow as suffixes. A byte is predicted from the longest
context seen; a context in which it never followed is escaped with method D's
estimate (half the number of different followers over the total), and every
symbol of the contexts already escaped is excluded from the shorter ones, down
to a uniform choice among the bytes not yet excluded. The probabilities of all
bytes after any context sum to one. A document's score is its accumulated code
length as log10.

The trie grows with the corpus and is never in one place. Documents are worked
on in buckets of bounded size. A bucket asks for its distinct five-byte strings
and words (one row each, with the learning counts), the counts are summed by
key, the trie is evaluated in parts of whole order-2 contexts (orders 1 and 0
are two tables of 65,536 and 256 entries), and the answers go back to the
bucket, sorted before its texts, where numpy adds them up as the rows stream by:
a task holds one bucket's answers and a slice of its texts. Text is stored with
its bucket and shuffled once, compressed.

Cases: null or empty text is the end token alone; with no learning documents
the base has N = V = 0 and the model is uniform over bytes; repeated rows count
as often as they occur and score alike; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, texts, with_package, written

ORDER = 4
PAD = b"\n" * ORDER
BUCKET_BYTES = 32 << 20
PIECE, CHUNK = 1 << 19, 1 << 20
POSITION_BITS = 20                                   # of CHUNK; a five-byte string takes 40
TRIE_STRINGS = 1 << 19                               # whole contexts are gathered up to this many strings


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def _streams(docs: list[list[bytes]]) -> Iterator[tuple[list[int], list[bytes]]]:
    """The documents' bytes, each piece led by its four bytes of context, in
    chunks of bounded size: (document numbers, pieces)."""
    numbers, pieces, size = [], [], 0
    for i, words in enumerate(docs):
        body = PAD + b" ".join(words) + b"\n"
        for at in range(ORDER, len(body), PIECE):
            piece = body[at - ORDER:at + PIECE]
            if size + len(piece) > CHUNK and pieces:
                yield numbers, pieces
                numbers, pieces, size = [], [], 0
            numbers.append(i)
            pieces.append(piece)
            size += len(piece)
    if pieces:
        yield numbers, pieces


def _grams(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(five-byte strings of all predicted positions, number of them per piece)."""
    v = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
    g = v[:len(v) - ORDER].copy()
    for k in range(1, ORDER + 1):
        g <<= 8
        g |= v[k:len(v) - ORDER + k]
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    valid = np.ones(len(g), bool)
    ends = np.cumsum(sizes)[:-1]                     # no string spans two pieces
    for k in range(ORDER):
        valid[ends - 1 - k] = False
    return g[valid], sizes - ORDER


def _merge(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(grams, kind="stable")
    g, n = grams[order], counts[order]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    return g[first], np.add.reduceat(n, first) if len(g) else n


class _Requests:
    """What a bucket asks for: its distinct strings and words."""

    def __init__(self) -> None:
        self.grams, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.words: Counter = Counter()
        self.other: set[bytes] = set()

    def add(self, docs: list[list[bytes]], learns: list[bool]) -> None:
        for words, own in zip(docs, learns):
            if own:
                self.words.update(words)
            else:
                self.other.update(words)
        for numbers, pieces in _streams(docs):
            g, n = _grams(pieces)
            own = np.repeat(np.array([learns[i] for i in numbers], np.int64), n)
            marked, times = np.unique(g << 1 | own, return_counts=True)
            self.grams, self.counts = _merge(np.concatenate([self.grams, marked >> 1]),
                                             np.concatenate([self.counts, times * (marked & 1)]))

    def rows(self, bucket: int) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "gram", "word", "n"]
        k = len(self.grams)
        if k:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, bucket)), pa.array(self.grams),
                                              pa.nulls(k, pa.binary()), pa.array(self.counts)], names)
        for w in self.other:
            if w not in self.words:
                self.words[w] = 0
        k = len(self.words)
        if k:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, bucket)), pa.nulls(k, pa.int64()),
                                              pa.array(list(self.words), pa.binary()),
                                              pa.array(list(self.words.values()), pa.int64())], names)


def _bucketed(batches, size: int):
    """Cut a task's rows into buckets of ``size`` bytes of text; the numbers
    depend on the input's order and splits, so they are stored with the text."""
    part, done = TaskContext.get().partitionId(), 0
    for b in batches:
        if not b.num_rows:
            continue
        used = np.asarray(pc.fill_null(pc.binary_length(b.column("text")), 0), np.int64)
        ends = done + np.cumsum(used)
        numbers = (ends - used) // size
        done = int(ends[-1])
        cuts = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1], True])
        for i, j in zip(cuts[:-1], cuts[1:]):
            yield (part << 32) + int(numbers[i]), b.slice(int(i), int(j - i))


def _slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def bucket_rows(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The buckets of ``docs`` (``doc_id, text, learns``) and what they ask for
    as rows of one kind: ``bucket, doc_id, learns, text`` of a document (text
    compressed, else null), or ``bucket, gram, word, n`` of a request. Both
    come from one pass, so a request always names the bucket of its text."""
    schema = pa.schema([("bucket", pa.int64()), ("gram", pa.int64()), ("word", pa.binary()), ("n", pa.int64()),
                        ("doc_id", pa.int64()), ("learns", pa.bool_()), ("text", pa.binary())])

    def batch(columns: dict, rows: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(rows, f.type)) for f in schema], schema=schema)

    def asks(asked, bucket):
        for r in asked.rows(bucket):
            yield batch(dict(zip(r.schema.names, r.columns)), r.num_rows)

    def run(batches):
        press = zstandard.ZstdCompressor(level=3)
        now, asked = None, None
        for bucket, b in _bucketed(batches, bucket_bytes):
            if bucket != now:
                if asked is not None:
                    yield from asks(asked, now)
                now, asked = bucket, _Requests()
            for c in _slices(b):
                raw = c.column("text").to_pylist()
                asked.add([words_of(t) for t in raw], c.column("learns").to_pylist())
                packed = pa.array([press.compress((t or "").encode()) for t in raw], pa.binary())
                yield batch({"bucket": pa.array(np.full(c.num_rows, bucket)), "doc_id": c.column("doc_id"),
                             "learns": c.column("learns"), "text": packed}, c.num_rows)
        if asked is not None:
            yield from asks(asked, now)
    return with_package(docs).mapInArrow(
        run, "bucket long, gram long, word binary, n long, doc_id long, learns boolean, text binary")


class Trie:
    """All contexts that end in the same two bytes, with orders 1 and 0."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> None:
        self.pairs = pairs                                       # count by (byte before, byte)
        self.single = pairs.sum(axis=0)
        seen = counts > 0
        self.keys, self.n, self.ctx, self.total, self.kinds, self.hidden = {}, {}, {}, {}, {}, {}
        for j in (4, 3, 2):
            g, n = _merge(grams[seen] & ((1 << 8 * (j + 1)) - 1), counts[seen])
            first = np.flatnonzero(np.r_[True, g[1:] >> 8 != g[:-1] >> 8]) if len(g) else np.zeros(0, np.int64)
            self.keys[j], self.n[j], self.ctx[j] = g, n, g[first] >> 8
            self.total[j] = np.add.reduceat(n, first) if len(g) else n
            self.kinds[j] = np.diff(np.r_[first, len(g)])
        for j in (4, 3, 2):                                      # mass of an order-j context's followers one order down
            g = self.keys[j]
            first = np.flatnonzero(np.r_[True, g[1:] >> 8 != g[:-1] >> 8]) if len(g) else np.zeros(0, np.int64)
            below = self._count(j - 1, g)
            self.hidden[j] = np.add.reduceat(below, first) if len(g) else below

    def _count(self, j: int, grams: np.ndarray) -> np.ndarray:
        if j == 1:
            return self.pairs[(grams >> 8) & 255, grams & 255]
        if j == 0:
            return self.single[grams & 255]
        key = grams & ((1 << 8 * (j + 1)) - 1)
        if not len(self.keys[j]):
            return np.zeros(len(grams), np.int64)
        at = np.minimum(np.searchsorted(self.keys[j], key), len(self.keys[j]) - 1)
        return np.where(self.keys[j][at] == key, self.n[j][at], 0)

    def _context(self, j: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Total, number of followers, and their mass one order down."""
        if j == 1:
            c = (grams >> 8) & 255
            follows = self.pairs > 0
            return self.pairs.sum(axis=1)[c], follows.sum(axis=1)[c], (follows * self.single).sum(axis=1)[c]
        if j == 0:
            zero = np.zeros(len(grams), np.int64)
            return zero + self.single.sum(), zero + (self.single > 0).sum(), zero
        key = (grams >> 8) & ((1 << 8 * j) - 1)
        if not len(self.ctx[j]):
            z = np.zeros(len(grams), np.int64)
            return z, z, z
        at = np.minimum(np.searchsorted(self.ctx[j], key), len(self.ctx[j]) - 1)
        hit = self.ctx[j][at] == key
        return tuple(np.where(hit, x[at], 0) for x in (self.total[j], self.kinds[j], self.hidden[j]))

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 P(last byte | the four before)."""
        out = np.zeros(len(grams))
        open_ = np.ones(len(grams), bool)
        hidden = np.zeros(len(grams), np.int64)                  # mass and number of the excluded symbols
        kinds = np.zeros(len(grams), np.int64)
        for j in range(ORDER, -1, -1):
            total, q, below = self._context(j, grams)
            rest, left = total - hidden, q - kinds
            use = open_ & (left > 0)
            n = self._count(j, grams)
            hit = use & (n > 0)
            miss = use & (n == 0)
            out[hit] += np.log10((2 * n[hit] - 1) / (2 * rest[hit]))
            out[miss] += np.log10(left[miss] / (2 * rest[miss]))
            open_ &= ~hit
            hidden, kinds = below, q
        out[open_] -= np.log10(256 - kinds[open_])
        return out


def evaluate(totals: DataFrame) -> DataFrame:
    """``gram, value``: log10 probabilities from ``gram, n`` (n = 0: asked for only)."""
    small = totals.where("n > 0").groupBy(F.col("gram").bitwiseAND(F.lit(0xFFFF)).alias("pair")) \
        .agg(F.sum("n").alias("n")).toPandas()                   # 65,536 rows at most
    pairs = np.zeros(1 << 16, np.int64)
    pairs[small["pair"].to_numpy(np.int64)] = small["n"].to_numpy(np.int64)
    pairs = pairs.reshape(256, 256)

    def answered(g, n):
        trie = Trie(g, n, pairs)
        for i in range(0, len(g), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(g[i:i + (1 << 16)]), pa.array(trie.log10(g[i:i + (1 << 16)]))],
                                             ["gram", "value"])

    def run(batches):
        """Rows come sorted by context: a trie ends where a context does."""
        grams, counts, held = [], [], 0
        for b in batches:
            if not b.num_rows:
                continue
            g, n = b.column("gram").to_numpy(), b.column("n").to_numpy()
            if held + len(g) >= TRIE_STRINGS:
                ctx = np.r_[grams[-1][-1] if grams else g[0], g] >> 8 & 0xFFFF
                new = np.flatnonzero(ctx[1:] != ctx[:-1])
                if len(new):
                    cut = int(new[-1])
                    yield from answered(np.concatenate([*grams, g[:cut]]), np.concatenate([*counts, n[:cut]]))
                    g, n, grams, counts, held = g[cut:], n[cut:], [], [], 0
            grams.append(g.copy())
            counts.append(n.copy())
            held += len(g)
        if held:
            yield from answered(np.concatenate(grams), np.concatenate(counts))
    context = F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF))
    return with_package(totals.withColumn("ctx", context)).repartition("ctx").sortWithinPartitions("ctx") \
        .select("gram", "n").mapInArrow(run, "gram long, value double")


def _runs(batches) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """Batches cut where the bucket or the kind of row changes: (bucket, holds
    texts, rows)."""
    for b in batches:
        if not b.num_rows:
            continue
        bucket, is_text = b.column("bucket").to_numpy(), np.asarray(pc.is_valid(b.column("text")))
        cuts = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (is_text[1:] != is_text[:-1]), True])
        for i, j in zip(cuts[:-1], cuts[1:]):
            yield int(bucket[i]), bool(is_text[i]), b.slice(int(i), int(j - i))


class _Answers:
    """What a bucket asked for: values by string, counts by word."""

    def __init__(self) -> None:
        self.keys, self.values, self.words = [], [], {}
        self.key = self.value = None

    def add(self, b: pa.RecordBatch) -> None:
        known = pc.is_valid(b.column("gram"))
        grams, rest = b.filter(known), b.filter(pc.invert(known))
        self.keys.append(grams.column("gram").to_numpy(zero_copy_only=False).copy())
        self.values.append(grams.column("value").to_numpy(zero_copy_only=False).copy())
        self.words.update(zip(rest.column("word").to_pylist(), rest.column("n").to_pylist()))

    def close(self) -> None:
        key, value = (np.concatenate(x) if x else np.zeros(0) for x in (self.keys, self.values))
        order = np.argsort(key)
        self.key, self.value = key[order], value[order]
        self.keys, self.values = [], []


def _score(b: pa.RecordBatch, known: _Answers, n_total: int, kinds: int, ends: int) -> pa.RecordBatch:
    norm = np.log10(n_total + 0.5 * (kinds + 1))
    press = zstandard.ZstdDecompressor()
    words = [words_of(press.decompress(t).decode()) for t in b.column("text").to_pylist()]
    base, known_n = [], []
    for w in words:
        c = np.fromiter(map(known.words.__getitem__, w), float, len(w))
        base.append(float((np.log10(c + 0.5) - norm).sum() + np.log10(ends + 0.5) - norm))
        known_n.append(int((c > 0).sum()) + (ends > 0))
    score = np.zeros(len(words))
    for numbers, pieces in _streams(words):
        g, n = _grams(pieces)
        place = np.sort(g << POSITION_BITS | np.arange(len(g)))
        own = place >> POSITION_BITS
        new = np.r_[True, own[1:] != own[:-1]]
        found = known.value[np.searchsorted(known.key, own[new])]
        at = np.empty(len(g))
        at[place & ((1 << POSITION_BITS) - 1)] = found[np.cumsum(new) - 1]
        np.add.at(score, numbers, np.add.reduceat(at, np.r_[0, np.cumsum(n)[:-1]]))
    k = len(words)
    return pa.RecordBatch.from_arrays(
        [b.column("doc_id"), pa.array([len(w) + 1 for w in words], pa.int64()), pa.array(known_n, pa.int64()),
         pa.array([n_total] * k, pa.int64()), pa.array(base, pa.float64()), pa.array(score)],
        ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


SCORES = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame, learns, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every
    row of ``docs``; ``learns`` is a boolean column over ``doc_id``: the rows
    the model learns from. ``docs`` is read once; texts and requests share a
    work table, so the buckets hold however the input was split."""
    own = texts(docs).withColumn("learns", F.coalesce(learns, F.lit(False)))
    asked = written(bucket_rows(own, bucket_bytes), "ppm-buckets")
    ends = asked.where("learns").count()
    words = asked.where("word is not null")
    tokens, kinds = words.where("n > 0").groupBy("word").agg(F.sum("n").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, kinds = tokens + ends, kinds + (1 if ends else 0)
    grams = asked.where("gram is not null")
    totals = written(grams.groupBy("gram").agg(F.sum("n").alias("n")), "ppm-grams")
    counts = words.groupBy("word").agg(F.sum("n").alias("total"))
    none = {c: F.lit(None).cast(t) for c, t in (("gram", "long"), ("value", "double"), ("word", "binary"), ("n", "long"),
                                                 ("doc_id", "long"), ("text", "binary"))}

    def shaped(df: DataFrame) -> DataFrame:
        return df.select("bucket", *[F.col(c).alias(c) if c in df.columns else v.alias(c) for c, v in none.items()])
    rows = shaped(grams.select("bucket", "gram").join(evaluate(totals), "gram")) \
        .union(shaped(words.select("bucket", "word").join(counts, "word").withColumnRenamed("total", "n"))) \
        .union(shaped(asked.where("text is not null").select("bucket", "doc_id", "text")))

    def run(batches):
        """Rows come sorted by bucket, a bucket's answers before its texts."""
        now, known = None, None
        for bucket, is_text, b in _runs(batches):
            if bucket != now:
                now, known = bucket, _Answers()
            if not is_text:
                known.add(b)
                continue
            if known.key is None:
                known.close()
            for c in _slices(b):
                yield _score(c, known, tokens, kinds, ends)
    return with_package(rows).repartition("bucket").sortWithinPartitions("bucket", F.col("text").isNotNull()) \
        .mapInArrow(run, SCORES)


def learning_rows(mod: int = 5, held: int = 1):
    return remainder(F.col("doc_id"), mod) != held
