"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes. Two fingerprints at Hamming
distance d differ in at most d bytes, so a linked pair shares at least 8 - d
positional bytes: that is the guaranteed minimum of the count filter. Tallying
single bytes would make posting lists of N/256 entries and so N^2/256 pairs;
here a posting is keyed by 8 - d positional bytes at once (one key for each
choice of positions), so two entries of one posting have reached the minimum
already, and only those pairs are verified by their differing bits. For d = 2
a fingerprint has C(8,2) = 28 postings and a posting holds at most 65,536
distinct fingerprints, because just two bytes are free: no posting grows with
the input without bound, however many near copies there are.

Exact copies collapse to one distinct fingerprint before the index, with
map-side aggregation; documents come back at the end by one join on the
fingerprint. Components come from alternating star steps over the links, with
a reliable checkpoint after each round.

Cases: null, empty or blank text has the fingerprint zero and links like any
other; fewer words than the shingle length make one shingle; a null doc_id
keeps its row and its component's smallest id is taken over the others (null
if there is none); repeated rows share a component; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, unused, with_package, written

WORDS_AT_ONCE = 1 << 18
#: Postings beyond this many entries are probed by bit flips, not pair by pair.
LONG_POSTING = 256


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of lower-cased (A-Z) word shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return digest(b" ".join(words), seed)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    votes, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for i in range(0, n, WORDS_AT_ONCE):
        j = min(n, i + WORDS_AT_ONCE)
        h = [digest(joined[a:b], seed) for a, b in
             zip(starts[i:j].tolist(), ends[i + shingle - 1:j + shingle - 1].tolist())]
        votes += np.unpackbits(np.array(h, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs`` must hold ``text``; its other columns are kept, the text gives
    way to ``fp`` (the fingerprint as a signed long). Narrow."""
    keep = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches):
        for whole in batches:
            for b in small_batches(whole):
                fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([b.column(f.name) for f in keep] + [pa.array(fp.view(np.int64))],
                                                 [f.name for f in keep] + ["fp"])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + ["fp long"])
    return with_package(docs).mapInArrow(run, schema)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _pairs_in_runs(part: np.ndarray, key: np.ndarray, fp: np.ndarray, distance: int, free_bits: dict):
    """Verified links inside runs of equal (part, key); rows come sorted."""
    new = np.r_[True, (part[1:] != part[:-1]) | (key[1:] != key[:-1])]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.r_[starts, len(fp)])
    run = np.repeat(np.arange(len(starts)), sizes)
    short = sizes <= LONG_POSTING
    left, right = [], []
    most = int(sizes[short].max(initial=1))
    at = np.flatnonzero(short[run] & (sizes[run] > 1))
    for d in range(1, most):
        at = at[at + d < len(fp)]
        at = at[run[at] == run[at + d]]
        if not len(at):
            break
        near = np.bitwise_count(fp[at] ^ fp[at + d]) <= distance
        left.append(fp[at[near]])
        right.append(fp[at[near] + d])
    for r in np.flatnonzero(~short):
        own = np.sort(fp[starts[r]:starts[r] + sizes[r]])
        for flip in free_bits[int(part[starts[r]])]:
            other = own ^ flip
            hit = own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other
            hit &= own < other
            left.append(own[hit])
            right.append(other[hit])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """All pairs ``a, b`` of different fingerprints (column ``fp``, each once)
    that differ in at most ``distance`` bits."""
    choices = list(combinations(range(8), distance))        # the positions left free
    masks = [(1 << 64) - 1 - sum(255 << 8 * p for p in c) for c in choices]
    postings = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks]))
                          .alias("part", "key"))
    flips = {}
    for i, c in enumerate(choices):
        bits = [8 * p + b for p in c for b in range(8)]
        flips[i] = [np.uint64(sum(1 << b for b in s)) for k in range(1, distance + 1) for s in combinations(bits, k)]

    def run(batches):
        rest = None
        for b in batches:
            cols = [b.column("part").to_numpy(), b.column("key").to_numpy(), b.column("fp").to_numpy().view(np.uint64)]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols)]
            if not len(cols[0]):
                continue
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = last[-1] + 1 if len(last) else 0          # the last run may go on in the next batch
            rest = [x[cut:] for x in cols]
            if cut:
                yield batch(*_pairs_in_runs(*[x[:cut] for x in cols], distance, flips))
        if rest is not None:
            yield batch(*_pairs_in_runs(*rest, distance, flips))

    def batch(left, right):
        return pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], ["a", "b"])

    return (with_package(postings).repartition("part", "key").sortWithinPartitions("part", "key")
            .mapInArrow(run, "a long, b long").dropDuplicates(["a", "b"]))


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """Connected components of undirected links ``a, b`` by alternating large
    and small star steps: one row ``node, root`` for each node with a link;
    the root is the component's smallest node. Every round is checkpointed to
    the shared folder."""
    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else \
            pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = both.join(least, "a")
        if large:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").dropDuplicates(["a", "b"])

    def mark(pairs: DataFrame):
        r = pairs.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        return r[0], r[1]

    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).checkpoint()
    seen = mark(pairs)
    for _ in range(rounds):
        pairs = star(star(pairs, True), False).checkpoint()
        now = mark(pairs)
        if now == seen:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        seen = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``, any further columns kept but for
    the text): ``fp, component_id, keeper`` (the smallest further columns
    of the component as a struct; with ``doc_id`` alone, its smallest id)."""
    rest = [c for c in docs.columns if c != "text"]
    marked = written(fingerprints(docs, shingle), "simhash")
    fps = marked.groupBy("fp").agg(F.min("doc_id").alias("least"),
                                   F.min(F.struct(*[F.col(c) for c in rest])).alias("keeper"))
    fps = written(fps, "simhash-distinct")
    roots = components(links(fps.select("fp"), distance))
    rooted = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", "keeper", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.min("keeper").alias("keeper"))
    named = rooted.select("fp", "root").join(groups, "root").select("fp", "component_id", "keeper")
    return marked.join(named, "fp")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest
    doc_id (the first of these rows where the id is repeated)."""
    row = unused(docs, "row")
    # the numbers are stored: a second scan may be split otherwise and would number the rows anew
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-rows")
    own = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(row).alias("row"),
                      F.col("text").cast("string").alias("text"))
    kept = near_duplicates(own, shingle, distance).where(F.col("keeper.row") == F.col("row"))
    return rows.join(kept.select(F.col("row").alias(row)), row, "left_semi").drop(row).select(docs.columns)
