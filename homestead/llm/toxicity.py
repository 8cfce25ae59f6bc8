"""Toxicity by maximum-scoring segments with extreme-value calibration.

1. Token weights. Tokens (lower-cased ``\\w+``) are hashed into a fixed number
   of buckets, so the model is bounded whatever the vocabulary. Labelled
   training texts give counts per bucket and class (dense arrays in the task,
   one row per non-empty bucket and task, summed in Spark). A weight is the
   log-odds ratio with an informative Dirichlet prior (the pooled counts,
   scaled), kept where its z-score passes a threshold, less a constant drift
   that makes the mean score of clean text negative.
2. Segments. A linear scan (Ruzzo and Tompa) finds all maximal scoring
   segments of a text.
3. Calibration. Under the clean distribution a segment's score S in a text of
   n tokens has E = K n exp(-lambda S): lambda solves sum(p exp(lambda w)) = 1
   over the buckets, K is the maximum-likelihood scale of the observed maxima
   of the clean calibration texts (a sum over all of them). A segment is a
   significant passage if its E is at most ``max_e``. A text's statistic is the
   best segment's lambda S - ln(K n) plus the positive ones of the others.
4. Probability. The statistic is binned over all calibration texts and turned
   into a probability by isotonic regression on the bins.

Learning rows are split by id: four fifths of the remainders learn the weights
and the last the calibration, so neither sees the other's texts. Exact copies
of a text count once. ``lang``, ``source``, ``doc_id`` and labels are never
inputs of a score.

Cases: null or empty text scores as a text without segments (the bin below all
segments); labels with a null id or class are ignored, several labels of one id
count as toxic if any does; no usable labels or only one class gives the
smoothed base rate to every text; repeated rows score alike; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, small_batches, texts, with_package, written

WORD = re.compile(r"\w+")
BIN, LOWEST, BINS = 0.5, -30.0, 200


@dataclass(frozen=True)
class Params:
    bits: int = 18               # 2^bits buckets
    prior: float = 10_000.0      # token mentions that the Dirichlet prior weighs
    z: float = 2.0               # least z-score of a weight
    drift: float = 0.5           # taken from every token's weight
    max_e: float = 0.01          # E-value of a significant passage


class _Buckets(dict):
    """Token -> bucket; remembers a bounded number of tokens."""

    def __init__(self, bits: int) -> None:
        super().__init__()
        self.mask = (1 << bits) - 1

    def __missing__(self, token: str) -> int:
        if len(self) >= 400_000:
            self.clear()
        self[token] = b = xxhash.xxh64_intdigest(token) & self.mask
        return b


_BUCKETS: dict[int, _Buckets] = {}


def buckets(text: str | None, bits: int) -> np.ndarray:
    own = _BUCKETS.get(bits) or _BUCKETS.setdefault(bits, _Buckets(bits))
    words = WORD.findall((text or "").lower())
    return np.fromiter(map(own.__getitem__, words), np.int64, len(words))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end exclusive, score) in linear
    time. Neighbouring positive scores always fall in one segment, so the
    stack sees runs of them."""
    up = scores > 0
    if not up.any():
        return []
    edge = np.diff(np.r_[False, up, False].astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.r_[0.0, np.cumsum(scores)]
    stack: list[list] = []       # [left sum, right sum, start, end, nearest entry below with a smaller left sum]
    for a, b, left, right in zip(starts.tolist(), ends.tolist(), total[starts].tolist(), total[ends].tolist()):
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= right:
                stack.append([left, right, a, b, j])
                break
            left, a = stack[j][0], stack[j][2]
            del stack[j:]
    return [(s[2], s[3], s[1] - s[0]) for s in stack]


@dataclass(frozen=True)
class Model:
    params: Params
    weights: np.ndarray          # float32 per bucket
    lam: float
    k: float
    curve: np.ndarray            # probability per bin of the statistic

    def statistic(self, n: int, found: list[tuple[int, int, float]]) -> float:
        base = math.log(self.k * max(n, 1))
        bits = sorted((self.lam * s - base for _, _, s in found), reverse=True)
        return (bits[0] if bits else -base) + sum(x for x in bits[1:] if x > 0)

    def probability(self, statistic: float) -> float:
        at = (statistic - LOWEST) / BIN - 0.5
        return float(np.interp(at, np.arange(BINS), self.curve))

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Probability, and the significant passages as (start, end, E) in tokens."""
        w = self.weights[buckets(text, self.params.bits)]
        found = segments(w)
        n = len(w)
        e = [(a, b, self.k * n * math.exp(-self.lam * s)) for a, b, s in found]
        return self.probability(self.statistic(n, found)), [x for x in e if x[2] <= self.params.max_e]


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, toxic, part`` of the labelled learning documents, each
    distinct text once; ids and hashes are matched first, so only the texts
    needed are shuffled."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    own = texts(docs).where(F.col("doc_id").isNotNull() & (remainder(F.col("doc_id")) != 0))
    hashed = own.select("doc_id", F.xxhash64("text").alias("h"), F.octet_length("text").alias("size"))
    chosen = hashed.join(marks, "doc_id").groupBy("h", "size").agg(
        F.min(F.struct("doc_id", "toxic")).alias("x")).select("x.doc_id", "x.toxic").dropDuplicates(["doc_id"])
    return own.join(chosen, "doc_id").select("doc_id", "text", "toxic", remainder(F.col("doc_id")).alias("part"))


def _counts(rows: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Per bucket, the clean and the toxic texts that hold one of its tokens."""
    size = 1 << bits

    def run(batches):
        total = np.zeros((2, size), np.int64)
        for b in batches:
            for c in small_batches(b):
                for text, toxic in zip(c.column("text").to_pylist(), c.column("toxic").to_pylist()):
                    total[1 if toxic else 0, np.unique(buckets(text, bits))] += 1
        at = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])],
                                         ["bucket", "clean", "toxic"])
    got = with_package(rows).mapInArrow(run, "bucket long, clean long, toxic long").groupBy("bucket").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()     # 2^bits rows at most
    out = np.zeros((2, size))
    out[0, got.bucket], out[1, got.bucket] = got.clean, got.toxic
    return out[0], out[1]


def token_weights(clean: np.ndarray, toxic: np.ndarray, p: Params) -> np.ndarray:
    pooled = clean + toxic
    prior = p.prior * pooled / max(pooled.sum(), 1)
    a, b = toxic + prior, clean + prior
    with np.errstate(divide="ignore", invalid="ignore"):
        delta = np.log(a / (toxic.sum() + p.prior - a)) - np.log(b / (clean.sum() + p.prior - b))
        z = delta / np.sqrt(1 / a + 1 / b)
    return (np.where((pooled > 0) & (np.abs(z) >= p.z), delta, 0.0) - p.drift).astype(np.float32)


def decay(weights: np.ndarray, clean: np.ndarray) -> float:
    """lambda: the positive root of sum(p exp(lambda w)) = 1."""
    share = (clean + 1e-9) / (clean + 1e-9).sum()
    w = weights.astype(float)
    if not (w > 0).any() or float(share @ w) >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    f = lambda x: float(share @ np.exp(np.minimum(x * w, 600))) - 1
    while f(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return high


def isotonic(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Rising probabilities per bin; empty bins lie between their neighbours."""
    rate = (toxic.sum() + 1) / (toxic.sum() + clean.sum() + 2)
    full = np.flatnonzero(toxic + clean)
    if not len(full) or not toxic.sum() or not clean.sum():
        return np.full(len(toxic), rate)
    pools: list[list[float]] = []                        # [toxic, all, bins]
    for i in full:
        pools.append([toxic[i] + rate, toxic[i] + clean[i] + 1.0, 1])   # one text's worth of the base rate
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            t, n, k = pools.pop()
            pools[-1] = [pools[-1][0] + t, pools[-1][1] + n, pools[-1][2] + k]
    level = np.concatenate([[t / n] * k for t, n, k in pools])
    at = np.arange(len(toxic))
    return np.clip(np.interp(at, full, level) + 1e-4 * (at / len(at) - 0.5), 0.0, 1.0)  # rises strictly


def learn(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Model:
    """Fit on the learning rows (see the module's text)."""
    rows = written(training_rows(docs, labels), "toxicity-train")
    clean, toxic = _counts(rows.where("part <> 4"), params.bits)
    weights = token_weights(clean, toxic, params)
    lam = decay(weights, clean)

    def run(batches):
        for b in batches:
            for c in small_batches(b):
                n, found = [], []
                for text in c.column("text").to_pylist():
                    w = weights[buckets(text, params.bits)]
                    n.append(max(len(w), 1))
                    found.append([s for _, _, s in segments(w)])
                yield pa.RecordBatch.from_arrays([c.column("toxic"), pa.array(n, pa.int64()),
                                                  pa.array(found, pa.list_(pa.float64()))], ["toxic", "n", "found"])
    held = written(with_package(rows.where("part = 4").select("text", "toxic")).mapInArrow(
        run, "toxic int, n long, found array<double>"), "toxicity-held")
    best = F.coalesce(F.array_max("found"), F.lit(0.0))
    fit = held.where("toxic = 0").agg(F.count(F.lit(1)), F.sum(F.col("n") * F.exp(-F.lit(lam) * best))).first()
    k = fit[0] / fit[1] if fit[0] and fit[1] else 1.0
    base = F.log(F.lit(k) * F.col("n"))
    other = F.aggregate(F.transform("found", lambda s: F.greatest(F.lit(lam) * s - base, F.lit(0.0))),
                        F.lit(0.0), lambda x, y: x + y) - F.greatest(F.lit(lam) * best - base, F.lit(0.0))
    at = F.least(F.greatest(F.floor((F.lit(lam) * best - base + F.when(F.size("found") > 1, other).otherwise(0.0)
                                     - LOWEST) / BIN), F.lit(0)), F.lit(BINS - 1))
    got = held.groupBy(at.alias("bin")).agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).toPandas()  # BINS rows
    t, n = np.zeros(BINS), np.zeros(BINS)
    t[got.bin.astype(int)], n[got.bin.astype(int)] = got.t, got.n
    return Model(params, weights, lam, k, isotonic(t, n - t))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted, passages`` (token ranges and E-values of the
    significant passages) of every row. Narrow."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("e", pa.float64())]))

    def run(batches):
        for b in batches:
            for c in small_batches(b):
                got = [model.score(t) for t in c.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [c.column("doc_id"), pa.array([g[0] for g in got], pa.float64()),
                     pa.array([int(g[0] >= 0.5) for g in got], pa.int32()),
                     pa.array([[{"start": x, "end": y, "e": e} for x, y, e in g[1]] for g in got], kind)],
                    ["doc_id", "score", "predicted", "passages"])
    return with_package(texts(docs)).mapInArrow(
        run, "doc_id long, score double, predicted int, passages array<struct<start:long,end:long,e:double>>")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs``, all columns, without the rows whose score reaches one half."""
    def run(batches):
        for b in batches:
            for c in small_batches(b):
                keep = [model.score(t)[0] < 0.5 for t in c.column("text").to_pylist()]
                yield c.filter(pa.array(keep, pa.bool_()))
    return with_package(docs).mapInArrow(run, docs.schema)
