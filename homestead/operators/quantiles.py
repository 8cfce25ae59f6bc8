"""Exact per-group quantiles that stay distributed when one group is huge.

Spark's exact ``percentile`` aggregate merges every distinct value of a group
into one buffer in one task — unbounded when a city holds a third of all
rows. Here sketches say where the wanted ranks lie, and only the values there
are ranked:

1. Every task sketches its values of a group (KLL, mergeable, bounded); the
   merged sketch gives each probability a *bracket*: two values that hold its
   ranks between them but for a small probability.
2. A second read counts the values of a group below, between and above the
   brackets and keeps those inside, one hash aggregate: what is outside
   collapses to one row per group, gap and task before the shuffle.
3. The kept values (about ``2 · SLACK`` of the group per probability) are
   range-partitioned by (group, value) into "blocks", so a hot group spreads over
   many. Block ids are fixed by a reliable ``checkpoint()`` (shared
   ``spark.checkpoint.dir``), also if executors are lost and tasks rerun.
4. Per (block, group) totals — at most #groups + #blocks rows — give each
   block's rank offset; running counts inside the few blocks that hold a wanted
   rank pick its value.
5. A picked value that does not lie in its bracket shows that the sketch missed.
   Such a group is done again with all its values kept. So are all groups where
   they are too many for their brackets to be broadcast (measured bytes).
6. Box statistics judge the values by the fences in a third read, again one hash
   aggregate (or, with all values kept, block by block).

The value table is never shuffled on the group. NULL and NaN values are skipped,
NULL groups dropped. These functions run jobs (the checkpoints) and read their
input two or three times: give them a table, or a derivation written before. The
frames they return are lazy.

Interpolation: ``linear`` is R type 7 (Spark ``percentile``, DuckDB
``quantile_cont``); ``midpoint`` is type 5 (h = n·p + 0.5), the default of
common box-plot libraries.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.text import nan_to_null
from ..session import ensure_checkpoint_dir
from .keyed import broadcast_fits, row_bytes

#: Size parameter of a sketch (some 100 kB per group and task) and the part of a
#: group's ranks that a bracket reaches to either side: beyond twice the sketch's
#: rank error, 2.3 / k ** 0.9.
SKETCH_K = 4096
SLACK = 0.003


def _positions(n, p: float, method: str):
    """1-based fractional position h of probability p in n sorted values."""
    if method == "linear":
        h = (n - 1) * F.lit(p) + 1
    elif method == "midpoint":
        h = F.least(F.greatest(n * F.lit(p) + 0.5, F.lit(1.0)), n.cast("double"))
    else:
        raise ValueError(f"unknown method {method!r}")
    lo = F.floor(h).cast("long")
    hi = F.least(F.ceil(h).cast("long"), n)
    return lo, hi, h - lo


def _values(df: DataFrame, group: str, value: str) -> DataFrame:
    """``g, v``: the values that count, under names of our own."""
    v = F.col(value)
    if dict(df.dtypes)[value] in ("double", "float"):
        v = nan_to_null(v.cast("double"))
    return df.select(F.col(group).alias("g"), v.alias("v")).filter(F.col("v").isNotNull() & F.col("g").isNotNull())


def _small(df: DataFrame, *cols: str) -> tuple[DataFrame, bool]:
    """Checkpoint a summary; and whether its measured bytes allow a broadcast."""
    ensure_checkpoint_dir(df.sparkSession)
    obs = Observation("summary")
    df = df.observe(obs, F.sum(row_bytes(*(cols or df.columns))).alias("bytes")).checkpoint(eager=True)
    return df, broadcast_fits(df.sparkSession, int(obs.get["bytes"] or 0))


def _maybe_broadcast(df: DataFrame, fits: bool) -> DataFrame:
    return F.broadcast(df) if fits else df


def value_blocks(counted: DataFrame) -> DataFrame:
    """``(g, v, c, blk)``: distinct values with multiplicity, range-partitioned
    by (g, v); ``blk`` is the partition id, fixed by a reliable checkpoint."""
    ensure_checkpoint_dir(counted.sparkSession)
    return (counted.select("g", "v", "c").repartitionByRange("g", "v")
                   .withColumn("blk", F.spark_partition_id()).checkpoint(eager=True))


def block_summary(blocks: DataFrame) -> tuple[DataFrame, bool]:
    """Per (block, group): values ``bc``, smallest and largest value, values of the
    group in the blocks before (``off``) and in all (``n``). At most #groups +
    #blocks rows, computed and checkpointed once."""
    per_block = blocks.groupBy("blk", "g").agg(F.sum("c").alias("bc"), F.min("v").alias("least"), F.max("v").alias("most"))
    wg = Window.partitionBy("g").orderBy("blk")
    return _small(per_block.withColumns({
        "off": F.coalesce(F.sum("bc").over(wg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"),
        "n": F.sum("bc").over(Window.partitionBy("g")).cast("long"),
    }))


def brackets(values: DataFrame, probs: Sequence[float]) -> tuple[DataFrame, bool]:
    """Per group: its number of values ``n`` and for each probability (rising)
    the ends ``lo<j>``, ``hi<j>`` of a bracket, as doubles; and whether they may be broadcast."""
    sketched = values.groupBy("g").agg(F.kll_sketch_agg_double(F.col("v").cast("double"), SKETCH_K).alias("sketch"),
                                       F.count(F.lit(1)).alias("n"))
    at = [0.0, 1.0]                                   # the ranks asked of a sketch are literals
    for p in probs:
        at += [max(p - SLACK, 0.0), min(p + SLACK, 1.0)]
    found = sketched.select("g", "n", F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, at))).alias("ends"))
    few = F.col("n") <= SKETCH_K                      # a rank is a large part of a small group: it is kept whole
    return _small(found.select("g", "n", *[
        F.when(few, F.get("ends", F.lit(side))).otherwise(F.get("ends", F.lit(2 + 2 * j + side))).alias(f"{end}{j}")
        for j in range(len(probs)) for side, end in enumerate(("lo", "hi"))]))


def split_by_brackets(values: DataFrame, bracketed: DataFrame, m: int) -> tuple[DataFrame, DataFrame]:
    """The kept values with their multiplicity (``g, v, c``), and ``bracketed``
    with the number ``skip<j>`` of values outside all brackets and below bracket j."""
    x = F.col("v").cast("double")
    gap = sum((F.when(x > F.col(f"hi{j}"), 1).otherwise(0) for j in range(m)), F.lit(0))    # brackets that end below x
    inside = F.lit(False)
    for j in range(m):
        inside = inside | x.between(F.col(f"lo{j}"), F.col(f"hi{j}"))
    cells = (values.join(F.broadcast(bracketed), "g")
                   .select("g", gap.alias("gap"), F.when(inside, F.col("v")).alias("v"))
                   .groupBy("g", "gap", "v").agg(F.count(F.lit(1)).alias("c")).checkpoint(eager=True))
    skipped = cells.filter(F.col("v").isNull()).groupBy("g").agg(*[
        F.sum(F.when(F.col("gap") <= j, F.col("c"))).alias(f"skip{j}") for j in range(m)])
    known = bracketed.join(skipped, "g", "left").fillna(0, [f"skip{j}" for j in range(m)])
    return cells.filter(F.col("v").isNotNull()), known


def quantiles_from_blocks(blocks: DataFrame, summary: DataFrame, summary_fits: bool, probs: Sequence[float],
                          method: str, known: DataFrame | None = None) -> DataFrame:
    """``g, n, q<j>, found``: the quantiles per group from ``value_blocks`` and
    ``block_summary``. With ``known`` (see ``split_by_brackets``) the blocks hold
    the values inside brackets only, and ``found`` counts the ranks (two for each
    probability) whose value lies in its bracket: with all of them the row is exact."""
    if known is not None:
        summary = summary.drop("n").join(known, "g")
    n, wanted = F.col("n"), []
    for j, p in enumerate(probs):
        lo, hi, frac = _positions(n, p, method)
        skip = F.col(f"skip{j}") if known is not None else F.lit(0).cast("long")
        ends = [F.col(f"{end}{j}") if known is not None else F.lit(None).cast("double") for end in ("lo", "hi")]
        wanted += [F.struct(F.lit(j).alias("j"), F.lit(side).alias("side"), (rank - skip).alias("rank"),
                            frac.alias("frac"), ends[0].alias("least"), ends[1].alias("most"))
                   for side, rank in ((0, lo), (1, hi))]
    # each block picks the wanted ranks of its group that lie in it: no join
    inside = F.filter(F.array(*wanted), lambda w: (w["rank"] > F.col("off")) & (w["rank"] <= F.col("off") + F.col("bc")))
    targets = summary.withColumn("wanted", inside).filter(F.size("wanted") > 0).select("blk", "g", "off", "n", "wanted")
    wb = (Window.partitionBy("blk", "g").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = (blocks.join(_maybe_broadcast(targets, summary_fits), on=["blk", "g"])
                    .withColumn("r_hi", F.col("off") + F.sum("c").over(wb))
                    .withColumn("r_lo", F.col("r_hi") - F.col("c") + 1))
    covered = F.filter("wanted", lambda w: (w["rank"] >= F.col("r_lo")) & (w["rank"] <= F.col("r_hi")))
    hits = ranked.select("g", "n", F.col("v").alias("x"), F.inline(covered))
    real = F.col("x").cast("double")
    aggs = [F.first("n").alias("n"), F.count(F.when(F.coalesce(real.between(F.col("least"), F.col("most")), F.lit(True)),
                                                    1)).alias("found")]
    for j in range(len(probs)):
        x0 = F.max(F.when((F.col("j") == j) & (F.col("side") == 0), F.col("x")))
        x1 = F.max(F.when((F.col("j") == j) & (F.col("side") == 1), F.col("x")))
        fr = F.max(F.when(F.col("j") == j, F.col("frac")))
        aggs.append((x0 + fr * (x1 - x0)).alias(f"q{j}"))
    return hits.groupBy("g").agg(*aggs)


def _all_blocks(values: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
    """Blocks of all values, and their summary."""
    blocks = value_blocks(values.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c")))
    return blocks, *block_summary(blocks)


def _guided(values: DataFrame, probs: Sequence[float], method: str, bracketed: DataFrame) -> DataFrame:
    """``g, n, q<j>`` by way of brackets that may be broadcast."""
    kept, known = split_by_brackets(values, bracketed, len(probs))
    blocks = value_blocks(kept)
    found, _ = _small(quantiles_from_blocks(blocks, *block_summary(blocks), probs, method, known))
    good = found.filter(F.col("found") == 2 * len(probs)).drop("found")
    missed = bracketed.select("g").join(good, "g", "left_anti").checkpoint(eager=True)
    if missed.isEmpty():
        return good
    again = values.join(F.broadcast(missed), "g", "left_semi")
    return good.unionByName(quantiles_from_blocks(*_all_blocks(again), probs, method).drop("found"))


def _rising(probs: Sequence[float], names: Sequence[str]) -> tuple[list[float], list[str]]:
    pairs = sorted(zip(probs, names))
    return [p for p, _ in pairs], [n for _, n in pairs]


def exact_quantiles(df: DataFrame, group: str, value: str, probs: Sequence[float],
                    names: Sequence[str] | None = None, method: str = "linear") -> DataFrame:
    """One row per group with the exact quantiles of ``value`` (NULL and NaN
    skipped) and ``n`` (the values counted)."""
    names = list(names or [f"q{int(round(p * 100)):02d}" for p in probs])
    rising, rising_names = _rising(probs, names)
    values = _values(df, group, value)
    bracketed, fits = brackets(values, rising)
    q = _guided(values, rising, method, bracketed) if fits else quantiles_from_blocks(*_all_blocks(values), rising, method)
    return q.select(F.col("g").alias(group), "n", *[F.col(f"q{rising_names.index(name)}").alias(name) for name in names])


def _fences(q: DataFrame, whisker: float) -> tuple[DataFrame, bool]:
    iqr = F.col("q2") - F.col("q0")
    return _small(q.select("g", "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"),
                           (F.col("q0") - whisker * iqr).alias("lo_fence"), (F.col("q2") + whisker * iqr).alias("hi_fence")))


def _judged_values(values: DataFrame, fences: DataFrame, fit: bool) -> DataFrame:
    """Whiskers and outliers per group in one read of the values."""
    v = F.col("v")
    inside = v.between(F.col("lo_fence"), F.col("hi_fence"))
    return values.join(_maybe_broadcast(fences.select("g", "lo_fence", "hi_fence"), fit), "g").groupBy("g").agg(
        F.min(F.when(inside, v)).alias("lower_whisker"), F.max(F.when(inside, v)).alias("upper_whisker"),
        F.count(F.when(~inside, 1)).alias("n_outliers"))


def _judged_blocks(blocks: DataFrame, summary: DataFrame, summary_fits: bool, fences: DataFrame, fit: bool) -> DataFrame:
    """The same from blocks of all values: whole blocks are judged by their
    smallest and largest value, only those that a fence cuts are read again."""
    own = _maybe_broadcast(fences.select("g", "lo_fence", "hi_fence"), fit)
    judged = summary.select("blk", "g", "bc", "least", "most").join(own, "g")
    lo, hi = F.col("lo_fence"), F.col("hi_fence")
    all_in = (F.col("least") >= lo) & (F.col("most") <= hi)
    all_out = (F.col("most") < lo) | (F.col("least") > hi)
    none = F.lit(None).cast(blocks.schema["v"].dataType)
    whole = judged.filter(all_in | all_out).select(
        "g", F.when(all_in, F.col("least")).otherwise(none).alias("lower"),
        F.when(all_in, F.col("most")).otherwise(none).alias("upper"),
        F.when(all_in, F.lit(0)).otherwise(F.col("bc")).cast("long").alias("out"))
    cut = judged.filter(~(all_in | all_out)).select("blk", "g", "lo_fence", "hi_fence")   # two blocks of a group at most
    v = F.col("v")
    inside = (v >= lo) & (v <= hi)
    read_again = blocks.join(_maybe_broadcast(cut, summary_fits and fit), ["blk", "g"]).groupBy("blk", "g").agg(
        F.min(F.when(inside, v)).alias("lower"), F.max(F.when(inside, v)).alias("upper"),
        F.coalesce(F.sum(F.when(~inside, F.col("c"))), F.lit(0)).cast("long").alias("out")).drop("blk")
    return whole.unionByName(read_again).groupBy("g").agg(
        F.min("lower").alias("lower_whisker"), F.max("upper").alias("upper_whisker"), F.sum("out").alias("n_outliers"))


def box_stats(df: DataFrame, group: str, value: str, method: str = "linear",
              whisker: float = 1.5) -> DataFrame:
    """Box-plot statistics per group: quartiles, whiskers (furthest values
    within ``whisker``·IQR of the box) and the number of outliers. The
    quartiles are computed and written once."""
    probs = [0.25, 0.5, 0.75]
    values = _values(df, group, value)
    bracketed, fits = brackets(values, probs)
    if fits:
        fences, fences_fit = _fences(_guided(values, probs, method, bracketed), whisker)
        stats = _judged_values(values, fences, fences_fit)
    else:
        kept = _all_blocks(values)
        fences, fences_fit = _fences(quantiles_from_blocks(*kept, probs, method), whisker)
        stats = _judged_blocks(*kept, fences, fences_fit)
    return fences.drop("lo_fence", "hi_fence").join(_maybe_broadcast(stats, fences_fit), on="g").withColumnRenamed("g", group)
