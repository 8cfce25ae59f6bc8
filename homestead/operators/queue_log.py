"""The URL work queue as an append-only log with leases.

Every step appends one small committed version of events; nothing is rewritten.
The state of a url is folded from its events with mergeable aggregates:

* ``enqueue`` appends links as pending (the first such event of a url counts);
* ``take`` leases the oldest pending urls to an owner until a moment: a url with
  a live lease is not taken again, an expired one returns to the queue. The
  lease is published against the version that the take has read, so of two
  takes at once the later one sees the other's leases and plans again;
* ``land`` appends that urls have been crawled;
* ``compact`` folds all events into one version, from which readers start.

A batch costs what it holds; only a take and ``state`` read the log, which
compaction keeps at one row per url and the batches since.
"""

from __future__ import annotations

import datetime as _dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..sources.tables import PublishConflict, committed_versions, current_version, last_note, publish_version
from .keyed import one_per_key

EVENTS = "url string, queued boolean, created_at timestamp_ntz, crawled boolean, owner string, until timestamp_ntz"
ATTEMPTS = 20


def _events(df: DataFrame, queued=False, created_at=None, crawled=False, owner=None, until=None) -> DataFrame:
    """One event per url of ``df``; values are columns or constants."""
    def col(value, kind):
        return (value if not isinstance(value, (bool, str, type(None))) else F.lit(value)).cast(kind)
    return df.select("url", col(queued, "boolean").alias("queued"), col(created_at, "timestamp_ntz").alias("created_at"),
                     col(crawled, "boolean").alias("crawled"), col(owner, "string").alias("owner"),
                     col(until, "timestamp_ntz").alias("until"))


def _append(events: DataFrame, root: str, base: int | None = None, note: dict | None = None) -> str:
    """Publish a version of events; a plain append waits its turn."""
    for attempt in range(ATTEMPTS):
        try:
            return publish_version(events, root, base=base, note=note)
        except PublishConflict:
            if base is not None or attempt == ATTEMPTS - 1:
                raise
            time.sleep(0.2 * (attempt + 1))
    raise AssertionError("unreachable")


def _log(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """All events from the newest compaction on, with their version ``v``."""
    start = (last_note(spark, root, kind="compaction") or {"version": 1})["version"]
    paths = [f"{root.rstrip('/')}/v={v}" for v in committed_versions(spark, root) if v >= start and (upto is None or v <= upto)]
    schema = T.StructType([*T.StructType.fromDDL(EVENTS).fields, T.StructField("v", T.IntegerType())])
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def _folded(log: DataFrame) -> DataFrame:
    """One event per url that stands for all of its events."""
    lease = F.col("owner").isNotNull()
    held = F.max_by(F.struct("owner", "until"), F.when(lease, F.col("v")))
    return log.groupBy("url").agg(
        F.max("queued").alias("queued"), F.min_by("created_at", F.when(F.col("queued"), F.col("v"))).alias("created_at"),
        F.max("crawled").alias("crawled"), held.alias("held")).select(
        "url", "queued", "created_at", "crawled", F.col("held.owner").alias("owner"), F.col("held.until").alias("until"))


def enqueue(links: DataFrame, root: str, created_at=None) -> str:
    """Append links (``url``; ``created_at`` too unless given) as pending."""
    stamp = F.col("created_at") if created_at is None else F.lit(str(created_at)).cast("timestamp_ntz")
    rows = one_per_key(links.select("url", stamp.cast("timestamp_ntz").alias("created_at")), ["url"])
    return _append(_events(rows, queued=True, created_at=F.col("created_at")), root)


def land(urls: DataFrame, root: str) -> str:
    """Append that these urls have been crawled."""
    return _append(_events(one_per_key(urls.select("url"), ["url"]), crawled=True), root)


def state(spark: SparkSession, root: str) -> DataFrame:
    """The queue: ``url, status, created_at, owner, until`` (the last lease)."""
    known = _folded(_log(spark, root)).filter("queued")
    return known.select("url", F.when(F.col("crawled"), F.lit(S.CRAWLED)).otherwise(F.lit(S.PENDING)).alias("status"),
                        "created_at", "owner", "until")


def take(spark: SparkSession, root: str, n: int, owner: str, now: _dt.datetime, lease: _dt.timedelta) -> DataFrame:
    """Lease the next ``n`` urls, oldest first: ``url, created_at, owner,
    until``. Only the leases are written."""
    at, until = (F.lit(t).cast("timestamp_ntz") for t in (now, now + lease))
    for attempt in range(ATTEMPTS):
        base = current_version(spark, root)
        free = _folded(_log(spark, root, base)).filter(
            F.col("queued") & ~F.col("crawled") & F.coalesce(F.col("until") <= at, F.lit(True)))
        chosen = free.orderBy(F.col("created_at").asc_nulls_last(), F.col("url").asc()).limit(n)
        leases = _events(chosen, created_at=F.col("created_at"), owner=owner, until=until)
        try:
            path = _append(leases, root, base=base)
        except PublishConflict:
            time.sleep(0.2 * (attempt + 1))
            continue
        return spark.read.schema(EVENTS).parquet(path).select("url", "created_at", "owner", "until")
    raise PublishConflict(f"no turn to take from {root} in {ATTEMPTS} attempts")


def compact(spark: SparkSession, root: str) -> str:
    """Fold the log into one version; readers start there from now on. An
    append meanwhile makes it fail, to be run again."""
    base = current_version(spark, root)
    return _append(_folded(_log(spark, root, base)), root, base=base, note={"kind": "compaction", "version": base + 1})
