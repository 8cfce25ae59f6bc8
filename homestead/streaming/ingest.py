"""Incremental bronze -> silver -> gold with Structured Streaming.

``readStream`` picks up only files not yet recorded in the checkpoint. With
``trigger(availableNow=True)`` a scheduled run processes everything that has
landed since the last run in bounded micro-batches and stops; a rerun with
nothing new adds nothing. Every sink is idempotent: a micro-batch writes its own
``batch=<id>`` directory, which a replay overwrites, and its gold upsert, which
compares crawls by recency, carries the batch id with the published version, so
a replay does not publish twice.

Silver keeps every crawl, in whatever order files arrive. Micro-batches are
written by landing day under a ``rebalance`` hint, which Spark plans from the
batch's measured rows (one writer a day, several for a large one), and sorted by
crawl date, so the files' statistics prune dates without a directory for each.
Corrupt lines go to a quarantine table in the same pass.

``first_per_key_stream`` emits each key once from Spark's keyed state (RocksDB),
by a built-in operator: no key goes through Python. The state holds one moment
per key and forgets it after ``keep_days``, so it is bounded by the keys of that
time, not by all output so far.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators.keyed import latest_per_key
from ..plans.etl import GOLD_BUCKETS, plan_gold_merge, publish_gold
from ..plans.gold import GOLD_INPUT
from ..plans.silver import bronze_to_silver, narrow, widen
from ..session import settings
from ..sources.bronze import corrupt_rows
from ..sources.tables import last_note, make_dir, names_in, partition_days, put_text

#: Files of one micro-batch.
MAX_FILES = 1000
#: Most tasks that read one file.
MAX_READERS = 16
#: Shuffled bytes of a writer of silver, which derives its rows.
WRITER_BYTES = "16m"
#: Days that the state of ``first_per_key_stream`` keeps a key.
KEEP_DAYS = 400
#: Keys are held in RocksDB; a micro-batch stores its changes. A window over a stream is one over each micro-batch by itself,
#: which Spark refuses as it may not be what was meant: here it is.
STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
         "spark.sql.streaming.unsupportedOperationCheck": "false"}
#: When a row's micro-batch was made.
NOW = "_now"


def bronze_stream(spark: SparkSession, root: str, max_files_per_trigger: int = MAX_FILES, **options: str) -> DataFrame:
    """Landed documents with their landing day ``load`` (from the path);
    ``options`` are the scan's. A compressed file cannot be split: a micro-batch
    of fewer files than cores is read by several tasks a file, each of which
    decompresses all of it, which is little, and parses its share of the lines."""
    lines = (spark.readStream.schema("value string, dt date")
             .option("maxFilesPerTrigger", max_files_per_trigger).options(**options).text(root))
    readers = min(MAX_READERS, max(1, spark.sparkContext.defaultParallelism // max_files_per_trigger))
    share = F.pmod(F.xxhash64("value"), F.lit(readers))
    return reduce(DataFrame.unionByName, [parsed(lines.filter(share == i)) for i in range(readers)])


def parsed(lines: DataFrame) -> DataFrame:
    """Bronze documents of JSON ``lines``, with their ``load``, as the JSON scan
    reads them: a line may be a list of documents, and is corrupt as a whole.
    (Where a text should be and an object is, its text has no blanks here.)"""
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    one = F.array(F.from_json("value", S.BRONZE_SCHEMA, how))
    pieces = F.from_json("value", "array<string>")
    found = F.transform(pieces, lambda p: F.from_json(p, S.BRONZE_SCHEMA, how))
    bad = F.when(F.exists(found, lambda d: d.isNull() | d["_corrupt_record"].isNotNull()), F.col("value"))
    listed = F.transform(found, lambda d: F.struct(*[(bad if c == "_corrupt_record" else d[c]).alias(c) for c in S.BRONZE_SCHEMA.fieldNames()]))
    is_list = F.col("value").rlike(r"^\s*\[") & pieces.isNotNull()
    docs = lines.select(F.explode(F.when(is_list, listed).otherwise(one)).alias("doc"), F.col("dt").alias("load"))
    return docs.select("doc.*", "load")


def _run(writer, **trigger: bool) -> None:
    query = writer.trigger(**trigger or {"availableNow": True}).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _good(bronze: DataFrame) -> DataFrame:
    return bronze_to_silver(bronze.filter(F.col("_corrupt_record").isNull()), keep=("load",))


def _write_silver(batch: DataFrame, number: int, silver_path: str, quarantine: str | None) -> str:
    """The micro-batch's silver rows as its own directory of the table."""
    at = f"{silver_path.rstrip('/')}/batch={number}"
    rows = narrow(batch.filter(F.col("_corrupt_record").isNull()), keep=("load",)).hint("rebalance", "load")
    with settings(batch.sparkSession, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": WRITER_BYTES}):
        widen(rows, keep=("load",)).sortWithinPartitions("load", "dt").write.mode("overwrite").partitionBy("load").parquet(at)
    if quarantine is not None:
        corrupt_rows(batch).write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch={number}")
    return at


def ingest_bronze_stream(spark: SparkSession, bronze_root: str, silver_path: str,
                         checkpoint: str, max_files_per_trigger: int = MAX_FILES,
                         quarantine: str | None = None) -> None:
    """Run one availableNow pass of bronze -> silver and wait for it."""
    def write(batch: DataFrame, number: int) -> None:
        _write_silver(batch, number, silver_path, quarantine)
    _run(bronze_stream(spark, bronze_root, max_files_per_trigger).writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint))


def upsert_batch(silver: DataFrame, number: int, gold_root: str, stream: str = "bronze", loaded_at=None,
                 n_buckets: int = GOLD_BUCKETS) -> bool:
    """Upsert one micro-batch's silver rows (with ``load``) into gold by
    recency, once: False if this batch of this stream is in gold already."""
    spark = silver.sparkSession
    done = last_note(spark, gold_root, stream=stream)
    if done is not None and done["batch"] >= number:
        return False
    plan = plan_gold_merge(spark, None, gold_root, loaded_at=loaded_at, n_buckets=n_buckets, recency=True,
                           silver=silver.select(*GOLD_INPUT, "load"))
    if plan.buckets:
        publish_gold(spark, plan, gold_root, n_buckets, note={"stream": stream, "batch": number})
    return True


def stream_to_gold(spark: SparkSession, bronze_root: str, silver_path: str, gold_root: str, checkpoint: str,
                   max_files_per_trigger: int = MAX_FILES, quarantine: str | None = None, stream: str = "bronze",
                   loaded_at=None, n_buckets: int = GOLD_BUCKETS) -> None:
    """One availableNow pass of bronze -> silver -> gold and wait for it: each
    micro-batch is kept in silver and upserted into gold from there. An upsert
    rewrites the buckets that it touches, soon all of gold; it therefore takes
    all micro-batches not yet in gold, and waits until they are as many as those
    in it or the pass ends: gold is rewritten a logarithmic number of times. What
    a lost pass left in silver only, the next one upserts."""
    schema = _good(bronze_stream(spark, bronze_root)).schema

    def upsert_pending(session: SparkSession, last: int | None = None) -> None:
        """Upsert the kept micro-batches that gold lacks, once they are as many
        as those it holds; without ``last`` (the newest one) in any case."""
        done = last_note(session, gold_root, stream=stream)
        held = 0 if done is None else done["batch"] + 1
        kept = sorted(n for n in map(int, partition_days(session, silver_path, "batch")) if n >= held and (last is None or n <= last))
        if kept and (last is None or len(kept) >= held):
            silver = session.read.schema(schema).option("basePath", silver_path).parquet(
                *[f"{silver_path.rstrip('/')}/batch={n}" for n in kept])
            upsert_batch(silver, kept[-1], gold_root, stream, loaded_at, n_buckets)

    def write(batch: DataFrame, number: int) -> None:
        _write_silver(batch, number, silver_path, quarantine)
        upsert_pending(batch.sparkSession, number)
    _run(bronze_stream(spark, bronze_root, max_files_per_trigger).writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    upsert_pending(spark)


def _first_per_key(rows: DataFrame, key: str, keep_ms: int) -> DataFrame:
    """Of each micro-batch one row a key, the first by all columns; then those
    whose key Spark's keyed state does not hold. The event time is that of the
    micro-batch, as it is logged: a key leaves the state when the watermark, half
    of ``keep_ms`` behind, has come to the key's own time and half of it more."""
    now = latest_per_key(rows, [key], order_by=[]).withColumn(NOW, F.current_timestamp())
    half = f"{keep_ms // 2} milliseconds"
    return now.withWatermark(NOW, half).dropDuplicatesWithinWatermark([key])


def first_per_key_stream(spark: SparkSession, bronze_root: str, out_path: str, checkpoint: str,
                         key: str = S.GOLD_KEY, max_files_per_trigger: int = MAX_FILES,
                         keep_days: float = KEEP_DAYS) -> None:
    """One availableNow pass that writes each key's first arrival once (of one
    micro-batch, the first by all columns). A key that arrives again more than
    ``keep_days`` after its first arrival is written again (keys are forgotten as
    a pass begins, and behind its micro-batches); rows without a key are not
    written. Nothing is compared with crawl dates, so no late row is lost."""
    ticks = f"{checkpoint.rstrip('/')}/ticks"
    keep_ms = int(keep_days * 86_400_000)

    def write(batch: DataFrame, number: int) -> None:
        batch.filter(F.col(key).isNotNull()).drop(NOW).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch={number}")

    def run(files: dict[str, str], empty: bool = False, **trigger: bool) -> None:
        with settings(spark, {**STATE, "spark.sql.streaming.noDataMicroBatches.enabled": str(empty).lower()}):
            bronze = bronze_stream(spark, bronze_root, max_files_per_trigger, **files)
            silver = _good(bronze).filter(F.col(key).isNotNull())
            # a tick is a row of nulls: it moves the watermark and is not written
            moved = silver.unionByName(spark.readStream.schema(silver.schema).json(ticks))
            _run(_first_per_key(moved, key, keep_ms).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), **trigger)
    begun, done = ([int(n) for n in names_in(spark, f"{checkpoint.rstrip('/')}/{log}") if n.isdecimal()] for log in ("offsets", "commits"))
    make_dir(spark, ticks)
    if begun:
        if max(begun) > max(done, default=-1):
            run({}, once=True)              # only the micro-batch that a lost pass left, with its files
        # a tick without bronze, and the empty micro-batch behind it, in which keys that are too old by now go
        put_text(spark, f"{ticks}/{os.urandom(8).hex()}.json", "{}")
        run({"pathGlobFilter": "no file"}, empty=True)
    run({})
