"""Sharding by jump consistent hashing, in DataFrame expressions alone.

The published loop draws numbers from a 64-bit linear congruential generator
seeded with the key and jumps to ever larger shard numbers; the last one below
the number of shards is the answer. No ring table exists, and going from n to
n + 1 shards moves a row only into shard n. The generator's wrap-around product
is put together from 16- and 32-bit limbs, which stay clear of overflow in ANSI
mode; the loop is a fold over n steps (each step raises the shard number, so n
steps are always enough).

Law ``key``: doc_id and the shard count decide, nothing else. Slots are gapless
without a one-task window over a shard: rows lie in the partitions of a
checkpointed ledger (ids, sizes and checksums, no text), a window numbers them
within (shard, partition), and the counts of the partitions before are added.

Cases: a null doc_id hashes as key 0; a null text has size 8 and the checksum of
no bytes (0); repeated rows get a slot each; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import texts

#: The generator's multiplier; fixed by the published function.
MULTIPLIER = 2862933555777941757
LOW = (1 << 32) - 1


def _step(hi: Column, lo: Column) -> tuple[Column, Column]:
    """(hi, lo) * MULTIPLIER + 1 modulo 2^64, as two unsigned 32-bit halves."""
    ch, cl = MULTIPLIER >> 32, MULTIPLIER & LOW
    low, high = lambda x: x.bitwiseAND(F.lit(0xFFFF)), lambda x: F.shiftright(x, 16)
    shifted = lambda x: F.shiftleft(x.bitwiseAND(F.lit(0xFFFF)), 16)
    p, q = low(lo) * F.lit(cl), high(lo) * F.lit(cl)                 # both below 2^48
    s = p + shifted(q) + F.lit(1)
    cross = (low(hi) * F.lit(cl) + shifted(high(hi) * F.lit(cl))
             + low(lo) * F.lit(ch) + shifted(high(lo) * F.lit(ch)))  # only its low half counts
    return (F.shiftright(s, 32) + F.shiftright(q, 16) + cross).bitwiseAND(F.lit(LOW)), s.bitwiseAND(F.lit(LOW))


def jump_hash(key: Column, shards: int) -> Column:
    """Shard number (int) of a long key."""
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))

    def jump(acc: Column, _: Column) -> Column:
        hi, lo = _step(acc["hi"], acc["lo"])
        b = acc["j"]                                                  # below the shard count here
        j = F.floor((b + F.lit(1)).cast("double")
                    * (F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + F.lit(1)).cast("double"))).cast("long")
        done = acc["j"] >= F.lit(shards)
        return F.struct(F.when(done, acc["hi"]).otherwise(hi).alias("hi"),
                        F.when(done, acc["lo"]).otherwise(lo).alias("lo"),
                        F.when(done, acc["b"]).otherwise(b).alias("b"),
                        F.when(done, acc["j"]).otherwise(j).alias("j"))
    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(LOW)).alias("lo"),
                     F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, jump, lambda acc: acc["b"]).cast("int")


def assign_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard`` (the shard when one more is appended). The ledger of ids is
    checkpointed in the shared folder, so its partitions stay what they are."""
    own = texts(docs)
    raw = F.coalesce(F.col("text"), F.lit(""))
    ledger = own.select(
        "doc_id", (F.octet_length(raw) + 8).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"),
        jump_hash(F.col("doc_id"), shards).alias("shard"),
        jump_hash(F.col("doc_id"), shards + 1).alias("grown_shard"),
        F.spark_partition_id().alias("part")).checkpoint()
    counts = ledger.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "part", (F.sum("n").over(
        Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    own_slot = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")) - 1
    return ledger.withColumn("own", own_slot).join(before, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("before") + F.col("own")).alias("slot"), "grown_shard")
