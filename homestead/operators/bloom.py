"""Blocked Bloom filter over key columns, in DataFrame expressions.

A batch's keys set four bits of one 64-bit word each; words lie in blocks of 64,
one row a block. The filter is built by two hash aggregates (bitwise or, map-side
combined) and applied to a large table by a broadcast join on the block number
and one bit test, so that only rows whose key the batch may hold go on to a
shuffle. It lets through every row with a batch key and a few others: an exact
join must follow.

The number of blocks is the largest power of two whose rows fit the session's
broadcast threshold, whatever the batch: a batch beyond some 4 million keys at
10 MB fills the filter up and lets more rows through, but broadcasts no more.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .keyed import ROW_OVERHEAD, broadcast_fits

WORDS = 64                                # 64-bit words of a block
BLOCK_BYTES = ROW_OVERHEAD + 8 + 8 * WORDS
MOST_BLOCKS = 1 << 20

_HASHED_ALIKE = (T.StringType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DateType(),
                 T.TimestampType(), T.TimestampNTZType(), T.BinaryType(), T.BooleanType())


def block_count(spark) -> int:
    """Blocks that may be broadcast, 0 where broadcasts are off or too small."""
    n = MOST_BLOCKS
    while n and not broadcast_fits(spark, n * BLOCK_BYTES):
        n >>= 1
    return n


def can_filter(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> bool:
    """Whether equal keys have equal hashes: the same type on both sides, one
    whose equal values are spelt alike."""
    return all(target.schema[k].dataType == batch.schema[k].dataType and target.schema[k].dataType in _HASHED_ALIKE
               for k in keys)


def _place(keys: Sequence[str], blocks: int) -> tuple[Column, Column, Column]:
    """Block, word in the block and bits of a key. The hash's bits 0 to 23
    choose the four bits, 24 to 29 the word, those from 30 on the block."""
    h = F.xxhash64(*keys)
    bits = F.lit(0).cast("long")
    for shift in (0, 6, 12, 18):
        at = F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return (F.shiftrightunsigned(h, 30).bitwiseAND(F.lit(blocks - 1).cast("long")),
            F.shiftrightunsigned(h, 24).bitwiseAND(F.lit(WORDS - 1).cast("long")).cast("int"), bits)


def build(batch: DataFrame, keys: Sequence[str], blocks: int) -> DataFrame:
    """``block, words``: one row per block that a key falls into."""
    block, word, bits = _place(keys, blocks)
    held = batch.select(block.alias("block"), word.alias("word"), bits.alias("bits")) \
        .groupBy("block", "word").agg(F.bit_or("bits").alias("bits"))
    by_word = F.map_from_entries(F.collect_list(F.struct("word", "bits")))           # 64 entries at most
    filled = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)),
                         lambda i: F.coalesce(F.try_element_at("by_word", i), F.lit(0).cast("long")))
    return held.groupBy("block").agg(by_word.alias("by_word")).select("block", filled.alias("words"))


def may_hold(target: DataFrame, batch: DataFrame, keys: Sequence[str], blocks: int | None = None) -> DataFrame:
    """The key columns of the rows of ``target`` whose key ``batch`` may hold:
    all that it holds, a few others, none with a NULL key. Without a filter
    (key types differ, broadcasts are off) all rows with a key."""
    present = target.select(*keys).dropna(subset=list(keys))
    blocks = block_count(target.sparkSession) if blocks is None else blocks
    if not blocks or not can_filter(target, batch, keys):
        return present
    held = F.broadcast(build(batch.select(*keys).dropna(subset=list(keys)), keys, blocks))
    block, word, bits = _place(keys, blocks)
    marked = present.select(*keys, block.alias("_block"), word.alias("_word"), bits.alias("_bits"))
    return marked.join(held, marked["_block"] == held["block"]) \
        .where(F.get("words", F.col("_word")).bitwiseAND(F.col("_bits")) == F.col("_bits")).select(*keys)
