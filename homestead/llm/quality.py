"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements
and one long whose bit i is set where rule i fails; the text is not needed
again; ``stored`` writes it. A policy is a versioned bitmask (any of these bits rejects), so applying
a policy is one bitwise AND, and ablations (what a rule rejects alone, what
would return without it) are aggregates over the distinct masks, which number
2^rules at most.

Rules and bits are listed in RULES; their order is part of the format and is
only ever appended to.

Cases: null or empty text has no words (all measurements 0) and fails the word
count; repeated rows get equal entries; an empty table gives an empty ledger;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, texts, with_package, written

SPACE = re.compile(r"[\x20\x09-\x0D]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")
LETTERS = re.compile(r"[^\W\d_]")

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words",
            "n_upper", "longest_word")


def measure(text: str | None) -> tuple[int, ...]:
    """The values of MEASURES."""
    text = text or ""
    words = [w for w in SPACE.split(text) if w]
    n = len(words)
    if not n:
        return (0,) * len(MEASURES)
    sizes = np.fromiter(map(len, words), np.int64, n)
    ids: dict[str, int] = {}
    at = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    repeat = 0
    if n >= 4:
        # a window is its first two words' pair number and its third word; numbers stay below n
        _, pair = np.unique(at[:-1] * len(ids) + at[1:], return_inverse=True)
        _, window, count = np.unique(pair[:-1] * len(ids) + at[2:], return_inverse=True, return_counts=True)
        twice = np.flatnonzero(count[window] > 1)
        covered = np.zeros(n + 1, np.int64)
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + 3, -1)
        repeat = int((np.cumsum(covered[:n]) > 0).sum())
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if SPACE.sub("", line):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    return (n, int(sizes.sum()), len(SYMBOLS.findall(text)), dup, repeat, lines,
            sum(1 for w in words if LETTERS.search(w)), sum(map(str.isupper, words)), int(sizes.max()))


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[], Column]


def _c(name: str) -> Column:
    return F.col(name)


# Bit i belongs to rule i. Thresholds compare whole numbers.
RULES = (
    Rule("too_few_words", lambda: _c("n_words") < 50),
    Rule("repeated_windows", lambda: 100 * _c("n_repeat_words") > 50 * _c("n_words")),
    Rule("too_many_words", lambda: _c("n_words") > 1_000_000),
    Rule("short_words", lambda: _c("word_chars") < 2 * _c("n_words")),
    Rule("long_words", lambda: _c("word_chars") > 15 * _c("n_words")),
    Rule("symbols", lambda: 10 * _c("n_symbols") > _c("n_words")),
    Rule("repeated_lines", lambda: 100 * _c("n_dup_lines") > 30 * _c("n_lines")),
    Rule("few_letter_words", lambda: 100 * _c("n_letter_words") < 70 * _c("n_words")),
    Rule("shouting", lambda: 100 * _c("n_upper") > 50 * _c("n_words")),
    Rule("endless_word", lambda: _c("longest_word") > 1_000),
)
BIT = {r.name: 1 << i for i, r in enumerate(RULES)}
BASE = BIT["too_few_words"] | BIT["repeated_windows"]

#: Versioned policies: the bits that reject. Versions are never changed, only added.
POLICIES: dict[str, int] = {
    "v1": BASE,
    "v2": (1 << len(RULES)) - 1,
}


def ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measurements and ``failures`` (the bitmask), one row per
    document. Narrow; every rule is evaluated once."""
    def run(batches):
        for whole in batches:
            for b in small_batches(whole):
                got = np.array([measure(t) for t in b.column("text").to_pylist()], np.int64).reshape(-1, len(MEASURES))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c) for c in got.T)],
                                                 ["doc_id", *MEASURES])
    schema = ", ".join(["doc_id long", *(f"{m} long" for m in MEASURES)])
    bits = F.lit(0).cast("long")
    for r in RULES:
        bits = bits.bitwiseOR(F.when(r.fails(), F.lit(BIT[r.name]).cast("long")).otherwise(F.lit(0).cast("long")))
    return with_package(texts(docs)).mapInArrow(run, schema).withColumn("failures", bits)


def stored(docs: DataFrame) -> DataFrame:
    """The ledger, written once: policies and ablations read its bits, no text."""
    return written(ledger(docs), "quality-ledger")


def apply_policy(book: DataFrame, policy: int | str) -> DataFrame:
    """The ledger with ``kept``: no bit of the policy is set."""
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    return book.withColumn("kept", F.col("failures").bitwiseAND(F.lit(mask).cast("long")) == 0)


def ablation(book: DataFrame, policy: int | str) -> DataFrame:
    """Per rule of the policy: ``rule, fails`` (documents that fail it),
    ``alone`` (fail no other rule of the policy: they would return without
    it), ``kept_without``. One aggregation to the distinct masks, then
    bitwise sums over those few rows."""
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    masks = book.groupBy(F.col("failures").bitwiseAND(F.lit(mask).cast("long")).alias("m")).agg(F.count(F.lit(1)).alias("n"))
    rules = [F.struct(F.lit(r.name).alias("rule"), F.lit(BIT[r.name]).cast("long").alias("bit"))
             for r in RULES if BIT[r.name] & mask]
    each = masks.select("m", "n", F.explode(F.array(*rules)).alias("r")).select("m", "n", "r.rule", "r.bit")
    hit, other = F.col("m").bitwiseAND(F.col("bit")) != 0, F.col("m").bitwiseAND(F.bitwise_not("bit"))
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(hit & (other == 0), F.col("n")).otherwise(0)).alias("alone"),
        F.sum(F.when(other == 0, F.col("n")).otherwise(0)).alias("kept_without"))
