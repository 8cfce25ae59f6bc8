"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are normalised alike (lower case, every run of characters
other than letters and digits becomes one space). An item of m characters may
occur with k = floor(rate * m) edits. It is split into k + 1 pieces: k edits
cannot touch all of them, so every occurrence holds one piece exactly. One
Aho-Corasick automaton finds the piece hits of a block of items; a hit is then
verified with Myers' bit-parallel edit distance, climbing from the piece to the
whole item: any c neighbouring pieces must be found with at most c - 1 edits
(again by pigeonhole), so a chance hit ends after a few characters, and the
last step is the whole item with k edits.

Test items are normalised by tasks and stored in blocks of about a fixed number
of characters; a larger item table means more passes, never a larger automaton,
and the driver holds one block at a time. One block is one narrow pass; with
more, the documents are numbered in a work table and only hits are joined.

Cases: null or empty texts hold nothing; null or blank items match nothing;
items below ``min_chars`` normalised characters, down to a single one, match
whole words only, with the same edits a character; repeated items share one
entry and all their ids are reported; an item without an id counts like any
other and is reported with a null id, first; repeated documents are judged
alike; an empty benchmark leaves every document clean; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import small_batches, texts, unused, with_package, written

NOISE = re.compile(r"[\W_]+")


@dataclass(frozen=True)
class Params:
    rate: float = 0.1            # edits per character of an item
    min_chars: int = 25          # shorter items must stand as whole words
    block_chars: int = 4 << 20   # characters of items in one automaton


def normalise(text: str | None) -> str:
    return NOISE.sub(" ", (text or "").lower()).strip()


def best_distance(pattern: str, text: str, most: int, masks: dict[str, int] | None = None) -> int:
    """Least edit distance between ``pattern`` and any substring of ``text``;
    ``most + 1`` if it is above ``most`` (Myers, one machine integer of
    len(pattern) bits)."""
    m = len(pattern)
    if masks is None:
        masks = letter_masks(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, m
    get = masks.get
    for c in text:
        eq = get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(xh | plus)
        down = plus & xh
        if up & high:
            score += 1
        elif down & high:
            score -= 1
            if score < best:
                best = score
                if not best:
                    return 0
        up <<= 1
        plus = ((down << 1) | ~(xv | up)) & full
        minus = up & xv & full
    return best if best <= most else most + 1


def worded_distance(pattern: str, text: str, origin: int, most: int) -> int:
    """Least edit distance between ``pattern`` and a run of whole words of
    ``text`` that starts and ends within ``most`` characters of where the
    pattern would from ``origin``; ``most + 1`` if it is above ``most``."""
    lo, hi = max(0, origin - most), min(len(text), origin + len(pattern) + most)
    far = best = most + 1
    row = [(0 if not lo or text[lo - 1] == " " else far) + i for i in range(len(pattern) + 1)]
    for q in range(lo, hi):
        c = text[q]
        new = [0 if c == " " else row[0] + 1]
        for i, x in enumerate(pattern):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
        row = new
        if q + 1 == len(text) or text[q + 1] == " ":
            best = min(best, row[-1])
    return best


def letter_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


class Matcher:
    """The items of one block: ``{normalised text: [ids]}``; an id may be None."""

    def __init__(self, items: dict[str, list[int | None]], p: Params) -> None:
        self.items = [(t, ids) for t, ids in items.items() if t]
        self.worded = [len(t) < p.min_chars for t, _ in self.items]
        self.budget = [int(p.rate * len(t)) for t, _ in self.items]
        self.cuts: list[list[int]] = []
        self.spans: dict[tuple[int, int, int], dict[str, int]] = {}
        at: dict[str, list[tuple]] = {}
        for i, (t, _) in enumerate(self.items):
            n = self.budget[i] + 1
            cuts = [len(t) * j // n for j in range(n + 1)]
            self.cuts.append(cuts)
            for j in range(n):
                at.setdefault(t[cuts[j]:cuts[j + 1]], []).append((i, j, *self._near(t, cuts, j)))
        self.automaton = ahocorasick.Automaton()
        for piece, where in at.items():
            self.automaton.add_word(piece, (len(piece), where))
        if at:
            self.automaton.make_automaton()
        self.empty = not at

    @staticmethod
    def _path(n: int, j: int) -> list[tuple[int, int]]:
        """The nodes over piece j of n, from the whole item down, by halves."""
        path, a, b = [], 0, n
        while b - a > 1:
            path.append((a, b))
            mid = (a + b) // 2
            a, b = (a, mid) if j < mid else (mid, b)
        return path

    def _near(self, t: str, cuts: list[int], j: int) -> tuple[list[tuple[int, int, str]], int]:
        """A cheap test before the first verification: of the halves of the
        other pieces under piece j's lowest node, as many must stand close by
        unharmed as the node has edits (c - 1 edits, 2 (c - 1) halves)."""
        path = self._path(len(cuts) - 1, j)
        if not path:
            return [], 0
        a, b = path[-1]
        slack, halves = b - a - 1, []
        for x in range(a, b):
            if x != j:
                mid = (cuts[x] + cuts[x + 1]) // 2
                for lo, hi in ((cuts[x], mid), (mid, cuts[x + 1])):
                    halves.append((lo - cuts[j] - slack, hi - cuts[j] + slack, t[lo:hi]))
        return halves, slack

    def _distance(self, i: int, a: int, b: int, text: str, origin: int) -> int:
        """Edits of pieces a..b of item i near the place where the item would
        start at ``origin``; at most b - a - 1 count."""
        item, cuts = self.items[i][0], self.cuts[i]
        part, most = item[cuts[a]:cuts[b]], b - a - 1
        # edits before these pieces may have moved them by up to the whole budget
        slack = most
        window = text[max(0, origin + cuts[a] - slack):origin + cuts[b] + slack]
        masks = self.spans.get((i, a, b))
        if masks is None:
            masks = self.spans[i, a, b] = letter_masks(part)
        return best_distance(part, window, most, masks)

    def _climb(self, i: int, j: int, text: str, start: int) -> int | None:
        """Edits of the whole item, if the exact piece j at ``start`` belongs
        to an occurrence."""
        origin = start - self.cuts[i][j]
        n = self.budget[i] + 1
        path = self._path(n, j)
        for a, b in reversed(path):
            d = self._distance(i, a, b, text, origin)
            if d > b - a - 1:
                return None
        return d if path else 0

    def find(self, text: str) -> dict[int | None, int]:
        """Least number of edits by item id, for the items that occur."""
        out: dict[int | None, int] = {}
        if self.empty or not text:
            return out
        found: dict[int, int] = {}
        seen: set[tuple[int, int]] = set()
        for end, (size, where) in self.automaton.iter(text):
            start = end - size + 1
            for i, j, halves, least in where:
                if found.get(i) == 0:
                    continue
                if least:
                    here = 0
                    for lo, hi, half in halves:
                        if half in text[max(0, start + lo):max(0, start + hi)]:
                            here += 1
                            if here == least:
                                break
                    else:
                        continue
                key = i, start - self.cuts[i][j]
                if key in seen:                # this alignment of the item has been verified
                    continue
                d = self._climb(i, j, text, start)
                if d is not None and self.worded[i]:
                    d = worded_distance(self.items[i][0], text, key[1], self.budget[i])
                    if d > self.budget[i]:
                        continue
                if d is not None:
                    seen.add(key)
                    found[i] = min(d, found.get(i, d))
        for i, d in found.items():
            for x in self.items[i][1]:
                out[x] = min(d, out.get(x, d))
        return out


class Blocks(Sequence):
    """The items in blocks of about ``block_chars`` characters, on shared
    storage; only a block that is asked for comes to the driver."""

    def __init__(self, table: DataFrame, n: int) -> None:
        self.table, self.n = table, n

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, b: int) -> dict[str, list[int | None]]:
        if not 0 <= b < self.n:
            raise IndexError(b)
        items: dict[str, list[int | None]] = {}
        for r in self.table.where(F.pmod(F.xxhash64("text"), F.lit(self.n)) == b).orderBy("item_id", "text").collect():
            items.setdefault(r.text, []).append(r.item_id)
        return items


def item_blocks(benchmark: DataFrame, p: Params) -> Blocks:
    """Normalised by the tasks and written once; a block takes the items whose
    hash falls to it, so equal items share a block."""
    def run(batches):
        for whole in batches:
            for b in small_batches(whole):
                yield pa.RecordBatch.from_arrays(
                    [b.column("item_id"), pa.array([normalise(t) for t in b.column("text").to_pylist()], pa.string())],
                    ["item_id", "text"])
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where("text is not null")
    table = written(with_package(rows).mapInArrow(run, "item_id long, text string").where("text <> ''").distinct(),
                    "decontam-items")
    chars = table.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    return Blocks(table, max(1, -(-chars // p.block_chars)))


_MATCHERS: dict[str, Matcher] = {}


def _matcher(key: str, items, p: Params) -> Matcher:
    if key not in _MATCHERS:
        _MATCHERS.clear()                      # one at a time: bounded memory
        _MATCHERS[key] = Matcher(items, p)
    return _MATCHERS[key]


def _null_first(hit: tuple[int | None, int]) -> tuple[bool, int]:
    return hit[0] is not None, hit[0] or 0


ITEMS = "array<struct<item:long,edits:int>>"


def scan(docs: DataFrame, benchmark: DataFrame, name: str, p: Params = Params()) -> DataFrame:
    """``docs`` (all columns) with the new column ``name``: the items that
    occur, as (item, edits) in the order of the item ids."""
    blocks = item_blocks(benchmark, p)
    if len(blocks) > 1:
        return _scan_blocks(docs, blocks, name, p)
    kind = pa.list_(pa.struct([("item", pa.int64()), ("edits", pa.int32())]))
    out = with_package(docs).withColumn(name, F.lit(None).cast(ITEMS))

    def run(batches, items=blocks[0], key=uuid.uuid4().hex):
        own = _matcher(key, items, p)
        for whole in batches:
            for b in small_batches(whole):
                found = [sorted(own.find(normalise(t)).items(), key=_null_first) for t in b.column("text").to_pylist()]
                marks = pa.array([[{"item": i, "edits": e} for i, e in r] for r in found], kind)
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], marks], b.schema.names)
    return out.mapInArrow(run, out.schema)


def _scan_blocks(docs: DataFrame, blocks: Blocks, name: str, p: Params) -> DataFrame:
    """One pass for each block, so the driver and a task hold one block at a
    time; the passes store their hits under the documents' stored numbers."""
    spark, row = docs.sparkSession, unused(docs, "row")
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "decontam-rows")
    own_texts = with_package(rows).select(F.col(row).alias("row"), "text")
    path, schema = scratch_path(spark, "decontam-hits"), "row long, item long, edits int"
    for b in range(len(blocks)):
        def run(batches, items=blocks[b], key=uuid.uuid4().hex):
            own = _matcher(key, items, p)
            for whole in batches:
                for c in small_batches(whole):
                    hits = [(r, i, e) for r, t in zip(c.column("row").to_pylist(), c.column("text").to_pylist())
                            for i, e in own.find(normalise(t)).items()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([h[k] for h in hits], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32()))],
                        ["row", "item", "edits"])
        own_texts.mapInArrow(run, schema).write.mode("append").parquet(path)
    least = spark.read.schema(schema).parquet(path).groupBy("row", "item").agg(F.min("edits").alias("edits"))
    hits = least.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("item", "edits"))).alias(name)) \
        .withColumnRenamed("row", row)
    return rows.join(hits, row, "left").select(*docs.columns, F.coalesce(name, F.array().cast(ITEMS)).alias(name))


def contaminated(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """Per row: ``doc_id, contaminated, n_items, item_ids, edits``."""
    found = scan(texts(docs), benchmark, "items", p)
    return found.select("doc_id", (F.size("items") > 0).alias("contaminated"), F.size("items").alias("n_items"),
                        F.col("items.item").alias("item_ids"), F.col("items.edits").alias("edits"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs``, all columns, without the rows that hold an item."""
    name = unused(docs, "items")
    return scan(docs, benchmark, name, p).where(F.size(name) == 0).drop(name)
