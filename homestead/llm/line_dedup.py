"""Line deduplication: sorted line hashes in, per-document keep bitmaps out.

1. Each text becomes one row per long enough line: a 128-bit hash of the line's
   key (stripped, A-Z lower-cased), the document and the line's position. No
   text moves.
2. The rows are range-partitioned by (hash, document) and sorted by hash,
   document from the largest id down, and position. A line that a third of all
   documents hold thus spreads over many partitions.
3. Each partition is streamed once: the first document of a hash keeps its
   lines, those of the others go once a third document has shown up. What a
   partition cannot know - the hash that it begins with may have begun before
   it, the one that it ends with may go on - it passes on with a count and the
   largest id; there are two such summaries a partition at most.
4. Dropped positions are sorted by document and become one compressed bitmap
   per document that loses lines.

Texts meet their bitmaps by (doc_id, hash of the text), not by a row number, so
no scan has to be split the same way twice.

Cases: a null or empty text is one empty line; keys shorter than ``min_chars``
code points never go; rows that repeat a doc_id are one document when holders
are counted, and each keeps a text of its own; rows with a null doc_id are
together one document, below all others; repeated lines in one document count
once and go or stay together; an empty table gives no rows; other columns are
ignored (``drop_repeated_lines`` keeps them).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settings
from .common import small_batches, unused, with_package, written

BLANK = b" \t\n\x0b\x0c\r"
LINE = "hi long, lo long, doc_id long, text_key long, pos long"
INSIDE, OPEN, SUMMARY = 0, 1, 2
#: Texts become Python strings in pieces of this many bytes.
PIECE_BYTES = 2 << 20
#: The work tables' rows go to Python and back in batches of this many.
NARROW_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def line_keys(text: str | None, min_chars: int) -> tuple[list[int], list[bytes]]:
    """Positions and 128-bit hashes of the lines whose key is long enough."""
    pos, keys = [], []
    for i, line in enumerate((text or "").encode().lower().split(b"\n")):
        key = line.strip(BLANK)
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
            pos.append(i)
            keys.append(xxhash.xxh3_128_digest(key))
    return pos, keys


def line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """``hi, lo, doc_id, text_key, pos``: one row per long enough line. Narrow."""
    return with_package(_keyed(docs)).mapInArrow(lambda batches: hashed(batches, min_chars), LINE)


def hashed(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """``line_rows`` of batches, a piece of texts at a time."""
    for whole in batches:
        for b in small_batches(whole, limit=PIECE_BYTES):
            pos, keys, sizes = [], [], []
            for t in b.column("text"):
                p, k = line_keys(t.as_py(), min_chars)
                pos += p
                keys += k
                sizes.append(len(p))
            take = pa.array(np.repeat(np.arange(b.num_rows), sizes))
            both = np.frombuffer(b"".join(keys), ">i8").astype(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1]), b.column("doc_id").take(take),
                 b.column("text_key").take(take), pa.array(pos, pa.int64())],
                ["hi", "lo", "doc_id", "text_key", "pos"])


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("text_key"))


class _Stream:
    """One partition's rows in order of (hi, lo, doc_id from the largest, pos)."""

    COLUMNS = ("hi", "lo", "doc", "null", "key", "pos")

    def __init__(self, min_docs: int) -> None:
        self.min_docs = min_docs
        self.last = None                # the last row so far
        self.first_run = True           # still inside the partition's first hash
        self.docs = 0                   # documents of the open run so far
        self.top = None                 # its largest: (doc, null)
        self.held: list[dict] = []      # its rows that go once enough documents are seen

    def feed(self, rows: dict):
        """(status, rows) pieces that the next rows settle."""
        n = len(rows["hi"])
        prior = self.last or {c: rows[c][:1] for c in self.COLUMNS}
        back = {c: np.r_[prior[c], rows[c][:-1]] for c in ("hi", "lo", "doc", "null")}
        new_run = (rows["hi"] != back["hi"]) | (rows["lo"] != back["lo"])
        new_doc = new_run | (rows["doc"] != back["doc"]) | (rows["null"] != back["null"])
        if self.last is None:
            new_run[0] = new_doc[0] = True
        starts = np.flatnonzero(new_run)
        edges = np.unique(np.r_[0, starts])
        total = np.cumsum(new_doc)
        out = self._step(rows, 0, int(np.r_[edges, n][1]), total, new_doc, bool(new_run[0]))
        if len(edges) > 1:
            out += self._whole(rows, edges[1:], total) + self._step(rows, int(edges[-1]), n, total, new_doc, True)
        return out

    def _step(self, rows: dict, a: int, b: int, total: np.ndarray, new_doc: np.ndarray, begins: bool):
        """Rows a to b belong to one hash, whose rows may go on before or behind."""
        out = []
        if begins:
            out += self._close(first=self.last is None)
            self.top = rows["doc"][a], rows["null"][a]
        rank = total[a:b] - (total[a] - new_doc[a]) + self.docs         # of each row's document in its run, from 1
        piece = {c: rows[c][a:b] for c in self.COLUMNS}
        self.docs = int(rank[-1])
        self.last = {c: rows[c][b - 1:b] for c in self.COLUMNS}
        if self.first_run:
            return [*out, (OPEN, piece)]
        self.held.append({c: piece[c][rank > 1] for c in self.COLUMNS})
        if self.docs >= self.min_docs:
            out += [(INSIDE, x) for x in self.held]
            self.held = []
        return out

    def _whole(self, rows: dict, edges: np.ndarray, total: np.ndarray):
        """Runs that begin and end between the first and the last of ``edges``."""
        out = self._close()
        sizes = np.diff(edges)
        rank = total[edges[0]:edges[-1]] - np.repeat(total[edges[:-1]], sizes) + 1
        docs = np.repeat(rank[edges[1:] - 1 - edges[0]], sizes)
        gone = np.flatnonzero((rank > 1) & (docs >= self.min_docs)) + edges[0]
        return [*out, (INSIDE, {c: rows[c][gone] for c in self.COLUMNS})]

    def _close(self, first: bool = False):
        """The open run ends inside the partition."""
        out = self._summary() if self.first_run and not first else []
        self.first_run = first
        self.docs, self.held = 0, []
        return out

    def _summary(self):
        doc, null = self.top
        return [(SUMMARY, {**self.last, "doc": np.array([doc]), "null": np.array([null]),
                           "pos": np.array([self.docs])})]

    def end(self):
        """What the next partitions must settle."""
        if self.last is None:
            return []
        return self._summary() + [(OPEN, x) for x in self.held]


def settle(rows: DataFrame, min_docs: int) -> DataFrame:
    """``kind`` and the columns of ``rows`` for rows range-partitioned and
    sorted as the module says: kind 0 is a dropped line, 1 a line of an edge
    hash, 2 a summary of an edge hash (documents in ``pos``, the largest in ``doc_id``)."""
    def run(batches):
        stream = _Stream(min_docs)
        for b in batches:
            if b.num_rows:
                yield from emit(stream.feed(_arrays(b)))
        yield from emit(stream.end())

    def emit(pieces):
        pieces = [(k, x) for k, x in pieces if len(x["hi"])]
        if not pieces:
            return
        kind = np.concatenate([np.full(len(x["hi"]), k, np.int32) for k, x in pieces])
        col = {c: np.concatenate([x[c] for _, x in pieces]) for c in _Stream.COLUMNS}
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind), pa.array(col["hi"]), pa.array(col["lo"]), pa.array(col["doc"], mask=col["null"]),
             pa.array(col["key"]), pa.array(col["pos"].astype(np.int64))],
            ["kind", "hi", "lo", "doc_id", "text_key", "pos"])
    return with_package(rows).mapInArrow(run, "kind int, " + LINE)


def _arrays(b: pa.RecordBatch) -> dict:
    doc = b.column("doc_id")
    return {"hi": b.column("hi").to_numpy(), "lo": b.column("lo").to_numpy(),
            "doc": doc.fill_null(0).to_numpy(), "null": doc.is_null().to_numpy(zero_copy_only=False),
            "key": b.column("text_key").to_numpy(), "pos": b.column("pos").to_numpy()}


def dropped_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc_id, text_key, pos`` of every line that goes."""
    with settings(docs.sparkSession, NARROW_BATCHES):
        rows = written(line_rows(docs, min_chars), "line-hashes")   # read twice: for the bounds, and to be dealt out
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["hi", "lo", F.col("doc_id").desc_nulls_last()]
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order, "text_key", "pos")
    with settings(docs.sparkSession, NARROW_BATCHES):
        found = written(settle(dealt, min_docs), "line-decisions")
    edges = found.where(F.col("kind") == SUMMARY).groupBy("hi", "lo").agg(
        F.sum("pos").alias("docs"), F.max("doc_id").alias("top")).where(F.col("docs") >= min_docs)
    # two summaries a partition at most: the bound of what is broadcast
    late = found.where(F.col("kind") == OPEN).join(F.broadcast(edges), ["hi", "lo"]).where(
        ~F.col("doc_id").eqNullSafe(F.col("top")))
    return found.where(F.col("kind") == INSIDE).select("doc_id", "text_key", "pos").union(
        late.select("doc_id", "text_key", "pos"))


def pack(dropped: np.ndarray) -> bytes:
    """Keep bitmap up to the last dropped line (later lines stay), compressed."""
    keep = np.ones(int(dropped[-1]) + 1, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes(), 6)


def unpack(bitmap: bytes, seen: int, n_lines: int) -> np.ndarray:
    """Keep flag of each of ``n_lines`` lines from a bitmap of the first ``seen``."""
    keep = np.ones(n_lines, bool)
    keep[:seen] = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=seen)
    return keep


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc_id, text_key, n_lines_seen, n_dropped, keep`` for each text that
    loses lines: ``keep`` is a zlib-compressed bitmap of the lines up to the
    last one that goes (``n_lines_seen`` of them); all lines behind it, and all
    lines of a text without a row, stay. ``text_key`` is xxhash64 of the text."""
    lines = dropped_lines(docs, min_chars, min_docs)
    ordered = lines.repartition("doc_id", "text_key").sortWithinPartitions("doc_id", "text_key", "pos")

    def run(batches):
        carry = None
        for b in batches:
            if not b.num_rows:
                continue
            doc, key, pos = (b.column(c) for c in ("doc_id", "text_key", "pos"))
            cols = [doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False), key.to_numpy(), pos.to_numpy()]
            if carry is not None:
                cols = [np.concatenate(x) for x in zip(carry, cols)]
            new = np.flatnonzero(np.r_[True, (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
                                       | (cols[2][1:] != cols[2][:-1])])
            yield batch(cols, new[:-1], new[1:])
            carry = [x[new[-1]:] for x in cols]                  # the last document may go on
        if carry is not None:
            yield batch(carry, np.array([0]), np.array([len(carry[0])]))

    def batch(cols, starts, ends):
        doc, null, key, pos = cols
        gone = [np.unique(pos[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[starts], mask=null[starts]), pa.array(key[starts]),
             pa.array([int(x[-1]) + 1 for x in gone], pa.int64()), pa.array([len(x) for x in gone], pa.int64()),
             pa.array([pack(x) for x in gone], pa.binary())],
            ["doc_id", "text_key", "n_lines_seen", "n_dropped", "keep"])
    return with_package(ordered).mapInArrow(
        run, "doc_id long, text_key long, n_lines_seen long, n_dropped long, keep binary")


def drop_repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with the lines that stay as ``text`` (never null), and two more
    columns (named longer where taken): ``n_lines`` before and ``n_dropped``."""
    lines = keep_bitmaps(docs, min_chars, min_docs)
    with settings(docs.sparkSession, NARROW_BATCHES):
        bitmaps = written(lines, "line-bitmaps")
    n_lines, n_dropped = unused(docs, "n_lines"), unused(docs, "n_dropped")
    own = docs.withColumn("text", F.col("text").cast("string"))
    meet = bitmaps.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"),
                          F.struct("n_lines_seen", "n_dropped", "keep").alias("map"))
    at = own.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                    F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("key"))
    joined = at.join(meet, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("key") == F.col("_key")), "left").select("row", "map")

    def run(batches):
        for whole in batches:
            for b in small_batches(whole, "row", PIECE_BYTES):
                rows = b.column("row")
                maps = b.column("map").to_pylist()
                text_at = [f.name.lower() for f in rows.type].index("text")
                fields = rows.flatten()
                kept, before, gone = [], [], []
                for text, m in zip(fields[text_at], maps):
                    text = text.as_py() or ""
                    n = text.count("\n") + 1
                    if m:
                        keep = unpack(m["keep"], m["n_lines_seen"], n)
                        text = "\n".join([x for x, k in zip(text.split("\n"), keep.tolist()) if k])
                    kept.append(text)
                    before.append(n)
                    gone.append(m["n_dropped"] if m else 0)
                fields[text_at] = pa.array(kept, pa.string())
                names = [rows.type.field(i).name for i in range(rows.type.num_fields)]
                yield pa.RecordBatch.from_arrays([*fields, pa.array(before, pa.int64()), pa.array(gone, pa.int64())],
                                                 [*names, n_lines, n_dropped])
    return with_package(joined).mapInArrow(run, _ddl(own) + f", `{n_lines}` long, `{n_dropped}` long")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
