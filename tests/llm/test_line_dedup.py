import hashlib

import numpy as np
import pyarrow as pa
import pytest

from homestead.llm import line_dedup
from helpers import ODD, PROSE, empty, in_files, odd_documents

SPACE = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, min_chars=20, min_docs=3):
    """[(doc_id, n_lines, n_dropped, kept text)] of (doc_id, text) rows."""
    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key_of(line)) >= min_chars:
                holders.setdefault(key_of(line), set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            own = holders.get(key_of(line), set()) if len(key_of(line)) >= min_chars else set()
            largest = max((x for x in own if x is not None), default=None)
            if len(own) < min_docs or d == largest:
                kept.append(line)
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(docs, **kw):
    got = line_dedup.drop_repeated_lines(docs, **kw)
    return sorted([(r.doc_id, r[got.columns.index("n_lines")], r.n_dropped, r.text) for r in got.collect()], key=repr)


COMMON = "This very common line appears in many documents."
MORE = [COMMON + "\nown " * 3, "  " + COMMON.upper() + "\t\r\nx", f"a\n{COMMON}\nb\n{COMMON}", f"{COMMON}\n{COMMON}",
        "only in two documents, so it stays\nz", "q\nonly in two documents, so it stays", "ünïcödé lines of 20 cp",
        "Ünïcödé lines of 20 cp", "ünïcödé LINES of 20 cp\n", "漢" * 19 + "\n" + "漢" * 20, "漢" * 20, "漢" * 20 + "\n" + "漢" * 19,
        "\n".join([PROSE] * 40), PROSE + "\n" + PROSE]


def test_against_brute_force(spark):
    docs = odd_documents(spark, MORE)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = line_dedup.drop_repeated_lines(docs)
    assert got.columns == docs.columns + ["n_lines", "n_dropped"]
    assert found(docs) == brute(rows)
    assert any(r[2] for r in brute(rows))


def test_hot_line_over_many_partitions(spark, tmp_path):
    rng = np.random.default_rng(5)
    lines = [f"line number {i} of a long list of lines" for i in range(300)]
    rows = []
    for d in range(3000):
        own = [lines[i] for i in rng.zipf(1.3, 4) % 300] + [f"line that document {d} alone has"]
        rows.append((int(d), "\n".join([COMMON, *own] if d % 3 == 0 else own)))
    docs = in_files(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "hot"))
    assert found(docs) == brute(rows)
    assert found(docs, min_chars=40, min_docs=5) == brute(rows, 40, 5)
    assert found(docs, min_docs=2) == brute(rows, 20, 2)


def test_null_and_repeated_ids(spark):
    text = COMMON + "\nsecond line, which is long enough too"
    rows = [(None, text), (None, text), (1, text), (1, text), (1, "x\n" + text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == brute(rows)                     # two documents only
    rows.append((2, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(docs)
    assert got == brute(rows) and sum(r[2] for r in got) == 10


def test_clashing_columns_types_and_empty(spark):
    docs = spark.createDataFrame([(i, COMMON, "a", [1], 7, 3, None) for i in range(4)],
                                 "doc_id int, text string, map string, row array<int>, n_lines int, keep int, doc string")
    got = line_dedup.drop_repeated_lines(docs)
    assert got.columns == docs.columns + ["n_lines_", "n_dropped"]
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == [
        (0, "", 7, 1), (1, "", 7, 1), (2, "", 7, 1), (3, COMMON, 7, 0)]
    assert line_dedup.drop_repeated_lines(empty(spark, docs)).count() == 0
    assert line_dedup.keep_bitmaps(empty(spark, docs)).count() == 0


def test_bitmaps_round_trip(spark):
    for gone, n in (([0], 1), ([7], 9), ([0, 8, 15], 16), ([3, 64], 1000)):
        keep = line_dedup.unpack(line_dedup.pack(np.array(gone)), gone[-1] + 1, n)
        assert np.flatnonzero(~keep).tolist() == gone and len(keep) == n
    long = "\n".join([f"line {i} of a very long text of many lines" for i in range(100_000)])
    docs = spark.createDataFrame([(i, long) for i in range(3)], "doc_id long, text string")
    rows = line_dedup.keep_bitmaps(docs).collect()
    assert sorted((r.doc_id, r.n_dropped) for r in rows) == [(0, 100_000), (1, 100_000)]
    assert all(len(r.keep) < 200 for r in rows)           # compressed, and no text


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_stream_settles_alike_for_any_batches(size):
    """Batch ends anywhere, partitions cut anywhere between documents."""
    rng = np.random.default_rng(size)
    rows = sorted(((int(h), 0, int(d), int(p)) for h, d, p in zip(rng.integers(0, 9, 300), rng.integers(0, 30, 300), range(300))),
                  key=lambda r: (r[0], -r[2], r[3]))
    cuts = [0] + sorted({i for i in rng.integers(1, 300, 4) if rows[i][:3] != rows[i - 1][:3]}) + [len(rows)]
    pieces = []
    for a, b in zip(cuts, cuts[1:]):
        stream = line_dedup._Stream(3)
        for i in range(a, b, size):
            part = np.array(rows[i:min(b, i + size)])
            pieces += stream.feed({"hi": part[:, 0], "lo": part[:, 1], "doc": part[:, 2], "null": np.zeros(len(part), bool),
                                   "key": part[:, 2], "pos": part[:, 3]})
        pieces += stream.end()
    sums = {}
    for k, x in pieces:
        if k == line_dedup.SUMMARY:
            docs, top = sums.get(int(x["hi"][0]), (0, -1))
            sums[int(x["hi"][0])] = docs + int(x["pos"][0]), max(top, int(x["doc"][0]))
    gone = []
    for k, x in pieces:
        for h, d, p in zip(x["hi"].tolist(), x["doc"].tolist(), x["pos"].tolist()):
            if k == line_dedup.INSIDE or k == line_dedup.OPEN and sums[h][0] >= 3 and d != sums[h][1]:
                gone.append(p)
    holders = {}
    for h, _, d, _ in rows:
        holders.setdefault(h, set()).add(d)
    assert sorted(gone) == sorted(p for h, _, d, p in rows if len(holders[h]) >= 3 and d != max(holders[h]))


def test_query_digest(spark):
    docs = odd_documents(spark, MORE)
    from pyspark.sql import functions as F
    got = line_dedup.drop_repeated_lines(docs).select(F.sha2("text", 256).alias("h"), "text").collect()
    assert all(r.h == hashlib.sha256(r.text.encode()).hexdigest() for r in got)
    assert len(got) == len(ODD) + len(MORE) + 3


def test_texts_of_a_batch_become_strings_piece_by_piece():
    import tracemalloc
    text = "\n".join(f"line {i} of some length or other" for i in range(60))
    n = 8000                                                     # 15 MB of text
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([text] * n), pa.array([7] * n, pa.int64())],
                                       ["doc_id", "text", "text_key"])
    tracemalloc.start()
    rows = sum(b.num_rows for b in line_dedup.hashed(iter([batch]), 20))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 60 * n and most < batch.nbytes
