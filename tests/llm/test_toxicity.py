import random

import numpy as np
import pytest

from helpers import PROSE, empty, odd_documents, remainder
from homestead.llm import toxicity as T


def brute_segments(s):
    """Ruzzo and Tompa's definition: take a best subsequence (shortest, first),
    then go on left and right of it."""
    def best(lo, hi):
        out = None
        for a in range(lo, hi):
            total = 0.0
            for b in range(a, hi):
                total += s[b]
                if total > 0 and (out is None or total > out[0] + 1e-12 or (abs(total - out[0]) <= 1e-12 and b + 1 - a < out[2] - out[1])):
                    out = (total, a, b + 1)
        return [] if out is None else [*best(lo, out[1]), (out[1], out[2], out[0]), *best(out[2], hi)]
    return best(0, len(s))


def test_segments_against_definition():
    rnd = random.Random(4)
    for _ in range(300):
        s = np.array([rnd.choice([-3.0, -1.5, -0.7, 0.9, 2.3, 4.1]) + rnd.random() * 1e-3 for _ in range(rnd.randrange(0, 25))])
        got = T.segments(s)
        want = brute_segments(s.tolist())
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([x for *_, x in got], [x for *_, x in want])


def test_isotonic():
    toxic, clean = np.array([0, 1, 0, 5, 0, 9]), np.array([9, 5, 6, 5, 0, 1])
    c = T.isotonic(toxic, clean)
    assert (np.diff(c) > 0).all() and 0 <= c.min() and c.max() <= 1
    assert len(set(T.isotonic(np.zeros(4), np.ones(4)))) == 1


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    bad = ["badword", "nastier", "foulest"]
    rows, marks = [], []
    for i in range(900):
        w = [rnd.choice(vocab) for _ in range(rnd.randrange(20, 120))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                w.insert(rnd.randrange(len(w)), rnd.choice(bad))
        rows.append((i, " ".join(w)))
        marks.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, corpus):
    docs, marks = corpus
    model = T.learn(docs, marks)
    got = {r.doc_id: r for r in T.score_documents(docs, model).collect()}
    held = [i for i in got if remainder(i) == 0]
    right = sum(got[i].predicted == int(i % 6 == 0) for i in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    kept = {r.doc_id for r in T.drop_toxic(docs, model).collect()}
    assert kept == {i for i, r in got.items() if not r.predicted}
    passages = T.score_documents(docs, model).where("predicted = 1").first()
    assert passages.passages and all(p.e <= model.params.max_e for p in passages.passages)


def test_held_out_labels_are_not_read(spark, corpus):
    docs, marks = corpus
    from pyspark.sql import functions as F
    flipped = marks.withColumn("toxic", F.when(T.remainder(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = T.learn(docs, marks), T.learn(docs, flipped)
    assert (a.weights == b.weights).all() and (a.lam, a.k) == (b.lam, b.k) and (a.curve == b.curve).all()


def test_odd_documents(spark):
    docs = odd_documents(spark)
    marks = spark.createDataFrame([(9, 0), (9, 1), (None, 1), (4, None), (7, 0), (10, 0), (11, 1)], "doc_id long, toxic int")
    model = T.learn(docs, marks)
    got = T.score_documents(docs, model).collect()
    assert len(got) == docs.count()
    by_text = {}
    for r in got:
        by_text.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_text[9]) == 1
    nothing = T.learn(docs, empty(spark, marks))
    scores = {round(r.score, 9) for r in T.score_documents(docs, nothing).collect()}
    assert len(scores) == 1
    assert T.score_documents(empty(spark, docs), model).collect() == []
    assert T.drop_toxic(docs, model).columns == docs.columns
    assert PROSE
