import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from helpers import PROSE, empty, in_files, odd_documents, remainder, splits, words
from homestead.llm import ppm


class Brute:
    def __init__(self, texts):
        self.trie = defaultdict(Counter)
        self.count = Counter()
        for t in texts:
            self.count.update([*words(t), None])
            b = b"\n" * 4 + " ".join(words(t)).encode() + b"\n"
            for p in range(4, len(b)):
                for j in range(5):
                    self.trie[b[p - j:p]][b[p]] += 1
        self.n, self.v = sum(self.count.values()), len(self.count)

    def log10(self, ctx, s):
        out, gone = 0.0, set()
        for j in range(4, -1, -1):
            seen = self.trie.get(ctx[4 - j:])
            rest = {k: v for k, v in (seen or {}).items() if k not in gone}
            if rest:
                total = sum(rest.values())
                if s in rest:
                    return out + math.log10((rest[s] - 0.5) / total)
                out += math.log10(0.5 * len(rest) / total)
            gone |= set(seen or {})
        return out - math.log10(256 - len(gone))

    def score(self, t):
        b = b"\n" * 4 + " ".join(words(t)).encode() + b"\n"
        return sum(self.log10(b[p - 4:p], b[p]) for p in range(4, len(b)))

    def base(self, t):
        return sum(math.log10((self.count[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in [*words(t), None])


def check(rows, docs, model):
    want = sorted(((r.doc_id, len(words(r.text)) + 1, sum(model.count[w] > 0 for w in [*words(r.text), None]), model.n,
                    round(model.base(r.text), 6), round(model.score(r.text), 6)) for r in docs), key=str)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                  for r in rows), key=str)
    assert got == want


def test_scores_equal_brute_force(spark):
    docs = odd_documents(spark, [PROSE.replace("fox", "vixen"), "zzz qqq"])
    rows = docs.collect()
    model = Brute([r.text for r in rows if remainder(r.doc_id) != 1])
    for size in (1 << 20, 300):                                   # one bucket, many buckets
        check(ppm.score_documents(docs, ppm.learning_rows(), size).collect(), rows, model)


def test_long_texts_in_pieces(spark, monkeypatch):
    docs = spark.createDataFrame([(0, PROSE * 3), (1, "other words " * 30), (2, "x")], "doc_id long, text string")
    whole = [np.sort(ppm._grams([x for _, ps in ppm._streams([words_b]) for x in ps])[0])
             for words_b in ([w.encode() for w in words(r.text)] for r in docs.collect())]
    monkeypatch.setattr(ppm, "PIECE", 50)
    monkeypatch.setattr(ppm, "CHUNK", 120)
    for r, want in zip(docs.collect(), whole):
        parts = [ppm._grams(ps)[0] for _, ps in ppm._streams([[w.encode() for w in words(r.text)]])]
        assert np.array_equal(np.sort(np.concatenate(parts)), want)


def test_probabilities_sum_to_one():
    body = b"\n\n\n\n" + PROSE.encode() + b"\n"
    g, _ = ppm._grams([body])
    keys, counts = np.unique(g, return_counts=True)
    pairs = np.zeros((256, 256), np.int64)
    np.add.at(pairs, ((g >> 8) & 255, g & 255), 1)
    trie = ppm.Trie(keys, counts, pairs)
    for ctx in (b"the ", b"\n\n\n\n", b"qzqz", b" the", b"zzze"):
        head = int.from_bytes(ctx, "big") << 8
        assert abs((10 ** trie.log10(head + np.arange(256))).sum() - 1) < 1e-9


def test_nothing_to_learn_from(spark):
    docs = odd_documents(spark)
    rows = docs.collect()
    check(ppm.score_documents(docs, F.lit(False)).collect(), rows, Brute([]))
    assert ppm.score_documents(empty(spark, docs), ppm.learning_rows()).collect() == []


def test_scores_hold_when_the_splits_change(spark, tmp_path):
    docs = in_files(spark, spark.createDataFrame([(i, f"{PROSE[i:i + 90]} {i * i} own") for i in range(40)],
                                                 "doc_id long, text string"), str(tmp_path / "docs"))
    rows = docs.collect()
    model = Brute([r.text for r in rows if remainder(r.doc_id) != 1])
    with splits(spark, 1):
        scores = ppm.score_documents(docs, ppm.learning_rows(), 300)
    with splits(spark, 6):
        check(scores.collect(), rows, model)


def test_scores_hold_for_tries_of_few_contexts(spark, monkeypatch):
    docs = odd_documents(spark, [PROSE, "zzz qqq"])
    rows = docs.collect()
    model = Brute([r.text for r in rows if remainder(r.doc_id) != 1])
    for strings in (1, 40):
        monkeypatch.setattr(ppm, "TRIE_STRINGS", strings)
        check(ppm.score_documents(docs, ppm.learning_rows(), 300).collect(), rows, model)
