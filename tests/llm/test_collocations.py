import re
from collections import Counter

import numpy as np
import pytest

from homestead.llm import collocations
from helpers import PROSE, empty, in_files, odd_documents


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def count(rows, longest=3):
    f = {}
    for lang, text in rows:
        own = f.setdefault("und" if lang is None else lang, Counter())
        for p in pieces(text):
            for k in range(1, longest + 1):
                own.update(tuple(p[i:i + k]) for i in range(len(p) - k + 1))
    return f


def brute(rows, longest=3, least=10, top=2000):
    out = []
    for lang, f in count(rows, longest).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {}
        for p, a in f.items():
            if len(p) > 1 and a >= least:
                cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                cand[p] = a, f[p[:k]], f[p[k:]], n, score
        kept = [(p, v) for p, v in cand.items() if not any(
            len(q) > len(p) and 100 * cand[q][0] >= 50 * v[0] and any(q[i:i + len(p)] == p for i in range(len(q))) for q in cand)]
        kept.sort(key=lambda x: (-x[1][4], -x[1][0], " ".join(x[0]).encode()))
        out += [(lang, i + 1, " ".join(p), *v) for i, (p, v) in enumerate(kept[:top])]
    return sorted(out)


def found(docs, **kw):
    return sorted(tuple(r) for r in collocations.mine(docs, **kw).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def prose(rng, n, vocabulary):
    words = [f"w{i}" for i in range(vocabulary)]
    marks = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", " ! "]
    return "".join(words[i] + marks[m] for i, m in zip(rng.zipf(1.4, n) % vocabulary, rng.integers(0, len(marks), n)))


def test_odd_documents_against_brute_force(spark):
    docs = odd_documents(spark, ["New York, new york. NEW YORK is big " * 12, "is not new york city " * 15, "Ünï É new york"])
    assert found(docs, least=2) == brute([(r.lang, r.text) for r in docs.collect()], least=2)
    assert found(docs) == brute([(r.lang, r.text) for r in docs.collect()])


@pytest.mark.parametrize("hold", [200, 1 << 20])
def test_languages_hot_pair_and_spills(spark, tmp_path, hold):
    rng = np.random.default_rng(3)
    rows = [(["en", "en", "en", "de", None, "und", ""][i % 7], prose(rng, 300, 400)) for i in range(70)]
    rows += [("en", " ".join(f"very common pair x{i}" for i in range(j, j + 400))) for j in range(0, 4000, 200)]
    rows += [("en", None), ("fr", ""), ("fr", " . ")]
    docs = in_files(spark, spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "doc_id long, lang string, text string"),
                    str(tmp_path / f"docs{hold}"))
    assert found(docs, hold=hold) == brute(rows)
    assert found(docs, hold=hold, least=3, top=7) == brute(rows, least=3, top=7)
    assert found(docs, hold=hold, longest=2) == brute(rows, longest=2)


def test_more_languages_than_tries(spark):
    rows = [(f"l{i % 40}", "same words again and again here") for i in range(480)]
    docs = spark.createDataFrame([(1, a, b) for a, b in rows], "doc_id long, lang string, text string").coalesce(1)
    assert found(docs) == brute(rows)


def drain(trie, texts):
    runs = []
    for t in texts:
        runs += trie.add_text(t)
        if trie.size > 3000:
            runs += trie.spill(800)
    return runs + list(trie.end())


@pytest.mark.parametrize("stretch", [7, 64, 1 << 18])
def test_trie_bursts_spills_and_counts_all(monkeypatch, stretch):
    """Long texts in overlapping stretches, bursts at two depths, spilled
    subtrees: the runs add up to a plain count."""
    for name, value in (("STRETCH", stretch), ("BURST", 500), ("OWN_NODE", 20)):
        monkeypatch.setattr(collocations, name, value)
    rng = np.random.default_rng(stretch)
    texts = [prose(rng, 3000, 60) for _ in range(4)] + ["a", "", None, "a b", "x. y", "b\n"]
    trie = collocations.PhraseTrie("en", 13, 3)
    runs = drain(trie, texts)
    got, places = Counter(), {}
    for part, run in runs:
        lang, words, w, counts = collocations.read_run(run)
        assert lang == "en" and (np.lexsort(w[::-1]) == np.arange(len(counts))).all()      # a sorted run
        for *ids, c in zip(*w.tolist(), counts.tolist()):
            phrase = tuple(words[i - 1].decode() for i in ids if i)
            got[phrase] += c
            places.setdefault(phrase, set()).add(part)
    assert got == count([("en", t) for t in texts])["en"]
    assert all(len(p) == 1 for p in places.values())              # a phrase has one partition


def test_trie_is_deep_only_where_phrases_are_frequent(monkeypatch):
    monkeypatch.setattr(collocations, "BURST", 400)
    monkeypatch.setattr(collocations, "OWN_NODE", 50)
    monkeypatch.setattr(collocations, "STRETCH", 1000)
    trie = collocations.PhraseTrie("en", 4, 3)
    for _ in trie.add_text(" . ".join(f"hot pair t{i}" for i in range(2000)) + " . " + " . ".join(f"r{i} s" for i in range(300))):
        pass
    trie.count()
    hot = trie.root.children[trie.words[b"hot"]]
    assert trie.words[b"pair"] in hot.children and trie.words[b"r5"] not in trie.root.children


def test_ids_run_out(monkeypatch):
    monkeypatch.setattr(collocations, "MOST_WORDS", 40)
    monkeypatch.setattr(collocations, "STRETCH", 8)
    text = " ".join(f"w{i % 50}" for i in range(300))
    trie = collocations.PhraseTrie("en", 3, 3)
    got = Counter()
    for _, run in drain(trie, [text]):
        _, words, w, counts = collocations.read_run(run)
        for *ids, c in zip(*w.tolist(), counts.tolist()):
            got[tuple(words[i - 1].decode() for i in ids if i)] += c
    assert got == count([("en", text)])["en"]


def test_exact_scores_beyond_64_bits(spark):
    big = 40_000_000_000
    phrases = spark.createDataFrame(
        [("en", 1, "a", None, None, 2 * big), ("en", 1, "b", None, None, 3 * big + 1), ("en", 2, "a", "b", None, big)],
        "lang string, k int, w1 string, w2 string, w3 string, f long")
    row = collocations.scored(phrases).first()
    assert row.score == 1_000_000 * big * big // (2 * big * (3 * big + 1))


def test_empty_and_repeated(spark):
    docs = odd_documents(spark)
    assert collocations.mine(empty(spark, docs)).count() == 0
    twice = docs.union(docs)
    assert found(twice, least=4) == brute([(r.lang, r.text) for r in twice.collect()], least=4)
    assert PROSE
