import random

import numpy as np
import xxhash

from helpers import ODD, PROSE, empty, in_files, odd_documents, splits, words
from homestead.llm import simhash


def brute(text, k=3):
    w = words(text)
    sh = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def near(spark, docs):
    return [(r.doc_id, r.fp & (1 << 64) - 1, r.component_id)
            for r in simhash.near_duplicates(docs.select("doc_id", "text")).collect()]


def brute_components(fps):
    """{fingerprint: smallest id} over (doc_id, fingerprint) rows."""
    kinds = sorted({f for _, f in fps})
    root = {f: f for f in kinds}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in kinds:
        for b in kinds:
            if a < b and (a ^ b).bit_count() <= 2:
                root[find(b)] = find(a)
    least = {}
    for d, f in fps:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return {f: least.get(find(f)) for f in kinds}


def test_fingerprints():
    for t in ODD:
        assert simhash.fingerprint(t) == brute(t)
    many = " ".join(f"w{i % 97}" for i in range(1000))
    whole = simhash.fingerprint(many)
    simhash.WORDS_AT_ONCE, old = 100, simhash.WORDS_AT_ONCE
    try:
        assert simhash.fingerprint(many) == whole == brute(many)
    finally:
        simhash.WORDS_AT_ONCE = old


def test_components_of_odd_documents(spark):
    docs = odd_documents(spark, [PROSE.replace("fox", "cat"), PROSE + "  "])
    got = near(spark, docs)
    fps = [(r.doc_id, brute(r.text)) for r in docs.collect()]
    want = brute_components(fps)
    assert sorted(got, key=str) == sorted([(d, f, want[f]) for d, f in fps], key=str)
    assert near(spark, empty(spark, docs)) == []


def _links(spark, values, distance=2):
    df = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    return {tuple(sorted((r.a & (1 << 64) - 1, r.b & (1 << 64) - 1))) for r in simhash.links(df, distance).collect()}


def test_links_are_complete_with_long_postings(spark):
    rnd = random.Random(3)
    centre = rnd.getrandbits(64)
    values = {centre}
    for _ in range(900):                       # many in one posting: probed by bit flips
        values.add(centre ^ rnd.getrandbits(16))
    for _ in range(300):
        v = rnd.getrandbits(64)
        values |= {v, v ^ 1 << rnd.randrange(64), v ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64)}
    values = sorted(values)
    want = {(a, b) for i, a in enumerate(values) for b in values[i + 1:] if (a ^ b).bit_count() <= 2}
    assert _links(spark, values) == want


def test_chain_component(spark):
    chain = [0]
    for i in range(40):
        chain.append(chain[-1] ^ (3 << i % 62))
    chain = list(dict.fromkeys(chain))
    edges = spark.createDataFrame(list(zip(chain, chain[1:])), "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert set(got) == set(chain) and set(got.values()) == {min(chain)}


def test_drop_keeps_one_of_each_group(spark):
    docs = odd_documents(spark, [PROSE + "  "])
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = brute_components([(r.doc_id, brute(r.text)) for r in docs.collect()])
    rows = kept.collect()
    assert len(rows) == len(set(brute(r.text) for r in docs.collect())) - sum(
        1 for f in want if f != min(g for g in want if want[g] == want[f]) and want[f] is not None)
    assert len({brute(r.text) for r in rows}) == len(rows)


def test_drop_holds_when_the_splits_change(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, " ".join(str(rnd.random()) for _ in range(20))) for i in range(60)]
    rows += [(100 + i, t) for i, t in rows[:20]]
    docs = in_files(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "docs"))
    with splits(spark, 1):
        kept = simhash.drop_near_duplicates(docs)
    with splits(spark, 6):
        assert sorted(r.doc_id for r in kept.collect()) == list(range(60))
