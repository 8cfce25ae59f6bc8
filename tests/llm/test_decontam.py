import random

from helpers import ODD, PROSE, empty, odd_documents
from homestead.llm import decontam as C


def plain_distance(p, t):
    """Least edit distance of p to a substring of t, by the full table."""
    row = list(range(len(p) + 1))
    best = row[-1]
    for c in t:
        new = [0]
        for i, x in enumerate(p):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def edited(rnd, t, k):
    t = list(t)
    for _ in range(k):
        i = rnd.randrange(len(t))
        op = rnd.randrange(3)
        if op == 0:
            t[i] = rnd.choice("abcxyz")
        elif op == 1:
            t.insert(i, rnd.choice("abc "))
        elif len(t) > 1:
            del t[i]
    return "".join(t)


def test_bit_parallel_distance():
    rnd = random.Random(1)
    for _ in range(200):
        p = "".join(rnd.choice("abc ") for _ in range(rnd.randrange(1, 40)))
        t = "".join(rnd.choice("abc ") for _ in range(rnd.randrange(0, 80)))
        most = rnd.randrange(0, len(p) + 1)
        assert C.best_distance(p, t, most) == min(plain_distance(p, t), most + 1)


def test_matcher_equals_brute_force():
    rnd = random.Random(2)
    vocab = PROSE.split()
    items = {}
    for i in range(30):
        items.setdefault(" ".join(rnd.choice(vocab) for _ in range(rnd.randrange(5, 40))), []).append(i)
    own = C.Matcher(items, C.Params(rate=0.1, min_chars=25))
    for _ in range(150):
        it = rnd.choice(list(items))
        text = " ".join(rnd.choice(vocab) for _ in range(30)) + " " + edited(rnd, it, rnd.randrange(0, len(it) // 8 + 1)) + \
            " " + " ".join(rnd.choice(vocab) for _ in range(20))
        want = {}
        for t, ids in items.items():
            d = plain_distance(t, text)
            if len(t) >= 25 and d <= int(0.1 * len(t)):
                want.update({i: d for i in ids})
        assert own.find(text) == want


def test_documents_in_one_and_many_blocks(spark):
    items = [(1, PROSE), (2, None), (3, ""), (4, PROSE.upper() + "!!"), (5, "one two"), (6, " -- "), (None, PROSE),
             (7, "Sailors mend their NETS and tell long stories about storms"), (7, "Sailors mend their NETS and tell long stories about storms")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = odd_documents(spark, ["start " + PROSE.replace("quick", "quack").replace("seven", "eleven") + " end", "one, two"])
    whole = {r.doc_id: r.item_ids for r in C.contaminated(docs, bench).collect() if r.contaminated}
    n = len(ODD)
    assert whole[9] == whole[10] == whole[11] == whole[n] == [None, 1, 4, 7]           # an item without an id counts
    assert whole[6] == whole[7] == whole[n + 1] == [5] and set(whole) == {6, 7, 9, 10, 11, n, n + 1, None}
    small = C.Params(block_chars=60)
    assert len(C.item_blocks(bench, small)) > 1
    assert sorted(map(str, C.contaminated(docs, bench, small).collect())) == sorted(map(str, C.contaminated(docs, bench).collect()))
    kept = C.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len(whole) - 1     # id 9 is there twice
    assert C.drop_contaminated(docs, empty(spark, bench)).count() == docs.count()
    assert C.contaminated(empty(spark, docs), bench).collect() == []


def test_short_items_inside_longer_texts():
    own = C.Matcher({"who wrote hamlet": [1], "what is the capital of x": [2], "is it so": [3], "ham": [4]}, C.Params())
    assert own.find("one more question who wrote hamlet and when") == {1: 0}
    assert own.find("who wrote hamlat") == {1: 1} and own.find("so who wrotehamlet then") == {1: 1}
    assert own.find("the man who rote hamlett") == {}                                  # two edits, one allowed
    assert own.find("who wrote hamletology") == {} and own.find("this it so") == {}    # no whole words
    assert own.find("tell what is a capital of x") == {} and own.find("wat is the capitol of x") == {2: 2}
    assert own.find("is it so") == {3: 0} and own.find("say is it so") == {3: 0}
    assert own.find("ham") == {4: 0} and own.find("eggs and ham now") == {4: 0} and own.find("hamper shame") == {}


def test_short_items_equal_brute_force():
    rnd = random.Random(5)
    vocab = PROSE.split() + ["a", "x", "ai", "no"]
    items = {}
    for i in range(80):
        t = C.normalise(" ".join(rnd.choice(vocab) for _ in range(rnd.randrange(1, 5))))
        if len(t) < 25:
            items.setdefault(t, []).append(i)
    own = C.Matcher(items, C.Params())
    for _ in range(100):
        it = rnd.choice(list(items))
        text = C.normalise(" ".join([*rnd.choices(vocab, k=6), edited(rnd, it, rnd.randrange(0, 4)), *rnd.choices(vocab, k=5)]))
        w = text.split(" ")
        runs = [" ".join(w[a:b]) for a in range(len(w)) for b in range(a + 1, len(w) + 1)]
        want = {}
        for t, ids in items.items():
            d = min((whole_distance(t, r) for r in runs if abs(len(r) - len(t)) <= 2), default=99)
            if d <= int(0.1 * len(t)):
                want.update({i: d for i in ids})
        assert own.find(text) == want


def whole_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_blocks_come_one_at_a_time(spark):
    """No list of all blocks, and a task runs one matcher pass at a time."""
    bench = spark.createDataFrame([(i, f"{PROSE[i:i + 60]} {i}") for i in range(12)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"say {PROSE[i:i + 60]} {i} end") for i in range(12)], "doc_id long, text string")
    small = C.Params(block_chars=200)
    blocks = C.item_blocks(bench, small)
    assert not isinstance(blocks, list) and len(blocks) > 2
    assert sorted(i for b in blocks for ids in b.values() for i in ids) == list(range(12))
    found = C.scan(docs, bench, "items", small)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 0
    assert {r.doc_id: r["items"] for r in found.collect()} == {r.doc_id: r["items"] for r in C.scan(docs, bench, "items").collect()}


def test_only_an_item_without_an_id(spark):
    bench = spark.createDataFrame([(None, PROSE), (None, "ai act")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "say " + PROSE), (2, "the AI Act is law"), (3, "said actor")], "doc_id long, text string")
    for p in (C.Params(), C.Params(block_chars=10)):
        got = {r.doc_id: (r.contaminated, r.n_items, r.item_ids) for r in C.contaminated(docs, bench, p).collect()}
        assert got == {1: (True, 1, [None]), 2: (True, 1, [None]), 3: (False, 0, [])}
    assert [r.doc_id for r in C.drop_contaminated(docs, bench).collect()] == [3]
