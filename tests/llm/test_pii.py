import hashlib
import random
import re
import time

import pytest

from helpers import ODD, empty, odd_documents
from homestead.llm import pii

SPANS = ["mail x.y@host.example.com now", "a@b", "@@a@b.c@d.e", "é.x@h.co", "10.0.0.255 and 1.2.3.256 and 1.2.3.4.5", "9" * 30 + ".1.1.1",
         "card 4111 1111 1111 1111, bad 4111-1111-1111-1112", "4111111111111111 4111111111111111", "+1 (239) 555-1768. +12",
         "++49 30 1234567890 x", "1 2 3 4 5 6 7 8 9 0 1 2 3 4", "00001.002.0003.04", "u_n%k+o@x-y.z-.q..", "🙂 a.b@c.de 🙂 +44 20 7946 0958"]


def brute(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]

    def ok(d):
        return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and ok(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_base_spans():
    rnd = random.Random(3)
    more = ["".join(rnd.choice("ab1239.@+- ()%_é") for _ in range(rnd.randrange(0, 60))) for _ in range(1500)]
    for t in [*ODD, *SPANS, *more]:
        assert pii.base_spans(t or "") == brute(t), t


def test_long_runs_stay_linear():
    for t in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "1 " * 100_000, "+1" * 100_000):
        pii.base_spans(t)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = []
    for i in range(60):
        rows += [f"please call me: phone +1 (239) 555-{1000 + i} or mail user{i}@host{i}.example.com today",
                 f"tel 239-555-{1000 + i} is my mobile number", f"contact jane{i} [at] example [dot] com any time",
                 f"order 2390-555-{1000 + i} shipped", f"server address 2001:db8:0:0:0:0:{i}:1 is up", "no data at all here"]
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


def test_added_spans(spark, corpus):
    model = pii.learn(corpus)
    _, spans = pii.all_spans("contact jane7 [at] example [dot] com any time", model)
    assert spans == [(8, 0, 36)]
    text = "phone +1 (239) 555-1768 or mail a@b.example.com"
    base, spans = pii.all_spans(text, model)
    assert set(base) <= set(spans) and pii.redact_text(text, model) == "phone <PHONE> or mail <EMAIL>"
    assert pii.all_spans("nothing here, really: 12 apples", model) == ([], [])


def test_documents_and_redaction(spark, corpus):
    docs = odd_documents(spark, SPANS)
    model = pii.learn(docs)
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    for r in pii.find_documents(docs, model).collect():
        if len(texts[r.doc_id]) == 1 or r.doc_id == 9:
            base = brute(texts[r.doc_id][0])
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in base) for k in range(4)]
            assert r.base_sha256 == hashlib.sha256(pii.spell(base).encode()).hexdigest()
            assert set(filter(None, pii.spell(base).split(","))) <= set(r.spans.split(","))
    clean = pii.redact(docs, model)
    assert clean.columns == docs.columns and clean.dtypes == docs.dtypes and clean.count() == docs.count()
    for r in clean.collect():
        assert not pii.base_spans(r.text or "")
        assert r.n_chars == len(r.text or "")
    nothing = pii.learn(empty(spark, docs))
    assert pii.find_documents(empty(spark, docs), nothing).collect() == []
    assert pii.all_spans("tel 239-555-1768", nothing) == ([], [])


class Sure:
    """A model that takes every candidate, the better the more labelers speak for it."""

    def probability(self, kind, votes, shape):
        return 0.6 + 0.05 * sum(v > 0 for v in votes)


def test_added_spans_equal_comparing_with_every_kept_span():
    rnd = random.Random(11)
    parts = [*SPANS, "jane [at] example [dot] com", "tel 239-555-1768", "2390-555-1000", "2001:db8:0:0:0:0:7:1"]
    for _ in range(200):
        text = rnd.choice([" ", "", "-"]).join(rnd.choices(parts, k=rnd.randrange(1, 12)))
        base = pii.base_spans(text)
        kept = list(base)
        for p, a, k, b in sorted((-Sure().probability(k, v, s), a, k, b)
                                 for k, a, b, own, v, s in pii.candidates(text, base) if not own):
            if not any(a < e and s < b for s, _, e in kept):
                kept.append((a, k, b))
        assert pii.all_spans(text, Sure()) == (base, sorted(kept))


def test_many_spans_in_one_text():
    for part in ("239-555-1768 or jane [at] example [dot] com, ", "a@b.example.com 239-555-1768 "):
        start = time.process_time()
        _, spans = pii.all_spans(part * 20_000, Sure())
        assert len(spans) >= 20_000 and time.process_time() - start < 20
