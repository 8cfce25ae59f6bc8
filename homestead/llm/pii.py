"""Personal data by weak supervision: labelers vote, EM weighs them, a span
classifier decides.

Kinds, in this order: email, ip, card, phone. The base spans of each kind come
from fixed patterns with a check (part size, Luhn, digit count) and always
stay. Further candidates come from looser patterns: spelled-out addresses, IP
version 6, grouped or shorter card numbers, telephone numbers without a plus
sign. Six labelers vote on every candidate (for, against, no vote): the strict
pattern, the loose pattern, a gazetteer (top-level domains, issuer digits,
country and area codes, reserved address ranges), trigger words before the
span, words that speak against it, and validity (Luhn, part sizes, lengths).

The vote patterns of all documents are counted (in the tasks, then summed in
Spark): at most kinds x 3^6 x 2^3 distinct rows. Expectation-maximisation on
these counts estimates each labeler's reliability per kind (conditionally
independent votes, the class unseen); the posterior of each pattern then
trains a logistic span classifier on the votes and three features of the
span's shape. A candidate that is no base span is kept if the classifier gives
it one half or more and it overlaps no span kept before it (base spans first,
then by probability, start and kind).

Cases: null or empty text has no spans; spans are code point offsets, end
exclusive; repeated rows count as often as they occur and get equal spans; an
empty table, or one without candidates, learns nothing and adds nothing; other
columns are ignored by :func:`find_documents` and kept by :func:`redact`.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, texts, with_package

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("strict", "loose", "gazetteer", "trigger", "against", "valid")

# The contract's base patterns. The email pattern is applied from
# each '@' outwards, and a digit run is entered at its first digit only, which
# finds the same leftmost matches without rescanning long runs.
EMAIL_LEFT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_RIGHT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LOOSE = {
    "email": re.compile(r"(?<!\w)[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}(?: ?\[at\] ?| ?\(at\) ?| at )[A-Za-z0-9-]{1,63}"
                        r"(?:(?: ?\[dot\] ?| ?\(dot\) ?| dot |\.)[A-Za-z0-9-]{2,63}){1,4}(?!\w)"),
    "ip": re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){3,7}:?(?:[0-9A-Fa-f]{1,4}:){0,4}[0-9A-Fa-f]{1,4}(?![\w:])"),
    "card": re.compile(r"(?<![\w.-])[0-9]{3,6}(?:[ .-][0-9]{3,6}){2,4}(?![\w.-])|(?<![\w.-])[0-9]{13}(?![\w.-])"),
    "phone": re.compile(r"(?<![\w.+-])(?:00[1-9][0-9]{0,2}[ .-]?)?\(?0?[1-9][0-9]{1,3}\)?[ .-][0-9]{3}[ .-]?[0-9]{3,4}(?![\w-])"),
}
TRIGGER = {
    "email": re.compile(r"e-?mail|mail|contact|write to|kontakt|correo|courriel", re.I),
    "ip": re.compile(r"\bip\b|address|server|host|adresse|dirección", re.I),
    "card": re.compile(r"card|visa|master|credit|karte|tarjeta|carte", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|fax|ruf|handy|teléfono|appel", re.I),
}
AGAINST = re.compile(r"isbn|issn|order|invoice|serial|version|\bid\b|chapter|section|page|figure|rev\b", re.I)
DOMAINS = frozenset("com org net edu gov mil int info biz io co de fr es it nl uk us eu ch at be se no dk fi pl pt ru cn jp in br au ca mx".split())
ISSUERS = ("34", "36", "37", "38", "4", "51", "52", "53", "54", "55", "60", "62", "65")
CONTEXT = 32


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        if i & 1:
            x = 2 * x - 9 if x > 4 else 2 * x
        total += x
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, in order."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        m = EMAIL_RIGHT.match(text, at)
        start = at
        while start > free and text[start - 1] in EMAIL_LEFT:
            start -= 1
        if m and start < at:
            out.append((start, 0, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if "." in text:
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if _octets(m.group())]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            d = _digits(m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    out.sort()
    return out


DIGIT = re.compile(r"[0-9]")
#: The part of a spelled-out address from "at" on; the name before it is found from there.
SPELLED = re.compile(r"(?: ?\[at\] ?| ?\(at\) ?| at )[A-Za-z0-9-]{1,63}"
                     r"(?:(?: ?\[dot\] ?| ?\(dot\) ?| dot |\.)[A-Za-z0-9-]{2,63}){1,4}(?!\w)")
NAME_MOST = 64


def _valid(kind: int, span: str) -> int:
    d = _digits(span)
    if kind == 0:
        return 1 if len(span) <= 254 and ".." not in span else -1
    if kind == 1:
        if ":" in span:
            return 1 if span.count("::") <= 1 and (span.count(":") == 7 or "::" in span) else -1
        return 1 if _octets(span) else -1
    if kind == 2:
        return 1 if 13 <= len(d) <= 19 and luhn(d) else -1
    return 1 if 9 <= len(d) <= 15 else -1


def _gazetteer(kind: int, span: str) -> int:
    d = _digits(span)
    if kind == 0:
        return 1 if re.split(r"[^A-Za-z0-9-]+", span)[-1].lower() in DOMAINS else -1
    if kind == 1:
        return 0 if ":" in span else -1 if d[:1] == "0" or span.split(".")[0] in ("0", "255") else 1
    if kind == 2:
        return 1 if d.startswith(ISSUERS) else -1
    return 1 if span.startswith(("+1", "+3", "+4", "+5", "00", "(")) else 0


def candidates(text: str, base: list[tuple[int, int, int]]):
    """Base spans and loose ones as (kind, start, end, is_base, votes, shape)."""
    raw = [(kind, a, b, True) for a, kind, b in base]
    digits = DIGIT.search(text) is not None
    for m in SPELLED.finditer(text):
        a = m.start()
        while a > 0 and text[a - 1] in EMAIL_LEFT and m.start() - a < NAME_MOST:
            a -= 1
        if a < m.start() and text[a].isalnum() and (a == 0 or not (text[a - 1].isalnum() or text[a - 1] == "_")):
            raw.append((0, a, m.end(), False))
    if digits:
        raw += [(k, m.start(), m.end(), False) for k, name in ((1, "ip"), (2, "card"), (3, "phone"))
                for m in LOOSE[name].finditer(text)]
    own = {(k, a, b) for k, a, b, is_base in raw if is_base}
    out = []
    for kind, a, b, is_base in raw:
        if not is_base and (kind, a, b) in own:
            continue
        span, before = text[a:b], text[max(0, a - CONTEXT):a]
        loose = LOOSE[KINDS[kind]].fullmatch(span)
        votes = (1 if is_base else -1, 1 if loose else 0, _gazetteer(kind, span),
                 1 if TRIGGER[KINDS[kind]].search(before) else 0, -1 if AGAINST.search(before) else 0, _valid(kind, span))
        n = len(_digits(span))
        shape = (int(2 * n >= b - a), int(b - a > 16), int(" " in span))
        out.append((kind, a, b, is_base, votes, shape))
    return out


def vote_counts(docs: DataFrame) -> Counter:
    """How often each (kind, votes, shape) occurs over all documents."""
    def run(batches):
        c: Counter = Counter()
        for whole in batches:
            for b in small_batches(whole):
                for t in b.column("text").to_pylist():
                    if t:
                        c.update((k, v, s) for k, _, _, _, v, s in candidates(t, base_spans(t)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([",".join(map(str, (k, *v, *s))) for k, v, s in c], pa.string()),
             pa.array(list(c.values()), pa.int64())], ["pattern", "n"])
    rows = with_package(texts(docs).select("text")).mapInArrow(run, "pattern string, n long") \
        .groupBy("pattern").agg(F.sum("n").alias("n")).collect()      # a bounded number of patterns
    out: Counter = Counter()
    for r in rows:
        x = tuple(map(int, r["pattern"].split(",")))
        out[x[0], x[1:1 + len(LABELERS)], x[1 + len(LABELERS):]] = r["n"]
    return out


def expectation_maximisation(counts: Counter, rounds: int = 50) -> dict:
    """Posterior of each (kind, votes): votes are independent given the unseen
    class; each labeler has a distribution over (-1, 0, 1) per class."""
    post: dict = {}
    for kind in range(len(KINDS)):
        total: Counter = Counter()
        for (k, v, _), n in counts.items():
            if k == kind:
                total[v] += n
        if not total:
            continue
        votes = np.array(list(total))
        n = np.array([total[tuple(v)] for v in votes], float)
        one = np.stack([votes == x for x in (-1, 0, 1)], axis=2).astype(float)     # pattern x labeler x vote
        p = 1 / (1 + np.exp(-votes.sum(axis=1).astype(float)))                     # start: the vote's balance
        for _ in range(rounds):
            prior = (n @ p + 1) / (n.sum() + 2)
            yes = np.einsum("i,ijk->jk", n * p, one) + 0.5
            no = np.einsum("i,ijk->jk", n * (1 - p), one) + 0.5
            yes += np.array([0.0, 0.0, 1.0])                                       # labelers are taken to be
            no += np.array([1.0, 0.0, 0.0])                                        # better than chance at first
            yes, no = yes / yes.sum(axis=1, keepdims=True), no / no.sum(axis=1, keepdims=True)
            logit = np.log(prior / (1 - prior)) + np.einsum("ijk,jk->i", one, np.log(yes) - np.log(no))
            new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            done = np.abs(new - p).max() < 1e-9
            p = new
            if done:
                break
        post.update({(kind, tuple(v)): float(x) for v, x in zip(votes, p)})
    return post


def _features(kind: int, votes: tuple, shape: tuple) -> np.ndarray:
    own = [1.0, *(float(v > 0) for v in votes), *(float(v < 0) for v in votes), *map(float, shape)]
    out = np.zeros(len(KINDS) * len(own))
    out[kind * len(own):(kind + 1) * len(own)] = own
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray

    def probability(self, kind: int, votes: tuple, shape: tuple) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights @ _features(kind, votes, shape), -30, 30))))


def learn(docs: DataFrame) -> Model:
    counts = vote_counts(docs)
    size = len(_features(0, (0,) * len(LABELERS), (0,) * 3))
    if not counts:
        return Model(np.zeros(size) - 1.0)
    post = expectation_maximisation(counts)
    x = np.array([_features(*key) for key in counts])
    n = np.array(list(counts.values()), float)
    y = np.array([post[k, v] for k, v, _ in counts])
    w = np.zeros(size)
    for _ in range(50):                                          # Newton steps, ridge 1
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (p - y)) + w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(size)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Model(w)


def all_spans(text: str, model: Model) -> tuple[list, list]:
    """(base spans, all spans) as sorted (start, kind, end)."""
    base = base_spans(text)
    more = [(-model.probability(k, v, s), a, k, b) for k, a, b, is_base, v, s in candidates(text, base) if not is_base]
    starts, ends = [], []                                        # of what is covered, apart and in order
    for a, _, b in sorted(base):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    kept = list(base)
    for p, a, k, b in sorted(more):
        if p > -0.5:
            break
        i = bisect_left(starts, b)
        if not i or ends[i - 1] <= a:
            starts.insert(i, a)
            ends.insert(i, b)
            kept.append((a, k, b))
    return base, sorted(kept)


def spell(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_documents(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: ``doc_id, n_email, n_ip, n_card, n_phone`` and ``base_sha256``
    of the base spans, ``spans`` with the added ones."""
    def run(batches):
        for whole in batches:
            for b in small_batches(whole):
                n = [[] for _ in KINDS]
                sha, spans = [], []
                for t in b.column("text").to_pylist():
                    base, found = all_spans(t or "", model)
                    for k in range(len(KINDS)):
                        n[k].append(sum(s[1] == k for s in base))
                    sha.append(hashlib.sha256(spell(base).encode()).hexdigest())
                    spans.append(spell(found))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), *(pa.array(x, pa.int64()) for x in n),
                     pa.array(sha, pa.string()), pa.array(spans, pa.string())],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return with_package(texts(docs)).mapInArrow(run, f"doc_id long, {counts}, base_sha256 string, spans string")


def redact_text(text: str | None, model: Model) -> str | None:
    if not text:
        return text
    _, spans = all_spans(text, model)
    out, at = [], 0
    for a, k, b in spans:
        if b <= at:
            continue                                             # inside a span of another kind
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Model, length: str = "n_chars") -> DataFrame:
    """``docs``, all columns, with every span replaced by its kind in angle
    brackets; a column named ``length``, where there is one, is the number of
    code points of the new text."""
    def run(batches):
        for whole in batches:
            for b in small_batches(whole):
                at = b.schema.get_field_index("text")
                new = [redact_text(t, model) for t in b.column("text").to_pylist()]
                yield b.set_column(at, b.schema.field("text"), pa.array(new, b.schema.field("text").type))
    out = with_package(docs).mapInArrow(run, docs.schema)
    if length in docs.columns and length != "text":
        out = out.withColumn(length, F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema[length].dataType))
                             .otherwise(F.col(length)))
    return out.select(docs.columns)
