import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from helpers import empty, odd_documents
from homestead.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def test_round_trip_equals_library(spark, library):
    docs = odd_documents(spark)
    got = bpe.round_trip(docs, PATH, P.PATTERN).collect()
    want = []
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_long_and_random_pretokens(library):
    own = bpe.ByteBPE(bpe.load_ranks(PATH), P.PATTERN, cache_entries=50)
    rnd = random.Random(1)
    for letters in ("ab", "aaabbé漢", "abcdefghijklmnopqrstuvwxyz"):
        for size in (1, 2, 7, 60, 3000):
            text = "".join(rnd.choice(letters) for _ in range(size))
            assert own.encode(text) == library.encode_ordinary(text)
            assert own.decode(own.encode(text)) == text.encode()


@pytest.mark.parametrize("wide", [1, 3, 10**9])
def test_wide_and_narrow_buckets_agree(library, monkeypatch, wide):
    """Every bucket at once, some, none: many pre-tokens, overlapping pairs in a row, one very long one."""
    monkeypatch.setattr(bpe, "WIDE", wide)
    own = bpe.ByteBPE(bpe.load_ranks(PATH), P.PATTERN)
    rnd = random.Random(2)
    texts = [" ".join("".join(rnd.choice("aeinrst") for _ in range(rnd.randint(1, 14))) for _ in range(400)),
             "aaaaaaa " * 50 + "a" * 5000 + " " * 300 + "\n" * 77 + "=" * 999, "été 漢字漢字漢字 🙂🙂🙂" * 60, ""]
    assert [own.encode(t) for t in texts] == [library.encode_ordinary(t) for t in texts]


def test_lower_rank_comes_up_while_a_wide_bucket_is_open(monkeypatch):
    """A joined token that meets its neighbour at a lower rank than its own: that pair comes first."""
    ranks = {bytes([b]): b + 10 for b in range(256)} | {b"abc": 1, b"bc": 2, b"ca": 3}
    plain = {}
    for wide in (1, 10**9):
        monkeypatch.setattr(bpe, "WIDE", wide)
        plain[wide] = bpe.ByteBPE(ranks, r"[a-z]+| +").encode("abcabcabc cacaca bcabca" * 9)
    assert plain[1] == plain[10**9]
    text = "abcabcabc cacaca bcabca" * 9
    assert plain[1] == tiktoken.Encoding("low", pat_str=r"[a-z]+| +", mergeable_ranks=ranks,
                                         special_tokens={}).encode_ordinary(text)


def test_bytes_outside_the_vocabulary():
    own = bpe.ByteBPE({b"a": 0, b"ab": 1}, r"[a-z]+")
    assert own.merge_all([b"ab", b"aab"]) == [[1], [0, 1]]
    with pytest.raises(KeyError):
        own.merge_all([b"b"])


def test_blocks_of_long_texts(library, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_TEXT", 40)
    own = bpe.ByteBPE(bpe.load_ranks(PATH), P.PATTERN)
    text = "some words, and  spaces\n\n " * 40
    assert own.encode(text) == library.encode_ordinary(text)
    assert [d[0] for d in own.digests([text, "a", text])] == [len(own.encode(text)), 1, len(own.encode(text))]


def test_encode_documents_and_empty(spark, library):
    docs = odd_documents(spark)
    for r in bpe.encode_documents(docs, PATH, P.PATTERN).join(docs.select("doc_id", "text"), "doc_id").collect():
        if r.doc_id not in (3, 9):
            assert r.token_ids == library.encode_ordinary(r.text or "")
    assert bpe.round_trip(empty(spark, docs), PATH, P.PATTERN).collect() == []
