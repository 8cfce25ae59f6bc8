"""The registered queries of the numbered operators: each applies one operator,
with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import (bpe, collocations, decontam, html_main, idcoder, line_dedup, pii, ppm, quality, sharding, simhash, toxicity,
               whitening)
from .common import read, remainder, texts
from .oracle import ORACLE  # noqa: F401

QUERIES: dict = {}

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bpe(spark, sf_dir) -> DataFrame:
    """Byte-level BPE round trip of every document."""
    return bpe.round_trip(read(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


@query
def op9_sharding(spark, sf_dir) -> DataFrame:
    """Jump consistent hashing of every document into 24 shards."""
    return sharding.assign_shards(read(spark, sf_dir, "documents"), 24)


@query
def op10_simhash(spark, sf_dir) -> DataFrame:
    """SimHash components of every document: 3-word shingles, 2 bits."""
    found = simhash.near_duplicates(texts(read(spark, sf_dir, "documents")), 3, 2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op2_toxicity(spark, sf_dir) -> DataFrame:
    """Toxicity score of every document, learned from the labels."""
    docs = read(spark, sf_dir, "documents")
    model = toxicity.learn(docs, read(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted",
        F.size("passages").alias("n_passages"))


@query
def op4_decontamination(spark, sf_dir) -> DataFrame:
    """Benchmark items in every document, up to one edit in ten characters."""
    return decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op5_quality(spark, sf_dir) -> DataFrame:
    """The stored ledger of every document under the newest policy."""
    book = quality.apply_policy(quality.stored(read(spark, sf_dir, "documents")), "v2")
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failures").bitwiseAND(F.lit(quality.BASE).cast("long")) != 0).alias("base_failed"), "kept",
        "failures")


@query
def quality_ablation(spark, sf_dir) -> DataFrame:
    """What each rule of the newest policy rejects, alone and in all, and what
    would be kept without it, from the stored bits."""
    return quality.ablation(quality.stored(read(spark, sf_dir, "documents")), "v2")


@query
def op8_pii(spark, sf_dir) -> DataFrame:
    """Personal data in every document."""
    docs = read(spark, sf_dir, "documents")
    return pii.find_documents(docs, pii.learn(docs))


@query
def op3_html(spark, sf_dir) -> DataFrame:
    """Main text of every page."""
    return html_main.extract_main(read(spark, sf_dir, "pages"))


@query
def op6_idcoder(spark, sf_dir) -> DataFrame:
    """Token ids of every document, written in the block format and read back."""
    blocks = idcoder.write_blocks(read(spark, sf_dir, "documents"), WORD_BPE, end_id=1)
    return idcoder.read_documents(blocks)


@query
def op7_ppm(spark, sf_dir) -> DataFrame:
    """PPM and unigram scores of every document."""
    docs = read(spark, sf_dir, "documents")
    return ppm.score_documents(docs, ppm.learning_rows()).select(
        "doc_id", (~ppm.learning_rows()).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_line_dedup(spark, sf_dir) -> DataFrame:
    """Lines of 20 code points or more that three documents hold stay in one."""
    kept = line_dedup.drop_repeated_lines(texts(read(spark, sf_dir, "documents")), min_chars=20, min_docs=3)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op12_whitening(spark, sf_dir) -> DataFrame:
    """The 16 leading whitened components of every embedding."""
    return whitening.whiten(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 16)


@query
def op13_collocations(spark, sf_dir) -> DataFrame:
    """Each language's 2,000 best phrases of two or three words."""
    return collocations.mine(read(spark, sf_dir, "documents"), longest=3, least=10, top=2000)
