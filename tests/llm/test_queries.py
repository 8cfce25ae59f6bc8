"""Registered queries against their SQL, and their columns."""

import pytest

from homestead.llm import quality
from homestead.llm.queries import ORACLE, QUERIES
from parity import compare, duck

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op2_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op3_html": ["page_id", "url", "text", "n_chars"],
    "op5_quality": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op6_idcoder": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op7_ppm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op8_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op9_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op10_simhash": ["doc_id", "fingerprint", "component_id"],
    "op11_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op12_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op13_collocations": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    res = compare(QUERIES[name](spark, SF), duck(SF), ORACLE[name])
    assert res["cols_match"] and res["rows_match"] and res["values_match"], res


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_row_comes_back(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns[:len(COLUMNS.get(name, []))] == COLUMNS.get(name, [])
    table = {"op3_html": "pages", "op12_whitening": "embeddings"}.get(name, "documents")
    rows = spark.read.parquet(f"{SF}/{table}.parquet")
    if name == "quality_ablation":
        assert df.count() == len(quality.RULES)
    elif name == "op13_collocations":
        assert 0 < df.count() <= 2000 * rows.select("lang").distinct().count()
    else:
        assert df.count() == rows.count() * (16 if name == "op12_whitening" else 1)
