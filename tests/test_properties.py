"""Property tests: Spark rules against a plain-Python statement of the same
rule on generated text (one DataFrame per batch of examples)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from homestead.functions import text as X

ALPHABET = st.sampled_from(list("0123456789,. -/ABCabcxyzSốsổđỏhồngmớicũ\t") + ["tỷ", "m²", "Số ", "số "])
TEXTS = st.lists(st.one_of(st.none(), st.lists(ALPHABET, max_size=14).map("".join)), min_size=1, max_size=40)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def py_locale_number(s):
    if s is None:
        return None
    t = re.sub(r"[^0-9,]", "", s).replace(",", ".")
    try:
        return float(t) if re.fullmatch(r"\d+(\.\d*)?|\.\d+", t) else None
    except ValueError:
        return None


def py_digits_int(s):
    if s is None:
        return None
    t = re.sub(r"[^0-9]", "", s)
    if not t:
        return None
    v = int(t)
    return v if v <= 2**31 - 1 else None


def py_keyword_flag(s, kws=("sổ", "đỏ", "hồng")):
    return 1 if s is not None and any(k in s.lower() for k in kws) else 0


def py_first_part(s):
    if s is None:
        return None
    for p in s.split(","):
        t = p.strip(" ")
        if re.fullmatch(r"[0-9/\sA-Za-z]{1,6}", t) or t.lower().startswith("số"):
            continue
        return p.strip(" ")
    return None


def run(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.r for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


@SETTINGS
@given(TEXTS)
def test_locale_number_property(spark, values):
    assert run(spark, values, X.locale_number) == [py_locale_number(v) for v in values]


@SETTINGS
@given(TEXTS)
def test_digits_int_property(spark, values):
    assert run(spark, values, X.digits_int) == [py_digits_int(v) for v in values]


@SETTINGS
@given(TEXTS)
def test_keyword_flag_property(spark, values):
    assert run(spark, values, X.keyword_flag) == [py_keyword_flag(v) for v in values]


@SETTINGS
@given(TEXTS)
def test_first_meaningful_part_property(spark, values):
    assert run(spark, values, X.first_meaningful_part) == [py_first_part(v) for v in values]
