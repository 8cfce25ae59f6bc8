"""Fixtures of the operators' tests: odd documents and a brute-force view of words."""

import contextlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")

PROSE = ("the quick brown fox jumps over the lazy dog while seven wizards quietly box five dozen liquor jugs near "
         "a harbour where old sailors mend their nets and tell long stories about storms and distant islands")

ODD = [None, "", " \t\n ", "a", "Ünï çödé 漢字 🙂", "x" * 5000, "one two", "One  TWO\tthree\x0bfour", "\n\n", PROSE,
       PROSE + " again", PROSE.upper(), "tab\tsep\r\nline\n\nline\nline", " lead and trail ", "nbsp stays here",
       " ".join(f"w{i}" for i in range(3000)), "a a a a a a", "'s 't don't I'll 12 345", "<|endoftext|> x", "combining é é"]


def odd_documents(spark, more=()):
    """ODD with ids 0.., repeated rows, a null id, and columns whose names
    clash with those that the operators make up."""
    rows = [(i, t) for i, t in enumerate([*ODD, *more])]
    rows += [(9, PROSE), (None, PROSE + " null id"), (3, "a")]
    schema = ("doc_id long, text string, row int, items int, score double, fp string, bucket int, n_chars long, "
              "lang string, part string")
    return spark.createDataFrame([(d, t, 1, 2, 0.5, "z", 3, len(t or ""), None, "p") for d, t in rows], schema)


def words(text):
    """Lower-cased (A-Z) words."""
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def remainder(doc_id, mod=5):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % mod


def empty(spark, df):
    return spark.createDataFrame([], df.schema)


@contextlib.contextmanager
def splits(spark, n):
    """File scans planned inside ask for at least ``n`` partitions, as a cluster of n cores does."""
    key = "spark.sql.files.minPartitionNum"
    spark.conf.set(key, n)
    try:
        yield
    finally:
        spark.conf.unset(key)


def in_files(spark, df, path, n=6):
    """``df`` read back from ``n`` files."""
    df.repartition(n).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
