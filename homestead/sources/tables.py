"""Parquet tables: scans with partition pruning, partitioned writes, and a
versioned publish for tables that are rewritten from themselves (upsert).

A Parquet path cannot be overwritten while it is being read, so a rewritten
table goes to a new version directory ``<root>/v=<n>``; Spark's commit
protocol writes ``_SUCCESS`` last, and readers take the highest committed
version. A job that dies mid-write leaves an uncommitted directory that no
reader picks, so a rerun is safe. A version's checks run on what was written,
before it is committed.

A keyed table is laid out in a fixed number of hash buckets of its key
(``v=<n>/bucket=<i>of<m>``). A version then holds only the buckets it rewrote,
and the table is the newest committed copy of each bucket: an upsert of a
small batch rewrites the buckets that the batch touches, not the table. A
publisher names the version it read; if a later one has rewritten any of the
same buckets, it fails and must plan again, so no rows are lost. Another bucket
count than the table's is refused.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
from collections.abc import Callable, Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_partitioned(spark: SparkSession, path: str, since=None, until=None,
                     part_col: str = "dt") -> DataFrame:
    """Scan a ``dt``-partitioned Parquet table; ``since``/``until`` (inclusive
    dates) become PartitionFilters, so only those directories are listed/read."""
    df = spark.read.parquet(path)
    if since is not None:
        df = df.filter(F.col(part_col) >= F.lit(_as_date(since)))
    if until is not None:
        df = df.filter(F.col(part_col) <= F.lit(_as_date(until)))
    return df


def _as_date(v):
    if isinstance(v, (_dt.date, _dt.datetime)):
        return v if not isinstance(v, _dt.datetime) else v.date()
    return _dt.date.fromisoformat(str(v))


def write_partitioned(df: DataFrame, path: str, part_col: str | tuple[str, ...] = "dt",
                      dynamic: bool = False, cluster_by_partition: bool = True,
                      finish: Callable[[DataFrame], DataFrame] | None = None, compression: str | None = None) -> None:
    """Overwrite a partitioned Parquet table.

    ``dynamic=False`` replaces the whole table (full rebuild) once the new copy
    is complete, so a job lost midway leaves the old one; ``dynamic=True``
    replaces only the partitions present in ``df`` (incremental runs).
    ``cluster_by_partition`` clusters rows by ``part_col`` before writing so a
    date is written by few tasks instead of one small file per task per date.
    It is a ``rebalance`` hint, not a plain repartition: AQE splits a date that
    holds a large share of the rows over several writers and merges small
    dates, so a hot date never lands in one task. ``finish`` makes the written
    rows of the clustered ones, so that narrow rows are shuffled.
    """
    cols = (part_col,) if isinstance(part_col, str) else part_col
    out = df.hint("rebalance", *cols) if cluster_by_partition else df
    out = finish(out) if finish else out
    if dynamic:
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(
            path, compression=compression)
        return
    staged = f"{path.rstrip('/')}__new-{os.urandom(4).hex()}"
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*cols).parquet(
        staged, compression=compression)
    _swap_in(out.sparkSession, staged, path)


def _swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Put a complete new copy where the old one was: the old one goes only
    when the new one stands."""
    fs, new, jvm = _fs(spark, staged)
    at, old = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}__old-{os.urandom(4).hex()}")
    was_there = fs.exists(at)
    if was_there and not fs.rename(at, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, at):
        if was_there:
            fs.rename(old, at)
        raise OSError(f"cannot move {staged} to {path}")
    if was_there:
        fs.delete(old, True)


def replace_days(df: DataFrame, path: str, day_col: str, days: Iterable, more: tuple[str, ...] = (),
                 finish: Callable[[DataFrame], DataFrame] | None = None, compression: str | None = None) -> None:
    """Make ``df`` all that the table holds of ``days`` (its first partition
    level ``day_col``): a day that ``df`` has no rows of any more goes. Other
    days stay as they are. The new days are written whole before any old one goes.
    ``finish``: as in ``write_partitioned``."""
    spark, base = df.sparkSession, path.rstrip("/")
    fs, root, jvm = _fs(spark, base)
    staged = f"{base}__new-{os.urandom(4).hex()}"
    cols = (day_col, *more)
    out = df.hint("rebalance", *cols)
    (finish(out) if finish else out).write.partitionBy(*cols).parquet(staged, compression=compression)
    fs.mkdirs(root)
    for name in sorted({f"{day_col}={d}" for d in days}):
        at, new = (jvm.org.apache.hadoop.fs.Path(f"{p}/{name}") for p in (base, staged))
        if fs.exists(new):
            _swap_in(spark, new.toString(), at.toString())
        elif fs.exists(at):
            fs.delete(at, True)
    fs.delete(jvm.org.apache.hadoop.fs.Path(staged), True)


def partition_days(spark: SparkSession, root: str, part_col: str = "dt") -> list[str]:
    """Values of the first partition level under ``root``, from the listing."""
    fs, hroot, _ = _fs(spark, root)
    if not fs.exists(hroot):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(hroot) if st.isDirectory()]
    return sorted(n[len(part_col) + 1:] for n in names if n.startswith(f"{part_col}="))


# --- versioned tables -------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hpath.getFileSystem(conf), hpath, jvm


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Version numbers under ``root`` that carry a ``_SUCCESS`` marker."""
    fs, hroot, jvm = _fs(spark, root)
    if not fs.exists(hroot):
        return []
    out = []
    for st in fs.listStatus(hroot):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            try:
                n = int(name[2:])
            except ValueError:
                continue
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(n)
    return sorted(out)


def _bucket_dirs(spark: SparkSession, version_path: str) -> dict[str, str]:
    """``{bucket name: path}`` of one version; empty for a table without buckets."""
    fs, hpath, _ = _fs(spark, version_path)
    return {st.getPath().getName()[7:]: st.getPath().toString() for st in fs.listStatus(hpath)
            if st.isDirectory() and st.getPath().getName().startswith("bucket=")}


def bucket_of(key: str, n_buckets: int):
    """Name of a row's bucket, e.g. ``0007of0064``; the count is part of the
    name, so a table cannot be read or extended with another one."""
    return F.format_string(f"%04dof{n_buckets:04d}", F.pmod(F.xxhash64(key), F.lit(n_buckets)))


def bucket_versions(spark: SparkSession, root: str) -> dict[str, int]:
    """The version that holds each bucket's newest committed copy."""
    found: dict[str, int] = {}
    for v in reversed(committed_versions(spark, root)):
        for name in _bucket_dirs(spark, f"{root.rstrip('/')}/v={v}"):
            found.setdefault(name, v)
    return found


def bucket_copies(spark: SparkSession, root: str, versions: dict[str, int]) -> list[str] | None:
    """Directories of these copies of the buckets; None if one is gone."""
    fs, _, jvm = _fs(spark, root)
    paths = [f"{root.rstrip('/')}/v={v}/bucket={name}" for name, v in sorted(versions.items())]
    return paths if all(fs.exists(jvm.org.apache.hadoop.fs.Path(p)) for p in paths) else None


def current_paths(spark: SparkSession, root: str, buckets: Iterable[str] | None = None) -> list[str]:
    """Directories that make up the current table: the newest committed copy
    of each bucket (of ``buckets`` only, if given), or the newest version."""
    base, wanted = root.rstrip("/"), None if buckets is None else set(buckets)
    found: dict[str, str] = {}
    for v in reversed(committed_versions(spark, root)):
        dirs = _bucket_dirs(spark, f"{base}/v={v}")
        if not dirs and not found:
            return [f"{base}/v={v}"]                   # a table without buckets
        for name, path in dirs.items():
            found.setdefault(name, path)
    return [p for name, p in sorted(found.items()) if wanted is None or name in wanted]


def read_versioned(spark: SparkSession, root: str, schema=None,
                   buckets: Iterable[str] | None = None) -> DataFrame | None:
    """The current table (of ``buckets`` only, if given); an empty frame of
    ``schema``, or None, when there is none."""
    paths = current_paths(spark, root, buckets)
    if not paths:
        return spark.createDataFrame([], schema) if schema is not None else None
    return spark.read.parquet(*paths)


class PublishConflict(RuntimeError):
    """Another run is publishing the same version (or died while it did)."""


@contextmanager
def _claimed_version(spark: SparkSession, root: str, base: int | None = None, buckets: Iterable[str] | None = None):
    """The next version number, claimed with a marker file: of two publishers
    of one version, one fails. With ``base`` (the version that was read, 0 for
    none), a version after it that has rewritten any of ``buckets`` (all, if
    not given) is a conflict, too. A run that was killed leaves its marker;
    remove it to go on."""
    vs = committed_versions(spark, root)
    n = vs[-1] + 1 if vs else 1
    marker = f"{root.rstrip('/')}/_publishing-{n}"
    fs, hpath, _ = _fs(spark, marker)
    if not fs.createNewFile(hpath):
        raise PublishConflict(f"{marker} exists: another run is publishing version {n}, or died while publishing it")
    try:
        now = committed_versions(spark, root)
        if n in now:
            raise PublishConflict(f"version {n} of {root} has been published meanwhile")
        for v in now if base is not None else ():
            both = set(_bucket_dirs(spark, f"{root.rstrip('/')}/v={v}")).intersection(buckets or ())
            if v > base and (buckets is None or both):
                raise PublishConflict(f"version {v} of {root} was published after version {base} was read: plan again")
        yield n
    finally:
        fs.delete(hpath, False)


def current_version(spark: SparkSession, root: str) -> int:
    """Number of the newest committed version, 0 if there is none."""
    return max(committed_versions(spark, root), default=0)


def publish_version(df: DataFrame, root: str, partition_by: str | None = None, base: int | None = None,
                    buckets: Iterable[str] | None = None, check: Callable[[DataFrame], None] | None = None,
                    note: dict | None = None, compression: str | None = None) -> str:
    """Write ``df`` as the next version of ``root`` and return its path.
    ``check`` sees the written rows and raises to refuse them: the version is
    committed behind it. ``note`` is kept with the version (``last_note``)."""
    spark = df.sparkSession
    with _claimed_version(spark, root, base, buckets) as n:
        path = f"{root.rstrip('/')}/v={n}"
        w = df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(path, compression=compression)
        if check is not None:
            check(spark.read.schema(df.schema).parquet(path))
        if note is not None:
            put_text(spark, f"{path}/_note.json", json.dumps(note))
        put_text(spark, f"{path}/_SUCCESS", "")
    return path


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    fs, hpath, _ = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(hpath)) if fs.exists(hpath) else []


def make_dir(spark: SparkSession, path: str) -> None:
    fs, hpath, _ = _fs(spark, path)
    fs.mkdirs(hpath)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    fs, hpath, _ = _fs(spark, path)
    out = fs.create(hpath, True)
    out.write(bytearray(text.encode()))
    out.close()


def last_note(spark: SparkSession, root: str, **having) -> dict | None:
    """The newest version's note that has these entries."""
    for v in reversed(committed_versions(spark, root)):
        fs, hpath, jvm = _fs(spark, f"{root.rstrip('/')}/v={v}/_note.json")
        if fs.exists(hpath):
            stream = fs.open(hpath)
            note = json.loads(bytes(stream.readAllBytes()).decode())
            stream.close()
            if all(note.get(k) == x for k, x in having.items()):
                return note
    return None


def assert_bucket_count(spark: SparkSession, root: str, n_buckets: int) -> None:
    """A table keeps the bucket count that it was made with."""
    for v in committed_versions(spark, root):
        for name in _bucket_dirs(spark, f"{root.rstrip('/')}/v={v}"):
            if int(name.split("of")[1]) != n_buckets:
                raise ValueError(f"{root} has {int(name.split('of')[1])} buckets, not {n_buckets}")


def publish_buckets(df: DataFrame, root: str, key: str, n_buckets: int, keep: int = 2, base: int | None = None,
                    buckets: Iterable[str] | None = None, check: Callable[[DataFrame], None] | None = None,
                    note: dict | None = None, clustered: bool = False,
                    finish: Callable[[DataFrame], DataFrame] | None = None, compression: str | None = None) -> str:
    """Write whole buckets (every row of each bucket that ``df`` has rows in)
    as the next version; then drop bucket copies that ``keep`` newer committed
    copies supersede. ``clustered`` rows have their ``bucket`` and are dealt by
    it already. ``finish`` makes the written rows (with ``bucket``) of the dealt ones."""
    spark = df.sparkSession
    assert_bucket_count(spark, root, n_buckets)
    if not clustered:
        df = df.withColumn("bucket", bucket_of(key, n_buckets)).hint("rebalance", "bucket")
    path = publish_version(finish(df) if finish else df, root, "bucket", base, buckets, check, note, compression)
    remove_superseded(spark, root, keep)
    return path


def remove_superseded(spark: SparkSession, root: str, keep: int) -> int:
    """Delete each bucket copy with ``keep`` or more newer committed copies
    (``keep`` 1: only the current table stays); returns how many went."""
    if keep < 1:
        raise ValueError("keep must be 1 or more")
    newer: dict[str, int] = {}
    gone = 0
    for v in reversed(committed_versions(spark, root)):
        for name, path in _bucket_dirs(spark, f"{root.rstrip('/')}/v={v}").items():
            newer[name] = newer.get(name, 0) + 1
            if newer[name] > keep:
                fs, hpath, _ = _fs(spark, path)
                fs.delete(hpath, True)
                gone += 1
    return gone
