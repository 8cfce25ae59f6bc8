"""Keyed table operators: dedupe, upsert, insert-ignore, status update and the
primary-key check.

Scale notes (1000 executors, 100 TB):
* ``latest_per_key`` is one shuffle on the key. ``row_number() = 1`` plans a
  *partial* ``WindowGroupLimit`` before the exchange, so a key holding a third
  of all rows still ships at most one row per map task.
* ``upsert`` / ``insert_ignore`` are anti-joins of a large target against a
  (usually small) batch. No broadcast hint is given: AQE measures the batch
  at runtime and switches to a broadcast hash join only when it is below
  ``spark.sql.adaptive.autoBroadcastJoinThreshold``; above it the plan stays a
  sort-merge join, and skewed partitions are split by AQE's skew-join rule.
* Target keys are unique by construction, so the target side carries no hot
  key; batch keys are reduced before the join (partial ``WindowGroupLimit`` or
  map-side combine).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S

_ORDERABLE = (T.StringType, T.NumericType, T.DateType, T.TimestampType,
              T.TimestampNTZType, T.BooleanType, T.BinaryType)


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _keys_present(ks: Sequence[str]) -> Column:
    """All key columns non-NULL: a primary key never holds NULL, so batch
    rows without a key are not written (a database would reject them)."""
    cond = F.lit(True)
    for k in ks:
        cond = cond & F.col(k).isNotNull()
    return cond


def tiebreak_columns(df: DataFrame, exclude: Sequence[str]) -> list[Column]:
    """Every remaining atomic column, ascending with NULLs first: a total
    order over distinct rows, so the survivor never depends on scan order."""
    skip = set(exclude)
    return [F.col(f.name).asc_nulls_first() for f in df.schema.fields
            if f.name not in skip and isinstance(f.dataType, _ORDERABLE)]


def latest_per_key(df: DataFrame, keys, order_by: Sequence[Column],
                   order_cols: Sequence[str] = (), tiebreak: bool = True) -> DataFrame:
    """Keep one row per key: the first by ``order_by`` (e.g. latest
    ``crawled_at``), ties broken by every other column. NULL keys form one
    group, as with ``dropDuplicates``."""
    ks = _keys(keys)
    order = list(order_by)
    if tiebreak or not order:
        order += tiebreak_columns(df, exclude=ks + list(order_cols))
    w = Window.partitionBy(*ks).orderBy(*(order or [F.lit(0)]))
    rn = "__rn"
    return (df.withColumn(rn, F.row_number().over(w))
              .filter(F.col(rn) == 1).drop(rn))


def any_per_key(df: DataFrame, keys) -> DataFrame:
    """Arbitrary survivor per key (``dropDuplicates``)."""
    return df.dropDuplicates(_keys(keys))


def one_per_key(df: DataFrame, keys) -> DataFrame:
    """One row per non-NULL key, the first by all other columns: whatever the
    scan order, a repeated key leaves the same row."""
    ks = _keys(keys)
    present = df.filter(_keys_present(ks))
    if len(ks) == len(df.columns):
        return present.dropDuplicates(ks)
    return latest_per_key(present, ks, order_by=[])


def upsert(target: DataFrame, source: DataFrame, keys,
           source_order: Sequence[Column] | None = None,
           broadcast_source_keys: bool = False, source_unique: bool = False) -> DataFrame:
    """Insert new keys, replace every non-key column of matched keys.

    Source rows with a NULL key are dropped. A key that the source repeats is
    reduced to one row: the first by ``source_order`` (e.g. latest first), ties
    broken by the other columns. ``source_unique`` skips that step for a source
    that is keyed already (e.g. the output of ``latest_per_key``). Target rows
    whose key is absent from the source are kept: nothing is deleted.

    ``broadcast_source_keys`` is for callers that have measured the keys
    (``broadcast_fits``): the key set is broadcast and the large target streams
    through the anti-join without being shuffled at all.
    """
    ks = _keys(keys)
    src = source.filter(_keys_present(ks))
    if not source_unique:
        src = latest_per_key(src, ks, source_order or [])
    src = src.select(*target.columns)
    key_side = src.select(*ks)
    if broadcast_source_keys:
        key_side = F.broadcast(key_side)
    kept = target.join(key_side, on=ks, how="left_anti")
    return kept.unionByName(src)


#: Bytes of a broadcast row besides its strings (hash slot, pointers, lengths).
ROW_OVERHEAD = 64


def row_bytes(*cols: str) -> Column:
    """Bytes that a row of these columns takes when broadcast: to be summed
    and observed while the rows are computed."""
    size = F.lit(ROW_OVERHEAD + 8 * len(cols))
    for c in cols:
        size = size + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    return size


def broadcast_fits(spark, n_bytes: int) -> bool:
    """Size check for an explicit broadcast: ``n_bytes``, measured (see
    ``row_bytes``), must fit the session's broadcast threshold (10 MB when
    unset, never when disabled)."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    s = str(raw).strip().lower()
    mult = 1
    for suffix, m in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("k", 1 << 10),
                      ("m", 1 << 20), ("g", 1 << 30), ("b", 1)):
        if s.endswith(suffix):
            s, mult = s[: -len(suffix)], m
            break
    limit = int(float(s) * mult)
    return 0 < limit and n_bytes <= limit


def new_rows(target: DataFrame, new: DataFrame, keys, prefilter: bool = False) -> DataFrame:
    """Rows of ``new`` whose key is not yet in ``target`` (one per key).
    ``prefilter`` is for a target much larger than ``new``: a Bloom filter of
    the new keys leaves few of the target's keys to shuffle (``bloom``)."""
    ks = _keys(keys)
    held = target.select(*ks)
    if prefilter:
        from .bloom import may_hold
        held = may_hold(held, new, ks)
    return one_per_key(new, ks).join(held, on=ks, how="left_anti")


def insert_ignore(target: DataFrame, new: DataFrame, keys,
                  defaults: dict | None = None, prefilter: bool = False) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING``: add unseen keys with their other
    columns, keep the rest. Of a repeated key one row is added (``one_per_key``).

    ``defaults`` maps target columns that ``new`` lacks to Column defaults
    (e.g. the frontier's ``status='pending'``, ``created_at=now``); a column
    that ``new`` brings keeps its value. ``prefilter``: see ``new_rows``.
    """
    ks = _keys(keys)
    brought = [c for c in target.columns if c in new.columns]
    added = new_rows(target, new.select(*brought), ks, prefilter)
    for name, value in (defaults or {}).items():
        if name not in brought:
            added = added.withColumn(name, value)
    return target.unionByName(added.select(*target.columns))


def observed_count(df: DataFrame, name: str) -> tuple[DataFrame, object]:
    """Attach a row counter evaluated by whatever action runs next (no rescan).

    Returns ``(df, observation)``; read ``observation.get[name]`` after the
    action, e.g. the number of rows an insert added.
    """
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias(name)), obs


def update_status(frontier: DataFrame, done: DataFrame, key: str = "url",
                  status_col: str = "status", new_status: str = S.CRAWLED) -> DataFrame:
    """Set ``status = new_status`` for keys present in ``done``; others keep
    their status. ``done`` is reduced to distinct keys before the join."""
    hit = "__hit"
    marks = done.select(key).dropDuplicates([key]).withColumn(hit, F.lit(True))
    return (frontier.join(marks, on=key, how="left")
                    .withColumn(status_col, F.when(F.col(hit), F.lit(new_status))
                                             .otherwise(F.col(status_col)))
                    .drop(hit).select(*frontier.columns))


def key_violations(df: DataFrame, keys) -> DataFrame:
    """Primary-key check: keys that occur more than once or are NULL, with
    their row count. Empty result = the key is a valid primary key."""
    ks = _keys(keys)
    any_null = F.lit(False)
    for k in ks:
        any_null = any_null | F.col(k).isNull()
    return (df.groupBy(*ks).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter((F.col("n_rows") > 1) | any_null))


def assert_primary_key(df: DataFrame, keys) -> None:
    """Raise when ``keys`` is not a primary key of ``df`` (one small job)."""
    bad = key_violations(df, keys).limit(5).collect()
    if bad:
        raise ValueError(f"primary key {list(_keys(keys))} violated: {bad}")
