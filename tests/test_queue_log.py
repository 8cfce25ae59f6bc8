"""The queue as a log: leases are exclusive, expire, and survive compaction."""

import datetime as dt
import os
import threading

import pytest

from homestead.operators import queue_log as QL
from homestead.sources import tables
from homestead.sources.tables import PublishConflict, committed_versions
from test_io_stream import scratch

NOW, HOUR = dt.datetime(2026, 1, 1), dt.timedelta(hours=1)


def urls(df):
    return sorted(r.url for r in df.collect())


def frame(spark, *names, at="2026-01-01 00:00:00"):
    return spark.createDataFrame([(n, None if at is None else at) for n in names], "url string, created_at string")


def test_take_lease_expire_land_and_compact(spark):
    root = f"{scratch()}/q"
    QL.enqueue(frame(spark, "c", "d", "d", None, at="2026-01-02 00:00:00"), root)
    QL.enqueue(frame(spark, "a", "b", "c"), root)          # c is known: it keeps its first moment
    QL.enqueue(frame(spark, "n", at=None), root)
    assert urls(QL.take(spark, root, 3, "one", NOW, HOUR)) == ["a", "b", "c"]
    assert urls(QL.take(spark, root, 9, "two", NOW + HOUR / 2, HOUR)) == ["d", "n"]
    assert urls(QL.take(spark, root, 9, "three", NOW + HOUR / 2, HOUR)) == []
    QL.land(frame(spark, "a", "unknown", "d"), root)
    QL.compact(spark, root)
    assert urls(QL.take(spark, root, 9, "three", NOW + HOUR, HOUR)) == ["b", "c"]     # expired; d and n are not
    state = {r.url: (r.status, r.owner, str(r.created_at)) for r in QL.state(spark, root).collect()}
    assert state == {"a": ("crawled", "one", "2026-01-01 00:00:00"), "b": ("pending", "three", "2026-01-01 00:00:00"),
                     "c": ("pending", "three", "2026-01-02 00:00:00"), "d": ("crawled", "two", "2026-01-02 00:00:00"),
                     "n": ("pending", "two", "None")}


def test_steps_write_only_their_batch(spark):
    root = f"{scratch()}/q"
    QL.enqueue(frame(spark, *[f"u{i}" for i in range(500)]), root)
    for path, n in ((QL.land(frame(spark, "u1", "u2"), root), 2),):
        assert spark.read.parquet(path).count() == n
    QL.take(spark, root, 7, "one", NOW, HOUR)
    assert spark.read.parquet(f"{root}/v=3").count() == 7
    QL.compact(spark, root)
    files = QL._log(spark, root).inputFiles()
    assert files and all("/v=4/" in f for f in files)      # readers start at the compaction


def test_a_take_that_saw_an_old_log_plans_again(spark, monkeypatch):
    root = f"{scratch()}/q"
    QL.enqueue(frame(spark, "a", "b", "c", "d"), root)
    publish, other = QL.publish_version, []

    def slow(events, at, base=None, note=None):
        if not other:                                      # another taker comes between reading and publishing
            other.append(None)
            monkeypatch.setattr(QL, "publish_version", publish)
            other[0] = urls(QL.take(spark, root, 2, "fast", NOW, HOUR))
        return publish(events, at, base=base, note=note)
    monkeypatch.setattr(QL, "publish_version", slow)
    mine = urls(QL.take(spark, root, 2, "slow", NOW, HOUR))
    assert other[0] == ["a", "b"] and mine == ["c", "d"]
    with pytest.raises(PublishConflict):
        tables.publish_version(frame(spark, "x"), root, base=1)


def test_takers_at_once_share_nothing(spark):
    root = f"{scratch()}/q"
    QL.enqueue(frame(spark, *"abcdef"), root)
    got, errors = {}, []

    def work(owner):
        try:
            got[owner] = urls(QL.take(spark, root, 2, owner, NOW, HOUR))
        except Exception as exc:
            errors.append(exc)
    threads = [threading.Thread(target=work, args=(o,)) for o in ("one", "two", "three")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and sorted(sum(got.values(), [])) == list("abcdef")
    assert committed_versions(spark, root) == [1, 2, 3, 4]
    assert not [f for f in os.listdir(root) if f.startswith("_publishing")]
