"""Gold and silver lose and double nothing: late and undated crawls, corrected
landings, concurrent publishers, refused versions."""

import os

import pytest
from pyspark.sql import functions as F

from homestead import schemas as S
from homestead.plans.etl import (plan_gold_merge, publish_gold, read_gold, run_bronze_to_silver, run_etl,
                                 run_silver_to_gold)
from homestead.sources.bronze import land_bronze, read_bronze
from homestead.sources.tables import (PublishConflict, committed_versions, last_note, publish_buckets, publish_version,
                                      read_partitioned, read_versioned, write_partitioned)
from homestead.session import settings
from test_io_stream import DOC, scratch, write_docs

STAMP = "2026-06-01 02:00:00"


def doc(name, when, **more):
    return dict(DOC, url=f"https://site.example/{name}", crawled_at=when, **more)


def paths(root):
    return f"{root}/bronze", f"{root}/silver", f"{root}/gold"


def gold_of(spark, root):
    return sorted(map(tuple, read_gold(spark, f"{root}/gold").collect()), key=repr)


def rebuilt(spark, bronze):
    root = scratch()
    run_etl(spark, bronze, *paths(root)[1:], loaded_at=STAMP)
    return gold_of(spark, root), sorted(map(str, read_partitioned(spark, f"{root}/silver").select(*S.SILVER_COLUMNS).collect()))


def test_late_undated_old_and_tied_crawls_equal_a_rebuild(spark):
    root = scratch()
    args = paths(root)
    landings = [
        [doc("a", "2026-05-02T10:00:00"), doc("b", None, title="undated b"), doc("c", "2026-05-02T10:00:00", title="m")],
        [doc("a", None, title="undated a"), doc("b", "2026-05-01T00:00:00"), doc("c", "2026-05-02T10:00:00", title="k")],
        [doc("a", "2023-01-01T00:00:00", title="old a"), doc("b", None, title="another"), doc("c", "2026-05-02T10:00:00", title="z"),
         doc("d", None, title="y"), doc("d", None, title="x")],
        [doc("a", "2026-05-02T10:00:01", title="newest a"), doc("d", None, title="w"), doc("e", "2026-05-02T10:00:00")],
    ]
    for i, docs in enumerate(landings):
        day = f"2026-06-0{i + 1}"
        write_docs(args[0], day, docs)
        for _ in range(2):                                 # a rerun changes nothing
            run_etl(spark, *args, loaded_at=STAMP, incremental=i > 0, since=day if i else None)
        gold, silver = rebuilt(spark, args[0])
        assert gold_of(spark, root) == gold
        assert sorted(map(str, read_partitioned(spark, args[1]).select(*S.SILVER_COLUMNS).collect())) == silver
    titles = {r.url[-1]: r.title for r in read_gold(spark, args[2]).collect()}
    assert titles == {"a": "newest a", "b": DOC["title"], "c": "k", "d": "w", "e": DOC["title"]}


def test_incremental_run_reads_its_landings_and_touched_buckets_only(spark):
    root = scratch()
    args = paths(root)
    write_docs(args[0], "2026-05-01", [doc(str(i), "2026-05-01T00:00:00") for i in range(100)])
    run_etl(spark, *args, loaded_at=STAMP)
    write_docs(args[0], "2026-05-02", [doc("7", "2023-05-02T00:00:00"), doc("8", "2026-05-02T00:00:00")])
    run_bronze_to_silver(spark, args[0], args[1], incremental=True, since="2026-05-02")
    plan = plan_gold_merge(spark, args[1], args[2], loaded_at=STAMP, since="2026-05-02")
    assert plan.silver_obs.get["n"] == 2 and len(plan.buckets) <= 2
    files = plan.merged.inputFiles()
    assert files and all(any(f"bucket={b}" in f for b in plan.buckets) for f in files if "/gold/" in f)
    publish_gold(spark, plan, args[2])
    days = {r.url.rsplit("/", 1)[1]: str(r.dt) for r in read_gold(spark, args[2]).collect()}
    assert len(days) == 100 and days["7"] == "2026-05-01" and days["8"] == "2026-05-02"


def test_corrected_landing_leaves_nothing_of_the_old_one(spark):
    root = scratch()
    args = paths(root)
    write_docs(args[0], "2026-05-01", [doc("x", "2026-04-30T00:00:00")])
    write_docs(args[0], "2026-05-02", [doc("a", "2026-05-01T00:00:00"), doc("b", "2026-05-02T00:00:00", title="b first")])
    run_etl(spark, *args, loaded_at=STAMP)
    write_docs(args[0], "2026-05-02", [doc("b", "2026-05-02T00:00:00", title="corrected b")])
    run_etl(spark, *args, loaded_at=STAMP, incremental=True, since="2026-05-02")
    silver = read_partitioned(spark, args[1])
    assert sorted((r.url[-1], r.title) for r in silver.collect()) == [("b", "corrected b"), ("x", DOC["title"])]
    titles = {r.url[-1]: r.title for r in read_gold(spark, args[2]).collect()}
    assert titles["b"] == "corrected b"                    # the same moment, but its landing was read again
    write_docs(args[0], "2026-05-02", [doc("q", "2026-05-02T00:00:00", title=" ")])
    run_bronze_to_silver(spark, args[0], args[1], incremental=True, since="2026-05-02")
    assert [r.url[-1] for r in read_partitioned(spark, args[1]).collect()] == ["x"]     # an unfit landing empties its day


def test_second_publisher_of_the_same_buckets_must_plan_again(spark):
    root = scratch()
    silver = {}
    for name in "abc":
        write_docs(f"{root}/{name}/bronze", "2026-05-01", [doc(name, "2026-05-01T00:00:00")])
        run_bronze_to_silver(spark, f"{root}/{name}/bronze", f"{root}/{name}/silver")
        silver[name] = f"{root}/{name}/silver"
    gold = f"{root}/gold"
    run_silver_to_gold(spark, silver["a"], gold, loaded_at=STAMP, n_buckets=1)
    one, two = (plan_gold_merge(spark, silver[n], gold, loaded_at=STAMP, n_buckets=1) for n in "bc")
    publish_gold(spark, one, gold, n_buckets=1)
    with pytest.raises(PublishConflict, match="plan again"):
        publish_gold(spark, two, gold, n_buckets=1)
    publish_gold(spark, plan_gold_merge(spark, silver["c"], gold, loaded_at=STAMP, n_buckets=1), gold, n_buckets=1)
    assert sorted(r.url[-1] for r in read_gold(spark, gold).collect()) == ["a", "b", "c"]
    assert committed_versions(spark, gold) == [1, 2, 3] and not [f for f in os.listdir(gold) if f.startswith("_pub")]


def test_publishers_of_different_buckets_do_not_collide(spark):
    root = f"{scratch()}/t"
    df = spark.createDataFrame([(f"k{i}",) for i in range(40)], "url string")
    publish_buckets(df, root, "url", 8)
    from homestead.sources.tables import bucket_of
    named = df.withColumn("b", bucket_of("url", 8))
    first, second = sorted({r.b for r in named.collect()})[:2]
    for b in (first, second):                              # both planned on version 1
        publish_buckets(named.where(F.col("b") == b).drop("b"), root, "url", 8, base=1, buckets=[b])
    assert read_versioned(spark, root).count() == 40


def test_other_bucket_count_is_refused(spark):
    root = scratch()
    args = paths(root)
    write_docs(args[0], "2026-05-01", [doc("a", "2026-05-01T00:00:00")])
    run_bronze_to_silver(spark, *args[:2])
    run_silver_to_gold(spark, *args[1:], loaded_at=STAMP, n_buckets=4)
    with pytest.raises(ValueError, match="4 buckets, not 8"):
        run_silver_to_gold(spark, *args[1:], loaded_at=STAMP, n_buckets=8)
    with pytest.raises(ValueError, match="4 buckets, not 8"):
        publish_buckets(read_versioned(spark, args[2]), args[2], "url", 8)
    assert read_gold(spark, args[2]).count() == 1


def test_refused_version_is_never_committed(spark):
    root = f"{scratch()}/t"
    publish_version(spark.createDataFrame([("a",)], "url string"), root, note={"stream": "s", "batch": 3})
    from homestead.operators.keyed import assert_primary_key
    twice = spark.createDataFrame([("b",), ("b",)], "url string")
    with pytest.raises(ValueError, match="primary key"):
        publish_version(twice, root, check=lambda df: assert_primary_key(df, ["url"]))
    assert committed_versions(spark, root) == [1] and [r.url for r in read_versioned(spark, root).collect()] == ["a"]
    publish_version(spark.createDataFrame([("c",)], "url string"), root)
    assert committed_versions(spark, root) == [1, 2]       # the refused copy is overwritten
    assert last_note(spark, root, stream="s") == {"stream": "s", "batch": 3} and last_note(spark, root, stream="t") is None


def test_failed_rebuild_leaves_the_old_table(spark):
    path = f"{scratch()}/t"
    good = spark.createDataFrame([(1, "2026-05-01")], "id int, dt string")
    write_partitioned(good, path)
    with pytest.raises(Exception, match="(?i)lost"):
        write_partitioned(good.withColumn("id", F.raise_error(F.lit("lost midway")).cast("int")), path)
    assert [(r.id, str(r.dt)) for r in spark.read.parquet(path).collect()] == [(1, "2026-05-01")]
    write_partitioned(spark.read.parquet(path).withColumn("id", F.lit(2)), path)       # even from itself
    assert [r.id for r in spark.read.parquet(path).collect()] == [2]
    assert not [f for f in os.listdir(os.path.dirname(path)) if "__old" in f]


def test_slug_landed_twice_on_a_day_is_overwritten(spark):
    root = f"{scratch()}/b"
    schema = "url string, title string, crawled_at string"

    def land(*rows):
        land_bronze(spark.createDataFrame(rows, schema), root, same_day_last_wins=True)
    land(("https://a.example/z", "first", "2026-05-01T10:00:00"), ("https://a.example/y", "stays é", "2026-05-01T10:00:00"),
         ("https://a.example/z", "other day", "2026-05-02T10:00:00"))
    os.makedirs(f"{root}/dt=2026-05-01", exist_ok=True)
    with open(f"{root}/dt=2026-05-01/more.json", "w", encoding="utf-8") as f:
        f.write('{nope\n{"url": "https://a.example/w", "unknown": 5}\n')
    land(("https://b.example/x/z/", "second", "2026-05-01T09:00:00"))
    got = sorted((str(r.dt), r.url or "", r.title or "") for r in read_bronze(spark, root).collect())
    assert got == [("2026-05-01", "", ""), ("2026-05-01", "https://a.example/w", ""), ("2026-05-01", "https://a.example/y", "stays é"),
                   ("2026-05-01", "https://b.example/x/z/", "second"), ("2026-05-02", "https://a.example/z", "other day")]
    raw = "".join(open(os.path.join(d, f), encoding="utf-8").read() for d, _, fs in os.walk(f"{root}/dt=2026-05-01") for f in fs if f[0] not in "._")
    assert '"unknown": 5' in raw and "{nope" in raw        # lines that stay are as they were


LANDINGS = [
    [doc("a", "2026-05-02T10:00:00"), doc("b", None, title="undated b"), doc("c", "2026-05-02T10:00:00", title="m"),
     doc("f", "2026-05-02T10:00:00", title="stays")],
    [doc("a", None, title="undated a"), doc("b", "2026-05-01T00:00:00"), doc("c", "2026-05-02T10:00:00", title="k"),
     doc("c", "2026-05-02T10:00:00", title="l"), doc("f", "2026-05-01T10:00:00", title="older")],
    [doc("a", "2023-01-01T00:00:00", title="old a"), doc("b", None, title="another"), doc("d", None, title="y"), doc("d", None, title="x")],
]


def three_runs(spark, root):
    """Gold after each of three landings, each run twice."""
    args, found, counts = paths(root), [], []
    for i, docs in enumerate(LANDINGS):
        day = f"2026-06-0{i + 1}"
        write_docs(args[0], day, docs)
        for _ in range(2):
            counts.append(run_etl(spark, *args, loaded_at=STAMP, incremental=i > 0, since=day if i else None))
        found.append(gold_of(spark, root))
    return found, [(c.silver_rows, c.gold_batch_rows, c.gold_rows) for c in counts]


def test_batches_too_large_to_broadcast_meet_gold_in_one_shuffle(spark, monkeypatch):
    from homestead.plans import etl
    small, counts = three_runs(spark, scratch())
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        root = scratch()
        large, own = three_runs(spark, root)
        assert large == small and own == counts
        monkeypatch.setattr(etl, "BUCKET_PART_ROWS", 2)        # several parts a bucket, and every url with crawls enough is hot
        assert three_runs(spark, scratch()) == (small, counts)
        args = paths(root)
        plan = plan_gold_merge(spark, args[1], args[2], loaded_at=STAMP, since="2026-06-03")
        plan.merged.write.format("noop").mode("overwrite").save()
        phys = plan.merged._jdf.queryExecution().executedPlan().toString()
        assert not plan.broadcast_keys and "Join" not in phys and phys.split("Initial Plan")[0].count("Exchange hashpartitioning(bucket") == 1
        assert [c for c in plan.merged.columns if c not in etl.GOLD_INPUT] == ["load", "gold_loaded_at", "bucket"]


def test_a_url_with_most_crawls_is_reduced_before_it_is_dealt(spark, monkeypatch):
    from homestead.plans import etl
    root = scratch()
    args = paths(root)
    write_docs(args[0], "2026-05-01", [doc("hot", f"2026-05-01T00:{i:02d}:00", title=f"t{i}") for i in range(60)] + [doc("cold", None)])
    monkeypatch.setattr(etl, "BUCKET_PART_ROWS", 100)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        run_etl(spark, *args, loaded_at=STAMP)
        plan = plan_gold_merge(spark, args[1], args[2], loaded_at=STAMP)
        assert "WindowGroupLimit" in plan.merged._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.title for r in read_gold(spark, args[2]).collect()) == [DOC["title"], "t59"]


def test_gold_stored_with_a_tie_struct_is_merged_as_before(spark):
    root = scratch()
    args = paths(root)
    write_docs(args[0], "2026-06-01", LANDINGS[0])
    run_etl(spark, *args, loaded_at=STAMP)
    from homestead.plans.gold import TIE, stored_crawls
    now = read_versioned(spark, args[2])
    held = stored_crawls(now)
    old = (held.select(S.GOLD_KEY, F.col("crawled_at").alias("_crawled_at"), F.struct(*TIE).alias("_tie"), F.col("load").alias("_load"))
           .join(now.select(*S.GOLD_COLUMNS), S.GOLD_KEY).select(*S.GOLD_COLUMNS, "_crawled_at", "_tie", "_load"))
    before = sorted(map(str, held.collect()))
    assert sorted(map(str, stored_crawls(old).collect())) == before


def test_silver_is_derived_behind_its_shuffle(spark):
    from homestead.plans.silver import bronze_to_silver, narrow, widen
    root = scratch()
    write_docs(root, "2026-06-01", [d for docs in LANDINGS for d in docs] + [doc("q", None, title=" ")])
    bronze = read_bronze(spark, root)
    assert "price" not in narrow(bronze).columns and "city" not in narrow(bronze).columns
    assert sorted(map(str, widen(narrow(bronze)).collect())) == sorted(map(str, bronze_to_silver(bronze).collect()))
