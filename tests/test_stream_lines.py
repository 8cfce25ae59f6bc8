"""How the streams read landed lines: compressed files by several tasks, as the JSON scan does."""

import json
import os

from pyspark.sql import functions as F

from homestead.plans import catalog as C
from homestead.sources.bronze import read_bronze
from homestead.streaming import ingest as I
from test_io_stream import DOC, scratch

ODD = [json.dumps(DOC, ensure_ascii=False), "", "  ", "{nope", "null", "[]", json.dumps([DOC, dict(DOC, url="v")]), "\t" + json.dumps([DOC]),
       '[{"url": "x"},', json.dumps(dict(DOC, short_info="abc")), json.dumps(dict(DOC, title=5)), json.dumps(dict(DOC, specs=[1])), "5",
       json.dumps(DOC) + " more", '[{"url": "p", "specs": "abc"}, {"url": "q"}]', '{"dt": "2020-01-01", "url": "z"}', '{"url": null}']


def _bytes(root):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root.replace("file:", "")) for f in fs if f.startswith("part-"))


def test_lines_are_parsed_as_the_json_scan_does(spark):
    root = scratch()
    os.makedirs(f"{root}/b/dt=2026-06-01")
    with open(f"{root}/b/dt=2026-06-01/part-0.json", "w", encoding="utf-8") as f:
        f.write("\n".join(ODD))
    cols = ["url", "title", "address", "short_info", "specs", "crawled_at", "_corrupt_record"]
    want = read_bronze(spark, f"{root}/b").select(*cols, F.col("dt").alias("load"))
    lines = spark.read.schema("value string, dt date").text(f"{root}/b")
    some = F.coalesce("url", "_corrupt_record").isNotNull()         # a line of nothing is a row of nulls or none
    got = I.parsed(lines).select(*cols, "load")
    assert sorted(map(str, got.filter(some).collect())) == sorted(str(r) for r in want.collect() if r.url is not None or r._corrupt_record is not None)


def test_a_compressed_file_is_read_by_several_tasks(spark):
    assert spark.sparkContext.defaultParallelism == 4
    for files, unions in ((1, 4), (2, 2), (1000, 1)):
        plan = I.bronze_stream(spark, scratch(), files)._jdf.queryExecution().analyzed().toString()
        assert plan.count("StreamingRelation") == unions


def test_every_line_of_a_compressed_landing_is_in_silver_once(spark):
    root = C._landed_by_line(spark, "/root/testdata/sf0.001", "lines", 3)
    plain = scratch()
    read_bronze(spark, f"{root}/bronze").drop("_corrupt_record").write.partitionBy("dt").json(f"{plain}/b")
    assert 4 * _bytes(f"{root}/bronze") < _bytes(f"{plain}/b")
    I.ingest_bronze_stream(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck", 1)
    got = spark.read.parquet(f"{root}/silver").drop("batch")
    want = I.bronze_to_silver(read_bronze(spark, f"{root}/bronze").withColumnRenamed("dt", "load"), keep=("load",)).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
