"""Device state in buckets: a batch reads those of its own devices only."""

import os

from pyspark.sql import functions as F

from rivulet.operators import logs as L
from rivulet.plans import catalog as C, fixtures as FX
from rivulet.plans.extract import extract_routed
from rivulet.session import local_path, scratch_path
from rivulet.streaming import jobs as J
from test_apps import _rows

SF = "/root/testdata/sf0.001"


def _parts(state, upto):
    return [n for n in os.listdir(f"{local_path(state)}/visit_snapshot/upto={upto}") if n.startswith("bucket=")]


def test_batch_reads_the_buckets_of_its_devices(spark):
    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")
    lines = FX.log_lines(spark, SF)
    write = J.log_batch_writer(out, state, compact_every=1, bucket_devices=1)
    cuts = [lines.where(F.col("seq").between(a, b)) for a, b in ((0, 400), (401, 800), (801, 10 ** 9))]
    for i, cut in enumerate(cuts):
        write(cut, i)
    whole = J.known_visits(spark, state, 3)
    expected = _rows(L.first_visits(L.tag_lines(lines)).select("mid", "first_visit"))
    assert _rows(whole) == expected and len(_parts(state, 2)) > 4
    one = spark.createDataFrame([(expected[0][0],), (expected[0][0],), (None,)], "mid string")
    few = J.known_visits(spark, state, 3, one)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    got = _rows(few)
    assert expected[0] in got and len(got) < len(expected)
    assert all(r in expected for r in got)
    # devices nobody knows, and none at all
    assert expected[0] not in _rows(J.known_visits(spark, state, 3, one.where("mid is null")))
    cols = ["topic", "seq", "mid", "is_new", "page_id"]
    got = extract_routed(J.committed_topics(spark, out, state)).select(*cols)
    want = C.route_all(spark, SF).select(*cols)
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()


def test_bucket_count_follows_the_devices(spark):
    state = scratch_path(spark, "state")
    (spark.range(1000).select(F.concat(F.lit("d"), "id").alias("mid"), F.lit("2024-01-01").cast("date").alias("first_visit"))
     .write.parquet(f"{state}/visits/batch=0"))
    J.compact_visits(spark, state, 0, bucket_devices=100)
    assert len(_parts(state, 0)) == 16
    J.compact_visits(spark, state, 0, bucket_devices=1)       # complete: not written over
    assert len(_parts(state, 0)) == 16
    few = J.known_visits(spark, state, 1, spark.createDataFrame([("d7",)], "mid string"))
    assert 20 < few.count() < 200 and few.where("mid = 'd7'").count() == 1
    # a snapshot without buckets, as written before they were
    old = scratch_path(spark, "state")
    spark.read.parquet(f"{state}/visits/batch=0").write.parquet(f"{old}/visit_snapshot/upto=0")
    spark.range(1).select(F.lit(1).alias("done")).write.parquet(f"{old}/visit_snapshot_done/upto=0")
    assert J.known_visits(spark, old, 1, spark.createDataFrame([("d7",)], "mid string")).count() == 1000


def test_flag_repair_alone(spark):
    """Repaired lines by batch: batches that run again give what they gave,
    dirty lines stay, only marked batches count."""
    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")
    lines = FX.log_lines(spark, SF)
    cuts = [lines.where(F.col("seq") <= 500), lines.where(F.col("seq") > 500)]
    write = J.fixed_batch_writer(out, state, compact_every=1, keep_batches=1, bucket_devices=2)
    for i in (0, 1, 1):
        write(cuts[i], i)
    want = L.repair_flags(L.tag_lines(lines)).select(*J.FIXED_COLUMNS)
    got = spark.read.parquet(out).select(*J.FIXED_COLUMNS)
    assert _rows(got) == _rows(want) and J.committed(spark, state) == 1
    assert sum(r["lines"] for r in J.read_counts(spark, state, ("lines",)).collect()) == lines.count()
