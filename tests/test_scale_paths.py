"""Plan-shape and environment checks for the paths that matter at scale."""

import pytest
from pyspark.sql import functions as F

from rivulet.operators import logs as L
from rivulet.plans import catalog as C, fixtures as FX

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_device_path_gives_same_answer(spark):
    tagged = L.tag_lines(FX.log_lines(spark, SF))
    cols = ["seq", "first_visit", "is_new_fixed"]
    base = sorted(tuple(r) for r in L.repair_flags(tagged).select(*cols).collect())
    for k in (5, 1000):
        hot = L.repair_flags(tagged, hot_rows=3, max_hot_keys=k)
        assert sorted(tuple(r) for r in hot.select(*cols).collect()) == base
    n_hot = L.first_visits(tagged).where(F.col("rows") >= 3).count()
    assert n_hot > 5           # with k=5 the top-k bound is what limits the broadcast


def test_flag_repair_plan_shape(spark):
    f = L.run_log_job(FX.log_lines(spark, SF))
    f.collect()                                              # settle the adaptive plan
    plan = _plan(f)
    final = plan.split("== Initial Plan ==")[0]
    assert "Window" not in plan
    assert "BroadcastHashJoin" in final
    assert "SortAggregate" not in plan       # DATE days keep min_by hash-aggregatable
    # hot and cold branches share one aggregation: the topic is scanned twice, not three times
    assert "ReusedExchange" in final
    assert final.count("FileScan") <= 2


@pytest.mark.parametrize("tz", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_date_columns_ignore_session_zone(spark, tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    base = sorted(tuple(r) for r in C.date_columns(spark, SF).collect())
    try:
        spark.conf.set("spark.sql.session.timeZone", tz)
        assert sorted(tuple(r) for r in C.date_columns(spark, SF).collect()) == base
        got = sorted(tuple(r) for r in C.visitor_fix(spark, SF).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == sorted(tuple(r) for r in C.visitor_fix(spark, SF).collect())


def test_fallback_paths_without_broadcast_agree(spark):
    """Above the checked sizes the joins run as shuffle joins; same answers."""
    from rivulet.operators import changes as CH, configs as CF, dims as D
    ch = CH.filter_changes(CH.parse_changes(FX.change_lines(spark, SF)))
    hist = CF.config_images(FX.config_lines(spark, SF))
    versions = CF.config_versions(hist)
    small = CF.route_asof(ch, versions)
    big = CF.route_asof(ch, versions, max_broadcast=0)
    cols = ["seq", "table", "type", "data_text", "cseq", *CF.CONFIG_FIELDS[1:]]
    assert small.columns == big.columns
    assert sorted(tuple(r) for r in big.select(*cols).collect()) == \
        sorted(tuple(r) for r in small.select(*cols).collect())
    big.select(*cols).collect()
    plan = _plan(big)
    assert "Join" not in plan                                # a merge, no versions x changes
    log = D.change_log(small)
    a = D.fold_current(D.cells(log), D.row_deletes(log), D.table_drops(hist))
    b = D.fold_current(D.cells(log), D.row_deletes(log), D.table_drops(hist), max_broadcast=0)
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())
    snap = FX.config_snapshot(spark, SF)
    s1 = CF.route_static(ch, snap).select("seq", "sink_table")
    s2 = CF.route_static(ch, snap, max_broadcast=0).select("seq", "sink_table")
    assert sorted(tuple(r) for r in s1.collect()) == sorted(tuple(r) for r in s2.collect())


def test_flag_repair_shuffle_join_path(spark):
    """With automatic broadcasts off (as for a very large device table) the
    cold join runs as a sort-merge join on (device, salt); same answers."""
    tagged = L.tag_lines(FX.log_lines(spark, SF))
    cols = ["seq", "first_visit", "is_new_fixed"]
    base = sorted(tuple(r) for r in L.repair_flags(tagged).select(*cols).collect())
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        f = L.repair_flags(tagged, hot_rows=3, max_hot_keys=5).select(*cols)
        assert sorted(tuple(r) for r in f.collect()) == base
        assert "SortMergeJoin" in _plan(f)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_asof_merge_across_buckets(spark, monkeypatch):
    """The merge carries versions over bucket borders, preloads and deletes
    included, and equals the lookup, which tests every version."""
    from rivulet.operators import configs as CF
    monkeypatch.setattr(CF, "BUCKET_BITS", 4)
    history = spark.range(60).select(
        (F.col("id") * 13).alias("cseq"), F.when(F.col("id") % 5 == 3, "d").otherwise("u").alias("op"),
        F.concat(F.lit("t"), F.col("id") % 3).alias("source_table"), F.concat(F.lit("s"), "id").alias("sink_table"),
        F.lit("id").alias("sink_columns"), F.lit("f").alias("sink_family"), F.lit("id").alias("sink_row_key"))
    preload = spark.range(4).select(F.concat(F.lit("t"), "id").alias("source_table"), F.lit("first").alias("sink_table"),
                                    *[F.lit("id").alias(c) for c in CF.CONFIG_FIELDS[2:]])
    changes = spark.range(0, 3000, 3).select(
        (F.col("id") - 100).alias("seq"), F.when(F.col("id") % 11 != 0, F.concat(F.lit("t"), F.col("id") % 5)).alias("table"))
    for first in (None, preload):
        v = CF.config_versions(history, first)
        want = CF.route_asof(changes, v)
        got = CF.route_asof(changes, v, max_versions=0)
        assert "Join" in _plan(want) and "Join" not in _plan(got)
        rows = sorted(tuple(r) for r in got.collect())
        assert rows == sorted(tuple(r) for r in want.collect()) and len(rows) > 300


def test_dimension_fold_reads_changes_once(spark):
    cur = C.dim_current(spark, SF)
    changes = FX.change_lines(spark, SF).inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    plan = _plan(cur)
    assert sum("FileScan" in line and changes.rsplit("/", 1)[1] in line for line in plan.splitlines()) <= 1
    assert plan.count("data_text") and "SortMergeJoin" not in plan
