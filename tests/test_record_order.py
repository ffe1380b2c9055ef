"""Topics with partitions: order by record time, in both forms of the as-of join."""

import pytest
from pyspark.sql import functions as F

from rivulet.operators import configs as CF, logs as L
from rivulet.plans import catalog as C, fixtures as FX
from rivulet.session import scratch_path
from rivulet.sources.topics import read_topic, read_topics
from rivulet.streaming import jobs as J
from rivulet.streaming.apps import main
from test_apps import _rows

SF = "/root/testdata/sf0.001"


def test_both_joins_agree_by_time(spark):
    assert _rows(C.config_asof_partitions(spark, SF)) == _rows(C.config_asof_partitions(spark, SF, max_versions=0))


def test_hot_devices_are_spread_by_time(spark):
    assert _rows(C.visitor_fix_partitions(spark, SF)) == _rows(C.visitor_fix_partitions(spark, SF, hot_rows=2))


def test_versions_at_equal_times(spark):
    """Config comes before a change of the same record order; at equal times
    partition and offset decide; a preload comes before everything."""
    key = "struct<time:timestamp,partition:int,offset:bigint>"
    at = lambda s, p, o: f"named_struct('time', timestamp_seconds({s}), 'partition', {p}, 'offset', {o}L)"
    row = "'t' source_table, '{}' sink_table, 'id' sink_columns, 'f' sink_family, 'id' sink_row_key"
    history = spark.sql(f"select {at(100, 1, 5)} cseq, 'u' op, " + row.format("b")
                        + f" union all select {at(100, 2, 0)}, 'u', " + row.format("c"))
    preload = spark.sql("select " + row.format("a"))
    changes = spark.sql(" union all ".join(
        f"select cast({at(*k)} as {key}) seq, 't' table" for k in
        ((0, 0, 0), (100, 0, 9), (100, 1, 4), (100, 1, 5), (100, 1, 6), (100, 2, 0), (10 ** 9, 0, 0))))
    versions = CF.config_versions(history, preload)
    for limit in (64, 0):
        got = CF.route_asof(changes, versions, max_versions=limit).orderBy("seq").select("sink_table").collect()
        assert "".join(r[0] for r in got) == "aaabbcc"


def test_log_batches_by_time(spark):
    """The streaming job over records: topics carry the order key."""
    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")
    path = FX.records(spark, SF, "log_records", FX.log_lines)
    lines = read_topic(spark, path=path, stream=False, order="time")
    J.log_batch_writer(out, state)(lines, 0)
    kind = "struct<time:timestamp,partition:int,offset:bigint>"
    got = read_topics(spark, out, seq_type=kind).select("topic", "seq", "pos", "value")
    assert _rows(got) == _rows(L.run_log_job(lines).select("topic", "seq", "pos", "value"))
    assert got.where(F.col("seq.partition").isNull()).count() == 0
    with pytest.raises(ValueError):
        read_topic(spark, path=path, order="offset")


def test_log_app_by_time(spark):
    """From the command line, over files; one batch, so the batch job's rows."""
    path = FX.records(spark, SF, "log_records", FX.log_lines)
    out, state, ck = (scratch_path(spark, n) for n in ("out", "state", "ck"))
    main(["log", "--source-format", "parquet", "--source-path", path, "--sink-path", out, "--state-dir", state,
          "--checkpoint", ck, "--record-order", "time", "--bucket-devices", "100", "--available-now"])
    kind = "struct<time:timestamp,partition:int,offset:bigint>"
    lines = read_topic(spark, path=path, stream=False, order="time")
    got = read_topics(spark, out, seq_type=kind).select("topic", "seq", "pos", "value")
    assert _rows(got) == _rows(L.run_log_job(lines).select("topic", "seq", "pos", "value"))
