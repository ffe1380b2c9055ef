"""Streaming: restart from a checkpoint, replayed batches, random batch borders."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rivulet.operators import logs as L
from rivulet.plans import catalog as C, fixtures as FX
from rivulet.plans.extract import extract_routed
from rivulet.session import scratch_path
from rivulet.sources.topics import land_lines, read_topic, read_topics
from rivulet.streaming import jobs as J
from rivulet.streaming.visitor import OUT_SCHEMA, repair_flags_stream

SF = "/root/testdata/sf0.001"
COLS = ["topic", "seq", "pos", "mid", "is_new", "ts", "page_id"]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _run_routes(spark, src, out, ck, files=2, **options):
    lines = read_topic(spark, fmt="parquet", path=src, max_files_per_trigger=files)
    q = J.run_stream(lines, ck, foreach_batch=J.log_batch_writer(out, f"{ck}-state", **options), available_now=True)
    q.awaitTermination()
    assert q.exception() is None


def test_log_stream_restart_resumes_from_checkpoint(spark):
    lines = FX.log_lines(spark, SF)
    src, out, ck = (scratch_path(spark, n) for n in ("src", "out", "ck"))
    land_lines(lines.where(F.col("seq") < 400), src, 2, 2)
    _run_routes(spark, src, out, ck)
    first = read_topics(spark, out).count()
    land_lines(lines.where(F.col("seq") >= 400), src, 2, 2)
    _run_routes(spark, src, out, ck)          # same checkpoint: only the new files
    got = extract_routed(read_topics(spark, out)).select(*COLS)
    assert 0 < first < got.count()
    assert _rows(got) == _rows(C.route_all(spark, SF))


def test_replayed_batch_overwrites_its_output(spark):
    out = scratch_path(spark, "out")
    routed = L.run_log_job(FX.log_lines(spark, SF))
    write = J.topic_sink(out)
    write(routed, 7)
    write(routed, 7)                            # a retried batch
    assert read_topics(spark, out).count() == routed.count()


def test_log_batches_replay_with_the_same_state(spark):
    """A batch sees the state of earlier batches only, compacted or not, also
    when it runs again after later ones."""
    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")
    lines = FX.log_lines(spark, SF)
    cuts = [lines.where(F.col("seq") < 300), lines.where(F.col("seq").between(300, 600)), lines.where(F.col("seq") > 600)]
    write = J.log_batch_writer(out, state, compact_every=2)
    for i in (0, 1, 1, 2, 0, 1, 2):
        write(cuts[i], i)
    got = extract_routed(read_topics(spark, out)).select(*COLS)
    assert _rows(got) == _rows(C.route_all(spark, SF))
    visits = J.known_visits(spark, state, 3)
    assert _rows(visits) == _rows(L.first_visits(L.tag_lines(lines)).select("mid", "first_visit"))
    assert any("/visit_snapshot/upto=1/" in f for f in visits.inputFiles())


def test_log_batch_plan_is_native(spark):
    tagged = L.tag_lines(FX.log_lines(spark, SF)).persist()
    visits = J.batch_visits(L.first_visits(tagged), spark.createDataFrame([], J.VISIT_SCHEMA)).persist()
    routed = L.route(L.repair_flags(tagged, visits=visits.drop("fresh")))
    plan = routed._jdf.queryExecution().executedPlan().toString()
    above = [p for p in plan.splitlines() if "InMemoryTableScan" in p or "Python" in p or "Pandas" in p]
    assert above and not any("Python" in p or "Pandas" in p for p in above)
    assert routed.count() == L.run_log_job(FX.log_lines(spark, SF)).count()
    visits.unpersist(), tagged.unpersist()


@settings(max_examples=2, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=998), min_size=1, max_size=3, unique=True))
def test_log_stream_independent_of_batch_borders(spark, cuts):
    lines = FX.log_lines(spark, SF)
    src, out, ck = (scratch_path(spark, n) for n in ("src", "out", "ck"))
    bounds = [0] + sorted(cuts) + [10 ** 9]
    for a, b in zip(bounds, bounds[1:]):
        land_lines(lines.where((F.col("seq") >= a) & (F.col("seq") < b)), src, 1, 1)
    _run_routes(spark, src, out, ck, files=1, compact_every=2)
    got = extract_routed(read_topics(spark, out)).select(*COLS)
    assert _rows(got) == _rows(C.route_all(spark, SF))


def test_dim_stream_restart(spark):
    src, state, ck = (scratch_path(spark, n) for n in ("src", "state", "ck"))
    merged = (FX.config_lines(spark, SF).withColumn("kind", F.lit("config"))
              .unionByName(FX.change_lines(spark, SF).withColumn("kind", F.lit("change"))))

    def run():
        s = (spark.readStream.schema("seq long, value string, kind string")
             .option("maxFilesPerTrigger", "2").parquet(src))
        q = J.run_stream(s, ck, foreach_batch=J.dim_batch_writer(state), available_now=True)
        q.awaitTermination()
        assert q.exception() is None

    land_lines(merged.where(F.col("seq") < 5000), src, 2, 2)
    run()
    upto = J.compact_dims(spark, state)        # snapshot of the first batches
    assert upto >= 0
    land_lines(merged.where(F.col("seq") >= 5000), src, 3, 2)
    run()
    want = _rows(C.dim_current(spark, SF))
    assert _rows(J.dim_current_from_logs(spark, state)) == want   # snapshot + newer batches
    assert J.compact_dims(spark, state) > upto
    assert _rows(J.dim_current_from_logs(spark, state)) == want   # from the new snapshot alone


@settings(max_examples=3, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=998), min_size=1, max_size=3, unique=True))
def test_visitor_stream_independent_of_batch_borders(spark, cuts):
    lines = FX.log_lines(spark, SF)
    src, out, ck = (scratch_path(spark, n) for n in ("src", "out", "ck"))
    bounds = [0] + sorted(cuts) + [10 ** 9]
    for a, b in zip(bounds, bounds[1:]):
        land_lines(lines.where((F.col("seq") >= a) & (F.col("seq") < b)), src, 1, 1)
    s = read_topic(spark, fmt="parquet", path=src, max_files_per_trigger=1)
    fixed = repair_flags_stream(L.tag_lines(s)).drop("value")
    q = J.run_stream(fixed, ck, fmt="parquet", path=out, available_now=True)
    q.awaitTermination()
    got = spark.read.schema(OUT_SCHEMA.replace(", value string", "")).parquet(out)
    got = got.select("seq", "is_new_fixed").withColumnRenamed("is_new_fixed", "is_new")
    assert _rows(got) == _rows(C.visitor_fix(spark, SF).select("seq", "is_new"))


@settings(max_examples=2, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=60000), min_size=1, max_size=3, unique=True),
       st.integers(min_value=1, max_value=3))
def test_dim_stream_independent_of_batch_borders(spark, cuts, compact_every):
    merged = (FX.config_lines(spark, SF).withColumn("kind", F.lit("config"))
              .unionByName(FX.change_lines(spark, SF).withColumn("kind", F.lit("change"))))
    src, state, ck = (scratch_path(spark, n) for n in ("src", "state", "ck"))
    bounds = [-1] + sorted(cuts) + [10 ** 12]
    for a, b in zip(bounds, bounds[1:]):
        land_lines(merged.where((F.col("seq") > a) & (F.col("seq") <= b)), src, 1, 1)
    s = (spark.readStream.schema("seq long, value string, kind string")
         .option("maxFilesPerTrigger", "1").parquet(src))
    q = J.run_stream(s, ck, foreach_batch=J.dim_batch_writer(state, compact_every=compact_every),
                     available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    assert _rows(J.dim_current_from_logs(spark, state)) == _rows(C.dim_current(spark, SF))


def test_visitor_stream_with_state_ttl_processor(spark):
    """The transformWithState processor (used when a state TTL is asked for)
    gives the batch answer when the TTL outlives the run."""
    lines = FX.log_lines(spark, SF)
    src, out, ck = (scratch_path(spark, n) for n in ("src", "out", "ck"))
    land_lines(lines, src, 2, 2)
    s = read_topic(spark, fmt="parquet", path=src, max_files_per_trigger=2)
    fixed = repair_flags_stream(L.tag_lines(s), ttl_ms=7 * 24 * 3600 * 1000).drop("value")
    q = J.run_stream(fixed, ck, fmt="parquet", path=out, available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    got = spark.read.schema(OUT_SCHEMA.replace(", value string", "")).parquet(out)
    got = got.select("seq", "is_new_fixed").withColumnRenamed("is_new_fixed", "is_new")
    assert _rows(got) == _rows(C.visitor_fix(spark, SF).select("seq", "is_new"))


def _dim_lines(spark, rows):
    return spark.createDataFrame(rows, "seq long, value string, kind string")


def test_a_batch_is_visible_whole_or_not_at_all(spark, monkeypatch):
    """A writer that dies between its folders, or before its mark, leaves
    nothing to see; the batch run again leaves everything."""
    from test_apps import _change, _config
    state = scratch_path(spark, "state")
    write = J.dim_batch_writer(state)
    write(_dim_lines(spark, [(0, _config("r"), "config"), (5, _change(id=1), "change")]), 0)
    before = _rows(J.dim_current_from_logs(spark, state))
    second = _dim_lines(spark, [(6, _config("u", sink_table="dim_u"), "config"), (7, _change(id=2), "change"), (8, "bad", "change"),
                                (9, "{}x", "config")])
    for step in ("_change_counts", "_mark_done"):
        with monkeypatch.context() as m, pytest.raises(RuntimeError):
            m.setattr(J, step, lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            write(second, 1)
        assert J.committed(spark, state) == 0
        assert _rows(J.dim_current_from_logs(spark, state)) == before
        assert _rows(J.sink_tables_from_logs(spark, state)) == [("dim_t", "info")]
        assert J.read_quarantine_log(spark, state).isEmpty() and J.read_change_log(spark, state).count() == 1
        assert J.compact_dims(spark, state) == 0
    write(second, 1)
    assert J.committed(spark, state) == 1
    assert ("dim_u", "2", "id", "2") in _rows(J.dim_current_from_logs(spark, state))
    assert _rows(J.read_quarantine_log(spark, state)) == [(8, "change", "bad"), (9, "config", "{}x")]


def test_topics_of_an_unfinished_batch_are_not_read(spark, monkeypatch):
    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")
    lines, write = FX.log_lines(spark, SF), J.log_batch_writer(out, state)
    write(lines.where("seq < 300"), 0)
    first = _rows(J.committed_topics(spark, out, state).select("topic", "seq"))
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(J, "_mark_done", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        write(lines.where("seq >= 300"), 1)
    assert read_topics(spark, out).count() > len(first) > 0
    assert _rows(J.committed_topics(spark, out, state).select("topic", "seq")) == first
    write(lines.where("seq >= 300"), 1)
    routed = J.committed_topics(spark, out, state)
    assert routed.count() == read_topics(spark, out).count()
    counted = J.read_counts(spark, state, J.TOPICS).drop("batch").groupBy().sum().first()
    held = {r["topic"]: r["count"] for r in routed.groupBy("topic").count().collect()}
    assert list(counted) == [held.get(t, 0) for t in J.TOPICS]


@pytest.mark.parametrize("order", ["seq", "arrival"])
def test_config_is_carried_from_the_batch_before(spark, order):
    """A batch reads the state its predecessor left, not the config log; a
    batch without config leaves it in place, one that runs again reads it again."""
    from test_apps import _change, _config
    state = scratch_path(spark, "state")
    write = J.dim_batch_writer(state, order=order)
    write(_dim_lines(spark, [(0, _config("r"), "config"), (1, _config("u", sink_table="dim_u"), "config")]), 0)
    for _ in range(2):
        write(_dim_lines(spark, [(5, _change(id=1), "change"), (6, _change(id=1).replace('"t"', '"none"'), "change")]), 1)
    config, at = J.carried_config(spark, state, 2)
    assert at == 0 and all("/config_state/batch=0/" in f for f in config.inputFiles())
    assert config.count() == (2 if order == "seq" else 1)
    write(_dim_lines(spark, [(7, _config("d", sink_table="dim_u"), "config"), (8, _change(id=2), "change")]), 2)
    write(_dim_lines(spark, [(9, _change(id=3), "change")]), 3)
    assert J.carried_config(spark, state, 4)[1] == 2
    counts = {r["batch"]: r for r in J.read_counts(spark, state, J.COUNTS + J.CONFIG_COUNTS).collect()}
    assert [counts[i]["puts"] for i in range(4)] == [0, 1, 0, 0]
    assert [counts[i]["unrouted"] for i in range(4)] == [0, 1, 1, 1]
    assert [counts[i]["lines"] for i in range(4)] == [0, 2, 1, 1]
    assert [counts[i]["config_lines"] for i in range(4)] == [2, 0, 1, 0]


def test_every_line_has_one_fate(spark):
    """Counts by the lookup and by the merge; they add up to the lines."""
    from rivulet.operators import changes as CH, configs as CF
    parsed = CH.parse_changes(FX.change_lines(spark, SF))
    wanted = CH.wanted()
    parsed = parsed.withColumns({"wanted": wanted, "table": F.when(wanted, F.col("table"))})
    versions = CF.config_versions(CF.config_images(FX.config_lines(spark, SF)))
    got = []
    for options in ({}, {"max_versions": 0}):
        routed = CF.route_asof(parsed, versions, keep_unrouted=True, **options)
        got.append(J.D.change_log(routed, ("bad", "malformed", "wanted", "routed")).agg(*J._change_counts()).first().asDict())
    assert got[0] == got[1]
    assert got[0]["lines"] == sum(got[0][n] for n in J.COUNTS[1:]) and all(got[0].values())
