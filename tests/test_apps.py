"""The runnable jobs, driven over file topics to completion."""


from rivulet.plans import catalog as C, fixtures as FX
from rivulet.plans.extract import extract_routed
from rivulet.session import scratch_path
from rivulet.sources.topics import land_lines, read_topics
from rivulet.streaming import apps as A, jobs as J

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_log_app_over_file_topic(spark):
    src, out = scratch_path(spark, "src"), scratch_path(spark, "out")
    land_lines(FX.log_lines(spark, SF), src, 2, 2)
    q = A.start_log_app(spark, source_format="parquet", source_path=src,
                        source_options={"maxFilesPerTrigger": "2"}, sink_path=out,
                        checkpoint=scratch_path(spark, "ck"), available_now=True)
    q.awaitTermination()
    got = extract_routed(read_topics(spark, out)).select(
        "topic", "seq", "pos", "mid", "is_new", "ts", "page_id")
    assert _rows(got) == _rows(C.route_all(spark, SF))


def test_dim_app_over_file_topics(spark):
    chg, cfg, state = (scratch_path(spark, n) for n in ("chg", "cfg", "state"))
    land_lines(FX.change_lines(spark, SF), chg, 1, 2)
    land_lines(FX.config_lines(spark, SF), cfg, 1, 2)
    q = A.start_dim_app(spark, state_dir=state, source_format="parquet", source_path=chg,
                        config_path=cfg, checkpoint=scratch_path(spark, "ck"),
                        order="seq", available_now=True)   # fixture seqs are comparable
    q.awaitTermination()
    assert _rows(J.dim_current_from_logs(spark, state)) == _rows(C.dim_current(spark, SF))


def test_dim_writer_arrival_order(spark):
    """A change older (by seq) than a config row of the same batch: by seq it
    has no route yet; by arrival the batch's config applies to it."""
    import json
    cfg = json.dumps({"op": "r", "after": {"source_table": "t", "sink_table": "dim_t",
                                           "sink_columns": "id,name", "sink_family": "info",
                                           "sink_row_key": "id"}})
    chg = json.dumps({"database": "gmall", "table": "t", "type": "insert",
                      "data": {"id": 1, "name": "a"}})
    batch = spark.createDataFrame([(10, cfg, "config"), (5, chg, "change")],
                                  "seq long, value string, kind string")
    got = {}
    for order in ("seq", "arrival"):
        state = scratch_path(spark, "state")
        J.dim_batch_writer(state, order=order)(batch, 0)
        got[order] = _rows(J.dim_current_from_logs(spark, state))
    assert got["seq"] == []
    assert got["arrival"] == [("dim_t", "1", "id", "1"), ("dim_t", "1", "name", "a")]


def test_unfinished_snapshot_is_ignored(spark):
    import json
    cfg = json.dumps({"op": "r", "after": {"source_table": "t", "sink_table": "dim_t",
                                           "sink_columns": "id,name", "sink_family": "info",
                                           "sink_row_key": "id"}})
    rows = [(1, cfg, "config")] + [
        (10 + i, json.dumps({"database": "gmall", "table": "t", "type": "insert",
                             "data": {"id": i, "name": f"n{i}"}}), "change") for i in range(3)]
    state = scratch_path(spark, "state")
    write = J.dim_batch_writer(state)
    write(spark.createDataFrame(rows[:2], "seq long, value string, kind string"), 0)
    assert J.compact_dims(spark, state) == 0
    write(spark.createDataFrame(rows[2:], "seq long, value string, kind string"), 1)
    want = _rows(J.dim_current_from_logs(spark, state))
    assert len(want) == 6
    # a compaction that died before its marker: a stray, wrong snapshot folder
    spark.createDataFrame([("dim_t", "9", "id", "bogus", 99)],
                          "sink_table string, row_key string, col string, value string, seq long") \
        .write.parquet(f"{state}/snapshot/upto=1")
    assert _rows(J.dim_current_from_logs(spark, state)) == want


def _config(op, **image):
    import json
    row = {"source_table": "t", "sink_table": "dim_t", "sink_columns": "id,name", "sink_family": "info",
           "sink_row_key": "id"} | image
    return json.dumps({"op": op, "before" if op == "d" else "after": row})


def _change(kind="insert", **data):
    import json
    return json.dumps({"database": "gmall", "table": "t", "type": kind, "data": data})


def _write(spark, state, batches, **options):
    write = J.dim_batch_writer(state, **options)
    for i, rows in enumerate(batches):
        write(spark.createDataFrame(rows, "seq long, value string, kind string"), i)
    return _rows(J.dim_current_from_logs(spark, state))


def test_arrival_order_of_drops(spark):
    """Config and change offsets on unrelated scales: what arrived later wins."""
    emptied = [[(0, _config("r"), "config"), (4_096_000, _change(id=1, name="a"), "change")],
               [(4096, _config("u"), "config")]]
    assert _write(spark, scratch_path(spark, "state"), emptied, order="arrival") == []
    kept = [[(0, _config("r"), "config"), (4_096_000, _config("u"), "config")],
            [(20_480, _change(id=1, name="a"), "change")]]
    assert _write(spark, scratch_path(spark, "state"), kept, order="arrival") == [
        ("dim_t", "1", "id", "1"), ("dim_t", "1", "name", "a")]


def test_compaction_is_read_and_keeps_deletes(spark):
    first = [[(1, _config("r"), "config"), (10, _change(id=1, name="a"), "change"), (11, _change(id=2, name="b"), "change"),
              (20, _change("delete", id=1), "change")]]
    late = [(15, _change(id=1, name="late"), "change"), (30, _change(id=2, name="c"), "change")]
    plain, compacted = scratch_path(spark, "state"), scratch_path(spark, "state")
    want = _write(spark, plain, [*first, late])
    _write(spark, compacted, first, compact_every=1)
    J.dim_batch_writer(compacted)(spark.createDataFrame(late, "seq long, value string, kind string"), 1)
    assert _rows(J.dim_current_from_logs(spark, compacted)) == want == [("dim_t", "2", "id", "2"), ("dim_t", "2", "name", "c")]
    files = J.dim_current_from_logs(spark, compacted).inputFiles()
    assert any("/snapshot/upto=0/" in f for f in files)
    plan = J.dim_current_from_logs(spark, compacted)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan
    assert J._latest_snapshot(spark, compacted)[1] == 0


def test_malformed_lines_are_set_aside(spark):
    import pytest
    good, gone = _change(id=1, name="a"), _config("d")
    bad = [(2, "config", '{"op":"d"'), (3, "change", "{} trailing"), (5, "config", gone + "junk"),
           (6, "config", gone + gone), (7, "change", good + good), (8, "change", good + "," + good),
           (9, "change", good + " junk}"), (10, "change", ""), (11, "change", "[1]")]
    rows = [(1, _config("r"), "config"), (4, good, "change")] + [(seq, line, kind) for seq, kind, line in bad]
    state = scratch_path(spark, "state")
    assert len(_write(spark, state, [rows])) == 2
    assert _rows(J.read_quarantine_log(spark, state)) == bad
    with pytest.raises(ValueError):
        _write(spark, scratch_path(spark, "state"), [rows], on_malformed="fail")


def test_preload_routes_before_any_config(spark):
    from pyspark.sql import functions as F
    from rivulet.operators.configs import config_images
    preload = config_images(spark.createDataFrame([(0, _config("r"))], "seq long, value string")).drop("cseq", "op")
    for order in ("seq", "arrival"):
        got = _write(spark, scratch_path(spark, "state"), [[(4, _change(id=1, name="a"), "change")]], order=order,
                     preload=preload)
        assert len(got) == 2
    twice = preload.unionAll(preload.withColumn("sink_table", F.lit("dim_z")))
    from rivulet.operators.changes import parse_changes
    from rivulet.operators.configs import route_static
    change = parse_changes(spark.createDataFrame([(4, _change(id=1))], "seq long, value string"))
    assert route_static(change, twice).count() == 1


def test_other_ops_recreate_a_table(spark):
    from rivulet.operators.configs import config_images
    from rivulet.operators.dims import sink_tables
    lines = spark.createDataFrame([(1, _config("r")), (2, _config("t", sink_family="f2"))], "seq long, value string")
    assert _rows(sink_tables(config_images(lines))) == [("dim_t", "f2")]
    assert _rows(sink_tables(config_images(lines), recreate_on_update=False)) == [("dim_t", "info")]


def test_table_registry_of_the_stream(spark):
    """Tables come from the config log; an update empties one unless told not to."""
    from rivulet.operators.configs import config_images
    from rivulet.operators.dims import sink_families
    from pyspark.sql import functions as F
    batches = [[(0, _config("r"), "config"), (5, _change(id=1), "change")],
               [(1, _config("u", sink_family="info,more"), "config")]]
    state = scratch_path(spark, "state")
    assert _write(spark, state, batches, order="arrival") == []
    assert J.dim_current_from_logs(spark, state, recreate_on_update=False).count() == 1
    preload = (config_images(spark.createDataFrame([(0, _config("r"))], "seq long, value string"))
               .drop("cseq", "op").withColumn("sink_table", F.lit("dim_first")))
    tables = J.sink_tables_from_logs(spark, state, preload)
    assert _rows(tables) == [("dim_first", "info"), ("dim_t", "info,more")]
    assert _rows(sink_families(tables)) == [("dim_first", "info"), ("dim_t", "info"), ("dim_t", "more")]


def test_two_objects_on_a_line_are_dirty(spark):
    from rivulet.operators.logs import dirty_lines, tag_lines
    good = '{"common":{"mid":"m"},"ts":1}'
    lines = spark.createDataFrame([(1, good), (2, good + '{"x":1}'), (3, good + "," + good), (4, good + " junk}")],
                                  "seq long, value string")
    assert sorted(r["seq"] for r in dirty_lines(tag_lines(lines)).select("seq").collect()) == [2, 3, 4]


def test_topic_seqs_do_not_collide(spark):
    from pyspark.sql import functions as F
    from rivulet.sources.topics import topic_seq
    rows = spark.createDataFrame([(4096, 0), (0, 1), (0, 4096), (1, 0)], "p int, o long")
    assert rows.select(topic_seq(F.col("p"), F.col("o")).alias("s")).distinct().count() == 4
