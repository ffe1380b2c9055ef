"""Snapshot-then-changes source and sink tables in the catalog."""

import json

import pytest
from pyspark.sql import functions as F

from rivulet.session import local_path, scratch_path
from rivulet.sources.hybrid import SnapshotThenChangesReader, read_snapshot_then_changes
from rivulet.streaming import jobs as J, sinktables as T
from test_apps import _change, _config, _rows


def _hybrid(spark, **options):
    paths = {k: scratch_path(spark, k) for k in ("snapshotPath", "changesPath", "progressPath")}
    spark.range(10).selectExpr("concat('t', id) as source_table", "'s' as sink_table").repartition(5).write.parquet(paths["snapshotPath"])
    return paths, {**paths, "unitsPerTrigger": "2", "seqsPerTrigger": "3", **options}


def _changes(spark, path, seqs):
    spark.createDataFrame([(s, f"c{s}") for s in seqs], "seq long, value string").write.mode("append").parquet(path)


def _run(spark, options, ck, out):
    q = J.run_stream(read_snapshot_then_changes(spark, options), ck, fmt="parquet", path=out, processing_time="0 seconds")
    q.processAllAvailable()
    q.stop()
    assert q.exception() is None


def test_snapshot_then_changes_across_restarts(spark):
    """Each row comes once, the snapshot first, wherever the stream stops."""
    paths, options = _hybrid(spark)
    ck, out = scratch_path(spark, "ck"), scratch_path(spark, "out")
    _run(spark, options, ck, out)
    _changes(spark, paths["changesPath"], range(1, 8))
    _run(spark, options, ck, out)
    _run(spark, options, ck, out)                     # nothing new
    _changes(spark, paths["changesPath"], range(8, 12))
    _run(spark, options, ck, out)
    got = spark.read.schema("seq long, value string").parquet(out).collect()
    snapshot = [json.loads(r["value"]) for r in sorted(got) if r["seq"] < 0]
    assert sorted(e["after"]["source_table"] for e in snapshot) == [f"t{i}" for i in range(10)]
    assert {e["op"] for e in snapshot} == {"r"}
    assert sorted(r["seq"] for r in got if r["seq"] >= 0) == list(range(1, 12))


def test_hybrid_offsets(spark):
    """Steps, the handover after the seq of the snapshot, and a restart that
    plans the noted range again or goes on from its end."""
    paths, options = _hybrid(spark, changesFrom="4")
    _changes(spark, paths["changesPath"], range(1, 12))
    options = {k: local_path(v) for k, v in options.items()}
    reader, at, seen = SnapshotThenChangesReader(options), {"phase": "snapshot", "position": 0}, []
    for step in range(9):
        end = reader.latestOffset()
        if end == at:
            break
        units = reader.partitions(at, end)
        again = SnapshotThenChangesReader(options)         # died after planning: Spark plans the range again
        assert [u.__dict__ for u in again.partitions(at, end)] == [u.__dict__ for u in units]
        seen += [row for u in units for row in again.read(u)]
        reader, at = (again, end) if step % 2 else (SnapshotThenChangesReader(options), end)
    assert at == {"phase": "changes", "position": 11}
    assert len([s for s, _ in seen if s < 0]) == 10 and [s for s, _ in seen if s >= 0] == [5, 6, 7, 8, 9, 10, 11]
    with pytest.raises(ValueError):
        reader.partitions(at, {"phase": "snapshot", "position": 2})


def test_a_batch_reads_the_row_groups_of_its_seqs(spark):
    """Changes in order of seq are read about once in all, whatever the number of batches."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    paths, options = _hybrid(spark, seqsPerTrigger="10")
    options = {k: local_path(v) for k, v in options.items()}
    _changes(spark, paths["changesPath"], [])
    seqs = [*range(50), *[None] * 10]
    pq.write_table(pa.table({"value": [f"c{s}" for s in seqs], "seq": pa.array(seqs, pa.int64())}),
                   options["changesPath"] + "/part-00.parquet", row_group_size=10)
    reader, at, seen, groups = SnapshotThenChangesReader(options), {"phase": "changes", "position": -1}, [], []
    reader.at = at
    while (end := reader.latestOffset()) != at:
        for u in reader.partitions(at, end):
            groups += u.groups
            seen += reader.read(u)
        at = end
    assert seen == [(s, f"c{s}") for s in range(50)]
    assert groups == [0, 1, 2, 3, 4]


def test_batches_of_config_changes_do_not_grow_with_the_table(spark):
    from rivulet.streaming import catalog as C

    batches = lambda top: -(-top // C._seqs_a_batch(spark.createDataFrame([(1,), (top,)], "seq long")))
    assert [batches(top) for top in (4_000, 12_000, 100_000, 36_000_000)] == [1, 3, 24, 24]
    assert C._seqs_a_batch(spark.createDataFrame([], "seq long")) == C.LEAST_SEQS


def _batches(spark, state, batches, namespace, **options):
    write = J.dim_batch_writer(state, order="arrival", namespace=namespace, **options)
    for i, rows in batches:
        write(spark.createDataFrame(rows, "seq long, value string, kind string"), i)


def _files(spark, namespace, table):
    held = {}
    for r in spark.table(f"{namespace}.{table}").select("bucket", F.input_file_name().alias("f")).collect():
        held.setdefault(r["bucket"], set()).add(r["f"])
    return held


def test_a_batch_rewrites_its_buckets_only(spark):
    state = scratch_path(spark, "state")
    ns = "w" + state.rsplit("-", 1)[-1]
    first = [(0, _config("r"), "config")] + [(i, _change(id=i, name=f"n{i}"), "change") for i in range(1, 40)]
    _batches(spark, state, [(0, first)], ns, buckets=8)
    before = _files(spark, ns, "dim_t")
    assert len(before) == 8 and T.read_table(spark, ns, "dim_t").count() == 39
    one = [(50, _change("update", id=7, name="other"), "change")]
    _batches(spark, state, [(1, one), (1, one)], ns, buckets=8)       # and again
    after = _files(spark, ns, "dim_t")
    assert sum(before[b] != after[b] for b in before) == 1
    rows = {r["row_key"]: r["name"] for r in T.read_table(spark, ns, "dim_t").collect()}
    assert rows["7"] == "other" and len(rows) == 39
    gone = [(60 + i, _change("delete", id=i), "change") for i in range(1, 40)]
    _batches(spark, state, [(2, gone)], ns, buckets=8)
    assert T.read_table(spark, ns, "dim_t").count() == 0


def test_a_large_bucket_is_written_by_several_tasks(spark, monkeypatch):
    """And is whole: each row once, in a table beside small ones."""
    monkeypatch.setattr(T, "TASK_CELLS", 20)
    state = scratch_path(spark, "state")
    ns = "b" + state.rsplit("-", 1)[-1]
    rows = [(0, _config("r"), "config")] + [(i, _change(id=i, name=f"n{i}"), "change") for i in range(1, 60)]
    _batches(spark, state, [(0, rows)], ns, buckets=1)
    assert len(_files(spark, ns, "dim_t")[0]) > 1
    held = lambda: sorted((int(r["row_key"]), r["name"]) for r in T.read_table(spark, ns, "dim_t").collect())
    assert held() == [(i, f"n{i}") for i in range(1, 60)]
    _batches(spark, state, [(1, [(100 + i, _change("delete", id=i), "change") for i in range(1, 58)])], ns, buckets=1)
    assert held() == [(58, "n58"), (59, "n59")]


def test_tables_follow_the_config(spark):
    """Created, given a column, dropped and created anew; a session without
    the catalog's entries finds the written rows."""
    state = scratch_path(spark, "state")
    ns = "c" + state.rsplit("-", 1)[-1]
    put = lambda seq, **data: (seq, _change(**data), "change")
    _batches(spark, state, [(0, [(0, _config("r"), "config"), put(1, id=1, name="a", extra="x")])], ns)
    _batches(spark, state, [(1, [(1, _config("c", sink_columns="id,name,extra"), "config"), put(2, id=2, extra="y")])], ns)
    rows = sorted(map(tuple, T.read_table(spark, ns, "dim_t").select("row_key", "id", "name", "extra").collect()))
    assert rows == [("1", "1", "a", None), ("2", "2", None, "y")]
    spark.sql(f"drop table {ns}.dim_t")                               # only the entry goes
    _batches(spark, state, [(2, [put(3, id=3, name="c")])], ns)
    assert T.read_table(spark, ns, "dim_t").count() == 3
    _batches(spark, state, [(3, [(2, _config("u", sink_family="info,more"), "config")])], ns)
    assert T.read_table(spark, ns, "dim_t").count() == 0
    assert _rows(T.list_tables(spark, ns)) == [("dim_t", "info,more")]
    _batches(spark, state, [(4, [(3, _config("d"), "config")])], ns)
    assert _rows(T.list_tables(spark, ns)) == []


def test_one_object_a_line(spark):
    """Lines that close the bracket they are read in are not one object."""
    from rivulet.operators.changes import parse_changes
    good = '{"database":"gmall","table":"t","type":"insert","data":{"a":[{"b":1}]}}'
    bad = [good + t for t in ("] x", '],[{"x":2}', ",", "}", "]", good, '],"end":1', ',"end":1,"x":{}', "]" + good)] + [good[:-1], "", " "]
    fine = [good, " " + good + " ", "{'a' : [{'b':1}] , c: 2}", "{}", '{"end":2,"x":[{}]}', '{"t":"}] x"}']
    rows = list(enumerate(bad + fine))
    got = {r["seq"]: r["malformed"] for r in parse_changes(spark.createDataFrame(rows, "seq long, value string")).collect()}
    assert [i for i, m in sorted(got.items()) if m] == list(range(len(bad)))


def test_config_without_op_recreates(spark):
    state = scratch_path(spark, "state")
    bare = json.dumps({"after": json.loads(_config("r"))["after"]})
    _batches(spark, state, [(0, [(0, _config("r"), "config"), (1, _change(id=1, name="a"), "change")]), (1, [(1, bare, "config")]),
                            (2, [(2, _change(id=2, name="b"), "change")])], None)
    assert _rows(J.dim_current_from_logs(spark, state)) == [("dim_t", "2", "id", "2"), ("dim_t", "2", "name", "b")]
