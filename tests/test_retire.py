"""State that no batch needs any more is deleted; what the last ones read stays."""

import os

import pytest
from pyspark.sql import functions as F

from rivulet.operators import logs as L
from rivulet.plans import catalog as C, fixtures as FX
from rivulet.plans.extract import extract_routed
from rivulet.session import local_path, scratch_path
from rivulet.streaming import jobs as J
from test_apps import _change, _config, _rows

SF = "/root/testdata/sf0.001"


def _ids(state, folder):
    path = f"{local_path(state)}/{folder}"
    return sorted(int(n.split("=")[1]) for n in os.listdir(path) if "=" in n) if os.path.isdir(path) else []


def test_device_state_is_retired(spark):
    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")
    lines = FX.log_lines(spark, SF)
    write = J.log_batch_writer(out, state, compact_every=2, keep_batches=1)
    cuts = [lines.where(F.col("seq").between(a, b)) for a, b in ((0, 200), (201, 400), (401, 600), (601, 10 ** 9))]
    for i, cut in enumerate(cuts):
        write(cut, i)
    write(cuts[3], 3)                         # the last batch runs again
    assert _ids(state, "visit_snapshot") == [1, 3] == _ids(state, "visit_snapshot_done")
    assert _ids(state, "visits") == [2, 3]
    cols = ["topic", "seq", "mid", "is_new", "page_id"]
    got = extract_routed(J.committed_topics(spark, out, state)).select(*cols)
    assert got.exceptAll(C.route_all(spark, SF).select(*cols)).isEmpty() and got.count() == C.route_all(spark, SF).count()
    assert _rows(J.known_visits(spark, state, 4)) == _rows(L.first_visits(L.tag_lines(lines)).select("mid", "first_visit"))


def test_dimension_state_is_retired(spark):
    """Snapshots, log and config state go; the cells, the lines set aside and
    the table registry do not change, and a read as of a kept batch answers."""
    batches = [[(0, _config("r"), "config"), (1, _change(id=1, name="a"), "change"), (2, "bad", "change")],
               [(10, _change(id=2), "change"), (11, _change(name="no key"), "change")],
               [(20, _config("u", sink_columns="id"), "config"), (21, _change(id=3), "change"), (22, "worse", "change")],
               [(30, _change("delete", id=3), "change")],
               [(40, _change(id=4), "change")]]
    frames = [spark.createDataFrame(b, "seq long, value string, kind string") for b in batches]
    kept, whole = scratch_path(spark, "state"), scratch_path(spark, "state")
    fewer, plain = J.dim_batch_writer(kept, compact_every=1, keep_batches=2), J.dim_batch_writer(whole)
    for i, f in enumerate(frames):
        fewer(f, i)
        plain(f, i)
    fewer(frames[4], 4)                        # the last batch runs again
    assert _ids(kept, "snapshot") == [2, 3, 4] == _ids(kept, "snapshot_done")
    assert _ids(kept, "change_log") == [3, 4] and _ids(kept, "config_state") == [2] and _ids(kept, "set_aside") == [2]
    for through in (3, None):
        assert (_rows(J.dim_current_from_logs(spark, kept, through=through))
                == _rows(J.dim_current_from_logs(spark, whole, through=through)))
    for read in (J.read_quarantine_log, J.sink_tables_from_logs):
        assert _rows(read(spark, kept)) == _rows(read(spark, whole))
    assert _rows(J.read_quarantine_log(spark, kept)) == [(2, "change", "bad"), (22, "change", "worse")]
    reasons = [r["quarantine"] for r in J.read_set_aside(spark, kept).orderBy("seq").collect()]
    assert reasons == ["malformed", "no_row_key", "malformed"]
    late = spark.createDataFrame([(25, _change(id=3, name="late"), "change"), (50, _change(id=5), "change")],
                                 "seq long, value string, kind string")
    fewer(late, 5)
    plain(late, 5)
    assert _rows(J.dim_current_from_logs(spark, kept)) == _rows(J.dim_current_from_logs(spark, whole))


def test_the_last_batch_is_always_kept(spark):
    with pytest.raises(ValueError):
        J.retire_dims(spark, scratch_path(spark, "state"), 3, 0)
