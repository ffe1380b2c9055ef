"""Hand-made cases for the behaviours the survey lists (as coded by default)."""

import json

from pyspark.sql import functions as F

from rivulet import constants as K
from rivulet.functions.times import day_text
from rivulet.operators import changes as CH, configs as CF, dims as D, logs as L

# 2024-01-01 15:59:59.999 UTC is 23:59:59.999 at UTC+8; one ms later is the next day.
BEFORE_MIDNIGHT = 1704124799999
AFTER_MIDNIGHT = 1704124800000
DAY = 86_400_000


def _lines(spark, rows):
    return spark.createDataFrame(rows, "seq long, value string")


def _log(common, **kw):
    rec = {"common": common, **kw}
    return json.dumps(rec)


def _routed(spark, rows, **opts):
    out = L.run_log_job(_lines(spark, rows), **opts).collect()
    return [(r.seq, r.topic, r.pos, json.loads(r.value) if r.topic != K.TOPIC_DIRTY else r.value)
            for r in out]


def _fixed(spark, rows):
    f = L.repair_flags(L.tag_lines(_lines(spark, rows)))
    return {r.seq: r for r in f.select("seq", "dirty_reason", "is_new", "is_new_fixed",
                                       day_text(F.col("first_visit")).alias("fv"),
                                       day_text(F.col("visit_day")).alias("d")).collect()}


def test_dirty_reasons_and_trailing_text(spark):
    rows = [(1, "not json"), (2, '{"common":{"mid":"a"},"ts":1} trailing'),
            (3, '{"ts":1}'), (4, '{"common":{"is_new":"1"},"ts":1}'),
            (5, '{"common":{"mid":"a"}}'), (6, '{"common":"x","ts":1}'),
            (7, '[1,2]'), (8, None), (9, '{"common":{"mid":"a","is_new":"1"},"ts":1}   ')]
    t = {r.seq: r.dirty_reason for r in L.tag_lines(_lines(spark, rows)).collect()}
    assert t == {1: "not_json", 2: "not_json", 3: "no_common", 4: "no_mid", 5: "no_ts",
                 6: "no_common", 7: "not_json", 8: "not_json", 9: None}
    dirty = [r for r in _routed(spark, rows) if r[1] == K.TOPIC_DIRTY]
    assert {r[0] for r in dirty} == {1, 2, 3, 4, 5, 6, 7, 8}
    assert [r[3] for r in dirty if r[0] == 1] == ["not json"]


def test_lenient_names_and_duplicates_last_wins(spark):
    rows = [(1, "{common:{mid:'a',is_new:'1'},ts:5}"),
            (2, '{"common":{"mid":"b","is_new":"1"},"ts":1,"ts":%d}' % AFTER_MIDNIGHT)]
    t = {r.seq: r for r in L.tag_lines(_lines(spark, rows)).collect()}
    assert t[1].dirty_reason is None and t[1].mid == "a" and t[1].ts == 5
    assert t[2].ts == AFTER_MIDNIGHT


def test_json_null_err_is_absent_numeric_flag_coerced(spark):
    rows = [(1, '{"common":{"mid":"a","is_new":1},"ts":%d,"err":null,"page":{"page_id":"p"}}' % AFTER_MIDNIGHT)]
    r = _routed(spark, rows)
    assert {x[1] for x in r} == {K.TOPIC_PAGE}
    f = _fixed(spark, rows)[1]
    assert f.is_new == "1" and f.fv == "2024-01-02"


def test_missing_flag_seeds_yesterday_and_stays_missing(spark):
    rows = [(1, _log({"mid": "a"}, ts=AFTER_MIDNIGHT)),
            (2, _log({"mid": "a", "is_new": "1"}, ts=AFTER_MIDNIGHT + 5))]
    f = _fixed(spark, rows)
    assert f[1].is_new is None and f[1].is_new_fixed is None and f[1].fv == "2024-01-01"
    assert f[2].is_new_fixed == "0"          # state (yesterday) != today
    page = [x for x in _routed(spark, rows) if x[1] == K.TOPIC_PAGE and x[0] == 1][0][3]
    assert "is_new" not in page["common"]


def test_flag_zero_first_then_one_same_day(spark):
    rows = [(1, _log({"mid": "a", "is_new": "0"}, ts=AFTER_MIDNIGHT)),
            (2, _log({"mid": "a", "is_new": "1"}, ts=AFTER_MIDNIGHT + 1000))]
    f = _fixed(spark, rows)
    assert f[1].is_new_fixed == "0" and f[2].is_new_fixed == "0"


def test_late_record_with_older_date_is_flagged_old(spark):
    rows = [(1, _log({"mid": "a", "is_new": "1"}, ts=AFTER_MIDNIGHT + DAY)),
            (2, _log({"mid": "a", "is_new": "1"}, ts=AFTER_MIDNIGHT))]
    f = _fixed(spark, rows)
    assert f[1].is_new_fixed == "1" and f[2].is_new_fixed == "0"


def test_midnight_boundary_utc_plus_8(spark):
    rows = [(1, _log({"mid": "a", "is_new": "1"}, ts=BEFORE_MIDNIGHT)),
            (2, _log({"mid": "a", "is_new": "1"}, ts=AFTER_MIDNIGHT))]
    f = _fixed(spark, rows)
    assert f[1].d == "2024-01-01" and f[2].d == "2024-01-02"
    assert f[1].is_new_fixed == "1" and f[2].is_new_fixed == "0"


def test_first_line_decides_even_when_out_of_order_in_input(spark):
    rows = [(5, _log({"mid": "a", "is_new": "1"}, ts=AFTER_MIDNIGHT + DAY)),
            (3, _log({"mid": "a", "is_new": "0"}, ts=AFTER_MIDNIGHT))]
    f = _fixed(spark, rows)
    assert f[3].fv == "2024-01-01" and f[5].is_new_fixed == "0"


def test_err_and_start_together(spark):
    rows = [(1, _log({"mid": "a", "is_new": "1"}, ts=1, err={"error_code": 3},
                     start={"entry": "icon"}, display=[{"pos": 0}], actions=[{"pos": 0}]))]
    r = {x[1]: x[3] for x in _routed(spark, rows)}
    assert set(r) == {K.TOPIC_ERR, K.TOPIC_START, K.TOPIC_PAGE}
    assert "err" in r[K.TOPIC_ERR] and "start" in r[K.TOPIC_ERR]
    assert "err" not in r[K.TOPIC_START] and "start" in r[K.TOPIC_START]
    # start lines skip the display/action split, and nothing is removed from the page record
    assert "err" not in r[K.TOPIC_PAGE] and r[K.TOPIC_PAGE]["actions"] == [{"pos": 0}]


def test_display_and_displays_together(spark):
    rows = [(1, _log({"mid": "a", "is_new": "1"}, ts=7, page={"page_id": "p"},
                     display=[{"pos": 0}, {"pos": 1}], displays=[{"pos": 9}],
                     actions=[{"pos": 0}]))]
    r = _routed(spark, rows)
    disp = sorted((x[2], x[3]["display"]["pos"], x[3]["ts"]) for x in r if x[1] == K.TOPIC_DISPLAY)
    assert disp == [(0, 0, 7), (1, 1, 7)]
    act = [x[3] for x in r if x[1] == K.TOPIC_ACTION]
    assert len(act) == 1 and "ts" not in act[0] and act[0]["page"] == {"page_id": "p"}
    page = [x[3] for x in r if x[1] == K.TOPIC_PAGE][0]
    assert "display" in page and "displays" not in page and "actions" not in page


def test_display_not_an_array_and_options(spark):
    rows = [(1, _log({"mid": "a", "is_new": "1"}, ts=7, display={"pos": 0},
                     start={"entry": "x"}, actions=[{"pos": 0}]))]
    r = _routed(spark, rows)
    assert {x[1] for x in r} == {K.TOPIC_START, K.TOPIC_PAGE}
    r2 = _routed(spark, rows, page_excludes_start=True)
    assert {x[1] for x in r2} == {K.TOPIC_START}
    rows3 = [(1, _log({"mid": "a", "is_new": "1"}, ts=7, actions=[{"pos": 0}]))]
    act = [x[3] for x in _routed(spark, rows3, action_ts=True) if x[1] == K.TOPIC_ACTION]
    assert act[0]["ts"] == 7


def _dim(spark, changes, config):
    ch = CH.filter_changes(CH.parse_changes(_lines(spark, changes)))
    hist = CF.config_images(_lines(spark, config))
    log = D.change_log(CF.route_asof(ch, CF.config_versions(hist)))
    cur = D.fold_current(D.cells(log), D.row_deletes(log), D.table_drops(hist))
    return log, sorted(tuple(r) for r in cur.collect()), hist


def _cfg(seq, op, src, sink, cols, fam="info", key="id", before=None):
    img = {"source_table": src, "sink_table": sink, "sink_columns": cols,
           "sink_family": fam, "sink_row_key": key}
    env = {"op": op, "after": None if op == "d" else img, "before": img if op == "d" else before}
    return (seq, json.dumps(env))


def _chg(seq, table, typ, data, db="gmall"):
    rec = {"database": db, "table": table, "type": typ}
    if data is not None:
        rec["data"] = data
    return (seq, json.dumps(rec))


def test_column_rules(spark):
    config = [_cfg(0, "r", "t", "dim_t", "id, name,type,extra"),
              _cfg(1, "r", "u", "dim_u", "name"),
              _cfg(2, "r", "w", "dim_w", "id,name", fam="info,ext")]
    changes = [_chg(10, "t", "insert", {"id": 1, "name": "n", "type": "T", "extra": ""}),
               _chg(11, "t", "insert", {"id": 2, "extra": ""}),         # all-empty row
               _chg(12, "u", "insert", {"id": 3, "name": "x"}),         # key not retained
               _chg(13, "w", "insert", {"id": 4, "name": "y"}),         # two families
               _chg(14, "t", "insert", None)]                           # no data
    log, cur, _ = _dim(spark, changes, config)
    # ' name' (with a space) does not match 'name'; 'type' never survives; '' not written
    assert cur == [("dim_t", "1", "id", "1"), ("dim_t", "2", "id", "2")]
    q = {r.seq: r.quarantine for r in D.quarantined(log).collect()}
    assert q == {12: "no_row_key", 13: "multi_family", 14: "no_data"}


def test_change_filter_precedence(spark):
    rows = [_chg(1, "t", "bootstrap-insert", {}), _chg(2, "t", "bootstrap-insert", {"id": 1}),
            _chg(3, "t", "insert", {}), _chg(4, "t", "insert", None),
            _chg(5, "t", "bootstrap-start", {"id": 1}), _chg(6, "t", "update", {"id": 1}, db="x")]
    kept = {r.seq for r in CH.filter_changes(CH.parse_changes(_lines(spark, rows))).collect()}
    assert kept == {2, 3, 4}
    strict = {r.seq for r in CH.filter_changes(CH.parse_changes(_lines(spark, rows)),
                                               strict_data=True).collect()}
    assert strict == {2}


def test_update_recreates_table_and_renamed_source_keeps_old_route(spark):
    config = [_cfg(0, "r", "a", "dim_a", "id,name"),
              _cfg(20, "u", "b", "dim_b", "id,name",
                   before={"source_table": "a", "sink_table": "dim_a", "sink_columns": "id,name",
                           "sink_family": "info", "sink_row_key": "id"}),
              _cfg(40, "u", "a", "dim_a", "id,name")]
    changes = [_chg(10, "a", "insert", {"id": 1, "name": "x"}),
               _chg(30, "a", "insert", {"id": 2, "name": "y"}),    # old route still live
               _chg(31, "b", "insert", {"id": 3, "name": "z"}),
               _chg(50, "a", "update", {"id": 4, "name": "w"})]
    _, cur, hist = _dim(spark, changes, config)
    assert cur == [("dim_a", "4", "id", "4"), ("dim_a", "4", "name", "w"),
                   ("dim_b", "3", "id", "3"), ("dim_b", "3", "name", "z")]
    tabs = sorted(tuple(r) for r in D.sink_tables(hist).collect())
    assert tabs == [("dim_a", "info"), ("dim_b", "info")]


def test_delete_then_reinsert_and_partial_update(spark):
    config = [_cfg(0, "r", "a", "dim_a", "id,name,extra")]
    changes = [_chg(1, "a", "insert", {"id": 1, "name": "x", "extra": "e"}),
               _chg(2, "a", "update", {"id": 1, "name": "", "extra": "e2"}),
               _chg(3, "a", "insert", {"id": 2, "name": "q"}),
               _chg(4, "a", "delete", {"id": 2}),
               _chg(5, "a", "insert", {"id": 2, "extra": "back"})]
    _, cur, _ = _dim(spark, changes, config)
    assert cur == [("dim_a", "1", "extra", "e2"), ("dim_a", "1", "id", "1"), ("dim_a", "1", "name", "x"),
                   ("dim_a", "2", "extra", "back"), ("dim_a", "2", "id", "2")]


def test_config_delete_then_create(spark):
    config = [_cfg(0, "r", "a", "dim_a", "id"), _cfg(5, "d", "a", "dim_a", "id"),
              _cfg(8, "c", "a", "dim_a", "id", fam="f2")]
    changes = [_chg(1, "a", "insert", {"id": 1}), _chg(6, "a", "insert", {"id": 2}),
               _chg(9, "a", "insert", {"id": 3})]
    _, cur, hist = _dim(spark, changes, config)
    assert cur == [("dim_a", "3", "id", "3")]
    assert [tuple(r) for r in D.sink_tables(hist).collect()] == [("dim_a", "f2")]
    cur_cfg = CF.config_current(hist).collect()
    assert [(r.source_table, r.cseq) for r in cur_cfg] == [("a", 8)]
