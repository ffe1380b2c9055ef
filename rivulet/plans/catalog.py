"""Batch queries over the driver's tables: one callable per operator.

Each takes (spark, sf_dir) and returns a DataFrame whose columns match the
DuckDB oracle in ``rivulet.plans.oracle`` by name and type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet import constants as K
from rivulet.functions.jsonmap import member_array, member_long, member_str
from rivulet.functions.times import (day_text, date_to_ts, datetime_to_ts, ms_of, previous_day,
                                     ts_to_date, ts_to_datetime, ts_to_partition_day)
from rivulet.operators import changes as CH, configs as CF, dims as D, logs as L
from rivulet.plans import fixtures as FX
from rivulet.plans.extract import array_len, canonical, extract_routed, obj_pos
from rivulet.session import scratch_path
from rivulet.sources import tables as SRC
from rivulet.sources.topics import read_topic


# -- log job ------------------------------------------------------------------

def _tagged(spark, d):
    return L.tag_lines(FX.log_lines(spark, d))


def _routed(spark, d):
    return extract_routed(L.run_log_job(FX.log_lines(spark, d)))


def _arr_n(m_key: str):
    arr = member_array(F.col("m").getItem(m_key))
    return F.when(arr.isNotNull(), F.size(arr)).cast("long")


def log_parsed(spark: SparkSession, d: str) -> DataFrame:
    t = _tagged(spark, d).where(F.col("dirty_reason").isNull())
    m = F.col("m")
    return t.select("seq", "mid", "is_new", "ts",
                    member_str(m.getItem("page"), "$.page_id").alias("page_id"),
                    member_long(m.getItem("err"), "$.error_code").alias("error_code"),
                    member_str(m.getItem("start"), "$.entry").alias("entry"),
                    _arr_n("display").alias("display_n"),
                    _arr_n("displays").alias("displays_n"),
                    _arr_n("actions").alias("actions_n"))


def log_dirty(spark: SparkSession, d: str) -> DataFrame:
    return L.dirty_lines(_tagged(spark, d)).select("seq", "dirty_reason")


def visitor_first_visit(spark: SparkSession, d: str) -> DataFrame:
    return L.first_visits(_tagged(spark, d)).select(
        "mid", day_text(F.col("first_visit")).alias("first_visit"))


def visitor_fix(spark: SparkSession, d: str, hot_rows: int = L.DEFAULT_HOT_ROWS) -> DataFrame:
    f = L.repair_flags(_tagged(spark, d), hot_rows=hot_rows)
    return f.where(F.col("dirty_reason").isNull()).select(
        "seq", "mid", F.col("is_new").alias("is_new_in"),
        day_text(F.col("visit_day")).alias("visit_date"),
        day_text(F.col("first_visit")).alias("first_visit"),
        F.col("is_new_fixed").alias("is_new"))


def route_err(spark: SparkSession, d: str) -> DataFrame:
    r = _routed(spark, d).where(F.col("topic") == K.TOPIC_ERR)
    return r.select("seq", "mid", "is_new", "ts", "page_id", "error_code", "has_start")


def route_start(spark: SparkSession, d: str) -> DataFrame:
    r = _routed(spark, d).where(F.col("topic") == K.TOPIC_START)
    return r.select("seq", "mid", "is_new", "ts", "entry", "has_err", "page_id")


def route_page(spark: SparkSession, d: str) -> DataFrame:
    r = _routed(spark, d).where(F.col("topic") == K.TOPIC_PAGE)
    return r.select("seq", "mid", "is_new", "ts", "page_id", "has_err", "has_start",
                    array_len("display").alias("display_n"),
                    array_len("displays").alias("displays_n"),
                    array_len("actions").alias("actions_n"))


def route_display(spark: SparkSession, d: str) -> DataFrame:
    r = _routed(spark, d).where(F.col("topic") == K.TOPIC_DISPLAY)
    return r.select("seq", "pos", "mid", "is_new", "ts", "page_id",
                    obj_pos("display").alias("display_pos"))


def route_action(spark: SparkSession, d: str) -> DataFrame:
    r = _routed(spark, d).where(F.col("topic") == K.TOPIC_ACTION)
    return r.select("seq", "pos", "mid", "is_new", "page_id",
                    obj_pos("action").alias("action_pos"),
                    F.col("ts").isNotNull().alias("has_ts"))


def route_all(spark: SparkSession, d: str) -> DataFrame:
    return _routed(spark, d).select("topic", "seq", "pos", "mid", "is_new", "ts", "page_id")


def route_counts(spark: SparkSession, d: str) -> DataFrame:
    r = L.run_log_job(FX.log_lines(spark, d))
    return r.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def route_records(spark: SparkSession, d: str) -> DataFrame:
    """Whole records of every topic, members that the job does not know among
    them; NULL for the raw dirty lines."""
    r = L.run_log_job(FX.full_lines(spark, d))
    return r.select("topic", "seq", "pos", F.when(F.col("topic") != K.TOPIC_DIRTY, canonical("value")).alias("record"))


# -- time helpers as columns ----------------------------------------------------

def date_columns(spark: SparkSession, d: str) -> DataFrame:
    ev = spark.read.parquet(f"{d}/events.parquet").select(
        F.col("event_id").alias("seq"), ms_of(F.col("ts")).alias("ts_ms"))
    day = ts_to_date(F.col("ts_ms"))
    dt = ts_to_datetime(F.col("ts_ms"))
    return ev.select("seq", "ts_ms", day.alias("day"), dt.alias("datetime"),
                     ts_to_partition_day(F.col("ts_ms")).alias("part_day"),
                     previous_day(F.col("ts_ms")).alias("prev_day"),
                     datetime_to_ts(dt).alias("ts_back"),
                     date_to_ts(day).alias("day_start"))


def partition_by_day(spark: SparkSession, d: str) -> DataFrame:
    """Good log lines landed as files partitioned by their UTC+8 day, read back."""
    good = _tagged(spark, d).where(F.col("dirty_reason").isNull())
    out = scratch_path(spark, "log_by_day")
    SRC.write_partitioned(good.select("seq", "value", ts_to_partition_day(F.col("ts")).alias("dt")),
                          out, ["dt"])
    back = SRC.read_partitioned(spark, out, "seq long, value string, dt string")
    return back.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


# -- dimension job --------------------------------------------------------------

def _changes(spark, d):
    return CH.filter_changes(CH.parse_changes(FX.change_lines(spark, d)))


def _history(spark, d):
    return CF.config_images(FX.config_lines(spark, d))


def _routed_changes(spark, d):
    return CF.route_asof(_changes(spark, d), CF.config_versions(_history(spark, d)))


def _data_kind():
    return (F.when(F.col("data").isNull(), F.lit("absent"))
             .when(F.size("data") == 0, F.lit("empty")).otherwise(F.lit("row")))


def change_filter(spark: SparkSession, d: str) -> DataFrame:
    return _changes(spark, d).select("seq", F.col("table").alias("tbl"), "type",
                                     _data_kind().alias("data_kind"))


def config_images(spark: SparkSession, d: str) -> DataFrame:
    return _history(spark, d)


def change_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Change lines that are not one JSON object, as they came."""
    return CH.parse_changes(FX.change_lines(spark, d)).where("malformed").select("seq", F.col("bad").alias("value"))


def config_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Config lines that are no envelope with the image their op needs."""
    return (CF.parse_configs(FX.config_lines(spark, d)).where(F.col("bad").isNotNull())
            .select(F.col("cseq").alias("seq"), F.col("bad").alias("value")))


def config_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The snapshot read: a table written once, then read by the snapshot source."""
    path = scratch_path(spark, "config_snapshot")
    FX.config_snapshot(spark, d).write.mode("overwrite").parquet(path)
    return SRC.read_config_table(spark, path)


def rename_columns(spark: SparkSession, d: str) -> DataFrame:
    return CF.rename_to_camel(config_snapshot(spark, d))


def config_current(spark: SparkSession, d: str) -> DataFrame:
    return CF.config_current(_history(spark, d))


def column_retain(spark: SparkSession, d: str) -> DataFrame:
    r = _routed_changes(spark, d)
    kept = CH.retain_columns(F.col("data"), F.col("sink_columns"))
    return r.select("seq", "type", "sink_table", F.explode(kept).alias("col", "value"))


def config_join(spark: SparkSession, d: str) -> DataFrame:
    j = CF.route_static(_changes(spark, d), FX.config_snapshot(spark, d))
    return j.select("seq", F.col("table").alias("tbl"), "type", "sink_table", "sink_columns")


def config_lookup(spark: SparkSession, d: str) -> DataFrame:
    live = _history(spark, d).where(~F.col("op").eqNullSafe(F.lit("r")))
    v = CF.config_versions(live, preload=FX.config_snapshot(spark, d))
    j = CF.route_asof(_changes(spark, d), v)
    return j.select("seq", F.col("table").alias("tbl"), "type", "sink_table", "sink_columns")


def config_asof_join(spark: SparkSession, d: str) -> DataFrame:
    return _routed_changes(spark, d).select("seq", F.col("table").alias("tbl"), "type", "cseq",
                                            "sink_table", "sink_columns")


def _log(spark, d):
    return D.change_log(_routed_changes(spark, d))


def dim_cells(spark: SparkSession, d: str) -> DataFrame:
    return D.cells(_log(spark, d))


def dim_deletes(spark: SparkSession, d: str) -> DataFrame:
    return D.row_deletes(_log(spark, d))


def sink_tables(spark: SparkSession, d: str) -> DataFrame:
    return D.sink_tables(_history(spark, d))


def sink_families(spark: SparkSession, d: str) -> DataFrame:
    return D.sink_families(sink_tables(spark, d))


def _current(spark, d):
    return D.fold_rows(D.row_log(_log(spark, d)), D.table_drops(_history(spark, d)))


def dim_current(spark: SparkSession, d: str) -> DataFrame:
    return _current(spark, d)


def dim_current_after_config(spark: SparkSession, d: str) -> DataFrame:
    return D.table_summary(_current(spark, d), D.sink_tables(_history(spark, d)))


# -- topics with partitions, ordered by record time ------------------------------

def _by_time(spark, d, name, lines):
    return read_topic(spark, path=FX.records(spark, d, name, lines), stream=False, order="time")


def visitor_fix_partitions(spark: SparkSession, d: str, hot_rows: int = L.DEFAULT_HOT_ROWS) -> DataFrame:
    """``visitor_fix`` where a device's lines come from several partitions."""
    f = L.repair_flags(L.tag_lines(_by_time(spark, d, "log_records", FX.log_lines)), hot_rows=hot_rows)
    return f.where(F.col("dirty_reason").isNull()).select(
        "seq.partition", "seq.offset", "mid", F.col("is_new").alias("is_new_in"),
        day_text(F.col("visit_day")).alias("visit_date"), day_text(F.col("first_visit")).alias("first_visit"),
        F.col("is_new_fixed").alias("is_new"))


def _history_by_time(spark, d):
    return CF.config_images(_by_time(spark, d, "config_records", FX.config_lines))


def _routed_by_time(spark, d, **options):
    changes = CH.filter_changes(CH.parse_changes(_by_time(spark, d, "change_records", FX.change_lines)))
    return CF.route_asof(changes, CF.config_versions(_history_by_time(spark, d)), **options)


def config_asof_partitions(spark: SparkSession, d: str, **options) -> DataFrame:
    """The config version in force at each change, by record time."""
    return _routed_by_time(spark, d, **options).select(
        "seq.partition", "seq.offset", F.col("table").alias("tbl"), "type", "sink_table", "sink_columns")


def dim_current_partitions(spark: SparkSession, d: str, **options) -> DataFrame:
    """Current cells where changes and config are ordered by record time."""
    log = D.change_log(_routed_by_time(spark, d, **options))
    return D.fold_rows(D.row_log(log), D.table_drops(_history_by_time(spark, d)))


BATCH_QUERIES = {
    "log_parsed": log_parsed, "log_dirty": log_dirty,
    "visitor_first_visit": visitor_first_visit, "visitor_fix": visitor_fix,
    "route_err": route_err, "route_start": route_start, "route_page": route_page,
    "route_display": route_display, "route_action": route_action,
    "route_all": route_all, "route_counts": route_counts, "route_records": route_records,
    "date_columns": date_columns, "partition_by_day": partition_by_day,
    "change_filter": change_filter, "config_images": config_images,
    "change_quarantine": change_quarantine, "config_quarantine": config_quarantine,
    "config_snapshot": config_snapshot, "rename_columns": rename_columns,
    "config_current": config_current, "column_retain": column_retain,
    "config_join": config_join, "config_lookup": config_lookup,
    "config_asof_join": config_asof_join, "dim_cells": dim_cells,
    "dim_deletes": dim_deletes, "sink_tables": sink_tables, "sink_families": sink_families,
    "dim_current": dim_current, "dim_current_after_config": dim_current_after_config,
    "visitor_fix_partitions": visitor_fix_partitions, "config_asof_partitions": config_asof_partitions,
    "dim_current_partitions": dim_current_partitions,
}
