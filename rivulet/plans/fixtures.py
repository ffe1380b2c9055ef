"""Deterministic inputs derived from the driver's tables.

Each fixture has a *typed* form written once in SQL that runs on Spark and on
DuckDB (the oracle reads the typed form), and a *rendered* form: the JSON text
lines the engine consumes, produced by Spark from the typed form. Outputs are
always compared on extracted columns, never on JSON text.

Only two expressions differ by engine, ``{ms}`` and ``{day:...}``; table
references are ``{t:name}``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# -- typed fixtures ----------------------------------------------------------

LOG_TYPED = """
select event_id as seq,
       concat('mid_', user_id) as mid,
       case when event_id % 3 = 0 then '0' else '1' end as is_new,
       {ms} as ts_ms,
       (event_type = 'error' or event_id % 11 = 0) as has_err,
       (event_type = 'signup') as has_start,
       case when event_type = 'signup' then null else concat('page_', event_id % 7) end as page_id,
       case when event_id % 2 = 0 then 'display' else 'displays' end as display_key,
       case event_type when 'view' then event_id % 4 when 'purchase' then 1 else 0 end as display_n,
       case event_type when 'click' then event_id % 3 when 'purchase' then 1 else 0 end as action_n,
       case when event_id % 97 = 0 then 'not_json' when event_id % 101 = 0 then 'no_common'
            when event_id % 103 = 0 then 'no_mid' when event_id % 107 = 0 then 'no_ts' end as bad
from {t:events}
"""

CHANGE_TYPED = """
select c_custkey*100 as seq, 'gmall' as db, 'customer' as tbl, 'insert' as type, 'row' as data_kind, c_custkey as id, c_name as name, c_mktsegment as extra from {t:customer}
union all select c_custkey*100+1, 'gmall', 'customer', 'update', 'row', c_custkey, '', concat(c_mktsegment, '_U') from {t:customer} where c_custkey % 3 = 0
union all select c_custkey*100+2, 'gmall', 'customer', 'delete', 'row', c_custkey, c_name, c_mktsegment from {t:customer} where c_custkey % 5 = 0
union all select c_custkey*100+3, 'gmall', 'customer', 'insert', 'row', c_custkey, null, 'REBORN' from {t:customer} where c_custkey % 10 = 0
union all select p_partkey*100+19, 'gmall', 'part', 'bootstrap-start', 'empty', null, null, null from {t:part} where p_partkey % 50 = 0
union all select p_partkey*100+20, 'gmall', 'part', 'bootstrap-insert', 'row', p_partkey, p_name, p_type from {t:part}
union all select p_partkey*100+21, 'gmall', 'part', 'bootstrap-insert', 'empty', null, null, null from {t:part} where p_partkey % 40 = 0
union all select s_suppkey*100+40, 'gmall', 'supplier', 'insert', 'row', s_suppkey, s_name, concat('nation_', s_nationkey) from {t:supplier}
union all select s_suppkey*100+41, 'gmall', 'supplier', 'update', 'row', s_suppkey, concat(s_name, '_U'), '' from {t:supplier} where s_suppkey % 2 = 0
union all select s_suppkey*100+42, 'gmall', concat('sup_', s_nationkey), 'insert', 'row', s_suppkey, s_name, concat('n', s_nationkey, '_s', s_suppkey) from {t:supplier}
union all select s_suppkey*100+43, 'gmall', concat('sup_', s_nationkey), 'update', 'row', s_suppkey, '', concat('upd_', s_suppkey) from {t:supplier} where s_suppkey % 3 = 1
union all select s_suppkey*100+44, 'gmall', concat('sup_', s_nationkey), 'delete', 'row', s_suppkey, null, null from {t:supplier} where s_suppkey % 7 = 3
union all select n_nationkey*100+60, 'gmall', 'nation', 'insert', 'row', n_nationkey, n_name, null from {t:nation}
union all select n_nationkey*100+61, 'gmall', 'nation', 'insert', 'absent', null, null, null from {t:nation} where n_nationkey % 5 = 0
union all select o_orderkey*100+80, 'other', 'orders', 'insert', 'row', o_orderkey, o_orderstatus, o_orderpriority from {t:orders}
"""

# Config history. The first seven rows are hand-written routes for the
# customer / part / supplier change tables (snapshot, update that recreates,
# delete, re-create under a new name). The rest grow with the data: one
# snapshot route per nation and one config change per supplier, for the
# per-nation tables ``sup_<nationkey>``.
CONFIG_CHANGES = """
select * from (values
 (0, 'r', 'customer', 'dim_customer', 'id,name,extra', 'info', 'id'),
 (1, 'r', 'part', 'dim_part', 'id,name', 'info', 'id'),
 (2, 'r', 'supplier', 'dim_supplier', 'id,extra', 'info', 'id'),
 (500, 'u', 'supplier', 'dim_supplier', 'id,name,extra', 'info', 'id'),
 (5000, 'd', 'part', 'dim_part', 'id,name', 'info', 'id'),
 (7000, 'u', 'customer', 'dim_customer_v2', 'id,name,extra', 'info', 'id'),
 (8000, 'c', 'part', 'dim_part_v2', 'id,name,extra', 'info', 'id'),
 (43, cast(null as varchar(1)), 'nation', 'dim_nation', 'id,name', 'info', 'id'),
 (40, 'r', 'unused', 'dim_unused', 'id,name', 'info', 'id'),
 (41, 't', 'unused', 'dim_unused', 'id,name', 'info,more', 'id'),
 (42, 'r', 'bare', 'dim_bare', 'id,name', 'info', 'id'),
 (44, cast(null as varchar(1)), 'bare', 'dim_bare', 'id,name', 'info,bare', 'id')
) as t(cseq, op, source_table, sink_table, sink_columns, sink_family, sink_row_key)
union all
select cast(3 + n_nationkey as bigint), 'r', concat('sup_', n_nationkey), concat('dim_sup_', n_nationkey, '_0'),
       'id,name,extra', 'info', 'id' from {t:nation}
union all
select s_suppkey*100+30,
       case s_suppkey % 4 when 0 then 'd' when 1 then 'c' else 'u' end,
       concat('sup_', s_nationkey), concat('dim_sup_', s_nationkey, '_', s_suppkey % 3),
       case when s_suppkey % 2 = 0 then 'id,name' else 'id,name,extra' end, 'info', 'id'
from {t:supplier}
"""

# Lines that are no one JSON object: good ones with something after them, or cut
# short. ``{line}`` is the good line.
MALFORMED_TAILS = "case {n} % 7 when 0 then '] x' when 1 then '],[{{\"x\":2}}' when 2 then ',' when 3 then '}}' when 4 then ']' else '' end"
MALFORMED = ("case {n} % 7 when 5 then concat({line}, {line}) when 6 then substring({line}, 1, length({line}) - 1)"
             " else concat({line}, " + MALFORMED_TAILS + ") end")

MALFORMED_CHANGES = """
select n_nationkey*100+95 as seq, """ + MALFORMED.format(
    n="n_nationkey", line="""concat('{"database":"gmall","table":"customer","type":"insert","data":{"id":', cast(n_nationkey as varchar(9)), ',"name":"bad"}}')""") + """ as value
from {t:nation}
"""

MALFORMED_CONFIGS = """
select n_nationkey*100+96 as seq, """ + MALFORMED.format(
    n="n_nationkey", line="""concat('{"op":"d","before":{"source_table":"customer","sink_table":"dim_customer","sink_row_key":"', cast(n_nationkey as varchar(9)), '"}}')""") + """ as value
from {t:nation}
union all select cast(97 as bigint), '{"op":"d"}'
"""

CONFIG_SNAPSHOT = """
select source_table, sink_table, sink_columns, sink_family, sink_row_key
from ({config_changes}) where op = 'r'
"""

_SPARK_MS = "timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"
_DUCK_MS = "(epoch_us(ts) // 1000)"


def spark_day(x: str) -> str:
    return ("date_format(convert_timezone('UTC','Asia/Shanghai',timestampadd(MILLISECOND,"
            f"{x},timestamp_ntz'1970-01-01 00:00:00')),'yyyy-MM-dd')")


def duck_day(x: str) -> str:
    return ("strftime(timestamp '1970-01-01' + to_milliseconds(" + x
            + ") + interval 8 hour,'%Y-%m-%d')")


def render(sql: str, engine: str, sf_dir: str | None = None) -> str:
    """Fill placeholders for ``engine`` in {'spark','duckdb'}."""
    out = sql.replace("{ms}", _SPARK_MS if engine == "spark" else _DUCK_MS)
    for t in TABLES:
        ref = f"parquet.`{sf_dir}/{t}.parquet`" if engine == "spark" else t
        out = out.replace("{t:" + t + "}", ref)
    return out


def _spark_sql(spark: SparkSession, sql: str, sf_dir: str) -> DataFrame:
    return spark.sql(render(sql, "spark", sf_dir))


def log_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, LOG_TYPED, sf_dir)


def change_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, CHANGE_TYPED, sf_dir)


def config_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, CONFIG_CHANGES, sf_dir)


def config_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, CONFIG_SNAPSHOT.replace("{config_changes}", CONFIG_CHANGES), sf_dir)


# -- rendering to JSON text --------------------------------------------------

def _positions(n: Column, keep_empty: Column) -> Column:
    """[{pos:0}..{pos:n-1}]; [] when n = 0 and ``keep_empty``; else NULL."""
    items = F.transform(F.sequence(F.lit(0), (n - 1).cast("int")),
                        lambda i: F.struct(i.alias("pos")))
    empty = F.filter(items, lambda x: F.lit(False))
    return F.when(n > 0, items).when(keep_empty, empty)


_LANDED: dict[tuple, str] = {}


def landed(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Land a rendered topic once per application as a multi-file table under
    the shared checkpoint folder, then read it like a topic with partitions.
    (The driver tables are single small files; read directly they would put
    the whole rendering and parse into one task, so builders spread the typed
    rows, which are smaller than the lines.)"""
    from rivulet.session import app_id, scratch_path
    key = (app_id(spark), sf_dir, name)
    if key not in _LANDED:
        path = scratch_path(spark, f"landed-{name}")
        build(spark, sf_dir).write.parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def _spread(df: DataFrame) -> DataFrame:
    from rivulet.session import parallelism
    return df.repartition(parallelism(df.sparkSession))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log topic: (seq, value) JSON lines, some deliberately broken."""
    return landed(spark, sf_dir, "log_lines", render_log_lines)


def change_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change topic: (seq, value) change envelopes."""
    return landed(spark, sf_dir, "change_lines", render_change_lines)


def config_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The config change stream: (seq, value) ``{op, before, after}`` envelopes."""
    return landed(spark, sf_dir, "config_lines", render_config_lines)


# Records of topics with partitions whose clocks differ: by time they come in
# another order than by seq, and several share a time.
RECORD_PARTITIONS, RECORD_STEP, RECORD_LAG_S, RECORD_EPOCH_S = 3, 20, 5, 1_700_000_000


def as_records(lines: DataFrame) -> DataFrame:
    """(seq, value) lines as records (time, partition, offset, value)."""
    part = F.col("seq") % RECORD_PARTITIONS
    at = F.floor(F.col("seq") / RECORD_STEP) + part * RECORD_LAG_S + RECORD_EPOCH_S
    return lines.select(F.timestamp_seconds(at).alias("time"), part.cast("int").alias("partition"),
                        F.floor(F.col("seq") / RECORD_PARTITIONS).alias("offset"), "value")


def records(spark: SparkSession, sf_dir: str, name: str, lines) -> str:
    """Folder with the records of ``lines(spark, sf_dir)``."""
    landed(spark, sf_dir, name, lambda s, d: as_records(lines(s, d)))
    from rivulet.session import app_id
    return _LANDED[(app_id(spark), sf_dir, name)]


def duck_record_order(seq: str) -> str:
    """One number that orders as (time, partition, offset) of the record."""
    part = f"({seq} % {RECORD_PARTITIONS})"
    return (f"((cast({seq} as hugeint) // {RECORD_STEP} + {part} * {RECORD_LAG_S}) * {RECORD_PARTITIONS} + {part})"
            f" * 1000000000000 + {seq} // {RECORD_PARTITIONS}")


def render_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered log topic: (seq, value) JSON lines, some deliberately broken."""
    t = _spread(log_typed(spark, sf_dir))
    even = (F.col("seq") % 2) == 0
    disp = _positions(F.col("display_n"), even)
    rec = F.struct(
        F.when(F.col("bad") != "no_common",
               F.struct(F.when(F.col("bad") != "no_mid", F.col("mid")).alias("mid"),
                        F.col("is_new").alias("is_new"))).alias("common"),
        F.when(F.col("bad") != "no_ts", F.col("ts_ms")).alias("ts"),
        F.when(F.col("has_err"), F.struct((F.col("seq") % 10).alias("error_code"))).alias("err"),
        F.when(F.col("has_start"), F.struct(F.lit("icon").alias("entry"))).alias("start"),
        F.when(F.col("page_id").isNotNull(), F.struct(F.col("page_id"))).alias("page"),
        F.when(F.col("display_key") == "display", disp).alias("display"),
        F.when(F.col("display_key") == "displays", disp).alias("displays"),
        _positions(F.col("action_n"), even).alias("actions"),
    )
    # ``bad`` is NULL for good lines; != on NULL is NULL, so coalesce first.
    t = t.withColumn("bad", F.coalesce(F.col("bad"), F.lit("")))
    t = t.select("seq", "bad", F.to_json(rec).alias("line"))
    broken = F.when(F.col("seq") % 2 == 0, F.lit("not json")).otherwise(F.expr(MALFORMED.format(n="seq", line="line")))
    return t.select("seq", F.when(F.col("bad") == "not_json", broken).otherwise(F.col("line")).alias("value"))


def render_full_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log topic with members that the job does not know, nested ones, and
    a ``displays`` beside ``display``."""
    old = F.when(F.col("seq") % 2 == 0, F.lit('"displays":[{"old":1}],')).otherwise(F.lit(""))
    more = F.concat(F.lit('{"zz":{"deep":[1,{"k":"a\\"b"},[]],"big":12345678901234567890},"arr":['), F.col("seq"),
                    F.lit(',2.5,true],'), old)
    value = F.replace("value", F.lit('"common":{'), F.lit('"common":{"os":{"v":["x",{}]},'))
    return log_lines(spark, sf_dir).select("seq", F.when(
        F.startswith("value", F.lit('{"')), F.concat(more, F.substr(value, F.lit(2)))).otherwise(F.col("value")).alias("value"))


def full_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log topic with unknown and nested members: (seq, value) JSON lines."""
    return landed(spark, sf_dir, "full_lines", render_full_lines)


def render_change_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered change topic: (seq, value) change envelopes."""
    t = _spread(change_typed(spark, sf_dir))
    data = (F.when(F.col("data_kind") == "row",
                   F.to_json(F.struct("id", "name", "extra")))
             .when(F.col("data_kind") == "empty", F.lit("{}")))
    rec = F.struct(F.col("db").alias("database"), F.col("tbl").alias("table"),
                   F.col("type"), F.parse_json(data).alias("data"))
    return t.select("seq", F.to_json(rec).alias("value")).unionByName(_spark_sql(spark, MALFORMED_CHANGES, sf_dir))


def render_config_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered config change stream: (seq, value) ``{op, before, after}``
    envelopes with snake_case images; ``d`` carries only ``before``, ``u`` both."""
    t = _spread(config_changes(spark, sf_dir))
    image = F.struct("source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key")
    stale = F.struct("source_table", F.lit("stale_sink").alias("sink_table"),
                     F.lit("id").alias("sink_columns"), "sink_family", "sink_row_key")
    rec = F.struct(
        F.col("op"),
        F.when(F.col("op") == "d", image).when(F.col("op") == "u", stale).alias("before"),
        F.when(F.coalesce("op", F.lit("")) != "d", image).alias("after"),
    )
    good = t.select(F.col("cseq").alias("seq"), F.to_json(rec).alias("value"))
    return good.unionByName(_spark_sql(spark, MALFORMED_CONFIGS, sf_dir))
