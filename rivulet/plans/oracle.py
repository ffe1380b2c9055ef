"""DuckDB oracle SQL, one statement per query in the catalog.

The typed fixtures (shared with the Spark side as *inputs*) are inlined as
CTEs; the logic on top is written independently in plain SQL.
"""

from __future__ import annotations

from rivulet.plans import fixtures as FX

DAY = FX.duck_day


def _fx(sql: str) -> str:
    return FX.render(sql, "duckdb")


LT = _fx(FX.LOG_TYPED)
CT = _fx(FX.CHANGE_TYPED)
CC = _fx(FX.CONFIG_CHANGES)

LOG_CTES = f"""
lt as ({LT}),
g as (select * from lt where bad is null),
s as (select g.*, {DAY('ts_ms')} as d, {DAY('ts_ms - 86400000')} as pd from g),
fv as (select mid, arg_min(case when is_new = '1' then d else pd end, seq) as first_visit
       from s group by mid),
f as (select s.*, fv.first_visit,
             case when s.is_new = '1' and s.d <> fv.first_visit then '0' else s.is_new end as is_new_fixed
      from s join fv using (mid))
"""

DIM_CTES = f"""
ct as ({CT}),
cc as ({CC}),
cs as (select source_table, sink_table, sink_columns, sink_family, sink_row_key from cc where op = 'r'),
cf as (select * from ct where db = 'gmall' and (type = 'insert' or type = 'update' or type = 'delete'
       or (type = 'bootstrap-insert' and data_kind = 'row'))),
v as (select cf.seq, max(c.cseq) as cseq from cf join cc c on c.source_table = cf.tbl and c.cseq <= cf.seq
      group by cf.seq),
rt as (select cf.seq, cf.tbl, cf.type, cf.id, cf.name, cf.extra, c.cseq, c.sink_table, c.sink_columns
       from cf join v on v.seq = cf.seq join cc c on c.cseq = v.cseq and c.source_table = cf.tbl
       where c.op is distinct from 'd'),
cl as (select seq, type, sink_table, sink_columns, cast(id as varchar) as row_key, 'id' as col, cast(id as varchar) as value from rt
       union all select seq, type, sink_table, sink_columns, cast(id as varchar), 'name', name from rt
       union all select seq, type, sink_table, sink_columns, cast(id as varchar), 'extra', extra from rt),
kept as (select * from cl where value is not null and list_contains(string_split(sink_columns, ','), col)),
putc as (select * from kept where type <> 'delete' and value <> ''),
rowdel as (select sink_table, cast(id as varchar) as row_key, seq from rt where type = 'delete'),
ev as (select cseq, sink_table, op, sink_family from cc),
lastdrop as (select sink_table, max(cseq) as lseq from ev where coalesce(op, '') not in ('r', 'c') group by sink_table),
lastop as (select ev.sink_table, ev.op, ev.sink_family from ev join lastdrop l
           on ev.sink_table = l.sink_table and ev.cseq = l.lseq),
creat as (select ev.sink_table, arg_min(ev.sink_family, ev.cseq) as fam from ev
          left join lastdrop l on ev.sink_table = l.sink_table
          where ev.op in ('r', 'c') and (l.lseq is null or ev.cseq > l.lseq) group by ev.sink_table),
tabs as (select t.sink_table, case when lo.sink_table is not null and lo.op is distinct from 'd' then lo.sink_family else cr.fam end as sink_family
         from (select sink_table from lastdrop union select sink_table from creat) t
         left join lastop lo on lo.sink_table = t.sink_table left join creat cr on cr.sink_table = t.sink_table),
live as (select c.*, row_number() over (partition by c.sink_table, c.row_key, c.col order by c.seq desc) as rn
         from putc c
         left join (select sink_table, row_key, max(seq) as dseq from rowdel group by 1, 2) d
           on d.sink_table = c.sink_table and d.row_key = c.row_key
         left join lastdrop t on t.sink_table = c.sink_table
         where c.seq > coalesce(d.dseq, -1) and c.seq >= coalesce(t.lseq, -1)),
cur as (select sink_table, row_key, col, value from live where rn = 1)
"""


# The same rules where "earlier" is by record time: every seq is replaced by a
# number that orders as (time, partition, offset).
_K = FX.duck_record_order
LOG_CTES_BY_TIME = LOG_CTES.replace(f"lt as ({LT})", f"lt as (select * replace ({_K('seq')} as seq), seq as line from ({LT}))")
DIM_CTES_BY_TIME = DIM_CTES.replace(f"ct as ({CT})", f"ct as (select * replace ({_K('seq')} as seq) from ({CT}))").replace(
    f"cc as ({CC})", f"cc as (select * replace ({_K('cseq')} as cseq) from ({CC}))")


def _w(ctes: str, body: str) -> str:
    return f"with {ctes.strip()}\n{body}"


def _route_rows() -> str:
    return """
rr as (
 select 'dwd_traffic_err' as topic, seq, cast(null as integer) as pos, mid, is_new_fixed as is_new, ts_ms as ts, page_id from f where has_err
 union all select 'dwd_traffic_start', seq, null, mid, is_new_fixed, ts_ms, page_id from f where has_start
 union all select 'dwd_traffic_page', seq, null, mid, is_new_fixed, ts_ms, page_id from f
 union all select 'dwd_traffic_display', seq, cast(unnest(range(display_n)) as integer), mid, is_new_fixed, ts_ms, page_id
           from f where not has_start and display_key = 'display' and display_n > 0
 union all select 'dwd_traffic_action', seq, cast(unnest(range(action_n)) as integer), mid, is_new_fixed, cast(null as bigint), page_id
           from f where not has_start and action_n > 0
 union all select 'dirty_data', seq, null, cast(null as varchar), cast(null as varchar), cast(null as bigint), cast(null as varchar)
           from lt where bad is not null)
"""


def _record_rows() -> str:
    """Whole records as text, the members of every object in order of name."""
    positions = lambda n: f"""'[' || array_to_string(list_transform(range({n}), lambda x: '{{"pos":' || x || '}}'), ',') || ']'"""
    record = lambda *members: "'{' || concat_ws(',', " + ", ".join(members) + ") || '}'"
    common, page, ts = """'"common":' || common""", """'"page":' || page""", """'"ts":' || ts_ms"""
    arr, actions = """'"arr":[' || seq || ',2.5,true]'""", """'"actions":' || actions"""
    rest = ("""case when has_start then '"start":{"entry":"icon"}' end""", ts,
            r"""'"zz":{"big":12345678901234567890,"deep":[1,{"k":"a\"b"},[]]}'""")
    display = """case when display_key = 'display' then '"display":' || displays end"""
    displays = """'"displays":' || case when display_key = 'displays' then displays else '[{"old":1}]' end"""
    err = """case when has_err then '"err":{"error_code":' || (seq % 10) || '}' end"""
    shown, acted = """'"display":{"pos":' || pos || '}'""", """'"action":{"pos":' || pos || '}'"""
    return f"""
r as (select *, '{{"is_new":"' || is_new_fixed || '","mid":"' || mid || '","os":{{"v":["x",{{}}]}}}}' as common,
        '{{"page_id":"' || page_id || '"}}' as page,
        case when display_n > 0 or seq % 2 = 0 then {positions('display_n')} end as displays,
        case when action_n > 0 or seq % 2 = 0 then {positions('action_n')} end as actions,
        not has_start and display_key = 'display' and display_n > 0 as shown, not has_start and action_n > 0 as acted
      from f),
w as (select *, {record(f"case when not acted then {actions} end", arr, common, display,
                        f"case when not shown then {displays} end", page, *rest)} as cut,
        {record(actions, arr, common, display, displays, err, page, *rest)} as whole from r)
select 'dwd_traffic_err' as topic, seq, cast(null as integer) as pos, whole as record from w where has_err
union all select 'dwd_traffic_start', seq, null, cut from w where has_start
union all select 'dwd_traffic_page', seq, null, cut from w
union all select 'dwd_traffic_display', seq, pos, {record(common, shown, page, ts)}
  from (select *, cast(unnest(range(display_n)) as integer) as pos from w where shown)
union all select 'dwd_traffic_action', seq, pos, {record(acted, common, page)}
  from (select *, cast(unnest(range(action_n)) as integer) as pos from w where acted)
union all select 'dirty_data', seq, null, null from lt where bad is not null"""


def _ms_cte() -> str:
    return "e as (select event_id as seq, epoch_us(ts) // 1000 as ts_ms from events)"


def _local(x: str) -> str:
    return f"(timestamp '1970-01-01' + to_milliseconds({x}) + interval 8 hour)"


ORACLE: dict[str, str] = {
    "log_parsed": _w(LOG_CTES, """
select seq, mid, is_new, ts_ms as ts, page_id,
       case when has_err then seq % 10 end as error_code,
       case when has_start then 'icon' end as entry,
       case when display_key = 'display' and (display_n > 0 or seq % 2 = 0) then display_n end as display_n,
       case when display_key = 'displays' and (display_n > 0 or seq % 2 = 0) then display_n end as displays_n,
       case when action_n > 0 or seq % 2 = 0 then action_n end as actions_n
from g"""),
    "log_dirty": _w(LOG_CTES, "select seq, bad as dirty_reason from lt where bad is not null"),
    "visitor_first_visit": _w(LOG_CTES, "select mid, first_visit from fv"),
    "visitor_fix": _w(LOG_CTES, """
select seq, mid, is_new as is_new_in, d as visit_date, first_visit, is_new_fixed as is_new from f"""),
    "route_err": _w(LOG_CTES, """
select seq, mid, is_new_fixed as is_new, ts_ms as ts, page_id, seq % 10 as error_code, has_start
from f where has_err"""),
    "route_start": _w(LOG_CTES, """
select seq, mid, is_new_fixed as is_new, ts_ms as ts, 'icon' as entry, false as has_err, page_id
from f where has_start"""),
    "route_page": _w(LOG_CTES, """
select seq, mid, is_new_fixed as is_new, ts_ms as ts, page_id, false as has_err, has_start,
       case when display_key = 'display' and (display_n > 0 or seq % 2 = 0) then display_n end as display_n,
       case when display_key = 'displays' and (display_n > 0 or seq % 2 = 0) then display_n end as displays_n,
       case when action_n > 0 and not has_start then null
            when action_n > 0 or seq % 2 = 0 then action_n end as actions_n
from f"""),
    "route_display": _w(LOG_CTES + "," + _route_rows(), """
select seq, pos, mid, is_new, ts, page_id, pos as display_pos from rr where topic = 'dwd_traffic_display'"""),
    "route_action": _w(LOG_CTES + "," + _route_rows(), """
select seq, pos, mid, is_new, page_id, pos as action_pos, false as has_ts from rr where topic = 'dwd_traffic_action'"""),
    "route_all": _w(LOG_CTES + "," + _route_rows(), "select topic, seq, pos, mid, is_new, ts, page_id from rr"),
    "route_counts": _w(LOG_CTES + "," + _route_rows(), "select topic, count(*) as n from rr group by topic"),
    "route_records": _w(LOG_CTES + ",", _record_rows()),
    "date_columns": _w(_ms_cte(), f"""
select seq, ts_ms,
       strftime({_local('ts_ms')}, '%Y-%m-%d') as day,
       strftime({_local('ts_ms')}, '%Y-%m-%d %H:%M:%S') as datetime,
       strftime({_local('ts_ms')}, '%Y%m%d') as part_day,
       strftime({_local('ts_ms - 86400000')}, '%Y-%m-%d') as prev_day,
       (ts_ms // 1000) * 1000 as ts_back,
       ((ts_ms + 28800000) // 86400000) * 86400000 - 28800000 as day_start
from e"""),
    "partition_by_day": _w(LOG_CTES, f"""
select strftime({_local('ts_ms')}, '%Y%m%d') as dt, count(*) as n from g group by 1"""),
    "visitor_fix_partitions": _w(LOG_CTES_BY_TIME, f"""
select cast(line % {FX.RECORD_PARTITIONS} as integer) as partition, line // {FX.RECORD_PARTITIONS} as "offset", mid, is_new as is_new_in,
       d as visit_date, first_visit, is_new_fixed as is_new from f"""),
    "config_asof_partitions": _w(DIM_CTES_BY_TIME, f"""
select cast(seq // 1000000000000 % {FX.RECORD_PARTITIONS} as integer) as partition, cast(seq % 1000000000000 as bigint) as "offset",
       tbl, type, sink_table, sink_columns from rt"""),
    "dim_current_partitions": _w(DIM_CTES_BY_TIME, "select * from cur"),
    "change_filter": _w(DIM_CTES, "select seq, tbl, type, data_kind from cf"),
    "config_images": _w(DIM_CTES, """
select cseq, op, source_table, sink_table, sink_columns, sink_family, sink_row_key from cc"""),
    "change_quarantine": _fx(FX.MALFORMED_CHANGES),
    "config_quarantine": _fx(FX.MALFORMED_CONFIGS),
    "config_snapshot": _w(DIM_CTES, "select * from cs"),
    "rename_columns": _w(DIM_CTES, """
select source_table as "sourceTable", sink_table as "sinkTable", sink_columns as "sinkColumns",
       sink_family as "sinkFamily", sink_row_key as "sinkRowKey" from cs"""),
    "config_current": _w(DIM_CTES, """
select c.source_table, c.cseq, c.sink_table, c.sink_columns, c.sink_family, c.sink_row_key
from cc c join (select source_table, max(cseq) as cseq from cc group by 1) l using (source_table, cseq)
where c.op is distinct from 'd'"""),
    "column_retain": _w(DIM_CTES, "select seq, type, sink_table, col, value from kept"),
    "config_join": _w(DIM_CTES, """
select cf.seq, cf.tbl, cf.type, cs.sink_table, cs.sink_columns from cf join cs on cs.source_table = cf.tbl"""),
    "config_lookup": _w(DIM_CTES, "select seq, tbl, type, sink_table, sink_columns from rt"),
    "config_asof_join": _w(DIM_CTES, "select seq, tbl, type, cseq, sink_table, sink_columns from rt"),
    "dim_cells": _w(DIM_CTES, "select seq, sink_table, row_key, col, value from putc"),
    "dim_deletes": _w(DIM_CTES, "select seq, sink_table, row_key from rowdel"),
    "sink_tables": _w(DIM_CTES, "select sink_table, sink_family from tabs where sink_family is not null"),
    "sink_families": _w(DIM_CTES, """
select sink_table, unnest(string_split(sink_family, ',')) as family from tabs where sink_family is not null"""),
    "dim_current": _w(DIM_CTES, "select * from cur"),
    "dim_current_after_config": _w(DIM_CTES, """
select t.sink_table, coalesce(a.n_rows, 0) as n_rows, coalesce(a.n_cells, 0) as n_cells
from tabs t left join (select sink_table, count(distinct row_key) as n_rows, count(*) as n_cells
                       from cur group by 1) a on a.sink_table = t.sink_table
where t.sink_family is not null"""),
}
