"""Streaming twins of the batch queries.

Each lands the rendered fixture lines as files in seq order, runs the
streaming job over them with ``availableNow`` and a one-file trigger (several
micro-batches), and returns the sink's content read back as a batch
DataFrame, so it can be compared with its batch twin's oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.functions.jsonmap import parse_one
from rivulet.functions.times import day_text
from rivulet.operators import configs as CF, logs as L
from rivulet.plans import fixtures as FX
from rivulet.plans.extract import extract_routed
from rivulet.plans.oracle import DIM_CTES, LOG_CTES, ORACLE, _w
from rivulet.session import app_id, parallelism, scratch_path
from rivulet.sources.hybrid import read_snapshot_then_changes
from rivulet.sources.topics import land_lines, read_topic
from rivulet.streaming import jobs as J
from rivulet.streaming.apps import main
from rivulet.streaming.sinktables import list_tables, read_table

PIECES = 3
#: Batches of a config stream's changes, about, where the table is large; and
#: the seqs that a batch takes at least.
CHANGE_BATCHES, LEAST_SEQS = 24, 4000


def _drain(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _files_per_piece(spark: SparkSession) -> int:
    return parallelism(spark)


_SOURCES: dict[tuple, str] = {}


def _landed(spark: SparkSession, d: str, name: str, build) -> str:
    """Land a topic once per application as seq-ordered pieces of files; each
    streaming run uses a fresh checkpoint, so it replays all of them."""
    key = (app_id(spark), d, name)
    if key not in _SOURCES:
        src = scratch_path(spark, f"stream-{name}")
        land_lines(build(spark, d), src, PIECES, _files_per_piece(spark))
        _SOURCES[key] = src
    return _SOURCES[key]


def _landed_log(spark: SparkSession, d: str) -> str:
    return _landed(spark, d, "topic_log", FX.log_lines)


def _merged_db(spark: SparkSession, d: str) -> DataFrame:
    return (FX.config_lines(spark, d).withColumn("kind", F.lit("config"))
            .unionByName(FX.change_lines(spark, d).withColumn("kind", F.lit("change"))))


def prepare(spark: SparkSession, d: str) -> None:
    """Land every streaming source for ``d`` (bench setup)."""
    _landed_log(spark, d)
    _landed(spark, d, "topic_config", FX.config_lines)
    _landed(spark, d, "topic_db", _merged_db)


def _stream_lines(spark: SparkSession, src: str) -> DataFrame:
    return read_topic(spark, fmt="parquet", path=src,
                      max_files_per_trigger=_files_per_piece(spark))


def source_stream(spark: SparkSession, d: str) -> DataFrame:
    src = _landed_log(spark, d)
    out, ck = scratch_path(spark, "source_out"), scratch_path(spark, "ck")
    s = _stream_lines(spark, src).select(
        "seq", F.when(parse_one(F.col("value"), "struct<ts:string>").isNotNull(),
                      F.get_json_object("value", "$.common.mid")).alias("mid"))
    _drain(J.run_stream(s, ck, fmt="parquet", path=out, available_now=True,
                        state_partitions=_files_per_piece(spark)))
    return spark.read.schema("seq long, mid string").parquet(out)


def config_stream(spark: SparkSession, d: str) -> DataFrame:
    src = _landed(spark, d, "topic_config", FX.config_lines)
    out, ck = scratch_path(spark, "config_out"), scratch_path(spark, "ck")
    s = CF.config_images(_stream_lines(spark, src))
    _drain(J.run_stream(s, ck, fmt="parquet", path=out, available_now=True,
                        state_partitions=_files_per_piece(spark)))
    return spark.read.schema(J.HISTORY_SCHEMA).parquet(out)


def visitor_fix_stream(spark: SparkSession, d: str) -> DataFrame:
    src = _landed_log(spark, d)
    out, state, ck = (scratch_path(spark, n) for n in ("visitor_out", "visits", "ck"))
    _drain(J.run_stream(_stream_lines(spark, src), ck, available_now=True,
                        foreach_batch=J.fixed_batch_writer(out, state, compact_every=2, bucket_devices=100),
                        state_partitions=_files_per_piece(spark)))
    r = (spark.read.schema("seq long, mid string, is_new string, visit_day date, first_visit date, is_new_fixed string, "
                           "dirty_reason string, batch long").parquet(out)
         .where((F.col("batch") <= J.committed(spark, state)) & F.col("dirty_reason").isNull()))
    return r.select("seq", "mid", F.col("is_new").alias("is_new_in"),
                    day_text(F.col("visit_day")).alias("visit_date"),
                    day_text(F.col("first_visit")).alias("first_visit"),
                    F.col("is_new_fixed").alias("is_new"))


def _routed_stream(spark: SparkSession, d: str) -> tuple[str, str]:
    """The log job's topic folders and state folder."""
    src = _landed_log(spark, d)
    out, state, ck = (scratch_path(spark, n) for n in ("topics_out", "visits", "ck"))
    _drain(J.run_stream(_stream_lines(spark, src), ck, available_now=True,
                        foreach_batch=J.log_batch_writer(out, state, compact_every=2),
                        state_partitions=_files_per_piece(spark)))
    return out, state


def route_stream(spark: SparkSession, d: str) -> DataFrame:
    r = J.committed_topics(spark, *_routed_stream(spark, d))
    return extract_routed(r).select("topic", "seq", "pos", "mid", "is_new", "ts", "page_id")


def topic_sink_stream(spark: SparkSession, d: str) -> DataFrame:
    """Counts per topic folder of the file topic sink."""
    r = J.committed_topics(spark, *_routed_stream(spark, d))
    return r.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def route_stream_counts(spark: SparkSession, d: str) -> DataFrame:
    """Records per topic as the job's batches counted them while writing."""
    _, state = _routed_stream(spark, d)
    return _outcomes(J.read_counts(spark, state, J.TOPICS), J.TOPICS)


def _outcomes(counts: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Counts of all batches, one row a name."""
    total = counts.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    return total.select(F.inline(F.array(*[F.struct(F.lit(n).alias("outcome"), F.col(n).alias("n")) for n in names])))


def _dim_state(spark: SparkSession, d: str) -> str:
    """The dimension job's state folder."""
    src = _landed(spark, d, "topic_db", _merged_db)
    state, ck = scratch_path(spark, "dim_state"), scratch_path(spark, "ck")
    s = (spark.readStream.schema("seq long, value string, kind string")
         .option("maxFilesPerTrigger", str(_files_per_piece(spark))).parquet(src))
    _drain(J.run_stream(s, ck, foreach_batch=J.dim_batch_writer(state, compact_every=2),
                        available_now=True,
                        state_partitions=_files_per_piece(spark)))
    return state


def dim_stream(spark: SparkSession, d: str) -> DataFrame:
    return J.dim_current_from_logs(spark, _dim_state(spark, d))


def dim_stream_counts(spark: SparkSession, d: str) -> DataFrame:
    """What became of every line of the dimension job's topic, as its batches
    counted it while writing."""
    names = J.COUNTS + J.CONFIG_COUNTS
    return _outcomes(J.read_counts(spark, _dim_state(spark, d), names), names)


def _seqs_a_batch(changes: DataFrame) -> int:
    """A batch's share of all seqs: with a fixed size the number of batches,
    each of which costs the same at least, would grow with the table."""
    low, high = changes.agg(F.min("seq"), F.max("seq")).first()
    return max(LEAST_SEQS, (high - low) // CHANGE_BATCHES + 1) if low is not None else LEAST_SEQS


def config_hybrid_stream(spark: SparkSession, d: str) -> DataFrame:
    """Config snapshot, then config changes, as one stream that is stopped in
    mid-snapshot and started again."""
    snap, chg, out, ck = (scratch_path(spark, n) for n in ("config_snap", "config_chg", "config_out", "ck"))
    FX.config_snapshot(spark, d).repartition(6).write.parquet(snap)
    parsed = CF.parse_configs(FX.config_lines(spark, d))
    later = parsed.where(F.col("bad").isNull() & ~F.col("op").eqNullSafe(F.lit("r"))).select(F.col("cseq").alias("seq"))
    changes = FX.config_lines(spark, d).join(later, "seq", "left_semi")
    # in order of seq, so that a batch reads the files of its own seqs
    changes.repartitionByRange(CHANGE_BATCHES, "seq").sortWithinPartitions("seq").write.parquet(chg)
    options = {"snapshotPath": snap, "changesPath": chg, "progressPath": f"{ck}-progress", "unitsPerTrigger": "2",
               "seqsPerTrigger": str(_seqs_a_batch(spark.read.schema("seq long").parquet(chg)))}

    def start():
        images = CF.config_images(read_snapshot_then_changes(spark, options))
        return J.run_stream(images, ck, fmt="parquet", path=out, processing_time="0 seconds")

    first = start()
    while not any(p["numInputRows"] for p in first.recentProgress):
        if first.exception() is not None:
            raise first.exception()
        first.awaitTermination(0.05)
    first.stop()
    again = start()
    again.processAllAvailable()
    again.stop()
    images = spark.read.schema(J.HISTORY_SCHEMA).parquet(out)
    return images.withColumn("cseq", F.when(F.col("cseq") >= 0, F.col("cseq")))


def dim_stream_preload(spark: SparkSession, d: str) -> DataFrame:
    """The dimension job by its command line: the config table's snapshot is
    preloaded, the config topic holds its changes only."""
    snap, chg, cfg, state, ck = (scratch_path(spark, n) for n in ("config_snap", "changes", "config_chg", "dim_state", "ck"))
    FX.config_snapshot(spark, d).write.parquet(snap)
    FX.change_lines(spark, d).write.parquet(chg)
    (FX.config_lines(spark, d).join(FX.config_changes(spark, d).where("op = 'r'").select(F.col("cseq").alias("seq")), "seq", "left_anti")
     .write.parquet(cfg))
    main(["dim", "--source-format", "parquet", "--source-path", chg, "--config-path", cfg, "--state-dir", state, "--checkpoint", ck,
          "--order", "seq", "--preload-path", snap, "--available-now"])
    return J.read_change_log(spark, state).where("quarantine is null").select("seq", "type", "sink_table", "row_key")


def dim_stream_arrival(spark: SparkSession, d: str) -> DataFrame:
    """Two topics in order of arrival: every change of a batch meets the config
    as it stands after the batch's config changes."""
    src = _landed(spark, d, "topic_db", _merged_db)
    state, ck = scratch_path(spark, "dim_state"), scratch_path(spark, "ck")
    s = (spark.readStream.schema("seq long, value string, kind string")
         .option("maxFilesPerTrigger", "100000").parquet(src))
    _drain(J.run_stream(s, ck, foreach_batch=J.dim_batch_writer(state, order="arrival"), available_now=True,
                        state_partitions=_files_per_piece(spark)))
    return J.read_change_log(spark, state).where("quarantine is null").select("seq", "type", "sink_table", "row_key")


def _tables_stream(spark: SparkSession, d: str) -> str:
    """The dimension job with its sink tables in the catalog; their namespace."""
    src = _landed(spark, d, "topic_db", _merged_db)
    state, ck = scratch_path(spark, "dim_state"), scratch_path(spark, "ck")
    namespace = "dim_" + state.rsplit("-", 1)[-1]
    s = (spark.readStream.schema("seq long, value string, kind string")
         .option("maxFilesPerTrigger", str(2 * _files_per_piece(spark))).parquet(src))
    _drain(J.run_stream(s, ck, foreach_batch=J.dim_batch_writer(state, namespace=namespace, buckets=2), available_now=True,
                        state_partitions=_files_per_piece(spark)))
    return namespace


def dim_tables_stream(spark: SparkSession, d: str) -> DataFrame:
    """Sink tables that the catalog holds after all config ops."""
    return list_tables(spark, _tables_stream(spark, d))


def dim_wide(spark: SparkSession, d: str) -> DataFrame:
    """Rows of all sink tables, one per key."""
    namespace = _tables_stream(spark, d)
    cols, rows = ("id", "name", "extra"), None
    for name in sorted(t.name for t in spark.catalog.listTables(namespace)):
        t = read_table(spark, namespace, name)
        own = t.select(F.lit(name).alias("sink_table"), "row_key", *[
            F.col(c) if c in t.columns else F.lit(None).cast("string").alias(c) for c in cols])
        rows = own if rows is None else rows.unionByName(own)
    return rows


STREAM_QUERIES = {
    "dim_stream_preload": dim_stream_preload, "dim_stream_arrival": dim_stream_arrival,
    "config_hybrid_stream": config_hybrid_stream, "dim_tables_stream": dim_tables_stream, "dim_wide": dim_wide,
    "source_stream": source_stream, "config_stream": config_stream,
    "visitor_fix_stream": visitor_fix_stream, "route_stream": route_stream,
    "topic_sink_stream": topic_sink_stream, "dim_stream": dim_stream,
    "route_stream_counts": route_stream_counts, "dim_stream_counts": dim_stream_counts,
}

STREAM_ORACLE = {
    "config_hybrid_stream": _w(DIM_CTES, """
select case when op is distinct from 'r' then cseq end as cseq, op, source_table, sink_table, sink_columns, sink_family, sink_row_key
from cc"""),
    "dim_tables_stream": ORACLE["sink_tables"],
    # a snapshot row is in force from the start of time, a later config change from its seq on
    "dim_stream_preload": _w(DIM_CTES, """
select cf.seq, cf.type, coalesce(c.sink_table, s.sink_table) as sink_table, cast(cf.id as varchar) as row_key
from cf
left join (select x.seq, max(y.cseq) as cseq from cf x join cc y on y.source_table = x.tbl and y.cseq <= x.seq
           and y.op is distinct from 'r' group by x.seq) v on v.seq = cf.seq
left join cc c on c.cseq = v.cseq and c.source_table = cf.tbl
left join cs s on s.source_table = cf.tbl and v.cseq is null
where (c.source_table is not null and c.op is distinct from 'd' or s.source_table is not null) and cf.id is not null"""),
    "dim_stream_arrival": _w(DIM_CTES, """
select cf.seq, cf.type, c.sink_table, cast(cf.id as varchar) as row_key
from cf join cc c on c.source_table = cf.tbl
join (select source_table, max(cseq) as cseq from cc group by 1) l on l.source_table = c.source_table and l.cseq = c.cseq
where c.op is distinct from 'd' and cf.id is not null"""),
    "dim_wide": _w(DIM_CTES, """
select sink_table, row_key, max(value) filter (where col = 'id') as id, max(value) filter (where col = 'name') as name,
       max(value) filter (where col = 'extra') as extra
from cur group by sink_table, row_key"""),
    "source_stream": _w(LOG_CTES, """
select seq, case when bad in ('not_json', 'no_common', 'no_mid') then null else mid end as mid from lt"""),
    "config_stream": ORACLE["config_images"],
    "visitor_fix_stream": ORACLE["visitor_fix"],
    "route_stream": ORACLE["route_all"],
    "topic_sink_stream": ORACLE["route_counts"],
    "dim_stream": ORACLE["dim_current"],
    "route_stream_counts": f"""
select t.outcome, count(r.topic) as n
from (values ('dwd_traffic_page'), ('dwd_traffic_start'), ('dwd_traffic_display'), ('dwd_traffic_action'),
             ('dwd_traffic_err'), ('dirty_data')) t(outcome)
left join ({ORACLE["route_all"]}) r on r.topic = t.outcome
group by t.outcome""",
    # a line is malformed, else filtered, else unrouted, else cannot be applied (no data, no row key
    # among the columns kept, a put of two families), else a delete or a put
    "dim_stream_counts": _w(f"""{DIM_CTES},
mal as ({FX.render(FX.MALFORMED_CHANGES, "duckdb")}),
cmal as ({FX.render(FX.MALFORMED_CONFIGS, "duckdb")}),
fate as (
  select case when cf.seq is null then 'filtered'
              when c.cseq is null or c.op is not distinct from 'd' then 'unrouted'
              when ct.data_kind <> 'row' or ct.id is null or not list_contains(string_split(c.sink_columns, ','), c.sink_row_key)
                   or (ct.type <> 'delete' and contains(c.sink_family, ',')) then 'quarantined'
              when ct.type = 'delete' then 'deletes' else 'puts' end as outcome
  from ct left join cf on cf.seq = ct.seq left join v on v.seq = ct.seq
  left join cc c on c.cseq = v.cseq and c.source_table = ct.tbl),
each as (
  select outcome, count(*) as n from fate group by 1
  union all select 'malformed', count(*) from mal
  union all select 'lines', (select count(*) from ct) + (select count(*) from mal)
  union all select 'config_malformed', count(*) from cmal
  union all select 'config_lines', (select count(*) from cc) + (select count(*) from cmal))""", """
select t.outcome, coalesce(each.n, 0) as n
from (values ('lines'), ('malformed'), ('filtered'), ('unrouted'), ('quarantined'), ('puts'), ('deletes'),
             ('config_lines'), ('config_malformed')) t(outcome)
left join each on each.outcome = t.outcome"""),
}
