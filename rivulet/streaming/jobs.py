"""Structured Streaming forms of the two jobs, plus the common runner.

``run_stream`` is the job shape shared by every streaming query: source ->
transform -> sink, with a checkpoint per query (offsets and state live
there, so a restart resumes exactly where the last committed batch ended).
"""

from __future__ import annotations

import threading
from contextlib import contextmanager
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet import constants as K
from rivulet.operators import changes as CH, configs as CF, dims as D, logs as L
from rivulet.sources.topics import read_topics, write_topics_batch
from rivulet.streaming import sinktables as T

DEFAULT_TRIGGER = "5 seconds"
_STARTING = threading.Lock()


def run_stream(df: DataFrame, checkpoint: str, *, fmt: str | None = None, path: str | None = None,
               foreach_batch: Callable[[DataFrame, int], None] | None = None,
               available_now: bool = False, processing_time: str = DEFAULT_TRIGGER,
               options: dict | None = None, partition_by: list[str] | None = None,
               name: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Start ``df`` into a sink. ``available_now`` drains what is there (as
    several micro-batches when the source is rate-limited) and stops.

    ``state_partitions`` fixes the number of partitions of the query's
    stateful and shuffle steps. It is recorded in the checkpoint on the first
    start and adaptive execution does not coalesce it, so size it to the
    cores that will run the query (more only when state is large)."""
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt or "parquet").options(**(options or {}))
        if partition_by:
            w = w.partitionBy(*partition_by)
        if path is not None:
            w = w.option("path", path)
    confs = {}
    if state_partitions is not None:
        confs["spark.sql.shuffle.partitions"] = str(state_partitions)
    if available_now:
        # a drain must end: no empty batches for state cleanup (a state TTL
        # otherwise keeps a processing-time query busy evicting forever)
        confs["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    if not confs:
        return w.start()
    spark = df.sparkSession
    with _STARTING:                     # two starters do not see each other's settings
        old = {k: spark.conf.get(k, None) for k in confs}
        for k, v in confs.items():
            spark.conf.set(k, v)
        try:
            return w.start()            # the query runs on a clone of the session taken here
        finally:
            for k, v in old.items():
                if v is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, v)


VISIT_SCHEMA = "mid string, first_visit date"


def _read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of all ``batch=<id>`` folders under ``path``; none before the first."""
    return _read_table(spark, path, f"{schema}, batch long" if schema else "batch long")


def _read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, empty where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _snapshot_upto(spark: SparkSession, marks: str, below: int | None = None) -> int:
    """Last batch of the newest *complete* snapshot (of batches before
    ``below``), -1 without one. A snapshot counts once its marker exists; the
    marker is written only after the table committed, so a compaction that
    died half way is never read."""
    try:
        done = spark.read.schema("done int, upto long").parquet(marks)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    if below is not None:
        done = done.where(F.col("upto") < F.lit(below))
    upto = done.agg(F.max("upto")).first()[0]
    return -1 if upto is None else int(upto)


def _mark_snapshot(spark: SparkSession, marks: str, upto: int, buckets: int = 1) -> None:
    (spark.range(1).select(F.lit(1).alias("done"), F.lit(buckets).alias("buckets"))
     .write.mode("overwrite").parquet(f"{marks}/upto={upto}"))


def _mark_done(spark: SparkSession, state_dir: str, batch_id: int, values: dict[str, int]) -> None:
    """The last thing a batch writes: what it wrote before is visible from here
    on, in all its folders at once. ``values`` are the batch's counts."""
    (spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in values.items()])
     .write.mode("overwrite").parquet(f"{state_dir}/done/batch={batch_id}"))


def read_counts(spark: SparkSession, state_dir: str, names: tuple[str, ...]) -> DataFrame:
    """Counts of every completed batch, a row each: (batch, <names>)."""
    return _read_batches(spark, f"{state_dir}/done", ", ".join(f"`{n}` long" for n in names)).select("batch", *names)


def committed(spark: SparkSession, state_dir: str) -> int:
    """The last completed batch, -1 before the first. Batches complete in the
    order of their ids, so all before it are complete, too."""
    last = read_counts(spark, state_dir, ()).agg(F.max("batch")).first()[0]
    return -1 if last is None else int(last)


def _retire(spark: SparkSession, folder: str, column: str, below: int) -> None:
    """Delete the ``<column>=<id>`` folders under ``folder`` with smaller ids."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(path):
        return
    for entry in fs.listStatus(path):
        name, _, at = entry.getPath().getName().partition("=")
        if name == column and at.isdigit() and int(at) < below:
            fs.delete(entry.getPath(), True)


def _base(spark: SparkSession, marks: str, batch_id: int, keep_batches: int) -> int:
    """The snapshot from which all of the last ``keep_batches`` batches, which
    may run again or be read, can still be answered; -1 without one. Nothing
    before it is needed."""
    if keep_batches < 1:
        raise ValueError("keep_batches: at least the last batch, which may run again")
    return _snapshot_upto(spark, marks, batch_id - keep_batches + 1)


#: Devices a bucket of the device state holds, about, and the most buckets,
#: which bounds the folders a batch lists and the bucket numbers it collects.
BUCKET_DEVICES, MAX_BUCKETS = 250_000, 4096


def visit_bucket(buckets: int) -> F.Column:
    """The bucket of the device in ``mid``."""
    return F.pmod(F.xxhash64("mid"), F.lit(buckets)).cast("int")


def known_visits(spark: SparkSession, state_dir: str, before: int, devices: DataFrame | None = None) -> DataFrame:
    """Devices' first visits set by batches before ``before``, one row each.

    With ``devices`` (a column ``mid``) only the buckets that hold one of them
    are read from the snapshot, so that what a small batch reads depends on its
    own devices and on the batches since the snapshot, not on all known."""
    marks = f"{state_dir}/visit_snapshot_done"
    upto = _snapshot_upto(spark, marks, before)
    tail = (_read_batches(spark, f"{state_dir}/visits", VISIT_SCHEMA)
            .where((F.col("batch") > F.lit(upto)) & (F.col("batch") < F.lit(before))).drop("batch"))
    if upto < 0:
        return tail
    snapshot = f"{state_dir}/visit_snapshot/upto={upto}"
    # a snapshot of an older release has no buckets
    buckets = spark.read.schema("buckets int").parquet(f"{marks}/upto={upto}").first()["buckets"] or 1
    if devices is None or buckets == 1:
        return spark.read.schema(VISIT_SCHEMA).parquet(snapshot).select("mid", "first_visit").unionByName(tail)
    touched = [r[0] for r in devices.where("mid is not null").select(visit_bucket(buckets)).distinct().collect()]
    return (_read_table(spark, snapshot, f"{VISIT_SCHEMA}, bucket int").where(F.col("bucket").isin(touched))
            .drop("bucket").unionByName(tail))


def batch_visits(seen: DataFrame, known: DataFrame) -> DataFrame:
    """State of the devices of a batch, from its own ``first_visits``: (mid,
    first_visit, rows, fresh); what was set before stays, ``fresh`` devices are
    set by this batch. Of the known devices only the batch's cross a shuffle."""
    met = (known.join(seen.select("mid"), "mid", "left_semi")
           .select("mid", F.col("first_visit").alias("set_before")))
    return seen.join(met, "mid", "left").select(
        "mid", F.coalesce("set_before", "first_visit").alias("first_visit"), "rows",
        F.col("set_before").isNull().alias("fresh"))


#: Topics whose records a batch of the log job counts.
TOPICS = (K.TOPIC_PAGE, K.TOPIC_START, K.TOPIC_DISPLAY, K.TOPIC_ACTION, K.TOPIC_ERR, K.TOPIC_DIRTY)


def committed_topics(spark: SparkSession, sink_path: str, state_dir: str, fmt: str = "parquet") -> DataFrame:
    """The file topic sink as of its last completed batch."""
    return read_topics(spark, sink_path, fmt).where(F.col("batch") <= F.lit(committed(spark, state_dir)))


def log_batch_writer(sink_path: str | None, state_dir: str, fmt: str = "parquet", options: dict | None = None,
                     compact_every: int | None = 50, keep_batches: int | None = None,
                     bucket_devices: int = BUCKET_DEVICES, **route_opts):
    """foreachBatch body of the log job: (seq, value) lines -> topics.

    The batch is parsed once and kept; its devices' first visits are a
    partial aggregation, met by the state that earlier batches set, and the
    lines are repaired and fanned out as in the batch job, hot devices salted
    and dirty lines spread. Devices new in a batch go to
    ``visits/batch=<id>`` before the topics are written. Both are addressed by
    batch id and a batch reads only the state of batches before it, so a
    replayed batch gives what it gave before. Every ``compact_every`` batches
    the state is rewritten as one table in buckets of about ``bucket_devices``
    devices, of which a batch reads those of its own devices. Last comes the batch's mark with the
    records written to each topic; ``committed_topics`` reads marked batches.
    With ``keep_batches`` each snapshot is followed by deleting the state that
    the last so many batches do not need; without, all of it stays.
    """
    keep_state = _state_keeper(state_dir, compact_every, keep_batches, bucket_devices)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with _repaired(batch, batch_id, state_dir) as repaired:
            written = Observation()
            write_topics_batch(L.route(repaired, **route_opts).observe(
                written, *[F.count_if(F.col("topic") == t).alias(t) for t in TOPICS]), sink_path, batch_id, fmt, options)
            _mark_done(spark, state_dir, batch_id, written.get)
        keep_state(spark, batch_id)
    return write


@contextmanager
def _repaired(batch: DataFrame, batch_id: int, state_dir: str):
    """The batch's tagged lines with repaired flags. On entry the batch is
    parsed and kept, and its new devices are written to ``visits/batch=<id>``."""
    tagged = L.tag_lines(batch).persist()
    seen = L.first_visits(tagged).persist()
    visits = batch_visits(seen, known_visits(batch.sparkSession, state_dir, batch_id, seen)).persist()
    try:
        (visits.where("fresh").select("mid", "first_visit").write.mode("overwrite")
         .parquet(f"{state_dir}/visits/batch={batch_id}"))
        yield L.repair_flags(tagged, visits=visits.drop("fresh"))
    finally:
        visits.unpersist()
        seen.unpersist()
        tagged.unpersist()


def _state_keeper(state_dir: str, compact_every: int | None, keep_batches: int | None, bucket_devices: int):
    """What follows a batch's mark: every so many batches the state is compacted,
    and what is not needed then goes."""
    def keep_state(spark: SparkSession, batch_id: int) -> None:
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_visits(spark, state_dir, batch_id, bucket_devices)
            if keep_batches is not None:
                retire_visits(spark, state_dir, batch_id, keep_batches)
    return keep_state


FIXED_COLUMNS = ("seq", "mid", "is_new", "visit_day", "first_visit", "is_new_fixed", "dirty_reason")


def fixed_batch_writer(path: str, state_dir: str, compact_every: int | None = 50, keep_batches: int | None = None,
                       bucket_devices: int = BUCKET_DEVICES, columns: tuple[str, ...] = FIXED_COLUMNS):
    """foreachBatch body of flag repair alone: (seq, value) lines -> ``columns``
    of the repaired lines (``m``, the parsed line, may be one) in folders by
    batch id. State and marks are the log job's; hot devices are salted, and no
    Python runs on the lines."""
    keep_state = _state_keeper(state_dir, compact_every, keep_batches, bucket_devices)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with _repaired(batch, batch_id, state_dir) as repaired:
            written = Observation()
            (repaired.select(*columns).observe(written, F.count(F.lit(1)).alias("lines"))
             .write.mode("overwrite").parquet(f"{path}/batch={batch_id}"))
            _mark_done(spark, state_dir, batch_id, written.get)
        keep_state(spark, batch_id)
    return write


def retire_visits(spark: SparkSession, state_dir: str, batch_id: int, keep_batches: int) -> int:
    """Delete device state that no batch after ``batch_id - keep_batches`` reads;
    returns the snapshot that is the oldest now."""
    base = _base(spark, f"{state_dir}/visit_snapshot_done", batch_id, keep_batches)
    # a snapshot's mark goes before its rows
    for folder, column, below in (("visit_snapshot_done", "upto", base), ("visit_snapshot", "upto", base),
                                  ("visits", "batch", base + 1)):
        _retire(spark, f"{state_dir}/{folder}", column, below)
    return base


def compact_visits(spark: SparkSession, state_dir: str, through: int, bucket_devices: int = BUCKET_DEVICES) -> None:
    """Write the state set by batches up to ``through`` as one snapshot, a
    folder a bucket; one that is complete (a batch running again) is never
    written over. The number of buckets is the power of two, ``MAX_BUCKETS`` at
    most, that gives a bucket about ``bucket_devices``; the mark holds it."""
    marks = f"{state_dir}/visit_snapshot_done"
    if _snapshot_upto(spark, marks) >= through:
        return
    known, buckets = known_visits(spark, state_dir, through + 1), 1
    devices = known.count()             # from the files' footers
    while buckets < MAX_BUCKETS and buckets * bucket_devices < devices:
        buckets *= 2
    # one row a device, so buckets are even; sorted, so row groups are narrow
    bucketed = known.withColumn("bucket", visit_bucket(buckets))
    (bucketed.repartition("bucket").sortWithinPartitions("bucket", "mid").write.mode("overwrite").partitionBy("bucket")
     .parquet(f"{state_dir}/visit_snapshot/upto={through}"))
    _mark_snapshot(spark, marks, through, buckets)


def topic_sink(path: str, fmt: str = "parquet", options: dict | None = None):
    """foreachBatch writer for routed rows, addressed by batch id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_topics_batch(batch, path, batch_id, fmt, options)
    return write


HISTORY_SCHEMA = ("cseq long, op string, source_table string, sink_table string, "
                  "sink_columns string, sink_family string, sink_row_key string")
CONFIG_LOG_SCHEMA = HISTORY_SCHEMA + ", bad string, epoch long"
LOG_SCHEMA = ("seq long, sink_table string, sink_family string, type string, row_key string, "
              "cells map<string,string>, quarantine string, bad string, epoch long, phase int")

#: What becomes of the change lines of a batch; ``lines`` is the sum of the
#: others. ``filtered``: not of the database or of no type to keep;
#: ``unrouted``: no config for the table; ``quarantined``: cannot be applied.
COUNTS = ("lines", "malformed", "filtered", "unrouted", "quarantined", "puts", "deletes")
#: What becomes of its config lines.
CONFIG_COUNTS = ("config_lines", "config_malformed")


def _change_counts() -> list[F.Column]:
    held, fine = F.col("quarantine").isNotNull(), F.col("routed") & F.col("quarantine").isNull()
    gone = F.coalesce(F.col("type") == "delete", F.lit(False))
    of = {"malformed": F.col("malformed"), "filtered": ~F.col("malformed") & ~F.col("wanted"),
          "unrouted": F.col("wanted") & ~F.col("routed"), "quarantined": F.col("routed") & held,
          "puts": fine & ~gone, "deletes": fine & gone}
    return [F.count(F.lit(1)).alias("lines"), *[F.count_if(of[n]).alias(n) for n in COUNTS[1:]]]


def dim_batch_writer(state_dir: str, database: str = "gmall", compact_every: int | None = None,
                     order: str = "seq", on_malformed: str = "quarantine",
                     preload: DataFrame | None = None, recreate_on_update: bool = True,
                     namespace: str | None = None, buckets: int = T.BUCKETS, keep_batches: int | None = None):
    """foreachBatch body of the dimension job.

    Input rows: (seq, kind, value) with kind 'config' or 'change'. In order:
    (1) write the batch's config lines to the config log, (2) add them to the
    config state that the batch before left, (3) in one pass over the change
    lines parse them, route each to the config version in force at its seq,
    write puts, deletes and lines set aside to the change log, and count what
    became of every line, (4) write the batch's mark with these counts. All is
    addressed by batch id and overwritten on replay, and readers take marked
    batches only: a batch is visible whole or not at all.

    The config state is what routing needs: with ``order='arrival'`` the latest
    row of a source table, with ``order='seq'`` all its versions, as a change
    may come late. A batch without config lines leaves it where it is. The
    config log of earlier batches is not read (but for ``namespace``).
    With ``compact_every`` the folded state is snapshotted every that many
    batches, so reads fold a snapshot plus a bounded tail of the log, and with
    ``keep_batches`` the log and the snapshots that the last so many batches
    do not need are then deleted (``retire_dims``).

    ``order='seq'``: config and changes carry comparable seqs (one merged
    topic); each change uses the config version in force at its seq.
    ``order='arrival'``: separate topics whose offsets are not comparable;
    every change of a batch uses the config as it stands after the batch's
    config changes (what a broadcast-state job sees when config arrives
    first). The logs then carry (batch, config before change) as ``epoch``
    and ``phase``, and folds order by these before the topic's own seq.

    Lines that are no change or no config envelope are kept in the logs as they
    came (``read_quarantine_log``); ``on_malformed='fail'`` stops the job at
    the first batch with one instead, before its mark. ``preload`` is a config
    snapshot (one row a source table) in force before the stream's own config
    changes.

    With ``namespace`` the sink tables are kept as tables of the catalog, one
    wide row per key (``sinktables``): the batch's config events become DDL,
    then the buckets that its changes touch are rewritten. These tables change
    one by one, before the mark.
    """
    if on_malformed not in ("quarantine", "fail"):
        raise ValueError(f"on_malformed: {on_malformed}")
    arrival = order == "arrival"

    def refuse(counts: dict, name: str, batch_id: int) -> None:
        if on_malformed == "fail" and counts[name]:
            raise ValueError(f"malformed lines in batch {batch_id}: {counts[name]}, kept in the logs of {state_dir}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        epoch = F.lit(batch_id if arrival else 0).cast("long")
        own, seen = f"{state_dir}/config_log/batch={batch_id}", Observation()
        (CF.parse_configs(batch.where(F.col("kind") == "config")).withColumn("epoch", epoch)
         .observe(seen, F.count(F.lit(1)).alias("config_lines"), F.count_if(F.col("bad").isNotNull()).alias("config_malformed"))
         .write.mode("overwrite").parquet(own))
        lines, counts = spark.read.schema(CONFIG_LOG_SCHEMA).parquet(own), dict(seen.get)
        refuse(counts, "config_malformed", batch_id)
        config, at = carried_config(spark, state_dir, batch_id)
        if at is None or counts["config_lines"] > counts["config_malformed"]:
            config = config.unionByName(lines.where("bad is null").drop("bad", "epoch"))
            at = _write_config(config_latest(config) if arrival else config, state_dir, batch_id)
            config = spark.read.schema(HISTORY_SCHEMA).parquet(f"{state_dir}/config_state/batch={batch_id}")

        # what the log needs of the lines, parsed once: the as-of join may read them three times
        parsed = CH.parse_changes(batch.where(F.col("kind") == "change")).withColumn("wanted", CH.wanted(database))
        parsed = parsed.select("seq", "type", "malformed", "bad", "wanted",
                               *[F.when(F.col("wanted"), F.col(c)).alias(c) for c in ("table", "data")]).persist()
        try:
            if arrival:
                routed = CF.route_static(parsed, CF.config_current(CF.with_preload(config, preload)), keep_unrouted=True)
            else:
                routed = CF.route_asof(parsed, CF.config_versions(config, preload), keep_unrouted=True)
            seen = Observation()
            log = D.change_log(routed, ("bad", "malformed", "wanted", "routed")).observe(seen, *_change_counts())
            (log.where("routed or malformed")
             .withColumns({"quarantine": F.when(F.col("malformed"), F.lit("malformed")).otherwise(F.col("quarantine")),
                           "epoch": epoch, "phase": F.lit(int(arrival))})
             .drop("malformed", "wanted", "routed").write.mode("overwrite").parquet(f"{state_dir}/change_log/batch={batch_id}"))
        finally:
            parsed.unpersist()
        counts.update(seen.get)
        refuse(counts, "malformed", batch_id)
        if namespace:
            _write_tables(spark, state_dir, namespace, batch_id, preload, recreate_on_update, buckets)
        _mark_done(spark, state_dir, batch_id, {**counts, "config_batch": at})
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_dims(spark, state_dir, batch_id, recreate_on_update)
            if keep_batches is not None:
                retire_dims(spark, state_dir, batch_id, keep_batches)
    return write


def retire_dims(spark: SparkSession, state_dir: str, batch_id: int, keep_batches: int) -> int:
    """Delete the change log, snapshots and config states that no read as of
    the last ``keep_batches`` batches needs; returns the snapshot that is the
    oldest now. Changes set aside are written to ``set_aside`` first and stay,
    as do the config log and the batches' marks."""
    base = _base(spark, f"{state_dir}/snapshot_done", batch_id, keep_batches)
    if base < 0:
        return base
    if _snapshot_upto(spark, f"{state_dir}/set_aside_done") < base:
        _set_aside(spark, state_dir, base).write.mode("overwrite").parquet(f"{state_dir}/set_aside/upto={base}")
        _mark_snapshot(spark, f"{state_dir}/set_aside_done", base)
    used = _read_table(spark, f"{state_dir}/done/batch={base}", "config_batch long").first()
    for folder, column, below in (("snapshot_done", "upto", base), ("snapshot", "upto", base), ("change_log", "batch", base + 1),
                                  ("set_aside_done", "upto", base), ("set_aside", "upto", base),
                                  ("config_state", "batch", used["config_batch"] if used else 0)):
        _retire(spark, f"{state_dir}/{folder}", column, below)
    return base


def _set_aside(spark: SparkSession, state_dir: str, through: int) -> DataFrame:
    """Changes that were not applied, of the batches up to ``through``, from
    the change log and from what was kept of batches whose log is deleted."""
    upto = _snapshot_upto(spark, f"{state_dir}/set_aside_done", through + 1)
    log = read_change_log(spark, state_dir, with_batch=True, through=through).where((F.col("batch") > F.lit(upto)) & F.col("quarantine").isNotNull())
    if upto < 0:
        return log
    return spark.read.schema(LOG_SCHEMA + ", batch long").parquet(f"{state_dir}/set_aside/upto={upto}").unionByName(log)


def read_set_aside(spark: SparkSession, state_dir: str) -> DataFrame:
    """Changes that were not applied, malformed lines among them, with the
    reason (``quarantine``) and their batch."""
    return _set_aside(spark, state_dir, committed(spark, state_dir))


def carried_config(spark: SparkSession, state_dir: str, before: int) -> tuple[DataFrame, int | None]:
    """Config rows that the batches before ``before`` left, and the batch that
    wrote them; that is None where the batch before left no state (the first
    batch, or one of a job that kept the log alone, which is then read)."""
    if before > 0:
        # the one folder: marks of all batches are not listed
        mark = _read_table(spark, f"{state_dir}/done/batch={before - 1}", "config_batch long").first()
        if mark is not None and mark["config_batch"] is not None:
            at = int(mark["config_batch"])
            return spark.read.schema(HISTORY_SCHEMA).parquet(f"{state_dir}/config_state/batch={at}"), at
    return read_config_log(spark, state_dir, through=before - 1).drop("epoch"), None


def config_latest(history: DataFrame) -> DataFrame:
    """The last row per source table, deletes among them."""
    row = F.struct(*[c.split()[0] for c in HISTORY_SCHEMA.split(", ")])
    return history.groupBy("source_table").agg(F.max_by(row, "cseq").alias("v")).select("v.*")


def _write_config(config: DataFrame, state_dir: str, batch_id: int) -> int:
    (config.select(*[c.split()[0] for c in HISTORY_SCHEMA.split(", ")]).coalesce(1).write.mode("overwrite")
     .parquet(f"{state_dir}/config_state/batch={batch_id}"))
    return batch_id


def _write_tables(spark: SparkSession, state_dir: str, namespace: str, batch_id: int, preload: DataFrame | None,
                  recreate_on_update: bool, buckets: int) -> None:
    """DDL of the config log up to the batch, and the rows that it touches."""
    history = _ordered_history(spark, state_dir, preload, through=batch_id)
    tables = T.apply_tables(spark, namespace, f"{state_dir}/tables", T.wanted_tables(history, recreate_on_update))
    touched = (read_change_log(spark, state_dir, with_batch=True, through=batch_id)
               .where((F.col("batch") == batch_id) & F.col("quarantine").isNull()).select("sink_table", "row_key"))
    current = dim_current_from_logs(spark, state_dir, through=batch_id, recreate_on_update=recreate_on_update)
    T.write_rows(spark, namespace, tables, current, touched, buckets)


def _visible(spark: SparkSession, state_dir: str, through: int | None) -> int:
    return committed(spark, state_dir) if through is None else through


def _config_lines(spark: SparkSession, state_dir: str, through: int | None) -> DataFrame:
    return (_read_batches(spark, f"{state_dir}/config_log", CONFIG_LOG_SCHEMA)
            .where(F.col("batch") <= F.lit(_visible(spark, state_dir, through))).drop("batch"))


def read_config_log(spark: SparkSession, state_dir: str, through: int | None = None) -> DataFrame:
    """Config changes of the completed batches, or of those up to ``through``."""
    return _config_lines(spark, state_dir, through).where("bad is null").drop("bad")


def read_change_log(spark: SparkSession, state_dir: str, with_batch: bool = False, through: int | None = None) -> DataFrame:
    """Changes of the completed batches, or of those up to ``through``."""
    df = (_read_batches(spark, f"{state_dir}/change_log", LOG_SCHEMA)
          .where(F.col("batch") <= F.lit(_visible(spark, state_dir, through))))
    return df if with_batch else df.drop("batch")


ORDER_TYPE = "struct<epoch:bigint,phase:int,seq:bigint>"
SNAPSHOT_SCHEMA = f"sink_table string, row_key string, col string, value string, seq {ORDER_TYPE}"


def _order(seq: str, phase) -> F.Column:
    return F.struct(F.coalesce("epoch", F.lit(0).cast("long")).alias("epoch"),
                    F.coalesce(phase, F.lit(0)).cast("int").alias("phase"), F.col(seq).alias("seq"))


def read_quarantine_log(spark: SparkSession, state_dir: str) -> DataFrame:
    """Lines set aside by the stream as they came: (seq, kind, value)."""
    through = committed(spark, state_dir)
    changes = _set_aside(spark, state_dir, through).where("bad is not null")
    configs = _config_lines(spark, state_dir, through).where("bad is not null")
    return (changes.select("seq", F.lit("change").alias("kind"), F.col("bad").alias("value"))
            .unionByName(configs.select(F.col("cseq").alias("seq"), F.lit("config").alias("kind"), F.col("bad").alias("value"))))


def _latest_snapshot(spark: SparkSession, state_dir: str, below: int | None = None):
    """(row log, last batch id) of the newest complete snapshot (of batches
    before ``below``), or (None, -1)."""
    upto = _snapshot_upto(spark, f"{state_dir}/snapshot_done", below)
    if upto < 0:
        return None, -1
    return spark.read.schema(SNAPSHOT_SCHEMA).parquet(f"{state_dir}/snapshot/upto={upto}"), upto


def _fold_inputs(spark: SparkSession, state_dir: str, through: int | None, recreate_on_update: bool):
    """(row log, table drops): the newest snapshot plus only the log batches
    written after it (up to ``through`` when given)."""
    through = _visible(spark, state_dir, through)
    snap, upto = _latest_snapshot(spark, state_dir, through + 1)
    log = read_change_log(spark, state_dir, with_batch=True, through=through).where(F.col("batch") > F.lit(upto))
    rows = D.row_log(log.withColumn("seq", _order("seq", F.col("phase"))))
    history = read_config_log(spark, state_dir, through).withColumn("cseq", _order("cseq", F.lit(0)))
    if snap is not None:
        rows = rows.unionByName(snap)
    return rows, D.table_drops(history, recreate_on_update)


def dim_current_from_logs(spark: SparkSession, state_dir: str, keep_seq: bool = False,
                          through: int | None = None, recreate_on_update: bool = True) -> DataFrame:
    """Fold the logs written by the stream into current cells."""
    return D.fold_rows(*_fold_inputs(spark, state_dir, through, recreate_on_update), keep_seq=keep_seq)


def sink_tables_from_logs(spark: SparkSession, state_dir: str, preload: DataFrame | None = None,
                          recreate_on_update: bool = True) -> DataFrame:
    """The table registry of the stream: tables that exist after its config log."""
    return D.sink_tables(_ordered_history(spark, state_dir, preload), recreate_on_update)


def _ordered_history(spark: SparkSession, state_dir: str, preload: DataFrame | None = None,
                     through: int | None = None) -> DataFrame:
    """The config log (up to a batch) with its order key, a preload first."""
    history = read_config_log(spark, state_dir, through).withColumn("cseq", _order("cseq", F.lit(0)))
    if preload is not None:
        first = F.struct(F.lit(-1).cast("long").alias("epoch"), F.lit(0).alias("phase"),
                         F.lit(CF.PRELOAD_SEQ).cast("long").alias("seq"))
        history = history.unionByName(preload.select(first.alias("cseq"), F.lit("r").alias("op"), *CF.CONFIG_FIELDS),
                                      allowMissingColumns=True)
    return history


def compact_dims(spark: SparkSession, state_dir: str, through: int | None = None,
                 recreate_on_update: bool = True) -> int:
    """Write the folded state (each cell and each row's last delete with its
    order key) as ``snapshot/upto=<batch>`` and return that batch id; later
    folds read it plus newer batches only. The deletes stay, so a put that
    arrives late finds the row deleted all the same; table drops are read from
    the config log. Run between micro-batches or as a separate job; a snapshot
    is written once and never modified."""
    if through is None:
        through = committed(spark, state_dir)
        if through < 0:
            return -1
    if _latest_snapshot(spark, state_dir)[1] >= through:
        return through
    # pinned to the batches seen now: a batch the stream commits meanwhile
    # stays outside this snapshot and is folded in by later reads
    rows, drops = _fold_inputs(spark, state_dir, through, recreate_on_update)
    D.fold_rows(rows, drops, keep_seq=True, keep_deletes=True).write.mode("overwrite").parquet(
        f"{state_dir}/snapshot/upto={through}")
    _mark_snapshot(spark, f"{state_dir}/snapshot_done", through)
    return through
