"""Runnable jobs: the log job and the dimension job as long-running streams.

    python -m rivulet.streaming.apps log --source-format kafka \\
        --option kafka.bootstrap.servers=host:9092 --sink-format kafka ...
    python -m rivulet.streaming.apps dim --source-format parquet --source-path ...

Each job: one source -> transform -> sink query with its own checkpoint
folder (under ``spark.checkpoint.dir`` unless given), a processing-time
trigger (5 s by default, the reproduced jobs' checkpoint interval) and a
fixed number of state partitions (the jobs' parallelism).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet import constants as K
from rivulet.session import checkpoint_root, parallelism
from rivulet.sources.hybrid import FORMAT as HYBRID, read_snapshot_then_changes
from rivulet.sources.tables import read_config_table
from rivulet.sources.topics import ORDERS, read_topic
from rivulet.streaming import jobs as J


def _ck(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return checkpoint or f"{checkpoint_root(spark)}/rivulet/jobs/{name}"


def start_log_app(spark: SparkSession, *, source_format: str = "kafka", source_path: str | None = None,
                  source_options: dict | None = None, sink_format: str = "parquet",
                  sink_path: str | None = None, sink_options: dict | None = None,
                  checkpoint: str | None = None, trigger: str = J.DEFAULT_TRIGGER,
                  parallelism_: int | None = None, available_now: bool = False,
                  state_dir: str | None = None, keep_batches: int | None = None,
                  bucket_devices: int = J.BUCKET_DEVICES, record_order: str = "seq",
                  name: str = "dwd_base_log") -> StreamingQuery:
    """Log topic -> dirty split, flag repair, fan-out -> one topic sink.
    Devices' first visits are kept in ``state_dir`` (beside the checkpoint).
    With ``record_order='time'`` a batch's lines are ordered by record time
    across partitions, and file sinks carry that order as ``seq``."""
    lines = read_topic(spark, K.TOPIC_LOG, fmt=source_format, path=source_path,
                       options=source_options, order=record_order)
    ck = _ck(spark, name, checkpoint)
    write = J.log_batch_writer(sink_path, state_dir or f"{ck}-state", sink_format, sink_options,
                               keep_batches=keep_batches, bucket_devices=bucket_devices)
    return J.run_stream(lines, ck, foreach_batch=write, available_now=available_now,
                        processing_time=trigger, name=name,
                        state_partitions=parallelism_ or parallelism(spark))


def start_dim_app(spark: SparkSession, *, state_dir: str, source_format: str = "kafka",
                  source_path: str | None = None, source_options: dict | None = None,
                  config_path: str | None = None, config_options: dict | None = None,
                  checkpoint: str | None = None, trigger: str = J.DEFAULT_TRIGGER,
                  compact_every: int | None = 100, database: str = K.DEFAULT_DATABASE,
                  order: str = "arrival", on_malformed: str = "quarantine",
                  preload: DataFrame | None = None, recreate_on_update: bool = True,
                  config_format: str | None = None, namespace: str | None = None,
                  keep_batches: int | None = None, available_now: bool = False, name: str = "dim_app") -> StreamingQuery:
    """Change topic + config change stream -> routed cell log (+ snapshots).

    Both inputs are read as one stream (tagged by kind) so one query owns the
    order between config and data; ``config_path``/``config_options`` name
    the config change source, which uses ``source_format`` as well unless
    ``config_format`` says otherwise: ``snapshot_then_changes`` reads the
    config table first and then its changes, in one source (``sources.hybrid``).
    ``namespace`` keeps the sink tables in the catalog.
    ``order='arrival'`` (default for two topics) routes each batch's changes
    with the config after that batch's config changes; ``order='seq'`` when
    both carry comparable seqs (see ``dim_batch_writer``). Config is read from
    its earliest offset unless ``config_options`` say otherwise; ``preload``
    (``tables.read_config_table``) is in force before it."""
    changes = read_topic(spark, K.TOPIC_DB, fmt=source_format, path=source_path,
                         options=source_options).withColumn("kind", F.lit("change"))
    ck, config_format = _ck(spark, name, checkpoint), config_format or source_format
    if config_format == HYBRID:
        config = read_snapshot_then_changes(spark, {"progressPath": f"{ck}-progress", **(config_options or {})})
    else:
        start = {"startingOffsets": "earliest"} if config_format == "kafka" else {}
        config = read_topic(spark, "config", fmt=config_format, path=config_path, options={**start, **(config_options or {})})
    both = changes.unionByName(config.withColumn("kind", F.lit("config")))
    return J.run_stream(both, ck,
                        foreach_batch=J.dim_batch_writer(state_dir, database, compact_every, order, on_malformed, preload,
                                                         recreate_on_update, namespace, keep_batches=keep_batches),
                        available_now=available_now, processing_time=trigger, name=name)


def _opts(pairs: list[str] | None) -> dict:
    return dict(p.split("=", 1) for p in (pairs or []))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="rivulet")
    ap.add_argument("job", choices=["log", "dim"])
    ap.add_argument("--source-format", default="kafka")
    ap.add_argument("--source-path")
    ap.add_argument("--option", action="append", help="source option key=value")
    ap.add_argument("--config-path")
    ap.add_argument("--config-option", action="append")
    ap.add_argument("--config-format", help="default: as the source; snapshot_then_changes reads the table first")
    ap.add_argument("--order", choices=["arrival", "seq"], default="arrival")
    ap.add_argument("--on-malformed", choices=["quarantine", "fail"], default="quarantine")
    ap.add_argument("--keep-on-update", action="store_true", help="a config update keeps the table's rows")
    ap.add_argument("--preload-format", help="config snapshot in force before the stream: parquet, jdbc, ..")
    ap.add_argument("--preload-path")
    ap.add_argument("--preload-option", action="append", help="e.g. url=jdbc:..., dbtable=...")
    ap.add_argument("--database", default=K.DEFAULT_DATABASE)
    ap.add_argument("--compact-every", type=int, default=100)
    ap.add_argument("--keep-batches", type=int, help="after a snapshot, delete state that the last so many batches do not need")
    ap.add_argument("--bucket-devices", type=int, default=J.BUCKET_DEVICES, help="log job: devices in a bucket of the state")
    ap.add_argument("--record-order", choices=ORDERS, default="seq", help="log job: order of a topic's records")
    ap.add_argument("--namespace", help="keep the sink tables in this database of the catalog")
    ap.add_argument("--sink-format", default="parquet")
    ap.add_argument("--sink-path")
    ap.add_argument("--sink-option", action="append")
    ap.add_argument("--state-dir")
    ap.add_argument("--checkpoint")
    ap.add_argument("--trigger", default=J.DEFAULT_TRIGGER)
    ap.add_argument("--parallelism", type=int)
    ap.add_argument("--available-now", action="store_true")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"rivulet-{a.job}").getOrCreate()
    if a.job == "log":
        q = start_log_app(spark, source_format=a.source_format, source_path=a.source_path,
                          source_options=_opts(a.option), sink_format=a.sink_format,
                          sink_path=a.sink_path, sink_options=_opts(a.sink_option),
                          checkpoint=a.checkpoint, state_dir=a.state_dir, trigger=a.trigger,
                          parallelism_=a.parallelism, available_now=a.available_now, keep_batches=a.keep_batches,
                          bucket_devices=a.bucket_devices, record_order=a.record_order)
    else:
        preload = None
        if a.preload_format or a.preload_path:
            preload = read_config_table(spark, a.preload_path, a.preload_format or "parquet", _opts(a.preload_option))
        q = start_dim_app(spark, state_dir=a.state_dir or f"{checkpoint_root(spark)}/rivulet/dim_state",
                          source_format=a.source_format, source_path=a.source_path,
                          source_options=_opts(a.option), config_path=a.config_path,
                          config_options=_opts(a.config_option), checkpoint=a.checkpoint,
                          trigger=a.trigger, available_now=a.available_now, config_format=a.config_format,
                          order=a.order, on_malformed=a.on_malformed, recreate_on_update=not a.keep_on_update,
                          preload=preload, database=a.database, compact_every=a.compact_every, namespace=a.namespace,
                          keep_batches=a.keep_batches)
    q.awaitTermination()


if __name__ == "__main__":
    main()
