"""Topic sources and sinks: value-only string records.

Production reads and writes Kafka (``format='kafka'``); offline and in tests
the same records live in files of ``(seq, value)``. Every reader returns
``(seq, value STRING)``: ``seq`` is the arrival order used to break ties and to
order a device's lines. By default it is a BIGINT (for Kafka: ``topic_seq``,
which orders records within a partition, the only order Kafka defines, and puts
whole partitions one after the other). With ``order='time'`` it is
``record_order``, a struct of (record time, partition, offset), by which
partitions interleave; everything that orders by ``seq`` (first visits, the
as-of join, the fold of cells) takes either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# What one micro-batch takes at most, unless the caller says otherwise.
DEFAULT_OFFSETS_PER_TRIGGER = 10_000_000
DEFAULT_FILES_PER_TRIGGER = 1_000

LINE_SCHEMA = "seq long, value string"
#: Files of records that say where in their topic they stood.
RECORD_SCHEMA = "time timestamp, partition int, offset long, value string"
ORDERS = ("seq", "time")


def topic_seq(partition: Column, offset: Column) -> Column:
    """One 64-bit order key of a topic record; partitions do not interleave."""
    return F.shiftleft(partition.cast("long"), 48).bitwiseOR(offset.cast("long"))


def record_order(time: Column, partition: Column, offset: Column) -> Column:
    """Order key of a topic record across partitions: its time, then partition
    and offset, which no two records share. Times are the topic's (set by the
    broker or by the sender, as the topic is configured)."""
    return F.struct(time.cast("timestamp").alias("time"), partition.cast("int").alias("partition"),
                    offset.cast("long").alias("offset"))


def read_topic(spark: SparkSession, topic: str | None = None, fmt: str = "parquet",
               path: str | None = None, stream: bool = True, options: dict | None = None,
               max_files_per_trigger: int | None = None, order: str = "seq") -> DataFrame:
    """A topic as (seq, value), ``seq`` by ``order`` (files hold it, or for
    'time' the columns of ``RECORD_SCHEMA``). Kafka starts at the query's
    committed offsets (its checkpoint), else at ``latest``, and is never-ending."""
    if order not in ORDERS:
        raise ValueError(f"order: {order}")
    opts = dict(options or {})
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        opts.setdefault("subscribe", topic)
        if stream:
            opts.setdefault("startingOffsets", "latest")
            opts.setdefault("maxOffsetsPerTrigger", str(DEFAULT_OFFSETS_PER_TRIGGER))
        df = reader.format("kafka").options(**opts).load()
        if order == "time":
            return df.select(record_order(F.col("timestamp"), F.col("partition"), F.col("offset")).alias("seq"),
                             F.col("value").cast("string").alias("value"))
        # no two records share a seq: 48 bits of offset below the partition
        wide = F.assert_true((F.col("offset") < 1 << 48) & (F.col("partition") < 1 << 15), "topic too wide for seq")
        return df.where(wide.isNull()).select(topic_seq(F.col("partition"), F.col("offset")).alias("seq"),
                         F.col("value").cast("string").alias("value"))
    if stream:
        opts.setdefault("maxFilesPerTrigger", str(max_files_per_trigger or DEFAULT_FILES_PER_TRIGGER))
    if order == "time":
        df = reader.schema(RECORD_SCHEMA).format(fmt).options(**opts).load(path)
        return df.select(record_order(F.col("time"), F.col("partition"), F.col("offset")).alias("seq"), "value")
    df = reader.schema(LINE_SCHEMA).format(fmt).options(**opts).load(path)
    return df.select("seq", "value")


def land_lines(lines: DataFrame, path: str, pieces: int = 3, files_per_piece: int | None = None) -> int:
    """Write (seq, value) lines as ``pieces`` appends in seq order, each as
    ``files_per_piece`` files, so a file source read with
    ``maxFilesPerTrigger=files_per_piece`` replays them as ``pieces``
    micro-batches in arrival order, each processed by that many tasks.
    Returns ``files_per_piece``."""
    spark = lines.sparkSession
    from rivulet.session import parallelism
    files = files_per_piece or parallelism(spark)
    bounds = lines.select(F.min("seq").alias("lo"), F.max("seq").alias("hi")).first()
    if bounds["lo"] is None:          # nothing to land
        return files
    lo, hi = int(bounds["lo"]), int(bounds["hi"])
    step = (hi - lo) // pieces + 1
    for k in range(pieces):
        a, b = lo + k * step, lo + (k + 1) * step
        (lines.where((F.col("seq") >= a) & (F.col("seq") < b)).repartition(files)
              .write.mode("append").parquet(path))
    return files


def write_topics_batch(routed: DataFrame, path: str, batch_id: int | None = None,
                       fmt: str = "parquet", options: dict | None = None) -> None:
    """Write (topic, value [, seq, pos]) rows: Kafka takes the ``topic`` column
    itself (one writer for all topics); files go to ``topic=<name>`` folders,
    under ``batch=<id>`` when called per micro-batch so a replayed batch
    overwrites its own output instead of duplicating it."""
    if fmt == "kafka":
        routed.select("topic", "value").write.format("kafka").options(**(options or {})).save()
        return
    target = path if batch_id is None else f"{path}/batch={batch_id}"
    routed.write.mode("overwrite").partitionBy("topic").format(fmt).save(target)


def read_topics(spark: SparkSession, path: str, fmt: str = "parquet", seq_type: str = "long") -> DataFrame:
    """Read back a file topic sink: (batch, topic, seq, pos, value)."""
    return (spark.read.schema(f"seq {seq_type}, pos int, value string, batch long, topic string")
            .format(fmt).load(path))
