"""Routing configuration: CDC images, current state, versions and the as-of
join of change records to the configuration in force at their ``seq``.

The configuration is a control table (one row per routed source table plus
its history). While it is small and no table has many versions (both checked)
it is joined by broadcast; beyond that changes and versions are merged in seq
order within (table, seq bucket), which costs a sort however many versions a
table has, and splits a hot table over its buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DataType, StructType

from rivulet.functions.jsonmap import parse_one, seal

CONFIG_FIELDS = ("source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key")
IMAGE_TYPE = "struct<" + ",".join(f"{c}:string" for c in CONFIG_FIELDS) + ">"
ENVELOPE_TYPE = f"struct<op:string,before:{IMAGE_TYPE},after:{IMAGE_TYPE}>"

# Broadcast config rows only up to this many bytes of text.
DEFAULT_MAX_BROADCAST_BYTES = 32 << 20
# A broadcast lookup tests every version of a change's table: up to this many.
DEFAULT_MAX_LOOKUP_VERSIONS = 64
# Seqs per bucket of the merge; a seq names one record, so this bounds a bucket.
BUCKET_BITS = 20
# Microseconds (as bits) per bucket where records are ordered by their time.
BUCKET_TIME_BITS = 24

PRELOAD_SEQ = -(2 ** 62)
#: Microseconds at the first day that a timestamp can hold.
FIRST_MICROS = -62135596800000000


def _before_all(kind: DataType) -> F.Column:
    """An order key before those of all records: of a number, or of a record's
    (time, partition, offset)."""
    return _opening(F.lit(FIRST_MICROS)) if isinstance(kind, StructType) else F.lit(PRELOAD_SEQ).cast("long")


def _opening(micros: F.Column) -> F.Column:
    """The order key before those of all records from ``micros`` on."""
    return F.struct(F.timestamp_micros(micros).alias("time"), F.lit(-1).cast("int").alias("partition"),
                    F.lit(-1).cast("long").alias("offset"))


def _buckets(kind: DataType) -> tuple[F.Column, F.Column]:
    """The merge bucket of the order key ``_s``, and the key that opens bucket ``_b``."""
    if isinstance(kind, StructType):
        return (F.shiftright(F.unix_micros("_s.time"), BUCKET_TIME_BITS),
                _opening(F.shiftleft("_b", BUCKET_TIME_BITS)))
    return F.shiftright(F.col("_s"), BUCKET_BITS), F.shiftleft("_b", BUCKET_BITS)


def is_delete(op: str = "op") -> F.Column:
    """Only ``d`` deletes; an envelope without ``op`` is a change like any other."""
    return F.col(op).eqNullSafe(F.lit("d"))


def parse_configs(cdc: DataFrame, seq: str = "seq", value: str = "value") -> DataFrame:
    """``{op, before, after}`` envelopes -> (cseq, op, <config fields>, bad):
    ``d`` takes the ``before`` image, every other op the ``after`` image.
    ``bad`` is the line where it is no envelope with that image, else NULL."""
    e = cdc.select(F.col(seq).alias("cseq"), F.col(value).alias("line"), parse_one(F.col(value), ENVELOPE_TYPE).alias("e"))
    img = F.when(is_delete("e.op"), F.col("e.before")).otherwise(F.col("e.after"))
    e = seal(e.select("cseq", F.col("e.op").alias("op"), img.alias("img"), "line"))
    return e.select("cseq", "op", *[F.col(f"img.{c}").alias(c) for c in CONFIG_FIELDS],
                    F.when(F.col("img").isNull(), F.coalesce("line", F.lit(""))).alias("bad"))


def config_images(cdc: DataFrame, seq: str = "seq", value: str = "value") -> DataFrame:
    """The good envelopes of ``parse_configs``: (cseq, op, <config fields>)."""
    return parse_configs(cdc, seq, value).where(F.col("bad").isNull()).drop("bad")


def rename_to_camel(df: DataFrame) -> DataFrame:
    """snake_case -> lowerCamelCase column names (``source_table`` -> ``sourceTable``)."""
    def camel(name: str) -> str:
        head, *rest = name.split("_")
        return head + "".join(p[:1].upper() + p[1:] for p in rest)
    return df.toDF(*[camel(c) for c in df.columns])


def config_current(history: DataFrame) -> DataFrame:
    """Latest config row per source table; deleted tables drop out.
    A grouped max_by: partial aggregation, no window over a hot key."""
    latest = (history.groupBy("source_table")
              .agg(F.max_by(F.struct("cseq", "op", *CONFIG_FIELDS[1:]), "cseq").alias("v")))
    return (latest.where(~is_delete("v.op"))
            .select("source_table", *[F.col(f"v.{c}").alias(c) for c in ("cseq",) + CONFIG_FIELDS[1:]]))


def with_preload(history: DataFrame, preload: DataFrame | None) -> DataFrame:
    """Config history with the rows of a snapshot before all of it."""
    h = history.select("cseq", "op", *CONFIG_FIELDS)
    if preload is None:
        return h
    return preload.select(_before_all(h.schema["cseq"].dataType).alias("cseq"), F.lit("r").alias("op"),
                          *CONFIG_FIELDS).unionByName(h)


def config_versions(history: DataFrame, preload: DataFrame | None = None) -> DataFrame:
    """Validity intervals: (source_table, from_seq, to_seq, cseq, op, fields).

    ``cseq`` is a number or a record's (time, partition, offset), as the seq of
    the changes. A version is in force for change seqs in ``[from_seq, to_seq)``; config
    comes before data on equal seq. ``preload`` rows (a snapshot read before
    the stream starts) are versions from the start of time; the stream's own
    ops override them in order, a ``d`` included.
    """
    h = with_preload(history, preload)
    w = Window.partitionBy("source_table").orderBy("cseq")
    return h.select("*", F.col("cseq").alias("from_seq"),
                    F.lead("cseq").over(w).alias("to_seq"))


def _bytes() -> F.Column:
    return F.sum(F.octet_length(F.concat_ws("", "source_table", *CONFIG_FIELDS[1:])) + F.lit(64))


def route_asof(changes: DataFrame, versions: DataFrame, table: str = "table", seq: str = "seq",
               max_broadcast: int = DEFAULT_MAX_BROADCAST_BYTES,
               max_versions: int = DEFAULT_MAX_LOOKUP_VERSIONS, keep_unrouted: bool = False) -> DataFrame:
    """Inner as-of join: each change meets the config version in force at its
    seq; changes of unrouted or deleted tables drop out, or with
    ``keep_unrouted`` stay with NULL config fields; ``routed`` tells which."""
    size = (versions.groupBy("source_table").agg(F.count(F.lit(1)).alias("n"), _bytes().alias("b"))
            .agg(F.max("n").alias("n"), F.sum("b").alias("b")).first())
    if (size["n"] or 0) > max_versions or (size["b"] or 0) > max_broadcast:
        return _merge_asof(changes, versions, table, seq, keep_unrouted)
    v = versions.where(~is_delete()).select(
        F.col("source_table"), "from_seq", "to_seq", F.col("cseq"), *CONFIG_FIELDS[1:])
    cond = ((changes[table] == v["source_table"]) & (changes[seq] >= v["from_seq"])
            & (v["to_seq"].isNull() | (changes[seq] < v["to_seq"])))
    return _joined(changes, F.broadcast(v), cond, keep_unrouted).drop("from_seq", "to_seq")


def _joined(changes: DataFrame, config: DataFrame, cond: F.Column, keep_unrouted: bool) -> DataFrame:
    if not keep_unrouted:
        return changes.join(config, cond, "inner").drop("source_table")
    return changes.join(config, cond, "left").withColumn("routed", F.col("source_table").isNotNull()).drop("source_table")


def _merge_asof(changes: DataFrame, versions: DataFrame, table: str, seq: str, keep_unrouted: bool = False) -> DataFrame:
    """The as-of join as a merge: versions and changes sorted together within
    (table, seq bucket), the last version seen carried forward. A bucket opens
    with the version carried into it from the buckets before; that table holds
    one row per (table, bucket) with changes. ``changes`` is read twice, with
    ``keep_unrouted`` three times."""
    bucket, opening = _buckets(changes.schema[seq].dataType)
    v = (versions.where(F.col("to_seq").isNull() | (F.col("to_seq") > F.col("from_seq")))
         .select(F.col("source_table").alias("_t"), F.col("from_seq").alias("_s"),
                 F.struct("cseq", "op", *CONFIG_FIELDS[1:]).alias("_v"))
         .withColumn("_b", bucket))
    rows = (changes.where(F.col(table).isNotNull())
            .select(F.struct("*").alias("_row"), F.col(table).alias("_t"), F.col(seq).alias("_s"))
            .withColumn("_b", bucket))
    before = Window.partitionBy("_t").orderBy("_b").rangeBetween(Window.unboundedPreceding, -1)
    carried = (rows.select("_t", "_b").distinct()
               .unionByName(v.groupBy("_t", "_b").agg(F.max_by("_v", "_s").alias("_v")), allowMissingColumns=True)
               .select("_t", "_b", F.last("_v", ignorenulls=True).over(before).alias("_v"),
                       F.col("_v").isNull().alias("_wanted"))
               .where(F.col("_wanted") & F.col("_v").isNotNull())
               .select("_t", "_b", opening.alias("_s"), "_v"))
    merged = (rows.withColumn("_k", F.lit(2))
              .unionByName(v.withColumn("_k", F.lit(1)), allowMissingColumns=True)
              .unionByName(carried.withColumn("_k", F.lit(0)), allowMissingColumns=True))
    upto = Window.partitionBy("_t", "_b").orderBy("_s", "_k").rowsBetween(Window.unboundedPreceding, 0)
    met = merged.select("_row", "_k", F.last("_v", ignorenulls=True).over(upto).alias("_v")).where("_k = 2")
    routed, fields = F.col("_v").isNotNull() & ~is_delete("_v.op"), ("cseq",) + CONFIG_FIELDS[1:]
    if not keep_unrouted:
        return met.where(routed).select("_row.*", *[F.col(f"_v.{c}").alias(c) for c in fields])
    met = met.select("_row.*", *[F.when(routed, F.col(f"_v.{c}")).alias(c) for c in fields], routed.alias("routed"))
    nameless = changes.where(F.col(table).isNull()).withColumn("routed", F.lit(False))
    return met.unionByName(nameless, allowMissingColumns=True)


def route_static(changes: DataFrame, config: DataFrame, table: str = "table",
                 max_broadcast: int = DEFAULT_MAX_BROADCAST_BYTES, keep_unrouted: bool = False) -> DataFrame:
    """Inner equi-join to a fixed config. A source table listed twice counts
    once (the greater row), so no change is ever duplicated. ``keep_unrouted``
    as in ``route_asof``."""
    c = (config.groupBy("source_table").agg(F.max(F.struct(*CONFIG_FIELDS[1:])).alias("v"))
         .select("source_table", "v.*"))
    if (c.agg(_bytes()).first()[0] or 0) <= max_broadcast:
        c = F.broadcast(c)
    return _joined(changes, c, changes[table] == c["source_table"], keep_unrouted)
