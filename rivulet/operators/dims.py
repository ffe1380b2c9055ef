"""Dimension tables as an append-only cell log plus a fold.

A routed change becomes either a row delete or a put of its non-empty cells.
Config ops become table events: ``r``/``c`` create (a no-op when the table
exists), ``d`` drops, any other op drops and re-creates (emptying the table).

The current state of a cell (table, row key, column) is its last non-empty
value, provided that value was written after the row's last delete and not
before the table's last drop. Puts and deletes are one log (a delete is an
entry without a column), aggregated to its last entry per cell with map-side
partial combine; only these aggregated rows meet per row key, so a hot table
or hot row key never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rivulet.functions.jsonmap import seal
from rivulet.operators.changes import non_empty_cells, retain_listed

# Table drops are broadcast up to this many bytes.
DEFAULT_MAX_BROADCAST_BYTES = 16 << 20


def change_log(routed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """seq, sink_table, sink_family, type, row_key, cells, quarantine per change,
    and the columns named by ``keep``.

    ``cells`` are the retained, non-empty values (``type`` never among them).
    ``quarantine`` names why a change cannot be applied; the reproduced job
    fails on each of these, we keep the change aside instead:
    ``no_data`` (routed change without a data object), ``no_row_key`` (the
    key column is absent after retention), ``multi_family`` (the put would
    target a family named by the whole comma list).
    """
    # the list is split and the columns are retained once a change, not in every use
    own = seal(routed.select("seq", "sink_table", "sink_family", "sink_row_key", "type", "data",
                             F.split("sink_columns", ",").alias("columns"), *keep))
    own = seal(own.select("*", retain_listed(F.col("data"), F.col("columns")).alias("kept")))
    row_key = F.try_element_at(F.col("kept"), F.col("sink_row_key"))
    quarantine = (F.when(F.col("data").isNull(), F.lit("no_data"))
                   .when(row_key.isNull(), F.lit("no_row_key"))
                   .when((F.col("type") != "delete") & F.col("sink_family").contains(","),
                         F.lit("multi_family")))
    return own.select(
        "seq", "sink_table", "sink_family", "type",
        row_key.alias("row_key"),
        non_empty_cells(F.col("kept")).alias("cells"),
        quarantine.alias("quarantine"), *keep)


def cells(log: DataFrame) -> DataFrame:
    """Puts exploded to (seq, sink_table, row_key, col, value)."""
    puts = log.where((F.col("type") != "delete") & F.col("quarantine").isNull())
    return puts.select("seq", "sink_table", "row_key",
                       F.explode(F.col("cells")).alias("col", "value"))


def row_deletes(log: DataFrame) -> DataFrame:
    """Row deletes: (seq, sink_table, row_key)."""
    return log.where((F.col("type") == "delete") & F.col("quarantine").isNull()) \
              .select("seq", "sink_table", "row_key")


def row_log(log: DataFrame) -> DataFrame:
    """Cells put and row deletes in one pass over the log: (seq, sink_table,
    row_key, col, value), a delete with NULL ``col``."""
    gone = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value")))
    entries = F.when(F.col("type") == "delete", gone).otherwise(F.map_entries("cells"))
    return (log.where(F.col("quarantine").isNull())
            .select("seq", "sink_table", "row_key", F.inline(entries).alias("col", "value")))


def quarantined(log: DataFrame) -> DataFrame:
    """Changes that could not be applied, with the reason."""
    return log.where(F.col("quarantine").isNotNull())


def table_events(history: DataFrame, recreate_on_update: bool = True) -> DataFrame:
    """Config ops as DDL on the sink table: (cseq, sink_table, op, sink_family,
    drops, creates). Without ``recreate_on_update`` only ``d`` drops and every
    other op creates the table where it does not exist."""
    op = F.coalesce("op", F.lit(""))          # without op: a change like any other
    drops = ~op.isin("r", "c") if recreate_on_update else op == "d"
    return history.select(
        "cseq", "sink_table", "op", "sink_family",
        drops.alias("drops"),
        (op != "d").alias("creates"))


def sink_tables(history: DataFrame, recreate_on_update: bool = True, keep_birth: bool = False) -> DataFrame:
    """Tables that exist after all config ops: (sink_table, sink_family), and
    with ``keep_birth`` ``born``, the ``cseq`` that created each.

    The last drop (a ``d``, or the drop half of an update) decides: after an
    update the table exists with the update's families; after a ``d`` it
    exists only if a later ``r``/``c`` created it again (its families).
    """
    ev = table_events(history, recreate_on_update)
    last = (ev.where("drops").groupBy("sink_table")
            .agg(F.max_by(F.struct("cseq", "op", "sink_family"), "cseq").alias("l")))
    creates = ev.where("creates and not drops")
    after = (creates.join(last, "sink_table", "left")
             .where(F.col("l").isNull() | (F.col("cseq") > F.col("l.cseq")))
             .groupBy("sink_table")
             .agg(F.min_by("sink_family", "cseq").alias("created_family"), F.min("cseq").alias("created")))
    t = last.join(after, "sink_table", "full")
    # every op but r, c and d recreates the table
    again = F.col("l").isNotNull() & ~F.col("l.op").eqNullSafe(F.lit("d"))
    fam = F.when(again, F.col("l.sink_family")).otherwise(F.col("created_family"))
    born = [F.when(again, F.col("l.cseq")).otherwise(F.col("created")).alias("born")] if keep_birth else []
    return t.select("sink_table", fam.alias("sink_family"), *born).where(F.col("sink_family").isNotNull())


def sink_families(tables: DataFrame) -> DataFrame:
    """Column families of each existing table, one row each: (sink_table, family)."""
    return tables.select("sink_table", F.explode(F.split("sink_family", ",")).alias("family"))


def table_drops(history: DataFrame, recreate_on_update: bool = True) -> DataFrame:
    """Last drop per sink table: (sink_table, drop_seq)."""
    return (table_events(history, recreate_on_update).where("drops").groupBy("sink_table")
            .agg(F.max("cseq").alias("drop_seq")))


def fold_rows(rows: DataFrame, drops: DataFrame,
              max_broadcast: int = DEFAULT_MAX_BROADCAST_BYTES,
              keep_seq: bool = False, keep_deletes: bool = False) -> DataFrame:
    """A row log -> current cells: (sink_table, row_key, col, value [, seq]).

    ``rows`` may mix log entries with a compacted snapshot of earlier ones
    (which keep their seq): a later delete or drop still removes them, a later
    put still replaces them. ``seq`` may be any ordered type (a number, or a
    struct of ordering fields), the same on both sides. ``keep_deletes`` keeps
    each row's last delete (NULL ``col``), as a snapshot must.

    ``max_by`` over a string runs as a sort-based aggregate; it still combines
    map-side before the shuffle, so a hot cell costs one row per map task. The
    window then holds a row's columns, each once."""
    last = (rows.groupBy("sink_table", "row_key", "col")
            .agg(F.max_by("value", "seq").alias("value"), F.max("seq").alias("seq")))
    row = Window.partitionBy("sink_table", "row_key")
    last = last.withColumn("del_seq", F.max(F.when(F.col("col").isNull(), F.col("seq"))).over(row))
    size = drops.agg(F.sum(F.octet_length("sink_table") + F.lit(64))).first()[0] or 0
    if size <= max_broadcast:
        drops = F.broadcast(drops)
    j = last.join(drops, "sink_table", "left")
    live = F.col("del_seq").isNull() | (F.col("seq") > F.col("del_seq"))
    live = F.col("col").isNull() | live if keep_deletes else F.col("col").isNotNull() & live
    live = live & (F.col("drop_seq").isNull() | (F.col("seq") >= F.col("drop_seq")))
    cols = ["sink_table", "row_key", "col", "value"] + (["seq"] if keep_seq else [])
    return j.where(live).select(*cols)


def fold_current(cell_log: DataFrame, deletes: DataFrame, drops: DataFrame, **options) -> DataFrame:
    """``fold_rows`` of cells and row deletes kept apart."""
    return fold_rows(cell_log.unionByName(deletes, allowMissingColumns=True), drops, **options)


def table_summary(current: DataFrame, tables: DataFrame) -> DataFrame:
    """Per existing table: rows and cells now held (0 for emptied tables)."""
    per = current.groupBy("sink_table").agg(
        F.countDistinct("row_key").alias("n_rows"), F.count(F.lit(1)).alias("n_cells"))
    return (tables.join(per, "sink_table", "left")
            .select("sink_table", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
                    F.coalesce("n_cells", F.lit(0)).cast("long").alias("n_cells")))
