"""Change records (``{database, table, type, data}``) -> filtered, pruned rows.

All map-only column expressions; they run the same on batch and streaming
input and never shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rivulet import constants as K
from rivulet.functions.jsonmap import last_wins, parse_one, parse_string_map, seal


# The envelope is read as a typed struct: a duplicated member keeps its last
# value and ``data`` keeps the object's JSON text.
ENVELOPE_TYPE = "struct<database:string,table:string,type:string,data:string>"


def parse_changes(lines: DataFrame, seq: str = "seq", value: str = "value") -> DataFrame:
    """(seq, value) -> seq, database, table, type, data_text, data, malformed, bad.

    ``data`` is MAP<STRING,STRING>: numbers as their text, nested objects as
    JSON text, JSON null as NULL, last duplicate wins. ``malformed`` marks
    lines that are not one JSON object and nothing else; the
    reproduced job would fail on them, we quarantine them; ``bad`` is such a
    line, NULL for the others.
    """
    p = lines.select(F.col(seq).alias("seq"), F.col(value).alias("line"), parse_one(F.col(value), ENVELOPE_TYPE).alias("e"))
    p = p.select("seq", F.col("e").isNull().alias("malformed"), "e.database", "e.table", "e.type",
                 F.col("e.data").alias("data_text"), "line")
    p = p.select("*", parse_string_map(F.col("data_text")).alias("raw"))
    p = p.select("seq", "database", "table", "type", "data_text",
                 last_wins(F.col("raw")).alias("data"), "malformed", F.when(F.col("malformed"), F.coalesce("line", F.lit(""))).alias("bad"))
    return seal(p)


def wanted(database: str = K.DEFAULT_DATABASE, strict_data: bool = False) -> F.Column:
    """``database`` rows of type insert / update / delete, and
    bootstrap-insert rows whose data is a non-empty object. As coded, the data
    test guards only bootstrap-insert; ``strict_data`` applies it to all."""
    data_ok = F.col("data_text").isNotNull() & (F.length("data_text") > 2)
    typ = F.col("type")
    keep = (F.col("database") == database) & (
        typ.isin(*K.CHANGE_TYPES) | ((typ == K.BOOTSTRAP_INSERT) & data_ok))
    if strict_data:
        keep = keep & data_ok
    return F.coalesce(keep, F.lit(False))


def filter_changes(changes: DataFrame, database: str = K.DEFAULT_DATABASE,
                   strict_data: bool = False) -> DataFrame:
    """Keep the ``wanted`` changes."""
    return changes.where(wanted(database, strict_data)).drop("bad")


def retain_columns(data: F.Column, sink_columns: F.Column) -> F.Column:
    """Keep keys listed in the comma list (exact, case-sensitive, untrimmed)."""
    return retain_listed(data, F.split(sink_columns, ","))


def retain_listed(data: F.Column, columns: F.Column) -> F.Column:
    """Keep keys among ``columns``, which should be a column rather than an
    expression, as it is read for every key.
    The change type is attached after retention and removed before the write,
    so a real data column named ``type`` never survives."""
    return F.map_filter(data, lambda k, v: F.array_contains(columns, k) & (k != F.lit("type")))


def non_empty_cells(cells: F.Column) -> F.Column:
    """NULL and '' values are not written."""
    return F.map_filter(cells, lambda k, v: v.isNotNull() & (v != F.lit("")))
