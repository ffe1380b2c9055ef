"""Consumer-side extraction of emitted JSON records into typed columns.

Outputs are compared on these columns, or as ``canonical`` text of the whole
record, never on JSON text as emitted (key order carries no meaning)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rivulet import constants as K

RECORD_TYPE = ("struct<common:struct<mid:string,is_new:string>,ts:bigint,"
               "page:struct<page_id:string>,err:struct<error_code:bigint>,"
               "start:struct<entry:string>,display:string,displays:string,"
               "actions:string,action:string>")


def extract_routed(routed: DataFrame) -> DataFrame:
    """(seq, topic, pos, value) -> + mid, is_new, ts, page_id, error_code, entry,
    display, displays, actions, action (NULL for the raw dirty lines)."""
    r = F.when(F.col("topic") != K.TOPIC_DIRTY, F.from_json("value", RECORD_TYPE))
    x = routed.select("seq", "topic", "pos", r.alias("r"))
    return x.select(
        "seq", "topic", "pos",
        F.col("r.common.mid").alias("mid"),
        F.col("r.common.is_new").alias("is_new"),
        F.col("r.ts").alias("ts"),
        F.col("r.page.page_id").alias("page_id"),
        F.col("r.err.error_code").alias("error_code"),
        F.col("r.start.entry").alias("entry"),
        F.col("r.err").isNotNull().alias("has_err"),
        F.col("r.start").isNotNull().alias("has_start"),
        F.col("r.display").alias("display"),
        F.col("r.displays").alias("displays"),
        F.col("r.actions").alias("actions"),
        F.col("r.action").alias("action"))


def canonical(text_col: str):
    """A record's whole text with the members of every object in order of name."""
    return F.to_json(F.parse_json(text_col))


def array_len(text_col: str):
    return F.json_array_length(F.col(text_col)).cast("long")


def obj_pos(text_col: str):
    return F.get_json_object(F.col(text_col), "$.pos").cast("int")
