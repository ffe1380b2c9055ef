"""Operator 5: line dedup by overlapping three-line windows.

Every text is cut at line feeds, and a virtual line stands before and after it;
each run of three consecutive lines with a non-empty one among them is a window,
known by two 64-bit hashes of its lines. Texts of one or two lines and passages
at a text's edge thus have windows, too.
Over the whole corpus the first occurrence of a window (smallest document id,
then position) stays; the lines that any later occurrence covers are removed,
overlapping windows merged. What remains is joined again by line feeds.

A window may be in a third of all rows: the first occurrence is a grouped
minimum (combined before the shuffle), and the way back to the later ones is
an equi-join of which adaptive execution splits skewed partitions.

Defined results: a null text stays null; an empty text has no window; rows that
repeat both id and text count as one document and get the same result; a document of which every line is removed keeps an empty
text; an empty table gives an empty one. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.llm.common import read_table

SPAN = 3
#: Stands before and after a text; no line holds a line feed.
EDGE = "\n"


def windows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, pos, k1, k2): every window of every row; pos -1 is the
    virtual line before the text."""
    split = F.split(F.col(text_col).cast("string"), "\n", -1)
    split = F.concat(F.array(F.lit(EDGE)), split, F.array(F.lit(EDGE)))
    lines = df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), split.alias("lines"))
    long_enough = lines.filter(F.size("lines") >= SPAN)
    runs = F.expr(f"transform(sequence(0, size(lines) - {SPAN}), i -> slice(lines, i + 1, {SPAN}))")
    return (long_enough.select("id", "text_hash", F.posexplode(runs).alias("pos", "run"))
            .filter(F.exists("run", lambda line: ~line.isin("", EDGE)))
            .select("id", "text_hash", (F.col("pos") - 1).alias("pos"), F.xxhash64("run").alias("k1"),
                    F.xxhash64(F.lit("second"), "run").alias("k2")))


def later_occurrences(win: DataFrame) -> DataFrame:
    """Of ``windows`` rows, those that are not the first of their kind."""
    first = (win.groupBy("k1", "k2")
             .agg(F.min(F.struct("id", "text_hash", "pos")).alias("first"), F.count("*").alias("n"))
             .filter("n > 1").drop("n"))
    return (win.join(first, ["k1", "k2"])
            .filter(~F.struct("id", "text_hash", "pos").eqNullSafe(F.col("first")))
            .select("id", "text_hash", "pos"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with its text cleaned, plus ``__lines`` and ``__removed`` (line
    counts before and of what went)."""
    starts = (later_occurrences(windows(df, id_col, text_col))
              .groupBy(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"))
              .agg(F.collect_set("pos").alias("__starts")))
    covered = f"array_distinct(flatten(transform(__starts, s -> sequence(s, s + {SPAN - 1}))))"
    joined = df.withColumn("__hash0", F.xxhash64(text_col)).join(
        starts, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__hash0") == F.col("__hash")), "left")
    lines = joined.withColumn("__list", F.split(F.col(text_col).cast("string"), "\n", -1))
    kept = lines.withColumn("__keep", F.expr(
        f"case when __starts is not null then array_except(sequence(0, size(__list) - 1), {covered}) end"))
    text = F.when(F.col("__starts").isNull(), F.col(text_col)).otherwise(
        F.expr("array_join(transform(__keep, i -> get(__list, i)), '\\n')"))
    return kept.select(
        *[text.alias(c) if c == text_col else F.col(c) for c in df.columns],
        F.when(F.col(text_col).isNull(), 0).otherwise(F.size("__list")).cast("long").alias("__lines"),
        F.when(F.col("__starts").isNull(), 0).otherwise(F.size("__list") - F.size("__keep")).cast("long").alias("__removed"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its line counts and the text that stays."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", F.col("__lines").alias("n_lines"),
                                    F.col("__removed").alias("n_removed"), "text")


OP5_SQL = """
with parts as (
  select doc_id, text, string_split(text, chr(10)) as ls from documents
), win as (
  select doc_id, i - 2 as pos, ws[i] as a, ws[i + 1] as b, ws[i + 2] as c
  from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i
        from (select doc_id, list_concat([chr(10)], list_concat(ls, [chr(10)])) as ws from parts where text is not null))
), ranked as (
  select doc_id, pos, row_number() over (partition by a, b, c order by doc_id, pos) as nth
  from win where a not in ('', chr(10)) or b not in ('', chr(10)) or c not in ('', chr(10))
), gone as (
  select distinct doc_id, pos + d as line from ranked, (values (0), (1), (2)) t(d) where nth > 1
), split_lines as (
  select doc_id, i - 1 as line, ls[i] as l from (select doc_id, ls, unnest(range(1, len(ls) + 1)) as i from parts)
), kept as (
  select s.doc_id, count(*) as n_lines, count(g.line) as n_removed,
         coalesce(string_agg(l, chr(10) order by s.line) filter (where g.line is null), '') as text
  from split_lines s left join gone g on s.doc_id = g.doc_id and s.line = g.line
  group by s.doc_id
)
select p.doc_id, cast(coalesce(k.n_lines, 0) as bigint) as n_lines,
       cast(coalesce(k.n_removed, 0) as bigint) as n_removed, k.text
from parts p left join kept k on p.doc_id = k.doc_id
"""
