"""Operator 9: chat formatting by schema fingerprints. Native expressions only.

A record is a VARIANT. Its fingerprint is the hash of its nested field paths
(scalar types left out, array elements marked); a registry maps fingerprints
to declarative layouts, and a layout says where roles and texts stand. Records
of any registered layout become the same thing: an array of (role, text).

Turns are rendered as ``<|im_start|>role<|im_sep|>text<|im_end|>``. Within
roles and texts a backslash is doubled and one is put after the first
character of every control string, so no control string survives in them and
the way back (drop a backslash, keep what follows) is exact. The loss mask
lists the spans of assistant texts, both in the formatted string and within
their turn (code points, end exclusive).

Defined results: null roles and texts are empty; rows of one conversation are
ordered by turn, then role and text, so repeated rows stay and ties are
settled; a null id is a conversation of its own; a record of an unknown layout
has layout null and no turns; an empty table gives an empty one. Other columns
are not read. A conversation is assembled in one row, however many turns.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rivulet.llm.common import read_table

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Where a control string begins; what follows is looked at only.
CONTROL = r"<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])"
#: Names that other layouts use for the canonical roles (fixed values).
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant",
         "model": "assistant", "chatgpt": "assistant"}


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns.

    ``many``: path of an array with role and text fields per element;
    ``one``: role and text fields of a record that is one turn itself;
    ``fields``: (role, fields) in order; the non-empty fields of a turn are
    joined by a blank line, a turn without any is left out.
    ``optional`` names top-level fields that may be missing.
    """

    name: str
    shape: dict
    many: tuple[str, str, str] | None = None
    one: tuple[str, str] | None = None
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = field(default=())
    #: Roles have other names here (``ROLES``); else they stay as they are.
    foreign: bool = False


LAYOUTS = (
    Layout("messages", {"messages": [{"role": 0, "content": 0}], "system": 0},
           many=("messages", "role", "content"), optional=("system",)),
    Layout("sharegpt", {"conversations": [{"from": 0, "value": 0}], "system": 0},
           many=("conversations", "from", "value"), optional=("system",), foreign=True),
    Layout("instruction", {"instruction": 0, "input": 0, "output": 0, "system": 0},
           fields=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))),
           optional=("input", "system")),
    Layout("prompt_completion", {"prompt": 0, "completion": 0, "system": 0},
           fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))), optional=("system",)),
    Layout("prompt_response", {"prompt": 0, "response": 0, "system": 0},
           fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), optional=("system",)),
    Layout("question_answer", {"question": 0, "answer": 0, "context": 0},
           fields=(("user", ("context", "question")), ("assistant", ("answer",))), optional=("context",)),
    Layout("turn_row", {"turn": 0, "role": 0, "text": 0}, one=("role", "text")),
)


def paths_of(shape) -> str:
    """The field paths of a nested shape, as ``path_text`` writes them."""
    if isinstance(shape, dict):
        return "OBJECT<" + ", ".join(f"{k}{paths_of(v)}" for k, v in sorted(shape.items())) + ">"
    return f"ARRAY<{paths_of(shape[0])}>" if isinstance(shape, list) else ""


def signatures(layout: Layout) -> list[str]:
    """One per choice of the optional fields."""
    out = []
    for keep in product((True, False), repeat=len(layout.optional)):
        gone = {f for f, k in zip(layout.optional, keep) if not k}
        out.append(paths_of({k: v for k, v in layout.shape.items() if k not in gone}))
    return out


def path_text(record: Column) -> Column:
    """Nested field paths of a VARIANT, without the types of its scalars."""
    return F.regexp_replace(F.schema_of_variant(record), r": (?=OBJECT|ARRAY)|: [A-Z_]+(\(\d+, ?\d+\))?", "")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(path_text(record))


def layout_of(record: Column, layouts=LAYOUTS) -> Column:
    """Name of the layout whose fingerprint the record has, or null."""
    pairs = [c for x in layouts for s in signatures(x) for c in (F.xxhash64(F.lit(s)), F.lit(x.name))]
    return F.try_element_at(F.create_map(*pairs), fingerprint(record))


def _role(c: Column, foreign: bool) -> Column:
    if not foreign:
        return F.coalesce(c, F.lit(""))
    known = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    return F.coalesce(F.try_element_at(known, F.lower(c)), c, F.lit(""))


def _turns(record: Column, x: Layout) -> Column:
    get = lambda path, kind="string": F.try_variant_get(record, f"$.{path}", kind)
    turn = lambda role, text: F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    if x.one:
        return F.array(turn(_role(get(x.one[0]), x.foreign), get(x.one[1])))
    if x.many:
        path, role, text = x.many
        listed = F.transform(get(path, f"array<struct<`{role}`:string,`{text}`:string>>"),
                             lambda t: turn(_role(t[role], x.foreign), t[text]))
        system = F.filter(F.array(turn(F.lit("system"), get("system"))), lambda t: t["text"] != "")
        return F.concat(system, F.coalesce(listed, F.filter(system, lambda t: F.lit(False))))
    made = []
    for role, names in x.fields:
        filled = F.filter(F.array(*[get(n) for n in names]), lambda c: F.coalesce(c, F.lit("")) != "")
        made.append(turn(F.lit(role), F.array_join(filled, "\n\n")))
    return F.filter(F.array(*made), lambda t: t["text"] != "")


def canonical_turns(df: DataFrame, record: str, layouts=LAYOUTS, layout_col: str = "layout",
                    turns_col: str = "turns") -> DataFrame:
    """Adds the layout's name and the canonical turns of a VARIANT column."""
    known = df.withColumn(layout_col, layout_of(F.col(record), layouts))
    turns = F.lit(None)
    for x in layouts:
        turns = F.when(F.col(layout_col) == x.name, _turns(F.col(record), x)).otherwise(turns)
    return known.withColumn(turns_col, turns)


def escape(c: Column) -> Column:
    return F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), CONTROL, "$0\\\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def format_turns(rows: DataFrame, conv: str = "conv_id", order: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """Rows of single turns -> (conv, formatted, loss_spans)."""
    head = F.concat(F.lit(START), escape(F.col("__role")), F.lit(SEP))
    cut = rows.select(F.col(conv).alias("__conv"), F.col(order).alias("__order"), F.col(role).alias("__role"),
                      F.col(text).alias("__text")).withColumns({"__head": head, "__body": escape(F.col("__text"))})
    made = cut.select("__conv", "__order", "__role", "__text",
                      F.concat("__head", "__body", F.lit(END)).alias("part"),
                      F.length("__head").alias("from"), (F.length("__head") + F.length("__body")).alias("to"))
    w = Window.partitionBy("__conv").orderBy("__order", "__role", "__text")
    placed = made.select(
        "__conv", "__role", "part", "from", "to", (F.row_number().over(w) - 1).alias("turn"),
        F.coalesce(F.sum(F.length("part").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("at"))
    all_turns = F.sort_array(F.collect_list(F.struct("turn", "part", "at", "from", "to", F.col("__role").alias("role"))))
    spans = F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: F.struct(
        (t["at"] + t["from"]).alias("start"), (t["at"] + t["to"]).alias("end"),
        t["turn"].alias("turn"), t["from"].alias("from"), t["to"].alias("to")))
    return placed.groupBy("__conv").agg(all_turns.alias("turns")).select(
        F.col("__conv").alias(conv), F.array_join(F.transform("turns", lambda t: t["part"]), "").alias("formatted"),
        spans.alias("loss_spans"))


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, turns, loss): the turns parsed from the formatted string, and
    all text under the loss mask."""
    quoted = lambda s: s.replace("|", r"\|")
    pieces = formatted.withColumn("__pieces", F.filter(F.split("formatted", quoted(START), -1), lambda p: p != ""))
    body = lambda p: F.substring_index(p, END, 1)
    turns = F.transform("__pieces", lambda p: F.struct(
        unescape(F.substring_index(p, SEP, 1)).alias("role"),
        unescape(F.substring_index(body(p), SEP, -1)).alias("text")))
    under = F.transform("loss_spans", lambda s: unescape(F.substr(
        F.concat(F.lit(START), F.get("__pieces", s["turn"])), s["from"] + 1, s["to"] - s["from"])))
    return pieces.select(conv, "formatted", turns.alias("turns"), F.array_join(under, "").alias("loss"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, then read back as digests."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.array(*[F.struct(F.lit(-7).alias("conv_id"), F.lit(i).alias("turn"), F.lit(role).alias("role"),
                              F.lit("</s>[INST] ok [/INST]").alias("text")) for i, role in enumerate(("user", "assistant"))])
    tricky = spark.range(1).select(F.inline(said)).select(*[F.col(f.name).cast(f.dataType) for f in rows.schema])
    records = rows.unionByName(tricky).select("conv_id", "turn", F.to_variant_object(
        F.struct("turn", "role", "text")).alias("record"))
    turns = canonical_turns(records, "record").select("conv_id", "turn", F.inline("turns"))
    back = read_back(format_turns(turns))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


OP9_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized as (
  select *, length(t) + length(t) - length(replace(t, '\', ''))
    + len(regexp_extract_all(t, '<\||</?s>|<</?SYS>>|\[/?INST\]')) as chars
  from (select *, unnest([role, text]) as t from rows)
), totals as (select conv_id, sum(chars) as chars from sized group by conv_id)
select n.conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(any_value(t.chars) + 32 * count(*) as bigint) as formatted_chars
from rows n join totals t on n.conv_id is not distinct from t.conv_id group by n.conv_id
"""
