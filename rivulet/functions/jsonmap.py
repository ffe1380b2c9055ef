"""Schema-free JSON objects as ``MAP<STRING, VARIANT>`` columns.

All helpers return Columns of built-in expressions, so they stay inside the
JVM and whole-stage code generation; nothing here runs Python per row.

Semantics follow a lenient, hash-map based JSON object:
* a line that is not a JSON object (malformed text, array, scalar, NULL)
  parses to NULL;
* a duplicated member keeps its **last** value;
* a member holding JSON ``null`` counts as absent (it is dropped on parse, as
  the serializer would drop it on output);
* getters coerce: a number read as a string gives its text, a numeric string
  read as a long gives the number.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_OBJ = "map<string,variant>"
# A lenient parser: single quotes and unquoted member names are accepted.
JSON_OPTIONS = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}


def last_wins(m: Column) -> Column:
    """Keep the last value of a duplicated key; the common no-duplicate case
    is detected first so the quadratic rebuild runs only on odd lines."""
    e = F.map_entries(m)
    kept = F.filter(e, lambda x, i: ~F.exists(F.slice(e, i + 2, F.size(e)),
                                               lambda y: y["key"] == x["key"]))
    return (F.when(F.size(F.array_distinct(F.map_keys(m))) == F.size(m), m)
             .otherwise(F.map_from_entries(kept)))


def parse_one(text: Column, as_type: str) -> Column:
    """The one JSON object on a line, read as ``as_type``; NULL when the line
    holds anything else, text or a second value after the object included.

    The line is read in brackets, where what follows is seen as such, unless
    it closes the bracket itself. A line with an object before a closing
    bracket is therefore read as a member, too, with one more member after it:
    no text right after the object both closes the bracket and goes on to that
    member."""
    found = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{as_type}>", JSON_OPTIONS)
    one = F.try_element_at(F.get(F.filter(F.array(found), lambda a: F.size(a) == 1), F.lit(0)), F.lit(1))
    member = F.from_json(F.concat(F.lit('{"v":'), text, F.lit(',"end":1}')), "struct<end:int>", JSON_OPTIONS)
    return F.when(~text.rlike(r"\}\s*\]") | F.coalesce(member["end"] == 1, F.lit(False)), one)


def parse_object(text: Column | str) -> Column:
    """JSON text -> MAP<STRING,VARIANT>; NULL when the text is not an object.

    Use as ``df.select(parse_object(...).alias('raw'))`` followed by
    ``normalize_object('raw')`` in a *separate* projection: the normalization
    references the parsed map several times and must not inline the parse.
    """
    return parse_one(text if isinstance(text, Column) else F.col(text), _OBJ)


def normalize_object(m: Column) -> Column:
    """Last duplicate wins; members holding JSON null are dropped."""
    return F.map_filter(last_wins(m), lambda k, v: ~F.is_variant_null(v))


def parse_string_map(text: Column | str) -> Column:
    """JSON object text -> MAP<STRING,STRING> (nested values kept as JSON text,
    numbers as their text, JSON null as SQL NULL). Apply ``last_wins`` in a
    separate projection."""
    return F.from_json(text if isinstance(text, Column) else F.col(text), "map<string,string>",
                       JSON_OPTIONS)


def seal(df):
    """Pass every column through a one-row ``inline``.

    Catalyst pushes filters through projections by substituting the projected
    expressions, which would re-run an expensive parse inside the Filter.
    Columns produced by a generator cannot be substituted, so filters on them
    stay above it and the parse runs once. The generator is code-generated
    and emits exactly one row per input row."""
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def member(m: Column, key: str) -> Column:
    """Raw variant member (NULL when absent)."""
    return m.getItem(key)


def member_str(v: Column, path: str = "$") -> Column:
    """Coercing string read of a variant (objects come back as JSON text)."""
    return F.try_variant_get(v, path, "string")


def member_long(v: Column, path: str = "$") -> Column:
    return F.try_variant_get(v, path, "bigint")


def member_array(v: Column, path: str = "$") -> Column:
    """Array members as ARRAY<VARIANT>; NULL when absent or not an array."""
    return F.try_variant_get(v, path, "array<variant>")


def with_member(obj: Column, key: str, value: Column) -> Column:
    """Variant object ``obj`` with ``key`` set to ``value`` (a variant)."""
    inner = F.try_variant_get(obj, "$", _OBJ)
    rest = F.map_filter(inner, lambda k, v: k != F.lit(key))
    return F.to_variant_object(F.map_concat(rest, F.create_map(F.lit(key), value)))


def without_members(m: Column, drop: dict[str, Column]) -> Column:
    """Remove members: ``drop`` maps a key to a boolean Column deciding it."""
    def gone(k):
        cond = F.lit(False)
        for key, when in drop.items():
            cond = cond | ((k == F.lit(key)) & F.coalesce(when, F.lit(False)))
        return cond
    return F.map_filter(m, lambda k, v: ~gone(k))


def to_json_object(pairs: list[tuple[str, Column]]) -> Column:
    """Serialize key -> variant pairs as one JSON object, omitting NULL members."""
    args = []
    for k, v in pairs:
        args += [F.lit(k), v]
    m = F.map_filter(F.create_map(*args), lambda k, v: v.isNotNull())
    return F.to_json(m)
