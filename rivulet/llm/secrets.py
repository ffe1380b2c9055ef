"""Operator 10: secret scans. Native expressions only.

Three kinds of spans are found by pattern (assigned values, access keys, long
hexadecimal strings). The method adds a fourth: every candidate string (a long
run of key characters) belongs to the narrowest character class that holds it;
a window slides over it, keeping the count of each character and the sum of
c*log2(c), both updated for the one character that enters and the one that
leaves; windows whose Shannon entropy reaches the class's threshold are
flagged, from the first to the last. Words of samples cut candidates. Allowed shapes (words, numbers, paths,
UUIDs) suppress entropy spans, as does a pattern span around them;
pattern spans always stay.

Defined results: a null text is empty and has no spans; spans are counted in
code points, end exclusive, ordered by start, then kind; repeated rows get the
same result; an empty table gives an empty one; other columns are left alone.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rivulet.functions.jsonmap import seal
from rivulet.llm.common import read_table, text_or_empty

#: The patterns of the base kinds, in the order of their rank.
ASSIGN = r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
#: Every assigned value has one of these in its lower-cased text.
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Words of samples. A candidate ends before one and goes on after its first
#: letter, so that they allow nothing that stands beside them.
SAMPLE = r"(?i:example|sample|dummy|placeholder|xxxx)"
CANDIDATE = r"(?:(?!%s)[A-Za-z0-9+/_=-]){%d,}+" % (SAMPLE, WINDOW)
#: What every candidate and hexadecimal span holds, the first quicker to find.
CANDIDATE_HINTS = (r"[!-~]{%d}" % WINDOW, r"[A-Za-z0-9+/_=-]{%d}" % WINDOW)
#: Character classes, narrowest first, and their entropy thresholds in bits.
CLASSES = (
    (r"^[0-9a-fA-F]+$", 3.0),
    (r"^[A-Z0-9]+$", 3.5),
    (r"^[A-Za-z0-9]+$", 3.7),
    (r"^[A-Za-z0-9_-]+$", 3.8),
    (r"", 3.9),
)
#: Flagged by entropy is only what has a letter beside a digit: words, numbers
#: and both joined by other characters are not. Nor is a UUID.
MIXED = r"[A-Za-z][0-9]|[0-9][A-Za-z]"
UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
CHUNK = 256
#: Bits of a count (at most WINDOW), and how many counts one number holds.
COUNT_BITS = 5
PER_NUMBER = 12


def _before(values: Column, first: int = 0, op=lambda a, x: a + x) -> Column:
    """Running sums (or another ``op``) of an array from ``first`` on, each
    without its own element, the total last. In chunks, so that growing arrays
    stay short however many elements there are; what a lambda reads is its
    argument, so nothing is computed once an element."""
    grow = lambda a, x: F.concat(a, F.array(op(F.element_at(a, -1), x)))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int")),
                         lambda c: F.aggregate(F.slice(values, c * CHUNK + 1, CHUNK), F.array(F.lit(first)), grow))
    bases = F.aggregate(chunks, F.array(F.lit(first)), lambda a, c: grow(a, F.element_at(c, -1)))
    flat = F.zip_with(chunks, F.slice(bases, 1, F.size(bases) - 1), lambda c, base: F.transform(
        F.slice(c, 1, F.size(c) - 1), lambda x: op(x, base)))
    return F.when(F.size(values) > 0, F.concat(F.flatten(flat), F.array(F.element_at(bases, -1)))).otherwise(F.array(F.lit(first)))


def extractions(text: Column, pattern: str, hint: Column, name: str, groups: int = 2) -> list[Column]:
    """Columns ``name``0, ``name``1, ..: of the leftmost non-overlapping
    matches the text before each, the match, and its groups; null where
    ``hint`` is false, as it must be only where nothing matches."""
    anchored = r"\G((?s:.*?))(" + pattern + ")"
    return [F.when(hint, F.regexp_extract_all(text, F.lit(anchored), F.lit(g + 1))).alias(f"{name}{g}") for g in range(groups)]


def placed(name: str, value: str | None = None) -> Column:
    """array<struct<start, end, hit, value>> of ``extractions`` whose
    ``name``_ends holds the length of each match and the text before it."""
    zipped = F.arrays_zip(F.col(f"{name}0").alias("gap"), F.col(f"{name}1").alias("hit"), F.col(value or f"{name}1").alias("value"))
    begins = F.slice(_before(F.col(f"{name}_ends")), 1, F.size(f"{name}0"))
    return F.zip_with(zipped, begins, lambda m, b: F.struct(
        (b + F.length(m["gap"])).alias("start"), (b + F.length(m["gap"]) + F.length(m["hit"])).alias("end"),
        m["hit"].alias("hit"), m["value"].alias("value")))


def _spans(found: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    spans = F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"),
                                                  m["end"].alias("end"), F.lit(kind).alias("kind")))
    return F.coalesce(spans, F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>"))


def threshold(hit: Column) -> Column:
    """Entropy threshold of the narrowest class that holds the string."""
    out = F.lit(CLASSES[-1][1])
    for pattern, bits in reversed(CLASSES[:-1]):
        out = F.when(hit.rlike(pattern), bits).otherwise(out)
    return out


def flagged_window(hit: Column, limit: Column, window: int = WINDOW) -> Column:
    """struct<first, last>: from the first to the end of the last window of
    ``hit`` whose entropy is at least ``limit`` (first -1: none)."""
    # a character's count stands in COUNT_BITS bits of one of a few numbers
    code = lambda c: F.instr(F.lit(ALPHABET), c) - 1
    places = F.transform(F.split(hit, ""), lambda c: F.struct(
        F.floor(code(c) / PER_NUMBER).cast("int").alias("number"), (code(c) % PER_NUMBER * COUNT_BITS).alias("shift")))
    # what enters, and what leaves (null in the first window)
    pairs = F.arrays_zip(places.alias("new"), F.concat(
        F.array_repeat(F.lit(None).cast("struct<number:int,shift:int>"), window), places).alias("old"))
    term = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), -(-len(ALPHABET) // PER_NUMBER)).alias("counts"), F.lit(0.0).alias("sum"),
                     F.lit(0).alias("i"), F.lit(-1).alias("first"), F.lit(-1).alias("last"), limit.alias("limit"))
    one = lambda place, j: F.when(j == place["number"], F.call_function(
        "shiftleft", F.lit(1).cast("long"), place["shift"])).otherwise(F.lit(0).cast("long"))
    count = lambda counts, place: F.call_function(
        "shiftright", F.get(counts, place["number"]), place["shift"]).bitwiseAND((1 << COUNT_BITS) - 1).cast("int")

    def step(acc, p):
        same = p["new"].eqNullSafe(p["old"])
        n_in, n_out = count(acc["counts"], p["new"]), F.coalesce(count(acc["counts"], p["old"]), F.lit(0))
        total = F.when(same, acc["sum"]).otherwise(
            acc["sum"] + F.get(term, n_in + 1) - F.get(term, n_in) - F.get(term, n_out) + F.get(term, F.greatest(n_out - 1, F.lit(0))))
        counts = F.when(same, acc["counts"]).otherwise(F.transform(
            acc["counts"], lambda c, j: c + one(p["new"], j) - one(p["old"], j)))
        high = (acc["i"] >= window - 1) & (F.lit(math.log2(window)) - total / window >= acc["limit"])
        return F.struct(counts.alias("counts"), total.alias("sum"), (acc["i"] + 1).alias("i"),
                        F.when(high & (acc["first"] < 0), acc["i"] - (window - 1)).otherwise(acc["first"]).alias("first"),
                        F.when(high, acc["i"] + 1).otherwise(acc["last"]).alias("last"), acc["limit"].alias("limit"))

    # the zipped array ends with codes that leave after the last one entered
    return F.aggregate(F.filter(pairs, lambda p: p["new"].isNotNull()), start, step,
                       lambda a: F.struct(a["first"].alias("first"), a["last"].alias("last")))


def entropy_spans(candidates: Column) -> Column:
    odd = F.filter(candidates, lambda m: m["hit"].rlike(MIXED) & ~m["hit"].rlike(UUID))
    seen = F.transform(odd, lambda m: F.struct(m["start"].alias("at"), flagged_window(m["hit"], threshold(m["hit"])).alias("w")))
    return F.transform(F.filter(seen, lambda m: m["w"]["first"] >= 0), lambda m: F.struct(
        (m["at"] + m["w"]["first"]).alias("start"), (m["at"] + m["w"]["last"]).alias("end")))


def without_covered(df: DataFrame, inner: str, around: str) -> DataFrame:
    """Drops the elements (start, end, ..) of array ``inner`` that lie within
    one of ``around``: in order of start, the furthest end so far tells."""
    mark = lambda kind: lambda x, i: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), i.alias("i"))
    marks = F.when(F.size(inner) > 0, F.array_sort(F.concat(F.transform(around, mark(0)), F.transform(inner, mark(1)))))
    marked = seal(df.withColumn("__marks", marks))
    marked = seal(marked.withColumn("__ends", F.transform("__marks", lambda m: F.when(m["kind"] == 0, m["end"]).otherwise(-1))))
    zipped = F.arrays_zip(F.col("__marks").alias("m"), F.slice(_before(F.col("__ends"), -1, F.greatest), 1, F.size("__marks")).alias("reach"))
    stay = F.transform(F.filter(zipped, lambda x: (x["m"]["kind"] == 1) & (x["reach"] < x["m"]["end"])), lambda x: F.get(inner, x["m"]["i"]))
    return seal(marked.withColumn(inner, F.when(F.size("__marks") > 0, stay)).drop("__marks", "__ends"))


def scan(df: DataFrame, text_col: str = "text", base_col: str = "base_spans", all_col: str = "all_spans") -> DataFrame:
    """Adds the base spans and all spans, each array<struct<start, rank, end,
    kind>> in order, in place of columns so named. Every pattern is run once (``seal``) for each thing that is
    taken from its matches."""
    text, lower = F.col("__scan"), F.lower("__scan")
    kept = [c for c in df.columns if c not in (base_col, all_col)]
    some = lambda conditions, op: reduce(op, conditions)
    hinted = seal(seal(df.withColumn("__scan", text_or_empty(text_col)))
                  .withColumn("__named", some([lower.contains(h) for h in ASSIGN_HINTS], or_))
                  .withColumn("__long", some([text.rlike(h) for h in CANDIDATE_HINTS], and_)))
    kinds = {"__assign": (ASSIGN, F.col("__named"), 3), "__access": (ACCESS, text.contains("AKIA"), 2),
             "__hex": (HEX, F.col("__long"), 2), "__candidate": (CANDIDATE, F.col("__long"), 2)}
    found = seal(hinted.select(*df.columns, *[c for name, (pattern, hint, groups) in kinds.items()
                                              for c in extractions(text, pattern, hint, name, groups)]))
    ends = lambda name: F.zip_with(f"{name}0", f"{name}1", lambda gap, hit: F.length(gap) + F.length(hit))
    found = seal(found.withColumns({f"{name}_ends": ends(name) for name in kinds}))
    assign = F.filter(placed("__assign", "__assign2"), lambda m: F.length(m["value"]) >= LEAST_VALUE)
    based = seal(found.select(
        *kept,
        F.array_sort(F.concat(_spans(assign, "assign"), _spans(placed("__access"), "access"), _spans(placed("__hex"), "hex"))).alias(base_col),
        F.when(F.size("__candidate1") > 0, placed("__candidate")).alias("__candidates")))
    based = without_covered(based, "__candidates", base_col)      # what lies in a pattern span could give nothing
    entropy = F.when(F.size("__candidates") > 0, _spans(entropy_spans(F.col("__candidates")), "entropy"))
    both = without_covered(seal(based.withColumn("__entropy", entropy).drop("__candidates")), "__entropy", base_col)
    return both.withColumn(all_col, F.when(F.size("__entropy") > 0, F.array_sort(F.concat(base_col, "__entropy")))
                           .otherwise(F.col(base_col))).drop("__entropy")


def redact(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The same columns, with every span of the text replaced by ``mark``
    (spans that touch or overlap by one)."""
    found = scan(df, text_col, "__base", "__spans").drop("__base")
    # a cut begins where a span begins after the end of all before it, and ends with the last end before the next one
    found = seal(found.withColumn("__ends", F.transform("__spans", lambda s: s["end"])))
    found = seal(found.withColumn("__reach", F.when(F.size("__spans") > 0, _before(F.col("__ends"), -1, F.greatest))).drop("__ends"))
    begins = F.filter(F.arrays_zip(F.transform("__spans", lambda s: s["start"]).alias("start"),
                                   F.slice("__reach", 1, F.size("__spans")).alias("past")), lambda x: x["start"] > x["past"])
    found = seal(found.withColumn("__begins", F.when(F.size("__spans") > 0, begins)).withColumn("__last", F.element_at("__reach", -1)))
    # of every cut the text before it: from the end of the cut before
    gaps = F.transform("__begins", lambda x: F.struct(F.greatest(x["past"], F.lit(0)).alias("from"), x["start"].alias("to")))
    chars = seal(found.withColumn("__gaps", gaps).withColumn("__chars", F.when(F.size("__spans") > 0, F.split(text_col, "")))
                 .drop("__spans", "__reach", "__begins"))
    pieces = F.transform("__gaps", lambda g: F.concat(F.array_join(F.slice("__chars", g["from"] + 1, g["to"] - g["from"]), ""), F.lit(mark)))
    rest = F.array_join(F.slice("__chars", F.col("__last") + 1, F.size("__chars")), "")
    text = F.when(F.size("__gaps") > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(F.col(text_col))
    return chars.select(*[text.alias(c) if c == text_col else F.col(c) for c in df.columns])


def span_text(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    found = scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", of("assign"), of("access"), of("hex"),
                        F.sha2(span_text("base_spans"), 256).alias("base_sha256"), span_text("all_spans").alias("spans"))
