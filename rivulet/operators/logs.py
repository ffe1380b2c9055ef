"""Log job: JSON lines -> dirty split -> visitor-flag repair -> topic fan-out.

Every step is a DataFrame -> DataFrame transform built from JVM expressions.
Stages and their shuffles:

1. ``tag_lines``    map-only: one parse of each line into MAP<STRING,VARIANT>,
                    extraction of the device key, flag and time, a dirty reason.
2. ``repair_flags`` the only shuffle. A partial (map-side combined)
                    aggregation finds each device's first visit; rows then meet
                    their device's row in a join. Devices with very many rows
                    ("hot" devices, a bounded top-k) are answered from a
                    broadcast and their rows are spread over all partitions by
                    a salt, so no task ever holds one device's rows.
3. ``route``        map-only: one array of (topic, pos, value) per line, one
                    ``inline``; dirty lines come out as their raw text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rivulet import constants as K
from rivulet.functions.jsonmap import (member_array, member_long, member_str, normalize_object,
                                       parse_object, seal, to_json_object, with_member,
                                       without_members)
from rivulet.functions.times import ts_to_day

# A device with at least this many rows is "hot": its first visit comes from a
# broadcast and its rows are salted across partitions.
DEFAULT_HOT_ROWS = 1_000_000
# Upper bound on hot devices, which bounds the broadcast (~60 bytes a row).
DEFAULT_MAX_HOT_KEYS = 10_000

DIRTY_REASONS = ("not_json", "no_common", "no_mid", "no_ts")

ROUTE_TYPE = "array<struct<topic:string,pos:int,value:string>>"


def tag_lines(lines: DataFrame, seq: str = "seq", value: str = "value",
              tz: str = K.DEFAULT_TZ, keep: tuple[str, ...] = ()) -> DataFrame:
    """(seq, value) -> seq, value, m, mid, is_new, ts, visit_day, seed_day, dirty_reason.

    ``dirty_reason`` is NULL for good lines. A line is dirty when it is not a
    JSON object (``not_json``), has no ``common`` object (``no_common``), no
    device id (``no_mid``) or no ``ts`` (``no_ts``). Days are DATEs in ``tz``;
    ``seed_day`` is the state a device's first line would set. Columns named
    in ``keep`` are carried through unchanged.
    """
    kp = list(keep)
    raw = lines.select(F.col(seq).alias("seq"), F.col(value).alias("value"), *kp,
                       parse_object(F.col(value)).alias("raw"))
    norm = raw.select("seq", "value", *kp, normalize_object(F.col("raw")).alias("m"))
    m = F.col("m")
    part = norm.select("seq", "value", *kp, "m", m.getItem("common").alias("common"),
                       member_long(m.getItem("ts")).alias("ts"))
    common = F.when(F.schema_of_variant(F.col("common")).startswith("OBJECT"), F.col("common"))
    part = part.select("seq", "value", *kp, "m", "ts", common.alias("common"))
    part = part.select("seq", "value", *kp, "m", "ts", F.col("common").isNull().alias("no_common"),
                       member_str(F.col("common"), "$.mid").alias("mid"),
                       member_str(F.col("common"), "$.is_new").alias("is_new"))
    reason = (F.when(F.col("m").isNull(), F.lit("not_json"))
               .when(F.col("no_common"), F.lit("no_common"))
               .when(F.col("mid").isNull(), F.lit("no_mid"))
               .when(F.col("ts").isNull(), F.lit("no_ts")))
    visit = ts_to_day(F.col("ts"), tz)
    seed = F.when(F.col("is_new") == "1", visit).otherwise(ts_to_day(F.col("ts") - F.lit(K.DAY_MS), tz))
    out = part.select("seq", "value", *kp, "m", "mid", "is_new", "ts", reason.alias("dirty_reason"),
                      visit.alias("visit_day"), seed.alias("seed_day"))
    return seal(out)


def dirty_lines(tagged: DataFrame) -> DataFrame:
    """The dirty side output: (seq, dirty_reason, value) with the raw line."""
    return tagged.where(F.col("dirty_reason").isNotNull()).select("seq", "dirty_reason", "value")


def first_visits(tagged: DataFrame) -> DataFrame:
    """Per device: the seed date of its first line (by seq) and its row count.

    A partial aggregation: each map task folds its own rows per device before
    the shuffle, so a hot device costs one row per map task on the wire.
    """
    # (good lines always have a mid; stating it keeps the joins' inferred
    # not-null filters identical on every branch, so the shuffle is reused)
    return (tagged.where(F.col("dirty_reason").isNull() & F.col("mid").isNotNull())
            .groupBy("mid")
            .agg(F.min_by("seed_day", "seq").alias("first_visit"),
                 F.count(F.lit(1)).alias("rows")))


def repair_flags(tagged: DataFrame, hot_rows: int = DEFAULT_HOT_ROWS,
                 max_hot_keys: int = DEFAULT_MAX_HOT_KEYS, visits: DataFrame | None = None) -> DataFrame:
    """Adds ``first_visit`` and the repaired ``is_new_fixed`` to every good line.

    Rule (per device, state set once by its first line, never changed):
    first line flagged '1' -> its own date, otherwise the date 24 h earlier;
    a line flagged '1' whose date differs from that state becomes '0'.
    Dirty lines pass through with NULLs. On the way, ``m`` is kept only for
    good lines and ``value`` (the raw text) only for dirty ones. ``visits``
    (mid, first_visit, rows) replaces the lines' own ``first_visits`` where
    earlier lines have set a device's state.
    """
    stats = first_visits(tagged) if visits is None else visits
    hot = (stats.where(F.col("rows") >= F.lit(hot_rows))
           .orderBy(F.col("rows").desc(), F.col("mid"))
           .limit(max_hot_keys)                       # the broadcast's size bound
           .select(F.col("mid").alias("_key"), F.col("first_visit").alias("hot_first_visit")))
    # Dirty lines join on a NULL key: they never meet a device's state.
    t = tagged.withColumn("_key", F.when(F.col("dirty_reason").isNull(), F.col("mid")))
    t = t.join(F.broadcast(hot), "_key", "left")
    spread = F.col("hot_first_visit").isNotNull() | F.col("_key").isNull()
    t = t.withColumn("_salt", F.when(spread, F.xxhash64("seq")).otherwise(F.lit(0).cast("long")))
    # What crosses the shuffle: the parsed object only for good lines, the raw
    # text only for dirty ones (the only place it is emitted), no seed day.
    dirty = F.col("dirty_reason").isNotNull()
    t = (t.withColumn("m", F.when(~dirty, F.col("m")))
          .withColumn("value", F.when(dirty, F.col("value")))
          .drop("seed_day"))
    # ``rows > 0`` always holds; it keeps count(1) alive so this branch's
    # aggregation is identical to the hot branch's and its shuffle is reused
    # (otherwise pruning makes them differ and the topic is parsed again).
    cold = stats.where(F.col("rows") > 0).select(F.col("mid").alias("_key"), "first_visit",
                                                 F.lit(0).cast("long").alias("_salt"))
    j = t.join(cold, ["_key", "_salt"], "left").drop("_key")
    fv = F.coalesce(F.col("hot_first_visit"), F.col("first_visit"))
    fixed = (F.when((F.col("is_new") == "1") & (F.col("visit_day") != fv), F.lit("0"))
              .otherwise(F.col("is_new")))
    return (j.select("*", fixed.alias("is_new_fixed"), fv.alias("_fv"))
             .drop("hot_first_visit", "_salt", "first_visit")
             .withColumnRenamed("_fv", "first_visit"))


def _out(topic: str, pos: Column | None, value: Column) -> Column:
    return F.struct(F.lit(topic).alias("topic"),
                    (pos if pos is not None else F.lit(None)).cast("int").alias("pos"),
                    value.alias("value"))


def route(fixed: DataFrame, displays_key: str = "displays", page_excludes_start: bool = False,
          action_ts: bool = False) -> DataFrame:
    """One pass over repaired lines -> (seq, topic, pos, value).

    As coded in the reproduced job (options give the evidently intended form):
    * ``err`` present -> whole line to the err topic, then ``err`` removed;
    * ``start`` present -> line to the start topic, display/action skipped;
    * otherwise one display record ``{common, page, display, ts}`` per element
      of ``display`` and one action record ``{common, page, action}`` (no ts)
      per element of ``actions``; a non-empty ``actions`` is then removed and,
      when ``display`` is non-empty, the key ``displays`` is removed;
    * every good line (start lines too) goes to the page topic;
    * dirty lines go to ``dirty_data`` as their raw text.
    """
    m = F.col("m")
    common = m.getItem("common")
    changed = F.coalesce(F.col("is_new_fixed") != F.col("is_new"), F.lit(False))
    common_fixed = F.when(changed, with_member(common, "is_new", F.col("is_new_fixed").cast("variant"))
                          ).otherwise(common)
    # the map is rebuilt only for lines whose flag was repaired
    m_fixed = F.when(changed, F.transform_values(
        m, lambda k, v: F.when(k == "common", common_fixed).otherwise(v))).otherwise(m)
    has_err = m.getItem("err").isNotNull()
    has_start = m.getItem("start").isNotNull()
    disp = member_array(m.getItem("display"))
    acts = member_array(m.getItem("actions"))
    disp_on = (~has_start) & F.coalesce(F.size(disp) > 0, F.lit(False))
    acts_on = (~has_start) & F.coalesce(F.size(acts) > 0, F.lit(False))
    # One projection computes the repaired object and the page record once;
    # for a start line the start record *is* the page record (nothing but
    # ``err`` is removed from either), so it reuses the same text.
    staged = fixed.select(
        "seq", "value", "dirty_reason", "m", "ts",
        m_fixed.alias("_m_fixed"), common_fixed.alias("_common"),
        has_err.alias("_has_err"), has_start.alias("_has_start"),
        disp.alias("_disp"), acts.alias("_acts"),
        disp_on.alias("_disp_on"), acts_on.alias("_acts_on"))
    mf = F.col("_m_fixed")
    page_map = without_members(mf, {"err": F.lit(True), "actions": F.col("_acts_on"),
                                    displays_key: F.col("_disp_on")})
    staged = staged.select("*", F.to_json(page_map).alias("_page_json"))

    page = F.col("m").getItem("page")
    ts_v = F.col("ts").cast("variant")
    common_c = F.col("_common")
    singles = F.array(
        F.when(F.col("_has_err"), _out(K.TOPIC_ERR, None, F.to_json(mf))),
        F.when(F.col("_has_start"), _out(K.TOPIC_START, None, F.col("_page_json"))),
        F.when(~(F.col("_has_start") & F.lit(page_excludes_start)),
               _out(K.TOPIC_PAGE, None, F.col("_page_json"))),
    )
    empty = F.from_json(F.lit("[]"), ROUTE_TYPE)
    displays = F.when(F.col("_disp_on"), F.transform(F.col("_disp"), lambda x, i: _out(
        K.TOPIC_DISPLAY, i, to_json_object([("common", common_c), ("page", page),
                                            ("display", x), ("ts", ts_v)])))).otherwise(empty)
    action_fields = lambda x: [("common", common_c), ("page", page), ("action", x)] + (
        [("ts", ts_v)] if action_ts else [])
    actions = F.when(F.col("_acts_on"), F.transform(F.col("_acts"), lambda x, i: _out(
        K.TOPIC_ACTION, i, to_json_object(action_fields(x))))).otherwise(empty)
    good = F.filter(F.concat(singles, displays, actions), lambda x: x.isNotNull())
    dirty = F.array(_out(K.TOPIC_DIRTY, None, F.col("value")))
    outs = F.when(F.col("dirty_reason").isNotNull(), dirty).otherwise(good)
    return staged.select("seq", F.inline(outs))


def run_log_job(lines: DataFrame, tz: str = K.DEFAULT_TZ, hot_rows: int = DEFAULT_HOT_ROWS,
                max_hot_keys: int = DEFAULT_MAX_HOT_KEYS, **route_opts) -> DataFrame:
    """The whole batch log job: (seq, value) -> (seq, topic, pos, value)."""
    tagged = tag_lines(lines, tz=tz)
    return route(repair_flags(tagged, hot_rows, max_hot_keys), **route_opts)
