"""Operator 8: quality rules with n-gram perplexity bands.

The language model is a modified Kneser-Ney model over characters (lower case,
digits as 0, white space collapsed), one per language. Tasks count the n-grams
of their documents, Spark adds them up over the whole corpus, and every order
is a grouped table: counts of the highest order, continuation counts below,
discounts from counts of counts, context totals, and the interpolated
probability of each n-gram by joins with its context and its suffix. An n-gram
is packed into a 64-bit number of 16 bits a UTF-16 unit, so context and suffix
are shifts and masks, and no two n-grams or languages share a key.

For scoring, a model of up to ``BROADCAST_GRAMS`` n-grams is broadcast as
arrays sorted by n-gram; a larger one stays a table, which the n-grams counted
in each document meet in a shuffled join. Both give the same values.
A document's perplexity is the mean over all its characters; per language the
quartiles of all documents give a lower and an upper band, and documents
outside are rejected.

Words would be the wrong unit here: this corpus has nearly as many distinct
word bigrams as words, and shuffling them exceeds the disk allowed for it.

Defined results: a null or empty text has no words, fails the base rules and
has perplexity null; a missing language is a language of its own; repeated
rows count and are scored each; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rivulet.llm.common import materialize, read_table, slices, text_or_empty

ORDER = 4
#: N-grams are of UTF-16 units, so a key of 64 bits holds any four of them.
CHAR_BITS = 16
FOLD = (1 << CHAR_BITS) - 1
#: Stands before a text's first character. No text has this half of a surrogate
#: pair without the other one after it, so no n-gram of a text has it there.
EDGE = 0xD800
#: N-grams a task holds before it passes on their counts.
HELD_GRAMS = 6_000_000
#: A model of more n-grams is not broadcast but joined.
BROADCAST_GRAMS = 4_000_000
#: Bands lie this many interquartile widths outside the quartiles of
#: log-perplexity: at 3, they reject 28 of sf0.1's 3302 texts that pass the base
#: rules and are labelled good (at 2 it is 62, at 4 19, at 5 10). Where all texts
#: are equally likely the width is no less than what rounding may make of it.
BAND, LEAST_WIDTH = 3.0, 1e-6
LEAST_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 20, 8, 30
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\v\f\r"


# ------------------------------------------------------------ n-grams of text

def char_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-16 units of all texts, ORDER - 1 edge marks before each, and where
    each begins."""
    lead = np.array([EDGE] * (ORDER - 1), "<u2").tobytes()
    clean = [lead + re.sub(r"\d", "0", " ".join(t.lower().split())).encode("utf-16-le", "replace") for t in texts]
    size = np.array([len(c) // 2 for c in clean], np.int64)
    return np.frombuffer(b"".join(clean), "<u2").astype(np.uint64), np.cumsum(size) - size


def packed_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams that end at each unit of the texts, in order, and how
    many each text has."""
    codes, begin = char_codes(texts)
    grams = np.zeros(max(0, len(codes) - ORDER + 1), np.uint64)
    for i in range(ORDER):
        grams = grams << np.uint64(CHAR_BITS) | codes[i:i + len(grams)]
    # an n-gram across two texts would end in a leading mark, known by its place
    inside = np.ones(len(codes), bool)
    for i in range(ORDER - 1):
        inside[begin + i] = False
    until = np.append(begin[1:], len(codes))
    return grams[inside[ORDER - 1:]].view(np.int64), until - begin - (ORDER - 1)


def lang_name(lang: Column) -> Column:
    return F.coalesce(lang.cast("string"), F.lit("und"))


def count_grams(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, g, c): counts of the highest order over all of ``df``."""
    src = df.select(lang_name(F.col(lang_col)).alias("lang"), text_or_empty(text_col).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def flush(lang: str) -> pa.RecordBatch:
            grams, counts = (np.concatenate(x) for x in zip(*held.pop(lang)))
            found, at = np.unique(grams, return_inverse=True)
            total = np.bincount(at, counts, len(found)).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang]).take(pa.array(np.zeros(len(found), np.int64))), pa.array(found), pa.array(total)],
                ["lang", "g", "c"])

        for batch in batches:
            for part in slices(batch, "__text"):
                for lang in part.column(0).unique().to_pylist():
                    texts = part.column(1).filter(pa.compute.equal(part.column(0), lang)).to_pylist()
                    held.setdefault(lang, []).append(np.unique(packed_grams(texts)[0], return_counts=True))
                if sum(len(g) for x in held.values() for g, _ in x) > HELD_GRAMS:
                    for lang in list(held):
                        yield flush(lang)
        for lang in list(held):
            yield flush(lang)

    return (src.mapInArrow(run, "lang string, g long, c long").groupBy("lang", "g").agg(F.sum("c").alias("c")))


# ------------------------------------------------------- modified Kneser-Ney

def discounts(grams: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) of one order, from its counts of counts."""
    n = [F.count_if(F.col("c") == k).cast("double") for k in (1, 2, 3, 4)]
    y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))
    part = lambda k, a, b: F.least(F.lit(float(k)), F.greatest(
        F.lit(0.1), k - (k + 1) * y * F.col(b) / F.greatest(F.col(a), F.lit(1.0))))
    return (grams.groupBy("lang").agg(*[x.alias(f"n{i + 1}") for i, x in enumerate(n)])
            .select("lang", part(1, "n1", "n2").alias("d1"), part(2, "n2", "n3").alias("d2"),
                    part(3, "n3", "n4").alias("d3")))


def probabilities(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, g, c, p): interpolated probability of every n-gram of the
    highest order. Discounts have a row a language, which bounds their
    broadcast."""
    tables = {order: grams}
    for k in range(order - 1, 0, -1):
        mask = (1 << CHAR_BITS * k) - 1
        tables[k] = materialize(tables[k + 1].groupBy("lang", F.col("g").bitwiseAND(F.lit(mask)).alias("g"))
                                .agg(F.count("*").alias("c")), f"order{k}")
    # below all orders: every character is as likely
    lower = tables[1].groupBy("lang").agg((1 / (F.count("*") + 1)).alias("p_low"))
    on = ["lang"]
    out = None
    for k in range(1, order + 1):
        cut = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = (tables[k].join(F.broadcast(discounts(tables[k])), "lang")
                .withColumn("d", F.least(cut, F.col("c").cast("double")))
                .withColumn("ctx", F.shiftright("g", CHAR_BITS)))
        totals = rows.groupBy("lang", "ctx").agg(F.sum("c").alias("total"), F.sum("d").alias("spare"))
        low = F.broadcast(lower) if k == 1 else lower.withColumnRenamed("g", "low")
        joined = (rows.withColumn("low", F.col("g").bitwiseAND(F.lit((1 << CHAR_BITS * (k - 1)) - 1)))
                  .join(totals, ["lang", "ctx"]).join(low, on))
        out = materialize(joined.select(
            "lang", "g", "c", ((F.col("c") - F.col("d") + F.col("spare") * F.col("p_low")) / F.col("total")).alias("p")), f"p{k}")
        lower, on = out.select("lang", "g", F.col("p").alias("p_low")), ["lang", "low"]
    return out


def log_probabilities(probs: DataFrame) -> DataFrame:
    return probs.select("lang", "g", F.log("p").cast("float").alias("lp"))


def sorted_arrays(probs: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """A small model as {language: (sorted n-grams, log-probabilities)}."""
    table = log_probabilities(probs).toArrow().combine_chunks()
    out = {}
    for lang in table.column("lang").unique().to_pylist():
        own = table.filter(pa.compute.equal(table.column("lang"), lang))
        g, lp = own.column("g").to_numpy(), own.column("lp").to_numpy()
        order = np.argsort(g)
        out[lang] = g[order], lp[order]
    return out


# ------------------------------------------------------------------- scoring

def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode("utf-8", "replace").split()
    chars = len(text) - sum(text.count(c) for c in SPACE)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words in windows that occur twice or more. Windows get numbers that are
    equal exactly if their words are, by doubling their length."""
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == len(words):
        return 0
    span = 1
    while span < window:
        pair = ids[:-span] * (ids.max() + 1) + ids[span:]
        _, ids, count = np.unique(pair, return_inverse=True, return_counts=True)
        if count.max() == 1:
            return 0
        span *= 2
    at = np.flatnonzero(count[ids] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def score(df: DataFrame, probs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """(id, lang, the base counts, log_perplexity) of every row. Both ways
    look up every n-gram by its full key and give the same values."""
    if probs.count() > BROADCAST_GRAMS:
        return score_by_join(df, probs, id_col, text_col, lang_col)
    src = df.select(F.col(id_col), lang_name(F.col(lang_col)).alias("lang"), text_or_empty(text_col).alias("__text"))
    shared = df.sparkSession.sparkContext.broadcast(sorted_arrays(probs))
    kind = src.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, "__text"):
                texts = part.column(2).to_pylist()
                ppl, has = np.zeros(len(texts)), np.zeros(len(texts), bool)
                for lang in part.column(1).unique().to_pylist():
                    rows = np.flatnonzero(pa.compute.equal(part.column(1), lang).to_numpy(zero_copy_only=False))
                    grams, size = packed_grams([texts[i] for i in rows])
                    if len(grams):
                        keys, logs = model[lang]
                        upto = np.concatenate([[0.0], np.cumsum(logs[np.searchsorted(keys, grams)].astype(np.float64))])
                        ends = np.cumsum(size)
                        ppl[rows], has[rows] = (upto[ends - size] - upto[ends]) / np.maximum(size, 1), size > 0
                base = list(zip(*map(base_counts, texts))) or [()] * len(COUNTS)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(c, pa.int64()) for c in base), pa.array(ppl, mask=~has)],
                    [id_col, "lang", *COUNTS, "log_perplexity"])

    return src.mapInArrow(run, f"`{id_col}` {kind}, lang string, " + ", ".join(f"{c} long" for c in COUNTS) + ", log_perplexity double")


def score_by_join(df: DataFrame, probs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """``score`` for a model of any size: each document's n-grams are counted
    and meet the model in a shuffled join, then add up by document."""
    src = df.select(F.col(id_col), lang_name(F.col(lang_col)).alias("lang"), text_or_empty(text_col).alias("__text"))
    kind = src.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                texts = part.column(2).to_pylist()
                base = list(zip(*map(base_counts, texts))) or [()] * len(COUNTS)
                grams, size = packed_grams(texts)
                own = [np.unique(x, return_counts=True) for x in np.split(grams, np.cumsum(size)[:-1])]
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(g) for g, _ in own])]), pa.int32())
                values = [np.concatenate(x) for x in zip(*own)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(c, pa.int64()) for c in base), pa.array(size),
                     *(pa.ListArray.from_arrays(offsets, pa.array(v, pa.int64())) for v in values)],
                    [id_col, "lang", *COUNTS, "size", "g", "n"])

    counted = materialize(
        src.mapInArrow(run, f"`{id_col}` {kind}, lang string, " + ", ".join(f"{c} long" for c in COUNTS)
                       + ", size long, g array<long>, n array<long>")
        .withColumn("__row", F.monotonically_increasing_id()), "counted")
    model = log_probabilities(probs)
    sums = (counted.select("__row", "lang", F.inline(F.arrays_zip("g", "n")))
            .join(model.hint("shuffle_hash"), ["lang", "g"]).groupBy("__row")
            .agg(F.sum(F.col("n") * F.col("lp").cast("double")).alias("__sum")))
    return (counted.drop("g", "n").join(sums, "__row", "left")
            .select(id_col, "lang", *COUNTS, (-F.col("__sum") / F.col("size")).alias("log_perplexity")))


def bands(scored: DataFrame) -> DataFrame:
    """(lang, low, high) of log-perplexity, from all documents."""
    width = F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(LEAST_WIDTH)) * BAND
    return (scored.groupBy("lang").agg(F.percentile_approx("log_perplexity", [0.25, 0.75], 1000).alias("q"))
            .select("lang", (F.col("q")[0] - width).alias("low"), (F.col("q")[1] + width).alias("high")))


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts, perplexity, bands and verdict of every row."""
    probs = probabilities(materialize(count_grams(df, text_col, lang_col), "grams"))
    scored = materialize(score(df, probs, id_col, text_col, lang_col), "scored")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    inside = F.coalesce(F.col("log_perplexity").between(F.col("low"), F.col("high")), F.lit(True))
    return (scored.join(F.broadcast(bands(scored)), "lang").withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & inside).drop("lang"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict of every document."""
    return judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "log_perplexity", "low", "high")
