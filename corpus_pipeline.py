"""A training corpus from raw documents, in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over everything
its predecessor kept; ``run`` writes each result as Parquet in the cluster's
shared folder and reads it back as the next stage's input. All stages but the
last return the columns of ``documents`` in their order (``n_chars`` follows
the text where a stage changes it).

Rows with null text are rejected by the first stage; rows with a null id pass
near-dedup (no id could stand for their group); an empty table stays empty.
Rows that share an id but no near text count as documents of their own; where
no row names a language, all that have letters pass the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.llm.common import materialize, read_table
from rivulet.llm.langid import LEAST_SCORE, UNKNOWN, held_out, predict, train
from rivulet.llm.linededup import dedup_lines
from rivulet.llm.packing import default_tokenizer, pack_documents
from rivulet.llm.secrets import redact
from rivulet.llm.simhash import fingerprint, labelled


def _as_documents(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, its character count made to fit the text."""
    kind = dict(like.dtypes)
    return df.select(*[F.length("text").cast(kind[c]).alias(c) if c == "n_chars" else F.col(c) for c in like.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go; where no row names a
    language there is nothing to recognise, and those without letters go."""
    model = train(docs.filter(~held_out()))
    if model is None:      # the held-out rows may be all that have a language
        model = train(docs)
    if model is None:
        return docs.filter(F.col("text").cast("string").rlike(r"\p{L}"))
    others = tuple(c for c in docs.columns if c != "doc_id")
    named = predict(docs, model, lang_out="__lang", score_out="__score", keep=others)
    return named.filter((F.col("__lang") != UNKNOWN) & (F.col("__score") >= LEAST_SCORE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of three-line windows that occurred before go; the edge of a text
    counts as a line."""
    return _as_documents(dedup_lines(docs), docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest id. Where
    that id repeats, the least fingerprint of the group under it stands for the
    group, so texts that share an id alone count each."""
    found = materialize(labelled(docs), "labelled")
    stays = materialize(found.filter("doc_id = component_id").groupBy("label")
                        .agg(F.min(F.struct("doc_id", "fp")).alias("s"))
                        .select(F.col("s.doc_id").alias("__id"), F.col("s.fp").alias("__fp")), "stays")
    repeated = found.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("__id"))
    unique = stays.join(repeated, "__id", "left_anti")
    named = docs.join(unique, docs["doc_id"] == F.col("__id"), "left_semi")
    # only rows whose id repeats need their fingerprint again
    several = docs.join(repeated, docs["doc_id"] == F.col("__id"), "left_semi").withColumn("__hash", F.xxhash64("text"))
    by_text = fingerprint(several.select(F.struct("doc_id", "__hash").alias("__key"), "text"), "__key").select(
        F.col("__key.doc_id").alias("__id"), F.col("__key.__hash").alias("__hash0"), F.col("fp").alias("__fp"))
    texts = by_text.join(stays, ["__id", "__fp"]).groupBy("__id", "__fp").agg(F.min("__hash0").alias("__hash0"))
    again = (several.join(texts, (F.col("doc_id") == F.col("__id")) & F.col("__hash").eqNullSafe(F.col("__hash0")), "left_semi")
             .dropDuplicates(["doc_id", "__hash"]).drop("__hash"))
    return named.unionByName(again).unionByName(docs.filter("doc_id is null"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return _as_documents(redact(docs), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into windows of 4096 ids; each piece with its ids."""
    return pack_documents(docs, default_tokenizer())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: A trained network and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
