"""Operator 11: hard negatives by slot-decomposed selection.

An anchor's positives are its best rows of the same label. Each positive asks
for the best rows of other labels whose scores lie in a window below its own
score, and these windows overlap. The upper limits of an anchor's windows,
sorted, cut the scores into disjoint slots: from the highest limit down to the
next, and so on, the last down to the lowest lower limit. Whatever has a
window's upper limit or less lies in its own slot or a later one, so the best
``k`` of each slot hold every answer: combiners keep ``k`` rows a slot, in each
block and across blocks, and the merged best of a slot and all slots after it
(a suffix of the slots in descending order) are a window's best, of which
those above its lower limit are the answer.

The anchors are a stated query set that meets all rows in blocks: rows and
anchors are dealt out into blocks of bounded size, each pair of blocks is one
task of one matrix product, and what leaves a task is ``k`` rows a slot at
most, whatever the block holds. A hot label thus is spread over all blocks.
Scores are whole numbers, taken exactly: by a product in doubles where no sum
can reach 2^53, else in whole numbers of any size, ending at 64 bits.

Defined results: rows without a label or a vector, or with a null or non-finite
component, take no part; an empty vector scores 0; rows meet rows of as many
components only; a row that repeats an id is a row of its own, as positive or
negative of the other, too; null ids come last among equal scores; without
positives or negatives there is no row; an empty table gives an empty one.
Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rivulet.llm.common import groups_for, materialize, read_table
from rivulet.session import parallelism

POSITIVES = 5
NEGATIVES = 3
#: A window reaches from LOW to HIGH percent of its positive's score.
LOW, HIGH = 50, 95
SCALE = 256
ROW_BLOCK = 16_384
ANCHOR_BLOCK = 16_384
#: Scores held at once by a task.
TILE = 1 << 21


def usable(vector: str, label: str) -> Column:
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    return F.col(label).isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two whole-number matrices."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    big = whole(a) @ whole(b).T
    return np.clip(big, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def first_by_score(score: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` highest scores, highest first, of equal ones the
    lower index."""
    at = np.arange(len(score))
    if len(score) > 4 * k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.argsort(-score[at], kind="stable")[:k]]


def best_of_slots(score: np.ndarray, limits: np.ndarray, floor: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(slot, index) of the ``k`` best scores of every slot. ``limits``: the
    distinct upper limits, descending; slot s holds what is at most
    limits[s] and above limits[s + 1], the last one what is at least
    ``floor``."""
    inside = np.flatnonzero((score <= limits[0]) & (score >= floor))
    slot = len(limits) - 1 - np.searchsorted(limits[::-1], score[inside], "left")
    slots, picked = [], []
    for s in np.unique(slot):
        own = inside[slot == s]
        own = own[first_by_score(score[own], k)]
        slots.append(np.full(len(own), s))
        picked.append(own)
    return (np.concatenate(slots), np.concatenate(picked)) if slots else (slot[:0], inside[:0])


def _met(rows: DataFrame, anchors: DataFrame, per_block, out: str) -> DataFrame:
    """``per_block(rows, anchors)`` (Arrow tables, rows in order of their id)
    for each pair of blocks of as many components."""
    spark = rows.sparkSession
    n_rows, n_anchors = rows.count(), anchors.count()
    r = max(groups_for(n_rows, ROW_BLOCK), min(parallelism(spark), groups_for(n_rows, max(1, ROW_BLOCK // 16))))
    a = groups_for(n_anchors, ANCHOR_BLOCK)
    own = F.pmod(F.xxhash64("row"), F.lit(r)).cast("int")
    blank = lambda df, other: [F.lit(None).cast(t).alias(c) for c, t in other.dtypes if c not in df.columns]
    deal = lambda df, other, side, b1, b2: df.select(
        *df.columns, *blank(df, other), F.lit(side).alias("side"), b1.alias("b1"), b2.alias("b2"))
    left = deal(rows, anchors, 0, own, F.explode(F.sequence(F.lit(0), F.lit(a - 1))))
    right = deal(anchors, rows, 1, F.explode(F.sequence(F.lit(0), F.lit(r - 1))), F.pmod(F.xxhash64("row"), F.lit(a)).cast("int"))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table.column("side").to_numpy()
        order = pa.compute.sort_indices(table, sort_keys=[("id", "ascending"), ("row", "ascending")])
        side = side[order.to_numpy()]
        return per_block(table.take(order.filter(pa.array(side == 0))), table.take(order.filter(pa.array(side == 1))))

    return left.unionByName(right).groupBy("dim", "b1", "b2").applyInArrow(run, out)


def _matrix(table: pa.Table) -> np.ndarray:
    dim = table.column("dim")[0].as_py() if table.num_rows else 0
    return table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) if dim \
        else np.zeros((table.num_rows, 0))


def _tiles(rows: pa.Table, anchors: pa.Table):
    """(place of an anchor, its scores with all rows)."""
    x, y = _matrix(rows), _matrix(anchors)
    step = max(1, TILE // max(1, len(x)))
    for i in range(0, len(y), step):
        yield from enumerate(products(y[i:i + step], x), i)


def _codes(rows: pa.Table, anchors: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Labels of any type as numbers."""
    both = pa.chunked_array([*rows.column("label").chunks, *anchors.column("label").chunks],
                            rows.column("label").type).combine_chunks().dictionary_encode()
    codes = both.indices.to_numpy(zero_copy_only=False)
    return codes[:rows.num_rows], codes[rows.num_rows:]


def _picked(rows: pa.Table, anchors: pa.Table, which: list, index: list, score: list, slots: list | None = None) -> pa.Table:
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    index = pa.array(cat(index).astype(np.int64))
    cols = {"anchor": anchors.column("row").take(pa.array(cat(which).astype(np.int64)))}
    cols |= {"slot": pa.array(cat(slots).astype(np.int32))} if slots is not None else {}
    return pa.table(cols | {"score": pa.array(cat(score).astype(np.int64)), "row": rows.column("row").take(index),
                            "id": rows.column("id").take(index)})


def mine(df: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for the rows where ``anchor`` is true. Components are
    taken times ``SCALE``, rounded down."""
    kind = df.schema[id_col].dataType.simpleString()
    rows = materialize(
        df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"),
                  F.coalesce(anchor, F.lit(False)).alias("asks"))
        .filter(usable("vector", "label"))
        .withColumn("vector", F.transform("vector", lambda x: F.floor(x * F.lit(float(SCALE))).cast("double")))
        .withColumn("dim", F.size("vector")).withColumn("row", F.monotonically_increasing_id()), "rows")
    anchors = rows.filter("asks").drop("asks")
    rows = rows.drop("asks")

    def best_positives(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        labels, wanted = _codes(rows, anchors)
        of_label = {c: np.flatnonzero(labels == c) for c in np.unique(wanted)}
        row, own = rows.column("row").to_numpy(), anchors.column("row").to_numpy()
        which, index, score = [], [], []
        for i, s in _tiles(rows, anchors):
            same = of_label[wanted[i]]
            same = same[row[same] != own[i]]
            best = same[first_by_score(s[same], positives)]
            which.append(np.full(len(best), i)), index.append(best), score.append(s[best])
        return _picked(rows, anchors, which, index, score)

    first = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    found = _met(rows, anchors, best_positives, f"anchor long, score long, row long, id {kind}")
    found = (found.withColumn("nth", F.row_number().over(Window.partitionBy("anchor").orderBy(*first))).filter(f"nth <= {positives}")
             .withColumn("upper", F.expr(f"cast(floor(cast(score as decimal(20)) * {high} / 100) as bigint)"))
             .withColumn("lower", F.expr(f"cast(ceil(cast(score as decimal(20)) * {low} / 100) as bigint)"))
             .filter("lower <= upper"))
    found = materialize(found, "positives")
    asked = found.groupBy("anchor").agg(F.reverse(F.array_sort(F.collect_set("upper"))).alias("limits"), F.min("lower").alias("floor"))
    asking = materialize(anchors.join(asked.withColumnRenamed("anchor", "row"), "row"), "asking")

    def best_negatives(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        labels, own = _codes(rows, anchors)
        others = {c: np.flatnonzero(labels != c) for c in np.unique(own)}
        limits, floor = anchors.column("limits").to_pylist(), anchors.column("floor").to_pylist()
        which, index, score, slots = [], [], [], []
        for i, s in _tiles(rows, anchors):
            other = others[own[i]]
            slot, at = best_of_slots(s[other], np.array(limits[i], np.int64), floor[i], negatives)
            slots.append(slot), which.append(np.full(len(at), i)), index.append(other[at]), score.append(s[other[at]])
        return _picked(rows, anchors, which, index, score, slots)

    kept = (_met(rows, asking, best_negatives, f"anchor long, slot int, score long, row long, id {kind}")
            .withColumn("nth", F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(*first))).filter(f"nth <= {negatives}"))
    # slots of an anchor one after the other, best first: a suffix begins at a window's own slot
    ladder = kept.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("slot", "nth", "score", "id"))).alias("ladder"))
    windows = (found.join(asked.drop("floor"), "anchor").join(ladder, "anchor")
               .withColumn("slot", F.array_position("limits", F.col("upper")) - 1))
    answers = windows.withColumn("best", F.expr(f"slice(filter(ladder, x -> x.slot >= slot), 1, {negatives})")).select(
        F.col("anchor").alias("row"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), "lower",
        F.posexplode("best").alias("pos", "x"))
    return (answers.filter("x.score >= lower").join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", (F.col("pos") + 1).alias("rank"), F.col("x.id").alias("negative_id"),
                    "positive_score", F.col("x.score").alias("negative_score")))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each positive of every 50th vector."""
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(moved, F.col("vec_id") % 50 == 0)


OP11_SQL = f"""
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as double)) as e
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
         cast(list_dot_product(a.e, b.e) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
), positives as (
  select * from (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as nth from scored where same)
  where nth <= {POSITIVES}
), ranked as (
  select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
         row_number() over (partition by p.anchor_id, p.vec_id order by n.score desc, n.vec_id) as rank
  from positives p join scored n on p.anchor_id = n.anchor_id and not n.same
   and {LOW} * p.score <= 100 * n.score and 100 * n.score <= {HIGH} * p.score
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from ranked where rank <= {NEGATIVES}
"""
