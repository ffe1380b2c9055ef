"""Operator 7: embedding near-duplicates by collision-counting projections.

Vectors of one label link if their cosine is at least ``threshold``. Unit
vectors are projected on many random Gaussian lines. For two unit vectors at
cosine c the difference on a line is normal with variance 2 - 2c, so a window
of ``HALF_WIDTH`` deviations (at the threshold) around a query's value holds a
linked vector with known probability p on every line, independently. Each
line is sorted, the query-centred window is a range of ranks, and collisions
are counted per pair; pairs with at least ``required_count`` collisions - the
binomial quantile that keeps all but ``MISS`` of pairs right at the threshold
- are verified by their cosine in double precision. Pairs of higher cosine
collide more often.

Equal vectors are one class and meet once. Classes are dealt out in the order
of one more line, in blocks of bounded size; two blocks of a label meet in a
task of their own unless they lie further apart on that line than
``ROUTE_WIDTH`` deviations. A task returns link counts and a spanning forest,
never the links.

Defined results: vectors that are null, zero or hold null or non-finite
components, and rows without a label, link with nothing; vectors of different
length do not link; repeated rows are vectors of their own; ids may be null
(a component's id is its smallest non-null one); an empty table gives an empty
one. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.llm.common import groups_for, materialize, read_table
from rivulet.llm.components import Forest, component_labels

THRESHOLD = 0.93
LINES = 32
#: Window half width, in standard deviations of a linked pair's difference.
HALF_WIDTH = 1.5
#: Share of pairs at the threshold that the collision count may miss.
MISS = 0.001
ROUTE_WIDTH = 4.0
BLOCK_ROWS = 2048
SEED = 7


def required_count(lines: int = LINES, half_width: float = HALF_WIDTH, miss: float = MISS) -> int:
    """Largest count that a pair at the threshold reaches with probability
    1 - ``miss``."""
    p, below = math.erf(half_width / math.sqrt(2)), 0.0
    for k in range(lines + 1):
        below += math.comb(lines, k) * p ** k * (1 - p) ** (lines - k)
        if below > miss:
            return k
    return lines


def directions(dim: int, lines: int = LINES) -> np.ndarray:
    """Column 0 deals vectors out; the others count collisions."""
    return np.random.default_rng([SEED, dim]).standard_normal((dim, lines + 1))


def unit_rows(vectors: pa.Array, dim: int) -> np.ndarray:
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)      # no overflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def collisions(a: np.ndarray, b: np.ndarray, half: float) -> np.ndarray:
    """How many of the lines (columns) each row of ``b`` shares a window with
    each row of ``a``."""
    count = np.zeros((len(a), len(b)), np.uint8)
    for j in range(a.shape[1]):
        order = np.argsort(b[:, j], kind="stable")
        rank = np.empty(len(b), np.uint16)
        rank[order] = np.arange(len(b), dtype=np.uint16)
        line = b[order, j]
        low = np.searchsorted(line, a[:, j] - half, "left")
        size = np.searchsorted(line, a[:, j] + half, "right") - low
        # unsigned: ranks before the window wrap around to large numbers
        count += (rank[None, :] - low.astype(np.uint16)[:, None]) < size.astype(np.uint16)[:, None]
    return count


def linked_pairs(x: np.ndarray, y: np.ndarray, same: bool, threshold: float = THRESHOLD,
                 tile: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of linked rows of x and y; i < j if they are the
    same block."""
    lines = directions(x.shape[1])[:, 1:]
    half = HALF_WIDTH * math.sqrt(2 - 2 * threshold)
    need, py = required_count(lines.shape[1]), y @ lines
    for at in range(0, len(x), tile):
        part = x[at:at + tile]
        i, j = np.nonzero(collisions(part @ lines, py, half) >= need)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        ok = np.einsum("ij,ij->i", x[i], y[j]) >= threshold
        yield i[ok], j[ok]


def valid(vector: str, label: str):
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    return (F.col(label).isNotNull() & F.coalesce(
        F.forall(vector, finite) & F.exists(vector, lambda v: v != 0), F.lit(False)))


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id) of every row."""
    rows = materialize(df.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"))
        .withColumn("ok", valid("vector", "label")), "vectors")
    key = ["label", "dim", "k1", "k2"]
    keyed = rows.filter("ok").select("id", "label", "vector", F.size("vector").alias("dim"),
                                     F.xxhash64("vector").alias("k1"), F.xxhash64(F.lit("second"), "vector").alias("k2"))
    classes = (keyed.groupBy(*key).agg(F.min("id").alias("least"), F.count("*").alias("members"),
                                       F.any_value("vector").alias("vector"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = materialize(classes, "classes")
    n = classes.count()

    def deal(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            route = np.zeros(len(dims))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                route[at] = unit_rows(batch.column("vector").take(pa.array(at)), int(d)) @ directions(int(d))[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(route)], [*batch.schema.names, "route"])

    src = classes.select("label", "dim", "cid", "members", "vector")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields)
    dealt = materialize(src.mapInArrow(deal, f"{kinds}, route double")
                        .repartitionByRange(groups_for(n, BLOCK_ROWS), "label", "dim", "route")
                        .withColumn("block", F.spark_partition_id()), "dealt")
    sigma = math.sqrt(2 - 2 * threshold)
    ends = dealt.groupBy("label", "dim", "block").agg(F.min("route").alias("low"), F.max("route").alias("high"))
    left, right = ends.alias("l"), ends.alias("r")
    meet = materialize(left.join(right, ["label", "dim"]).filter(
        (F.col("l.block") <= F.col("r.block")) & (F.col("r.low") - F.col("l.high") <= ROUTE_WIDTH * sigma))
        .select("label", "dim", F.col("l.block").alias("b1"), F.col("r.block").alias("b2")), "meet")
    as_left = dealt.join(meet, (dealt["label"] == meet["label"]) & (dealt["dim"] == meet["dim"]) & (dealt["block"] == meet["b1"]))
    as_right = dealt.join(meet.filter("b1 <> b2"),
                          (dealt["label"] == meet["label"]) & (dealt["dim"] == meet["dim"]) & (dealt["block"] == meet["b2"]))
    pick = lambda d, side: d.select(dealt["label"], dealt["dim"], "b1", "b2", F.lit(side).alias("side"),
                                    "cid", "members", "vector")

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        dim, side = table.column("dim")[0].as_py(), table.column("side").to_numpy()
        same = table.column("b1")[0].as_py() == table.column("b2")[0].as_py()
        x = unit_rows(table.column("vector").combine_chunks(), dim)
        members, cid = table.column("members").to_numpy(), table.column("cid").to_numpy()
        one = np.flatnonzero(side == 0)
        two = one if same else np.flatnonzero(side == 1)
        links, forest = np.zeros(len(x), np.int64), Forest(len(x))
        for i, j in linked_pairs(x[one], x[two], same, threshold):
            i, j = one[i], two[j]
            np.add.at(links, i, members[j])
            np.add.at(links, j, members[i])
            forest.union(i, j)
        own = np.flatnonzero(links)
        return pa.table({"cid": cid[own], "links": links[own], "root": cid[forest.roots(own)]})

    found = materialize(pick(as_left, 0).unionAll(pick(as_right, 1)).groupBy("label", "dim", "b1", "b2")
                        .applyInArrow(compare, "cid long, links long, root long"), "found")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    labels = component_labels(found.select(F.col("cid").alias("a"), F.col("root").alias("b"))).toDF(
        "vertex", "component")
    named = (classes.select(*key, "cid", "least", "members").join(links, "cid", "left")
             .join(labels, F.col("cid") == labels["vertex"], "left")
             .select(*key, "least", (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "cid").alias("component")))
    named = materialize(named, "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = named.join(least, "component").select(*key, "n_links", "component_id")
    linked = keyed.select("id", *key).join(of_class, key).select("id", "n_links", "component_id")
    alone = rows.filter("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionAll(alone).withColumnRenamed("id", id_col)


def op7_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link count and component of every embedding."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
