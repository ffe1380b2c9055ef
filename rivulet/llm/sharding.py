"""Operator 6: resharding as a minimum-cost flow.

Given where rows lie now (``old_shard``) and how many bytes each new shard is
to hold, a transport problem decides how many bytes go from each old shard to
each new one: staying is free, every moved byte costs its way. It is solved by
successive shortest paths on the shards alone (old x new edges), so its size
does not depend on the rows. The flow is then turned into rows: an old shard's
rows stand in blocks, block sizes are summed up, and a row goes where the
middle of its bytes falls among the flow's borders. Rows larger than 1/64 of a
shard (there can be at most 64 per shard) are placed one by one before, so
that borders never cut far from where the flow put them.

The law held is ``bytes``: shard sizes are equal but for half a row at each
border. Equal texts are not kept together; each row is its own group.
Last, the rows of every shard that gains or loses any are written anew.

Defined results: a null text has no bytes (size is the fixed overhead);
null ids, repeated rows and rows that differ in nothing are placed each; an
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from rivulet.llm.common import groups_for, materialize, read_table
from rivulet.session import scratch_path

N_SHARDS = 40
ROW_OVERHEAD = 16
#: Rows larger than 1/LARGE of a new shard's share are placed one by one.
LARGE = 64
BLOCK_ROWS = 50_000


def min_cost_flow(supply: dict[int, int], capacity: dict[int, int], cost=None) -> dict[tuple[int, int], int]:
    """{(old, new): bytes} of least total cost moving all supply within the
    capacities (which must suffice). ``cost(old, new)`` per byte; by default 0
    for the same shard and 1 otherwise. Successive shortest paths with
    potentials over the residual graph."""
    cost = cost or (lambda i, j: int(i != j))
    olds, news = sorted(i for i in supply if supply[i]), sorted(capacity)
    source, sink = "s", "t"
    residual: dict = defaultdict(dict)
    price: dict = {}

    def edge(u, v, cap, c):
        residual[u][v] = cap
        residual[v].setdefault(u, 0)
        price[u, v], price[v, u] = c, -c

    for i in olds:
        edge(source, ("o", i), supply[i], 0)
        for j in news:
            edge(("o", i), ("n", j), supply[i], cost(i, j))
    for j in news:
        edge(("n", j), sink, capacity[j], 0)
    potential = defaultdict(int)
    left = sum(supply[i] for i in olds)
    while left:
        dist, back, heap, tie = {source: 0}, {}, [(0, 0, source)], 0
        while heap:
            d, _, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            for v, cap in residual[u].items():
                if cap > 0:
                    nd = d + price[u, v] + potential[u] - potential[v]
                    if nd < dist.get(v, nd + 1):
                        dist[v], back[v] = nd, u
                        tie += 1
                        heapq.heappush(heap, (nd, tie, v))
        if sink not in dist:
            raise ValueError("the capacities do not hold the supply")
        for v, d in dist.items():
            potential[v] += d
        push, v = left, sink
        while v != source:
            push, v = min(push, residual[back[v]][v]), back[v]
        v = sink
        while v != source:
            u = back[v]
            residual[u][v] -= push
            residual[v][u] += push
            v = u
        left -= push
    return {(i, j): residual["n", j]["o", i] for i in olds for j in news if residual["n", j]["o", i]}


def level(total: int, fixed: dict[int, int]) -> dict[int, int]:
    """What each shard has room for beyond ``fixed`` when ``total`` more bytes
    fill all shards to one level; whole bytes that sum to ``total``."""
    order = sorted(fixed, key=lambda j: (fixed[j], j))
    held, n = 0, 0
    for n, j in enumerate(order, 1):
        held += fixed[j]
        if n == len(order) or (total + held) // n <= fixed[order[n]]:
            break
    top, extra = divmod(total + held, n)
    return {j: max(0, top - fixed[j]) + (1 if k < extra else 0) if k < n else 0
            for k, j in enumerate(order)}


def place_large(rows: list[tuple], shards: int, share: int) -> tuple[dict, dict[int, int]]:
    """Large rows (key, old, size), largest first: each stays where it is
    while its shard is not over its share, else goes to the emptiest."""
    load, where = dict.fromkeys(range(shards), 0), {}
    for key, old, size in sorted(rows, key=lambda r: (-r[2], str(r[0]))):
        to = old if old in load and load[old] + size <= share else min(load, key=lambda j: (load[j], j))
        where[key] = to
        load[to] += size
    return where, load


def text_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_OVERHEAD).cast("long")


def text_crc(text: Column) -> Column:
    return F.coalesce(F.crc32(text), F.lit(0)).cast("long")


def reshard(df: DataFrame, old_shard: Column, shards: int = N_SHARDS, id_col: str = "doc_id",
            text_col: str = "text", cost=None) -> DataFrame:
    """(id, size, text_crc32, old_shard, shard, slot) of every row."""
    spark = df.sparkSession
    text = F.col(text_col).cast("string")
    rows = materialize(df.select(
        F.col(id_col), text_size(text).alias("size"), text_crc(text).alias("text_crc32"),
        F.coalesce(old_shard.cast("int"), F.lit(0)).alias("old_shard")), "rows")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    share = max(1, total // shards)
    n_blocks = groups_for(n, BLOCK_ROWS, 1024)
    key = [id_col, "size", "text_crc32", "old_shard"]
    # equal rows are told apart by a number, which also makes the key unique
    block = F.pmod(F.xxhash64(F.col(id_col), "text_crc32"), F.lit(n_blocks))
    large = F.col("size") * LARGE > share
    big = rows.filter(large).withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0))))
    big_rows = [(tuple(r), r["old_shard"], r["size"]) for r in big.collect()]   # at most LARGE a shard
    where, load = place_large(big_rows, shards, share)

    small = rows.filter(~large).withColumn("block", block)
    by_block = small.groupBy("old_shard", "block").agg(F.sum("size").alias("bytes"))
    supply = {r[0]: r[1] for r in by_block.groupBy("old_shard").agg(F.sum("bytes")).collect()}
    flow = min_cost_flow(supply, level(sum(supply.values()), load), cost)
    cuts: dict[int, list] = {i: [] for i in supply}
    for (i, j), b in sorted(flow.items(), key=lambda x: (x[0][0], x[0][1] != x[0][0], x[0][1])):
        cuts[i].append(((cuts[i][-1][0] if cuts[i] else 0) + b, j))
    table = spark.createDataFrame([(i, c) for i, c in cuts.items()],
                                  "old_shard int, cuts array<struct<until:long,shard:int>>")
    before = by_block.withColumn(
        "before", F.sum("bytes").over(Window.partitionBy("old_shard").orderBy("block")) - F.col("bytes"))
    in_block = Window.partitionBy("block", "old_shard").orderBy(id_col, "size", "text_crc32")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    middle = F.col("before") + F.col("upto") - F.col("size") / 2
    placed = (small.repartition(parts, "block")
              .withColumn("upto", F.sum("size").over(in_block.rowsBetween(Window.unboundedPreceding, 0)))
              .join(before.join(F.broadcast(table), "old_shard").drop("bytes"), ["old_shard", "block"])
              .withColumn("middle", middle)
              .withColumn("shard", F.expr("element_at(filter(cuts, c -> c.until > middle), 1).shard"))
              .select(*key, "shard", "block"))
    big_to = spark.createDataFrame([(*k, j) for k, j in where.items()], T.StructType([*big.schema.fields, T.StructField("shard", T.IntegerType())]))
    placed = materialize(placed.unionByName(big_to.withColumn("block", block).select(*placed.columns)), "placed")

    counts = placed.groupBy("shard", "block").agg(F.count("*").alias("n"))
    ahead = counts.withColumn("ahead", F.sum("n").over(Window.partitionBy("shard").orderBy("block")) - F.col("n")).drop("n")
    numbered = placed.repartition(parts, "block").withColumn(
        "nth", F.row_number().over(Window.partitionBy("block", "shard").orderBy(id_col, "size", "text_crc32", "old_shard")))
    return (numbered.join(ahead, ["shard", "block"])
            .select(*key, "shard", (F.col("ahead") + F.col("nth") - 1).cast("long").alias("slot")))


def affected_shards(placed: DataFrame) -> DataFrame:
    """New shards whose file changes: they gain or lose rows."""
    moved = placed.filter("old_shard <> shard")
    return moved.select("shard").union(moved.select(F.col("old_shard").alias("shard"))).distinct()


def with_places(df: DataFrame, placed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``df`` that ``placed`` names, with new_shard and new_slot. Rows
    equal in id, size and checksum share out their places, each taken once.
    The text crosses one shuffle."""
    def keyed(id_: Column, size: Column, crc: Column) -> dict[str, Column]:
        return {"__id": F.coalesce(id_.cast("string"), F.lit("")), "__no_id": id_.isNull(), "__size": size, "__crc": crc}

    keys = ["__id", "__no_id", "__size", "__crc"]
    places = (placed.select(*[c.alias(k) for k, c in keyed(F.col(id_col), F.col("size"), F.col("text_crc32")).items()],
                            F.struct("shard", "slot").alias("__place"))
              .groupBy(*keys).agg(F.sort_array(F.collect_list("__place")).alias("__places")))
    text = F.col(text_col).cast("string")
    rows = (df.withColumns(keyed(F.col(id_col), text_size(text), text_crc(text)))
            .withColumn("__nth", F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(text)))))
    at = F.expr("get(__places, __nth - 1)")
    return (rows.join(places, keys).withColumn("__at", at).filter("__at is not null")
            .withColumns({"new_shard": F.col("__at.shard"), "new_slot": F.col("__at.slot")})
            .drop(*keys, "__nth", "__places", "__at"))


def rewrite_affected(df: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Writes the rows of every affected shard to ``path`` (a folder a shard,
    its files ordered by slot) and returns the list of rewritten shards.
    Shards that neither gain nor lose rows keep their files."""
    touched = affected_shards(placed)
    rows = with_places(df, placed, id_col, text_col).join(
        F.broadcast(touched.withColumnRenamed("shard", "new_shard")), "new_shard", "left_semi")
    rows.sortWithinPartitions("new_shard", "new_slot").write.partitionBy("new_shard").parquet(path)
    return touched


def read_back(df: DataFrame, placed: DataFrame, touched: DataFrame, path: str, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """All rows as they lie after ``rewrite_affected``: the written shards from
    ``path``, the others from ``df``."""
    shards = {r[0] for r in touched.collect()}
    fields = [f for f in df.schema.fields if f.name not in ("new_shard", "new_slot")]
    schema = T.StructType([*fields, T.StructField("new_slot", T.LongType()), T.StructField("new_shard", T.IntegerType())])
    out = df.sparkSession.read.schema(schema).parquet(path)
    if {r[0] for r in placed.select("shard").distinct().collect()} <= shards:
        return out
    still = with_places(df, placed, id_col, text_col).filter(~F.col("new_shard").isin(list(shards)))
    return out.unionByName(still.select(*out.columns))


def op6_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that landed by source, moved into 40 shards of equal bytes:
    the affected shards are written, and the result is read from them."""
    docs = read_table(spark, sf_dir, "documents")
    landed = F.pmod(F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("string")), F.lit(N_SHARDS))
    placed = materialize(reshard(docs, landed), "resharded")
    path = scratch_path(spark, "shards")
    touched = rewrite_affected(docs, placed, path)
    text = F.col("text").cast("string")
    return read_back(docs, placed, touched, path).select(
        "doc_id", text_size(text).alias("size"), text_crc(text).alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("new_shard").alias("shard"), F.col("new_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.coalesce(landed.cast("int"), F.lit(0)).alias("old_shard"))
