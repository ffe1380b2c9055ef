"""Operator 13: mixing sources to target weights. Native expressions only.

Sources get shares of all words by weight; no source is asked for more than
``MOST`` times what it has, and what that leaves over is shared out again. The
mix is made of blocks of equally many words. Sainte-Lague apportionment deals
the blocks to the sources: block by block to the highest quotient
target / (2 k - 1), k the blocks a source would then have. The same rule deals
a source's blocks to its shards (documents dealt out by a hash of their id, so
many that a shard has about ``SHARD_ROWS``), which gives every shard an integer
quota. All but the last few quotients of a party are known beforehand to win:
with n parties and K blocks, a party of vote share s ends between
s (K - n/2) - 1/2 and s (K + n/2) + 1/2 blocks, so only the quotients between
these, at most a few a party, are ranked, whatever K is.

A shard's documents stand in a seeded order, repeated without end, cut into
blocks; its quota is that many consecutive blocks from a seeded one on. In
seeded order such a run is as random as any, and it cuts two documents a shard
at most, all others are taken whole. No word is taken more than ``MOST`` times.

The targets and quotas are one row a source and a shard (per ``SHARD_ROWS``
documents); a hot source is spread over its shards. Words run from
one white-space character to the next.

Defined results: a null or empty text has size 0 and takes nothing; a null
source is a source, last in order; a null id is an id; rows that repeat id and
text count each; a table without words has targets 0; an empty one gives no
rows; other columns are only carried where ``keep`` names them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rivulet.llm.common import materialize, read_table, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
#: How often a word may be taken.
MOST = 3
BLOCK_WORDS = 32
SHARD_ROWS = 50_000
SEED = 13


def seeded(seed: int, *parts: Column | str) -> Column:
    """60 bits of a hash of the parts, null or not."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p, F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``src`` (0, 1, .. by source, null last), ``weight`` and ``target``
    to (source, source_size): shares of all words by weight, none above
    ``most`` times its source. Sources whose limit is lowest for their weight
    reach it first; what is left is shared by the weights of the others."""
    ranked = sources.withColumn("src", F.expr("row_number() over (order by source asc nulls last) - 1"))
    weighed = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.expr(f"cast(src % {len(weights)} + 1 as int)")))
    turn = "over (order by source_size / weight, src rows between unbounded preceding and 1 preceding)"
    level = (f"(cast(sum(source_size) over () as double) - {most} * coalesce(sum(source_size) {turn}, 0))"
             f" / (sum(weight) over () - coalesce(sum(weight) {turn}, 0))")
    return (weighed.withColumn("level", F.expr(level)).withColumn("cap", F.expr(f"cast({most} * source_size as double)"))
            .withColumn("full", F.expr("cap <= weight * level"))
            .withColumn("target", F.expr("case when full then cap else weight * max(case when not full then level end) over () end"))
            .drop("level", "cap", "full"))


def highest_quotients(parties: DataFrame, votes: str, seats: str, order: str, by: str | None = None,
                      out: str = "quota") -> DataFrame:
    """Adds ``out``: how many of the ``seats`` of its group ``by`` a party
    gets, one after the other to the highest votes / (2 k - 1); ties go to the
    lower ``order``, a unique key within its group."""
    group = f"partition by {by}" if by else ""
    bounded = (parties.withColumn("__n", F.expr(f"count(*) over ({group})"))
               .withColumn("__share", F.expr(f"{votes} / nullif(cast(sum({votes}) over ({group}) as double), 0)"))
               # one more on either side than the proof needs, for rounding
               .withColumn("__low", F.expr(f"greatest(cast(ceil(coalesce(__share * ({seats} - __n / 2), 0) - 0.5) as bigint) - 1, 0)"))
               .withColumn("__high", F.expr(f"cast(floor(coalesce(__share * ({seats} + __n / 2), 0) + 0.5) as bigint) + 1"))
               .withColumn("__open", F.expr(f"{seats} - sum(__low) over ({group})")))
    asked = (bounded.filter(f"{votes} > 0")
             .select(*([by] if by else []), order, "__open", F.col(votes).alias("__votes"), F.expr("explode(sequence(__low + 1, __high))").alias("__k"))
             .withColumn("__nth", F.expr(f"row_number() over ({group} order by __votes / (2 * __k - 1) desc, {order}, __k)"))
             .filter("__nth <= __open"))
    key = [*([by] if by else []), order]
    won = asked.groupBy(*key).agg(F.count("*").alias("__won"))
    return (bounded.join(won, key, "left").withColumn(out, F.expr(f"case when {votes} > 0 then __low else 0 end + coalesce(__won, 0)"))
            .drop("__n", "__share", "__low", "__high", "__open", "__won"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block_words: int = BLOCK_WORDS,
        shard_rows: int = SHARD_ROWS, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, size, source_size, target, shard, taken and
    ``copies``, the ranges of words (start, end) of every time it is taken;
    then the columns ``keep``."""
    rows = df.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size"),
        seeded(seed, id_col).alias("turn"), F.xxhash64(text_col).alias("tie"),
        F.struct(*[F.col(c) for c in keep]).alias("kept") if keep else F.lit(None).cast("int").alias("kept"))
    rows = materialize(rows, "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    sources = targets(sources, weights, most).withColumn("blocks", F.expr(f"sum(source_size) over () div {block_words}"))
    sources = materialize(highest_quotients(sources, "target", "blocks", "src").select(
        F.col("source").alias("named"), "src", "source_size", "target", "quota",
        F.expr(f"cast(ceil(n_rows / {shard_rows}) as bigint)").alias("n_shards")), "sources")
    placed = (rows.join(sources, F.col("source").eqNullSafe(F.col("named")))
              .withColumn("shard", F.expr("turn % n_shards")))
    shards = placed.groupBy("src", "shard").agg(F.sum("size").alias("shard_size"), F.any_value("quota").alias("quota"))
    shards = highest_quotients(shards, "shard_size", "quota", "shard", "src", "dealt")
    shards = materialize(
        shards.withColumn("n_blocks", F.expr(f"least(dealt, {most} * shard_size div {block_words})"))
        .withColumn("first", seeded(seed, F.lit("block"), "src", "shard") % F.greatest(F.expr(f"cast(ceil(shard_size / {block_words}) as bigint)"), F.lit(1)))
        .select("src", "shard", "shard_size", F.expr(f"first * {block_words}").alias("a"),
                F.expr(f"(first + n_blocks) * {block_words}").alias("b")), "shards")
    # words [a, b) of the shard's endless stream; a document begins at ``at`` of every round
    stood = (placed.drop("quota", "n_shards", "source", "named").join(shards, ["src", "shard"])
             .withColumn("at", F.expr("sum(size) over (partition by src, shard order by turn, id, size, tie"
                                      " rows between unbounded preceding and current row) - size")))
    rounds = "case when size > 0 and b > a then sequence(a div shard_size, (b - 1) div shard_size) else array() end"
    ranges = (f"transform({rounds}, r -> struct(greatest(a - r * shard_size - at, 0) as start,"
              " least(b - r * shard_size - at, size) as end))")
    return (stood.withColumn("copies", F.expr(f"filter({ranges}, c -> c.end > c.start)"))
            .select(F.col("id").alias(id_col), "size", "source_size", "target", "src", "shard",
                    F.expr("aggregate(copies, 0L, (n, c) -> n + c.end - c.start)").alias("taken"), "copies",
                    *[F.col("kept")[c].alias(c) for c in keep]))


def mixed_texts(mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """One row for each time a document of ``mix(keep=(text_col,))`` is taken:
    its text, or the words taken of a cut one, a space between."""
    words = F.slice(F.regexp_extract_all(text_or_empty(text_col), F.lit(WORD), F.lit(0)),
                    (F.col("copy.start") + 1).cast("int"), (F.col("copy.end") - F.col("copy.start")).cast("int"))
    whole = (F.col("copy.start") == 0) & (F.col("copy.end") == F.col("size"))
    return (mixed.withColumn("copy", F.explode("copies"))
            .withColumn(text_col, F.when(whole, F.col(text_col)).otherwise(F.array_join(words, " "))).drop("copy", "copies"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


#: All quotients are ranked, and a source is full if filling all others to its
#: level takes no more than there is.
OP13_SQL = f"""
with docs as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size,
         cast('0x' || substr(md5('{SEED}:' || coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) as turn
  from documents
), sources as (
  select source, cast(sum(size) as bigint) as source_size, count(*) as n_rows,
         row_number() over (order by source nulls last) - 1 as src
  from docs group by source
), weighed as (
  select *, src % 3 + 1 as weight, cast(sum(source_size) over () as bigint) as total from sources
), filled as (
  select w.src, sum(least({MOST} * o.source_size, o.weight * {MOST} * w.source_size / w.weight)) <= any_value(w.total) as is_full
  from weighed w, weighed o group by w.src
), rest as (
  select (any_value(total) - coalesce(sum({MOST} * source_size) filter (where is_full), 0)) / sum(weight) filter (where not is_full) as level
  from weighed join filled using (src)
), aimed as (
  select w.*, case when is_full then cast({MOST} * source_size as double) else weight * level end as target,
         total // {BLOCK_WORDS} as blocks
  from weighed w join filled using (src), rest
), seats as (
  select src, target / (2 * k - 1) as quotient, k, blocks
  from (select src, target, blocks, unnest(range(1, cast(target as bigint) // {BLOCK_WORDS} + 4)) as k from aimed where target > 0)
), dealt as (
  select src, count(*) as quota from (select *, row_number() over (order by quotient desc, src, k) as nth from seats)
  where nth <= blocks group by src
), placed as (
  select d.doc_id, d.size, d.turn, a.src, a.source_size, a.target, coalesce(q.quota, 0) as quota,
         d.turn % cast(ceil(a.n_rows / {SHARD_ROWS}) as bigint) as shard
  from docs d join aimed a on d.source is not distinct from a.source left join dealt q on a.src = q.src
), shards as (
  select src, shard, cast(sum(size) as bigint) as shard_size, any_value(quota) as quota from placed group by src, shard
), shard_seats as (
  select src, shard, quota, shard_size / (2 * k - 1) as quotient, k
  from (select *, unnest(range(1, quota + 1)) as k from shards where shard_size > 0)
), shard_dealt as (
  select src, shard, count(*) as won
  from (select *, row_number() over (partition by src order by quotient desc, shard, k) as nth from shard_seats)
  where nth <= quota group by src, shard
), runs as (
  select s.src, s.shard, shard_size, least(coalesce(won, 0), {MOST} * shard_size // {BLOCK_WORDS}) as n_blocks,
         cast('0x' || substr(md5('{SEED}:block:' || s.src || ':' || s.shard), 1, 15) as bigint)
           % greatest(cast(ceil(shard_size / {BLOCK_WORDS}) as bigint), 1) as first
  from shards s left join shard_dealt d on s.src = d.src and s.shard = d.shard
), stood as (
  select p.*, r.shard_size, r.first * {BLOCK_WORDS} as a, (r.first + r.n_blocks) * {BLOCK_WORDS} as b,
         cast(sum(size) over (partition by p.src, p.shard order by turn, doc_id, size rows unbounded preceding) as bigint) - size as beg
  from placed p join runs r on p.src = r.src and p.shard = r.shard
)
select doc_id, size, source_size, target, cast(case when size = 0 then 0 else
       (b // shard_size - a // shard_size) * size
       + least(greatest(b % shard_size - beg, 0), size) - least(greatest(a % shard_size - beg, 0), size) end as bigint) as taken
from stood
"""
