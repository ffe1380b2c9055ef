"""Operator 12: ranked lexical search without random access (NRA).

A term in a document has an impact, its part of the score. Documents are dealt
out as they lie in their files; a task keeps the postings of a bounded number
of them (a shard) as one list a term, sorted by impact. For every item, all its
lists are read from the top, some entries at a time: what a document has been
seen with is the lower end of its score, that plus the next unread impact of
every list it has not been seen in is the upper end. A document whose upper
end falls below the k-th best lower end, or below the k-th score of the task's
earlier shards, is out; once the next impacts together are below it, no unseen
document can come in. Reading goes on until every document still in is read
out: its ends meet, so that membership, ties and scores are exact. The best k
of all tasks then meet in one grouped ranking.

The items are a stated query set, read in blocks of bounded text; a block's
vocabulary is broadcast, and every document is cut into terms once a block and
written as (term, count) of the terms that the block asks for. Corpus counts
come from all documents. A frequent term's list is as long as the
shard has documents, wherever it is frequent.

Defined results: a null text has no term and is no document of the counts; a
null item text asks for nothing; items that repeat an id are ranked each;
documents that repeat an id count each; null ids come last among equal scores;
an empty table of documents or items gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rivulet.llm.common import materialize, read_table, slices, text_or_empty

TOP = 10
#: Text of the items that are searched for in one pass over the documents.
BLOCK_BYTES = 1 << 20
#: Postings of a shard (one longer document is a shard by itself).
SHARD_POSTINGS = 1 << 21
#: Entries read of every list in the first round; each further round reads
#: ``GROWTH`` times as many.
FIRST_READ = 256
GROWTH = 4
#: Bytes of terms: digits, letters and all of characters beyond ASCII.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def length_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    if 90 * int(n.max(initial=0)) * n_docs < 1 << 63:
        return 10 + (90 * n * n_docs) // n_terms
    return np.array([10 + 90 * int(x) * n_docs // n_terms for x in n], np.int64)


# ---------------------------------------------------------------- postings

def postings(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, counts) of every document with a term: how many terms it
    has, and those of the vocabulary (by number) with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = {t: i for i, t in enumerate(shared.value)}.get
        size = max(1, len(shared.value))
        for batch in batches:
            for part in slices(batch, "__text"):
                lengths, numbers = [], []
                for text in part.column(1).cast(pa.binary()):
                    words = terms(text.as_py())
                    lengths.append(len(words))
                    numbers.append(np.array([x for x in map(get, words) if x is not None], np.int64))
                doc = np.repeat(np.arange(len(numbers)), [len(x) for x in numbers])
                pair, count = np.unique(doc * size + np.concatenate(numbers or [doc]), return_counts=True)
                ends = np.searchsorted(pair, np.arange(len(numbers) + 1) * size)
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lengths, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(pair % size, pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(count, pa.int32()))], ["id", "n", "terms", "counts"])

    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("__text"))
    return src.mapInArrow(run, f"id {kind}, n long, terms array<int>, counts array<int>").filter("n > 0")


def document_frequencies(stored: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "df"])

    out = np.zeros(size, np.int64)
    for r in stored.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


# ------------------------------------------------------------------ search

class Shard:
    """Impact-sorted lists of some documents."""

    def __init__(self, tables: list[pa.Table], weights: np.ndarray, n_docs: int, n_terms: int):
        table = pa.concat_tables(tables).combine_chunks()
        self.ids = table.column("id").combine_chunks()
        n, lists = table.column("n").to_numpy(), table.column("terms").combine_chunks()
        term = lists.flatten().to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(n)), pa.compute.list_value_length(lists).to_numpy())
        tf = table.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
        impact = impacts(weights[term], tf, length_norm(n, n_docs, n_terms)[doc])
        used = np.flatnonzero(impact > 0)
        order = used[np.lexsort((-impact[used], term[used]))]
        self.doc, self.impact, term = doc[order], impact[order], term[order]
        self.begin = np.searchsorted(term, np.arange(len(weights) + 1))
        rank = pa.compute.sort_indices(self.ids, null_placement="at_end").to_numpy()
        self.id_rank = np.empty(len(n), np.int64)      # order among equal scores
        self.id_rank[rank] = np.arange(len(n))

    def search(self, asked: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the best ``k`` that score ``least`` or more
        (with all of the lowest score's ties that could be among them)."""
        at, end = self.begin[asked], self.begin[asked + 1]
        at, end = at[end > at], end[end > at]
        low = np.zeros(len(self.id_rank), np.int64)
        seen = np.zeros(len(low), bool)
        read: list[tuple[np.ndarray, np.ndarray]] = []       # documents and list numbers of entries read
        still = None                                         # documents that are in; None: any
        size, bar = FIRST_READ, least
        while len(at):
            stop = np.minimum(end, at + size)
            count = stop - at
            entry = np.repeat(at - np.cumsum(count) + count, count) + np.arange(count.sum())
            which = np.repeat(np.arange(len(at)), count)
            doc = self.doc[entry]
            if still is not None:
                own = still[doc]
                entry, which, doc = entry[own], which[own], doc[own]
            np.add.at(low, doc, self.impact[entry])
            seen[doc] = True
            read.append((doc, which))
            at = stop
            following = np.where(at < end, self.impact[np.minimum(at, len(self.impact) - 1)], 0)
            total = int(following.sum())
            found = np.flatnonzero(seen if still is None else still)
            if len(found) >= k:
                bar = max(bar, int(np.partition(low[found], len(found) - k)[len(found) - k]))
            known = np.zeros(len(low), np.int64)             # next impacts of lists a document was seen in
            for d, w in read:
                np.add.at(known, d, following[w])
            high = low[found] + total - known[found]
            inside = found[high >= bar]
            if total < bar:                                  # nothing unseen can come in
                still = np.zeros(len(low), bool)
                still[inside] = True
                if not len(inside) or bool((known[inside] == total).all()):
                    break
            if total == 0:
                break
            size *= GROWTH
        else:
            inside = np.flatnonzero(seen)
        inside = inside[low[inside] >= bar] if len(inside) else inside
        best = inside[np.lexsort((self.id_rank[inside], -low[inside]))[:k]]
        return best, low[best]


def _better(row: tuple) -> tuple:
    return (-row[0], row[1] is None, row[1] if row[1] is not None else 0)


def best_of_tasks(stored: DataFrame, items: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int,
                  k: int) -> DataFrame:
    """(item, id, score): the best ``k`` of every task. ``items``: the numbers
    of the terms of each."""
    shared = stored.sparkSession.sparkContext.broadcast((items, weights))
    kind = stored.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = shared.value
        top: list[list[tuple]] = [[] for _ in asked]
        held: list[pa.Table] = []
        id_type = None

        def search() -> None:
            shard = Shard(held, weights, n_docs, n_terms)
            for i, of_item in enumerate(asked):
                doc, score = shard.search(of_item, k, top[i][-1][0] if len(top[i]) == k else 1)
                if len(doc):
                    new = zip(score.tolist(), shard.ids.take(pa.array(doc)).to_pylist())
                    top[i] = sorted([*top[i], *new], key=_better)[:k]
            held.clear()

        n = 0
        for batch in batches:
            id_type = batch.schema.field("id").type
            at, until = 0, np.cumsum(pa.compute.list_value_length(batch.column("terms")).to_numpy())
            while at < batch.num_rows:
                room = SHARD_POSTINGS - n + (until[at - 1] if at else 0)
                stop = max(at if held else at + 1, int(np.searchsorted(until, room, "right")))
                held += [pa.Table.from_batches([batch.slice(at, stop - at)])] if stop > at else []
                n += int(until[stop - 1] - (until[at - 1] if at else 0)) if stop > at else 0
                at = stop
                if at < batch.num_rows:
                    search()
                    n = 0
        if held:
            search()
        rows = [(i, d, s) for i, found in enumerate(top) for s, d in found]
        if rows:
            item, ids, score = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, id_type), pa.array(score, pa.int64())],
                                             ["item", "id", "score"])

    return stored.mapInArrow(run, f"item int, id {kind}, score long")


def _blocks(items: DataFrame, limit: int) -> Iterator[list]:
    held, size = [], 0
    for row in items.toLocalIterator():
        held.append(row)
        size += len(row["text"].encode())
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", k: int = TOP) -> DataFrame:
    """(item_id, rank, id, score): the ``k`` best documents of every item."""
    spark = docs.sparkSession
    queries = items.select(F.col(item_col).alias("item_id"), text_or_empty(item_text_col).alias("text"))
    item_type = queries.schema["item_id"].dataType
    out = None
    for block in _blocks(queries, BLOCK_BYTES):
        asked = [sorted(set(terms(r["text"].encode()))) for r in block]
        vocabulary = sorted(set().union(*asked))
        number = {t: i for i, t in enumerate(vocabulary)}
        stored = materialize(postings(docs, vocabulary, id_col, text_col), "postings")
        n_docs, n_terms = stored.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        frequency = document_frequencies(stored, len(vocabulary))
        weights = np.array([weight(n_docs, int(df)) for df in frequency], np.int64)
        numbers = [np.array([number[t] for t in a], np.int64) for a in asked]
        found = best_of_tasks(stored, numbers, weights, n_docs, n_terms, k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        named = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)],
                                      "item int, item_id " + item_type.simpleString())
        best = materialize(ranked.join(F.broadcast(named), "item").select("item_id", "rank", "id", "score"), "ranked")
        out = best if out is None else out.unionByName(best)
    if out is None:
        out = queries.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(None).cast(docs.schema[id_col].dataType).alias("id"),
                                      F.lit(0).cast("long").alias("score"))
    return out.withColumnRenamed("id", id_col).withColumnRenamed("item_id", item_col)


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP12_SQL = rf"""
with terms as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents
), tfs as (
  select doc_id, term, count(*) as tf, sum(count(*)) over (partition by doc_id) as n from terms group by doc_id, term
), totals as (
  select cast(count(distinct doc_id) as bigint) as nd, cast(count(*) as bigint) as l from terms
), dfs as (
  select term, cast(floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1))) as bigint) as w from tfs, totals group by term
), asked as (
  select distinct item_id, term from (
    select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
), scored as (
  select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + ((90 * n * nd) // l))))) as bigint) as score
  from asked join tfs using (term) join dfs using (term), totals group by item_id, doc_id
), ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score
  from scored where score > 0
)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= {TOP}
"""
