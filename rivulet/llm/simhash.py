"""Operator 4: SimHash near-duplicates by pivot distance tables.

The fingerprint of a text is the bitwise majority of the XXH64 hashes of its
4-word shingles (words are maximal runs without ASCII white space, A-Z in
lower case). Two texts link if their fingerprints differ in at most 4 bits.

Search works on distinct fingerprints. Each is placed under several keys: the
64 bits are cut into 4 + k blocks, and two fingerprints within 4 bits agree on
at least k whole blocks, so every link meets under one of the choices of k
blocks; k grows with the number of fingerprints so that groups stay small at
any size. Inside a group the distances to fixed reference fingerprints are
tabled. By the triangle inequality a pair within 4 bits differs by at most 4
in every coordinate; pairs with a larger maximum coordinate difference are
discarded and the survivors verified by their real distance.

A group larger than ``GROUP_ROWS`` is dealt out: its members are cut into
parts by hash and every two parts meet in a task of their own, so nothing is
dropped and no task sees the whole group. A task returns a spanning forest of
the links it finds, not the links, so output stays linear in its input.

Defined results: a text with no words (or null) has fingerprint zero and
links like any other; fewer than 4 words are one shingle; repeated rows get
the same result; ids may be null (a component's id is its smallest non-null
id); an empty table gives an empty one. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.llm.common import groups_for, materialize, read_table, slices, text_or_empty
from rivulet.llm.components import Forest, component_labels

WORDS = 4
SEED = 42
MAX_BITS = 4
#: Reference fingerprints of the distance table.
REFERENCES = 16
#: Largest group compared in one task; larger ones are cut into parts.
GROUP_ROWS = 4096
#: Pairs examined at once inside a task.
PAIRS_AT_ONCE = 1 << 20


def fingerprints_of(texts: list[bytes], words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """Unsigned 64-bit fingerprints of UTF-8 texts."""
    from xxhash import xxh64_intdigest

    out = np.zeros(len(texts), np.uint64)
    for row, text in enumerate(texts):
        tokens = text.lower().split()        # on bytes: A-Z and ASCII white space only
        if not tokens:
            continue
        joined = b" ".join(tokens)
        ends, at = [], -1
        for t in tokens:
            at += len(t) + 1
            ends.append(at)
        last = ends[words - 1:] or ends[-1:]
        first = [0, *(e + 1 for e in ends)]
        hashes = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in zip(first, last)], np.uint64)
        ones = np.zeros(64, np.int64)
        for i in range(0, len(hashes), 1 << 17):
            bits = np.unpackbits(hashes[i:i + (1 << 17)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(0, dtype=np.int64)
        out[row] = np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0]
    return out


def fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, fp long): the fingerprint as a signed 64-bit number."""
    src = df.select(F.col(id_col), F.encode(text_or_empty(text_col), "UTF-8").alias("__text"))
    kind = src.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                fps = fingerprints_of(part.column(1).to_pylist(), words)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64))], [id_col, "fp"])

    return src.mapInArrow(run, f"`{id_col}` {kind}, fp long")


def key_masks(n: int, max_bits: int = MAX_BITS, per_group: int = 64) -> list[int]:
    """Bit masks of the keys: all choices of k of max_bits + k blocks, with
    the least k whose keys spread ``n`` uniform fingerprints to groups of
    about ``per_group``."""
    need = max(0.0, math.log2(max(n, 1) / per_group))
    k = 1
    while 64 * k // (max_bits + k) < need and max_bits + k < 32:
        k += 1
    n_blocks = max_bits + k
    borders = [64 * i // n_blocks for i in range(n_blocks + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(borders, borders[1:])]
    return [sum(c) for c in combinations(blocks, k)]


def references(count: int = REFERENCES) -> np.ndarray:
    return np.random.default_rng(20).integers(0, 1 << 64, count, np.uint64, endpoint=False)


def linked_within(group: np.ndarray, fps: np.ndarray, refs: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """For each row the row that stands for its links inside its group:
    rows joined by a chain of links of one group get the same one."""
    table = np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int16)
    order = np.lexsort((table[:, 0], group))
    group, fps, table = group[order], fps[order], table[order]
    _, index = np.unique(group, return_inverse=True)
    code = index.astype(np.int64) * 256 + table[:, 0]
    # rows after i in its group whose first coordinate is at most max_bits more
    until = np.searchsorted(code, code + max_bits, "right")
    count = until - np.arange(len(code)) - 1
    forest, total = Forest(len(code)), np.concatenate([[0], np.cumsum(count)])
    i = 0
    while i < len(code):
        j = max(i + 1, int(np.searchsorted(total, total[i] + PAIRS_AT_ONCE, "right")) - 1)
        c = count[i:j]
        a = np.repeat(np.arange(i, j), c)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(c) - c, c)
        for p in range(1, table.shape[1]):
            near = np.abs(table[a, p] - table[b, p]) <= max_bits
            a, b = a[near], b[near]
        near = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
        forest.union(a[near], b[near])
        i = j
    roots = np.empty(len(order), np.int64)
    roots[order] = order[forest.roots(np.arange(len(order)))]
    return roots


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) whose connected components are those of all pairs of
    ``distinct.fp`` within ``max_bits`` bits."""
    spark = distinct.sparkSession
    n = distinct.count()
    masks = key_masks(n, max_bits)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    placed = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("which"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(signed)])).alias("k")).select("fp", "k.which", "k.key")
    sizes = placed.groupBy("which", "key").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP_ROWS)
    large = materialize(sizes.select("which", "key", F.ceil(F.col("n") * 2 / GROUP_ROWS).cast("int").alias("cut")), "large")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.coalesce(F.col("cut"), F.lit(1))).cast("int")
    dealt = (placed.join(large, ["which", "key"], "left").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("cut") - 1, F.lit(0)))))
             .select("which", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp"))
    keys = ["which", "key", "low", "high"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), groups_for(n * len(masks), 500_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs, held = references(), None

        def links(rows: pa.Table) -> pa.RecordBatch:
            cols = [rows.column(k).to_numpy() for k in keys]
            change = np.zeros(len(rows), bool)
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            fps = rows.column("fp").to_numpy()
            roots = linked_within(np.cumsum(change), fps.view(np.uint64), refs, max_bits)
            own = np.flatnonzero(roots != np.arange(len(roots)))
            return pa.RecordBatch.from_arrays([pa.array(fps[own]), pa.array(fps[roots[own]])], ["a", "b"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            last = rows.slice(len(rows) - 1, 1).to_pylist()[0]
            same = np.ones(len(rows), bool)
            for k in keys:
                same &= rows.column(k).to_numpy() == last[k]
            cut = int(np.argmax(same))                # the last group may go on
            held = rows.slice(cut).combine_chunks()
            if cut:
                yield links(rows.slice(0, cut))
        if held is not None and len(held):
            yield links(held)

    return (dealt.repartition(parts, *keys).sortWithinPartitions(*keys)
            .mapInArrow(run, "a long, b long"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fp, component_id) of every row."""
    return labelled(df, id_col, text_col, words, max_bits).drop("label")


def labelled(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``near_duplicates`` with the component's own label, which ids that
    repeat do not blur."""
    marked = materialize(fingerprint(df, id_col, text_col, words), "fingerprints")
    by_fp = materialize(marked.groupBy("fp").agg(F.min(id_col).alias("least")), "by_fp")
    labels = component_labels(near_links(by_fp.select("fp"), max_bits))
    named = by_fp.join(labels, by_fp["fp"] == labels["vertex"], "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of_fp = named.join(least, "label").select("fp", "component_id", "label")
    return marked.join(of_fp, "fp").select(id_col, "fp", "component_id", "label")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
