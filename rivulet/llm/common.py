"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rivulet.session import scratch_path

#: Raw text handled at once in a Python worker (a single longer text is still
#: handled whole); bounds worker memory whatever the Arrow batch holds.
CHUNK_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the cluster's shared folder and read it back:
    later steps no longer depend on any executor, and every reader sees the
    same rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | Column = "text") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def slices(batch: pa.RecordBatch, col: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the byte length of ``col`` stays near ``limit``."""
    start, held = 0, 0
    lengths = pa.compute.binary_length(batch.column(col)).to_pylist()
    for i, n in enumerate(lengths):
        held += n or 0
        if held >= limit:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def groups_for(total: int, per_group: int, least: int = 1) -> int:
    """How many groups hold ``total`` units at ``per_group`` units each."""
    return max(least, -(-int(total or 0) // per_group))


def once_per_process(key: str, make: Callable):
    """A Python worker's own copy of something costly to build. Workers serve
    many tasks; functions shipped by value would build it anew in each."""
    state = sys.modules.setdefault("_rivulet_worker_state", types.ModuleType("_rivulet_worker_state"))
    if key not in state.__dict__:
        state.__dict__[key] = make()
    return state.__dict__[key]
