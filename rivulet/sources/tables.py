"""Table sources and sinks (batch): config snapshot reads, partitioned landing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.operators.configs import CONFIG_FIELDS


def read_config_table(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                      options: dict | None = None) -> DataFrame:
    """Snapshot read of the routing config table (all rows, config columns).

    ``fmt='jdbc'`` with ``options`` (url, dbtable, user, ...) reads the live
    database table; files are read with ``fmt`` from ``path``.
    """
    r = spark.read.format(fmt).options(**(options or {}))
    df = r.load(path) if path is not None else r.load()
    return df.select(*CONFIG_FIELDS)


def write_partitioned(df: DataFrame, path: str, by: list[str], fmt: str = "parquet") -> None:
    """Overwrite ``path`` with ``df`` split into ``by=value`` folders.

    No repartition by the partition columns: a hot day would land in one task.
    The writer sorts each task's rows by the partition columns itself, so a
    task writes at most one file per value it holds."""
    df.write.mode("overwrite").partitionBy(*by).format(fmt).save(path)


def read_partitioned(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """Read a partitioned folder with an explicit schema, so partition values
    keep their declared type (``20240101`` stays a string)."""
    return spark.read.schema(schema).format(fmt).load(path)
