"""Sink tables as tables of Spark's catalog, one wide row per key.

Config events become DDL: a table exists in the catalog while the registry
says so, at a location of its own for every time it was created, named by the
event that created it. Dropping and creating again thus is a change of
location: nothing is emptied in place, and doing it twice does nothing more.

A table holds one row per row key: ``row_key``, a column for every column that
config rows have named since the table was created, and ``bucket``, a hash of
the key. A batch rewrites the buckets it touches, by dynamic partition
overwrite, from the folded log; other buckets' files stay. The cells to write
are kept in order of table, so that each table's write reads its own and not
all; a bucket of many cells is written by several tasks. Every bucket
written holds one row without a key, so that a bucket whose rows are all
deleted is overwritten, too; ``read_table`` leaves it out.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.operators import configs as CF, dims as D

#: Buckets of a table; a batch rewrites those its keys fall into.
BUCKETS = 16
#: Tables written at once.
WRITERS = 8
#: Cells of a bucket that one task writes, about.
TASK_CELLS = 2_000_000
ROW_KEY, BUCKET = "row_key", "bucket"


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def table_name(sink_table: str) -> str:
    """A catalog name: letters, digits and underscores, as the sink has them."""
    if not re.fullmatch(r"\w+", sink_table):
        raise ValueError(f"not a table name: {sink_table}")
    return sink_table


def wanted_tables(history: DataFrame, recreate_on_update: bool = True) -> DataFrame:
    """(sink_table, sink_family, born, columns): the tables that exist after
    the config ``history``, the key of the event that created each, and the
    columns named by any config row of the table since then."""
    tables = D.sink_tables(history, recreate_on_update, keep_birth=True)
    named = (history.where(~CF.is_delete()).select("sink_table", "cseq", F.explode(F.split("sink_columns", ",")).alias("col"))
             .join(tables.select("sink_table", "born"), "sink_table").where(F.col("cseq") >= F.col("born"))
             .where(~F.col("col").isin("", "type")).groupBy("sink_table").agg(F.array_sort(F.collect_set("col")).alias("columns")))
    return tables.join(named, "sink_table", "left").withColumn("columns", F.coalesce("columns", F.array().cast("array<string>")))


def _written(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema(f"{ROW_KEY} string").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def _columns(spark: SparkSession, table: str) -> list[str] | None:
    return spark.table(table).columns if spark.catalog.tableExists(table) else None


def apply_tables(spark: SparkSession, namespace: str, root: str, wanted: DataFrame, only: DataFrame | None = None) -> dict[str, dict]:
    """Creates, drops and re-creates the tables of ``namespace`` so that they
    are those of ``wanted_tables``; ``only`` (sink_table) names the ones that
    config events touched. Returns table -> location and columns of ``wanted``.
    Config rows are a control table: a row per sink table is read here."""
    spark.sql(f"create database if not exists {_quoted(namespace)}")
    want = {r["sink_table"]: r for r in wanted.collect()}
    touched = {r[0] for r in only.select("sink_table").distinct().collect()} if only is not None else None
    exist = {t.name.lower() for t in spark.catalog.listTables(namespace)}
    out = {}

    def apply(name: str) -> None:
        row, table = want.get(name), _quoted(namespace, table_name(name))
        if row is None:
            spark.sql(f"drop table if exists {table}")
            return
        born = "-".join(str(x) for x in (row["born"] if isinstance(row["born"], tuple) else (row["born"],)))
        location = f"{root}/{name}/{born}"
        out[name] = {"location": location, "columns": row["columns"], "born": row["born"]}
        held = dict(r for r in spark.sql(f"show tblproperties {table}").collect()) if name.lower() in exist else {}
        if held and held.get("born") != born:
            spark.sql(f"drop table {table}")
            held = {}
        if not held:
            columns = ", ".join(f"{_quoted(c)} string" for c in (ROW_KEY, *row["columns"]))
            spark.sql(f"create table {table} ({columns}, {BUCKET} int) using parquet partitioned by ({BUCKET}) location '{location}' "
                      f"tblproperties ('born' = '{born}', 'families' = '{row['sink_family']}')")
            if _written(spark, location):      # by a session whose catalog is gone
                spark.sql(f"alter table {table} recover partitions")
        else:
            more = [c for c in row["columns"] if c not in _columns(spark, table)]
            if more:
                spark.sql(f"alter table {table} add columns ({', '.join(f'{_quoted(c)} string' for c in more)})")

    names = sorted(want.keys() | (touched or set()) | (exist if touched is None else set()))
    with ThreadPoolExecutor(WRITERS) as pool:
        list(pool.map(apply, names))
    return out


def bucket_of(key: str = ROW_KEY, buckets: int = BUCKETS) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def wide_rows(cells: DataFrame, columns: list[str]) -> DataFrame:
    """Cells of one table -> one row per key."""
    return cells.groupBy("sink_table", ROW_KEY, BUCKET).agg(*[F.max(F.when(F.col("col") == c, F.col("value"))).alias(c) for c in columns]) \
        .select(ROW_KEY, *columns, BUCKET)


def write_rows(spark: SparkSession, namespace: str, tables: dict[str, dict], current: DataFrame, touched: DataFrame,
               buckets: int = BUCKETS) -> None:
    """Rewrites the buckets of ``touched`` (sink_table, row_key) from the cells
    ``current`` (sink_table, row_key, col, value)."""
    touched = touched.select("sink_table", bucket_of(buckets=buckets).alias(BUCKET)).distinct().persist()
    cells = (current.withColumn(BUCKET, bucket_of(buckets=buckets)).join(F.broadcast(touched), ["sink_table", BUCKET], "left_semi")
             .sortWithinPartitions("sink_table", ROW_KEY, BUCKET).persist())
    try:
        names = [r[0] for r in touched.select("sink_table").distinct().collect() if r[0] in tables]
        most = dict(cells.groupBy("sink_table", BUCKET).count().groupBy("sink_table").agg(F.max("count")).collect())

        def write(name: str) -> None:
            own = tables[name]
            rows = wide_rows(cells.where(F.col("sink_table") == name), own["columns"])
            blank = touched.where(F.col("sink_table") == name).select(
                F.lit(None).cast("string").alias(ROW_KEY), *[F.lit(None).cast("string").alias(c) for c in own["columns"]], BUCKET)
            tasks = max(1, -(-most.get(name, 0) // TASK_CELLS))
            share = [F.pmod(F.hash(ROW_KEY), F.lit(tasks))] if tasks > 1 else []
            (rows.unionByName(blank).repartition(buckets * tasks, BUCKET, *share)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(own["location"]))
            table = _quoted(namespace, table_name(name))
            spark.sql(f"alter table {table} recover partitions")
            spark.catalog.refreshTable(table)

        # large tables first, so that none is left over at the end
        with ThreadPoolExecutor(WRITERS) as pool:
            list(pool.map(write, sorted(names, key=lambda n: (-most.get(n, 0), n))))
    finally:
        cells.unpersist()
        touched.unpersist()


def read_table(spark: SparkSession, namespace: str, sink_table: str) -> DataFrame:
    """One row per key of a sink table."""
    return spark.table(_quoted(namespace, table_name(sink_table))).where(F.col(ROW_KEY).isNotNull()).drop(BUCKET)


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """(sink_table, sink_family) of the tables that the catalog holds."""
    rows = []
    for t in spark.catalog.listTables(namespace):
        held = dict(r for r in spark.sql(f"show tblproperties {_quoted(namespace, t.name)}").collect())
        rows.append((t.name, held.get("families")))
    return spark.createDataFrame(rows, "sink_table string, sink_family string")
