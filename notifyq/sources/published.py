"""Run tables that become visible as a whole (K8, K11), and a destination bucketed by id.

A load is written, checked and then published. Each try of a run appends into partitions of its
own (``load_id=...``); its rows become visible when one row that names the try is put into the
table of commits, in a single file for the run, which every reader joins with. A try that ends
before its commit leaves no visible row, and the next one starts afresh. A run that has committed
is not written again. ``remove_unpublished`` deletes what ended tries have left.

The destination is an external table bucketed by the id, declared again in each session over
the same folder (no metastore is needed); its number of buckets is kept beside it. Joins by id
read the buckets as they lie: only the incoming rows are moved. One writer per root is assumed.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("load_id", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("committed_at", T.TimestampNTZType()),
        T.StructField("table", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)

#: Buckets of a new destination at most, unless a number is given; as many as the session has shuffle
#: partitions otherwise. A load writes a file for each bucket and batch.
MAX_BUCKETS = 4096

#: Committed tries named in a reader's filter at most.
LISTED = 10_000


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A run table with its known schema (an empty write leaves no file to infer from)."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


# ---- commits ---------------------------------------------------------------------------------


def commits(spark: SparkSession, root: str, table: str) -> DataFrame:
    """(load_id, rows, committed_at, table, run_id) of the runs whose rows of ``table`` are visible."""
    return read_or_empty(spark, f"{root}/commits", COMMIT_SCHEMA).where(F.col("table") == table)


def is_committed(spark: SparkSession, root: str, table: str, run_id: str) -> bool:
    return not commits(spark, root, table).where(F.col("run_id") == run_id).isEmpty()


def committed_rows(spark: SparkSession, root: str, table: str) -> int:
    """Visible rows of a table, from its commits: the table itself is not read."""
    return commits(spark, root, table).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def new_load_id() -> str:
    return uuid.uuid4().hex


def commit(spark: SparkSession, root: str, table: str, run_id: str, load_id: str, rows: int, at) -> None:
    """Make a try's rows visible: one file, so that it is there or it is not."""
    row = spark.createDataFrame([(load_id, rows, at)], T.StructType(COMMIT_SCHEMA.fields[:3]))
    row.coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/table={table}/run_id={run_id}")


def visible(rows: DataFrame, root: str, table: str) -> DataFrame:
    """The rows of committed tries. ``load_id`` is a partition column: up to ``LISTED`` tries are
    a filter on partitions, which leaves the scan's buckets as they are; more are joined."""
    tries = commits(rows.sparkSession, root, table).select("load_id")
    some = [r["load_id"] for r in tries.limit(LISTED + 1).collect()]
    if len(some) <= LISTED:
        return rows.where(F.col("load_id").isin(some))
    return rows.join(tries, "load_id", "left_semi").select(*rows.columns)


def forget(spark: SparkSession, root: str, table: str) -> None:
    """Take back all commits of a table."""
    path = f"{root}/commits/table={table}"
    if path_exists(spark, path):
        spark.createDataFrame([], T.StructType(COMMIT_SCHEMA.fields[:3])).write.mode("overwrite").parquet(path)


# ---- bucketed table --------------------------------------------------------------------------


def _buckets(spark: SparkSession, path: str, asked: int | None) -> int:
    kept = f"{path.rstrip('/')}-layout"
    if path_exists(spark, kept):
        return spark.read.schema("buckets int").json(kept).first()["buckets"]
    n = asked or min(MAX_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.createDataFrame([(n,)], "buckets int").coalesce(1).write.json(kept)
    return n


def table_name(path: str) -> str:
    return f"notifyq_{hashlib.sha256(path.rstrip('/').encode()).hexdigest()[:24]}"


def declare(
    spark: SparkSession, path: str, schema: T.StructType, partitions: list[str], key: str, buckets: int | None = None
) -> str:
    """Name of the external table over ``path``, bucketed by ``key`` and partitioned by the
    trailing columns ``partitions``; its partitions are taken from the folder."""
    name = table_name(path)
    if "'" in path or "\\" in path:
        raise ValueError(f"a table's folder may hold no quote or backslash: {path}")
    if not spark.catalog.tableExists(name):
        n = _buckets(spark, path, buckets)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(partitions)}) "
            f"CLUSTERED BY ({key}) INTO {n} BUCKETS LOCATION '{path}'"
        )
    if path_exists(spark, path):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def buckets_of(spark: SparkSession, path: str) -> int:
    return _buckets(spark, path, None)


def append(rows: DataFrame, name: str, key: str, buckets: int) -> None:
    """Add rows to a declared table: each bucket is written by one task."""
    rows.select(*rows.sparkSession.table(name).columns).repartition(buckets, key).write.insertInto(name)


def remove_unpublished(spark: SparkSession, root: str, table: str, path: str) -> list[str]:
    """Delete the partitions of tries that have not committed, while no run is under way; returns
    their ids."""
    if not path_exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("load_id=")]
    kept = {r["load_id"] for r in commits(spark, root, table).select("load_id").collect()}
    gone = [p for p in there if p.getName().partition("=")[2] not in kept]
    for p in gone:
        fs.delete(p, True)
    return sorted(p.getName().partition("=")[2] for p in gone)
