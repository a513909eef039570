"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notifyq.session import checkpoint_dir

#: Arrow batches are worked on in slices of about this many payload bytes.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def others(df: DataFrame, *made: str) -> list[str]:
    """The columns of ``df`` but those named in ``made``; as Spark does, case is not looked at."""
    gone = {c.lower() for c in made}
    return [c for c in df.columns if c.lower() not in gone]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores more as no column of ``df`` has it."""
    held, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder.

    What follows reads files that every executor can reach, so losing an executor
    costs a re-read and no recomputation of earlier stages.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def utf8_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, null as none."""
    return F.coalesce(text, F.lit("")).cast("binary")


def slices(batches: Iterable[pa.RecordBatch], payload: str) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one slice holds about SLICE_BYTES of the payload column.

    A slice has one row at least, so a single very long text passes whole.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, int(batch.num_rows * SLICE_BYTES / max(1, batch.column(payload).nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each end of an edge can reach.

    ``edges`` has columns a and b. Alternates large and small stars until the edges are stars
    themselves; each round is two joins over the edges and is kept in the shared folder.
    """

    def stars(pairs: DataFrame) -> DataFrame:
        """Each node with the smallest of itself and its neighbours; kept, so that the join
        with it can be split where one node has very many edges."""
        return stored(pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))

    def state(pairs: DataFrame) -> tuple:
        return pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before, current = None, state(now)
    while current != before:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = stored(both.join(stars(both), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        joined = large.join(stars(large), "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(joined.select("a", F.col("m").alias("b")))
        now = stored(small.filter("a <> b").distinct())
        before, current = current, state(now)
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
