"""Ingest: landing copy (K1) and file manifest (K2).

Files are listed with ``binaryFile``. The SHA-256 of a file is taken by Spark itself from its
content, for files of up to ``HASH_WHOLE`` bytes; a larger one is streamed block by block in a
task of its own through ``pyarrow.fs``, and has none where that knows no file system for the
path. Beside it stands a digest of the file's lines that is added up from all splits, so a file
of any size is digested by as many tasks as read it: the sum, without regard to order, of the
SHA-256 of each line. It tells content that has landed before. Row counts come from a parsed read
grouped by file (Q12: parsed rows, not physical lines minus one), with the physical line count as
a second field.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notifyq import schema as S
from notifyq.sources.files import read_raw_csv


#: Bytes of a file whose content Spark hashes as one value, at most.
HASH_WHOLE = 64 << 20

#: Bytes read at once while hashing a larger file.
HASH_BLOCK = 1 << 20


def _sha256(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = []
        for uri in batch.column("path").to_pylist():
            digest = hashlib.sha256()
            try:
                store, path = fs.FileSystem.from_uri(uri)
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                digests.append(None)
                continue
            with store.open_input_stream(path) as f:
                while block := f.read(HASH_BLOCK):
                    digest.update(block)
            digests.append(digest.hexdigest())
        yield batch.append_column("sha256", pa.array(digests, pa.string()))


def file_hashes(spark: SparkSession, path: str | list[str], whole: int = HASH_WHOLE) -> DataFrame:
    """(path, source_file, bytes, modified_at, sha256) per file; the path tells files of one
    name in different folders apart. ``whole`` is the size up to which Spark hashes the content."""
    files = spark.read.format("binaryFile").load(path)
    columns = [
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified_at"),
    ]
    # The length is tested before a file is opened.
    small = files.where(F.col("length") <= whole).select(*columns, F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > whole).select(*columns)
    out = "path string, source_file string, bytes long, modified_at timestamp, sha256 string"
    return small.unionByName(large.mapInArrow(_sha256, out))


def line_digests(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, lines, lines_digest) per file, from its splits: the eight 32-bit parts of the
    SHA-256 of all lines are summed, part by part."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.sha2("value", 256).alias("h"))
    parts = [F.sum(F.conv(F.substring("h", 8 * k + 1, 8), 16, 10).cast("bigint")).alias(f"p{k}") for k in range(8)]
    digest = F.concat(*[F.lpad(F.lower(F.hex(F.col(f"p{k}") % F.lit(1 << 32))), 8, "0") for k in range(8)])
    return lines.groupBy("path").agg(F.count(F.lit(1)).alias("lines"), *parts).select("path", "lines", digest.alias("lines_digest"))


def landed_before(manifest: DataFrame, earlier: DataFrame) -> DataFrame:
    """The manifest with ``landed_before``: whether ``earlier`` manifests hold a file of the same
    bytes and lines, under whatever name, so that its rows are known already."""
    known = earlier.select("bytes", "lines_digest").distinct().withColumn("_known", F.lit(True))
    joined = manifest.join(known, ["bytes", "lines_digest"], "left")
    return joined.select(*manifest.columns, F.col("_known").isNotNull().alias("landed_before"))


def file_manifest(
    spark: SparkSession, path: str | list[str], fmt: str = "csv", stage: str = S.STAGE_INGEST, paths: bool = False
) -> DataFrame:
    """K2: one row per file: name (and full path if asked for), sha256, bytes, parsed rows,
    physical lines and their digest, stage."""
    hashes = file_hashes(spark, path)
    if fmt == "csv":
        parsed = read_raw_csv(spark, path).select(F.col(f"{S.ROW_ORD}.file").alias("path"))
        line_counts = line_digests(spark, path)
    else:
        parsed = spark.read.format(fmt).load(path).select(F.col("_metadata.file_path").alias("path"))
        line_counts = None
    rows = parsed.groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
    out = hashes.join(rows, "path", "left")
    if line_counts is not None:
        out = out.join(line_counts, "path", "left")
    else:
        out = out.withColumns({"lines": F.lit(None).cast("bigint"), "lines_digest": F.lit(None).cast("string")})
    return out.select(
        *(["path"] if paths else []),
        "source_file",
        "sha256",
        "bytes",
        F.coalesce(F.col("rows"), F.lit(0).cast("bigint")).alias("rows"),
        "lines",
        "lines_digest",
        F.lit(stage).alias("stage"),
    )


def land_raw(raw: DataFrame, raw_root: str) -> None:
    """K1: keep the landed rows as a table partitioned by ``batch_id`` (append)."""
    raw.write.mode("append").partitionBy(S.BATCH_ID).parquet(raw_root)
