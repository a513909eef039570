"""File sources: raw CSV landing files (S1), the newest of them by its name (S2), JSON run documents.

Row order matters for deduplication (first copy of an id wins), and a distributed scan
has no order, so every raw row carries an explicit ``row_ord``: the file name, the byte
offset of the split that holds it and its position inside that split. All three are
stable under task retry, so a lost executor recomputes the same ordering.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notifyq import schema as S


#: The dialect of landing files. Columns are checked against each file's header.
CSV_DIALECT = {
    "header": True,
    "enforceSchema": False,
    "escape": '"',
    "mode": "PERMISSIVE",
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_raw_csv(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Header CSV, all 16 columns as nullable strings; only empty fields are null.

    ``NA``/``null`` stay text, as the specification asks. A doubled quote inside a quoted
    field is one quote. Columns are checked against each file's header: another order or
    name fails instead of swapping values. ``multi_line`` accepts line breaks inside quoted
    fields, at the price of one task for each file. ``row_ord`` is a struct (full path,
    split offset, position) ordered like the file; ``batch_id`` is the file name without
    extension.
    """
    df = spark.read.schema(S.RAW_SCHEMA).options(**CSV_DIALECT, multiLine=multi_line).csv(path)
    # Position inside a split: monotonically_increasing_id keeps scan order inside a
    # task; its high bits (the task index) are removed so only the offset remains.
    pos = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return df.select(
        *S.RAW_COLUMNS,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("offset"),
            pos.alias("pos"),
        ).alias(S.ROW_ORD),
        F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "").alias(S.BATCH_ID),
    )


def listed_files(spark: SparkSession, path: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """(path, source_file, bytes, modified_at) of the files under ``path`` whose name fits the
    pattern, from the listing: without the content column no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("source_file"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


def exact_path(path: str) -> str:
    """A listed path as a reader's argument that names this file only: a reader takes its
    argument as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def newest_file(spark: SparkSession, path: str | list[str], pattern: str = "*.csv") -> str:
    """The file whose name sorts last (names carry their time); of files of one name in
    several folders the one whose full path does. Raises FileNotFoundError where there is none."""
    last = listed_files(spark, path, pattern).agg(F.max(F.struct("source_file", "path")).alias("f")).first()["f"]
    if last is None:
        raise FileNotFoundError(f"no file like {pattern} under {path}")
    return last["path"]


def read_newest_csv(spark: SparkSession, path: str | list[str], pattern: str = "*.csv", multi_line: bool = False) -> DataFrame:
    """The rows of the newest landing file; the other files are listed, not read."""
    return read_raw_csv(spark, exact_path(newest_file(spark, path, pattern)), multi_line)


def latest_batch_id(df: DataFrame) -> DataFrame:
    """S2/T1 on a table of several batches: one-row frame with the newest ``batch_id`` (names sort by time)."""
    return df.agg(F.max(S.BATCH_ID).alias(S.BATCH_ID))


def only_latest_batch(df: DataFrame) -> DataFrame:
    """Rows of the newest batch: a filter against a scalar subquery (the one-value max),
    i.e. a partition filter on a ``batch_id``-partitioned table, not a join."""
    return df.where(F.col(S.BATCH_ID) == latest_batch_id(df).scalar())


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """Multi-line JSON documents (run metrics, reports, catalogues)."""
    return spark.read.option("multiLine", True).json(path)
