"""Cleaning a corpus of documents in stages, each calling one operator of notifyq.llm.

Every stage works on all that its predecessor kept, and all but the last return the columns
of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notifyq.llm import bpe_codec, decontaminate, jaccard_join, line_dedup, quality
from notifyq.llm.common import fresh, table
from notifyq.llm.queries import vocabulary
from notifyq.session import checkpoint_dir

#: A stage takes (spark, documents, folder of the tables).
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on their labelled ones, does not reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    (score,) = fresh(docs, "score")
    return quality.with_scores(docs, model, out=score).filter(F.col(score) >= quality.GOOD).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a smaller doc_id holds too; n_chars follows."""
    cut = line_dedup.dedup_lines(docs)
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return cut.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near duplicates (five words, 0.8). Of rows that
    repeat an id, the one whose columns, as JSON text, have the smallest digest. Rows without an id stay."""
    found = jaccard_join.jaccard_components(docs, jaccard_join.Rule(words=5, percent=80))
    first = found.filter("component_id = doc_id").select("doc_id").distinct()
    row = F.struct(*docs.columns)
    kept = docs.join(first, "doc_id", "left_semi").groupBy("doc_id")
    one = kept.agg(F.min_by(row, F.sha2(F.to_json(row), 256)).alias("row")).select("row.*")
    return one.unionByName(docs.filter("doc_id IS NULL"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark text."""
    judged = decontaminate.with_leaks(docs, table(spark, sf_dir, "benchmark"))
    return judged.filter(~F.col("contaminated")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's number of tokens and the digests of its ids and decoded text."""
    return bpe_codec.codec_report(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("bpe_codec", encode),
]

#: SQL cannot express the classifier, the latent search or BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each stage's result is written to the shared
    folder as Parquet before the next one reads it."""
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
