"""Incremental runs over a landing folder with Structured Streaming.

The batch process picks "the newest raw file by name" (S2) and runs every stage on it.
Here a stream of the folder's *listing* does that bookkeeping: each new file's path is
picked up once (recorded in the stream's checkpoint), and ``foreachBatch`` hands the paths
to the same ``stage_ingest`` and ``run_batch`` that a batch run calls. So both read the
files with one reader and one dialect, check headers alike, keep the raw rows and the
manifest alike (K1, K2), and give the same tables; the content of a file never passes
through the stream. ``files_per_trigger=1`` keeps one file per run, like the original
process; raise it to catch up a backlog in fewer runs. A micro-batch replayed after a
failure has the same run id, and a run's tables are replaced or already published, so
nothing is written twice. The checkpoint location must be on shared storage; by default it
is a folder under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from notifyq.functions.protect import FernetKey
from notifyq.plans.runner import run_batch, stage_ingest
from notifyq.session import checkpoint_dir
from notifyq.sources.files import exact_path

LISTING = "path string, modificationTime timestamp, length long, content binary"


def landing_stream(spark: SparkSession, landing_dir: str, files_per_trigger: int = 1, pattern: str = "*.csv") -> DataFrame:
    """(path, modified_at, bytes) of new landing files; their content is not read."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(LISTING)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(landing_dir)
    )
    return files.selectExpr("path", "modificationTime AS modified_at", "length AS bytes")


def start_incremental_runs(
    spark: SparkSession,
    landing_dir: str,
    root: str,
    key: str | FernetKey,
    checkpoint_location: str | None = None,
    as_of: str | None = None,
    available_now: bool = True,
    files_per_trigger: int = 1,
    pattern: str = "*.csv",
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes the backlog and stops."""
    location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/incremental-runs"

    def process(batch: DataFrame, epoch_id: int) -> None:
        # As many paths as a trigger takes; a batch run passes its paths to the reader too.
        paths = [exact_path(r["path"]) for r in batch.select("path").orderBy("path").collect()]
        if not paths:
            return
        # The stream's own id keeps the epochs of streams with other checkpoints apart.
        stream = spark.read.json(f"{location}/metadata").first()["id"]
        run_id = f"{stream}-epoch{epoch_id:08d}"
        raw = stage_ingest(spark, paths, root, run_id)
        run_batch(spark, raw, root, key, run_id=run_id, as_of=as_of)

    writer = (
        landing_stream(spark, landing_dir, files_per_trigger, pattern)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", location)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
