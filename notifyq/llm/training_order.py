"""Token sequences written in training order.

Each document is encoded by a public library; its ids, ended by a mark, are cut into sequences of a fixed length. A keyed
Feistel permutation with cycle-walking gives every sequence one global slot: a bijection on
0 .. n-1 that needs no sort of random keys and no state. Range partitions of slots become
blocks of fixed-stride records, so that a reader finds any slot by division and resumes
anywhere.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notifyq.llm.common import slices
from notifyq.session import checkpoint_dir

ROUNDS = 6

#: Bytes of records that one task orders and writes, at most.
TASK_BYTES = 64 << 20


def permuted(index: np.ndarray, n: int, key: str) -> np.ndarray:
    """Slots of indices 0 .. n-1: a bijection chosen by ``key``."""
    if n < 2:
        return np.zeros(len(index), np.int64)
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    keys = [np.uint64(int.from_bytes(hashlib.blake2b(f"{key}/{r}".encode(), digest_size=8).digest(), "little")) for r in range(ROUNDS)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for k in keys:
            mixed = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        return left << shift | right

    out = once(index.astype(np.uint64))
    while len(at := np.flatnonzero(out >= n)):  # walk the cycle back into the domain
        out[at] = once(out[at])
    return out.astype(np.int64)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a rank file: a line for each token, base64 and number."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(i) for token, i in (line.split() for line in f if line.strip())}


def sequences(docs: DataFrame, ranks: dict[bytes, int], pattern: str, end_text: str, length: int) -> DataFrame:
    """(part, pos, doc_id, seq_no, n_tokens, record): the ids of each whole document and an end
    mark, cut into records of at most ``length`` unsigned 16-bit ids.

    ``end_text`` inside a text is the end mark too. A null or empty text gives one record with
    the mark alone. part and pos are the task and the place in it: a repeated task numbers
    its rows the same."""
    end = len(ranks)
    if end >= 1 << 16:
        raise ValueError("ids do not fit 16 bits")
    sent = docs.sparkSession.sparkContext.broadcast(ranks)  # the vocabulary, some 50,000 tokens
    names = ["part", "pos", "doc_id", "seq_no", "n_tokens", "record"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=sent.value, special_tokens={end_text: end})
        part, pos = TaskContext.get().partitionId(), 0
        for b in slices(batches, "text"):
            doc, no, used, record = [], [], [], []
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = np.array([*coder.encode(text or "", allowed_special="all"), end], "<u2").tobytes()
                for k, at in enumerate(range(0, len(ids), 2 * length)):
                    record.append(ids[at : at + 2 * length])
                    doc.append(i)
                    no.append(k)
                    used.append(len(record[-1]) // 2)
            made = [pa.array([part] * len(doc), pa.int32()), pa.array(range(pos, pos + len(doc)), pa.int64())]
            made += [pa.array(doc, pa.int64()), pa.array(no, pa.int64()), pa.array(used, pa.int32()), pa.array(record, pa.binary())]
            pos += len(doc)
            yield pa.RecordBatch.from_arrays(made, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(cut, "part int, pos long, doc_id long, seq_no long, n_tokens int, record binary")


def with_slots(rows: DataFrame, key: str) -> tuple[DataFrame, int]:
    """``rows`` of sequences(), read from where they are kept, with a long column ``slot`` in
    place of part and pos; and their number.

    Numbers are dense without a sort or shuffle: the parts' counts give each part's offset."""
    counts = sorted(rows.groupBy("part").count().collect())  # 16 bytes for each task that wrote
    starts, total = {}, 0
    for part, n in counts:
        starts[part] = total
        total += n
    sent = rows.sparkSession.sparkContext.broadcast(starts)
    others = [f for f in rows.schema.fields if f.name not in ("part", "pos")]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first = np.array([sent.value[x] for x in b.column("part").to_pylist()], np.int64)
            slot = permuted(first + np.asarray(b.column("pos")), total, key)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(f.name) for f in others), pa.array(slot)], names=[*(f.name for f in others), "slot"]
            )

    return rows.mapInArrow(number, T.StructType([*others, T.StructField("slot", T.LongType())])), total


def blocks(slotted: DataFrame, total: int, per_block: int, stride: int, end: int) -> DataFrame:
    """(block, first_slot, n_records, payload): records of consecutive slots, end to end, each
    padded with the end mark to ``stride`` bytes.

    Block b holds the slots from b * per_block on, so a slot's bytes begin at
    (slot mod per_block) * stride of block slot div per_block."""
    keyed = slotted.select(F.expr(f"slot div {per_block}").alias("block"), "slot", "record")

    pad = np.full(stride // 2, end, "<u2").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, held = None, 0, []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int64()), pa.array([first], pa.int64()), pa.array([len(held)], pa.int32()), pa.array([b"".join(held)], pa.binary())],
                ["block", "first_slot", "n_records", "payload"],
            )

        for b in batches:
            for block, slot, record in zip(*(b.column(c).to_pylist() for c in ("block", "slot", "record")), strict=True):
                if block != now:
                    if held:
                        yield made()
                    now, first, held = block, slot, []
                held.append(record + pad[len(record) :])
        if held:
            yield made()

    # Slots are dense and uniform: ranges of blocks are even without looking at the data, and a
    # task has TASK_BYTES of records at most, however many there are.
    cores = keyed.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(-(-total // per_block), max(4 * cores, -(-total * stride // TASK_BYTES))))
    ranged = keyed.repartitionByRange(parts, "block").sortWithinPartitions("block", "slot")
    return ranged.mapInArrow(pack, "block long, first_slot long, n_records int, payload binary")


def write_training_order(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, folder: str, key: str,
    end_text: str = "<|endoftext|>", length: int = 512, per_block: int = 256,
) -> DataFrame:
    """Write all sequences of ``docs`` to ``folder`` as Parquet blocks in training order, and
    return where each went: doc_id, seq_no, n_tokens, slot, block, offset (bytes), and the
    digest of its ids without padding.

    Null ids stay null; rows that share an id keep their own sequences; extra columns are
    not written; an empty table writes no block. The sequences are encoded once and kept in
    the shared folder meanwhile.
    """
    spark = docs.sparkSession
    kept = f"{checkpoint_dir(spark)}/sequences-{uuid.uuid4().hex}"
    sequences(docs, ranks, pattern, end_text, length).write.option("compression", "zstd").parquet(kept)
    slotted, total = with_slots(spark.read.parquet(kept), key)
    made = blocks(slotted, total, per_block, 2 * length, len(ranks))
    made.write.option("compression", "zstd").mode("overwrite").parquet(folder)
    return slotted.select(
        "doc_id", "seq_no", F.col("n_tokens").cast("long").alias("n_tokens"), "slot",
        F.expr(f"slot div {per_block}").alias("block"),
        (F.col("slot") % per_block * (2 * length)).alias("offset"),
        F.sha2("record", 256).alias("ids_sha256"),
    )


def read_slots(
    spark: SparkSession, folder: str, first: int, count: int, length: int = 512, per_block: int = 256
) -> DataFrame:
    """(slot, record) of ``count`` slots from ``first`` on, reading only their blocks."""
    lo, hi = first // per_block, (first + count - 1) // per_block
    at = spark.read.parquet(folder).filter(F.col("block").between(lo, hi))
    rows = at.select("first_slot", "payload", F.explode(F.expr("sequence(0, n_records - 1)")).alias("_k"))
    cut = rows.select(
        (F.col("first_slot") + F.col("_k")).alias("slot"),
        F.substring("payload", F.col("_k") * (2 * length) + 1, F.lit(2 * length)).alias("record"),
    )
    return cut.filter(F.col("slot").between(first, first + count - 1))
