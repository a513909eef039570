"""Reversible line deduplication.

The state is three tables: ``postings`` (which document holds which line key),
``refs`` (the exact reference count of each key and the smallest document holding it)
and ``filters`` (one cuckoo filter for each shard of the key space, holding the keys
with two documents or more). Inserting or deleting documents adds to and subtracts from the
counts of their own keys, and a key that reaches or loses its second document enters or leaves
its shard's filter; other rows and shards stay as they are. What changes is written beside the
tables and read over them, until COMPACT changes have gathered and they are written whole. Lines to
drop are found by probing the filters; only what they accept meets the exact table.

A line's key is the line without white space at its ends, A-Z lower-cased; lines with a
short key are never dropped. Keys travel as the first 16 bytes of their SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notifyq.llm.common import fresh, others, slices, stored

#: Code points that a key must have.
MIN_KEY = 10
#: Keys held by this share of all postings or more are at most HEAVY in number, whatever
#: the data; they are broadcast and so never meet in one task.
HEAVY = 4096
#: Shards at least, and postings that a shard should have at most.
MIN_SHARDS, SHARD_POSTINGS = 1024, 200_000
#: Changes after which the tables are written whole.
COMPACT = 8
_KEY = np.dtype([("hi", "<u8"), ("lo", "<u8")])


def line_key(line: str) -> bytes | None:
    """Digest of a line's key, or None if the key is short."""
    key = line.encode().strip().lower()  # ASCII white space and letters only, as bytes
    if len(key) < MIN_KEY or (len(key) < 4 * MIN_KEY and len(key.decode()) < MIN_KEY):
        return None
    return hashlib.sha256(key).digest()[:16]


class Cuckoo:
    """Cuckoo filter of 16-byte keys: 4 slots a bucket, 16-bit fingerprints."""

    SLOTS, KICKS = 4, 500

    def __init__(self, keys: int = 0, table: bytes | None = None):
        if table is None:
            n = 1 << max(1, int(keys / (self.SLOTS * 0.85))).bit_length()
            self.table = np.zeros((n, self.SLOTS), np.uint16)
        else:
            self.table = np.frombuffer(table, np.uint16).reshape(-1, self.SLOTS).copy()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        mark = (keys["lo"] % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        first = keys["hi"] & mask
        return mark, first.astype(np.int64), (first ^ (self._jump(mark) & mask)).astype(np.int64)

    @staticmethod
    def _jump(mark: np.ndarray) -> np.ndarray:
        return mark.astype(np.uint64) * np.uint64(0x5BD1E9955BD1E995) >> np.uint64(13)

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key may be held; never False for a held one."""
        mark, a, b = self._places(keys)
        mark = mark[:, None]
        return (self.table[a] == mark).any(1) | (self.table[b] == mark).any(1)

    def add(self, keys: np.ndarray) -> bool:
        """Add keys; False if the filter is full, which leaves it unusable."""
        table, mask = self.table, len(self.table) - 1
        for mark, a, b in zip(*(x.tolist() for x in self._places(keys)), strict=True):
            at = a
            for kick in range(self.KICKS):
                row = table[at]
                free = np.flatnonzero(row == 0)
                if len(free):
                    row[free[0]] = mark
                    break
                if kick:
                    slot = kick % self.SLOTS
                    mark, row[slot] = int(row[slot]), mark
                    at ^= int(self._jump(np.array([mark], np.uint16))[0]) & mask
                else:
                    at = b
            else:
                return False
        return True

    def remove(self, keys: np.ndarray) -> None:
        """Take out keys that were added before."""
        for mark, a, b in zip(*(x.tolist() for x in self._places(keys)), strict=True):
            for at in (a, b):
                held = np.flatnonzero(self.table[at] == mark)
                if len(held):
                    self.table[at, held[0]] = 0
                    break

    @classmethod
    def of(cls, keys: np.ndarray) -> Cuckoo:
        """Filter of these keys, with room doubled until they fit."""
        room = len(keys)
        while not (made := cls(room)).add(keys):
            room = 2 * room + 8
        return made


def _keys(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), _KEY)


def _postings(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, key) for each distinct key of a document."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            ids, out = [], []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                own = {k for line in t.split("\n") if (k := line_key(line))}
                ids += [i] * len(own)
                out += own
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "key"])

    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return whole.filter("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(keys, "doc_id long, key binary")


def _counted(postings: DataFrame) -> DataFrame:
    """Exact references of each key: one for each document, and the smallest holder."""
    return postings.groupBy("key").agg(F.count("*").alias("refs"), F.min("doc_id").alias("keeper"))


def _shard(shards: int) -> F.Column:
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")


def _changed_filters(filters: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """Filters (shard, table) after adding and removing keys, both (shard, key); one that is full
    gets a null table. A shard without a filter has held no key."""

    def one(change: pa.Table) -> pa.Table:
        kinds = change.column("kind").to_numpy()
        of = lambda k: _keys(change.filter(pa.array(kinds == k)).column("key").combine_chunks())
        old = change.filter(pa.array(kinds == 0)).column("table").to_pylist()
        f = Cuckoo(table=old[0]) if old else None
        if f is None:
            f = Cuckoo.of(of(1))
        else:
            f.remove(of(2))
            f = f if f.add(of(1)) else None
        return pa.table({"shard": change.column("shard")[:1], "table": pa.array([f and f.table.tobytes()], pa.binary())})

    none = F.lit(None).cast("binary")
    rows = filters.select("shard", F.lit(0).alias("kind"), none.alias("key"), "table")
    for kind, keys in ((1, added), (2, removed)):
        rows = rows.unionAll(keys.select("shard", F.lit(kind).alias("kind"), "key", none.alias("table")))
    return rows.groupBy("shard").applyInArrow(one, "shard int, table binary")


@dataclass
class LineIndex:
    """State of incremental line dedup; insert() and delete() return new states."""

    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int
    #: Postings in all, and changes since the tables were written whole.
    held: int = 0
    changes: int = 0
    #: The keys that the last change touched: (key, was, refs, keeper), their references before and after.
    touched: DataFrame | None = None

    @classmethod
    def build(cls, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LineIndex:
        """State of a first set of documents. Rows with a null id take no part; rows that
        share an id count as one document."""
        return cls._of(stored(_postings(docs, doc_id, text).distinct()))

    @classmethod
    def _of(cls, postings: DataFrame, shards: int = MIN_SHARDS) -> LineIndex:
        total = postings.count()
        while shards * SHARD_POSTINGS < total:
            shards *= 2
        refs = stored(_counted(postings))
        shared = refs.filter("refs >= 2").select(_shard(shards), "key")
        empty = postings.sparkSession.createDataFrame([], "shard int, table binary")
        return cls(postings, refs, stored(_changed_filters(empty, shared, shared.limit(0))), shards, total)

    def insert(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LineIndex:
        """State with more documents; rows of known ids add to their documents."""
        given = stored(_postings(docs, doc_id, text).distinct())
        # Only the postings of the same ids can hold a given row already.
        known = self.postings.join(given.select("doc_id").distinct(), "doc_id", "left_semi")
        new = stored(given.join(known, ["doc_id", "key"], "left_anti"))
        more = new.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
        was = F.coalesce("refs", F.lit(0)).cast("long")
        touched = more.join(self._refs_of(more), "key", "left").select(
            "key", was.alias("was"), (was + F.col("n")).alias("refs"), F.least("keeper", "first").alias("keeper")
        )
        return self._moved(self.postings.unionAll(new), self.held + new.count(), touched)

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """State without the documents whose ids are in the first column of ``doc_ids``."""
        gone = stored(doc_ids.select(F.col(doc_ids.columns[0]).cast("long").alias("doc_id")).distinct())
        old = stored(self.postings.join(gone, "doc_id", "left_semi"))
        rest = self.postings.join(gone, "doc_id", "left_anti")
        less = old.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
        left = less.join(self._refs_of(less), "key")
        # A key whose keeper goes has the smallest of its other documents.
        orphans = left.filter("keeper = first AND refs > n").select("key")
        heirs = rest.join(orphans, "key", "left_semi").groupBy("key").agg(F.min("doc_id").alias("heir"))
        touched = left.join(heirs, "key", "left").select(
            "key", F.col("refs").alias("was"), (F.col("refs") - F.col("n")).alias("refs"), F.coalesce("heir", "keeper").alias("keeper")
        )
        return self._moved(rest, self.held - old.count(), touched)

    def _refs_of(self, keys: DataFrame) -> DataFrame:
        return self.refs.join(keys.select("key"), "key", "left_semi")

    def _moved(self, postings: DataFrame, held: int, touched: DataFrame) -> LineIndex:
        """State in which the ``touched`` keys have new references; their rows are written beside
        the old tables, and of the filters those whose keys became shared or unshared."""
        if held > self.shards * SHARD_POSTINGS:
            return self._of(stored(postings), self.shards)
        touched = stored(touched)
        refs = self.refs.join(touched.select("key"), "key", "left_anti").unionAll(
            touched.filter("refs > 0").select("key", "refs", "keeper")
        )
        crossed = touched.filter("(was >= 2) <> (refs >= 2)").select(_shard(self.shards), "key", "refs")
        added, removed = (crossed.filter(f"refs {sign} 2").select("shard", "key") for sign in (">=", "<"))
        own = crossed.select("shard").distinct()
        changed = stored(_changed_filters(self.filters.join(own, "shard", "left_semi"), added, removed))
        # A full filter is made anew from all shared keys of its shard.
        full = changed.filter("table IS NULL").select("shard")
        filters = self.filters.join(own, "shard", "left_anti").unionAll(changed.filter("table IS NOT NULL"))
        if not full.isEmpty():
            exact = refs.filter("refs >= 2").select(_shard(self.shards), "key").join(full, "shard", "left_semi")
            filters = filters.unionAll(stored(_changed_filters(filters.limit(0), exact, exact.limit(0))))
        changes = self.changes + 1
        if changes >= COMPACT:
            postings, refs, filters, changes = stored(postings), stored(refs), stored(filters), 0
        return LineIndex(postings, refs, filters, self.shards, held, changes, touched)

    def probed(self, postings: DataFrame) -> DataFrame:
        """The (doc_id, key) rows that the filters accept: each shard's filter and its
        probes meet in one task, the filter first, and the probes stream past it."""
        none = lambda kind, name: F.lit(None).cast(kind).alias(name)
        filters = self.filters.select("shard", none("long", "doc_id"), none("binary", "key"), "table")
        probes = postings.select(_shard(self.shards), "doc_id", "key", none("binary", "table"))
        met = filters.unionAll(probes).repartition("shard").sortWithinPartitions("shard", F.col("table").isNull())

        def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard, f = None, None
            for b in batches:
                table = b.column("table")
                starts = np.flatnonzero(~np.asarray(table.is_null()))
                ids = np.asarray(b.column("shard"))
                keep = np.zeros(b.num_rows, bool)
                bounds = np.flatnonzero(np.diff(ids, prepend=ids[:1] - 1))
                held = {int(ids[s]): s for s in starts}
                for lo, hi in zip(bounds, [*bounds[1:], b.num_rows], strict=True):
                    if ids[lo] != shard:
                        shard, f = int(ids[lo]), None
                    if shard in held:
                        f = Cuckoo(table=table[held[shard]].as_py())
                        lo += 1
                    if f is not None and hi > lo:
                        keep[lo:hi] = f.has(_keys(b.column("key").slice(lo, hi - lo)))
                yield b.filter(pa.array(keep)).select(["doc_id", "key"])

        return met.mapInArrow(test, "doc_id long, key binary")

    def drops(self, postings: DataFrame | None = None) -> DataFrame:
        """(doc_id, key) of the lines to drop: shared keys, except at their keeper."""
        probes = self.postings if postings is None else postings
        total = max(1, self.held)
        heavy = F.broadcast(self.refs.filter((F.col("refs") >= 2) & (F.col("refs") * HEAVY >= total)))
        often = probes.join(heavy, "key").filter("doc_id <> keeper").select("doc_id", "key")
        rest = self.probed(probes.join(heavy, "key", "left_anti"))
        exact = self.refs.filter("refs >= 2").select("key", "keeper")
        return often.unionAll(rest.join(exact, "key").filter("doc_id <> keeper").select("doc_id", "key"))


def dedup_lines(
    docs: DataFrame, index: LineIndex | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with kept_text, n_lines and n_dropped.

    Lines whose key stands in two documents of the index or more stay only in the smallest
    doc_id that holds it; without an index, ``docs`` themselves are indexed. A null or empty
    text is one empty line; a row with a null id keeps all lines; rows that share an id drop
    the same lines. Other columns pass through; columns of these three names are replaced.
    """
    index = index or LineIndex.build(docs, doc_id, text)
    base = docs.select(*others(docs, "kept_text", "n_lines", "n_dropped"))
    drop_id, drop = fresh(base, "drop_id", "drop")
    drops = index.drops().groupBy("doc_id").agg(F.collect_set("key").alias(drop))
    drops = drops.select(F.col("doc_id").alias(drop_id), drop)
    joined = base.join(drops, base[doc_id] == drops[drop_id], "left").drop(drop_id)
    new = [T.StructField("kept_text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            kept, before, dropped = [], [], []
            for t, gone in zip(b.column(text).to_pylist(), b.column(drop).to_pylist(), strict=True):
                lines = (t or "").split("\n")
                left = _without(lines, gone)
                kept.append("\n".join(left))
                before.append(len(lines))
                dropped.append(len(lines) - len(left))
            rest = b.drop_columns([drop])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(kept, pa.string()), pa.array(before, pa.int64()), pa.array(dropped, pa.int64())],
                names=[*rest.schema.names, "kept_text", "n_lines", "n_dropped"],
            )

    return joined.mapInArrow(cut, T.StructType([*base.schema.fields, *new]))


def _without(lines: list[str], gone: Iterable[bytes] | None) -> list[str]:
    if not gone:
        return lines
    out = set(gone)
    return [x for x in lines if line_key(x) not in out]


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of each row."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )
