"""Hard negatives by exact integer scores, looked up in subset-sum tables (four Russians).

Each component x becomes the integer floor(scale * x). Candidates are kept as bit planes: for each
bit of their two's complement and each group of eight dimensions one byte, packed over the group.
For an anchor and a group of dimensions a table holds the sums of all 256 subsets of the anchor's
components. A plane's inner product with the anchor is then one lookup for each group, and shifting
and adding the planes gives the full exact score, without a multiplication.

Candidates are dealt to slices and anchors to groups, both of bounded size; each slice meets each
group once for the positives, and once for the negatives, as these depend on the positives' scores.
What a meeting hands on is its best rows only, and the best of all meetings are the result.

An anchor's positives are its first rows of the same label, by falling score and rising id. For each
of them the negatives are the first rows of another label whose score lies between ``low`` and
``high`` per cent of the positive's.

Defined cases: rows without id, label or vector, or with a null or non-finite component take no
part, nor do rows whose integers reach ``Settings.limit`` (scores would leave 64 bits). Rows that share an id
are one row, the smallest by (label, integers). Shorter vectors end in zeros. An anchor without a
positive, or a positive without a negative, has no rows. Columns other than the three are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notifyq.llm.common import stored

#: Dimensions of a group: as many as a byte has bits.
GROUP = 8


@dataclass(frozen=True)
class Settings:
    scale: int = 256
    positives: int = 5
    negatives: int = 5
    #: Bounds of a negative's score in per cent of the positive's.
    low: int = 80
    high: int = 100
    #: Integers stay below this size, and so the scores of up to 128 dimensions within 64 bits.
    limit: int = 1 << 28
    #: Candidates of a slice and anchors of a group, about, at most.
    slice: int = 1 << 17
    group: int = 1 << 12
    #: Candidates of a slice, about, at least, where fewer slices than cores would do.
    small: int = 1 << 9
    #: Candidates and anchors scored at once.
    rows: int = 1 << 11
    anchors: int = 64


# ---- tables and planes -----------------------------------------------------------------------


def bit_planes(ints: np.ndarray) -> np.ndarray:
    """Two's complement of the rows as bytes [plane, group, row], the sign's plane last."""
    bits = int(max(ints.max(initial=0), -1 - ints.min(initial=0))).bit_length() + 1
    groups = -(-ints.shape[1] // GROUP)
    wide = np.zeros((len(ints), groups * GROUP), np.int64)
    wide[:, : ints.shape[1]] = ints
    planes = [np.packbits((wide >> p) & 1, axis=1, bitorder="little").T for p in range(bits)]
    return np.ascontiguousarray(np.stack(planes))


def from_planes(planes: np.ndarray) -> np.ndarray:
    """The integers [row, dimension] of ``bit_planes``."""
    parts = [np.unpackbits(p.T, axis=1, bitorder="little").astype(np.int64) << k for k, p in enumerate(planes)]
    return sum(parts[:-1], np.zeros_like(parts[-1])) - parts[-1]


def subset_sums(anchors: np.ndarray, groups: int, kind: type) -> np.ndarray:
    """Table [group, subset, anchor]: the sum of the anchor's components in each subset of a group."""
    wide = np.zeros((groups * GROUP, len(anchors)), kind)
    d = min(anchors.shape[1], len(wide))
    wide[:d] = anchors[:, :d].T
    out = np.zeros((groups, 1 << GROUP, len(anchors)), kind)
    for g in range(groups):
        for bit in range(GROUP):
            half = 1 << bit
            out[g, half : 2 * half] = out[g, :half] + wide[g * GROUP + bit]
    return out


def exact_scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products [row, anchor] by lookups, shifts and additions only."""
    n, a = planes.shape[2], tables.shape[2]
    total = np.zeros((n, a), tables.dtype)
    found, part = np.empty_like(total), np.empty_like(total)
    for k in range(len(planes) - 1, -1, -1):
        part[:] = 0
        for g in range(planes.shape[1]):
            np.take(tables[g], planes[k, g], axis=0, out=found)
            part += found
        total <<= 1
        if k == len(planes) - 1:
            total -= part
        else:
            total += part
    return total


# ---- slices and groups -----------------------------------------------------------------------


def usable_rows(rows: DataFrame, is_anchor: Column, s: Settings) -> DataFrame:
    """(vec_id, wanted, label, ints): one row for each id that takes part; ``wanted`` marks anchors."""
    x = F.transform("embedding", lambda v: v.cast("double") * float(s.scale))
    fits = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float(s.limit)))
    wanted = F.coalesce(is_anchor, F.lit(False)).alias("wanted")
    some = rows.select(F.col("vec_id").cast("long").alias("vec_id"), wanted, F.col("label").cast("long").alias("label"), x.alias("x"))
    some = some.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & fits)
    ints = some.select("vec_id", "wanted", F.struct("label", F.transform("x", lambda v: F.floor(v).cast("int")).alias("ints")).alias("row"))
    one = ints.groupBy("vec_id", "wanted").agg(F.min("row").alias("row"))
    return one.select("vec_id", "wanted", "row.label", "row.ints")


def _bytes(values: np.ndarray, kind: type) -> bytes:
    return np.ascontiguousarray(values, kind).tobytes()


def _long(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64)


def packed_slices(rows: DataFrame, slices: int) -> DataFrame:
    """(slice, ids, labels, wanted, bits, planes): one row for each slice, its rows by rising id."""

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("vec_id")
        held = t.column("ints").combine_chunks()
        sizes = np.diff(held.offsets.to_numpy())
        ints = np.zeros((len(sizes), max(1, sizes.max(initial=0))), np.int64)
        ints[np.arange(ints.shape[1]) < sizes[:, None]] = held.flatten().to_numpy()
        planes = bit_planes(ints)
        return pa.table(
            {
                "slice": t.column("slice").slice(0, 1),
                "ids": [_bytes(_long(t.column("vec_id")), np.int64)],
                "labels": [_bytes(_long(t.column("label")), np.int64)],
                "wanted": [t.column("wanted").to_numpy().astype(bool).tobytes()],
                "bits": pa.array([len(planes)], pa.int32()),
                "planes": [planes.tobytes()],
            }
        )

    dealt = rows.withColumn("slice", F.pmod(F.xxhash64("vec_id"), F.lit(slices)).cast("int"))
    return dealt.groupBy("slice").applyInArrow(pack, "slice int, ids binary, labels binary, wanted binary, bits int, planes binary")


def _planes(row: dict) -> np.ndarray:
    return np.frombuffer(row["planes"], np.uint8).reshape(row["bits"], -1, len(row["ids"]) // 8)


def anchor_rows(packed: DataFrame, groups: int) -> DataFrame:
    """(grp, vec_id, label, ints) of the anchors, their integers packed."""

    def take(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
                at = np.flatnonzero(np.frombuffer(row["wanted"], bool))
                ints = from_planes(_planes(row)[:, :, at]).astype(np.int32)
                yield pa.record_batch(
                    [pa.array(ids[at]), pa.array(labels[at]), pa.array([x.tobytes() for x in ints], pa.binary())],
                    ["vec_id", "label", "ints"],
                )

    out = packed.mapInArrow(take, "vec_id long, label long, ints binary")
    return out.withColumn("grp", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))


class Meeting:
    """The rows of a slice and the anchors of a group."""

    def __init__(self, left: pa.Table, anchors: pa.Table, s: Settings):
        row = left.to_pylist()[0]
        self.s = s
        self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        self.planes = _planes(row)
        self.anchor_ids, self.anchor_labels = _long(anchors.column("vec_id")), _long(anchors.column("label"))
        held = [np.frombuffer(x, np.int32) for x in anchors.column("ints").to_pylist()]
        self.anchors = np.zeros((len(held), max(len(x) for x in held)), np.int64)
        for k, x in enumerate(held):
            self.anchors[k, : len(x)] = x

    def scored(self, anchors: np.ndarray, rows: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, anchors, scores) by parts; rows None for all of the slice."""
        bits, groups, n = self.planes.shape
        for a in range(0, len(anchors), self.s.anchors):
            own = anchors[a : a + self.s.anchors]
            ints = self.anchors[own]
            most = int(np.abs(ints).max(initial=0)) * groups * GROUP << bits
            tables = subset_sums(ints, groups, np.int32 if most < 1 << 30 else np.int64)
            for r in range(0, n if rows is None else len(rows), self.s.rows):
                if rows is None:
                    some = np.arange(r, min(n, r + self.s.rows))
                    yield some, own, exact_scores(tables, self.planes[:, :, r : r + self.s.rows])
                else:
                    some = rows[r : r + self.s.rows]
                    yield some, own, exact_scores(tables, self.planes[:, :, some])


def first_of_each(key: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k entries of each key; equal keys lie together."""
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    since = np.arange(len(key)) - np.repeat(starts, np.diff(np.append(starts, len(key))))
    return np.flatnonzero(since < k)


FOUND = "anchor_id long, positive_id long, positive_score long"
MINED = f"{FOUND}, negative_id long, negative_score long"


def _positives(left: pa.Table, right: pa.Table, s: Settings) -> pa.Table:
    out = []
    if left.num_rows and right.num_rows:
        m = Meeting(left, right, s)
        for label in np.unique(m.anchor_labels):
            rows = np.flatnonzero(m.labels == label)
            for some, own, score in m.scored(np.flatnonzero(m.anchor_labels == label), rows):
                k = min(len(some), s.positives + 1)
                # A row's place breaks ties, as rows lie by rising id.
                least = -np.partition(-score, k - 1, axis=0)[k - 1]
                r, a = np.nonzero((score >= least) & (m.ids[some][:, None] != m.anchor_ids[own][None]))
                sort = np.lexsort((r, -score[r, a].astype(np.int64), a))
                keep = sort[first_of_each(a[sort], s.positives)]
                out.append((m.anchor_ids[own[a[keep]]], m.ids[some[r[keep]]], score[r[keep], a[keep]].astype(np.int64)))
    return _best(out, FOUND, s.positives)


def _negatives(left: pa.Table, right: pa.Table, s: Settings) -> pa.Table:
    out = []
    if left.num_rows and right.num_rows:
        m = Meeting(left, right, s)
        held = right.column("positives").to_pylist()
        ids, scores = np.zeros((len(held), s.positives), np.int64), np.zeros((len(held), s.positives), np.int64)
        there = np.zeros((len(held), s.positives), bool)
        for k, own in enumerate(held):
            for at, x in enumerate(own):
                ids[k, at], scores[k, at], there[k, at] = x["positive_id"], x["positive_score"], True
        low, high = -(-s.low * scores // 100), s.high * scores // 100
        there &= low <= high
        none = np.iinfo(np.int64)
        least, most = np.where(there, low, none.max).min(axis=1), np.where(there, high, none.min).max(axis=1)
        for some, own, score in m.scored(np.flatnonzero(there.any(axis=1))):
            ok = (score >= least[own]) & (score <= most[own]) & (m.labels[some][:, None] != m.anchor_labels[own])
            r, a = np.nonzero(ok)
            value = score[r, a].astype(np.int64)
            sort = np.lexsort((r, -value, a))
            r, a, value = r[sort], a[sort], value[sort]
            for p in range(s.positives):
                at = own[a]
                hit = np.flatnonzero(there[at, p] & (value >= low[at, p]) & (value <= high[at, p]))
                hit = hit[first_of_each(a[hit], s.negatives)]
                at = own[a[hit]]
                out.append((m.anchor_ids[at], ids[at, p], scores[at, p], m.ids[some[r[hit]]], value[hit]))
    return _best(out, MINED, s.negatives)


def _best(parts: list[tuple[np.ndarray, ...]], schema: str, k: int) -> pa.Table:
    """The first k found for each anchor (and positive): by falling score, then rising id, the last two columns."""
    names = [c.split()[0] for c in schema.split(", ")]
    columns = zip(*parts, strict=True) if parts else [[np.zeros(0, np.int64)] for _ in names]
    own = [np.concatenate(x) for x in columns]
    keys = own[:1] if len(own) == 3 else own[:2]
    order = np.lexsort((own[-2], -own[-1], *reversed(keys)))
    key = np.unique(np.stack(keys)[:, order], axis=1, return_inverse=True)[1].ravel() if len(order) else order
    order = order[first_of_each(key, k)]
    return pa.table({c: x[order] for c, x in zip(names, own, strict=True)})


# ---- the operator ----------------------------------------------------------------------------


def hard_negatives(rows: DataFrame, is_anchor: Column, s: Settings = Settings()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` holds vec_id, label and embedding; ``is_anchor`` is a condition on vec_id."""
    spark = rows.sparkSession
    size = rows.agg(F.count("*").alias("rows"), F.count_if(is_anchor).alias("anchors")).first()
    cores = spark.sparkContext.defaultParallelism
    slices = max(1, -(-size["rows"] // s.slice), min(2 * cores, size["rows"] // s.small))
    groups = max(1, -(-size["anchors"] // s.group))
    packed = stored(packed_slices(usable_rows(rows, is_anchor, s), slices))
    anchors = stored(anchor_rows(packed, groups))
    cells = packed.drop("wanted").withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def meet(these: DataFrame, function, schema: str) -> DataFrame:
        dealt = these.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        both = cells.groupBy("slice", "grp").cogroup(dealt.groupBy("slice", "grp"))
        return both.applyInArrow(lambda left, right: function(left, right, s), schema)

    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    first = meet(anchors, _positives, FOUND).withColumn("at", F.row_number().over(order)).filter(F.col("at") <= s.positives)
    positives = first.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    ready = stored(anchors.join(positives, anchors["vec_id"] == positives["anchor_id"]).drop("anchor_id"))
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    mined = meet(ready, _negatives, MINED).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= s.negatives)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
