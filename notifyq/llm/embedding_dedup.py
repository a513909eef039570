"""Near-duplicate vectors by a robust-pruned flat graph over overlapping shards.

Vectors with equal components and label are one class. Each label's classes are dealt to the
nearest of some centroids, each to several of them, which makes overlapping shards. A shard
is cut into blocks of bounded size; for each block a graph is built whose edges are robustly
pruned, and a class's adjacency lists of all blocks are united. Every class then searches
the blocks of all its shards: greedily from the block's medoid to its neighbourhood, from
there to everything around it that is similar enough. Pairs are verified by their cosine in
double precision.

Every search is audited in two ways: the pairs found for a set of classes are compared with brute
force, and planted probes, classes turned by an angle that still links, must find the class they
were made from, so that recall is measured where few rows link too. While either falls short, classes are dealt to
more shards; where all shards are used and it still does, blocks are compared exactly.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notifyq.llm.common import components, stored

_LOG = logging.getLogger(__name__)


@dataclass(frozen=True)
class Graph:
    """Parameters of shards, graph and search."""

    cosine: float = 0.98
    #: Classes of a shard, on average; centroids at most, over all labels.
    shard: int = 600
    centroids: int = 4096
    #: Shards a class is dealt to at first.
    overlap: int = 2
    #: Classes of a block; queries of one task for it.
    block: int = 1024
    queries: int = 4096
    degree: int = 16
    alpha: float = 1.2
    beam: int = 12
    #: A search goes on through everything of this cosine, wider than the one asked for.
    range_cosine: float = 0.85
    #: The audit: classes of its first pass, each further one drawing twice as many; pairs to
    #: be seen; passes at most; and the recall to be reached.
    audit_rows: int = 256
    audit_links: int = 200
    audit_passes: int = 4
    recall: float = 0.98
    #: Planted probes, and the largest cosine with their class; the smallest is ``cosine``.
    probes: int = 512
    probe_cosine: float = 0.995
    #: Compare each query with all of a block instead of searching the block's graph.
    exact: bool = False
    #: Bounded sample from which centroids are fitted.
    sample: int = 16_384
    rounds: int = 4


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def pruned_graph(vectors: np.ndarray, g: Graph) -> list[np.ndarray]:
    """Adjacency of a block's unit vectors: of each one's nearest, those to which no chosen
    one is nearer by the factor alpha."""
    n = len(vectors)
    out = []
    k = min(n - 1, 4 * g.degree)
    for lo in range(0, n, 256):
        near = vectors[lo : lo + 256] @ vectors.T
        near[np.arange(len(near)), np.arange(lo, lo + len(near))] = -2
        order = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else np.zeros((len(near), 0), np.int64)
        for row, some in zip(near, order, strict=True):
            some = some[np.argsort(-row[some], kind="stable")]
            apart = 1 - vectors[some] @ vectors[some].T
            far, kept, open_ = 1 - row[some], [], np.ones(len(some), bool)
            while open_.any() and len(kept) < g.degree:
                at = int(np.argmax(open_))
                kept.append(some[at])
                open_ &= g.alpha * apart[at] > far
                open_[at] = False
            out.append(np.array(kept, np.int64))
    return out


def reachable(lists: list[np.ndarray], medoid: int) -> list[np.ndarray]:
    """The lists made two-way, with parts that the medoid does not reach tied to it."""
    both: list[set[int]] = [set(map(int, x)) for x in lists]
    for a, near in enumerate(lists):
        for b in near:
            both[b].add(a)
    seen, stack, order = {medoid}, [medoid], iter(range(len(lists)))
    while True:
        while stack:
            new = both[stack.pop()] - seen
            seen |= new
            stack += new
        left = next((x for x in order if x not in seen), None)
        if left is None:
            return [np.array(sorted(x), np.int64) for x in both]
        both[medoid].add(left)
        both[left].add(medoid)
        seen.add(left)
        stack.append(left)


def range_search(query: np.ndarray, vectors: np.ndarray, near: list[np.ndarray], medoid: int, g: Graph) -> np.ndarray:
    """Indices found with a cosine of ``g.cosine`` or more.

    Best first from the medoid with a beam; then on through all neighbours of whatever has
    the wider ``range_cosine``, until nothing new has it."""
    score = {medoid: float(vectors[medoid] @ query)}
    done: set[int] = set()
    while True:
        best = sorted(score, key=score.__getitem__, reverse=True)[: g.beam]
        todo = [x for x in best if x not in done] or [x for x, s in score.items() if s >= g.range_cosine and x not in done]
        if not todo:
            break
        done.update(todo)
        new = np.unique(np.concatenate([near[x] for x in todo]))
        new = [x for x in new.tolist() if x not in score]
        if new:
            score.update(zip(new, (vectors[new] @ query).tolist(), strict=True))
    found = np.fromiter(score.keys(), np.int64, len(score))
    return found[np.fromiter(score.values(), np.float64, len(score)) >= g.cosine]


def _classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vec_id, class_key) of the rows that can link; and the classes: class_key, label, root
    (smallest vec_id), size (rows) and unit (unit vector as doubles)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = rows.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
        & F.exists("embedding", lambda x: x != 0)
    )
    # -0.0 and 0.0 are equal as numbers: adding 0.0 makes them alike.
    numbers = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    key = F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.to_json(numbers)).cast("binary"), 256)
    keyed = usable.select("vec_id", "label", "embedding", F.unhex(F.substring(key, 1, 32)).alias("class_key"))
    ids = stored(keyed.select("vec_id", "class_key"))
    size = ids.groupBy("class_key").agg(F.min("vec_id").alias("root"), F.count("*").alias("size"))
    first = keyed.join(size, "class_key").filter("vec_id = root").dropDuplicates(["class_key"])

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for v in b.column("embedding").to_pylist():
                x = np.array(v, np.float64)
                x = x / np.abs(x).max()
                made.append((x / np.sqrt(x @ x)).tobytes())
            rest = b.drop_columns(["embedding"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(made, pa.binary())], names=[*rest.schema.names, "unit"])

    columns = first.select("class_key", F.col("label").cast("string").alias("label"), "root", "size", "embedding")
    made = columns.mapInArrow(unit, "class_key binary, label string, root long, size long, unit binary")
    # Vectors of another length have no cosine with each other: they are labels apart.
    return ids, stored(made.withColumn("label", F.concat_ws("/", "label", F.octet_length("unit").cast("string"))))


def _centroids(classes: DataFrame, g: Graph) -> dict[str, np.ndarray]:
    """Unit centroids of each label, fitted on a bounded sample of classes."""
    counts = {r["label"]: r["n"] for r in classes.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(g.centroids).collect()}
    total = sum(counts.values())
    rows = classes.select("label", "unit").orderBy(F.xxhash64("root"), "root").limit(g.sample).collect()
    by_label: dict[str, list[bytes]] = {}
    for r in rows:
        by_label.setdefault(r["label"], []).append(r["unit"])
    out = {}
    for label, units in by_label.items():
        x = np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)
        k = min(len(x), max(1, round(min(counts.get(label, 1) / g.shard, g.centroids * counts.get(label, 1) / max(1, total)))))
        c = x[:k].copy()
        for _ in range(g.rounds):
            at = np.argmax(x @ c.T, axis=1)
            for j in range(k):
                mean = x[at == j].sum(0)
                if np.any(mean):
                    c[j] = mean / np.linalg.norm(mean)
        out[label] = c
    return out


def _dealt(classes: DataFrame, centroids: dict[str, np.ndarray], overlap: int) -> DataFrame:
    """(shard, shards, root, size, unit): each class in its nearest shards; ``shards`` are all
    of them. A label outside the sample has one shard."""
    sent = classes.sparkSession.sparkContext.broadcast(centroids)  # bounded by Graph.centroids

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            picks = []
            for label, raw in zip(b.column("label").to_pylist(), b.column("unit").to_pylist(), strict=True):
                c = sent.value.get(label)
                near = [0] if c is None else np.argsort(-(c @ np.frombuffer(raw, np.float64)), kind="stable")[:overlap]
                picks.append([f"{label}/{int(j)}" for j in near])
            kept = b.select(["root", "size", "unit"])
            yield pa.RecordBatch.from_arrays([pa.array(picks, pa.list_(pa.string())), *kept.columns], ["shards", "root", "size", "unit"])

    rows = classes.mapInArrow(deal, "shards array<string>, root long, size long, unit binary")
    return stored(rows.select(F.explode("shards").alias("shard"), "shards", "root", "size", "unit"))


def _planted(classes: DataFrame, g: Graph) -> DataFrame:
    """(label, root, size, unit) of up to ``g.probes`` classes, each turned at random so that its
    cosine with what it was lies between ``cosine`` and ``probe_cosine``; root is the bitwise not of the class's."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for root, raw in zip(b.column("root").to_pylist(), b.column("unit").to_pylist(), strict=True):
                u, rng = np.frombuffer(raw, np.float64), np.random.default_rng(abs(root))
                side = rng.normal(size=len(u))
                side -= (side @ u) * u
                norm = np.sqrt(side @ side)
                c = rng.uniform(g.cosine + 1e-6, g.probe_cosine) if norm > 1e-9 else 1.0
                x = c * u + (np.sqrt(1 - c * c) / norm * side if norm > 1e-9 else 0)
                made.append((x / np.sqrt(x @ x)).tobytes())
            rest = [b.column("label"), pa.array([~r for r in b.column("root").to_pylist()], pa.int64()), b.column("size")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(made, pa.binary())], ["label", "root", "size", "unit"])

    some = classes.orderBy(F.xxhash64("root", F.lit(11)), "root").limit(g.probes).select("label", "root", "size", "unit")
    return stored(some.mapInArrow(turn, "label string, root long, size long, unit binary"))


def _blocked(dealt: DataFrame, probes: DataFrame, g: Graph) -> tuple[DataFrame, DataFrame]:
    """Members (shard, block, ...) and queries (the same, for every block of their shard,
    dealt over salts; kind 1, or 2 for a probe): a shard of any size is worked on in tasks of bounded size."""
    sizes = dealt.groupBy("shard").agg(F.count("*").alias("n"))
    cut = stored(sizes.select("shard", F.ceil(F.col("n") / g.block).cast("int").alias("blocks"), F.ceil(F.col("n") / g.queries).cast("int").alias("salts")))
    both = dealt.join(cut, "shard")
    members = both.withColumn("block", F.pmod(F.xxhash64("root"), F.col("blocks")).cast("int"))
    asked = both.withColumn("kind", F.lit(1)).unionByName(probes.join(cut, "shard").withColumn("kind", F.lit(2)))
    queries = asked.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn(
        "salt", F.pmod(F.xxhash64("root", F.lit(1)), F.col("salts")).cast("int")
    )
    return members, queries


def _united(members: DataFrame, g: Graph) -> DataFrame:
    """(root, near): each class's neighbours, united over the blocks it is in."""

    def build(part: pa.Table) -> pa.Table:
        roots = part.column("root").to_numpy()
        lists = pruned_graph(_matrix(part.column("unit")), g)
        return pa.table({"root": roots, "near": pa.array([roots[x].tolist() for x in lists], pa.list_(pa.int64()))})

    lists = members.groupBy("shard", "block").applyInArrow(build, "root long, near array<bigint>")
    return lists.groupBy("root").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def _searched(members: DataFrame, queries: DataFrame, g: Graph) -> DataFrame:
    """Rows (root, links, other, pairs): the rows and classes linked with a class, counted where
    its pair is at home, and edges to one member of each connected part of the block that it links with.

    A pair that shares several shards is counted in the first of them only. A probe that finds its
    class is a row whose links are PROBE."""
    place = lambda salt: F.xxhash64("shard", "block", salt).alias("place")
    none = F.lit(None).cast("array<bigint>").alias("near")
    salted = members.withColumn("salt", F.explode(F.expr("sequence(0, salts - 1)")))
    columns = ["shard", "shards", "root", "size", "unit"]
    rows = salted.select(place("salt"), F.lit(0).alias("kind"), *columns, "near").unionAll(
        queries.select(place("salt"), "kind", *columns, none)
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, block = None, None
        for b in batches:
            out: list[tuple[int, int, int | None, int]] = []
            names = ("place", "kind", "shard", "shards", "root", "size", "unit", "near")
            for at, kind, shard, shards, root, size, raw, near in zip(*(b.column(c).to_pylist() for c in names), strict=True):
                if at != place:
                    place, block = at, _Block(g)
                if kind == 0:
                    block.add(shards, root, size, raw, near or [])
                elif kind == 1:
                    out += block.search(shard, shards, root, raw)
                elif block.finds(root, raw):
                    out.append((root, PROBE, None, 0))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(4)], ["root", "links", "other", "pairs"])

    met = rows.repartition("place").sortWithinPartitions("place", "kind", "root")
    return met.mapInArrow(search, "root long, links long, other long, pairs long")


#: Links of a row that says a probe has found its class.
PROBE = -1


class _Block:
    """A block's members and their united adjacency lists."""

    def __init__(self, g: Graph):
        self.g, self.rows, self.ready = g, [], False

    def add(self, shards: list[str], root: int, size: int, raw: bytes, near: list[int]) -> None:
        self.rows.append((shards, root, size, raw, near))

    def _open(self) -> None:
        self.ready = True
        self.roots = np.array([r[1] for r in self.rows], np.int64)
        self.sizes = np.array([r[2] for r in self.rows], np.int64)
        self.vectors = np.frombuffer(b"".join(r[3] for r in self.rows), np.float64).reshape(len(self.rows), -1)
        place = {int(r): k for k, r in enumerate(self.roots)}
        lists = [np.array([place[x] for x in r[4] if x in place], np.int64) for r in self.rows]
        self.medoid = int(np.argmax(self.vectors @ self.vectors.mean(0)))
        self.near = reachable(lists, self.medoid)
        self.part = np.arange(len(self.rows))

    def _found(self, raw: bytes) -> np.ndarray:
        if not self.ready:
            self._open()
        query = np.frombuffer(raw, np.float64)
        if self.g.exact:
            return np.flatnonzero(self.vectors @ query >= self.g.cosine)
        return range_search(query, self.vectors, self.near, self.medoid, self.g)

    def finds(self, root: int, raw: bytes) -> bool:
        """Whether a probe meets the class it was made from."""
        return bool((self.roots[self._found(raw)] == ~root).any())

    def search(self, shard: str, shards: list[str], root: int, raw: bytes) -> list[tuple[int, int, int | None, int]]:
        found = self._found(raw)
        found = found[self.roots[found] != root]
        if not len(found):
            return []
        at_home = [k for k in found if next(s for s in shards if s in set(self.rows[k][0])) == shard]
        links = int(self.sizes[at_home].sum())
        # What a query links with is connected by it: later queries need one edge for it.
        parts, first = np.unique(self.part[found], return_index=True)
        edges = [(root, 0, int(x), 0) for x in self.roots[found[first]]]
        self.part[np.isin(self.part, parts)] = parts[0]
        return [(root, links, None, len(at_home)), *edges]


def recall(classes: DataFrame, links: DataFrame, g: Graph) -> float | None:
    """Share of the truly linked pairs of classes that were found, or None if none was seen.

    Classes drawn by a hash are compared with all of their label by brute force in blocks;
    passes of growing size draw on until ``audit_links`` pairs were seen, all classes are
    used or ``audit_passes`` are done, so the work grows with the table and not its square."""
    most = g.audit_rows * ((1 << g.audit_passes) - 1)
    picked = classes.orderBy(F.xxhash64("root", F.lit(7)), "root").limit(most).select("root", "label", "unit").collect()
    found = links.groupBy("root").agg(F.sum("pairs").alias("found"))
    true = got = at = 0
    for k in range(g.audit_passes):
        some, at = picked[at : at + (g.audit_rows << k)], at + (g.audit_rows << k)
        if not some or true >= g.audit_links:
            break
        seen = _true_pairs(classes, some, g).join(found, "root", "left").agg(F.sum("true"), F.sum(F.coalesce("found", F.lit(0)))).first()
        true, got = true + (seen[0] or 0), got + (seen[1] or 0)
    return got / true if true else None


def _true_pairs(classes: DataFrame, picked: list, g: Graph) -> DataFrame:
    """(root, true): how many other classes each of the picked ones is truly linked with."""
    by_label: dict[str, list] = {}
    for r in picked:
        by_label.setdefault(r["label"], []).append((r["root"], r["unit"]))
    sent = classes.sparkSession.sparkContext.broadcast(by_label)

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roots, labels = np.asarray(b.column("root")), np.array(b.column("label").to_pylist())
            out = []
            for label, queries in sent.value.items():
                at = np.flatnonzero(labels == label)
                units = _matrix(b.column("unit").take(pa.array(at))) if len(at) else None
                for lo in range(0, len(queries) if len(at) else 0, 256):
                    own = np.array([root for root, _ in queries[lo : lo + 256]], np.int64)
                    asked = np.stack([np.frombuffer(raw, np.float64) for _, raw in queries[lo : lo + 256]])
                    hit = (units @ asked.T >= g.cosine) & (roots[at][:, None] != own)
                    out += zip(own.tolist(), hit.sum(0).tolist(), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["root", "true"])

    made = classes.select("root", "label", "unit").mapInArrow(brute, "root long, true long")
    return made.groupBy("root").agg(F.sum("true").alias("true"))


def near_duplicates(rows: DataFrame, g: Graph | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of (vec_id, embedding, label).

    Only vectors of equal, non-null label are compared. Vectors that are null, empty, zero or
    hold null or non-finite components, and rows without vec_id, link with nothing; their
    component is their own vec_id. n_links counts the other rows linked directly, equal
    vectors among them; rows that repeat a vec_id are rows of one node. Extra columns are
    ignored; an empty table gives an empty result.
    """
    g = g or Graph()
    ids, classes = _classes(rows)
    centroids, overlap = _centroids(classes, g), g.overlap
    most = max((len(c) for c in centroids.values()), default=1)
    planted = _planted(classes, g)
    probes = planted.count()
    while True:
        members, queries = _blocked(_dealt(classes, centroids, overlap), _dealt(planted, centroids, overlap), g)
        united = stored(_united(members, g))
        both = stored(_searched(members.join(united, "root"), queries, g))
        found = both.filter(F.col("links") != PROBE)
        share = recall(classes, found, g)
        met = both.filter(F.col("links") == PROBE).select("root").distinct().count()
        _LOG.info("overlap %s, exact %s: recall of audited pairs %s, of probes %s of %s", overlap, g.exact, share, met, probes)
        if (share is None or share >= g.recall) and met >= g.recall * probes:
            break
        if overlap < most:
            overlap *= 2
        elif not g.exact:
            g = replace(g, exact=True)
        else:
            break  # every class was compared with every other one of its label
    reached = components(stored(found.filter("other IS NOT NULL").select(F.col("root").alias("a"), F.col("other").alias("b"))))
    per_root = found.groupBy("root").agg(F.sum("links").alias("links"))
    per_class = stored(
        classes.select("class_key", "root", "size").join(per_root, "root", "left")
        .join(reached.withColumnRenamed("node", "root"), "root", "left")
        .select("class_key", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "root").alias("component_id"))
    )
    linked = stored(ids.join(per_class, "class_key").select("vec_id", "n_links", "component_id").distinct())
    # Rows of one id in several classes: all their links, and the smallest component.
    one = linked.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = rows.select(F.col("vec_id").cast("long").alias("vec_id")).join(one, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
