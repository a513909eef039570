"""Exact Jaccard self-join of documents on word n-grams by a token-group matrix.

Documents with equal shingle sets are one class. Classes are partitioned into groups by
the smallest hash of their tokens, which similar sets tend to share; large groups are cut
into blocks. The matrix says which groups hold a token among their members' first tokens; a
query's first tokens give the groups it may have links in. There the overlap with the
group's token union bounds the overlap with any member, and only groups that pass are
opened and compared member by member.

The order puts rare tokens first, by hash among themselves, and frequent tokens last. Sets
x and y with similarity of t or more share k tokens among the first n - ceil(t n) + k of
each, whatever the order, so the result does not depend on what counts as frequent. A
query's groups must hold that many of its first tokens. A token's place in a set also bounds
the size of the sets it can start a link with: what stands before it is not shared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notifyq.llm.common import components, slices, stored

#: Members of a block on average, and queries of one task for them.
BLOCK, QUERIES = 64, 4096
#: Groups that are cut into blocks at most; they are sent to the executors.
CUT_GROUPS = 1 << 20
#: A token counts as frequent from this many holders on; the number doubles until at most
#: FREQUENT_MAX tokens are (8 bytes each are sent to the executors).
FREQUENT, FREQUENT_MAX = 16, 1 << 22
#: A set's first tokens are so many that linked sets share one for each so many of theirs.
SHARED_EVERY = 40
#: Tokens of one counting bucket.
BUCKET_TOKENS = 2_000_000
MIN_BUCKETS = 1024
#: Matrix entries that one task holds beside its bucket.
EXPANDED = 2_000_000


@dataclass(frozen=True)
class Rule:
    """Words of a shingle, and per cent of the union that the intersection must have."""

    words: int = 4
    percent: int = 85

    def shared(self, n: int) -> int:
        """Tokens that two linked sets of n or more share among their first ones."""
        return 1 + n // SHARED_EVERY

    def prefix(self, n: int) -> int:
        """Tokens of a set of n among which shared(n) common ones must be."""
        return min(n, n + (-self.percent * n) // 100 + self.shared(n))

    def partner(self, n: int, at: np.ndarray) -> np.ndarray:
        """Largest size of a set that a set of n can link with if its token at place ``at``
        is among their first shared ones."""
        return (100 + self.percent) * (n - at + self.shared(n) - 1) // self.percent - n

    def needs(self, n: int) -> int:
        """Tokens of a set of n that any linked set must hold."""
        return -((-self.percent * n) // 100)

    def links(self, common: np.ndarray, n: int, m: np.ndarray) -> np.ndarray:
        return 100 * common >= self.percent * (n + m - common)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """Word -> 64-bit hash; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 250_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text: A-Z lower-cased, words between
    ASCII white space; with fewer words than a shingle has, the sequence as one."""
    split = [(t or "").encode().lower().split() for t in texts]
    n = [len(ws) for ws in split]
    codes = np.fromiter(map(_HASHES.__getitem__, chain.from_iterable(split)), np.uint64, sum(n))

    def hashed(lo: int, hi: int, take: int) -> np.ndarray:
        """Hash of the ``take`` words from each place on: a polynomial, then mixed."""
        h = np.full(max(0, hi - lo - take + 1), take, np.uint64)
        for k in range(take):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h += codes[lo + k : lo + k + len(h)]
        return _mixed(h)

    whole, out, at = hashed(0, len(codes), words), [], 0
    for count in n:
        if count >= words:
            s = np.sort(whole[at : at + count - words + 1])
            out.append(s[np.append(True, s[1:] != s[:-1])])
        else:
            out.append(hashed(at, at + count, count)[: min(1, count)])
        at += count
    return out


def set_key(tokens: np.ndarray) -> bytes:
    """16-byte digest of a set."""
    return blake2b(tokens.tobytes(), digest_size=16).digest()


def _short(keys: list[bytes]) -> np.ndarray:
    """First 8 bytes of keys as integers; a clash only adds a candidate."""
    return np.frombuffer(b"".join(k[:8] for k in keys), np.int64)


def _classes(batch: pa.RecordBatch, words: int) -> tuple[list[bytes], list[np.ndarray]]:
    """Distinct non-empty sets of a slice."""
    sets = {set_key(s): s for s in shingle_sets(batch.column("text").to_pylist(), words) if len(s)}
    return list(sets), list(sets.values())


def _by_bucket(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """Rows dealt to buckets: (bucket, packed columns)."""
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], tuple(c[order] for c in columns)
    cuts = [*np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket)]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        yield int(bucket[lo]), [c[lo:hi].tobytes() for c in columns]


def _distinct(pairs: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of a 2 x n array, and the sum of their times."""
    times = np.ones(pairs.shape[1], np.int64) if times is None else times
    order = np.lexsort(pairs)
    pairs = pairs[:, order]
    new = np.ones(pairs.shape[1], bool)
    new[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(0)
    first = np.flatnonzero(new)
    return pairs[:, first], np.add.reduceat(times[order], first) if len(first) else times[:0]


def _frequent(docs: DataFrame, rule: Rule, buckets: int) -> np.ndarray:
    """Sorted frequent tokens. Counted are the tokens that come first by hash, half more
    than a link can start at: only those matter for the order of most sets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            _, sets = _classes(b, rule.words)
            if not sets:
                continue
            tokens, n = np.unique(np.concatenate([s[: rule.prefix(len(s)) * 3 // 2] for s in sets]), return_counts=True)
            rows = list(_by_bucket((tokens % np.uint64(buckets)).astype(np.int64), tokens, n.astype(np.uint32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[1][k] for r in rows], pa.binary()) for k in (0, 1))],
                ["bucket", "tokens", "n"],
            )

    def add(part: pa.Table) -> pa.Table:
        tokens = np.frombuffer(b"".join(part.column("tokens").to_pylist()), np.uint64)
        n = np.frombuffer(b"".join(part.column("n").to_pylist()), np.uint32)
        distinct, place = np.unique(tokens, return_inverse=True)
        total = np.bincount(place, n).astype(np.int64)
        often = total >= FREQUENT
        return pa.table({"token": distinct[often].view(np.int64), "n": total[often]})

    counts = stored(docs.mapInArrow(count, "bucket long, tokens binary, n binary").groupBy("bucket").applyInArrow(add, "token long, n long"))
    least = FREQUENT
    while counts.filter(F.col("n") >= least).count() > FREQUENT_MAX:
        least *= 2
    got = counts.filter(F.col("n") >= least).select("token").toArrow().column("token").to_numpy()
    return np.sort(got.view(np.uint64))


def _ordered_prefix(tokens: np.ndarray, frequent: np.ndarray, rule: Rule) -> np.ndarray:
    """The tokens of a set among which a link must start, in the global order."""
    at = np.minimum(np.searchsorted(frequent, tokens), max(0, len(frequent) - 1))
    often = frequent[at] == tokens if len(frequent) else np.zeros(len(tokens), bool)
    return np.concatenate([tokens[~often], tokens[often]])[: rule.prefix(len(tokens))]


@dataclass
class _Groups:
    """Group of a class: its smallest token, and a block where that group is cut."""

    cut: np.ndarray  # sorted smallest tokens of the groups that are cut
    blocks: np.ndarray

    @classmethod
    def of(cls, roots: DataFrame) -> _Groups:
        """From (first, ...) rows, one for each class. A group is cut if it has more than
        BLOCK members and that share of all that bounds the number of such groups."""
        least = max(BLOCK, roots.count() // CUT_GROUPS) + 1
        rows = roots.groupBy("first").agg(F.count("*").alias("n")).filter(F.col("n") >= least).toArrow()
        first, n = rows.column("first").to_numpy().view(np.uint64), rows.column("n").to_numpy()
        order = np.argsort(first)
        return cls(first[order], -(-n[order] // BLOCK))

    def place(self, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
        if not len(self.cut):
            return first
        at = np.minimum(np.searchsorted(self.cut, first), len(self.cut) - 1)
        block = classes.view(np.uint64) % self.blocks[at].astype(np.uint64)
        return np.where(self.cut[at] == first, _mixed(first + block), first)


_POSTED = {"tokens": np.uint64, "groups": np.uint64, "classes": np.int64, "n": np.uint32, "partner": np.int32}


def _candidates(docs: DataFrame, frequent: np.ndarray, groups: _Groups, rule: Rule, buckets: int) -> DataFrame:
    """(class, grp, n): groups that hold some of a class's first tokens in sets of fitting
    sizes, and how many tokens; each pair of groups one way, its own group if another class
    there holds the token too."""
    sent = docs.sparkSession.sparkContext.broadcast((frequent, groups))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, groups = sent.value
        for b in slices(batches, "text"):
            keys, sets = _classes(b, rule.words)
            if not keys:
                continue
            starts = [_ordered_prefix(s, frequent, rule) for s in sets]
            times = [len(s) for s in starts]
            classes = _short(keys)
            own = groups.place(np.array([s[0] for s in sets], np.uint64), classes)
            rows = {
                "tokens": np.concatenate(starts), "groups": np.repeat(own, times), "classes": np.repeat(classes, times),
                "n": np.repeat([len(s) for s in sets], times),
                "partner": np.concatenate([rule.partner(len(s), np.arange(k)) for s, k in zip(sets, times, strict=True)]),
            }
            packed = list(_by_bucket((rows["tokens"] % np.uint64(buckets)).astype(np.int64), *(rows[c].astype(t) for c, t in _POSTED.items())))
            columns = [pa.array([r[1][k] for r in packed], pa.binary()) for k in range(len(_POSTED))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in packed], pa.int64()), *columns], ["bucket", *_POSTED])

    def match(part: pa.Table) -> pa.Table:
        tokens, groups, classes, n, partner = (np.frombuffer(b"".join(part.column(c).to_pylist()), t) for c, t in _POSTED.items())
        order = np.lexsort((classes, groups, tokens))
        tokens, groups, classes, n, partner = (x[order] for x in (tokens, groups, classes, n.astype(np.int64), partner))
        new_token, new_group, new_class = (np.append(True, x[1:] != x[:-1]) for x in (tokens, groups, classes))
        new_group |= new_token
        once = np.flatnonzero(new_group | new_class)  # a class comes from several slices
        tokens, classes, n, partner = (x[once] for x in (tokens, classes, n, partner))
        new_token, new_group = np.append(True, tokens[1:] != tokens[:-1]), np.append(True, (groups[once][1:] != groups[once][:-1]) | (tokens[1:] != tokens[:-1]))
        groups = groups[once]
        # The matrix: an entry for each token and group, with what its members allow.
        entry, first = np.cumsum(new_group) - 1, np.flatnonzero(new_group)
        held, group = np.diff(np.append(first, len(tokens))), groups[first]
        least, most = np.minimum.reduceat(n, first), np.maximum.reduceat(partner, first)
        last = np.append(np.flatnonzero(new_token[first])[1:], len(first))[np.cumsum(new_token[first]) - 1]  # of the token
        home = held[entry] > 1
        pairs, times = _distinct(np.stack([classes, groups.view(np.int64)])[:, home])
        later = last[entry] - entry - 1
        many = np.flatnonzero(later)
        steps = np.cumsum(later[many]) // EXPANDED  # entries of the matrix at a time
        for chunk in np.split(many, np.flatnonzero(np.diff(steps)) + 1):
            k = later[chunk]
            at = np.repeat(entry[chunk] + 1 - (np.cumsum(k) - k), k) + np.arange(k.sum())
            q = np.repeat(chunk, k)
            fits = (least[at] <= partner[q]) & (n[q] <= most[at])
            new = np.stack([classes[q[fits]], group[at[fits]].view(np.int64)])
            times = np.concatenate([times, np.ones(new.shape[1], np.int64)])
            pairs, times = _distinct(np.concatenate([pairs, new], axis=1), times)
        return pa.table({"class": pairs[0], "grp": pairs[1], "n": times})

    schema = ", ".join(["bucket long", *(f"{c} binary" for c in _POSTED)])
    found = docs.mapInArrow(post, schema).groupBy("bucket").applyInArrow(match, "class long, grp long, n long")
    return found.groupBy("class", "grp").agg(F.sum("n").alias("n"))


def _links(rows: DataFrame, rule: Rule) -> DataFrame:
    """Edges (a, b) between classes' roots, enough to connect all that link.

    Rows (place, kind, root, tokens) meet by place: the members of a block first (kind 0),
    then the queries stream past them (kind 1). Members are linked with the smallest of
    their connected part of the block, a query with one member of each part it links with.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, block, edges = None, None, []
        for b in slices(batches, "tokens"):
            columns = (b.column(c).to_pylist() for c in ("place", "kind", "root", "tokens"))
            for at, kind, root, raw in zip(*columns, strict=True):
                if at != place:
                    edges += block.inner() if block else []
                    place, block = at, _Block(rule)
                if kind == 0:
                    block.add(root, np.frombuffer(raw, np.uint64))
                else:
                    edges += block.linked(root, np.frombuffer(raw, np.uint64))
            yield _edge_batch(edges)
            edges = []
        yield _edge_batch(block.inner() if block else [])

    met = rows.repartition("place").sortWithinPartitions("place", "kind", "root")
    return met.mapInArrow(compare, "a long, b long").distinct()


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = [pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b"])


class _Block:
    """Members of a group that one task compares with queries."""

    def __init__(self, rule: Rule):
        self.rule = rule
        self.roots: list[int] = []
        self.sets: list[np.ndarray] = []
        self.open = False

    def add(self, root: int, tokens: np.ndarray) -> None:
        self.roots.append(root)
        self.sets.append(tokens)

    def _open(self) -> None:
        """The group's token union, as all members' tokens sorted, with their owners; and
        which members are connected among themselves."""
        if self.open:
            return
        self.open = True
        sizes = np.array([len(s) for s in self.sets], np.int64)
        tokens = np.concatenate(self.sets) if self.sets else np.zeros(0, np.uint64)
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.owners = tokens[order], np.repeat(np.arange(len(sizes)), sizes)[order]
        self.sizes, self.ids, self.part = sizes, np.array(self.roots, np.int64), np.arange(len(sizes))
        if len(sizes) > 1:
            for k, s in enumerate(self.sets):
                for other in np.unique(self.part[self._hits(s)]):
                    self.part[self.part == other] = self.part[k]

    def _hits(self, tokens: np.ndarray) -> np.ndarray:
        """Members that link with a set; none if the bound by the union rules them out."""
        lo, hi = np.searchsorted(self.tokens, tokens, "left"), np.searchsorted(self.tokens, tokens, "right")
        n = hi - lo
        if np.count_nonzero(n) < self.rule.needs(len(tokens)):
            return np.zeros(len(self.sizes), bool)
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        common = np.bincount(self.owners[at], minlength=len(self.sizes))
        return self.rule.links(common, len(tokens), self.sizes)

    def inner(self) -> list[tuple[int, int]]:
        """Members linked with the smallest of their connected part."""
        self._open()
        out = []
        for part in np.unique(self.part):
            ids = self.ids[self.part == part]
            out += [(int(i), int(ids.min())) for i in ids if i != ids.min()]
        return out

    def linked(self, root: int, tokens: np.ndarray) -> list[tuple[int, int]]:
        """A query linked with one member of each connected part."""
        self._open()
        at = np.flatnonzero(self._hits(tokens))
        _, first = np.unique(self.part[at], return_index=True)
        return [(root, int(i)) for i in self.ids[at[first]]]


def _grouped(roots: DataFrame, groups: _Groups) -> DataFrame:
    """``roots`` with class and grp."""
    sent = roots.sparkSession.sparkContext.broadcast(groups)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            classes = _short(b.column("set_key").to_pylist())
            first = np.asarray(b.column("first")).view(np.uint64)
            own = sent.value.place(first, classes).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(classes), pa.array(own)], names=[*b.schema.names, "class", "grp"])

    return roots.mapInArrow(place, "set_key binary, root long, n long, first long, class long, grp long")


def _places(grouped: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """(place, kind, set_key, root): where the members of groups and their queries meet.

    A class asks the groups that hold enough of its first tokens and have members of a
    fitting size. A group that is asked, by a member too, is opened: its members come to as
    many salted copies as its queries need, QUERIES to each, so that no group is bound to
    one task.
    """
    needs = f"(n * {rule.percent} + 99) div 100"
    sizes = grouped.groupBy("grp").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    asking = stored(
        pairs.withColumnRenamed("n", "held")
        .join(grouped.select("class", "set_key", "root", "n", F.col("grp").alias("own")), "class")
        .filter(f"held >= 1 + {needs} div {SHARED_EVERY}").join(sizes, "grp")
        .filter(f"100 * n >= {rule.percent} * least AND 100 * most >= {rule.percent} * n")
        .select("set_key", "root", "grp", (F.col("grp") == F.col("own")).alias("home"))
    )
    asked = asking.groupBy("grp").agg(F.count(F.when(~F.col("home"), 1)).alias("asked"))
    salts = stored(asked.select("grp", (F.floor(F.col("asked") / QUERIES) + 1).cast("int").alias("salts")))
    salt = F.pmod(F.xxhash64("root"), F.col("salts")).cast("int")
    members = grouped.join(salts, "grp").select(
        "set_key", "root", "grp", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind")
    )
    queries = asking.filter(~F.col("home")).join(salts, "grp").select("set_key", "root", "grp", salt.alias("salt"), F.lit(1).alias("kind"))
    return members.unionAll(queries).select(F.xxhash64("grp", "salt").alias("place"), "kind", "set_key", "root")


#: Bits of the filter for wanted documents: ten for each, and at most so many.
FILTER_BITS = 1 << 27


def _wanted_sets(docs: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """(set_key, tokens): the sets of the classes' smallest documents, made again from their
    texts. A bit filter of their ids, of bounded size, spares most other documents the work;
    what passes it wrongly finds no partner in the join."""
    roots = wanted.select("root").distinct()
    n = roots.count()
    words = min(FILTER_BITS, max(1024, 10 * n)) // 64
    place = F.pmod(F.xxhash64("root"), F.lit(words * 64))
    bits = roots.select(place.alias("p")).groupBy(F.expr("p div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("value")
    )
    got = bits.toArrow()  # as many rows at most as the filter has words
    table = np.zeros(words, np.int64)
    table[got.column("word").to_numpy()] = got.column("value").to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.asarray(b.column("p"))
            hit = (sent.value[p >> 6] >> (p & 63)) & 1
            for some in slices([b.filter(pa.array(hit == 1))], "text"):
                keys, sets = _classes(some, rule.words)
                made = [pa.array(keys, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(made, ["set_key", "tokens"])

    rows = docs.select("text", F.pmod(F.xxhash64("doc_id"), F.lit(words * 64)).alias("p"))
    return rows.mapInArrow(sets_of, "set_key binary, tokens binary").dropDuplicates(["set_key"])


def jaccard_components(docs: DataFrame, rule: Rule | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of each row.

    component_id is the smallest doc_id reachable by links, its own included; a document
    without words links with nothing. Rows that share an id are one document: a link of any
    is a link of all. Rows with a null id have their own n_shingles, no links and a null
    component. Extra columns are ignored; an empty table gives an empty result.
    """
    rule = rule or Rule()
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            sets = shingle_sets(b.column("text").to_pylist(), rule.words)
            keys = [set_key(s) if len(s) else None for s in sets]
            first = np.array([s[0] if len(s) else 0 for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(first)],
                ["doc_id", "n_shingles", "set_key", "first"],
            )

    signed = stored(base.mapInArrow(sign, "doc_id long, n_shingles long, set_key binary, first long"))
    base, known = base.filter("doc_id IS NOT NULL"), signed.filter("doc_id IS NOT NULL AND set_key IS NOT NULL")
    one = [F.min("doc_id").alias("root"), F.first("n_shingles").alias("n"), F.first("first").alias("first")]
    roots = stored(known.groupBy("set_key").agg(*one))
    total = signed.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(MIN_BUCKETS, total // BUCKET_TOKENS)
    groups = _Groups.of(roots)
    pairs = _candidates(base, _frequent(base, rule, buckets), groups, rule, buckets)
    wanted = stored(_places(stored(_grouped(roots, groups)), pairs, rule))
    edges = _links(wanted.join(_wanted_sets(base, wanted, rule), "set_key"), rule)
    # Texts of one document in different classes.
    held = known.join(roots, "set_key").groupBy("doc_id").agg(F.min("root").alias("a"), F.max("root").alias("z")).filter("a <> z")
    same = known.join(roots, "set_key").join(held.select("doc_id", "a"), "doc_id").select("a", F.col("root").alias("b"))
    reached = components(stored(edges.unionAll(same)))
    by_key = stored(
        roots.join(reached, roots["root"] == reached["node"], "left")
        .select("set_key", F.coalesce("component", "root").alias("component"))
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return signed.join(by_key, "set_key", "left").select("doc_id", "n_shingles", component.alias("component_id"))
