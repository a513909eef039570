"""Benchmark decontamination by latent semantic retrieval.

Benchmark texts are cut into passages with TF-IDF weights: term frequency, inverse document
frequency over the whole corpus. Windows of the documents are compared with them in two kinds of
spaces, and a window whose cosine with a passage is high enough in either is a candidate.

The latent space is one for all passages, of far fewer dimensions than there are passages. It is
fitted to the passages and to all windows of all documents, so that words which stand in the same contexts
are near to each other, by a randomised SVD whose products run over the rows in Spark: each task
adds up its rows' part of A^T (A Q), and the driver only holds the factor Q, terms by dimensions.
Texts are cut into words once for this and for the document frequencies; the words' hashes are kept.
A paraphrase is near its passage there with other words. A space of few dimensions keeps little of
a passage's norm and would lose copies, so exact spaces stand beside it as a floor: passages are
dealt to groups of at most ``rank``, and a group's space keeps the norm of each passage however
large the benchmark is.

A candidate is checked against the whole benchmark text: by the longest common subsequence of
words and by the text's answer, its rarest words. Of a text of several passages, a copy of one
passage is a leak too.

A squared window norm is a sum over its words, so running sums give it for every window.
The same sum over words of a group bounds the cosine with any of its passages: windows below
the threshold are dropped before projection without losing a candidate.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notifyq.llm.common import fresh, others, slices, stored

_CLEAN = bytes(
    ord(" ") if chr(b) in string.punctuation else b for b in range(256)
)  # bytes.translate table: ASCII punctuation separates words


@dataclass(frozen=True)
class Rules:
    """Parameters of passages, windows, latent space and checks."""

    #: Counters of words for document frequencies (a power of two).
    terms: int = 1 << 18
    #: Passages of one latent space, and so its dimensions at most.
    rank: int = 128
    oversample: int = 16
    power: int = 2
    #: Dimensions of the latent space for all passages; the strongest ones, which tell languages and
    #: common words apart, are left out. The cosine from which a window is a candidate there.
    latent_rank: int = 40
    latent_skip: int = 4
    latent_cosine: float = 0.68
    latent_power: int = 1
    #: Columns of words that no benchmark text holds: their hashes are folded to so many (a power of two).
    latent_terms: int = 1 << 13
    #: Once bounds of a sample that it was fitted to. It is fitted to all windows of all documents
    #: whatever they are; they are only here for callers that name them.
    latent_docs: int | None = None
    latent_windows: int | None = None
    passage: int = 32
    #: (words, step) of the windows: short ones for short texts, long ones for the rest.
    windows: tuple[tuple[int, int], ...] = ((24, 8), (64, 24))
    cosine: float = 0.4
    #: Words of both sides of a window that are checked with it.
    margin: int = 16
    #: Share of a text's words, or of one of its passages, in common order that proves a copy,
    #: and with the answer.
    copied: float = 0.75
    paraphrased: float = 0.5
    answer_words: int = 3
    #: Benchmark texts of one search; a larger benchmark is searched in several passes.
    chunk: int = 4096
    #: Passages of one search, about; their spaces are held by every executor.
    held: int = 4096


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words, cut at white space and ASCII punctuation."""
    return (text or "").lower().encode().translate(_CLEAN).split()


class Terms:
    """Numbers of words: their places in a vocabulary, or after those one of ``terms`` hashes."""

    def __init__(self, terms: int, vocabulary: dict[bytes, int] | None = None):
        self.terms, self.vocabulary = terms, vocabulary or {}

    def hashed(self, words: Iterable[bytes]) -> np.ndarray:
        # Hashing a word anew costs less than a memo of the many words that come once.
        return (np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64) % np.uint64(self.terms)).astype(np.int64)

    def of(self, words: list[bytes]) -> np.ndarray:
        if not self.vocabulary:
            return self.hashed(words)
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        other = ids < 0
        ids[other] = self.hashed(compress(words, other.tolist())) + len(self.vocabulary)
        return ids


def word_hashes(docs: DataFrame) -> DataFrame:
    """The hashes of each text's words in their order, 64 bits each; none for a null text. The counts
    and the latent space's passes read these, so that texts are cut into words once for all of them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            made = [np.fromiter(map(xxhash.xxh3_64_intdigest, words_of(t)), np.uint64).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["hashes"])

    return docs.mapInArrow(cut, "hashes binary")


def _flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers packed in a column of binary values, end to end, and how many each value has."""
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], wide)[column.offset : column.offset + len(column) + 1]
    size, data = np.dtype(kind).itemsize, column.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, kind), np.zeros(len(column), np.int64)
    held = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(kind)
    return held, (np.diff(offsets) // size).astype(np.int64)


def _packed(values: np.ndarray, n: np.ndarray) -> pa.Array:
    """The opposite of _flat: each value has the next ``n`` numbers."""
    offsets = np.append(0, np.cumsum(n * values.itemsize)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def document_frequencies(hashed: DataFrame, r: Rules) -> tuple[np.ndarray, int]:
    """Documents that hold each hashed word, and documents, over the whole table of word hashes."""
    parts, span = 64, r.terms // 64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(r.terms, np.int64), 0
        for b in slices(batches, "hashes"):
            for at in range(0, b.num_rows, 1 << 11):
                words, size = _flat(b.column("hashes").slice(at, 1 << 11), np.uint64)
                doc = np.repeat(np.arange(len(size), dtype=np.uint64) << np.uint64(53), size)
                held = np.sort(doc | words & np.uint64((1 << 53) - 1))  # the last bits tell the number of the word
                held = held[np.append(True, held[1:] != held[:-1])[: len(held)]]
                total += np.bincount((held % np.uint64(r.terms)).astype(np.int64), minlength=r.terms)
                n += len(size)
        if n:
            rows = [total[k * span : (k + 1) * span].tobytes() for k in range(parts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(parts), pa.int32()), pa.array([n] * parts, pa.int64()), pa.array(rows, pa.binary())], ["part", "n", "counts"]
            )

    def add(part: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in part.column("counts").to_pylist())
        n = sum(part.column("n").to_pylist())
        return pa.table({"part": part.column("part")[:1], "n": pa.array([n], pa.int64()), "counts": pa.array([total.tobytes()], pa.binary())})

    made = hashed.mapInArrow(count, "part int, n long, counts binary").groupBy("part").applyInArrow(add, "part int, n long, counts binary")
    rows = sorted(made.collect())  # one row for each range of terms
    if not rows:
        return np.zeros(r.terms, np.int64), 0
    return np.concatenate([np.frombuffer(x["counts"], np.int64) for x in rows]), rows[0]["n"]


@dataclass
class Space:
    """Latent space of a group of passages."""

    passages: np.ndarray  # places among all passages
    terms: np.ndarray  # their vocabulary, ascending
    basis: np.ndarray  # terms x latent
    latent: np.ndarray  # passage x latent, of norm 1
    kept: np.ndarray  # norm that each passage keeps in the space


@dataclass
class Latent:
    """The latent space of all passages of a search."""

    basis: np.ndarray  # column x latent: words of the benchmark, then folded hashes of others
    passages: np.ndarray  # passage x latent, of norm 1


@dataclass
class Passages:
    """Benchmark passages of one search, as they are sent to the executors."""

    items: list[int]
    texts: list[list[bytes]]
    answers: list[frozenset[bytes]]
    vocabulary: dict[bytes, int]
    idf: np.ndarray  # of the vocabulary, then of the hashes
    owner: np.ndarray  # passage -> place in items
    spans: list[tuple[int, int]]  # words of its text
    spaces: list[Space] = field(default_factory=list)
    latent: Latent | None = None


def _vector(terms: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms with their weights, of norm 1."""
    ids, n = np.unique(terms, return_counts=True)
    weight = np.sqrt(n) * idf[ids]
    return ids, weight / max(np.sqrt((weight**2).sum()), 1e-12)


def _spans(n: int, r: Rules) -> list[tuple[int, int]]:
    """Passages of a text of n words; a short rest belongs to the last one."""
    count = max(1, n // r.passage)
    return [(k * r.passage, n if k == count - 1 else (k + 1) * r.passage) for k in range(count)]


def latent_basis(matrix: np.ndarray, r: Rules) -> np.ndarray:
    """Right singular vectors (terms x latent) of a group's passage matrix by randomised
    subspace iteration."""
    rows, columns = matrix.shape
    width = min(r.rank + r.oversample, rows, columns)
    q = np.linalg.qr(np.random.default_rng(11).standard_normal((columns, width)))[0]
    for _ in range(r.power):
        q, _ = np.linalg.qr(matrix.T @ (matrix @ q))
    part = matrix @ q
    values, turn = np.linalg.eigh(part.T @ part)
    best = np.argsort(-values)[: min(r.rank, width)]
    return (q @ turn[:, best[values[best] > 1e-9]]).astype(np.float32)


def _spaces(passages: DataFrame, r: Rules) -> list[Space]:
    """Latent spaces of the groups of (space, passage, ids, weights), a task for each group."""

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by("passage")
        ids, weights = ([np.frombuffer(x, kind) for x in group.column(c).to_pylist()] for c, kind in (("ids", np.int64), ("weights", np.float64)))
        terms = np.unique(np.concatenate(ids))
        matrix = np.zeros((len(ids), len(terms)))
        for row, at, weight in zip(matrix, ids, weights, strict=True):
            row[np.searchsorted(terms, at)] = weight
        basis = latent_basis(matrix, r)
        latent = matrix.astype(np.float32) @ basis
        made = [group.column("passage").to_numpy(), terms, basis, latent]
        return pa.table({c: pa.array([x.tobytes()], pa.binary()) for c, x in zip(("passages", "terms", "basis", "latent"), made, strict=True)})

    out = []
    for x in passages.groupBy("space").applyInArrow(fit, "passages binary, terms binary, basis binary, latent binary").collect():
        places, terms = np.frombuffer(x["passages"], np.int64), np.frombuffer(x["terms"], np.int64)
        latent = np.frombuffer(x["latent"], np.float32).reshape(len(places), -1)
        kept = np.linalg.norm(latent, axis=1)
        basis = np.frombuffer(x["basis"], np.float32).reshape(len(terms), -1)
        out.append(Space(places, terms, basis, latent / np.maximum(kept, 1e-12)[:, None], kept))
    return sorted(out, key=lambda space: int(space.passages[0]))


def _columns(ids: np.ndarray, known: int, r: Rules) -> np.ndarray:
    """Columns of the latent space for terms, of which ``known`` are words of the benchmark."""
    return np.where(ids < known, ids, known + (ids - known) % r.latent_terms)


def _weighted(ids: np.ndarray, row: np.ndarray, place: np.ndarray, size: int, idf: np.ndarray, known: int, r: Rules) -> pa.RecordBatch:
    """Rows of distinct columns with their TF-IDF weights, of norm 1, packed: for each term its row
    and its place there, below ``size``."""
    rows, none = int(row[-1]) + 1 if len(row) else 0, np.int64(1) << 40
    # Sorted by column inside each row, with the place below it.
    cells = np.full((rows, size), none * size, np.int64)
    cells[row, place] = _columns(ids, known, r) * size + place
    weight = np.zeros((rows, size))
    weight[row, place] = idf[ids]
    cells.sort(axis=1)
    weight, column = np.take_along_axis(weight, cells % size, axis=1).ravel(), cells // size
    new = np.ones((rows, size), bool)
    new[:, 1:] = column[:, 1:] != column[:, :-1]
    first = np.flatnonzero(new)
    total, column = np.add.reduceat(weight, first) if rows else weight, column.ravel()[first]
    real = column < none
    total, column, row = total[real], column[real], (first // size)[real]
    n = np.bincount(row, minlength=rows)
    norm = np.sqrt(np.bincount(row, total**2, minlength=rows))
    return pa.RecordBatch.from_arrays([_packed(column, n), _packed(total / np.maximum(norm, 1e-12)[row], n)], ["ids", "weights"])


ROWS = "ids binary, weights binary"


#: Makes TF-IDF rows of word hashes.
Weigher = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _weigher(spark: SparkSession, p: Passages, r: Rules) -> Weigher:
    """TF-IDF rows of all windows, end to end, of all documents, from the hashes of their words."""
    known, size = len(p.vocabulary), r.windows[-1][0]
    names = np.fromiter(map(xxhash.xxh3_64_intdigest, p.vocabulary), np.uint64, known)
    sent = spark.sparkContext.broadcast((p.idf, names))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, names = sent.value
        low = np.uint64((1 << 16) - 1)
        slot = (names & low).astype(np.int64)
        first = np.full(1 << 16, -1, np.int32)  # a word of the benchmark by its last bits
        first[slot] = np.arange(known)
        shared = np.bincount(slot, minlength=1 << 16) > 1
        order = np.argsort(names)
        for b in slices(batches, "hashes"):
            words, n = _flat(b.column("hashes"), np.uint64)
            slot = (words & low).astype(np.int64)
            at = first[slot]
            several = np.flatnonzero(shared[slot])
            at[several] = order[np.minimum(np.searchsorted(names, words[several], sorter=order), known - 1)]
            ids = np.where((at >= 0) & (names[at] == words), at, (words % np.uint64(r.terms)).astype(np.int64) + known)
            at = np.arange(len(words)) - np.repeat(np.cumsum(n) - n, n)
            windows = -(-n // size)
            yield _weighted(ids, np.repeat(np.cumsum(windows) - windows, n) + at // size, at % size, size, idf, known, r)

    return cut


def _passage_rows(p: Passages, r: Rules) -> pa.RecordBatch:
    """TF-IDF rows of the passages."""
    terms = Terms(r.terms, p.vocabulary)
    held = [terms.of(p.texts[o][lo:hi]) for o, (lo, hi) in zip(p.owner.tolist(), p.spans, strict=True)]
    n = np.array([len(x) for x in held])
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return _weighted(np.concatenate(held), np.repeat(np.arange(len(n)), n), place, int(n.max()), p.idf, len(p.vocabulary), r)


def _context_rows(docs: DataFrame, p: Passages, n_docs: int, r: Rules) -> DataFrame:
    """The rows the space of ``docs`` (column text) is fitted to, as a table: all passages, and
    all windows of all documents."""
    spark = docs.sparkSession
    own = spark.createDataFrame([*zip(*(c.to_pylist() for c in _passage_rows(p, r).columns), strict=True)], ROWS)
    return word_hashes(docs).mapInArrow(_weigher(spark, p, r), ROWS).unionAll(own)


#: Tasks of a product at least; rows of a factor that are added up at once; numbers that are
#: worked on at a time, few enough for a core's cache.
PRODUCT_TASKS, FACTOR_ROWS, BLOCK = 32, 128, 2048


def _images(b: pa.RecordBatch, q: np.ndarray) -> tuple[np.ndarray, ...]:
    """The rows' columns and weights, their row, and A q."""
    (at, n), (weight, _) = _flat(b.column("ids"), np.int64), _flat(b.column("weights"), np.float64)
    row, starts = np.repeat(np.arange(len(n)), n), np.append(0, np.cumsum(n))
    images, weight = np.zeros((len(n), q.shape[1]), q.dtype), weight.astype(q.dtype)
    lo = 0
    while lo < len(n):
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + BLOCK, "right")) - 1)
        own, full = slice(starts[lo], starts[hi]), lo + np.flatnonzero(n[lo:hi])
        if len(full):
            images[full] = np.add.reduceat(q[at[own]] * weight[own, None], starts[full] - starts[lo], axis=0)
        lo = hi
    return at, weight, row, images


def _add_product(b: pa.RecordBatch, q: np.ndarray, total: np.ndarray) -> None:
    """Adds A^T (A q) of some rows."""
    at, weight, row, images = _images(b, q)
    order = np.argsort(at.astype(np.uint16) if len(q) <= 1 << 16 else at, kind="stable")
    at, weight, row = at[order], weight[order], row[order]
    for lo in range(0, len(at), BLOCK):
        some = slice(lo, lo + BLOCK)
        first = np.flatnonzero(np.append(True, np.diff(at[some]) != 0))
        total[at[some][first]] += np.add.reduceat(images[row[some]] * weight[some, None], first, axis=0)


def _add_gram(b: pa.RecordBatch, q: np.ndarray, total: np.ndarray) -> None:
    """Adds (A q)^T (A q) of some rows."""
    images = _images(b, q)[3]
    total += images.T @ images


def _added(rows: DataFrame, q: np.ndarray, add_rows: Callable[[pa.RecordBatch, np.ndarray, np.ndarray], None], n: int, weigher: Weigher | None) -> np.ndarray:
    """The sum, of ``n`` rows, over all rows, which ``weigher`` makes of ``rows`` if it is given:
    each task adds up its own, then ranges of the sum are added over the tasks. The number of
    tasks does not grow with the rows, nor do so the sums."""
    context, shape = rows.sparkSession.sparkContext, (n, q.shape[1])
    sent = context.broadcast(q)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, total = sent.value, np.zeros(shape)
        for b in weigher(batches) if weigher else batches:
            if b.num_rows:
                add_rows(b, q, total)
        parts = [(k, total[k : k + FACTOR_ROWS].tobytes()) for k in range(0, n, FACTOR_ROWS)]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in parts], pa.int32()), pa.array([x[1] for x in parts], pa.binary())], ["part", "sums"])

    def add(part: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in part.column("sums").to_pylist())
        return pa.table({"part": part.column("part")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    tasks = rows.coalesce(max(PRODUCT_TASKS, 2 * context.defaultParallelism))
    made = tasks.mapInArrow(multiply, "part int, sums binary").groupBy("part").applyInArrow(add, "part int, sums binary")
    found = sorted(made.collect())  # as large as the sum
    return np.concatenate([np.frombuffer(x["sums"], np.float64) for x in found]).reshape(shape) if found else np.zeros(shape)


def _product(rows: DataFrame, q: np.ndarray, weigher: Weigher | None = None) -> np.ndarray:
    """A^T (A q) for the matrix A of the rows. What comes back has the size of q."""
    return _added(rows, q, _add_product, len(q), weigher)


def _gram(rows: DataFrame, q: np.ndarray, weigher: Weigher | None = None) -> np.ndarray:
    """(A q)^T (A q), of q's dimensions: no sums over terms are needed."""
    return _added(rows, q, _add_gram, q.shape[1], weigher)


def fit_latent(docs: DataFrame, p: Passages, n_docs: int, r: Rules, hashed: DataFrame | None = None) -> Latent:
    """The latent space of the passages and their words' contexts in all of ``docs`` (column
    text), by randomised subspace iteration."""
    size, rank = len(p.vocabulary) + r.latent_terms, r.latent_rank + r.latent_skip
    hashed, weigher = stored(word_hashes(docs)) if hashed is None else hashed, _weigher(docs.sparkSession, p, r)
    own = _passage_rows(p, r)
    q = np.linalg.qr(np.random.default_rng(17).standard_normal((size, rank + r.oversample)))[0]
    for _ in range(r.latent_power):
        single = q.astype(np.float32)  # the sums over the rows are of doubles
        total = _product(hashed, single, weigher)
        _add_product(own, q, total)
        q = np.linalg.qr(total)[0]
    total = _gram(hashed, q.astype(np.float32), weigher)
    _add_gram(own, q, total)
    values, turn = np.linalg.eigh(total)  # of A^T A in the range of q
    best = np.argsort(-values)[r.latent_skip : rank]
    basis = q @ turn[:, best[values[best] > 1e-9]]
    terms = Terms(r.terms, p.vocabulary)
    held = [terms.of(p.texts[o][lo:hi]) for o, (lo, hi) in zip(p.owner.tolist(), p.spans, strict=True)]
    images = np.stack([p.idf[x] @ basis[_columns(x, len(p.vocabulary), r)] for x in held])
    norm = np.linalg.norm(images, axis=1, keepdims=True)
    return Latent(basis.astype(np.float32), np.where(norm > 1e-9, images / np.maximum(norm, 1e-12), 0).astype(np.float32))


def word_places(a: list[bytes]) -> dict[bytes, int]:
    """For each word of a text its places, one bit for each."""
    where: dict[bytes, int] = {}
    for k, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << k
    return where


def common_words(a: list[bytes], b: list[bytes], places: dict[bytes, int] | None = None) -> int:
    """Length of the longest common subsequence, with one bit for each word of ``a``."""
    where = word_places(a) if places is None else places
    full = (1 << len(a)) - 1
    row = full
    for own in filter(None, map(where.get, b)):
        both = row & own
        row = ((row + both) | (row - both)) & full
    return len(a) - row.bit_count()


#: Windows that are projected at a time.
PROJECTED = 512


class _Searcher:
    """Finds the benchmark texts in lists of texts, all their windows at once."""

    def __init__(self, p: Passages, r: Rules):
        self.p, self.r = p, r
        self.terms, self.columns = Terms(r.terms, p.vocabulary), len(p.vocabulary)
        self.square = p.idf**2
        self.idf32 = p.idf.astype(np.float32)
        self.column = _columns(np.arange(len(p.idf)), self.columns, r)
        self.held: dict[int, dict[bytes, int]] = {}  # places of the words of the texts met
        self.places = []  # for each space, its columns of the vocabulary: place among its terms, or -1
        for space in p.spaces:
            place = np.full(self.columns, -1, np.int32)
            place[space.terms] = np.arange(len(space.terms))
            self.places.append(place)

    def search(self, texts: list[str | None]) -> list[list[tuple[int, float]]]:
        """For each text, (item, share of its words in common order) of its leaks."""
        found: list[dict[int, float]] = [{} for _ in texts]
        words = [words_of(t) for t in texts]
        if self.p.items and any(words):
            starts = np.cumsum([0, *map(len, words)])
            ids = self.terms.of(list(chain.from_iterable(words)))
            norm = np.cumsum(np.append(0.0, self.square[ids]))
            cut = [self._cut(size, step, starts, norm) for size, step in self.r.windows]
            known = np.flatnonzero(ids < self.columns)  # words of the benchmark
            before = np.searchsorted(known, np.arange(len(ids) + 1))
            for space, place in zip(self.p.spaces, self.places, strict=True):
                local = place[ids[known]]
                part = np.cumsum(np.append(0.0, np.where(local >= 0, self.square[ids[known]], 0.0)))
                for doc, lo, hi, whole in cut:
                    bound = part[before[hi]] - part[before[lo]]
                    # A float sum may fall short by its rounding; kept is 1 but for that too.
                    ok = np.flatnonzero(bound * (1 + 1e-9) + 1e-9 >= (self.r.cosine * space.kept.min()) ** 2 * whole)
                    for at in range(0, len(ok), PROJECTED):
                        some = ok[at : at + PROJECTED]
                        score = self._projected(space, before[lo[some]], before[hi[some]], local, ids[known]) @ space.latent.T
                        least = self.r.cosine * np.sqrt(np.maximum(whole[some], 1e-12))[:, None] * space.kept
                        window, near = np.nonzero(score >= least)
                        for w, k in zip(some[window].tolist(), space.passages[near].tolist(), strict=True):
                            d = int(doc[w])
                            self._check(words[d], int(lo[w] - starts[d]), int(hi[w] - starts[d]), k, found[d])
            if self.p.latent is not None:
                doc, lo, hi, _ = cut[-1]
                for w, k in self._alike(doc, lo, hi, starts, ids):
                    d = int(doc[w])
                    self._check(words[d], int(lo[w] - starts[d]), int(hi[w] - starts[d]), k, found[d])
        return [sorted((self.p.items[o], s) for o, s in f.items()) for f in found]

    def _alike(self, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray, starts: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window, passage) pairs that are near in the latent space. All windows begin and end
        on cells of as many words as divide their size and step, counted from their text's
        start, so running sums over the cells' images give those of the windows."""
        space, size = self.p.latent, math.gcd(*self.r.windows[-1])
        cells = -(-np.diff(starts) // size)
        before = np.append(0, np.cumsum(cells))  # of each text
        place = np.arange(len(ids)) + np.repeat(before[:-1] * size - starts[:-1], np.diff(starts))
        term, weight = np.zeros(before[-1] * size, np.int64), np.zeros(before[-1] * size, np.float32)
        term[place], weight[place] = self.column[ids], self.idf32[ids]
        from_, to = before[doc] + (lo - starts[doc]) // size, before[doc] + -(-(hi - starts[doc]) // size)
        for at in range(0, len(lo), PROJECTED):
            a, b = from_[at : at + PROJECTED], to[at : at + PROJECTED]
            first, last = int(a[0]), int(b.max())
            own = slice(first * size, last * size)
            each = np.matmul(weight[own].reshape(-1, 1, size), space.basis[term[own]].reshape(last - first, size, -1))
            sums = np.zeros((last - first + 1, space.basis.shape[1]), np.float32)
            np.cumsum(each[:, 0], axis=0, out=sums[1:])
            images = sums[b - first] - sums[a - first]
            norm = np.sqrt(np.einsum("ij,ij->i", images, images))
            near = images @ space.passages.T >= np.where(norm > 1e-3, self.r.latent_cosine * norm, np.inf)[:, None]
            window, passage = np.nonzero(near)
            yield from zip((window + at).tolist(), passage.tolist(), strict=True)

    def _cut(self, size: int, step: int, starts: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, ...]:
        """Windows of all texts: text, first word, end, squared norm."""
        n = np.diff(starts)
        count = np.where(n > 0, 1 + np.maximum(0, -(-(n - size) // step)), 0)
        doc = np.repeat(np.arange(len(n)), count)
        lo = starts[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * step
        hi = np.minimum(lo + size, starts[doc + 1])
        return doc, lo, hi, norm[hi] - norm[lo]

    def _projected(self, space: Space, lo: np.ndarray, hi: np.ndarray, local: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Latent vectors of windows, not yet divided by the windows' norms."""
        n = hi - lo
        place = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        window = np.repeat(np.arange(len(lo)), n)
        inside = local[place] >= 0
        window, place = window[inside], place[inside]
        cell, first, times = np.unique(window * len(space.terms) + local[place], return_index=True, return_counts=True)
        row, column = cell // len(space.terms), cell % len(space.terms)
        used, column = np.unique(column, return_inverse=True)  # the windows' part of the space's words
        weights = np.zeros((len(lo), len(used)), np.float32)
        weights[row, column] = np.sqrt(times) * self.p.idf[term[place[first]]]
        return weights @ space.basis[used]

    def _check(self, words: list[bytes], lo: int, hi: int, passage: int, found: dict[int, float]) -> None:
        """Compare the region around a window with the passage's whole text, and if that is not
        copied whole, with the passage alone."""
        p, r = self.p, self.r
        owner, (first, last) = int(p.owner[passage]), p.spans[passage]
        if found.get(owner, 0.0) == 1.0:
            return
        text = p.texts[owner]
        region = words[max(0, lo - first - r.margin) : hi + len(text) - last + r.margin]
        if owner not in self.held:
            self.held[owner] = word_places(text)
        share = common_words(text, region, self.held[owner]) / len(text)
        if self._proves(share, owner, region) or (last - first < len(text) and self._holds_part(words, lo, hi, passage)):
            found[owner] = max(found.get(owner, 0.0), share)

    def _proves(self, share: float, owner: int, region: list[bytes]) -> bool:
        return share >= self.r.copied or (share >= self.r.paraphrased and self.p.answers[owner] <= set(region))

    def _holds_part(self, words: list[bytes], lo: int, hi: int, passage: int) -> bool:
        """Whether the window copies the passage, by the rules for whole texts, or as many
        words in a row of two passages as prove a copy of one."""
        p, r = self.p, self.r
        owner, (first, last) = int(p.owner[passage]), p.spans[passage]
        region = words[max(0, lo - r.margin) : hi + r.margin]
        if self._proves(common_words(p.texts[owner][first:last], region) / (last - first), owner, region):
            return True
        run = math.ceil(r.copied * r.passage)
        around = p.texts[owner][max(0, first - run) : last + run]
        runs = {tuple(around[k : k + run]) for k in range(len(around) - run + 1)}
        return any(tuple(region[k : k + run]) in runs for k in range(len(region) - run + 1))


HITS = "array<struct<item_id: bigint, share: double>>"


def with_leaks(
    docs: DataFrame, benchmark: DataFrame, rules: Rules | None = None, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (by default all) with contaminated, n_items, item_ids
    (sorted) and overlap (largest share of an item's words found in order).

    ``benchmark`` has item_id and text. Null and empty texts on either side match nothing;
    repeated rows are judged alike; nulls in other columns pass through; items that share an
    id are searched each; columns of the four names in ``docs`` are replaced; an empty
    benchmark finds nothing. Windows cover whole texts, passages whole benchmark texts.
    """
    r = rules or Rules()
    kept = others(docs.select(*keep) if keep else docs, "contaminated", "n_items", "item_ids", "overlap")
    own, hits = fresh(docs.select(*kept), "own_text", "hits")
    texts = docs.select(F.col(text).alias("text"))
    hashed = stored(word_hashes(texts)) if r.latent_rank else word_hashes(texts)
    counts, n_docs = document_frequencies(hashed, r)
    idf = np.log((1 + n_docs) / (1 + counts)) + 0.01  # next to nothing for the commonest words
    has_id = F.col("item_id").isNotNull() & F.col("text").isNotNull()
    items = stored(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(has_id).distinct())
    n_items, n_passages = items.mapInArrow(_sizes(r), "texts long, passages long").agg(F.sum("texts"), F.sum("passages")).first()
    passes = max(1, -(-(n_items or 0) // r.chunk), -(-(n_passages or 0) // r.held))
    searched = docs.select(*kept, F.col(text).alias(own), F.array().cast(HITS).alias(hits))
    for k in range(passes):  # each pass adds its hits to the rows it is given
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        found = _passages(part, idf, r)
        if found.items and r.latent_rank:
            found.latent = fit_latent(texts, found, n_docs, r, hashed)
        searched = _searched(searched, own, hits, found, r, last=k == passes - 1)
    return searched.select(*kept, *_verdict(F.array_sort(hits)))


def leak_report(docs: DataFrame, benchmark: DataFrame, rules: Rules | None = None) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids and overlap of each row."""
    return with_leaks(docs, benchmark, rules, keep=["doc_id"])


def _verdict(hits: F.Column) -> list[F.Column]:
    ids = F.transform(hits, lambda x: x["item_id"])
    return [
        (F.size(hits) > 0).alias("contaminated"), F.size(hits).cast("long").alias("n_items"), ids.alias("item_ids"),
        F.coalesce(F.array_max(F.transform(hits, lambda x: x["share"])), F.lit(0.0)).alias("overlap"),
    ]


def _sizes(r: Rules) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counter of texts and of their passages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [len(_spans(len(words_of(t)), r)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([len(n)], pa.int64()), pa.array([sum(n)], pa.int64())], ["texts", "passages"])

    return count


def _passages(items: DataFrame, idf: np.ndarray, r: Rules) -> Passages:
    """Passages of at most ``chunk`` benchmark texts with their latent spaces."""
    rows = [(x["item_id"], x["text"], words_of(x["text"])) for x in items.orderBy("item_id", "text").collect()]
    rows = [x for x in rows if x[2]]
    spans = [(o, s) for o, x in enumerate(rows) for s in _spans(len(x[2]), r)]
    vocabulary: dict[bytes, int] = {}
    for x in rows:
        for w in x[2]:
            vocabulary.setdefault(w, len(vocabulary))
    all_idf = np.concatenate([idf[Terms(r.terms).of(list(vocabulary))], idf])
    rarity = lambda w: (-all_idf[vocabulary[w]], w)
    answers = [frozenset(sorted(set(x[2]), key=rarity)[: r.answer_words]) for x in rows]
    owner = np.array([o for o, _ in spans], np.int64)
    p = Passages([x[0] for x in rows], [x[2] for x in rows], answers, vocabulary, all_idf, owner, [s for _, s in spans])
    if not rows:
        return p
    terms = Terms(r.terms, vocabulary)
    made = [_vector(terms.of(rows[o][2][lo:hi]), all_idf) for o, (lo, hi) in spans]
    table = [(k // r.rank, k, ids.tobytes(), weight.tobytes()) for k, (ids, weight) in enumerate(made)]
    p.spaces = _spaces(items.sparkSession.createDataFrame(table, "space int, passage long, ids binary, weights binary"), r)
    return p


def _searched(rows: DataFrame, text: str, hits: str, p: Passages, r: Rules, last: bool) -> DataFrame:
    """``rows`` with the leaks of one search added to the column ``hits``; the last one drops ``text``."""
    sent = rows.sparkSession.sparkContext.broadcast(p)  # at most Rules.chunk benchmark texts
    kept = [f for f in rows.schema.fields if f.name != hits and not (last and f.name == text)]
    names = [f.name for f in kept]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaks = _Searcher(sent.value, r)
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("share", pa.float64())]))
        for b in slices(batches, text):
            before, texts = b.column(hits).to_pylist(), b.column(text).to_pylist()
            found = [h + [{"item_id": i, "share": s} for i, s in new] for h, new in zip(before, leaks.search(texts), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(found, kind)], [*names, hits])

    return rows.mapInArrow(search, T.StructType([*kept, rows.schema[hits]]))
