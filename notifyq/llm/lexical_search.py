"""Ranked lexical search over a length-stratified index.

A document's length enters its score only through an integer normaliser m. Documents of equal m
form a stratum, kept as blocks of bounded size in which a term's postings are ordered by falling
term frequency. Inside a stratum the impact of a term depends on its frequency alone, so it is
computed once for each frequency, and the impact of a term's first posting bounds all others.
A search adds these up to a bound for each block and item, visits the blocks in falling order of
their bounds, and leaves out those whose bound lies below the k-th score found; the result is exact.

Terms are maximal runs of ASCII letters, digits and all characters above ASCII, with A-Z lower-cased.
With N documents that hold a term, L terms in all, df documents of a term, n terms of a document and
tf of them equal to the term: w = floor(1000 ln((2N + 2) / (2df + 1))), m = 10 + (90 n N) div L, and a
score is the sum of w * ((10^9 tf) div (1000 tf + 8 m)) over the item's distinct terms.

Defined cases: a null or empty text has no term and counts in no statistic. Rows that share a
doc_id are documents of their own. A document without an id counts in the statistics and is not
ranked. Rows that share an item_id are one item with the terms of all; an item without an id, or
without a known term, gets no row. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notifyq.llm.common import slices, stored, utf8_bytes

#: What a byte of UTF-8 becomes: itself, its lower-case letter, or a space outside of terms.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)

#: Terms of a text are split off in pieces of about this many bytes.
PIECE = 4 << 20


@dataclass(frozen=True)
class Settings:
    """Sizes of the index; none changes a result."""

    #: Documents of a block at most.
    block: int = 4096
    #: (item, term) pairs searched in one pass over the documents, about; more take more passes.
    pairs: int = 1 << 19
    #: Bytes of blocks whose visits a task orders at once.
    window: int = 32 << 20


def term_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, by pieces that end between terms."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def term_counts(text: bytes, known: dict[bytes, int]) -> tuple[int, Counter]:
    """(number of terms, occurrences by number of the known ones, which count from 1)."""
    n, found = 0, Counter()
    for terms in term_pieces(text):
        n += len(terms)
        found.update(filter(None, map(known.get, terms)))
    return n, found


# ---- items ---------------------------------------------------------------------------------


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the distinct terms of each item, as UTF-8 bytes."""

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids, terms = [], []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = {t for piece in term_pieces(text) for t in piece}
                ids += [item] * len(own)
                terms += own
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], ["item_id", "term"])

    rows = items.filter("item_id IS NOT NULL").select(F.col("item_id").cast("long"), utf8_bytes(F.col("text")).alias("text"))
    return rows.mapInArrow(split, "item_id long, term binary").distinct()


@dataclass(frozen=True)
class Items:
    """Items of one pass: their ids, and for each the numbers (from 0) of its terms."""

    ids: np.ndarray
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]

    @staticmethod
    def of(pairs: list[tuple[int, bytes]]) -> Items:
        vocabulary: dict[bytes, int] = {}
        own: dict[int, list[int]] = {}
        for item, term in sorted(pairs):
            own.setdefault(item, []).append(vocabulary.setdefault(term, len(vocabulary)))
        return Items(np.array(list(own), np.int64), [np.array(sorted(x), np.int32) for x in own.values()], vocabulary)

    def holders(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the items by term: those of term t are holders[starts[t]:starts[t + 1]]."""
        place = np.repeat(np.arange(len(self.ids)), [len(x) for x in self.terms])
        term = np.concatenate(self.terms)
        order = np.argsort(term, kind="stable")
        return np.searchsorted(term[order], np.arange(len(self.vocabulary) + 1)), place[order]


# ---- index ---------------------------------------------------------------------------------


def forward_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document: all its terms counted, and of the vocabulary's
    terms the numbers and occurrences, as packed 32-bit integers."""
    known = {t: k + 1 for t, k in vocabulary.items()}

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n, terms, tfs = [], [], []
            for text in batch.column("text"):
                size, found = term_counts(text.as_py(), known)
                n.append(size)
                terms.append((np.fromiter(found.keys(), np.int32, len(found)) - 1).tobytes())
                tfs.append(np.fromiter(found.values(), np.int32, len(found)).tobytes())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())],
                ["doc_id", "n", "terms", "tfs"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8_bytes(F.col("text")).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n long, terms binary, tfs binary")


def document_frequencies(forward: DataFrame, size: int) -> DataFrame:
    """(term, df) of the vocabulary's terms that occur, added up inside each task first."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for held in batch.column("terms"):
                df[np.frombuffer(held.as_buffer(), np.int32)] += 1
        some = np.flatnonzero(df)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(df[some])], ["term", "df"])

    return forward.select("terms").mapInArrow(add, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))


def pack_block(ids: list[int], terms: list[bytes], tfs: list[bytes]) -> tuple[bytes, bytes, bytes, bytes, bytes]:
    """Documents of one stratum as (ids, distinct terms, starts, tf and document of each posting);
    a term's postings lie together, by falling tf and rising document."""
    held = [np.frombuffer(x, np.int32) for x in terms]
    doc = np.repeat(np.arange(len(ids), dtype=np.int32), [len(x) for x in held])
    term, tf = np.concatenate(held), np.concatenate([np.frombuffer(x, np.int32) for x in tfs])
    order = np.lexsort((doc, -tf, term))
    distinct, starts = np.unique(term[order], return_index=True)
    return (
        np.array(ids, np.int64).tobytes(), distinct.tobytes(), np.append(starts, len(term)).astype(np.int32).tobytes(),
        tf[order].tobytes(), doc[order].tobytes(),
    )


BLOCK = "m long, ids binary, terms binary, starts binary, tfs binary, docs binary"


def stratified_blocks(forward: DataFrame, documents: int, terms: int, s: Settings) -> DataFrame:
    """The index: one row for each block of at most ``s.block`` documents of one normaliser.

    Documents are range-partitioned by (m, doc_id), so strata stay together and a large one is
    cut between tasks and blocks."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in BLOCK.split(", ")]
        m, rows = None, []
        for batch in batches:
            out = []
            for new, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (new != m or len(rows) == s.block):
                    out.append((m, *pack_block(*zip(*rows, strict=True))))
                    rows = []
                m = new
                rows.append(row)
            if out:
                yield pa.record_batch([pa.array(c) for c in zip(*out, strict=True)], names)
        if rows:
            out = [(m, *pack_block(*zip(*rows, strict=True)))]
            yield pa.record_batch([pa.array(c) for c in zip(*out, strict=True)], names)

    m = F.expr(f"10L + CAST(90 * n AS DECIMAL(30, 0)) * {documents}L div {max(1, terms)}L")
    rows = forward.filter("doc_id IS NOT NULL AND length(terms) > 0").select(m.alias("m"), "doc_id", "terms", "tfs")
    dealt = rows.repartitionByRange("m", "doc_id", F.xxhash64("terms")).sortWithinPartitions("m", "doc_id")
    return dealt.mapInArrow(pack, BLOCK)


# ---- search --------------------------------------------------------------------------------


class Block:
    """A block of the index, its postings weighted for the items searched."""

    def __init__(self, row: dict, weights: np.ndarray):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.terms = np.frombuffer(row["terms"], np.int32)
        self.starts = np.frombuffer(row["starts"], np.int32)
        self.docs = np.frombuffer(row["docs"], np.int32)
        tf, place = np.unique(np.frombuffer(row["tfs"], np.int32).astype(np.int64), return_inverse=True)
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * row["m"])
        weight = weights[self.terms]
        self.gains = np.repeat(weight, np.diff(self.starts)) * impact[place]
        #: What one document gets of each term at most: its first posting's share.
        self.most = self.gains[self.starts[:-1]]

    def bounds(self, starts: np.ndarray, holders: np.ndarray, items: int) -> np.ndarray:
        """For each item, what no document of the block can exceed."""
        lo, n = starts[self.terms], starts[self.terms + 1] - starts[self.terms]
        at = np.repeat(lo - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        out = np.zeros(items, np.int64)
        np.add.at(out, holders[at], np.repeat(self.most, n))
        return out

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """The score of each of the block's documents for an item's terms."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        at = at[self.terms[at] == terms]
        out = np.zeros(len(self.ids), np.int64)
        for lo, hi in zip(self.starts[at], self.starts[at + 1], strict=True):
            out[self.docs[lo:hi]] += self.gains[lo:hi]  # a term has one posting of a document
        return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores with their ids, equal ones by rising id."""
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def visit(blocks: list[Block], items: Items, holders: tuple, found: dict, k: int) -> None:
    """Bring ``found`` (place of an item -> its best scores and ids) up to date with the blocks."""
    bounds = np.stack([b.bounds(*holders, len(items.ids)) for b in blocks])
    for item, terms in enumerate(items.terms):
        for at in np.argsort(-bounds[:, item], kind="stable"):
            scores, ids = found.get(item, (np.zeros(0, np.int64),) * 2)
            least = max(1, scores[-1] if len(scores) == k else 1)
            if bounds[at, item] < least:
                break
            new = blocks[at].scores(terms)
            some = np.flatnonzero(new >= least)
            if len(some):
                found[item] = best(np.append(scores, new[some]), np.append(ids, blocks[at].ids[some]), k)


def search_blocks(index: DataFrame, items: Items, weights: np.ndarray, k: int, s: Settings) -> DataFrame:
    """(item_id, rank, doc_id, score): each task's best documents of each item, then the best of all."""

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holders, found = items.holders(), {}
        blocks, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                blocks.append(Block(row, weights))
                size += 4 * len(row["docs"]) + 8 * len(items.ids)
                if size >= s.window:
                    visit(blocks, items, holders, found, k)
                    blocks, size = [], 0
        if blocks:
            visit(blocks, items, holders, found, k)
        if found:
            n = [len(x) for x, _ in found.values()]
            yield pa.record_batch(
                [
                    pa.array(np.repeat(items.ids[list(found)], n)),
                    pa.array(np.concatenate([x for _, x in found.values()])),
                    pa.array(np.concatenate([x for x, _ in found.values()])),
                ],
                ["item_id", "doc_id", "score"],
            )

    each = index.mapInArrow(search, "item_id long, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, s: Settings = Settings()) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents above 0 for each item, equal scores by
    rising doc_id.

    ``docs`` holds doc_id and text, ``items`` item_id and text. Items are searched together as long
    as they have about ``s.pairs`` terms; what a task gets of them is bounded by that."""
    spark = docs.sparkSession
    pairs = stored(item_terms(items))
    passes = -(-pairs.count() // s.pairs)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for at in range(passes):
        some = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == at) if passes > 1 else pairs
        rows = some.collect()
        if not rows:
            continue
        own = Items.of([(r.item_id, bytes(r.term)) for r in rows])
        forward = stored(forward_counts(docs, own.vocabulary))
        total = forward.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
        n, length = total["documents"], total["terms"] or 0
        w = F.floor(F.lit(1000.0) * F.ln(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1)))
        weights = np.zeros(len(own.vocabulary), np.int64)
        for r in document_frequencies(forward, len(weights)).select("term", w.cast("long").alias("w")).toLocalIterator():
            weights[r.term] = r.w
        index = stored(stratified_blocks(forward, n, length, s))
        out = out.unionByName(search_blocks(index, own, weights, k, s))
    return out
