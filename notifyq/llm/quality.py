"""Quality classifier on supervised subword embeddings.

A word has a feature for itself and one for each of its character n-grams, hashed into
buckets with a learned vector each. A document is the average of all its features' vectors;
a softmax layer gives the class probabilities. Trained by stochastic gradient descent in
numpy on a bounded sample of labelled documents, in a task, applied to all.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notifyq.llm.common import others, slices


@dataclass
class Settings:
    """Size of the model and of its training sample."""

    buckets: int = 1 << 17
    dim: int = 16
    n_grams: tuple[int, ...] = (2, 3, 4)
    epochs: int = 3
    #: Steps at least: few labelled documents are gone through more often.
    least_steps: int = 500
    rate: float = 8.0
    batch: int = 32
    seed: int = 7
    #: The sample: labelled documents of the smallest hashes, and bytes one may have.
    sample_docs: int = 2048
    sample_bytes: int = 32_768


#: Stands for a pair of adjacent equal words: the word bigrams w w of all w share it.
TWICE = b"\x01twice"


def words_of(text: str | None) -> Counter[bytes]:
    """Counts of the ASCII-lower-cased words between ASCII white space and of adjacent equal
    ones; an empty word for a text without any, so that it has a score too."""
    words = (text or "").encode().lower().split() or [b""]
    out = Counter(words)
    if twice := sum(map(eq, words, islice(words, 1, None))):
        out[TWICE] = twice
    return out


def features(words: list[bytes], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(place of a word, bucket) of all features: each <word>, and the character n-grams of
    it by a rolling hash over all words at once. A long word has features in proportion."""
    marked = [b"<" + w + b">" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    raw = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint32)
    word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(raw))  # bytes up to the word's end
    places = [np.arange(len(words), dtype=np.int32)]
    buckets = [np.fromiter(map(zlib.crc32, marked), np.uint32, len(marked))]
    rolled = np.zeros(len(raw), np.uint32)
    for n in range(1, max(s.n_grams) + 1):
        rolled = rolled[: len(raw) - n + 1] * np.uint32(0x01000193) + raw[n - 1 :] + np.uint32(1)
        if n in s.n_grams:
            whole = np.flatnonzero(left[: len(rolled)] >= n)
            h = rolled[whole]
            places.append(word[whole])
            buckets.append((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n))
    mixed = np.concatenate(buckets)
    return np.concatenate(places), ((mixed ^ (mixed >> np.uint32(13))) % np.uint32(s.buckets)).astype(np.int32)


@dataclass
class Model:
    """Learned vectors and the softmax layer; a fixed size, whatever the data."""

    settings: Settings
    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray
    classes: list[int] = field(default_factory=lambda: [0, 1])

    def probabilities(self, averages: np.ndarray) -> np.ndarray:
        z = averages @ self.layer + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train(texts: list[str | None], labels: list[int], s: Settings | None = None) -> Model:
    """Model of labelled texts. Without any, all scores are the same one half."""
    s = s or Settings()
    rng = np.random.default_rng(s.seed)
    classes = 2
    m = Model(s, rng.uniform(-1 / s.dim, 1 / s.dim, (s.buckets, s.dim)).astype(np.float32),
              np.zeros((s.dim, classes), np.float32), np.zeros(classes, np.float32))
    counts = [words_of(t) for t in texts]
    words = list({w for c in counts for w in c})
    at = {w: k for k, w in enumerate(words)}
    place, bucket = features(words, s) if words else (np.zeros(0, np.int32), np.zeros(0, np.int32))
    bucket, ends = bucket[np.argsort(place, kind="stable")], np.cumsum(np.bincount(place, minlength=len(words)))
    own = np.split(bucket, ends[:-1])
    docs = []
    for c in counts:
        mine = [own[at[w]] for w in c]
        weight = np.repeat(np.fromiter(c.values(), np.float32, len(c)), [len(x) for x in mine])
        ids, back = np.unique(np.concatenate(mine), return_inverse=True)
        docs.append((ids, (np.bincount(back, weight) / weight.sum()).astype(np.float32)))
    per_epoch, done = -(-len(docs) // s.batch), 0
    epochs = max(s.epochs, -(-s.least_steps // per_epoch)) if docs else 0
    steps = epochs * per_epoch
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(docs), s.batch):
            some = order[at : at + s.batch]
            average = np.stack([docs[i][1] @ m.vectors[docs[i][0]] for i in some])
            error = m.probabilities(average)
            error[np.arange(len(some)), [labels[i] for i in some]] -= 1
            rate = s.rate * (1 - done / steps)
            back = rate * (error @ m.layer.T)
            m.layer -= rate * (average.T @ error) / len(some)
            m.bias -= rate * error.mean(axis=0) / 8
            for i, g in zip(some, back, strict=True):
                ids, weight = docs[i]  # a document's features are distinct
                m.vectors[ids] -= np.outer(weight, g)
            done += 1
    return m


class Scorer:
    """Scores texts with a memo of word vectors, emptied when full."""

    WORDS = 150_000

    def __init__(self, model: Model):
        self.model, self.columns = model, np.ascontiguousarray(model.vectors.T)
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.sums = np.zeros((4096, self.model.settings.dim + 1), np.float32)

    def _learn(self, words: list[bytes]) -> None:
        """Sum of the vectors of each word's features, and their number."""
        place, bucket = features(words, self.model.settings)
        sums = [np.bincount(place, column[bucket], len(words)) for column in self.columns]
        sizes = np.bincount(place, minlength=len(words))
        at = len(self.rows)
        while at + len(words) > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
        self.sums[at : at + len(words), :-1], self.sums[at : at + len(words), -1] = np.stack(sums, axis=1), sizes
        self.rows.update((w, at + k) for k, w in enumerate(words))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability of class 1 of each text."""
        if len(self.rows) > self.WORDS:
            self._clear()
        counts = [words_of(t) for t in texts]
        if new := list({w for c in counts for w in c if w not in self.rows}):
            self._learn(new)
        totals = np.stack(
            [
                np.fromiter(c.values(), np.float64, len(c)) @ self.sums[list(map(self.rows.__getitem__, c))].astype(np.float64)
                for c in counts
            ]
        ) if counts else np.zeros((0, self.model.settings.dim + 1))
        return self.model.probabilities(totals[:, :-1] / totals[:, -1:])[:, 1]


def held_out(doc_id: Column) -> Column:
    """Rows that never train: crc32 of the id as text divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings | None = None) -> Model:
    """Model of the labelled rows that are not held out, by a bounded sample.

    The sample is the ``sample_docs`` labelled documents of the smallest id hashes among
    those of at most ``sample_bytes`` bytes, so one task gets at most the product of the
    two; the driver gets the model alone. Null ids, null labels and labels other than 0 and 1 do not train.
    """
    s = settings or Settings()
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    usable = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    short = docs.select("doc_id", "text").filter(F.octet_length(F.coalesce("text", F.lit(""))) <= s.sample_bytes)
    # Twice the ids, as long documents fall out; the ids are few enough to broadcast.
    picked = usable.groupBy("doc_id").agg(F.min(label).alias("label")).orderBy(*order).limit(2 * s.sample_docs)
    rows = short.join(F.broadcast(picked), "doc_id").orderBy(*order, "text").limit(s.sample_docs).select("text", F.col("label").cast("int"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, marks = [], []
        for b in batches:
            texts += b.column("text").to_pylist()
            marks += b.column("label").to_pylist()
        if texts:
            m = train(texts, marks, s)
            parts = [pa.array([x.tobytes()], pa.binary()) for x in (m.vectors, m.layer, m.bias)]
            yield pa.RecordBatch.from_arrays(parts, names=["vectors", "layer", "bias"])

    # The limit leaves one partition in its order; coalesce holds that fast.
    made = rows.coalesce(1).mapInArrow(learn, "vectors binary, layer binary, bias binary").collect()
    if not made:
        return train([], [], s)
    vectors, layer, bias = (np.frombuffer(x, np.float32) for x in made[0])
    return Model(s, vectors.reshape(s.buckets, s.dim), layer.reshape(s.dim, -1), bias)


def with_scores(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a double column ``out``: probability of class 1 of the whole text.

    Null and empty texts have a score too. No shuffle; other columns pass through; an
    existing column ``out`` is replaced.
    """
    docs = docs.select(*others(docs, out))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # buckets x dim floats: 8 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for b in slices(batches, text):
            made = pa.array(scorer.score(b.column(text).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, made], names=[*b.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


#: Score from which a document counts as good.
GOOD = 0.3


def quality_report(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of GOOD) of each row."""
    scored = with_scores(docs.select("doc_id", "text"), fit(docs, labels, settings=settings))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted")
    )
