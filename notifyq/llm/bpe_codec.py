"""BPE encoding by speculation and verification, and decoding.

Greedy longest match proposes the tokens of a pre-token. The proposal is the BPE encoding
exactly if each token encodes alone as itself (only such tokens are proposed) and every
adjacent pair is compatible, i.e. no merge across the border comes before the merges that
built the two tokens. That is checked for all distinct pairs of a batch at once with numpy.
Only words with a failing pair are merged exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from notifyq.llm.bpe_tables import MEMO_ENTRIES, BpeTables, ship, units
from notifyq.llm.common import others, slices

IDS = np.dtype("<u4")
#: Characters of the units a worker's memo may hold.
MEMO_CHARS = 16 << 20
_NEVER = np.int64(1 << 60)


class PairCheck:
    """Vectorised compatibility of adjacent tokens."""

    def __init__(self, tables: BpeTables):
        n = len(tables.token_bytes)
        #: Rank of the merge that makes a token; -1 for single bytes.
        self.made = np.full(n, -1, np.int64)
        self.parts = np.full((n, 2), -1, np.int64)
        times = np.zeros(n, np.int64)
        for (left, right), (rank, token) in tables.merges.items():
            self.made[token], self.parts[token] = rank, (left, right)
            times[token] += 1
        #: Tokens made by several merges have no single history; they are not proposed.
        self.plain = {i for i in np.flatnonzero(times <= 1)}
        keys = np.array([a * n + b for a, b in tables.merges], np.int64)
        order = np.argsort(keys)
        self.n, self.keys = n, keys[order]
        self.ranks = np.array([r for r, _ in tables.merges.values()], np.int64)[order]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, or never."""
        key = left * self.n + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NEVER)

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of both tokens together leaves them as they are.

        Runs time backwards: undoes whichever of the two border tokens was made last and
        asks whether the pair that then met at the border would have merged before that.
        Among equal ranks the leftmost merge comes first, so the right token is undone
        first and a border merge of its very rank precedes it.
        """
        good = np.ones(len(left), bool)
        at, a, b = np.arange(len(left)), left.astype(np.int64), right.astype(np.int64)
        limit = np.full(len(left), _NEVER)
        while len(at):
            bad = self.rank(a, b) < limit
            good[at[bad]] = False
            made_a, made_b = self.made[a], self.made[b]
            on = ~bad & ((made_a >= 0) | (made_b >= 0))
            at, a, b, made_a, made_b = at[on], a[on], b[on], made_a[on], made_b[on]
            undo_right = made_b >= made_a
            limit = np.where(undo_right, made_b + 1, made_a)
            a, b = np.where(undo_right, a, self.parts[a, 1]), np.where(undo_right, self.parts[b, 0], b)
        return good


class Encoder:
    """Texts to ids, with a memo of units and words that is emptied when full."""

    def __init__(self, tables: BpeTables):
        self.tables, self.pairs = tables, PairCheck(tables)
        self.known = {b: i for b, i in tables.whole.items() if i in self.pairs.plain}
        #: First two bytes -> length of the longest known token that begins so.
        self.longest: dict[bytes, int] = {}
        for b in self.known:
            self.longest[b[:2]] = max(self.longest.get(b[:2], 1), len(b))
        self.special = {s: np.array([i], IDS).tobytes() for s, i in tables.special.items()}
        self.words: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}
        self.held = 0
        self.exact = 0  # words merged exactly so far

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        known, longest, ids, at, n = self.known, self.longest, [], 0, len(word)
        while at < n:
            end = min(n, at + longest.get(word[at : at + 2], 1))
            while (token := known.get(word[at:end])) is None:
                end -= 1
            ids.append(token)
            at = end
        return ids

    def learn_words(self, words: list[str]) -> None:
        """Encode unseen pre-tokens."""
        proposed = [self.propose(w.encode()) for w in words]
        sizes = np.fromiter(map(len, proposed), np.int64, len(words))
        ids = np.fromiter((i for x in proposed for i in x), np.int64, int(sizes.sum()))
        ends = np.cumsum(sizes)
        inner = np.ones(len(ids), bool)  # is followed by a token of the same word
        inner[ends - 1] = False
        left = np.flatnonzero(inner)
        pairs, place = np.unique(ids[left] * self.pairs.n + ids[left + 1], return_inverse=True)
        good = self.pairs.compatible(pairs // self.pairs.n, pairs % self.pairs.n)
        failing = set(np.searchsorted(ends, left[~good[place]], side="right").tolist())
        raw = ids.astype(IDS).tobytes()
        at = 0
        for k, (word, end) in enumerate(zip(words, (ends * IDS.itemsize).tolist(), strict=True)):
            self.words[word] = raw[at:end]
            at = end
            if k in failing:
                self.exact += 1
                self.words[word] = np.array(self.tables.merge(word.encode()), IDS).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null as empty."""
        if self.held > MEMO_CHARS or len(self.units) > MEMO_ENTRIES:
            self.words, self.units, self.held = {}, {}, 0
        cut = [[(k % 2, [s] if k % 2 else units(s)) for k, s in enumerate(self.tables.sections(t or ""))] for t in texts]
        seen = self.units
        unseen = {u for parts in cut for special, us in parts if not special for u in us if u not in seen}
        words = {u: self.tables.pre_tokens(u) for u in unseen}
        self.held += sum(map(len, unseen))
        if new := list({w for ws in words.values() for w in ws if w not in self.words}):
            self.learn_words(new)
        for u, ws in words.items():
            self.units[u] = b"".join(map(self.words.__getitem__, ws))
        return [
            b"".join(x for special, us in parts for x in map((self.special if special else self.units).__getitem__, us))
            for parts in cut
        ]


def _mapped(df: DataFrame, column: str, out: str, kind: T.DataType, make) -> DataFrame:  # noqa: ANN001
    """``df`` with column ``out``, old or new, = make() applied to lists of ``column``."""
    df = df.select(*others(df, out))
    arrow = {T.BinaryType(): pa.binary(), T.StringType(): pa.string()}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for b in slices(batches, column):
            made = pa.array(work(b.column(column).to_pylist()), arrow)
            yield pa.RecordBatch.from_arrays([*b.columns, made], names=[*b.schema.names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, kind)]))


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with a binary column ``out``: the ids of the whole ``text``.

    Ids are little-endian unsigned 32-bit integers. Special strings inside a text become
    their special id, no other special token is added. Null and empty texts have empty ids;
    repeated rows encode alike; other columns pass through; an existing column ``out`` is
    replaced; an empty table gives an empty result. No shuffle; memory is bounded by a
    slice of a batch and the memo.
    """
    tables = ship(docs.sparkSession, path)
    return _mapped(docs, text, out, T.BinaryType(), lambda: Encoder(tables.value).encode)


def decoder(tables: BpeTables):  # noqa: ANN201
    """Lists of id bytes -> texts; null stays null."""
    token = tables.token_bytes
    size = len(token)

    def text_of(raw: bytes | None) -> str | None:
        if raw is None:
            return None
        ids = np.frombuffer(raw, IDS)
        if len(ids) and ids.max() >= size:
            ids = ids[ids < size]
        return b"".join(map(token.__getitem__, ids.tolist())).decode("utf-8", "replace")

    return lambda many: [text_of(x) for x in many]


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with a string column ``out``: the text of the ids, special strings included.

    Null ids give null; ids outside the vocabulary give nothing; bytes that are no UTF-8
    give the replacement character. Other columns pass through.
    """
    tables = ship(df.sparkSession, path)
    return _mapped(df, ids, out, T.StringType(), lambda: decoder(tables.value))


def codec_report(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row: encodes and decodes in one
    pass over the texts, so that neither ids nor decoded texts leave their task."""
    tables = ship(docs.sparkSession, path)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, texts_of = Encoder(tables.value), decoder(tables.value)
        for b in slices(batches, "text"):
            ids = encoder.encode(b.column("text").to_pylist())
            decoded = [hashlib.sha256(t.encode()).hexdigest() for t in texts_of(ids)]
            made = [pa.array([len(x) // IDS.itemsize for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *made, pa.array(decoded, pa.string())], names)

    rows = docs.select("doc_id", "text")
    text = [T.StructField(c, T.StringType()) for c in names[2:]]
    return rows.mapInArrow(both, T.StructType([rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()), *text]))
