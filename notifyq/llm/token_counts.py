"""Token counts by the whole-token shortcut.

Offline, once for a vocabulary, exact merging proves which vocabulary strings encode alone
as one token (``BpeTables.whole``). A pre-token among them counts 1 directly; only the rest
is merged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notifyq.llm.bpe_tables import MEMO_ENTRIES, MEMO_UNIT, BpeTables, ship, units
from notifyq.llm.common import others, slices


class _WordMemo(dict):
    """Pre-token -> number of tokens: 1 for whole tokens, else by merging."""

    def __init__(self, tables: BpeTables):
        self.tables, self.whole = tables, tables.whole

    def __missing__(self, word: str) -> int:
        raw = word.encode()
        if raw in self.whole:
            return 1
        n = len(self.tables.merge(raw))
        if len(word) <= MEMO_UNIT:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[word] = n
        return n


class _UnitMemo(dict):
    """Unit -> number of tokens."""

    def __init__(self, tables: BpeTables):
        self.words, self.cut = _WordMemo(tables), tables.pattern.findall

    def __missing__(self, unit: str) -> int:
        n = sum(map(self.words.__getitem__, self.cut(unit)))
        if len(unit) <= MEMO_UNIT:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[unit] = n
        return n


def counter(tables: BpeTables) -> Callable[[str | None], int]:
    """Text -> number of tokens; null and empty texts have none."""
    memo = _UnitMemo(tables)

    def count(text: str | None) -> int:
        if not text:
            return 0
        parts = tables.sections(text)
        return len(parts) // 2 + sum(sum(map(memo.__getitem__, units(p))) for p in parts[::2])

    return count


def with_token_counts(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with a long column ``out``: tokens of the whole ``text``.

    A narrow map: no shuffle, one pass, memory bounded by one batch and the memo. Null and
    empty texts count 0; repeated rows count alike; other columns, whatever their names or
    nulls, pass through. An existing column ``out`` is replaced. An empty table gives
    an empty result.
    """
    docs = docs.select(*others(docs, out))
    tables = ship(docs.sparkSession, path)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])

    def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tables.value)
        for b in slices(batches, text):
            n = pa.array([count(x) for x in b.column(text).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, n], names=[*b.schema.names, out])

    return docs.mapInArrow(count_batches, schema)


def token_count_report(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each row."""
    sized = docs.select("doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    return with_token_counts(sized, path).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
