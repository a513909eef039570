"""Language of a text by compression: the language whose text helps most to make it shorter.

For each language a bounded sample of its documents is kept as a raw-content dictionary of
zstandard. A text, reduced to its words of letters in lower case, of which one that follows itself
counts once, is cut into pieces and each piece is compressed with each language's dictionary; a
language's size is the sum over all pieces, so that every part of a long text counts the same. The
smallest size is the prediction, and it is rejected where the next one is hardly larger.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and rejected. Of equal
sizes the language with more documents learned from is taken, then the one first in the alphabet. With nothing to
learn from, every text is ``und``. Repeated rows are predicted alike; rows to learn from that
repeat a text count once. Other columns than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notifyq.llm.common import slices, utf8_bytes

UNKNOWN = "und"

#: Characters of a text reduced to letters at once.
PART = 1 << 20
_OTHER = regex.compile(r"\P{L}+")


@dataclass(frozen=True)
class Settings:
    #: Bytes of a language's dictionary, and texts that may go into it: their number, and the
    #: size up to which they are taken before longer ones.
    dictionary: int = 32 << 10
    texts: int = 64
    text_bytes: int = 8 << 10
    #: Bytes of text compressed at once.
    piece: int = 4 << 10
    #: The part of the second smallest size by which the smallest must lie below it.
    margin: float = 0.01


@dataclass(frozen=True)
class Model:
    """The dictionaries by language, in the order in which equal sizes are decided."""

    dictionaries: dict[str, bytes] = field(default_factory=dict)
    settings: Settings = Settings()


def letters(text: str) -> bytes:
    """The words of letters of a text in lower case, one that follows itself once, in UTF-8."""
    return " ".join(word for word, _ in groupby(_OTHER.sub(" ", text.lower()).split())).encode()


def fit(docs: DataFrame, s: Settings = Settings()) -> Model:
    """Learn from the rows of ``docs`` (text, lang) that have both.

    Of each language the texts of smallest hash are taken, short ones first and equal ones once.
    What reaches the driver is ``s.texts`` hashes and ``s.dictionary`` bytes of text for each language."""
    known = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text", F.xxhash64("text").alias("hash"))
    long_ = (F.octet_length("text") > s.text_bytes).alias("long")
    each = known.groupBy("lang", "hash", long_).agg(F.count("*").alias("rows"))
    order = Window.partitionBy("lang").orderBy("long", "hash")
    first = each.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= s.texts)
    chosen = first.select("lang", "hash", "at")
    size = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    start = F.substring("text", 1, s.dictionary).alias("text")
    texts = known.join(F.broadcast(chosen), ["lang", "hash"]).groupBy("lang", "at").agg(F.min(start).alias("text"))
    held: dict[str, list[tuple[int, bytes]]] = {}
    for r in texts.toLocalIterator():
        held.setdefault(r["lang"], []).append((r["at"], letters(r["text"])))
    order = sorted(held, key=lambda lang: (-size[lang], lang))
    return Model({x: b" ".join(t for _, t in sorted(held[x]))[: s.dictionary] for x in order}, s)


class Compressors:
    """The sizes of a text with each language's dictionary."""

    def __init__(self, model: Model):
        self.piece = model.settings.piece
        parameters = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_GREEDY, min_match=4, window_log=17, hash_log=15, chain_log=15, search_log=4,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        self.tools = []
        for held in model.dictionaries.values():
            # Shorter ones are no dictionaries.
            own = zstandard.ZstdCompressionDict(held if len(held) >= 8 else b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(compression_params=parameters)
            self.tools.append(zstandard.ZstdCompressor(dict_data=own, compression_params=parameters).compress)

    def sizes(self, text: str) -> np.ndarray:
        """The sum over all pieces for each language; zeros for a text without a letter."""
        out = np.zeros(len(self.tools), np.int64)
        for start in range(0, len(text), PART):
            own = letters(text[start : start + PART])
            for at in range(0, len(own), self.piece):
                piece = own[at : at + self.piece]
                out += np.array([len(compress(piece)) for compress in self.tools], np.int64)
        return out


def judge(sizes: np.ndarray, margin: float) -> tuple[int, float, bool]:
    """(place of the smallest size, its score, rejected). The score compares the sizes by the
    exponential of their distance from the smallest, in parts of it."""
    at = int(np.argmin(sizes))
    unit = 1 + sizes[at] * margin
    score = 1 / float(np.exp((sizes[at] - sizes) / unit).sum())
    rest = np.delete(sizes, at)
    return at, score, bool(len(rest) and rest.min() - sizes[at] < margin * rest.min())


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred, score (0 to 1) and rejected for ``text``."""
    rows = docs.select(*keep, utf8_bytes(F.col("text")).alias("text"))
    names = [*keep, "lang_pred", "score", "rejected"]
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep), "lang_pred string, score double, rejected boolean"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, langs = Compressors(model), list(model.dictionaries)
        for batch in slices(batches, "text"):
            found = []
            for text in batch.column("text"):
                sizes = tools.sizes(text.as_py().decode("utf-8", "replace"))
                if sizes.any():
                    at, score, unsure = judge(sizes, model.settings.margin)
                    found.append((langs[at], score, unsure))
                else:
                    found.append((UNKNOWN, 0.0, True))
            out = zip(*found, strict=True)
            yield pa.record_batch([*(batch.column(c) for c in keep), *(pa.array(x) for x in out)], names)

    return rows.mapInArrow(run, schema)


def language_report(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every document, learned from those whose
    crc32(doc_id) leaves another remainder than 2 when divided by 4. Rows without an id are not learned from."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = fit(docs.filter(rest != 2).select("text", "lang"), s)
    out = predict(docs.select("doc_id", "text"), model, ["doc_id"])
    held = F.coalesce(rest == 2, F.lit(False)).alias("held_out")
    return out.select("doc_id", held, "lang_pred", "score", "rejected")
