"""URL filters by a Bloom filter cascade.

Each url gives candidate keys: every domain suffix of its host with every prefix of its path
that is as long as some rule's path. The cascade answers exactly which of these keys are
listed: level 0 encodes the listed keys, level 1 those keys of the corpus that level 0
accepts wrongly, level 2 the listed keys that level 1 accepts wrongly, and so on until none
is left. It is built over the complete key universe of the corpus, so membership is exact
for every key that can be asked, and no row is joined with the rules.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notifyq.llm.common import fresh, others, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Most bytes of cascades that are sent to the executors at once.
MAX_FILTER_BYTES = 128 << 20
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


class CascadeTooLarge(ValueError):
    """The keys need a larger cascade than is allowed."""


@dataclass
class Level:
    """One Bloom filter: 64-bit words, and the number of hash functions."""

    words: np.ndarray
    hashes: int

    @classmethod
    def sized(cls, n: int, rate: float) -> Level:
        """An empty filter for n keys at a rate of false positives."""
        bits = max(64, math.ceil(n * -math.log(rate) / math.log(2) ** 2))
        return cls(np.zeros((bits + 63) // 64, np.int64), max(1, round(bits / max(n, 1) * math.log(2))))

    def positions(self, key: str, level: int) -> list[int]:
        h = xxhash.xxh3_128_intdigest(key.encode(), seed=level)
        first, step = h >> 64, (h & ((1 << 64) - 1)) | 1
        bits = len(self.words) * 64
        return [(first + i * step) % bits for i in range(min(self.hashes, 32))]

    def has(self, key: str, level: int) -> bool:
        return all(int(self.words[p >> 6]) >> (p & 63) & 1 for p in self.positions(key, level))


class Cascade:
    """Exact membership of keys in a listed set, for the keys of a known universe."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def __contains__(self, key: str) -> bool:
        for i, level in enumerate(self.levels):
            if not level.has(key, i):
                return i % 2 == 1
        return len(self.levels) % 2 == 1

    @property
    def n_bytes(self) -> int:
        return sum(x.words.nbytes for x in self.levels)


def _filled(keys: DataFrame, empty: Level, i: int) -> Level:
    """Level i over all rows of ``keys``: partial bit sets from the tasks, merged by word."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique([p for k in b.column(0).to_pylist() for p in empty.positions(k, i)])
            word, first = np.unique(at >> 6, return_index=True)
            value = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first) if len(at) else at
            yield pa.RecordBatch.from_arrays(
                [pa.array(word, pa.int64()), pa.array(value.astype(np.uint64).view(np.int64), pa.int64())], ["word", "value"]
            )

    merged = keys.mapInArrow(bits, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value"))
    words = empty.words.copy()
    got = merged.toArrow()  # as many rows at most as the filter has words
    words[got.column("word").to_numpy()] = got.column("value").to_numpy()
    return Level(words, empty.hashes)


def _accepted(keys: DataFrame, level: Level, i: int) -> DataFrame:
    """The keys that level i accepts."""
    sent = keys.sparkSession.sparkContext.broadcast(level)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([sent.value.has(k, i) for k in b.column(0).to_pylist()], pa.bool_()))

    return keys.mapInArrow(keep, "key string")


def build_cascade(listed: DataFrame, others: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> Cascade:
    """Cascade of the distinct keys of ``listed`` against those of ``others`` (column
    ``key`` each; no key in both).

    The first level's rate leaves about as many wrongly accepted keys as there are listed
    ones; later levels halve. CascadeTooLarge if the levels exceed ``max_bytes``.
    """
    inside, outside = listed.select("key"), others.select("key")
    n_in, n_out = inside.count(), outside.count()
    levels: list[Level] = []
    rate = min(0.5, max(n_in, 1) / (math.sqrt(2) * max(n_out, 1)))
    while n_in:
        i = len(levels)
        empty = Level.sized(n_in, rate)
        if empty.words.nbytes + sum(x.words.nbytes for x in levels) > max_bytes:
            raise CascadeTooLarge(f"{n_in} keys need a cascade of more than {max_bytes} bytes")
        levels.append(_filled(inside, empty, i))
        wrong = stored(_accepted(outside, levels[i], i))
        inside, outside = wrong, inside
        n_in, n_out, rate = wrong.count(), n_in, 0.5
    return Cascade(levels)


def url_host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ?, # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def candidate_keys(host: Column, path: Column, lengths: Iterable[int]) -> Column:
    """Array of keys: domain suffixes of the host x path prefixes of the given lengths."""
    parts = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
    )
    fits = F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>"), lambda n: n <= F.char_length(path))
    return F.flatten(
        F.transform(suffixes, lambda s: F.transform(fits, lambda n: F.concat(s, F.substr(path, F.lit(1), n))))
    )


def usable_rules(rules: Iterable[tuple[str, str, str]]) -> dict[str, str]:
    """Key -> action of (action, host, path) rules. A path that neither is empty nor begins
    with / fits no url and is dropped, as is a host with one of /?#; block wins over allow
    for the same key."""
    out: dict[str, str] = {}
    for action, host, path in rules:
        if action not in ("allow", "block"):
            raise ValueError(f"unknown action {action}")
        if (path and not path.startswith("/")) or any(c in host for c in "/?#"):
            continue
        key = host.translate(str.maketrans(UPPER, LOWER)) + path
        out[key] = "block" if "block" in (action, out.get(key)) else "allow"
    return out


def judge_urls(
    pages: DataFrame, rules: Iterable[tuple[str, str, str]], url: str = "url", default: str = "allow",
    max_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    A rule fits its host and all subdomains if the url's path begins with the rule's; the
    longest rule wins, among equally long ones that of the longer host. Without a rule,
    ``rule`` is null and ``verdict`` is ``default``: an unlisted url. A null url, or one
    without ://, has empty host and path. Rows are neither dropped nor merged; other columns
    pass through; columns of the four names in ``pages`` are replaced. The rules are a
    parameter; cascades of more than ``max_bytes`` are cut into shards, one pass for each.
    """
    spark = pages.sparkSession
    actions = usable_rules(rules)
    lengths = {len(k) - len(k.split("/")[0]) for k in actions}
    names = others(pages, "host", "path", "rule", "verdict")
    parsed = pages.select(*names, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    if not actions:
        return parsed.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    keys = candidate_keys(F.col("host"), F.col("path"), lengths)
    asked = parsed.select("host", "path").distinct().select(F.explode(keys).alias("key"), F.lit(False).alias("listed"))
    rule_keys = spark.createDataFrame([(k, a) for k, a in actions.items()], "key string, action string")
    # The universe of all keys, the listed ones among it marked, from one grouping.
    both = asked.unionAll(rule_keys.select("key", F.lit(True).alias("listed")))
    unlisted = stored(both.groupBy("key").agg(F.max("listed").alias("listed")).filter("NOT listed").select("key"))
    cascades = sharded_cascades(rule_keys, unlisted, max_bytes)
    (all_keys,) = fresh(parsed, "keys")
    out = parsed.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    shards = len(cascades)

    def first_listed(shard: int, sent):  # noqa: ANN001, ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, stop = sent.value
            for b in batches:
                hits, said = b.column("rule").to_pylist(), b.column("verdict").to_pylist()
                for at, ks in enumerate(b.column(all_keys).to_pylist()):
                    for k in ks:
                        if k == hits[at]:  # found by an earlier pass, and longer than what follows
                            break
                        if shard_of(k, shards) == shard and k in known:
                            hits[at], said[at] = k, "block" if k in stop else "allow"
                            break
                kept = b.drop_columns(["rule", "verdict"])
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(hits, pa.string()), pa.array(said, pa.string())],
                    names=[*kept.schema.names, "rule", "verdict"],
                )

        return run

    # The longest first; of equally long ones the longer host, i.e. the shorter path.
    ranked = F.transform(
        F.array_sort(F.transform(keys, lambda k: F.struct(-F.char_length(k), -F.instr(k, "/"), k.alias("key")))),
        lambda s: s["key"],
    )
    out = out.select(*parsed.columns, ranked.alias(all_keys), "rule", "verdict")
    schema = T.StructType([f if f.name != "verdict" else T.StructField("verdict", T.StringType()) for f in out.schema.fields])
    for shard, pair in enumerate(cascades):  # each pass looks up the keys of one shard
        out = out.mapInArrow(first_listed(shard, spark.sparkContext.broadcast(pair)), schema)
    return out.drop(all_keys)


def shard_of(key: str, shards: int) -> int:
    return zlib.crc32(key.encode()) % shards


def sharded_cascades(rules: DataFrame, unlisted: DataFrame, max_bytes: int) -> list[tuple[Cascade, Cascade]]:
    """For each shard of the keys, the cascade of its listed ones and, asked for those only, that
    of the blocked among them. There are as many shards as keep each pair within ``max_bytes``."""
    shards = 1
    while True:
        try:
            out = []
            for k in range(shards):
                own = F.pmod(F.crc32(F.col("key").cast("binary")), F.lit(shards)) == k
                listed = build_cascade(rules.filter(own), unlisted.filter(own), max_bytes // 2)
                blocked = rules.filter(own & (F.col("action") == "block"))
                out.append((listed, build_cascade(blocked, rules.filter(own & (F.col("action") == "allow")), max_bytes // 2)))
            return out
        except CascadeTooLarge:
            shards *= 2
