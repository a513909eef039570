"""Tables of a byte-level BPE vocabulary file and the exact merging of one pre-token.

The vocabulary file (``tokenizers`` JSON) is read on the driver and broadcast: its size is
bounded by the vocabulary (some 50,000 entries), not by the data.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import cached_property

import regex
from pyspark import Broadcast
from pyspark.sql import SparkSession

# Fixed value: the pattern that byte-level pre-tokenisation splits a text with.
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

#: A space followed by a character that is surely no white space always starts a
#: pre-token: a match holds a space only as its first character or inside a run of white
#: space, and a run before a word gives up its last character. Cutting there gives units
#: whose pre-tokens do not depend on their neighbours.
UNIT_CUT = re.compile(r" (?=[!-~¡-ᙿぁ-퟿])")

#: Units longer than this are not kept in a memo.
MEMO_UNIT = 64
#: Entries of a worker's memo; it is emptied when full, which changes no result.
MEMO_ENTRIES = 400_000


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in character -> byte: Latin-1's visible characters stand for
    themselves, the other bytes in order for the code points from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BpeTables:
    """Vocabulary, merges and special tokens by id, with what is derived from them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        plain = not any(
            (
                spec["normalizer"],
                pre["type"] != "ByteLevel",
                pre["add_prefix_space"],
                not pre["use_regex"],
                model["type"] != "BPE",
                model["ignore_merges"],
                any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]),
            )
        )
        if not plain:
            raise ValueError(f"{path}: only plain byte-level BPE files are supported")
        alphabet = byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {k: v for k, v in model["vocab"].items() if k not in self.special}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(alphabet[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.byte_id = [0] * 256
        for c, b in alphabet.items():
            self.byte_id[b] = vocab[c]
        #: (left id, right id) -> (rank, id of the merged token)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])

    @cached_property
    def whole(self) -> dict[bytes, int]:
        """Byte string -> id of the tokens proven to encode alone as one token.

        The proof is the exact merging itself, run once for each vocabulary string.
        """
        ordinary = ((i, b) for i, b in enumerate(self.token_bytes) if b and b not in self._special_bytes)
        return {b: i for i, b in ordinary if self.merge(b) == [i]}

    @cached_property
    def _special_bytes(self) -> set[bytes]:
        return {s.encode() for s in self.special}

    @cached_property
    def pattern(self) -> regex.Pattern:
        return regex.compile(PRE_TOKEN)

    @cached_property
    def special_cut(self) -> re.Pattern | None:
        longest = sorted(self.special, key=len, reverse=True)
        return re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    def __getstate__(self) -> dict:
        self.whole  # noqa: B018  computed on the driver once, not by each worker
        return {k: v for k, v in self.__dict__.items() if k not in ("pattern", "special_cut")}

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token: lowest rank first, leftmost first among equals."""
        ids = [self.byte_id[b] for b in word]
        return self._merge_short(ids) if len(ids) <= 48 else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        """Ranks of adjacent pairs are kept; a merge changes its two neighbours only."""
        merges, none = self.merges, (1 << 60, -1)
        found = [merges.get(p, none) for p in zip(ids, ids[1:], strict=False)]
        while found:
            best = min(found)
            if best is none:
                break
            at = found.index(best)
            ids[at : at + 2] = [best[1]]
            del found[at]
            if at < len(found):
                found[at] = merges.get((ids[at], ids[at + 1]), none)
            if at:
                found[at - 1] = merges.get((ids[at - 1], ids[at]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list: n log n for texts without breaks."""
        n, merges = len(ids), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], at, ids[at], ids[at + 1]) for at in range(n - 1) if (m := merges.get((ids[at], ids[at + 1])))]
        heapq.heapify(heap)
        while heap:
            _, at, left, right = heapq.heappop(heap)
            to = after[at]
            if ids[at] != left or to >= n or ids[to] != right:
                continue
            ids[at] = merges[left, right][1]
            ids[to] = -1
            after[at] = after[to]
            if after[to] < n:
                before[after[to]] = at
            for x, y in ((before[at], at), (at, after[at])):
                if x >= 0 and y < n and (m := merges.get((ids[x], ids[y]))):
                    heapq.heappush(heap, (m[0], x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def sections(self, text: str) -> list[str]:
        """A text cut at special strings; these stand at the odd places."""
        if self.special_cut is None or not any(s in text for s in self.special):
            return [text]
        return self.special_cut.split(text)

    def pre_tokens(self, section: str) -> list[str]:
        return self.pattern.findall(section)


def units(section: str) -> list[str]:
    """A section cut into units that pre-tokenise alone as they do in place."""
    if not section:
        return []
    first, *rest = UNIT_CUT.split(section)
    return [*([first] if first else []), *(" " + x for x in rest)]


_SHIPPED: dict[tuple[str, str], Broadcast] = {}


def ship(spark: SparkSession, path: str) -> Broadcast:
    """The tables as a broadcast, once for each application and file."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _SHIPPED:
        _SHIPPED[key] = spark.sparkContext.broadcast(BpeTables(path))
    return _SHIPPED[key]
