"""Token counts, the BPE codec and training order against the public libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from notifyq.llm import bpe_codec, token_counts, training_order
from notifyq.llm.bpe_tables import PRE_TOKEN, BpeTables
from notifyq.llm.queries import vocabulary

ODD = [
    None, "", " ", "\n\n  \n", "a" * 50_000, "ab" * 20_000 + " x", "I'll don't WE'LL", "x<|endoftext|>y <|endof", "漢字　かな",
    "é\u0301 \xa0 \x85 \x1c", "👍🏽 ok", "== ==== =====", "same text", "same text", "1234567 ٣٤", "\t tab\r\nline  end ",
]
SCHEMA = "doc_id long, text string, n_bytes string, ids string, label int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


@pytest.fixture(scope="module")
def tables():
    return BpeTables(vocabulary())


def odd_docs(spark):
    rows = [(k if k != 3 else None, t, None, "x", None) for k, t in enumerate(ODD)]
    return spark.createDataFrame(rows, SCHEMA)


def test_counts_and_codec_follow_the_library(spark, library):
    rows = token_counts.token_count_report(odd_docs(spark), vocabulary()).collect()
    coded = bpe_codec.codec_report(odd_docs(spark), vocabulary()).collect()
    assert len(rows) == len(coded) == len(ODD)
    want = {}
    for k, t in enumerate(ODD):
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want[k if k != 3 else None] = (len((t or "").encode()), len(ids), digest, hashlib.sha256(decoded.encode()).hexdigest())
    for r in rows:
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (*want[r.doc_id][:2], want[r.doc_id][1] > 512)
    for r in coded:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want[r.doc_id][1:]


def test_random_words_by_speculation_and_by_merging(library, tables):
    rnd, pieces = random.Random(3), [" ", "  ", "\n", "a", "aa", "ab", "he", "The", "=", "==", "é", "'s", "1", "<|endoftext|>", "-----"]
    texts = ["".join(rnd.choices(pieces, k=rnd.randint(0, 14))) for _ in range(3000)]
    encoder, count = bpe_codec.Encoder(tables), token_counts.counter(tables)
    got = encoder.encode(texts)
    assert encoder.exact > 0
    for t, x in zip(texts, got, strict=True):
        ids = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(x, "<u4").tolist() == ids and count(t) == len(ids)
    assert bpe_codec.decoder(tables)(got) == texts
    assert bpe_codec.decoder(tables)([None, np.array([70_000], "<u4").tobytes()]) == [None, ""]


def test_whole_tokens_are_proven(tables):
    assert all(tables.merge(b) == [i] for b, i in list(tables.whole.items())[::97])
    assert b"<|endoftext|>" not in tables.whole


def test_general_codec_round_trip_and_empty_table(spark):
    docs = odd_docs(spark).drop("ids")
    back = bpe_codec.decode(bpe_codec.encode(docs, vocabulary()), vocabulary()).collect()
    assert all(r.decoded == (r.text or "") for r in back)
    assert bpe_codec.codec_report(docs.limit(0), vocabulary()).count() == 0
    assert token_counts.token_count_report(docs.limit(0), vocabulary()).count() == 0
    replaced = bpe_codec.encode(odd_docs(spark), vocabulary())  # its column ids is replaced
    assert [f.dataType.simpleString() for f in replaced.schema.fields if f.name == "ids"] == ["binary"]


def test_permutation_is_a_bijection():
    for n in (1, 2, 3, 10, 1000, 65_537):
        a = training_order.permuted(np.arange(n), n, "k")
        assert sorted(a.tolist()) == list(range(n))
    assert training_order.permuted(np.arange(1000), 1000, "k").tolist() != training_order.permuted(np.arange(1000), 1000, "j").tolist()


def test_training_order_is_written_whole_and_resumable(spark, library, workdir):
    ranks = training_order.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    out = f"{workdir}/blocks"
    rows = training_order.write_training_order(odd_docs(spark), ranks, PRE_TOKEN, out, "k", length=16, per_block=8).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    records = {}
    for first in range(0, len(rows), 100):
        part = training_order.read_slots(spark, out, first, 100, length=16, per_block=8).collect()
        records |= {r.slot: np.frombuffer(bytes(r.record), "<u2").tolist() for r in part}
    assert len(records) == len(rows)
    by_doc = {}
    for r in sorted(rows, key=lambda r: r.seq_no):
        assert len(records[r.slot]) == 16 and r.block == r.slot // 8 and r.offset == r.slot % 8 * 32
        by_doc.setdefault(r.doc_id, []).extend(records[r.slot][: r.n_tokens])
    for k, t in enumerate(ODD):
        assert by_doc[k if k != 3 else None] == [*library.encode(t or "", add_special_tokens=False).ids, 50256]
    empty = training_order.write_training_order(odd_docs(spark).limit(0), ranks, PRE_TOKEN, f"{workdir}/none", "k")
    assert empty.count() == 0
