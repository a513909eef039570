"""Hard negatives, language identification and ranked search against plain Python."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from notifyq.llm import hard_negatives as hn
from notifyq.llm import language_id as lang
from notifyq.llm import lexical_search as lex
from notifyq.llm.queries import QUERIES

# ---- hard negatives ---------------------------------------------------------------------------


def mined(rows, is_anchor):
    """Brute force over (vec_id, label, vector) rows that take part."""
    held = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own = (label, tuple(math.floor(256 * x) for x in v))
        held[i] = min(held.get(i, own), own)
    out = set()
    for a, (label, v) in held.items():
        if not is_anchor(a):
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in held.items() if i != a}
        same = sorted((i for i in score if held[i][0] == label), key=lambda i: (-score[i], i))[:5]
        for p in same:
            fit = [i for i in score if held[i][0] != label and 80 * score[p] <= 100 * score[i] <= 100 * score[p]]
            for rank, i in enumerate(sorted(fit, key=lambda i: (-score[i], i))[:5], 1):
                out.add((a, p, rank, i, score[p], score[i]))
    return out


VECTORS = "vec_id long, label int, embedding array<float>"


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives_equal_brute_force(spark, small):
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(0, 3)), [float(x) for x in rng.normal(0, 0.2, 20).astype("f4")]) for i in range(300)]
    rows += [(i, 1, rows[0][2]) for i in range(300, 400)]  # a third of all rows are copies: ties
    rows += [rows[10], (10, 2, rows[11][2])]  # a repeated row, an id with two contents
    rows += [(500, None, rows[0][2]), (501, 1, None), (502, 1, [None, 1.0]), (503, 1, [float("nan")]), (504, 1, [float("inf")] * 20)]
    rows += [(None, 1, rows[0][2]), (600, 0, []), (601, 1, [0.5]), (-100, 1, rows[3][2])]
    df = spark.createDataFrame(rows, VECTORS).withColumn("positives", F.lit(1)).withColumn("ints", F.lit("x"))
    s = hn.Settings(slice=64, group=3, rows=16, anchors=2) if small else hn.Settings()
    got = hn.hard_negatives(df, F.col("vec_id") % 20 == 0, s).collect()
    want = mined(rows, lambda i: i % 20 == 0)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert any(r.positive_score == r.negative_score for r in got)


def test_hard_negatives_of_empty_and_single_rows(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hn.hard_negatives(empty, F.col("vec_id") % 100 == 0).collect() == []
    one = spark.createDataFrame([(0, 1, [0.1])], VECTORS)
    assert hn.hard_negatives(one, F.col("vec_id") % 100 == 0).collect() == []


def test_scores_by_tables_are_inner_products():
    rng = np.random.default_rng(1)
    for top in (1, 2, 200, 1 << 27):
        rows, anchors = rng.integers(-top, top, (50, 13)), rng.integers(-top, top, (7, 13))
        planes = hn.bit_planes(rows)
        assert (hn.from_planes(planes)[:, :13] == rows).all()
        got = hn.exact_scores(hn.subset_sums(anchors, planes.shape[1], np.int64), planes)
        assert (got == rows @ anchors.T).all()


# ---- language ---------------------------------------------------------------------------------

WORDS = {
    "aa": ["kalo", "meru", "tanis", "lopa", "rekum", "sadi"],
    "bb": ["schwin", "brekt", "flutz", "grompf", "knarz", "dulch"],
    "cc": ["éàu", "oùi", "èlle", "çaro", "nûit", "fêt"],
}


def text_of(language, words, rng):
    return " ".join(rng.choice(WORDS[language]) for _ in range(words))


def test_language_learned_predicted_and_rejected(spark):
    rng = random.Random(3)
    rows = [(i, text_of(x, rng.randint(3, 40), rng), x) for i, x in enumerate(sorted(WORDS) * 60)]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 !! \n", "cc"), (1003, text_of("bb", 300_000, rng), None)]
    rows += [(1004, "zzzz", None), (1005, rows[0][1], "aa"), (1005, rows[0][1], "aa"), (None, rows[1][1], "bb")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    df = df.withColumn("score", F.lit("x")).withColumn("LANG_PRED", F.lit(1)).withColumn("hash", F.lit(0))
    got = lang.language_report(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    right = [by[i].lang_pred == x for i, t, x in rows[:180]]
    assert sum(right) >= 178
    assert [(by[i].lang_pred, by[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert by[1003].lang_pred == "bb" and not by[1003].rejected
    assert by[1004].rejected and by[1004].lang_pred in WORDS
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)


def test_languages_of_held_out_rows_are_not_learned(spark):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, "kalo meru", "xx" if i in held else "aa") for i in range(100)]
    got = lang.language_report(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert {r.lang_pred for r in got} == {"aa"}
    assert lang.language_report(spark.createDataFrame([], "doc_id long, text string, lang string")).collect() == []
    alone = spark.createDataFrame([(1, "kalo", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in lang.language_report(alone).collect()] == [("und", 0.0)]


def test_sizes_are_those_of_all_pieces():
    model = lang.Model({"aa": b"kalo meru tanis lopa " * 9, "bb": b"schwin brekt flutz " * 9})
    tools = lang.Compressors(model)
    text = "kalo meru, tanis! " * 2000
    own = lang.letters(text)
    assert lang.letters("Of of OF, the 1 the") == b"of the"
    want = [sum(len(c(own[a : a + 4096])) for a in range(0, len(own), 4096)) for c in tools.tools]
    assert tools.sizes(text).tolist() == want and want[0] < want[1]


def test_language_held_out_accuracy_on_the_given_documents(spark):
    from conftest import SF001

    got = QUERIES["op12_language_id"](spark, SF001)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang")
    right = got.filter("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98


# ---- search -----------------------------------------------------------------------------------


def plain_terms(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = c.lower() if "A" <= c <= "Z" else c
        if "0" <= c <= "9" or "a" <= c <= "z" or ord(c) >= 0x80:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def ranked(docs, items, k):
    held = [(i, plain_terms(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    n, total = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    own = {}
    for i, t in items:
        if i is not None:
            own.setdefault(i, set()).update(plain_terms(t))
    out = []
    for item, terms in own.items():
        scores = []
        for i, t in held:
            m = 10 + 90 * len(t) * n // total
            s = 0
            for x in terms:
                if tf := t.count(x):
                    s += math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if s > 0 and i is not None:
                scores.append((-s, i))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("s", [lex.Settings(), lex.Settings(block=3, pairs=7, window=600)])
def test_ranked_search_equals_brute_force(spark, s):
    rng = random.Random(11)
    words = ["the", "of"] * 8 + [f"w{i}" for i in range(60)] + ["É", "ß", "x_y", "A-b", "naïve", "日本"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 5, 40, 200])))) for i in range(150)]
    docs += [(200 + i, docs[7][1]) for i in range(70)]  # a group of copies: ties
    docs += [(300, None), (301, ""), (302, "!!! ..."), (None, docs[3][1]), (5, "w1 w2 The"), (5, "w1 w2 THE"), (303, "rare " * 30_000)]
    items = [(0, "The w1, W2; w3"), (1, docs[7][1]), (2, None), (3, ""), (4, "unseen words"), (5, "rare É ß"), (6, "日本 x_y A-b")]
    items += [(7, "w9"), (7, "w10 w9"), (0, "The w1, W2; w3"), (None, "w1")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("m", F.lit("x")).withColumn("terms", F.lit(1))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit(1))
    got = sorted(tuple(r) for r in lex.rank_documents(d, b, 10, s).select("item_id", "rank", "doc_id", "score").collect())
    assert got == ranked(docs, items, 10)


def test_ranked_search_of_empty_tables(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items, empty = spark.createDataFrame([(1, "a")], "item_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert lex.rank_documents(none, items).collect() == []
    assert lex.rank_documents(some, empty).collect() == []
    assert [r.doc_id for r in lex.rank_documents(some, items).collect()] == [1]


def test_blocks_below_the_threshold_are_not_opened(monkeypatch):
    opened = []
    score = lex.Block.scores
    monkeypatch.setattr(lex.Block, "scores", lambda self, terms: opened.append(1) or score(self, terms))
    items = lex.Items.of([(1, b"a"), (1, b"b")])
    one = lambda x: np.array(x, np.int32).tobytes()
    rows = []
    for k in range(50):
        both = k == 30
        names = ["ids", "terms", "starts", "tfs", "docs"]
        rows.append({"m": 100, **dict(zip(names, lex.pack_block([k], [one([0, 1] if both else [0])], [one([1, 1] if both else [1])])))})
    found = {}
    lex.visit([lex.Block(r, np.array([5, 9])) for r in rows], items, items.holders(), found, 1)
    assert found[0][1].tolist() == [30] and len(opened) == 1
