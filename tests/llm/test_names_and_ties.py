"""Extra columns with the names that operators use, ties and recall of all operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from notifyq.llm import bpe_codec, decontaminate, embedding_dedup, html_text, line_dedup, quality, token_counts, url_filters
from notifyq.llm.queries import URL_RULES, vocabulary

#: Names that operators use inside, or give to their results, in another case too.
CLASHES = [
    "_drop", "drop", "drop_id", "KEPT_TEXT", "n_lines", "_blocks", "blocks", "loose", "starts", "HOST", "_host", "_form", "form",
    "_text", "own_text", "_hits", "hits", "Contaminated", "_keys", "keys", "Rule", "SCORE", "_score", "N_TOKENS", "IDS", "Decoded",
    "row", "digest", "key", "shard",
]


def clashing(df):
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHES)])


def check(before, after, made):
    """All columns but the replaced ones pass through, the new ones are there."""
    gone = {m.lower() for m in made}
    kept = [c for c in before.columns if c.lower() not in gone]
    assert [c for c in after.columns if c.lower() not in gone] == kept
    rows = after.collect()
    assert all(r[c] == k for r in rows for k, c in enumerate(CLASHES) if c in kept)
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "one line of text\nshared line of words"), (2, "shared line of words\nanother one"), (3, None), (None, "shared line of words"), (4, "")]
    return clashing(spark.createDataFrame(rows, "doc_id long, text string"))


def test_line_dedup(docs):
    rows = check(docs, line_dedup.dedup_lines(docs), ["kept_text", "n_lines", "n_dropped"])
    assert {r.doc_id: r.kept_text for r in rows}[2] == "another one"


def test_token_counts_and_codec(docs):
    rows = check(docs, token_counts.with_token_counts(docs, vocabulary()), ["n_tokens"])
    assert {r.doc_id: r.n_tokens for r in rows}[3] == 0
    encoded = bpe_codec.encode(docs, vocabulary())
    check(docs, encoded, ["ids"])
    back = check(encoded, bpe_codec.decode(encoded, vocabulary()), ["decoded"])
    assert {r.doc_id: r.decoded for r in back}[1] == "one line of text\nshared line of words"


def test_quality(docs):
    model = quality.train(["good words here"] * 8 + ["bad bad bad"] * 8, [1] * 8 + [0] * 8, quality.Settings())
    rows = check(docs, quality.with_scores(docs, model), ["score"])
    assert all(0 <= r.score <= 1 for r in rows)


def test_html(spark):
    pages = [(1, "http://h.example/1", "<article><p>Body</p></article>"), (2, None, None), (3, "http://h.example/3", "<p>Loose text of a page</p>")]
    df = clashing(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("TEXT", F.lit("old")))
    rows = check(df.drop("html"), html_text.extract_main_text(df), ["text"])
    assert {r.page_id: r.text for r in rows} == {1: "Body", 2: "", 3: "Loose text of a page"}


def test_leaks(spark, docs):
    bench = spark.createDataFrame([(7, " ".join(f"w{k}" for k in range(40)))], "item_id long, text string")
    held = clashing(spark.createDataFrame([(9, "x " + " ".join(f"w{k}" for k in range(40)))], "doc_id long, text string"))
    rows = check(docs, decontaminate.with_leaks(docs.unionAll(held), bench), ["contaminated", "n_items", "item_ids", "overlap"])
    assert {r.doc_id: r.contaminated for r in rows}[9] and not {r.doc_id: r.contaminated for r in rows}[1]


def test_urls(spark):
    urls = ["http://a.example.org/en/1", "http://x.com/de/2", "http://net", None, "http://y.org/z", "http://x.com/fr/de/"] * 3
    df = clashing(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))
    made = ["host", "path", "rule", "verdict"]
    whole = check(df, url_filters.judge_urls(df, URL_RULES), made)
    tell = lambda rows: sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in rows)
    rules = [*URL_RULES, *(("block", f"h{k}.example", "/") for k in range(400))]
    assert tell(whole) == tell(url_filters.judge_urls(df, rules).collect())
    # Cascades cut into shards, as a longer list of rules would need.
    many = url_filters.judge_urls(df, rules, max_bytes=100)
    assert str(many._jdf.queryExecution().analyzed()).count("MapInArrow") > 1
    assert tell(many.collect()) == tell(whole)


def test_no_join_with_the_rules(spark):
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert "Join" not in url_filters.judge_urls(df, URL_RULES)._jdf.queryExecution().executedPlan().toString()


ATTRIBUTES = [
    ('<p data-hidden="1">keep me</p>', "keep me"), ('<p title="hidden gem">keep</p>', "keep"), ('<div data-class="ad">x</div>', "x"),
    ('<div data-id="comments">x</div>', "x"), ("<div data-role=menu>x</div>", "x"), ('<a title="see class=ad">x</a>', "x"),
    ("<article><p title=it's>Hello</p></article>", "Hello"), ('<p a="1" b=2 c>x', "x"), ("<a href=/x/y>z</a>", "z"),
    ('<p class = "ad">x</p>', ""), ("<p CLASS='ad'>x</p>", ""), ("<p hidden>x</p>y", "y"), ("<div " + 'a="1" ' * 20 + ">x</div>", "x"),
    ("<article class=card><p>Teaser</p></article><main><p>The real main text</p></main>", "The real main text"),
    ("<article><p>A long text of many words</p></article><section><article><p>Teaser</p></article></section>", "A long text of many words"),
    ("<main><h1>T</h1><article><p>Body text</p></article></main>", "Body text"),
    ("<main><article><p>aa</p></article><p>most of the text is no article</p></main>", "aa\n\nmost of the text is no article"),
    ("<article><p>half one</p></article><article><p>half two</p></article>", "half one\n\nhalf two"),
]
INSIDE = [
    "comments-section", "comment-thread", "reader-comments", "user-comments", "disqus_thread", "ad-slot", "ad-container",
    "ad-wrapper", "sidebar-left", "post-footer", "share-this", "notice",
]


def test_attributes_and_main_containers():
    for page, want in ATTRIBUTES + [(f'<article><p>Body</p><div class="{c}">no</div></article>', "Body") for c in INSIDE]:
        assert html_text.main_text(html_text.blocks(page), None) == want, page


def test_many_attributes_and_no_end_take_no_time():
    page = "<div " + 'a="1" ' * 20_000
    assert html_text.blocks(page)[0][1].startswith("<div a=")
    assert html_text.blocks("<p a='" * 5000)


def test_one_row_of_an_id_whatever_the_order(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(1, text, "en", "a", 9), (1, text, "en", "b", 9), (1, text + " x", "de", "c", 9), (2, text, "en", "d", 9), (None, text, "en", "e", 9), (None, None, None, None, None)]
    got = []
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        df = spark.createDataFrame(order, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
        out = corpus_pipeline.keep_one_of_each(spark, df, "")
        assert out.columns == df.columns
        got.append(sorted(map(str, out.collect())))
    assert got[0] == got[1] == got[2] and len(got[0]) == 3


@pytest.mark.parametrize("shard", [10_000, 150, 40])
def test_recall_with_one_several_and_many_centroids(spark, monkeypatch, shard):
    """Links planted among others are found, and the audit runs whatever the overlap is."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(1500, 24))
    near = base[:200] + 0.02 * rng.normal(size=(200, 24))
    rows = [(k, [float(x) for x in v], k % 2 if k < 1500 else (k - 1500) % 2) for k, v in enumerate(np.vstack([base, near]))]
    audited = []
    monkeypatch.setattr(embedding_dedup, "recall", lambda c, f, g, real=embedding_dedup.recall: audited.append(real(c, f, g)) or audited[-1])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df, embedding_dedup.Graph(shard=shard, block=128)).collect()}
    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([y for *_, y in rows])
    links = (x @ x.T >= 0.98) & (label[:, None] == label) & ~np.eye(len(x), dtype=bool)
    found = sum(n for n, _ in got.values())
    assert audited and audited[-1] >= 0.98
    assert 0.98 * links.sum() <= found <= links.sum() and links.sum() >= 350


def test_a_search_that_finds_too_little_ends_in_exact_blocks(spark, monkeypatch):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(400, 16))
    rows = [(k, [float(x) for x in v], 1) for k, v in enumerate(np.vstack([base, base[:60] + 0.01 * rng.normal(size=(60, 16))]))]
    monkeypatch.setattr(embedding_dedup, "range_search", lambda *_: np.zeros(0, np.int64))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.near_duplicates(df, embedding_dedup.Graph(shard=100)).agg(F.sum("n_links")).first()[0]
    assert got >= 120
