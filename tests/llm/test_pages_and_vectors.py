"""Main texts, URL filters and embedding near-duplicates by brute force."""

import numpy as np
import pytest

from notifyq.llm import embedding_dedup, html_text, url_filters
from notifyq.llm.queries import URL_RULES

PAGE = """<!DOCTYPE html><html><head><title>No</title><script>var a = "</p><p>no</p>";</script></head><body class="comments">
<header>Site name</header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article class="post"><h1>Title &amp; more</h1><p>First   <b>para</b>graph.<br>Next&nbsp;line &lt;b&gt;<p>Second<div class="ad">Buy</div>
<aside>Side</aside><ul><li>One<li>Two</ul><form>Name<input></form><!-- <p>no</p> --></article>
<section id="comments"><article>Nice post</article></section><footer>&copy; x</footer></body></html>"""


def test_blocks_of_a_page():
    main = [t for label, t in html_text.blocks(PAGE) if label == html_text.MAIN]
    assert main == ["Title & more", "First paragraph. Next line <b>", "Second", "One", "Two"]
    assert html_text.blocks(None) == html_text.blocks("") == html_text.blocks("<p></p><!-- open") == []
    assert html_text.blocks("plain text") == [(html_text.LOOSE, "plain text")]
    assert html_text.blocks("<nav>menu<article><p>body</p></article>")[-1] == (html_text.MAIN, "body")


def test_names_that_only_contain_a_furniture_word_are_kept():
    main = lambda page: [t for label, t in html_text.blocks(page) if label != html_text.FURNITURE]
    for page in (
        '<article class="post no-sidebar"><p>text</p></article>', '<article class="entry comments-open sponsored">text</article>',
        '<div class="content-sidebar-wrap"><p>text</p></div>', '<article><section id="related-work">text</section></article>',
        '<article><p class="notice">text</p></article>', "<article><p><math><mi>text</mi></math></p></article>",
        "<article><svg><style>a{}</style><text>text</text></svg></article>", "<article><object>text</object></article>",
    ):
        assert main(page) == ["text"], page
    for name in ("sidebar", "cookie-notice", "site-footer", "post-x comments-area", "share_buttons", "ad", "notice"):
        assert main(f'<div class="{name}">menu</div><p>text</p>') == ["text"], name
    assert main('<article>text</article><article class="comment">nice</article>') == ["text"]


def test_repeated_windows():
    same = "this line stands on every page of the host".split()
    pages = [[f"w{k}{i}" for i in range(12)] + same + [f"v{k}{i}" for i in range(5)] for k in range(4)]
    cover = html_text.repeated(pages)
    assert all(c.tolist() == [False] * 12 + [True] * 9 + [False] * 5 for c in cover)
    assert not any(c.any() for c in html_text.repeated([same, same, same]))  # copies are one page
    assert [len(c) for c in html_text.repeated([[], same, []])] == [0, 9, 0]


def test_main_texts_of_hosts(spark):
    loose = "<p>{}</p><p>Follow us on all our channels and never miss a story again</p>"
    rows = [(k, f"http://h.example/{k}", loose.format(f"The page has its own text number {k}"), 1) for k in range(5)]
    rows += [(9, "http://h.example/9", PAGE, 1), (10, None, None, 1), (11, "no url", "", 1), (12, "http://o.example", "x " * 50_000, 1), (0, *rows[0][1:])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, _n int")
    got = {r.page_id: r.text for r in html_text.extract_main_text(pages).collect()}
    assert got[2] == "The page has its own text number 2"
    assert got[9].startswith("Title & more\n\nFirst") and got[10] == got[11] == "" and got[12] == ("x " * 50_000).strip()
    assert html_text.extract_main_text(pages).count() == len(rows)
    assert html_text.extract_main_text(pages.limit(0)).count() == 0


def test_rare_boilerplate_of_a_large_host(spark, monkeypatch):
    """A notice on 3 of 900 pages of a host goes, however its pages are dealt to runs; a text
    on 2 pages, on copies of one page, or on other hosts stays."""
    notice, twice, copied, far = (" ".join(f"{x}{k}" for k in range(12)) for x in ("Notice", "Twice", "Copied", "Far"))
    own = lambda k: f"<p>Page {k} {' '.join(f'w{k}x{i}' for i in range(9))}</p>"
    html = {k: own(k) for k in range(900)}
    for k in (5, 333, 801):
        html[k] += f"<p>{notice}</p>"
    for k in (17, 600):
        html[k] += f"<p>{twice}</p>"
    for k in (40, 300, 500, 700):
        html[k] = f"{own(40)}<p>{copied}</p>"
    rows = [(k, f"http://big.example/{k}", x) for k, x in html.items()]
    rows += [(1000 + k, f"http://h{k}.example/", f"{own(1000 + k)}<p>{far}</p>") for k in range(4)]
    rows.append((2000, "http://big.example/a", f"<article><p>Body</p></article><p>{notice}</p>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = []
    for array_pages, chars in ((256, 4_000_000), (1000, 4_000_000), (256, 300)):
        monkeypatch.setattr(html_text, "ARRAY_PAGES", array_pages)
        monkeypatch.setattr(html_text, "ARRAY_CHARS", chars)
        found.append({r.page_id: r.text for r in html_text.extract_main_text(pages).collect()})
    assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)
    holds = lambda x: sorted(k for k, t in found[0].items() if x in t)
    assert holds("Notice") == [] and holds(twice) == [17, 600] and holds(copied) == [40, 300, 500, 700] and holds(far) == [1000, 1001, 1002, 1003]
    assert found[0][5] == " ".join(["Page 5", *(f"w5x{i}" for i in range(9))]) and found[0][2000] == "Body"


def test_boilerplate_inside_articles_goes(spark, monkeypatch):
    """A notice in most articles of a host goes, however they are dealt to runs; text that few articles
    share, copies and near copies of an article, and small hosts keep all."""
    notice, few, body = (" ".join(f"{x}{k}" for k in range(12)) for x in ("Notice", "Few", "Body"))
    own = lambda k: f"<p>Page {k} {' '.join(f'w{k}x{i}' for i in range(30))}</p>"
    art = lambda *x: f"<nav>menu {len(x)}</nav><article>{''.join(x)}</article>"
    shared = {k: (f"<p>{few}</p>" if k < 100 else "") + (f"<div>{notice}</div>" if k % 3 else "") for k in range(600)}
    rows = [(k, f"http://big.example/{k}", art(own(k), x, own(k + 5000))) for k, x in shared.items()]
    rows += [(1000 + k, f"http://copies.example/{k}", art(own(7), f"<p>{body}</p>", f"<p>{'near ' * (k // 3)}</p>")) for k in range(9)]
    rows += [(2000 + k, f"http://small.example/{k}", art(own(k), f"<p>{notice}</p>")) for k in range(2)]
    rows += [(3000 + k, None, art(own(k), f"<p>{notice}</p>")) for k in range(2)]
    rows += [(4000, "http://big.example/1", art(own(1), shared[1], own(5001)))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = []
    for array_pages, chars in ((256, 4_000_000), (1000, 4_000_000), (50, 9000)):
        monkeypatch.setattr(html_text, "ARRAY_PAGES", array_pages)
        monkeypatch.setattr(html_text, "ARRAY_CHARS", chars)
        found.append({r.page_id: r.text for r in html_text.extract_main_text(pages).collect()})
    assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)
    plain = {k: html_text.main_text(html_text.blocks(h), None) for k, _, h in rows}
    for k, text in found[0].items():
        want = [x for x in plain[k].split("\n\n") if x != notice or not (k < 1000 or k == 4000)]
        assert text == "\n\n".join(want), k
    assert any("Notice" in x for x in plain.values()) and few in found[0][5]


URLS = [
    "https://a.example.org/es/1", "http://EXAMPLE.org/en/12?x", "http://x.org", "http://x.org/", "http://x.com/de/1#f", "http://x.com/fr/", "https://net",
    "ftp://u@b.co.com/de/", None, "", "no scheme", "http://notexample.org/es/", "//a", "http://a://b.org/", "http://.org/x", "http://y.com/De/", "http://x.org/",
]


def brute_url(u):
    if u is None or "://" not in u:
        host = path = ""
    else:
        rest = u.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:end].lower(), rest[end:].split("?")[0].split("#")[0]
    fit = [(len(h + p), h + p, a) for a, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_urls_by_brute_force(spark):
    pages = spark.createDataFrame([(k, u, "old") for k, u in enumerate(URLS)], "page_id long, url string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.judge_urls(pages, URL_RULES).collect()}
    assert got == {k: brute_url(u) for k, u in enumerate(URLS)}
    assert url_filters.judge_urls(pages.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in url_filters.judge_urls(pages, []).collect()} == {"allow"}


def test_cascade_is_exact(spark):
    listed = [f"k{i}" for i in range(0, 3000, 7)]
    others = [f"k{i}" for i in range(3000) if i % 7]
    f = lambda keys: spark.createDataFrame([(k,) for k in keys], "key string")
    c = url_filters.build_cascade(f(listed), f(others))
    assert len(c.levels) > 1 and all(k in c for k in listed) and not any(k in c for k in others)
    with pytest.raises(ValueError):
        url_filters.build_cascade(f(listed), f(others), max_bytes=8)


def test_vectors_by_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 16))
    vectors = [(centres[rng.integers(40)] + rng.normal(0, 0.045, 16)).astype(np.float32) for _ in range(600)]
    vectors[5:25] = [vectors[4]] * 20
    rows = [(k, v.tolist(), int(k % 2)) for k, v in enumerate(vectors)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 16, [nan] + [1.0] * 15, [inf] * 16, [None] + [1.0] * 15]
    rows += [(1000 + k, v, 0) for k, v in enumerate(odd)] + [(2000, rows[0][1], None), (None, rows[0][1], 0), (2001, [1.0, 2.0], 0)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, kept string")
    small = embedding_dedup.Graph(shard=60, block=64, queries=50)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(frame, small).collect()}
    assert len(got) == len(rows)
    x = np.stack(vectors).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= 0.98) & (np.arange(600)[:, None] % 2 == np.arange(600) % 2) & ~np.eye(600, dtype=bool)
    found = np.array([got[k].n_links for k in range(600)])
    assert (found <= links.sum(1)).all() and found.sum() >= 0.98 * links.sum() and links.sum() > 1000
    label = np.arange(600)
    for _ in range(600):
        new = np.array([min(label[i], label[links[i]].min(initial=600)) for i in range(600)])
        if (new == label).all():
            break
        label = new
    assert np.mean([got[k].component_id == label[k] for k in range(600)]) > 0.98
    for k in [*range(1000, 1006), 2000, 2001]:
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (0, k, True)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_recall_is_of_class_pairs_and_draws_on(spark):
    """Classes on a circle of 1,000 apart, of which some have a near twin."""
    g = embedding_dedup.Graph(cosine=0.9999999)
    angle = lambda k: k * 2 * np.pi / 1000

    def audit(twins, found, sizes):
        at = {k: angle(k) for k in range(1000)} | {1000 + k: angle(k) + 1e-5 for k in twins}
        rows = [(r, "a", sizes.get(r, 1), bytearray(np.array([np.cos(a), np.sin(a)]).tobytes())) for r, a in at.items()]
        links = [(r, sizes.get(o, 1), None, 1) for k in found for r, o in ((k, 1000 + k), (1000 + k, k))]
        classes = spark.createDataFrame(rows, "root long, label string, size long, unit binary")
        return embedding_dedup.recall(classes, spark.createDataFrame(links, "root long, links long, other long, pairs long"), g)

    assert audit([], [], {}) is None
    assert audit(range(20), [3], {3: 100_000, 1003: 100_000}) == pytest.approx(1 / 20)  # not 0.9998, as by rows
    assert audit([7], [], {}) == 0.0 and audit([7], [7], {}) == 1.0  # a rare link is seen
