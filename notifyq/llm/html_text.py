"""Main text of web pages with a host's repeated boilerplate removed.

A page is cut into text blocks, each labelled by where it stands: in the page's main container
(the articles, or the main element, that hold most of its text), in its furniture (menus, headers, footers, side bars, notices, adverts, forms, comments), or
loose. The token streams of a host's pages are concatenated in runs and sorted by suffix, which
gives each run's distinct windows and their pages; Spark counts them over all runs. Windows
that stand in several distinct pages of the host are boilerplate. Furniture goes; of loose blocks the
unique runs stay. Of a marked article those blocks go that lie whole in windows of at least half of the host's
distinct articles, unless little else is left: copies of an article on one host repeat as boilerplate
does and are no boilerplate.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notifyq.llm.common import fresh, others, slices, stored
from notifyq.llm.url_filters import url_host

MAIN, LOOSE, FURNITURE = 0, 1, 2
#: Tokens of a window; a run must be repeated at this length at least.
WINDOW = 8
#: Distinct pages that must hold a window to make it boilerplate.
PAGES = 3
#: One of so many distinct articles of a host must hold a window to make it boilerplate inside articles, and PAGES at least.
ARTICLE_SHARE = 2
#: Pages and characters of one suffix array; they do not change what is found.
ARRAY_PAGES, ARRAY_CHARS = 256, 4_000_000
#: Hosts with this share of all pages or more are at most so many; they are broadcast.
HOT_HOSTS = 4096

# Elements by what they do to text.
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "template", "noembed", "xmp"}
FURNITURE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "fieldset", "datalist"}
BLOCK_TAGS = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl", "dt", "figcaption",
    "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "ol", "p", "pre", "search",
    "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# Names of a class, id or role that mark furniture.
FURNITURE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo", "recommended",
    "related", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
# Parts that leave a compound of these words what it is (comments-area); any other part does not (no-sidebar).
NEUTRAL_WORDS = {
    "area", "articles", "bar", "block", "bottom", "box", "buttons", "container", "inner", "left", "links", "list", "main", "post",
    "posts", "reader", "readers", "right", "section", "site", "slot", "this", "thread", "top", "user", "wrap", "wrapper",
}
# Names that mark an article element itself as furniture, and names that mark furniture inside an article.
ARTICLE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "comment", "comments"}
INSIDE_WORDS = FURNITURE_WORDS
# Elements that a name like notice does not make furniture inside an article: text set apart.
SET_APART, APART_WORDS = {"p", "blockquote", "span", "strong", "em", "b", "i"}, {"notice", "notices"}
HEADER_NAMES = {"header", "site-header", "page-header", "site_header", "page_header", "top-header"}

_MARK = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^=>]++|=\s*+(?>"[^"]*"|'[^']*'|))*+)>|<[!?/][^>]*>""",
    re.S,
)
# An attribute's name and its value: a quote opens a value right after = only, and an unquoted one ends at white space.
_ATTR = re.compile(r"""([^\s/=][^\s/=]*+)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'][^\s]*+))?""")
_TELLING = re.compile("class|id|role|style|hidden", re.I)
_WORD = re.compile(r"[a-z0-9]+")


def _names(token: str, words: set[str]) -> bool:
    """Whether a name is one of ``words`` or a compound of such and neutral ones alone."""
    parts = set(_WORD.findall(token))
    return not parts.isdisjoint(words) and parts <= words | NEUTRAL_WORDS


def _is_furniture(tag: str, rest: str, in_article: bool) -> bool:
    if tag in FURNITURE_TAGS or (tag == "header" and not in_article):
        return True
    if not _TELLING.search(rest):
        return False
    for name, value in _ATTR.findall(rest):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name in ("class", "id", "role"):
            words = ARTICLE_WORDS if tag == "article" else INSIDE_WORDS if in_article else FURNITURE_WORDS
            words = words - APART_WORDS if in_article and tag in SET_APART else words
            if tag not in ("html", "body", "main") and any(_names(token, words) for token in value.split()):
                return True
            if not in_article and not HEADER_NAMES.isdisjoint(value.split()):
                return True
    return False


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(label, text) of a page's non-empty blocks in order.

    Character references are decoded, white space inside a block is one space. If the page
    marks articles or main elements, ``_chosen`` says which of them hold its text, and other text that
    is no furniture is furniture too. Comments, scripts and the like give nothing; markup that never ends is
    read up to the end of the page.
    """
    page = page or ""
    out: list[list] = []  # label, number of the outermost article, of the main element (0: none), pieces
    skip: tuple[str, int] | None = None  # furniture element and how deep it nests itself
    article = main = 0
    seen = {"article": 0, "main": 0}  # how many outermost ones have begun
    fresh, at = True, 0

    def add(text: str) -> None:
        nonlocal fresh
        if not text:
            return
        if fresh:
            out.append([FURNITURE if skip else LOOSE, seen["article"] if article else 0, seen["main"] if main else 0, []])
            fresh = False
        out[-1][3].append(text)

    while at < len(page):
        m = _MARK.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"]:
            if skip and tag == skip[0]:
                skip = (tag, skip[1] - 1) if skip[1] > 1 else None
                fresh = True
            elif tag == "article" and not skip:
                article = max(0, article - 1)
            elif tag == "main" and not skip:
                main = max(0, main - 1)
            fresh = fresh or tag in BLOCK_TAGS
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = close.start() if close else len(page)
            continue
        rest = m["rest"] or ""
        if skip and (tag == "main" or (tag == "article" and not seen["article"])) and not _is_furniture(tag, rest, False):
            skip = None  # an element left open before the article began
        if skip:
            if tag == skip[0] and tag not in VOID:
                skip = (tag, skip[1] + 1)
        elif tag not in VOID and _is_furniture(tag, rest, article > 0):
            skip, fresh = (tag, 1), True
        elif tag in seen:
            seen[tag] += not (article if tag == "article" else main)
            article, main = article + (tag == "article"), main + (tag == "main")
        if tag in ("br", "td", "th", "img"):
            add(" ")
        fresh = fresh or tag in BLOCK_TAGS
    made = [(*x, " ".join(html.unescape("".join(pieces)).split())) for *x, pieces in out]
    articles, mains = _chosen(made)
    marked = any(seen.values())
    return [
        (label if label != LOOSE or not marked else MAIN if article in articles or main in mains else FURNITURE, text)
        for label, article, main, text in made
        if text
    ]


def _chosen(made: list[tuple[int, int, int, str]]) -> tuple[set[int], set[int]]:
    """The articles and the main elements that hold a page's text, by the characters in them.

    Of the articles those count that hold half as much as the largest. A main element is
    taken instead if it holds more than them without being filled by them to one half."""
    article_chars: dict[int, int] = {}
    main_chars: dict[int, int] = {}
    for label, article, main, text in made:
        if label == LOOSE:
            article_chars[article] = article_chars.get(article, 0) + (len(text) if article else 0)
            main_chars[main] = main_chars.get(main, 0) + (len(text) if main else 0)
    largest, most = max(article_chars.values(), default=0), max(main_chars.values(), default=0)
    articles = {k for k, n in article_chars.items() if k and n and 2 * n >= largest}
    mains = {k for k, n in main_chars.items() if k and n == most}
    inside = sum(len(text) for label, article, main, text in made if label == LOOSE and article in articles and main in mains)
    if most > sum(article_chars[k] for k in articles) and 2 * inside < most:
        return set(), mains
    return articles, set()


def page_digest(tokens: list[str]) -> int:
    """Exact copies of a page have the same."""
    return int.from_bytes(blake2b("\0".join(tokens).encode(), digest_size=8).digest(), "little", signed=True)


def _ranked(pages: list[list[str]], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each place of the concatenated token streams, with a separator after each page: the
    rank of its window, its page, and whether the window ends before the page does.

    Suffixes are sorted by their first ``window`` tokens by prefix doubling: windows are
    equal exactly if their ranks are.
    """
    lengths = [len(p) for p in pages]
    code: dict[str, int] = {}
    stream = np.array([i for k, p in enumerate(pages) for i in [*(code.setdefault(t, len(code)) for t in p), -1 - k]], np.int64)
    _, rank = np.unique(stream, return_inverse=True)
    span = 1
    while span < window:
        step = min(span, window - span)
        later = np.concatenate([rank[step:], np.zeros(step, rank.dtype)])[: len(rank)]
        _, rank = np.unique(rank * (len(stream) + 1) + later, return_inverse=True)
        span += step
    starts = np.cumsum([0, *(n + 1 for n in lengths)])
    page = np.repeat(np.arange(len(pages)), np.array(lengths) + 1)
    return rank, page, np.arange(len(stream)) + window < starts[page + 1]


def covered(tokens: int, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Whether each token lies in a window that begins at one of ``starts``."""
    change = np.zeros(tokens + window + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return np.cumsum(change)[:tokens] > 0


def repeated(pages: list[list[str]], window: int = WINDOW, least: int = PAGES) -> list[np.ndarray]:
    """For each page's tokens, whether a token lies in a window that stands in ``least``
    distinct pages or more; exact copies of a page count as one."""
    lengths = [len(p) for p in pages]
    if not sum(lengths):
        return [np.zeros(0, bool) for _ in pages]
    rank, page, whole = _ranked(pages, window)
    alike: dict[int, int] = {}
    owner = [alike.setdefault(page_digest(p), k) for k, p in enumerate(pages)]
    held = np.unique(rank[whole] * len(pages) + np.array(owner)[page[whole]]) // len(pages)
    often = np.bincount(held, minlength=rank.max() + 1) >= least
    cover = covered(len(rank), np.flatnonzero(whole & often[rank]), window)
    starts = np.cumsum([0, *(n + 1 for n in lengths)])
    return [cover[s : s + n] for s, n in zip(starts[:-1], lengths, strict=True)]


_MIX = np.random.default_rng(5).integers(0, 1 << 63, WINDOW, np.uint64) * np.uint64(2) + np.uint64(1)


def window_digests(tokens: list[str]) -> np.ndarray:
    """64-bit digest of the window at each place where a whole one begins."""
    each = np.fromiter((xxhash.xxh3_64_intdigest(t) for t in tokens), np.uint64, len(tokens))
    n = max(0, len(tokens) - WINDOW + 1)
    return sum((each[k : k + n] * m for k, m in enumerate(_MIX)), np.zeros(n, np.uint64)).view(np.int64)


def run_windows(pages: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """(window digest, page digest) of a run: each distinct window with all its distinct
    pages, or PAGES of them, which is all that a count needs."""
    made = [window_digests(p) for p in pages]
    if not sum(map(len, made)):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rank, page, whole = _ranked(pages, WINDOW)
    name, owner = np.unique([page_digest(p) for p in pages], return_inverse=True)
    pairs, first = np.unique(rank[whole] * len(name) + owner[page[whole]], return_index=True)
    window = pairs // len(name)
    before = np.searchsorted(window, window)  # place of the window's first page
    some = np.arange(len(window)) - before < PAGES
    return np.concatenate(made)[first[some]], name[pairs[some] % len(name)]


def often_windows(articles: list[list[str]], least: int) -> np.ndarray:
    """Digests of the windows that stand in ``least`` of these distinct articles or more."""
    made = [window_digests(a) for a in articles]
    if not sum(map(len, made)):
        return np.zeros(0, np.int64)
    rank, page, whole = _ranked(articles, WINDOW)
    pairs, first = np.unique(rank[whole] * len(articles) + page[whole], return_index=True)
    _, at, held = np.unique(pairs // len(articles), return_index=True, return_counts=True)
    return np.concatenate(made)[first[at[held >= least]]]


def article_tokens(page: list[tuple[int, str]]) -> list[str]:
    return [t for label, text in page if label == MAIN for t in text.split(" ")]


def without_common(page: list[tuple[int, str]], common: np.ndarray) -> list[tuple[int, str]]:
    """A page without the blocks of its article that lie whole in ``common`` windows, or as it
    is if they are more than half of the article's tokens."""
    tokens = article_tokens(page)
    gone = covered(len(tokens), np.flatnonzero(np.isin(window_digests(tokens), common)))
    kept, at, dropped = [], 0, 0
    for label, text in page:
        n = text.count(" ") + 1 if label == MAIN else 0
        if n and gone[at : at + n].all():
            dropped += n
        else:
            kept.append((label, text))
        at += n
    return kept if 2 * dropped <= len(tokens) else page


def loose_windows(page: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray]:
    """(place, digest) of the windows of a page that reach into its loose blocks."""
    words = [text.split(" ") for _, text in page]
    loose = np.repeat([label == LOOSE for label, _ in page], [len(w) for w in words])
    digests = window_digests([t for w in words for t in w])
    upto = np.cumsum(np.append(0, loose))
    at = np.flatnonzero(upto[WINDOW:] > upto[:-WINDOW]) if len(digests) else np.zeros(0, np.int64)
    return at, digests[at]


def main_text(page: list[tuple[int, str]], starts: list[int] | None) -> str:
    """Main text of a page, given its blocks and the places of its boilerplate windows."""
    kept, at = [], 0
    gone = covered(sum(text.count(" ") + 1 for _, text in page), np.array(starts, np.int64)) if starts else None
    for label, text in page:
        n = text.count(" ") + 1
        if gone is not None and label == LOOSE and gone[at : at + n].any():
            text = " ".join(w for w, g in zip(text.split(" "), gone[at : at + n], strict=True) if not g)
        at += n
        if label != FURNITURE and text:
            kept.append(text)
    return "\n\n".join(kept)


def extract_main_text(pages: DataFrame, url: str = "url", page_html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` without ``page_html``, with a string column ``out``: the main text.

    Null and empty html give the empty text; a null url makes a host of its own; repeated
    rows are extracted alike; other columns, whatever their names, pass through; an existing
    column ``out`` is replaced. Pages are parsed once and kept as compressed blocks. The articles of a host meet
    in runs too, so that those of all pages are sorted by suffix. If
    a host has loose blocks, its pages are worked on in runs of ARRAY_PAGES pages, hosts of
    many runs dealt over many tasks; distinct pages of a window are counted over all runs.
    """
    names = others(pages, out, page_html)
    kept = pages.select(*names).schema.fields
    packed_name, loose_name, starts_name, host_name, form_name, common_name = fresh(pages, "blocks", "loose", "starts", "host", "form", "common")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3)
        for b in slices(batches, page_html):
            made = [blocks(x) for x in b.column(page_html).to_pylist()]
            packed = pa.array([pack.compress(json.dumps(x, ensure_ascii=False).encode()) for x in made], pa.binary())
            loose = pa.array([any(label == LOOSE for label, _ in x) for x in made], pa.bool_())
            rest = b.drop_columns([page_html])
            yield pa.RecordBatch.from_arrays([*rest.columns, packed, loose], names=[*rest.schema.names, packed_name, loose_name])

    new = [T.StructField(packed_name, T.BinaryType()), T.StructField(loose_name, T.BooleanType())]
    parsed = stored(pages.select(*names, page_html).mapInArrow(parse, T.StructType([*kept, *new])))
    made = T.StructType([*kept, T.StructField(out, T.StringType())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, packed_name):
            texts = []
            for raw, starts, common in zip(*(b.column(c).to_pylist() for c in (packed_name, starts_name, common_name)), strict=True):
                page = _unpacked(raw)
                texts.append(main_text(without_common(page, np.array(common, np.int64)) if common else page, starts))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(texts, pa.string())], names=[*names, out])

    none, no_common = F.lit(None).cast("array<int>").alias(starts_name), F.lit(None).cast("array<long>").alias(common_name)
    host, packed = url_host(F.col(url)), F.col(packed_name).alias("_blocks")
    # A page with a marked article has no loose blocks.
    plain = parsed.filter(~F.col(loose_name)).select(*names, packed_name, none)
    common = common_windows(parsed.filter(~F.col(loose_name)).select(host.alias("_host"), packed))
    if common is None:
        plain = plain.select("*", no_common)
    else:
        common = common.select(F.col("_host").alias(host_name), F.col("_common").alias(common_name))
        plain = plain.withColumn(host_name, host).join(common, host_name, "left").drop(host_name)
    plain = plain.select(*names, packed_name, starts_name, common_name).mapInArrow(extract, made)
    loose = parsed.filter(F.col(loose_name))
    if loose.isEmpty():
        return plain
    # Equal blocks have equal bytes, so a digest of them names a page of a host.
    form = F.sha2(packed_name, 256)
    asked = loose.select(host.alias("_host"), form.alias("_form"), packed).dropDuplicates(["_host", "_form"])
    starts = boilerplate(parsed.select(host.alias("_host"), packed), asked)
    starts = starts.select(F.col("_host").alias(host_name), F.col("_form").alias(form_name), F.col("_starts").alias(starts_name))
    full = loose.select(*names, packed_name, host.alias(host_name), form.alias(form_name)).join(starts, [host_name, form_name], "left")
    return plain.unionAll(full.select(*names, packed_name, starts_name, no_common).mapInArrow(extract, made))


def _unpacked(raw: bytes) -> list[tuple[int, str]]:
    return [(label, text) for label, text in json.loads(zstandard.ZstdDecompressor().decompress(raw))]


def _hot(held: DataFrame, total: int) -> DataFrame:
    """(_hot, _parts): hosts of very many of ``total`` rows, and the parts they are dealt to."""
    hosts = held.groupBy("_host").agg(F.count("*").alias("n"))
    # At most HOT_HOSTS hosts have that share, so their number is bounded for any input.
    return hosts.filter((F.col("n") * HOT_HOSTS >= total) & (F.col("n") > ARRAY_PAGES)).select(
        F.col("_host").alias("_hot"), F.ceil(F.col("n") / ARRAY_PAGES).cast("int").alias("_parts")
    )


def common_windows(pages: DataFrame) -> DataFrame | None:
    """(_host, _common): the windows that stand in one of ARTICLE_SHARE distinct articles of a host or
    more, and in PAGES of them at least. None if there are none.

    A host's distinct articles are dealt to runs; a window with that share of all has it in one
    run at least, so the runs' suffix arrays give few candidates, which are then counted over all.
    """

    def articles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3)
        for b in slices(batches, "_blocks"):
            made = [article_tokens(_unpacked(raw)) for raw in b.column("_blocks").to_pylist()]
            digests = pa.array([page_digest(t) for t in made], pa.int64())
            packed = pa.array([pack.compress(" ".join(t).encode()) for t in made], pa.binary())
            long = pa.array([len(t) >= WINDOW for t in made], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("_host"), digests, packed], names=["_host", "_page", "_article"]).filter(long)

    def tokens(raw: bytes) -> list[str]:
        return zstandard.ZstdDecompressor().decompress(raw).decode().split(" ")

    held = pages.filter("_host IS NOT NULL").mapInArrow(articles, "_host string, _page long, _article binary")
    dealt = (
        held.join(F.broadcast(_hot(pages, max(1, pages.count()))), F.col("_host") == F.col("_hot"), "left")
        .select("_host", "_page", "_article", F.coalesce(F.pmod("_page", F.col("_parts")), F.lit(-1)).cast("int").alias("_part"))
        .repartition("_host", "_part")
        .sortWithinPartitions("_host", "_part", "_page")
    )

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[list[str]] = []
        now, last, chars, cut = None, None, 0, False

        def flush(whole: bool) -> Iterator[pa.RecordBatch]:
            share = -(-len(run) // ARTICLE_SHARE)
            found = often_windows(run, max(PAGES, share) if whole else share) if len(run) >= PAGES or not whole else np.zeros(0, np.int64)
            parts = [pa.array([now[0]], pa.string()), pa.array([len(run)], pa.int64()), pa.array([found.tolist()], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(parts, names=["_host", "_n", "_windows"])

        for b in slices(batches, "_article"):
            rows = zip(*(b.column(c).to_pylist() for c in ("_host", "_part", "_page", "_article")), strict=True)
            for host, part, page, raw in rows:
                key, full = (host, part), chars > ARRAY_CHARS
                if key == now and page == last:
                    continue  # a copy of the article
                if run and (key != now or full):
                    cut = cut or key == now
                    yield from flush(now[1] < 0 and not cut)
                    run, chars, cut = [], 0, cut and key == now
                run.append(tokens(raw))
                now, last, chars = key, page, chars + sum(map(len, run[-1])) + len(run[-1])
        if run:
            yield from flush(now[1] < 0 and not cut)

    runs = dealt.mapInArrow(candidates, "_host string, _n long, _windows array<long>")
    hosts = runs.groupBy("_host").agg(F.sum("_n").alias("_n"), F.array_distinct(F.flatten(F.collect_list("_windows"))).alias("_windows"))
    hosts = stored(hosts.filter((F.col("_n") >= PAGES) & (F.size("_windows") > 0)))
    if hosts.isEmpty():
        return None

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_article"):
            for k, (raw, windows) in enumerate(zip(b.column("_article").to_pylist(), b.column("_windows").to_pylist(), strict=True)):
                found = np.intersect1d(window_digests(tokens(raw)), np.array(windows, np.int64))
                own = [pa.repeat(b.column(c)[k], len(found)) for c in ("_host", "_n", "_page")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(found)], names=["_host", "_n", "_page", "_window"])

    found = held.join(hosts, "_host").mapInArrow(hits, "_host string, _n long, _page long, _window long").distinct()
    counts = found.groupBy("_host", "_n", "_window").count().filter((F.col("count") >= PAGES) & (F.col("count") * ARTICLE_SHARE >= F.col("_n")))
    return counts.groupBy("_host").agg(F.collect_list("_window").alias("_common"))


def boilerplate(pages: DataFrame, asked: DataFrame) -> DataFrame:
    """(_host, _form, _starts): where windows begin, in the pages ``asked`` for, that reach
    into loose blocks and stand in PAGES distinct pages of the host or more.

    ``pages`` has _host and _blocks of all pages, ``asked`` (_host, _form, _blocks) of those
    with loose blocks.
    """
    held = pages.join(asked.select("_host").distinct(), "_host", "left_semi")
    hot = _hot(held, max(1, pages.count()))
    order = F.xxhash64("_blocks")
    dealt = (
        held.join(F.broadcast(hot), F.col("_host") == F.col("_hot"), "left")
        .select("_host", "_blocks", F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(order, F.col("_parts"))).alias("_part"))
        .repartition("_host", "_part")
        .sortWithinPartitions("_host", "_part", order)
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[list[str]] = []
        now, chars = None, 0

        def flush() -> Iterator[pa.RecordBatch]:
            window, page = run_windows(run)
            if len(window):
                yield pa.RecordBatch.from_arrays([pa.repeat(now[0], len(window)), pa.array(window), pa.array(page)], ["_host", "_window", "_page"])

        for b in slices(batches, "_blocks"):
            keys = zip(b.column("_host").to_pylist(), b.column("_part").to_pylist(), strict=True)
            for key, raw in zip(keys, b.column("_blocks").to_pylist(), strict=True):
                tokens = [t for _, text in _unpacked(raw) for t in text.split(" ")]
                size = sum(map(len, tokens)) + len(tokens)
                if run and (key != now or len(run) >= ARRAY_PAGES or chars + size > ARRAY_CHARS):
                    yield from flush()
                    run, chars = [], 0
                now, chars = key, chars + size
                run.append(tokens)
        yield from flush()

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_blocks"):
            for k, raw in enumerate(b.column("_blocks").to_pylist()):
                at, window = loose_windows(_unpacked(raw))
                if len(at):
                    own = [pa.repeat(b.column(c)[k], len(at)) for c in ("_host", "_form")]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(at, pa.int32()), pa.array(window)], ["_host", "_form", "_at", "_window"])

    # Distinct by page first: a window that all pages hold is spread over the tasks.
    windows = dealt.mapInArrow(count, "_host string, _window long, _page long").distinct()
    often = windows.groupBy("_host", "_window").count().filter(F.col("count") >= PAGES).select("_host", "_window")
    found = asked.mapInArrow(places, "_host string, _form string, _at int, _window long").join(often, ["_host", "_window"])
    return found.groupBy("_host", "_form").agg(F.collect_list("_at").alias("_starts"))
