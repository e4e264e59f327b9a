"""HTML extraction by a host suffix array, with the page's structure as a prior.

A page falls into blocks of text. Blocks in navigation, headers, footers, sidebars, notices, adverts, forms, comments and
the like are chrome; blocks of an article or main element are the article; all others are open. The word streams of a
host's chrome and open blocks are joined and their suffixes sorted: runs of MIN_RUN words or more that occur on several
distinct pages are boilerplate. On pages without an article these runs are cut out of the open blocks, and the unique runs
between stay. In an article a run is cut out if open blocks of several distinct pages have it. Chrome goes in any case, but
is no evidence against an article: adverts and teasers quote what articles say. What repeats in articles only is text.

A host too large for one task has its runs counted through a shuffle instead, over all its pages, with the same result.
"""

from __future__ import annotations

import re
import struct
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from gridprep.llm.common import _MULT, Words, bits_of, cut, hits, mix64, small_batches, with_rows
from gridprep.llm.urls import host_path

#: Words of a repeated run, and distinct pages it is on.
MIN_RUN, MIN_PAGES = 8, 2
#: Words of a host that one task sorts at most; the runs of a larger host are counted by a shuffle, with the same result.
SHARD_WORDS = 400_000

_MARK = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
_INSIDE = re.compile(r"(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>")
_ATTR = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "object", "canvas", "audio", "video", "noframes", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
_CHROME_TAGS = {"nav", "footer", "aside", "form", "head", "title", "menu", "dialog", "select", "button", "search", "dir"}
_CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu", "menubar", "toolbar", "status"}
_CHROME_WORDS = set("ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline-share comment comments commentlist consent cookie cookies copyright cta disqus feedback flash footer footnav gdpr header heading-nav login masthead menu menus modal nav navbar navigation newsletter notice notices notification outbrain overlay pager pagination paywall popup privacy promo promos promotion reactions recommend recommended recommendations related replies respond search share sharing sidebar signup sitemap skip skiplink social sponsor sponsored subscribe subscription taboola teaser teasers toc-nav toolbar topbar tracking trending warning-bar widget widgets".split())
#: Words that say where or what kind of box a name is for, and nothing about what it holds.
_BOX_WORDS = set("area bar block bottom box btn button buttons container content form inner item items left link links list main outer page panel post posts right row section site slot stack strip top unit wrap wrapper".split())
#: Names by which an id inside an article decides: readers' comments and adverts.
_COMMENT_WORDS = set("ad ads advert adverts advertisement comment comments commentlist disqus replies respond".split())
_TEXT_TAGS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "li", "td", "th", "dt", "dd", "figcaption", "caption"}
_MAIN_WORDS = {"article", "articlebody", "article-body", "article-content", "article-text", "content", "main-content", "maincontent", "entry-content", "post-content", "post-body", "story", "story-body", "post", "entry", "main"}
_CLOSES_P = _BLOCKS - {"body", "html", "head", "title", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}


def _is_chrome(name: str, chrome: set[str], single: bool = False) -> bool:
    """Whether a name is made of chrome words alone, with words for boxes around; ``single``: of one word."""
    words = re.split(r"[-_]+", name)
    if len(words) == 1 or single:
        return name in chrome and name not in ("header", "heading")
    return any(w in chrome for w in words) and all(w in chrome or w in _BOX_WORDS for w in words) and words[-1] not in ("header", "heading")


def _kind(tag: str, attrs: str, in_article: bool) -> str:
    """chrome, main, or nothing particular."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)} if attrs.strip() else {}
    if tag in ("html", "body"):
        return ""
    role = found.get("role", "").lower()
    style = found.get("style", "").replace(" ", "").lower()
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style:
        return "chrome"
    classes, own_id = (unescape(found.get(k, "")).lower().split() for k in ("class", "id"))
    names = classes + own_id
    if in_article:
        # what an article is about may be in its names: a name decides as a whole, and an id by comments and adverts only
        if any(_is_chrome(n, _CHROME_WORDS, tag in _TEXT_TAGS) for n in classes) or tag not in _TEXT_TAGS and any(_is_chrome(n, _COMMENT_WORDS) for n in own_id):
            return "chrome"
    else:
        for name in names:
            words = re.split(r"[-_]+", name)
            if words[0] in ("has", "with", "no", "is", "js"):
                continue
            if tag not in ("main", "h1") and (words[0] in _CHROME_WORDS or words[-1] in _CHROME_WORDS):
                return "chrome"
    if tag in _CHROME_TAGS or role in _CHROME_ROLES or tag == "header" and not in_article:
        return "chrome"
    if tag in ("article", "main") or role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody" or any(n in _MAIN_WORDS for n in names):
        return "main"
    return ""


class _Tags:
    """The marks of a page in turn: (start, end, closing, name, attributes); name is None for comments and the like.

    A tag ends at the first > outside quotes, or, where there is none, at the first one at all. One without any > is cut
    off at the end of the page, and ``end`` is where the text ends. All is found in time proportional to the page: after
    failed looks for unbalanced quotes over four times its length the rest of the tags end at their first >.
    """

    def __init__(self, html: str) -> None:
        self.html, self.end, self.left = html, len(html), 4 * len(html)

    def next(self, at: int) -> tuple[int, int, bool, str | None, str] | None:
        m = _MARK.search(self.html, at)
        if not m:
            return None
        start, inside = m.start(), m.end()
        if m[2] is None:
            close = {"<!--": "-->", "<![CDATA[": "]]>"}.get(m[0], ">")
            end = self.html.find(close, inside)
            if end < 0 and m[0] == "<![CDATA[":
                close, end = ">", self.html.find(">", inside)
            if end < 0:
                self.end = start
                return None
            return start, end + len(close), False, None, ""
        if self.left > 0:
            full = _INSIDE.match(self.html, inside)
            if full:
                return start, full.end(), bool(m[1]), m[2].lower(), self.html[inside : full.end() - 1]
            self.left -= len(self.html) - inside
        end = self.html.find(">", inside)
        if end < 0:
            self.end = start
            return None
        return start, end + 1, bool(m[1]), m[2].lower(), self.html[inside:end]


def blocks(html: str) -> list[tuple[str, str]]:
    """(kind, text) of a page's blocks in order; kind: article, chrome or open, or title: an open first heading."""
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []  # open elements: tag, state
    places: dict[str, list[int]] = defaultdict(list)  # of the open elements, by tag
    blocks_at: list[int] = []  # of those that are blocks
    parts: list[str] = []
    state, at, had_article = "open", 0, False

    def flush() -> None:
        nonlocal had_article
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                out.append(("title" if state == "open" and places["h1"] else state, text))
                had_article = had_article or state == "article"

    def close(depth: int) -> None:
        nonlocal state
        for t, _ in stack[depth:]:
            places[t].pop()
        del stack[depth:]
        while blocks_at and blocks_at[-1] >= depth:
            blocks_at.pop()
        state = stack[-1][1] if stack else "open"

    def last(*names: str) -> int:
        """The innermost open element of these names, or -1."""
        return max((places[t][-1] for t in names if places[t]), default=-1)

    tags = _Tags(html)
    while found := tags.next(at):
        start, end, closing, tag, attrs = found
        if start > at:
            parts.append(unescape(html[at:start]))
        at = end
        if tag is None:
            continue
        if closing:
            depth = last(tag)
            # an inline end tag doesn't reach across a block
            if depth >= 0 and (tag in _BLOCKS or not blocks_at or blocks_at[-1] <= depth):
                if tag in _BLOCKS or blocks_at and blocks_at[-1] >= depth:
                    flush()
                if stack[depth][1] != (stack[depth - 1][1] if depth else "open"):
                    flush()
                close(depth)
            elif tag in _BLOCKS:
                flush()
            continue
        if tag == "br" or tag == "wbr":
            parts.append(" " if tag == "br" else "")
            continue
        if tag in _RAW:
            if not attrs.rstrip().endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                at = stop.end() if stop else len(html)
            continue
        if tag in _BLOCKS:
            flush()
        if tag in _VOID:
            continue
        if tag in _CLOSES_P:
            depth = last("p")
            if depth >= 0 and last("table", "button", "object") <= depth:
                close(depth)
        if tag in ("li", "option", "dd", "dt", "tr", "td", "th") and last(tag) > last("ul", "ol", "menu", "select", "dl", "table"):
            close(last(tag))
        kind = _kind(tag, attrs, state == "article")
        inner = state
        if kind == "chrome":
            inner = "chrome"
        elif kind == "main" and state == "open":
            inner = "article"
        elif tag in ("article", "main") and kind == "main" and state == "chrome" and not had_article and not places["aside"]:
            # an unclosed element before the article doesn't swallow it
            inner = "article"
        if inner != state:
            flush()
        if tag == "body":
            inner = "open"
        places[tag].append(len(stack))
        if tag in _BLOCKS:
            blocks_at.append(len(stack))
        stack.append((tag, inner))
        state = inner
    if at < tags.end:
        parts.append(unescape(html[at : tags.end]))
    flush()
    return out


def unique_runs(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words ``first`` to ``end`` - 1 of each span, and what stands between a removed word and the next."""
    w = Words([text], hashed=False)
    kept, at = [], 0
    for first, end in spans:
        kept.append(w.data[at : w.start[first] if first else 0])
        at = int(w.start[end]) if end < len(w.start) else len(w.data)
    kept.append(w.data[at:])
    parts = (" ".join(x.tobytes().decode("utf-8", "surrogatepass").split()) for x in kept)
    return " ".join(p for p in parts if p)


def repeated_starts(streams: list[np.ndarray], run: int = MIN_RUN, pages: int = MIN_PAGES) -> list[np.ndarray]:
    """For each word of each stream whether the ``run`` words from it on occur on ``pages`` distinct streams.

    The suffixes of the joined streams are sorted by prefix doubling, to a depth of ``run`` words: deeper order doesn't
    change where such runs are. Equal streams are copies of one page and count once.
    """
    distinct: dict[bytes, int] = {}
    which = [distinct.setdefault(s.tobytes(), len(distinct)) for s in streams]
    unique = [np.frombuffer(b, np.uint64) for b in distinct]
    lengths = np.array([len(s) for s in unique], np.int64)
    found: list[np.ndarray] = []
    if lengths.sum():
        _, rank = np.unique(np.concatenate(unique), return_inverse=True)
        rank = rank.astype(np.int64) + 1
        owner = np.repeat(np.arange(len(unique)), lengths)
        left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(rank))  # words to the stream's end
        depth = 1
        while depth < run:
            step = min(depth, run - depth)
            after = np.where(left > step, np.concatenate((rank[step:], np.zeros(min(step, len(rank)), np.int64))), 0)
            order = np.lexsort((after, rank))
            new = np.concatenate(([True], (rank[order][1:] != rank[order][:-1]) | (after[order][1:] != after[order][:-1])))
            rank = np.empty_like(rank)
            rank[order] = np.cumsum(new)
            depth += step
        order = np.lexsort((owner, rank))
        order = order[left[order] >= run]
        first = np.concatenate(([True], (rank[order][1:] != rank[order][:-1]) | (owner[order][1:] != owner[order][:-1]))) if len(order) else np.zeros(0, bool)
        many = np.bincount(rank[order][first], minlength=int(rank.max()) + 1) >= pages
        starts = order[many[rank[order]]]
        begins = np.zeros(len(rank), bool)
        begins[starts] = True
        found = np.split(begins, np.cumsum(lengths)[:-1])
    else:
        found = [np.zeros(0, bool) for _ in unique]
    return [found[w] for w in which]


def covered_by(starts: np.ndarray, n: int, run: int = MIN_RUN) -> np.ndarray:
    """Which of n words lie in a run of ``run`` words from one of the places ``starts``."""
    edge = np.zeros(n + run, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + run, -1)
    return np.cumsum(edge)[:n] > 0


def repeated(streams: list[np.ndarray], run: int = MIN_RUN, pages: int = MIN_PAGES) -> list[np.ndarray]:
    """For each word of each stream whether a run of ``run`` words or more around it occurs on ``pages`` distinct streams."""
    return [covered_by(np.flatnonzero(b), len(b), run) for b in repeated_starts(streams, run, pages)]


def run_hashes(words: np.ndarray, lengths: np.ndarray, hosts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(page, place, hash with the host) of every run of MIN_RUN words of several pages, whose words follow one another."""
    counts = np.maximum(lengths - MIN_RUN + 1, 0)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    first = place + np.repeat(np.cumsum(lengths) - lengths, counts)
    run = np.repeat(hosts.astype(np.int64).view(np.uint64), counts)
    for j in range(MIN_RUN):
        run = mix64(run * _MULT + words[first + j])
    return np.repeat(np.arange(len(lengths)), counts), place, run


def decided(found: list[tuple[str, str]]) -> list[str]:
    """The blocks that may be main text: the article's, or all open ones of a page without an article. First headings outside
    the article belong to it; one that only repeats a heading of the article doesn't."""
    inside = {t for k, t in found if k == "article"}
    return [t for k, t in found if k == "article" or k == "title" and t not in inside] if inside else [t for k, t in found if k in ("open", "title")]


def main_text(texts: list[str], starts: np.ndarray | list[int] = ()) -> tuple[str, int]:
    """The unique runs of the blocks, joined by line feeds, and how many words are removed.

    ``starts``: where boilerplate runs begin, in words through all blocks. If nothing is left, nothing is removed.
    """
    if not len(starts):
        return "\n".join(texts), 0
    words = np.diff(Words(texts, hashed=False).first)
    cover = covered_by(np.asarray(starts, np.int64), int(words.sum()))
    kept = []
    for text, own in zip(texts, np.split(cover, np.cumsum(words)[:-1]), strict=True):
        bounds = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8))).reshape(-1, 2)
        left = unique_runs(text, bounds.tolist()) if len(bounds) else text
        if left:
            kept.append(left)
    return ("\n".join(kept), int(cover.sum())) if kept else ("\n".join(texts), 0)


def _streams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words of each page's chrome and open blocks, and of its open blocks alone, as hashes, each under the scope in
    which such streams meet; those with fewer words than a run have no row."""
    for pdf in batches:
        whole = [" ".join((*c, *o)) for c, o in zip(pdf["chrome"], pdf["open"], strict=True)]
        w = Words([*whole, *(" ".join(o) for o in pdf["open"])])
        scope = np.concatenate((pdf["outside"].to_numpy(np.int64), pdf["inside"].to_numpy(np.int64)))
        n = np.diff(w.first)
        full = np.flatnonzero(n >= MIN_RUN)
        stream = [w.hash[w.first[i] : w.first[i + 1]].tobytes() for i in full]
        yield pd.DataFrame({"scope": scope[full], "stream": pd.Series(stream, dtype=object), "n": n[full].astype(np.int64)})


def _sorted_runs(pdf: pd.DataFrame) -> pd.DataFrame:
    """The boilerplate runs of a scope, by the suffix array of its pages."""
    streams = [np.frombuffer(s, np.uint64) for s in pdf["stream"]]
    lengths = np.array([len(s) for s in streams], np.int64)
    _, _, run = run_hashes(np.concatenate(streams), lengths, pdf["scope"].to_numpy())
    begins = np.concatenate([b[: len(b) - MIN_RUN + 1] for b in repeated_starts(streams)])
    return pd.DataFrame({"run": np.unique(run[begins]).view(np.int64)})


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every run of MIN_RUN words: its hash with the scope, and the digest of its page's stream."""
    for pdf in batches:
        lengths = np.array([len(s) // 8 for s in pdf["stream"]], np.int64)
        page, _, run = run_hashes(np.frombuffer(b"".join(pdf["stream"]), np.uint64), lengths, pdf["scope"].to_numpy())
        yield pd.DataFrame({"digest": pdf["digest"].to_numpy(np.int64)[page], "run": run.view(np.int64)})


def boilerplate(pages: DataFrame) -> DataFrame:
    """run: the hash of each run of words of ``pages`` (chrome, open, outside, inside) that stands on several distinct pages of a scope."""
    streams = cut(pages.select("chrome", "open", "outside", "inside").mapInPandas(_streams, "scope long, stream binary, n long"))
    sizes = streams.groupBy("scope").agg(F.sum("n").alias("total"))
    # one host for each SHARD_WORDS words of all pages at most; sent to all tasks if Spark finds the table small
    large = cut(sizes.filter(F.col("total") > SHARD_WORDS).select("scope"))
    found = streams.join(large, "scope", "left_anti").groupBy("scope").applyInPandas(_sorted_runs, "run long")
    if not large.isEmpty():
        runs = streams.join(large, "scope", "left_semi").withColumn("digest", F.xxhash64("stream")).mapInPandas(_runs, "digest long, run long")
        often = runs.groupBy("run").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).filter("low < high")
        found = found.unionByName(often.select("run"))
    return cut(found)


def _probed(shared):
    """Where the runs of the pages' decided blocks pass the sieve of boilerplate runs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            w = Words([" ".join(x) for x in pdf["texts"]])
            page, place, run = run_hashes(w.hash, np.diff(w.first), pdf["scope"].to_numpy())
            hit = hits(shared.value, run)
            yield pd.DataFrame({"key": pdf["key"].to_numpy(np.int64)[page[hit]], "at": place[hit].astype(np.int32), "run": run[hit].view(np.int64)})

    return run


@F.pandas_udf(StructType([StructField("texts", ArrayType(StringType())), StructField("chrome", ArrayType(StringType())), StructField("open", ArrayType(StringType())), StructField("article", BooleanType())]))
def _parsed(html: pd.Series) -> pd.DataFrame:
    found = [blocks(h) for h in html]
    kinds = {kind: pd.Series([[t for k, t in f if k == kind or kind == "open" and k == "title"] for f in found], dtype=object) for kind in ("chrome", "open")}
    article = pd.Series([any(k == "article" for k, _ in f) for f in found], dtype=bool)
    return pd.DataFrame({"texts": pd.Series([decided(f) for f in found], dtype=object), **kinds, "article": article})


@F.pandas_udf(StructType([StructField("text", StringType()), StructField("n", LongType())]))
def _cleaned(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([main_text(list(t), () if s is None else s) for t, s in zip(texts, starts, strict=True)], columns=["text", "n"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points), n_boilerplate (words of the main text's blocks removed): a row for each page.

    Null html is empty and gives an empty text, as do pages of chrome alone. Repeated rows give a row each and count as
    one page in the host's suffix array; a null url belongs to the empty host. Other columns are ignored.

    Each page is parsed once; its blocks are written to the shared folder. Only pages that hold a boilerplate run in their
    main text are moved to meet their runs.
    """
    spark = pages.sparkSession
    small_batches(spark, 200)
    host, _ = host_path(F.col("url").cast("string"))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), host.alias("host"), _parsed(F.coalesce(F.col("html").cast("string"), F.lit(""))).alias("found"))
    # where runs count for open blocks, and where they do for articles
    scopes = F.xxhash64("host", F.lit(0)).alias("outside"), F.xxhash64("host", F.lit(1)).alias("inside")
    parsed = with_rows(rows.select("page_id", "url", *scopes, "found.texts", "found.chrome", "found.open", "found.article"), "key")
    often = boilerplate(parsed)
    runs = spark.sparkContext.broadcast(bits_of(often, F.col("run")))
    places = parsed.select("key", F.when(F.col("article"), F.col("inside")).otherwise(F.col("outside")).alias("scope"), "texts").mapInPandas(_probed(runs), "key long, at int, run long")
    starts = cut(places.join(often, "run", "left_semi").groupBy("key").agg(F.collect_list("at").alias("starts")))
    sieve = spark.sparkContext.broadcast(bits_of(starts, F.xxhash64("key")))

    @F.pandas_udf(BooleanType())
    def touched(keys: pd.Series) -> pd.Series:
        passed = np.zeros(len(keys), bool)
        passed[hits(sieve.value, np.array([xxhash.xxh64_intdigest(struct.pack("<q", k), 42) for k in keys], np.uint64))] = True
        return pd.Series(passed)

    marked = parsed.withColumn("touched", touched("key"))
    whole = marked.filter("not touched").select("page_id", "url", F.array_join("texts", "\n").alias("text"), F.lit(0).cast("long").alias("n_boilerplate"))
    cleaned = marked.filter("touched").join(starts, "key", "left").select("page_id", "url", _cleaned("texts", "starts").alias("c"))
    out = whole.unionByName(cleaned.select("page_id", "url", F.col("c.text").alias("text"), F.col("c.n").alias("n_boilerplate")))
    return out.select(F.col("page_id").cast("long").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"), "n_boilerplate")
