"""Main text of web pages: page structure plus a suffix array per host.

A page is read into blocks (text between block-level tags, character references
decoded, white space collapsed), each in one of three zones: inside the article,
in marked chrome (menus, headers, footers, sidebars, notices, adverts, forms,
comments, hidden parts), or open. Scripts, styles and the head give no blocks.
Inside an article, what readers wrote and names that are chrome as a whole are chrome; a
box (no section, heading or paragraph) named by one chrome word is, unless it holds prose (a block of ``PROSE_WORDS``
words, few of them links); where a name merely holds such a word, the block goes only
if it is host boilerplate. Of several articles, those under ``SIBLING_SHARE`` of the
longest one's text are teasers.

The token streams of a host's pages outside their articles are concatenated and
their suffixes sorted by prefix doubling; a run of ``REPEAT_TOKENS`` tokens or more
is host boilerplate when it stands on ``REPEAT_SHARE`` of the host's distinct pages, and
on ``REPEAT_PAGES`` at least. Pages of one token stream, article included, are one page
here, so copies never make each other boilerplate. Suffixes only
need sorting by their first ``REPEAT_TOKENS`` tokens: every longer repeat is a chain
of such windows. From the open blocks the boilerplate runs are cut, the unique runs
before, between and after them stay.

Why the zones: an article's sentences may repeat on other pages (quotations,
licences, copies of the page), and one-page adverts repeat nowhere, so repetition
alone would cut the first and keep the second. Where a page declares its article,
its blocks are the text; where it does not, what the suffix array leaves of the
open blocks is. So the array decides no text of a page that declares its article.

Hot hosts. Pages of a host go to parts of about ``PART_BYTES`` of HTML, each one
task's suffix array. For hosts of several parts, the windows (hashes) are counted over
all parts first, by distinct page, and each part gets those that count as boilerplate,
so the outcome does not depend on the cut.

Defined results: null or empty pages have empty text; pages without a host form one
host; rows that repeat a page count as that page once, and all get its text.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import ship_package, slices, staged
from tierline.llm.url_reputation import url_host

REPEAT_TOKENS = 6
REPEAT_PAGES = 3
REPEAT_SHARE = 0.5
PART_BYTES = 8 << 20
#: Most hosts of several parts (some 50 bytes each) that are broadcast; beyond it the join shuffles.
BROADCAST_HOSTS = 500_000
ARTICLE, OPEN, CHROME, LAYOUT, DOUBT, NAMED = 0, 1, 2, 3, 4, 5
#: A block that is prose: words, and the share of its characters that may be in links.
PROSE_WORDS = 40
PROSE_LINKS = 1 / 3
#: Articles beside the longest one that have less than this share of its text are teasers.
SIBLING_SHARE = 0.5

# Skipped elements end at their end tag; without one, where the page's structure goes on.
_EDGE = r"</?(?:article|main|head|body|html)(?=[\s/>])"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg(?=[\s/])(?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+(?<=/)>"
    r"|<(?P<raw>script|style|noscript|template|textarea|title)(?=[\s/>])[^>]*+>"
    rf"(?:.*?</(?P=raw)\s*>|.*?(?={_EDGE}|\Z))"
    r"|<(?P<box>svg|iframe|object|select|button)(?=[\s/>])[^>]*+>"
    rf"(?:(?:[^<]++|<(?!{_EDGE[1:]}))*?</(?P=box)\s*>|.*?(?={_EDGE}|</(?:p|div|section|li|td|th|form|nav|header|footer|aside|ul|ol|table)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*+)(?P<attrs>(?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+)>"
    r"|<[/!?A-Za-z][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([A-Za-z][A-Za-z0-9_:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")

# Element and class names: fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
CHROME_TAGS = frozenset("head nav footer aside form menu dialog header".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr"
    " notice notices alert popup modal newsletter subscribe subscription signup login sidebar nav navbar navigation menu"
    " breadcrumb breadcrumbs footer header masthead topbar comment comments disqus respond reply replies discussion share sharing"
    " social related recommended pagination pager widget toolbar copyright disclaimer".split()
)
HEADER_NAMES = frozenset(("header",))
ARTICLE_PARTS = frozenset("section h1 h2 h3 h4 h5 h6 p figure blockquote".split())
READER_WORDS = frozenset("comment comments reply replies respond disqus".split())
#: Chrome words that also name the layout around an article, as in ``has-sidebar``.
LAYOUT_WORDS = frozenset("sidebar nav navbar navigation menu header footer widget banner ad ads topbar".split())
#: Inside an article: names that are chrome by themselves, and what may stand beside a chrome word in one name.
ARTICLE_CHROME = frozenset(
    "ad ads advert adverts advertisement advertising sponsored cookies gdpr popup modal newsletter subscribe signup login sidebar"
    " nav navbar breadcrumb breadcrumbs masthead topbar comments disqus pagination pager".split()
)
BESIDE_CHROME = frozenset(
    "area bar block box button buttons container content form icons inner item items link links list module outer panel posts"
    " section slot unit wrap wrapper".split()
)


def _article_zone(names: str, tag: str) -> int:
    """Zone of an element inside an article by its class and id: each name counts as a whole.

    What readers wrote is chrome, and so are names of chrome alone. A block element named by
    one chrome word is judged by its text (``NAMED``); names that merely hold such a
    word stay in doubt, as do the article's own parts (sections, headings, paragraphs).
    """
    zone = ARTICLE
    box = tag not in INLINE and tag not in ARTICLE_PARTS
    for name in names.split():
        parts = set(re.split(r"[^a-z0-9]+", name)) - {""}
        words = parts & CHROME_WORDS
        core = {p for p in parts if not p.isdigit()}
        if box and core & READER_WORDS and core <= READER_WORDS | BESIDE_CHROME:
            return CHROME
        if box and len(core) == 1 and words - HEADER_NAMES:
            zone = NAMED
            continue
        if name in ARTICLE_CHROME or len(parts) > 1 and words - HEADER_NAMES and parts <= CHROME_WORDS | BESIDE_CHROME:
            return CHROME
        if words - HEADER_NAMES and zone != NAMED and tag not in INLINE:  # words inside a paragraph are the paragraph's
            zone = DOUBT
    return zone


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)}


def _zone_of(tag: str, raw: str, zone: int, in_article: bool) -> tuple[int, bool]:
    """(zone, in_article) inside an element."""
    if zone == CHROME:
        return zone, in_article
    if tag in CHROME_TAGS and not (in_article and tag in HEADER_NAMES):
        return CHROME, in_article
    found = _attributes(raw) if raw and not raw.isspace() else {}
    names = f"{found.get('class', '')} {found.get('id', '')}".lower()
    words = set(re.split(r"[^a-z0-9]+", names)) & CHROME_WORDS
    role = found.get("role", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true"
    if role in CHROME_ROLES or hidden or re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
        return CHROME, in_article
    if in_article:  # an article's own header holds its heading
        named = _article_zone(names, tag) if words else ARTICLE
        return (zone if named == ARTICLE else named), True
    if words and tag not in ("body", "html", "main"):
        return (LAYOUT if words <= LAYOUT_WORDS else CHROME), in_article
    if tag in ("article", "main") or role in ("article", "main") or found.get("itemprop") == "articleBody":
        return ARTICLE, True  # also where only the names of the layout around it are chrome's
    return zone, in_article


def blocks_of(page: str | None) -> list[tuple[int, str]]:
    """(zone, text) of the page's blocks in order; an article inside ``main`` makes the rest of ``main`` open."""
    if not page:
        return []
    out: list[_Block] = []
    text: list[str] = []
    stack: list[tuple[str, int, bool, int, int]] = []  # tag and what holds outside it
    zone, in_article, real, mark = OPEN, False, 0, 0
    anchors, linked, marks, articles = 0, 0, 0, 0
    at = 0

    def flush() -> None:
        nonlocal linked
        if text:
            words = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if words:
                out.append(_Block(zone, words, real, mark, linked))
            text.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal zone, in_article, real, mark, anchors
        _, zone, in_article, real, mark = stack[depth]
        anchors -= sum(s[0] == "a" for s in stack[depth:])
        del stack[depth:]

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text.append(page[at : m.start()])
            linked += (m.start() - at) * (anchors > 0)
        at = m.end()
        tag = m.group("tag")
        if tag is None:
            continue
        tag = tag.lower()
        block = tag not in INLINE and tag != "br"
        if tag == "br":
            text.append(" ")
            continue
        if block:
            flush()
        if m.group("end"):
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    if zone != stack[depth][1]:
                        flush()
                    close(depth)
                    break
                if tag in INLINE and stack[depth][0] not in INLINE:
                    break
            continue
        if tag in VOID or m.group("attrs").endswith("/") and tag in ("svg", "path"):
            continue
        if block and tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option") or block and any(s[0] == "p" for s in stack[-3:]):
            # a block ends an open paragraph, an item ends the item before it
            for depth in range(len(stack) - 1, -1, -1):
                name = stack[depth][0]
                if name == "p" or name == tag and tag != "p":
                    close(depth)
                    break
                if name not in INLINE:
                    break
        inner, inside = _zone_of(tag, m.group("attrs"), zone, in_article)
        if inner != zone:
            flush()
        stack.append((tag, zone, in_article, real, mark))
        anchors += tag == "a"
        if tag == "article" and not real:
            articles += 1
            real = articles
        if inner == NAMED and zone != NAMED:
            marks += 1
            mark = marks
        zone, in_article = inner, inside
    text.append(page[at:])
    flush()
    return _judged(out)


class _Block(NamedTuple):
    zone: int
    text: str
    article: int  # number of the outermost article element around it, or 0
    mark: int  # number of the element in NAMED zone around it, or 0
    linked: int  # characters in links

    def is_prose(self) -> bool:
        return len(self.text.split()) >= PROSE_WORDS and self.linked < PROSE_LINKS * len(self.text)


def _judged(blocks: list[_Block]) -> list[tuple[int, str]]:
    """(zone, text): elements named by one chrome word are the article's where they hold prose; of several articles
    the short ones are teasers; an article inside ``main`` makes the rest of ``main`` open."""
    prose = {b.mark for b in blocks if b.zone == NAMED and b.is_prose()}
    blocks = [b._replace(zone=ARTICLE if b.mark in prose else CHROME) if b.zone == NAMED else b for b in blocks]
    sizes: dict[int, int] = {}
    for b in blocks:
        if b.article and b.zone in (ARTICLE, DOUBT):
            sizes[b.article] = sizes.get(b.article, 0) + len(b.text)
    least = SIBLING_SHARE * max(sizes.values(), default=0)
    out = []
    for b in blocks:
        zone = CHROME if b.zone == LAYOUT else b.zone
        if zone in (ARTICLE, DOUBT) and sizes:
            zone = OPEN if not b.article else CHROME if sizes[b.article] < least else zone
        out.append((zone, b.text))
    return out


# ---------------------------------------------------------------- suffix arrays


def window_hashes(tokens: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` tokens (64-bit hashes) from each position that has as many after it."""
    if len(tokens) < length:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(tokens) - length + 1, dtype=np.uint64)
    for j in range(length):
        out = out * np.uint64(0x9E3779B97F4A7C15) + tokens[j : len(tokens) - length + 1 + j]
    return out ^ (out >> np.uint64(29))


def sorted_suffixes(tokens: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array by the first ``length`` tokens, rank of each suffix) by prefix doubling."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    have, n = 1, len(tokens)
    while have < length:
        step = min(have, length - have)
        later = np.zeros(n, dtype=np.int64)
        later[: max(0, n - step)] = rank[step:] + 1
        rank = np.unique(rank * (n + 2) + later, return_inverse=True)[1].astype(np.int64)
        have += step
    return np.argsort(rank, kind="stable"), rank


def repeated_starts(tokens: np.ndarray, page: np.ndarray, length: int = REPEAT_TOKENS, pages: int = REPEAT_PAGES) -> np.ndarray:
    """Positions whose next ``length`` tokens, all on one page, also stand on other pages (``pages`` in all)."""
    n = len(tokens)
    mark = np.zeros(n, dtype=bool)
    if n < length:
        return mark
    order, rank = sorted_suffixes(tokens, length)
    whole = np.zeros(n, dtype=bool)
    whole[: n - length + 1] = page[: n - length + 1] == page[length - 1 :]
    order = order[whole[order]]
    if not order.size:
        return mark
    group, owner = rank[order], page[order]
    # within a group of equal windows, positions and so pages ascend: count page changes
    new_group = np.concatenate([[True], group[1:] != group[:-1]])
    new_page = new_group | np.concatenate([[True], owner[1:] != owner[:-1]])
    number = np.cumsum(new_group) - 1
    distinct = np.bincount(number, weights=new_page)
    mark[order[distinct[number] >= pages]] = True
    return mark


def covered(starts: np.ndarray, length: int = REPEAT_TOKENS) -> np.ndarray:
    """Positions that lie in a marked window."""
    change = np.zeros(len(starts) + length, dtype=np.int64)
    at = np.flatnonzero(starts)
    np.add.at(change, at, 1)
    np.add.at(change, at + length, -1)
    return np.cumsum(change)[: len(starts)] > 0


def _stream(pages: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hash, page number, block number) of the pages' blocks, concatenated."""
    known: dict[str, int] = {}
    tokens, page, block = [], [], []
    number = 0
    for i, blocks in enumerate(pages):
        for words in blocks:
            for word in words.split():
                value = known.get(word)
                if value is None:
                    value = known[word] = xxhash.xxh64_intdigest(word)
                tokens.append(value)
                page.append(i)
                block.append(number)
            number += 1
    return np.array(tokens, dtype=np.uint64), np.array(page, dtype=np.int64), np.array(block, dtype=np.int64)


def _page_windows(tokens: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window hash, start) of every window that lies on one page."""
    hashes = window_hashes(tokens, REPEAT_TOKENS)
    at = np.flatnonzero(page[: len(hashes)] == page[REPEAT_TOKENS - 1 :][: len(hashes)]) if len(hashes) else np.zeros(0, np.int64)
    return hashes[at], at


def page_vote(found: list[tuple[int, str]]) -> int | None:
    """Hash (signed) of a page's tokens, those of the article apart; None without any."""
    if not found:
        return None
    inside, outside = (" ".join(t for z, t in found if (z == ARTICLE) == of) for of in (True, False))
    return xxhash.xxh64_intdigest(f"{inside}\0{outside}") - (1 << 63)


def pages_needed(distinct: int) -> int:
    """Distinct pages of a host on which a run must stand to be boilerplate."""
    return max(REPEAT_PAGES, math.ceil(distinct * REPEAT_SHARE))


def repeated_windows(pages: list[list[str]], votes: list[int | None]) -> np.ndarray:
    """Hashes of the windows that are boilerplate by the suffix array of the pages, one page a vote."""
    once = {v: blocks for v, blocks in zip(votes, pages, strict=True) if v is not None}
    tokens, page, _ = _stream(list(once.values()))
    starts = repeated_starts(tokens, page, pages=pages_needed(len(once)))
    return np.unique(window_hashes(tokens, REPEAT_TOKENS)[np.flatnonzero(starts)])


def unique_runs(pages: list[list[str]], repeated: np.ndarray) -> list[list[tuple[str, bool]]]:
    """For each page's blocks, the text outside boilerplate and whether any was cut; ``repeated``: its window hashes.

    A block whose every token is covered goes; of others the runs that repeat
    inside the block are cut, so a repeat that reaches in from a neighbour takes nothing.
    """
    tokens, page, block = _stream(pages)
    starts = np.zeros(len(tokens), dtype=bool)
    if repeated.size:
        hashes, at = _page_windows(tokens, page)
        starts[at[np.isin(hashes, repeated)]] = True
    total = sum(map(len, pages))
    last = np.minimum(np.arange(len(tokens)) + REPEAT_TOKENS - 1, len(tokens) - 1)
    inside = covered(starts & (block == block[last]))
    size = np.bincount(block, minlength=total)
    whole = (size > 0) & (np.bincount(block, weights=covered(starts), minlength=total) == size)
    some = np.bincount(block, weights=inside, minlength=total) > 0
    first = np.cumsum(size) - size
    out, number = [], 0
    for blocks in pages:
        kept = []
        for text in blocks:
            if whole[number]:
                text = ""
            elif some[number]:
                lo = first[number]
                text = " ".join(w for w, cut in zip(text.split(), inside[lo : lo + size[number]].tolist(), strict=True) if not cut)
            kept.append((text, bool(whole[number] or some[number])))
            number += 1
        out.append(kept)
    return out


# ---------------------------------------------------------------- Spark


def article_parts(found: list[tuple[int, str]]) -> list[str | None] | None:
    """The declared article's text, with None in the place of each doubtful block; None where none is declared."""
    if not any(z in (ARTICLE, DOUBT) for z, _ in found):
        return None
    parts: list[str | None] = []
    for zone, text in found:
        if zone == DOUBT:
            parts.append(None)
        elif zone == ARTICLE and parts and parts[-1] is not None:
            parts[-1] += "\n" + text
        elif zone == ARTICLE:
            parts.append(text)
    return parts


def _parsed(pages: DataFrame, schema: T.StructType, outside_only: bool) -> DataFrame:
    """Blocks of each page: (..., article parts or null, other blocks, their zones, the page's vote)."""
    kept = schema.names[:-4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                articles, texts, zones, votes = [], [], [], []
                for page in part.column("__html").to_pylist():
                    found = blocks_of(page)
                    articles.append(None if outside_only else article_parts(found))
                    texts.append([t for z, t in found if z != ARTICLE])
                    zones.append([z for z, _ in found if z != ARTICLE])
                    votes.append(page_vote(found))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept]
                    + [pa.array(articles, pa.list_(pa.string())), pa.array(texts, pa.list_(pa.string())), pa.array(zones, pa.list_(pa.int8())), pa.array(votes, pa.int64())],
                    names=schema.names,
                )

    return pages.mapInArrow(run, schema)


def extract_text(df: DataFrame, page: str = "page_id", url: str = "url", html_column: str = "html") -> DataFrame:
    """(page, url, text, n_chars, n_repeated) of every row.

    ``text`` joins the kept blocks with newlines; ``n_repeated`` counts the blocks
    outside the article in which the host's suffix array found boilerplate.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = df.select(
        F.col(page).alias("__page"), F.col(url).alias("__url"), url_host(F.col(url)).alias("__host"),
        F.col(html_column).alias("__html"),
    )
    # only hosts of several parts, at most one per PART_BYTES of input; the others have one part
    size = F.sum(F.octet_length(F.coalesce("__html", F.lit(""))).cast("long"))
    large = rows.groupBy(F.col("__host").alias("__h")).agg((F.floor(size / PART_BYTES) + 1).cast("int").alias("__parts"))
    large = staged(large.filter(F.col("__parts") > 1), "large-hosts")
    if large.count() <= BROADCAST_HOSTS:
        large = F.broadcast(large)
    rows = rows.join(large, F.col("__host") == F.col("__h"), "left").drop("__h").fillna(1, ["__parts"])
    # by content too: a page delivered often with other content each time is spread like other pages
    spread = F.pmod(F.xxhash64("__page", "__url", "__html"), F.col("__parts")).cast("int")
    rows = rows.withColumn("__part", spread)

    head = [T.StructField("__host", T.StringType()), T.StructField("__part", T.IntegerType())]
    tail = [
        T.StructField("__article", T.ArrayType(T.StringType())),
        T.StructField("__texts", T.ArrayType(T.StringType())),
        T.StructField("__zones", T.ArrayType(T.ByteType())),
        T.StructField("__vote", T.LongType()),
    ]
    page_fields = [T.StructField("__page", df.schema[page].dataType), T.StructField("__url", df.schema[url].dataType)]

    # hosts of several parts: windows by the distinct pages they stand on; a null window counts the host's pages
    several = rows.filter(F.col("__parts") > 1).select("__host", "__html")
    streams = _parsed(several, T.StructType(head[:1] + tail), outside_only=True).select("__host", "__texts", "__vote")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                for host, texts, vote in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if vote is None:
                        continue
                    tokens, number, _ = _stream([texts])
                    some = [None, *np.unique(_page_windows(tokens, number)[0]).view(np.int64).tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([host] * len(some), pa.string()), pa.array(some, pa.int64()), pa.array([vote] * len(some), pa.int64())],
                        names=["__host", "__window", "__vote"],
                    )

    found = streams.mapInArrow(windows, "__host string, __window long, __vote long")
    found = found.groupBy("__host", "__window").agg(F.countDistinct("__vote").alias("__on"))
    found = staged(found.filter(F.col("__window").isNull() | (F.col("__on") >= REPEAT_PAGES)), "windows")
    hosts = found.filter(F.col("__window").isNull()).select("__host", F.col("__on").alias("__pages"))
    needed = F.greatest(F.lit(REPEAT_PAGES), F.ceil(F.col("__pages") * REPEAT_SHARE))
    shared = (
        found.filter(F.col("__window").isNotNull()).join(hosts, "__host").filter(F.col("__on") >= needed)
        .groupBy("__host").agg(F.collect_list("__window").alias("__windows"))
        .join(large, F.col("__host") == F.col("__h"), "right")
        .select(
            F.col("__h").alias("__host"), F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)).alias("__part"),
            F.coalesce("__windows", F.array().cast("array<long>")).alias("__windows"),
        )
    )

    body = _parsed(
        rows.select("__host", "__part", "__page", "__url", "__html"), T.StructType(head + page_fields + tail), outside_only=False
    ).withColumn("__windows", F.lit(None).cast("array<long>"))
    extra = shared.select(
        "__host", "__part",
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in page_fields + tail),
        "__windows",
    )
    schema = T.StructType(
        [T.StructField(page, page_fields[0].dataType), T.StructField(url, page_fields[1].dataType)]
        + [T.StructField("text", T.StringType()), T.StructField("n_repeated", T.LongType())]
    )

    def clean(table: pa.Table) -> pa.Table:
        lists = [w for w in table.column("__windows").to_pylist() if w is not None]
        table = table.filter(pa.compute.is_null(table.column("__windows")))
        texts, zones = table.column("__texts").to_pylist(), table.column("__zones").to_pylist()
        if lists:  # a host of several parts
            repeated = np.array(lists[0], dtype=np.int64).view(np.uint64)
        else:
            repeated = repeated_windows(texts, table.column("__vote").to_pylist())
        runs = unique_runs(texts, repeated)
        out = []
        for article, left, zone, blocks in zip(table.column("__article").to_pylist(), runs, zones, texts, strict=True):
            if article is None:
                article = [t for (t, _), z in zip(left, zone, strict=True) if z != CHROME]
            elif None in article:  # a doubtful block stays whole unless boilerplate covers all of it
                doubtful = iter([b if t else "" for (t, _), z, b in zip(left, zone, blocks, strict=True) if z == DOUBT])
                article = [next(doubtful) if t is None else t for t in article]
            out.append("\n".join(t for t in article if t))
        return pa.Table.from_arrays(
            [table.column("__page"), table.column("__url"), pa.array(out, pa.string()), pa.array([sum(r for _, r in left) for left in runs], pa.int64())],
            names=schema.names,
        )

    done = body.unionByName(extra).groupBy("__host", "__part").applyInArrow(clean, schema)
    return done.select(page, url, "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")
