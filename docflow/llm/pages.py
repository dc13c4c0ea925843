"""Main text of web pages: blocks, without the runs that a host's suffix arrays find on its pages.

A page is read as blocks. Elements that are no content by their tag or name (menus, footers, forms, adverts,
comments, ...) are skipped; if the page marks its article or main part, the blocks in it are its text.

The token streams of a host's pages, of marked ones and of the others by themselves, are concatenated and their suffixes
sorted; that gives each run of ``RUN`` tokens and the number of distinct pages that have it.

On pages without marks a run that ``PAGES`` pages have is boilerplate, and the tokens it covers are removed. What is
unique stays. A page that is covered whole (a copy of an article) stays whole.

In a marked article a run is the host's own if one in ``SHARE`` of its marked pages have it, ``SITE_PAGES`` at least: a
notice that stands on most pages of a site without a telling name. Blocks that such runs cover whole are removed, unless
that were half of the article or more (copies of an article); all other passages stay, also if other pages repeat them.

Hosts are dealt out in shards of pages; the numbers of the shards are added up, so a run counts the same however its
host was split. A shard of a split host names the runs of marked pages that one in ``LOCAL`` of its pages have: shards
are dealt by a hash, and what half of the host's pages have is not that rare on any of them.

Null html counts as empty: no text. Rows are pages of their own, also when ids repeat or are null; a page without a
readable host belongs to the empty host. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import small, written

RUN = 8  # tokens a repeated run has at least
PAGES = 3  # distinct pages without marks that must have it
SHARE, SITE_PAGES = 2, 6  # of a host's marked pages one in so many must have it, and so many at least
SHARD = 512  # pages of a host that one suffix array covers, about
LOCAL = 8  # a shard of a split host names the runs that one in so many of its marked pages have
SITE_ROWS = 200_000  # runs of all hosts that are broadcast
FOUND = "host string, marked boolean, window binary, pages long, key long, page_id long, url string, blocks array<string>"
STREAM = "host string, marked boolean, shard int, shards int, key long, page_id long, url string, blocks array<string>"

# A comment, a tag, or a declaration; a "<" before anything else is text.
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(?:[!?]|/(?![a-zA-Z]))[^>]*>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?:!important\s*)?(?:;|$)", re.I)
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}
SKIPPED = {"nav", "footer", "aside", "form", "button", "select", "template", "svg", "canvas", "dialog", "menu", "head",
           "object", "audio", "video", "map"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
BLOCK = {"address", "article", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "ol", "p",
         "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul", "caption"}
SPACED = {"br", "td", "th"}
# Roles, and class and id names, of elements that are no content. A name counts as a whole: one of FURNITURE, alone or with
# words that say where it stands or what shape it has ("site-footer", "cookie-notice", "ad-box-2"); "related-work" is a name of its own.
ROLES = {"navigation", "banner", "complementary", "contentinfo", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
FURNITURE = (r"(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|"
             r"comments?|disqus|respond|replies|reply|sidebar|side|widgets?|menu|navbar|nav|navigation|breadcrumbs?|pagination|pager|footer|"
             r"masthead|topbar|toolbar|share|sharing|social|newsletter|subscribe|signup|login|related|recommended|contentinfo|complementary|search)")
PLACE = r"(?:site|main|page|post|article|global|user|reader|left|right|top|bottom|primary|secondary|google)"
SHAPE = (r"(?:box|bar|wrap|wrapper|container|section|area|list|block|unit|slot|inner|outer|links?|form|message|buttons?|icons?|thread|"
         r"posts|articles|stories|items|left|right|top|bottom|\d+)")
NO_CONTENT = re.compile(rf"(?:{PLACE}[_-]+)*{FURNITURE}\d*(?:[_-]+(?:{FURNITURE}|{SHAPE}))*", re.I)
# Elements whose end tag may be left out: what a start tag ends, up to the next element that bounds it.
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
IN_HEAD = {"title", "meta", "link", "base", "style", "script", "noscript", "template"}
SCOPE = {"table", "td", "th", "caption", "object", "template", "marquee", "applet"}
SPECIAL = BLOCK | SKIPPED | SCOPE
CELLS, TABLE = {"td", "th"}, {"table", "template"}
GROUPS = {"tbody", "thead", "tfoot"}
P_ENDERS = HEADINGS | {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset",
                       "figcaption", "figure", "footer", "form", "header", "hgroup", "hr", "li", "dd", "dt", "main", "menu", "nav",
                       "ol", "p", "pre", "search", "section", "summary", "table", "ul"}
IMPLIED = {
    "li": ({"li"}, SPECIAL - {"address", "div", "p"}), "dt": ({"dt", "dd"}, SPECIAL - {"address", "div", "p"}),
    "td": (CELLS, TABLE | {"tr"}), "tr": (CELLS | {"tr", "caption", "colgroup"}, TABLE | GROUPS),
    "tbody": (CELLS | GROUPS | {"tr", "caption", "colgroup"}, TABLE), "option": ({"option"}, SPECIAL | {"optgroup"}),
    "optgroup": ({"option", "optgroup"}, SPECIAL), "rt": ({"rt", "rp"}, SPECIAL | {"ruby"})}
IMPLIED |= {"dd": IMPLIED["dt"], "th": IMPLIED["td"], "thead": IMPLIED["tbody"], "tfoot": IMPLIED["tbody"], "rp": IMPLIED["rt"]}
# How far out an end tag reaches for its element; other blocks are bounded by SCOPE, inline elements by any block.
REACH = {"p": SCOPE | {"button"}, "li": SCOPE | {"ol", "ul"}, "table": {"template"}} | dict.fromkeys(CELLS | GROUPS | {"tr", "caption"}, TABLE)
RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}
BODY, MAIN, ARTICLE = 0, 1, 2


class OpenElements:
    """The names of a page's open elements, outermost first, ended as HTML does when end tags are left out."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.held: Counter[str] = Counter()

    def push(self, name: str) -> None:
        self.names.append(name)
        self.held[name] += 1

    def cut(self, at: int) -> None:
        while len(self.names) > at:
            self.held[self.names.pop()] -= 1

    def _close(self, ended: set[str], border: set[str], all_of: bool) -> None:
        if not any(self.held[name] for name in ended):
            return
        at = len(self.names)
        for i in range(len(self.names) - 1, -1, -1):
            if self.names[i] in ended:
                at = i
                if not all_of:
                    break
            elif self.names[i] in border:
                break
        self.cut(at)

    def start(self, name: str) -> None:
        """Ends what the start tag of ``name`` ends."""
        top = self.names[-1] if self.names else ""
        if top == "head" and name not in IN_HEAD or top in HEADINGS and name in HEADINGS:
            self.cut(len(self.names) - 1)
        if name in P_ENDERS:
            self._close({"p"}, REACH["p"], False)
        if name in IMPLIED:
            self._close(*IMPLIED[name], True)

    def end(self, name: str) -> None:
        """Ends the element that the end tag of ``name`` names, and all within it; nothing if there is none."""
        self._close(HEADINGS if name in HEADINGS else {name}, REACH.get(name, SCOPE if name in SPECIAL else SPECIAL), False)


def no_content(rest: str) -> bool:
    """Whether the attributes ``rest`` of an element say that it is not seen or no content."""
    found: dict[str, str] = {}
    for key, value in ATTRIBUTE.findall(rest):
        found.setdefault(key.lower(), entities.unescape(value[1:-1] if value[:1] in ("'", '"') else value))
    if found.get("hidden", "false").lower() not in ("false", "until-found") or UNSEEN.search(found.get("style", "")):
        return True
    names = [*found.get("class", "").split(), *found.get("id", "").split()]
    return found.get("role", "").strip().lower() in ROLES or any(NO_CONTENT.fullmatch(x) for x in names)


def _chosen(texts: list[tuple[bool, bool, str]]) -> tuple[int, list[str]]:
    """The texts of the articles, of the main part where most of it is outside articles, or all if there is neither.

    Main holds its articles too, in order; articles outside it that are longer than all of it go before it.
    """
    size = Counter()
    for in_article, in_main, text in texts:
        size[in_article, in_main] += len(text)
    if size[False, True] > size[True, True] and size[False, True] + size[True, True] >= size[True, False]:
        return MAIN, [t for _, in_main, t in texts if in_main]
    if size[True, True] + size[True, False]:
        return ARTICLE, [t for in_article, _, t in texts if in_article]
    return BODY, [t for *_, t in texts]


def blocks(html: str) -> tuple[int, list[str]]:
    """The mark of content that decides on the page (article, main or none) and the texts of the blocks it holds."""
    found: list[tuple[bool, bool, str]] = []
    text: list[str] = []
    open_marks: list[str] = []
    elements = OpenElements()
    skipped: int | None = None  # elements around the one that is skipped
    at = 0

    def close_block() -> None:
        block = re.sub(r"\s+", " ", entities.unescape("".join(text))).strip()
        text.clear()
        if block:
            found.append(("article" in open_marks, "main" in open_marks, block))

    def add(piece: str) -> None:
        nonlocal skipped
        if skipped is not None and elements.names[-1] == "head" and piece.strip():
            elements.cut(skipped)
            skipped = None
        if skipped is None and piece:
            text.append(piece)

    while (m := TAG.search(html, at)) is not None:
        add(html[at:m.start()])
        at = m.end()
        ending, name, rest = m.group(1), (m.group(2) or "").lower(), m.group(3) or ""
        if not name:
            continue
        if not ending and name in RAW:
            end = RAW_END[name].search(html, at)
            at = end.end() if end else len(html)
            continue
        (elements.end if ending else elements.start)(name)
        opens = not ending and name not in VOID and name not in ("html", "body") and not rest.endswith("/")
        if skipped is not None:
            if len(elements.names) > skipped:
                if opens:
                    elements.push(name)
                continue
            own = ending and len(elements.names) == skipped
            skipped = None
            if own:
                continue
        if name in BLOCK or name in SKIPPED:
            close_block()
        elif name in SPACED:
            text.append(" ")
        if ending:
            mark = "article" if name == "article" else "main"
            if name in ("article", "main") and mark in open_marks:
                open_marks.remove(mark)
            continue
        if name in VOID:
            continue
        drop = name in SKIPPED or name == "header" and not open_marks
        if name not in ("html", "body") and (drop or no_content(rest)):
            close_block()
            if opens:
                skipped = len(elements.names)
                elements.push(name)
            continue
        if name in ("article", "main"):
            open_marks.append(name)
        if opens:
            elements.push(name)
    add(html[at:])
    close_block()
    return _chosen(found)


def suffix_groups(tokens: np.ndarray, length: int) -> np.ndarray:
    """A number for each suffix, equal for those that begin with the same ``length`` tokens, ascending in suffix order.

    Prefix doubling: suffixes sorted by their first k tokens are sorted by 2k through the ranks k places on.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    k = 1
    while k < length:
        step = min(k, length - k)
        after = np.zeros_like(rank)
        after[:-step] = rank[step:]
        rank = np.unique(rank * (len(rank) + 2) + after, return_inverse=True)[1].astype(np.int64) + 1
        k += step
    return rank


def windows(tokens: list[str]) -> list[bytes]:
    """A digest for each ``RUN`` tokens in a row."""
    return [hashlib.blake2b("\x1f".join(tokens[i:i + RUN]).encode(), digest_size=12).digest() for i in range(len(tokens) - RUN + 1)]


def _least(marked: bool, pages: int, shards: int) -> int:
    """The number of pages of a shard that must have a run for the shard to name it."""
    if not marked:
        return PAGES if shards == 1 else 1
    return max(SITE_PAGES, -(-pages // SHARE)) if shards == 1 else -(-pages // LOCAL)


def _shard(table: pa.Table) -> pa.Table:
    """A shard's suffix array: windows and the number of pages that have them, one place for each group of suffixes.

    The empty window stands for the pages of the shard. Pages without marks follow, to be read again.
    """
    host, marked, shards = (table[c][0].as_py() for c in ("host", "marked", "shards"))
    pages = [" ".join(b).split() for b in table["blocks"].to_pylist()]
    sizes = np.array([len(p) for p in pages])
    number: dict[str, int] = {}
    # every page ends with a token of its own, which no run can cross
    stream = [number.setdefault(t, len(number)) for p in pages for t in p + [None]]
    owner = np.repeat(np.arange(len(pages)), sizes + 1)
    place = np.concatenate([np.arange(n + 1) for n in sizes])
    tokens = np.array(stream, np.int64)
    ends = place == sizes[owner]
    tokens[ends] = len(number) + np.arange(ends.sum())
    group = suffix_groups(tokens, RUN)
    inside = np.flatnonzero(place + RUN <= sizes[owner])
    pairs = np.unique(group[inside] * len(pages) + owner[inside])
    groups, pages_of = np.unique(pairs // len(pages), return_counts=True)
    named = pages_of >= _least(marked, len(pages), shards)
    first = np.zeros(int(group.max(initial=0)) + 1, np.int64)
    first[group[inside][::-1]] = inside[::-1]
    found = [b""] + [windows(pages[owner[i]][place[i]:place[i] + RUN])[0] for i in first[groups[named]].tolist()]
    counts = pa.table({"host": pa.array([host] * len(found), pa.string()), "marked": pa.array([marked] * len(found), pa.bool_()),
                       "window": pa.array(found, pa.binary()), "pages": pa.array([len(pages), *pages_of[named].tolist()], pa.int64())})
    rest = table.select(["host", "marked", "key", "page_id", "url", "blocks"])
    names = [f.split()[0] for f in FOUND.split(", ")]
    return pa.concat_tables([counts, rest.slice(0, 0) if marked else rest], promote_options="default").select(names)


def _unique_runs(texts: list[str], covered: set[int]) -> list[str]:
    """The blocks without the tokens that repeated windows cover; all of them if nothing would be left."""
    hidden = {i + k for i in covered for k in range(RUN)}
    out, at = [], 0
    for block in texts:
        tokens = block.split()
        kept = " ".join(t for i, t in enumerate(tokens) if at + i not in hidden)
        at += len(tokens)
        if kept:
            out.append(kept)
    return out or texts


def _without_site(texts: list[str], site: frozenset[bytes]) -> list[str]:
    """The blocks but those that runs of the host cover whole; all of them if those were half of the text or more."""
    tokens = " ".join(texts).split()
    hidden = {i + k for i, w in enumerate(windows(tokens)) if w in site for k in range(RUN)}
    out, at, gone = [], 0, 0
    for block in texts:
        n = len(block.split())
        if n and all(i in hidden for i in range(at, at + n)):
            gone += n
        else:
            out.append(block)
        at += n
    return out if 2 * gone < len(tokens) else texts


def _streams(batches):
    """Each page with text, for its shard; what a marked page is called is not needed there."""
    for batch in batches:
        out = []
        for page, url, html, host, shard, shards, key in zip(*(c.to_pylist() for c in batch.columns)):
            scope, texts = blocks(html or "")
            if texts:
                marked = scope != BODY
                out.append((host, marked, shard, shards, *((None, None, None) if marked else (key, page, url)), texts))
        kinds = (pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * len(kinds), kinds)],
                                         ["host", "marked", "shard", "shards", "key", "page_id", "url", "blocks"])


def _marked(batches):
    """(page_id, url, blocks) of pages that mark their content, without what is their host's, and of pages without text."""
    for batch in batches:
        out, sites = ([], [], []), {}
        columns = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "host")))
        for i, (page, url, html, host) in enumerate(columns):
            scope, texts = blocks(html or "")
            if scope == BODY and texts:
                continue
            if host not in sites:
                sites[host] = frozenset(batch.column("site")[i].as_py() or ())
            out[0].append(page)
            out[1].append(url)
            out[2].append(_without_site(texts, sites[host]) if sites[host] else texts)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()),
                                          pa.array(out[2], pa.list_(pa.string()))], ["page_id", "url", "blocks"])


def _rows(batches):
    """(key, host, window, place) of each window of each page."""
    for batch in batches:
        keys, hosts, found, places = [], [], [], []
        for key, host, texts in zip(*(c.to_pylist() for c in batch.columns)):
            of = windows(" ".join(texts).split())
            keys += [key] * len(of)
            hosts += [host] * len(of)
            found += of
            places += range(len(of))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(hosts, pa.string()), pa.array(found, pa.binary()),
                                          pa.array(places, pa.int32())], ["key", "host", "window", "place"])


def _left_over(batches):
    for batch in batches:
        out = [_unique_runs(texts, set(places or ())) for texts, places in zip(
            batch.column("blocks").to_pylist(), batch.column("places").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.list_(pa.string()))],
                                         ["page_id", "url", "blocks"])


def _sites(counts: DataFrame) -> DataFrame:
    """(host, site): the runs that most of the host's marked pages have; few for each host, as a page holds few of them."""
    marked = counts.where("marked")
    of_host = marked.where("window = X''").select("host", F.col("pages").alias("all_pages"))
    runs = marked.where("window <> X''").join(of_host, "host").where(
        (F.col("pages") >= SITE_PAGES) & (F.col("pages") * SHARE >= F.col("all_pages"))).select("host", "window")
    sites = runs.groupBy("host").agg(F.collect_list("window").alias("site"))
    return F.broadcast(sites) if runs.limit(SITE_ROWS + 1).count() <= SITE_ROWS else sites


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars per page."""
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).withColumn("host", host)
    split = rows.groupBy("host").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards")).where("shards > 1")
    dealt = rows.withColumn("key", F.monotonically_increasing_id()).join(small(split), "host", "left").withColumn(
        "shards", F.coalesce("shards", F.lit(1)))
    streams = dealt.select(
        "page_id", "url", "html", "host", F.pmod(F.xxhash64("key"), "shards").cast("int").alias("shard"), "shards", "key").mapInArrow(_streams, STREAM)
    found = written(streams.groupBy("host", "marked", "shard").applyInArrow(_shard, FOUND), "page-runs")
    counts = found.where("window IS NOT NULL").groupBy("host", "marked", "window").agg(F.sum("pages").alias("pages"))

    schema = "page_id long, url string, blocks array<string>"
    marked = rows.join(_sites(counts), "host", "left").select("page_id", "url", "html", "host", "site").mapInArrow(_marked, schema)
    plain = found.where("key IS NOT NULL").select("key", "page_id", "url", "blocks", "host")
    repeated = counts.where(~F.col("marked") & (F.col("window") != F.lit(b"")) & (F.col("pages") >= PAGES)).select("host", "window")
    places = plain.select("key", "host", "blocks").mapInArrow(_rows, "key long, host string, window binary, place int")
    covered = places.join(repeated, ["host", "window"]).groupBy("key").agg(F.collect_list("place").alias("places"))
    rest = plain.join(covered, "key", "left").select("page_id", "url", "blocks", "places").mapInArrow(_left_over, schema)
    text = F.array_join("blocks", "\n\n")
    return marked.unionByName(rest).select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))
