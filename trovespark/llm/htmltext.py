"""Main text of web pages by site template removal.

A page is read once into a flat list of elements and texts. Every block-level element's subtree is hashed (tag, texts and
children's hashes). Spark counts, for each host, on how many different pages each subtree stands; subtrees on many pages
of a host are its template and are deleted from all its pages. Pages with equal bodies count once, so that copies of a
page don't make a template of its article. Elements that say what they are (navigation, forms, adverts by class, ...) go
too, as one page is enough to tell: by their tag or role, or by a class or id ('user-comments', 'sidebar', 'related-posts',
but not 'related-work'). Inside a marked article prose goes only when it recurs on `PROSE_TIMES` as many pages,
for texts quote each other; and a named block that holds most of the article is the article. A marked article that holds
less text than the page around it is a teaser, and the whole page is taken.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from trovespark.frames import materialise, pick, release, slices

# HTML's element classes, and words by which pages name what isn't their article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math canvas object audio video select".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"br", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "optgroup", "legend", "html", "body"}
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}), "option": ({"option"}, {"select"})}
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th tr tbody table ul ol dl figure figcaption br".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED = frozenset("head nav footer aside form button menu dialog label fieldset".split()) | (RAW - {"math"})
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = frozenset("adv advert adverts advertisement advertising breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr modal nav navbar navigation newsletter pager pagination paywall popup promo promotion sharing sidebar signup sponsored subscribe toolbar".split())
#: Names that mean this only alone or with words that add nothing, as in 'share-buttons' (but 'share-prices' does not).
WEAK_NAMES = frozenset("ad ads banner disclaimer login menu notice notices recommended related reply respond search share skip social sponsor subscription widget".split())
BESIDE = frozenset("area articles bar block bottom box btn button buttons col column container content follow form global group header head icons inner item items left links list main media outer page panel posts primary reading right row secondary section site slot sticky stories text this thread top unit us widgets wrap wrapper".split())
#: Words that say an element stands beside such a block, as in 'has-sidebar'.
NOT_IT = frozenset("has no with without".split())
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
END_OR_QUOTE = re.compile(r"[>\"']")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"

#: A subtree is template from so many different pages of its host on, however many pages the host has.
MIN_PAGES = 5
#: Templates (two numbers and a host) that may be broadcast; with more, each page is joined to its own ones.
BROADCAST_HASHES = 200_000
LINKS_FROM = 0.3
#: How many times as many pages prose in a marked article must recur on to be template.
PROSE_TIMES = 4


@cache
def names_a_side_block(name: str) -> bool:
    """Whether a class or id names what isn't an article: by a word that means nothing else, or by a weaker one as a whole."""
    words = {w for w in re.split(r"[^a-z]+", name) if len(w) > 1}
    if words & NOT_IT:
        return False
    return bool(words & NAMES) or bool(words & WEAK_NAMES) and words <= WEAK_NAMES | BESIDE


class Page:
    """A parsed page: elements in page order (parents first) and text events that belong to them."""

    def __init__(self, source: str):
        self.tags, self.parents, self.attributes, self.hashes = [""], [0], [""], [0]
        self.events: list[tuple[int, str | None]] = []  # None: a block boundary
        self._parts: list[list[str]] = [[]]
        self._stack = [0]
        self._open_now: Counter[str] = Counter()
        self._read(source)
        while len(self._stack) > 1:
            self._close()
        self.body = xxhash.xxh64_intdigest("\0".join(self._parts[0]).encode("utf-8", "surrogatepass"))

    def _open(self, tag: str, attributes: str) -> None:
        self._open_now[tag] += 1
        self.tags.append(tag)
        self.parents.append(self._stack[-1])
        self.attributes.append(attributes)
        self.hashes.append(0)
        self._stack.append(len(self.tags) - 1)
        self._parts.append([tag])
        if tag in BLOCK:
            self.events.append((self._stack[-1], None))

    def _close(self) -> None:
        node, parts = self._stack.pop(), self._parts.pop()
        self._open_now[self.tags[node]] -= 1
        if self.tags[node] in BLOCK:
            self.events.append((node, None))
        if len(parts) > 1:
            value = xxhash.xxh64_intdigest("\0".join(parts).encode("utf-8", "surrogatepass"))
            self.hashes[node] = value - (1 << 63)
            self._parts[-1].append(f"{value:x}")

    def _until(self, names: set[str], barrier: set[str]) -> None:
        """Closes the nearest open element of `names` and all in it, unless a barrier is nearer."""
        if not any(self._open_now[name] for name in names):
            return
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self.tags[self._stack[depth]]
            if tag in names:
                while len(self._stack) > depth:
                    self._close()
                return
            if tag in barrier:
                return

    def _text(self, text: str) -> None:
        if not text:
            return
        text = html.unescape(text) if "&" in text else text
        self.events.append((self._stack[-1], text))
        if plain := " ".join(text.split()):
            self._parts[-1].append(plain)

    def _read(self, source: str) -> None:
        at, quotes, lower = 0, {'"': True, "'": True}, None
        while True:
            begin = source.find("<", at)
            if begin < 0:
                self._text(source[at:])
                return
            tag = TAG.match(source, begin)
            if not tag:
                if source.startswith("<!--", begin):
                    end = source.find("-->", begin + 4)
                elif source[begin + 1 : begin + 2] in ("!", "?", "/") and len(source) > begin + 1:
                    end = source.find(">", begin + 2)
                else:
                    self._text(source[at : begin + 1])
                    at = begin + 1
                    continue
                self._text(source[at:begin])
                if end < 0:
                    return
                at = end + (3 if source[begin + 2 : begin + 4] == "--" else 1)
                continue
            self._text(source[at:begin])
            end = tag.end()
            while (m := END_OR_QUOTE.search(source, end)) and m[0] != ">":
                shut = source.find(m[0], m.end()) if quotes[m[0]] else -1
                if shut < 0:  # an unclosed quote is no quote, here and later on
                    quotes[m[0]] = False
                end = max(shut, m.start()) + 1
            if not m:
                return
            at, name = m.end(), tag[2].lower()
            if tag[1]:
                self._end(name)
                continue
            attributes = source[tag.end() : m.start()]
            if name in CLOSES_P:
                self._until({"p"}, {"td", "th", "table", "button", "object"})
            if name in ENDS:
                self._until(*ENDS[name])
            self._open(name, attributes)
            if name in VOID or attributes.endswith("/") and name not in BLOCK:
                self._close()
            elif name in RAW:
                lower = lower if lower is not None else source.lower()
                end = lower.find(f"</{name}", at) if len(lower) == len(source) else -1
                if end < 0 and (close := re.compile(f"</{re.escape(name)}", re.IGNORECASE).search(source, at)):
                    end = close.start()
                self._close()
                if end < 0:
                    return
                shut = source.find(">", end)
                at = len(source) if shut < 0 else shut + 1

    def _end(self, name: str) -> None:
        if name == "br":
            self.events.append((self._stack[-1], None))
        elif name in BLOCK:
            self._until({name}, {"td", "th", "table"} if name not in ("table", "tbody", "thead", "tfoot", "tr", "td", "th", "body", "html", "article", "main") else set())
        else:
            self._until({name}, BLOCK - {name})

    def subtrees(self) -> set[int]:
        """Hashes of all block-level subtrees that hold text."""
        return {h for h, tag in zip(self.hashes, self.tags) if h and tag in BLOCK}

    def _says_so(self, node: int) -> bool:
        """Whether the element itself says that it isn't the article."""
        tag, raw = self.tags[node], self.attributes[node]
        if tag in DROPPED:
            return True
        if not raw or tag in ("html", "body", "article", "main") and "comment" not in raw:
            return False
        for m in ATTRIBUTE.finditer(raw):
            key, value = m[1].lower(), next((x for x in m.groups()[1:] if x is not None), "").lower()
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in ROLES:
                return True
            if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
            if key in ("class", "id") and any(map(names_a_side_block, value.split())):
                return True
        return False

    def text(self, template: frozenset[int] | set[int] = frozenset(), often: frozenset[int] | set[int] = frozenset()) -> str:
        """The article's text, without the subtrees of `template`; `often` are those that go from an article's prose too."""
        n = len(self.tags)
        holds = [False] * n  # an article or main element
        for i in range(n - 1, 0, -1):
            holds[i] |= self.tags[i] in ("article", "main")
            holds[self.parents[i]] |= holds[i]
        size, linked, in_link = [0] * n, [0] * n, [False] * n
        for i in range(1, n):
            in_link[i] = in_link[self.parents[i]] or self.tags[i] == "a"
        for node, text in self.events:
            if text:
                plain = len(text) - text.count(" ")
                size[node] += plain
                linked[node] += plain * in_link[node]
        for i in range(n - 1, 0, -1):
            size[self.parents[i]] += size[i]
            linked[self.parents[i]] += linked[i]
        gone, article, heads, of = [False] * n, [False] * n, [False] * n, [0] * n  # of: the marked article around
        for i in range(1, n):
            parent, tag = self.parents[i], self.tags[i]
            marked = tag in ("article", "main")
            article[i], of[i] = article[parent] or marked, i if marked else of[parent]
            own = self._says_so(i) and not (holds[i] and not marked)
            if own and article[i] and not marked and tag not in DROPPED and 2 * size[i] > size[of[i]]:
                own = False
            if not own and tag not in ("html", "body") and not marked and not holds[i] and self.hashes[i]:
                if not article[i]:
                    own = self.hashes[i] in template
                elif tag in PROSE:
                    own = self.hashes[i] in often
                else:
                    own = self.hashes[i] in often or self.hashes[i] in template and linked[i] >= LINKS_FROM * size[i]
            heads[i] = heads[parent] or tag == "header" and not holds[i]
            gone[i] = gone[parent] or own
        for i in range(n):  # of a header, an article keeps its headings
            if heads[i] and not gone[i]:
                up = i
                while up and self.tags[up] not in HEADINGS and self.tags[up] != "header":
                    up = self.parents[up]
                gone[i] = not (article[i] and self.tags[up] in HEADINGS)
        whole = sum(len(text) for node, text in self.events if text and not gone[node] and not in_link[node])
        for region in ("article", "main", ""):
            inside = [not region] * n
            for i in range(1, n):
                inside[i] = inside[self.parents[i]] or self.tags[i] == region
            blocks, now, prose = [], [], 0
            for node, text in self.events:
                if text is None:
                    if now:
                        blocks.append("".join(now))
                        now = []
                elif inside[node] and not gone[node]:
                    now.append(text)
                    prose += 0 if in_link[node] else len(text)
            blocks.append("".join(now))
            out = " ".join(" ".join(blocks).split())
            if out and (not region or 2 * prose >= whole):
                return out
        return ""


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1000):
        hosts, hashes, bodies, sources = [], [], [], []
        for name, source, number in zip(batch.column(0), batch.column(1), batch.column(2)):
            page, host = Page(source.as_py() or ""), name.as_py()
            own = page.subtrees()
            hosts += [host] * len(own)
            hashes += own
            bodies += [page.body - (1 << 63)] * len(own)
            sources += [number.as_py()] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *(pa.array(c, pa.int64()) for c in (hashes, bodies, sources))], ["host", "hash", "body", "source"])


def source_of(html: Column) -> Column:
    return F.xxhash64(F.coalesce(html, F.lit("")))


def subtrees(pages: DataFrame) -> DataFrame:
    """host, hash, body, source: the subtrees of every different page; a table to release."""
    named = pick(pages, url="string", html="string").select(host_of(F.col("url")).alias("host"), "html", source_of(F.col("html")).alias("source"))
    rows = named.mapInArrow(_subtrees, "host string, hash bigint, body bigint, source bigint")
    return materialise(rows.distinct(), "html-subtrees")


def templates(found: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """host, hash and often: the subtrees that recur on at least min_pages pages of the host with different bodies, and
    whether they do so on `PROSE_TIMES` as many. A table to release."""
    counts = found.select("host", "hash", "body").distinct().groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
    return materialise(counts.where(F.col("n") >= min_pages).select("host", "hash", (F.col("n") >= PROSE_TIMES * min_pages).alias("often")), "html-templates")


def _texts(batches: Iterator[pa.RecordBatch], sent=None) -> Iterator[pa.RecordBatch]:
    """Texts of (page_id, url, html) with either the host, whose templates are in `sent`, or the page's own two lists."""
    none = (frozenset(), frozenset())
    for batch in slices(batches, 1000):
        if sent is not None:
            held = [sent.value.get(host.as_py(), none) for host in batch.column(3)]
        else:
            held = [(frozenset(a.as_py() or ()), frozenset(b.as_py() or ())) for a, b in zip(batch.column(3), batch.column(4))]
        texts = [Page(source.as_py() or "").text(*own) for source, own in zip(batch.column(2), held)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, broadcast_hashes: int = BROADCAST_HASHES) -> DataFrame:
    """page_id, url, text (empty if none) and n_chars of every page.

    A null html counts as empty; a null url or one without a host belongs to host ''. Repeated rows give repeated rows,
    an empty table none; other columns are left out whatever their names. There are no ties. The templates are broadcast
    if they are few enough; otherwise each different page is joined to those that it holds itself, so that no task has a
    host's whole list, however many pages or templates a host has. Both ways give the same texts.
    """
    schema = "page_id bigint, url string, text string, n_chars bigint"
    rows = pick(pages, page_id="bigint", url="string", html="string")
    there = subtrees(rows)
    found = templates(there, min_pages)
    named = rows.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    if found.count() <= broadcast_hashes:
        by_host: dict[str, tuple[set[int], set[int]]] = {}
        for r in found.toLocalIterator():
            every, often = by_host.setdefault(r.host, (set(), set()))
            every.add(r.hash)
            if r.often:
                often.add(r.hash)
        sent = pages.sparkSession.sparkContext.broadcast(by_host)
        out = named.select("page_id", "url", "html", "host").mapInArrow(lambda b: _texts(b, sent), schema)
    else:
        own = there.select("host", "hash", "source").distinct().join(found, ["host", "hash"])
        lists = own.groupBy("host", "source").agg(F.collect_list("hash").alias("hashes"), F.collect_list(F.when(F.col("often"), F.col("hash"))).alias("often"))
        joined = named.withColumn("source", source_of(F.col("html"))).join(lists, ["host", "source"], "left")
        out = materialise(joined.select("page_id", "url", "html", "hashes", "often").mapInArrow(_texts, schema), "html-texts")
    release(there, found)
    return out
