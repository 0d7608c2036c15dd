"""Main text of web pages by equivalence classes of template tokens.

Pages of one host are worked on in groups of some dozens. The tokens of a page are its opening tags and its text blocks, each
with the path of elements that it stands in. Tokens of the same occurrence vector over the pages of a group (so many times in
the first page, so many in the second, ...) form an equivalence class. A class of enough tokens that most pages have is valid
if its tokens come in one order, over and over, in every page, and if all of it lies in one gap of the page's skeleton, the
class of what every page has once. Valid classes nest into the template; the text blocks in them are the site's, what stands
in the slots between them is the page's own.

The article is a slot of the template. Elements that a page has once nest into a tree, valid over the pages that have them,
so that a host may have several layouts. From the root, the way goes down to whichever element holds most of the text that
differs from page to page, links not counted, and ends where no element holds more than half of it. The text of a page is
what this element holds, in page order, with a heading (h1) of the page's own that stands before it; an article element that
has most of it, or around it, is taken as a whole. Elements that name themselves menus, headers, footers, sidebars, notices,
adverts, forms or reader comments, by tag, role, class or id, are left out with all they hold. Text blocks of the template
are left out unless they make up a good part of the page, as in pages that are copies of each other.

A group of fewer than LEAST distinct pages, or of pages in which next to nothing differs, has no template to choose from. There
the text is the longest of the top-level article elements, else the main element, else the body without lists of links.

Groups are made of a host's distinct pages, whatever the number of tasks, of repeated rows or of other hosts' pages: hosts of
many distinct pages are first dealt into buckets by a digest of the page, then pages of a host and bucket are taken in the order
of that digest, GROUP at a time. Each distinct page is worked on once and its text joined to its rows. Null and empty pages have
an empty text; an unreadable or null url is a host of its own.
"""

from __future__ import annotations

import html as references
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwatch.llm.storage import under_plain_names

GROUP, BUCKET = 64, 512
#: Distinct pages of a group with a template, share of them that a class must be in, and most of a page's text that it may be.
LEAST, SHARE, MOST = 5, 0.8, 0.4
#: Pages are copies of each other if no more of their text differs.
ALIKE = 0.1

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template textarea title iframe object svg canvas select button audio video math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements of text, in which no article stands.
TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote figure figcaption ul ol dl li dt dd".split())
LEFT_OUT = frozenset("nav footer aside form menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
NAMED = frozenset(
    """ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner banners nav navbar navigation
    menu menus breadcrumb breadcrumbs masthead topbar toolbar footer footers sidebar sidebars rail aside widget widgets cookie
    cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing
    social comment comments disqus reply replies respond discussion related recommended recommendations pagination pager search
    copyright legal disclaimer""".split()
)
HEADERS = frozenset("header headers".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|itemprop|hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
END_OF = {name: re.compile(rf"</{name}\s*>", re.I) for name in SKIPPED}


#: An element is kept, left out, or left out as a header unless it turns out to be the article's.
KEPT, OUT, HEADER = range(3)


class Block:
    """A run of text between block-level tags."""

    __slots__ = ("text", "path", "article", "out", "linked", "list")

    def __init__(self, text: str, path: int, article: int, out: int, linked: int, in_list: int):
        self.text, self.path, self.article, self.out, self.linked, self.list = text, path, article, out, linked, in_list


class Page:
    """Tokens and text blocks of a page."""

    def __init__(self, source: str):
        self.blocks: list[Block] = []
        self.tokens: list[tuple] = []
        self.articles: dict[int, str] = {}
        self.links: Counter[int] = Counter()
        self.above: dict[int, tuple[int, str]] = {}  # of a path: the path around it, and the tag
        self.read(source)

    def flush(self) -> None:
        text = " ".join(references.unescape("".join(self.parts)).split())
        linked = len(" ".join(references.unescape("".join(self.linked)).split()))
        self.parts, self.linked = [], []
        if text:
            _, path, out, article, in_list = self.stack[-1]
            self.blocks.append(Block(text, path, article, out, linked, in_list))
            self.tokens.append((path, text))

    def add(self, text: str) -> None:
        if text:
            self.parts.append(text)
            if self.in_link:
                self.linked.append(text)

    def read(self, source: str) -> None:
        # open elements: tag, path, left out (KEPT, OUT or HEADER), article (0: none), list (0: none)
        self.stack: list[tuple[str, int, int, int, int]] = [("", 0, KEPT, 0, 0)]
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.in_link = 0
        at, n = 0, 0
        while (m := TOKEN.search(source, at)) is not None:
            self.add(source[at : m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self.close(tag)
                continue
            if tag == "br":
                self.add(" ")
                continue
            if tag in SKIPPED:
                if not m[3].endswith("/"):
                    end = END_OF[tag].search(source, at)
                    at = end.end() if end else len(source)
                if tag not in INLINE:
                    self.add(" ")
                continue
            if tag not in INLINE:
                self.flush()
            if tag in VOID:
                continue
            n += 1
            self.open(tag, m[3], n)
        self.add(source[at:])
        self.flush()

    def open(self, tag: str, rest: str, n: int) -> None:
        if tag not in INLINE:
            self.end_implied(tag)
        _, path, out, article, in_list = self.stack[-1]
        attributes = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(rest)} if rest.strip() else {}
        if tag not in INLINE or attributes:
            around, path = path, hash((path, tag, attributes.get("class", ""), attributes.get("id", "") if tag not in INLINE else ""))
            self.above[path] = around, tag
        if tag not in INLINE:
            self.tokens.append((path,))
        if out != OUT and tag not in ("html", "body", "main"):
            out = left_out(tag, attributes, article) or out
        if not out and (tag == "article" or attributes.get("itemprop", "").lower() == "articlebody") and not (article and self.articles[article] == "article"):
            article = n
            self.articles[n] = "article"
        elif not out and not article and (tag == "main" or attributes.get("role", "").lower() == "main"):
            article = n
            self.articles[n] = "main"
        if tag in ("ul", "ol", "dl", "table"):
            in_list = n
        if tag == "a":
            self.in_link += 1
            self.links[in_list] += 1
        self.stack.append((tag, path, out, article, in_list))

    def end_implied(self, tag: str) -> None:
        if tag not in CLOSES:
            for k in range(len(self.stack) - 1, max(0, len(self.stack) - 7), -1):
                if self.stack[k][0] == "p":
                    self.drop(k)
                    return
            return
        for k in range(len(self.stack) - 1, 0, -1):
            name = self.stack[k][0]
            if name in CLOSES[tag]:
                self.drop(k)
                return
            if name in ("ul", "ol", "dl", "table", "tr", "div", "section", "article"):
                return

    def close(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] == tag:
                self.drop(k)
                return
            if tag in INLINE and self.stack[k][0] not in INLINE:
                return

    def drop(self, k: int) -> None:
        self.in_link -= sum(s[0] == "a" for s in self.stack[k:])
        del self.stack[k:]


def left_out(tag: str, attributes: dict[str, str], article: int) -> int:
    """Does the element name itself as something other than the text?"""
    header = HEADER if tag == "header" and not article else KEPT
    if tag in LEFT_OUT:
        return OUT
    if not attributes:
        return header
    if attributes.get("role", "").lower() in ROLES or "hidden" in attributes or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return OUT
    if tag in INLINE or tag in ("article", "h1", "h2", "h3", "h4", "h5", "h6", "p"):
        names = " ".join((attributes.get("class", ""), attributes.get("id", ""))).split()
        return OUT if any(name.lower() in NAMED for name in names) else KEPT
    for name in (attributes.get("class", "") + " " + attributes.get("id", "")).split():
        words = [w.lower() for w in WORD.findall(name)]
        # the last word says what it is, the first one whose: post-comments, ad-slot, but not content-with-sidebar
        if words and (words[-1] in NAMED or (words[0] in NAMED and words[-1] not in ("content", "article", "text", "body", "main"))):
            return OUT
        if words and not article and words[-1] in HEADERS:
            header = HEADER
    return header


def template_of(pages: list[Page]) -> set[tuple]:
    """Text tokens of the valid equivalence classes of some distinct pages."""
    n = len(pages)
    if n < LEAST:
        return set()
    counts = [Counter(p.tokens) for p in pages]
    support = Counter(t for c in counts for t in c)
    classes = defaultdict(list)
    for token, k in support.items():
        if k >= SHARE * n:
            classes[tuple(c[token] for c in counts)].append(token)
    skeleton = set(classes.get((1,) * n, ()))
    if not ordered(skeleton, pages):
        skeleton = set()
    # gap of the skeleton that each token stands in, by page
    gaps: dict[tuple, set[int]] = defaultdict(set)
    for page in pages:
        gap = 0
        for token in page.tokens:
            gap += token in skeleton
            if support[token] >= SHARE * n:
                gaps[token].add(gap)
    found: set[tuple] = set(skeleton)
    for tokens in classes.values():
        own = set(tokens)
        if own <= skeleton or len(own) < 2 or not ordered(own, pages):
            continue
        if len(set().union(*(gaps[t] for t in own))) == 1 or not skeleton:
            found |= own
    return {t for t in found if len(t) == 2}


def ordered(tokens: set[tuple], pages: list[Page]) -> bool:
    """Do the tokens of a class come in one order, over and over, in every page?"""
    order: list[tuple] = []
    for page in pages:
        there = [t for t in page.tokens if t in tokens]
        order = order or there[: len(tokens)]
        if there != order * (len(there) // max(1, len(order))):
            return False
    return True


class Elements:
    """The tree of elements that pages have once, and how much text that differs from page to page each of them holds."""

    def __init__(self, pages: list[Page]):
        self.above = {path: around for page in pages for path, around in page.above.items()}
        tags = [Counter(t[0] for t in page.tokens if len(t) == 1) for page in pages]
        holders = defaultdict(list)
        for k, page in enumerate(tags):
            for path, times in page.items():
                holders[path].append(k if times == 1 else -1)
        classes = defaultdict(set)
        for path, ks in holders.items():
            if len(ks) >= LEAST and min(ks) >= 0 and self.above[path][1] not in TEXTUAL:
                classes[tuple(ks)].add((path,))
        self.tree = {path for ks, own in classes.items() if ordered(own, [pages[k] for k in ks]) for (path,) in own}
        self.nearest: dict[int, int] = {0: 0}  # of a path: the element of the tree that it is or stands in
        self.layouts = [frozenset(self.tree & page.keys()) for page in tags]
        self.support = Counter(token for page in pages for token in {t for t in page.tokens if len(t) == 2})
        self.holders = {path: len(holders[path]) for path in self.tree} | {0: len(pages)}
        self.depth = {0: 0}
        for path in self.tree:
            way = [path]
            while way[-1] not in self.depth:
                way.append(self.around(way[-1]))
            for p in reversed(way[:-1]):
                self.depth[p] = self.depth[self.around(p)] + 1

    def element(self, path: int) -> int:
        """The element of the tree that a path is or stands in, 0 for none."""
        way = []
        while path not in self.nearest:
            way.append(path)
            if path in self.tree:
                self.nearest[path] = path
            else:
                path = self.above[path][0]
        for p in way:
            self.nearest[p] = self.nearest[path]
        return self.nearest[path]

    def around(self, element: int) -> int:
        return self.element(self.above[element][0])

    def tag(self, path: int) -> str:
        """Of the block element that a path is or stands in."""
        while path and self.above[path][1] in INLINE:
            path = self.above[path][0]
        return self.above[path][1] if path else ""

    def differs(self, block: Block) -> bool:
        return 2 * self.support[block.path, block.text] <= self.holders[self.element(block.path)]

    def weights(self, pages: list[Page], layouts: list[frozenset[int]]) -> tuple[dict[int, float], bool]:
        """Differing text in each element, by page that has it; do the pages differ at all?"""
        sums, times, whole = Counter(), Counter({0: len(pages)}), 0
        for page, layout in zip(pages, layouts, strict=True):
            times.update(layout)
            for block in page.blocks:
                if not block.out:
                    size = len(block.text) - block.linked
                    whole += size
                    if self.differs(block):
                        sums[self.element(block.path)] += size
        own = sums.total()
        for element in sorted(times, key=self.depth.__getitem__, reverse=True):
            if element:
                sums[self.around(element)] += sums[element]
        return {e: sums[e] / n for e, n in times.items()}, own > ALIKE * whole

    def slot(self, layout: frozenset[int], weight: dict[int, float]) -> int:
        """The innermost element of a layout with more than half of the differing text of all that are around it."""
        below = defaultdict(list)
        for element in layout:
            below[self.around(element)].append(element)
        at = 0
        while below[at]:
            best = max(below[at], key=lambda e: weight[e])
            if 2 * weight[best] <= weight[at]:
                break
            at = best
        return at


def slots_of(pages: list[Page]) -> list[set[int] | None]:
    """Of each of some distinct pages, the numbers of its blocks that stand in the article's slot; None without a template."""
    if len(pages) < LEAST:
        return [None] * len(pages)
    elements = Elements(pages)
    everywhere = elements.weights(pages, elements.layouts)
    alike = defaultdict(list)
    for page, layout in zip(pages, elements.layouts, strict=True):
        alike[layout].append(page)
    chosen = {}
    for layout, those in alike.items():  # a layout of few pages is judged by all pages that have its elements
        weight, differ = elements.weights(those, [layout] * len(those)) if len(those) >= LEAST else everywhere
        chosen[layout] = elements.slot(layout, weight) if differ else None
    return [None if chosen[layout] is None else held_in(page, chosen[layout], elements) for page, layout in zip(pages, elements.layouts, strict=True)]


def held_in(page: Page, slot: int, elements: Elements) -> set[int]:
    """Numbers of the blocks in an element, or in the article that has most of it, and of the heading before it."""
    held = {0: not slot, slot: True}

    def inside(path: int) -> bool:
        way = [elements.element(path)]
        while way[-1] not in held:
            way.append(elements.around(way[-1]))
        for element in way:
            held[element] = held[way[-1]]
        return held[way[0]]

    root = not slot or elements.above[slot][1] in ("html", "body", "main")
    found = {k for k, b in enumerate(page.blocks) if b.out != OUT and (b.out != HEADER or not root) and inside(b.path)}
    sizes = Counter()
    for k in found:
        sizes[page.blocks[k].article if page.articles.get(page.blocks[k].article) == "article" else 0] += len(page.blocks[k].text)
    article = max(sizes, key=lambda a: (sizes[a], -a), default=0)
    if article and 2 * sizes[article] > sum(sizes.values()):
        return {k for k, b in enumerate(page.blocks) if not b.out and b.article == article}
    if found and not any(elements.tag(page.blocks[k].path) == "h1" for k in found):
        heads = [k for k, b in enumerate(page.blocks) if not b.out and elements.tag(b.path) == "h1"]
        if len(heads) == 1 and heads[0] < min(found) and elements.differs(page.blocks[heads[0]]):
            found.add(heads[0])
    return found


def slot_text(page: Page, template: set[tuple], slot: set[int] | None = None) -> str:
    """The page's own text: in the blocks of a slot, or in what names itself the article."""
    if slot is not None:
        inside = [page.blocks[k] for k in sorted(slot)]
    else:
        inside = named_article(page)
    own = [b for b in inside if (b.path, b.text) not in template]
    whole, left = sum(len(b.text) for b in inside), sum(len(b.text) for b in own)
    return " ".join(b.text for b in (own if whole - left <= MOST * whole else inside))


def named_article(page: Page) -> list[Block]:
    """The blocks of the longest article or main element, else all but lists of links."""
    sizes = Counter()
    for b in page.blocks:
        if not b.out and b.article:
            sizes[b.article] += len(b.text)
    articles = {k: v for k, v in sizes.items() if page.articles[k] == "article"} or dict(sizes)
    chosen = max(articles, key=lambda k: (articles[k], -k)) if articles else 0
    inside = [b for b in page.blocks if not b.out and (not chosen or b.article == chosen)]
    if not chosen:  # lists that are mostly links
        total, linked = Counter(), Counter()
        for b in inside:
            total[b.list] += len(b.text)
            linked[b.list] += b.linked
        inside = [b for b in inside if not (b.list and page.links[b.list] >= 3 and linked[b.list] > 0.6 * total[b.list])]
    return inside


def texts_of_group(sources: list[str | None]) -> list[str]:
    """The text of each page of a group of one host."""
    pages = {s: Page(s) for s in sources if s}
    distinct = [*pages.values()]
    template, slots = template_of(distinct), slots_of(distinct)
    texts = {s: slot_text(p, template, slot) for (s, p), slot in zip(pages.items(), slots, strict=True)}
    return [texts[s] if s else "" for s in sources]


def extract_text(pages: DataFrame, url: str = "url", html: str = "html", into: str = "text") -> DataFrame:
    """The rows without the column html, with a column into (replaced if there is one): the main text."""
    return under_plain_names(pages, [url, html], texts_of_pages, into, html)


def texts_of_pages(pages: DataFrame, url: str, html: str) -> DataFrame:
    """The rows without html, with the column found."""
    host = F.coalesce(F.lower(F.regexp_extract(pages[url].cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = pages.withColumns({"__host": host, "__page": F.substring(F.unhex(F.sha2(pages[html], 256)), 1, 16)})
    there = rows.where("__page is not null")
    counts = there.select("__host", "__page").distinct().groupBy("__host").count()
    # one host for BUCKET distinct pages at most
    hosts = counts.where(F.col("count") > BUCKET).select("__host", F.ceil(F.col("count") / BUCKET).alias("__buckets"))
    sources = there.select("__host", "__page", F.col(html).alias("__html"))
    sources = sources.mapInArrow(distinct_of_task, "__host string, __page binary, __html binary").join(F.broadcast(hosts), "__host", "left")
    sources = sources.withColumn("__bucket", F.pmod(F.xxhash64("__page"), F.coalesce("__buckets", F.lit(1)))).drop("__buckets")
    sources = sources.repartition("__host", "__bucket").sortWithinPartitions("__host", "__bucket", "__page")
    texts = sources.mapInArrow(texts_of_task, "__host string, __page binary, __text binary")
    kept = [f.name for f in pages.schema.fields if f.name != html]
    rows = rows.select(*kept, "__host", "__page").join(texts, ["__host", "__page"], "left")
    return rows.select(*kept, F.coalesce(unpacked("__text"), F.lit("")).alias("found"))


@F.arrow_udf(T.StringType())
def unpacked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([None if x is None else zlib.decompress(x).decode() for x in batch.to_pylist()], pa.string())


def distinct_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each host and page of a task, the page compressed."""
    seen = set()
    for batch in batches:
        new = []
        for k, key in enumerate(zip(batch.column("__host").to_pylist(), batch.column("__page").to_pylist(), strict=True)):
            if key not in seen:
                seen.add(key)
                new.append(k)
        found = batch.take(pa.array(new, pa.int64()))
        raw = pa.array([zlib.compress(x.as_py().encode()) for x in found.column("__html")], pa.binary())
        yield pa.record_batch({"__host": found.column("__host"), "__page": found.column("__page"), "__html": raw})


def texts_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed texts of the distinct pages of sorted rows (__host, __page, __html, __bucket)."""

    def out(host: str, group: list[tuple[bytes, str]]) -> pa.RecordBatch:
        texts = texts_of_group([source for _, source in group])
        pages = pa.array([page for page, _ in group], pa.binary())
        return pa.record_batch({"__host": pa.array([host] * len(group), pa.string()), "__page": pages, "__text": pa.array([zlib.compress(x.encode()) for x in texts], pa.binary())})

    held: list[tuple[bytes, str]] = []
    key = None
    for batch in batches:
        names = zip(*(batch.column(name).to_pylist() for name in ("__host", "__bucket", "__page")), strict=True)
        for k, (host, bucket, page) in enumerate(names):
            if (host, bucket) != key:
                if held:
                    yield out(key[0], held)
                held, key = [], (host, bucket)
            elif page == held[-1][0]:  # sent by another task, too
                continue
            held.append((page, zlib.decompress(batch.column("__html")[k].as_py()).decode()))
            if len(held) >= GROUP + GROUP // 2:
                yield out(host, held[:GROUP])
                held = held[GROUP:]
    if held:
        yield out(key[0], held)
