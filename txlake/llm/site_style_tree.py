"""Main text of web pages by a style tree of each site.

The pages of a host are merged into one tree: an element node stands for a place (the path of block elements with
their classes), with the styles found there (the sequences of child elements) and, where text lies, its features (the
texts of its blocks). Presentation importance of a node is the entropy of its styles over the pages that have it,
content importance one less the mean entropy of its features: what looks or reads alike on every page scores 0, what
differs from page to page scores 1. Importance is composed bottom-up, with a damping of ``GAMMA`` a level. Branches in
which no node has enough composite importance are removed from every page of the host.

Copies of a page count once. A site needs ``MIN_PAGES`` different pages at a place before it can say anything
there. Beside the tree, names decide. Elements for menus, footers, sidebars, forms and dialogs and headers outside an article, and
outside an article containers (not headings, paragraphs or list items) whose class, id or role has a word for such parts, are noise
whatever the tree says: adverts, menus and footers that change from page to page are as important to the tree as the text. So are
containers named for reader comments, adverts, menus, footers or sidebars (``NEVER_TEXT``) inside an article. Doubtful
are containers with another such word inside an article (``header`` is none there) and, where a page marks its article or main part, all
else outside: they are kept where the site has enough pages at the place and its branch is important (``NOISE_ANYWHERE``), else not.
Of the rest inside an article only branches that hardly vary at all are removed. On a page without an article a name does not
count for a container that holds more than half of the page's text outside lists and tables (``has-sidebar`` around everything),
unless it names comments or adverts.

Pages travel as the hashes of their parts, are made distinct and summed; a host's tree has one row for each place, however many pages it
has. The places to remove are sent to all tasks if they are few (``MOST_SENT``), else joined by host.

Defined cases: a script, button or other element without page text that has no end tag ends at the next block element (without
one, scripts and styles end with the page, of others only the tag goes); a head ends where its elements end; a null or empty page has an empty text; a null url belongs to no site; ties do not arise; repeated
rows each get their text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as html_module
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .textops import slices

GAMMA = 0.9
MIN_PAGES = 10
#: Composite importance below which a branch is noise: where the page marks no article, and inside a marked one.
NOISE_ANYWHERE, NOISE_IN_ARTICLE = 0.6, 0.05
MOST_SENT = 100_000
FOUND = pa.struct([("place", pa.int64()), ("parent", pa.int64()), ("kind", pa.string()), ("value", pa.int64())])

# Element names of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements without page text. Of the raw ones the first end tag ends the element, whatever stands before it.
RAW = frozenset("script style textarea title".split())
SILENT = RAW | frozenset("noscript template iframe object svg canvas select option button".split())
NOISE_TAGS = frozenset("nav footer aside form menu search dialog".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

#: Elements that hold text rather than parts of the page; their classes and ids say nothing about noise.
TEXTS = frozenset("h1 h2 h3 h4 h5 h6 hgroup p li dt dd pre blockquote figcaption legend summary address center caption".split())
#: Kinds of blocks by names: wanted, doubtful (only the tree can keep them), noise.
WANTED, DOUBTFUL, NOISE = range(3)

NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer "
    "gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification popup promo promoted promotion recommended related "
    "replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)

COMMENTS_ADVERTS = frozenset(
    "ad ads advert adverts advertisement advertising comment comments disqus promo promoted promotion replies reply respond sponsor sponsored".split()
)
#: Names of what is no part of an article even inside one.
NEVER_TEXT = COMMENTS_ADVERTS | frozenset("breadcrumb breadcrumbs footer menu nav navbar navigation sidebar".split())
#: Text directly in these is no sign that a container holds the page's prose.
LISTED = frozenset("li dt dd td th option legend".split())

#: A quote opens a value only behind an equals sign, and only if it is closed; elsewhere it is a character like others.
ATTRIBUTES = r"""(?:=\s*+(?:"[^"]*+"|'[^']*+')|[^>])*+"""
TAG = re.compile(rf"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)({ATTRIBUTES})(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
NEXT_BLOCK = re.compile(rf"<!--.*?(?:-->|\Z)|</?(?:{'|'.join(sorted(BLOCKS | {'body', 'select', 'datalist'}))})(?=[\s/>]|\Z)", re.I | re.S)
END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for tag in RAW}
OWN = {
    tag: re.compile(rf"""<!--.*?(?:-->|\Z)|<({'|'.join(sorted(RAW))})(?=[\s/>])|<(/?){tag}(?=[\s/>]|\Z)({ATTRIBUTES})(?:>|\Z)""", re.I | re.S)
    for tag in SILENT - RAW
}


def hash64(*parts) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


class Element:
    __slots__ = ("tag", "place", "label", "noise", "article", "number", "prose", "children")

    def __init__(self, tag, place, label, noise, article, number=None):
        self.tag, self.place, self.label, self.noise, self.article = tag, place, label, noise, article
        #: Of a container that only its name makes noise: its number on the page; the characters of prose in it.
        self.number, self.prose = number, 0
        self.children: list[str] = []


class Silences:
    """Where the silent elements of a page end; each search that fails is made once a page."""

    def __init__(self, page: str):
        self.page, self.open_raw, self.pairs, self.last_block = page, set(), {}, False

    def _raw_end(self, tag: str, at: int) -> int | None:
        if tag in self.open_raw:
            return None
        m = END[tag].search(self.page, at)
        if m is None:
            self.open_raw.add(tag)
        return m.end() if m else None

    def _pairs(self, tag: str) -> dict[int, int]:
        """From the start of each ``tag`` that has an end tag of its own to the end of that."""
        if tag not in self.pairs:
            ends, waiting, at = {}, [], 0
            while m := OWN[tag].search(self.page, at):
                at = m.end()
                if m[1]:
                    at = self._raw_end(m[1].lower(), at) or at
                elif m[2]:
                    if waiting:
                        ends[waiting.pop()] = m.end()
                elif m[2] is not None and not m[3].rstrip().endswith("/"):
                    waiting.append(m.start())
            self.pairs[tag] = ends
        return self.pairs[tag]

    def end(self, tag: str, start: int, after: int) -> int:
        """Where to read on behind the element whose start tag lies from ``start`` to ``after``."""
        end = self._raw_end(tag, after) if tag in RAW else self._pairs(tag).get(start)
        if end is not None:
            return end
        at = after
        while not self.last_block:
            m = NEXT_BLOCK.search(self.page, at)
            if m is None:
                self.last_block = True
            elif m[0].startswith("<!--"):
                at = m.end()
            else:
                return m.start()
        return len(self.page) if tag in ("script", "style") else after


class Reader:
    """Reads pages into blocks of text and elements with their places; the tree is kept as a stack."""

    def __init__(self):
        self.places: dict[tuple[int, str], int] = {}
        self.marks: dict[tuple[str, str], tuple[str, int, int, bool, bool]] = {}

    def _marked(self, tag: str, attributes: str) -> tuple[str, int, int, bool, bool]:
        """(label, kind by name outside an article, kind inside one, is the article or main part, may hold the page in spite of its name)."""
        known = self.marks.get((tag, attributes))
        if known is None:
            names: dict[str, str] = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
            words = [w.lower() for v in (names.get("class", ""), names.get("id", ""), names.get("role", "")) for w in WORD.findall(v)]
            article = tag in ("article", "main") or "main" in names.get("role", "").lower().split()
            marks = set() if article or tag in TEXTS or tag in ("html", "body") else NOISE_WORDS.intersection(words)
            outside = NOISE if tag in NOISE_TAGS or tag == "header" or marks else WANTED
            inside = NOISE if tag in NOISE_TAGS or marks & NEVER_TEXT else DOUBTFUL if marks - {"header"} else WANTED
            named = bool(marks) and tag not in NOISE_TAGS and tag != "header" and not marks & COMMENTS_ADVERTS
            # Ids are often made from titles: with them every page would have places of its own.
            label = ".".join([tag, *sorted({w.lower() for w in WORD.findall(names.get("class", ""))})])
            if len(self.marks) > 50_000:
                self.marks.clear()
            known = self.marks[tag, attributes] = (label, outside, inside, article, named)
        return known

    def _place(self, parent: int, label: str) -> int:
        key = (parent, label)
        place = self.places.get(key)
        if place is None:
            if len(self.places) > 50_000:
                self.places.clear()
            place = self.places[key] = hash64(parent, label)
        return place

    def read(self, page: str, holders: frozenset[int] = frozenset()) -> tuple[list[tuple[str, tuple[int, ...], int]], list[tuple[int, int, str]], bool]:
        """(blocks: text, places from the root, kind), (place, parent, style) of elements, has an article.

        ``holders``: numbers of the containers whose names do not count, found by a first reading.
        """
        blocks, elements, n_opened = [], [], 0
        named: list[tuple[int, int]] = []
        root = Element("", 0, "", WANTED, False)
        stack, text, has_article = [root], [], False

        def flush() -> None:
            if text:
                block = " ".join(html_module.unescape("".join(text)).split())
                text.clear()
                if block:
                    top = stack[-1]
                    blocks.append((block, tuple(e.place for e in stack[1:]), top.noise, top.article))
                    if top.tag not in LISTED:
                        top.prose += len(block)

        def pop() -> None:
            e = stack.pop()
            style = " ".join(c for i, c in enumerate(e.children) if i == 0 or c != e.children[i - 1])
            elements.append((e.place, stack[-1].place, style))
            stack[-1].prose += e.prose
            if e.number is not None:
                named.append((e.number, e.prose))

        at, end, silences = 0, len(page), Silences(page)
        while at < end:
            m = TAG.search(page, at)
            if m is None:
                text.append(page[at:])
                break
            if m.start() > at:
                text.append(page[at : m.start()])
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if not m[1] and tag in SILENT:
                if not m[3].rstrip().endswith("/"):
                    at = silences.end(tag, m.start(), at)
                continue
            if tag not in BLOCKS:
                if tag in VOID:
                    text.append(" ")
                continue
            flush()
            if m[1]:
                if any(e.tag == tag for e in stack):
                    while stack[-1].tag != tag:
                        pop()
                    pop()
                continue
            while stack[-1].tag == "p" or stack[-1].tag in CLOSES.get(tag, ()):
                pop()
            if tag in VOID:
                continue
            parent = stack[-1]
            label, noise_outside, noise_inside, article, by_name = self._marked(tag, m[3])
            n_opened += 1
            if by_name and n_opened in holders:
                noise_outside = noise_inside = WANTED
            inside = parent.article or article
            noise = max(parent.noise, noise_inside if inside else noise_outside)
            has_article |= article and noise == WANTED
            parent.children.append(label)
            stack.append(Element(tag, self._place(parent.place, label), label, noise, inside, n_opened if by_name else None))
        flush()
        while len(stack) > 1:
            pop()
        if not has_article and not holders:
            found = frozenset(n for n, prose in named if 2 * prose > root.prose)
            if found:
                return self.read(page, found)
        if has_article:
            blocks = [(text, path, max(kind, WANTED if inside else DOUBTFUL)) for text, path, kind, inside in blocks]
        else:
            blocks = [(text, path, kind) for text, path, kind, _ in blocks]
        return blocks, elements, has_article


def host_of(url):
    """The host of a url in lower case, without www. and port; null without one."""
    host = F.regexp_extract(F.lower(url), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?(?:www\.)?([^/?#:]+)", 1)
    return F.when(F.length(host) > 0, host)


def counted(pages: DataFrame) -> DataFrame:
    """host, place, parent, kind (page, style, content or doubt), value, n: how many different pages of the host have it there."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for part in slices(batches, "html"):
            seen: dict[tuple[str, int], list[dict]] = {}
            for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
                key = (host, hash64(page or ""))
                if key in seen:
                    continue
                blocks, elements, _ = reader.read(page or "")
                found = set()
                for place, parent, style in elements:
                    found.add((place, parent, "page", 0))
                    found.add((place, parent, "style", hash64(style)))
                for text, path, kind in blocks:
                    if path:
                        parent = path[-2] if len(path) > 1 else 0
                        found.add((path[-1], parent, "content", hash64(text)))
                        if kind == DOUBTFUL:
                            found.add((path[-1], parent, "doubt", 0))
                seen[key] = [dict(zip(("place", "parent", "kind", "value"), f)) for f in sorted(found)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in seen], pa.string()), pa.array([d for _, d in seen], pa.int64()), pa.array(seen.values(), pa.list_(FOUND))], ["host", "page", "found"]
            )

    rows = pages.where(F.col("host").isNotNull()).select("host", "html")
    # Copies of a page are alike in all three columns and count once.
    different = rows.mapInArrow(run, "host string, page long, found array<struct<place: long, parent: long, kind: string, value: long>>").distinct()
    return different.select("host", F.inline("found")).groupBy("host", "place", "parent", "kind", "value").agg(F.count(F.lit(1)).alias("n"))


def importance(pages: DataFrame) -> DataFrame:
    """host, place, n_pages, importance, the best importance in the branch, doubtful (some text there is), of every node of every site's tree.

    ``pages`` has host and html.
    """

    def of(kind: str, value):
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, value)), F.lit(0.0))

    n = F.col("n").cast("double")
    nodes = counted(pages).groupBy("host", "place").agg(
        F.max("parent").alias("parent"),
        of("page", n).alias("m"),
        of("style", n).alias("styles"),
        of("style", n * F.log(n)).alias("style_logs"),
        of("content", F.lit(1.0)).alias("features"),
        of("content", F.log(n)).alias("feature_logs"),
        (of("doubt", n) > 0).alias("doubtful"),
    )
    scale = F.log("m")
    look = F.when(F.col("m") > 1, F.when(F.col("styles") > 0, (F.log("styles") - F.col("style_logs") / F.col("styles")) / scale)).otherwise(1.0)
    read = F.when(F.col("features") > 0, F.when(F.col("m") > 1, 1 - F.col("feature_logs") / F.col("features") / scale).otherwise(1.0))
    nodes = nodes.select("host", "place", "parent", "m", F.coalesce(look, F.lit(0.0)).alias("look"), read.alias("read"), "doubtful")

    def compose(group: pa.Table) -> pa.Table:
        rows = {r["place"]: r for r in group.to_pylist()}
        below: dict[int, list[int]] = {}
        for place, r in rows.items():
            below.setdefault(r["parent"], []).append(place)
        done: dict[int, float] = {}
        best: dict[int, float] = {}
        order = [p for p, r in rows.items() if r["parent"] not in rows]
        for place in order:  # grows: parents before children
            order += below.get(place, [])
        for place in reversed(order):
            r = rows[place]
            parts = [(rows[c]["m"], done[c]) for c in below.get(place, [])]
            if r["read"] is not None:
                parts.append((r["m"], r["read"]))
            if below.get(place):
                share = sum(w * v for w, v in parts) / sum(w for w, _ in parts)
                done[place] = (1 - GAMMA) * r["look"] + GAMMA * share
            else:
                done[place] = r["read"] if r["read"] is not None else r["look"]
            best[place] = max([done[place], *(best[c] for c in below.get(place, []))])
        return pa.table(
            {"host": group.column("host").take(pa.array([0] * len(done), pa.int64())), "place": pa.array(done, pa.int64()), "n_pages": pa.array([int(rows[p]["m"]) for p in done], pa.int64()), "importance": pa.array(done.values(), pa.float64()), "best": pa.array([best[p] for p in done], pa.float64()), "doubtful": pa.array([rows[p]["doubtful"] for p in done], pa.bool_())}
        )

    return nodes.groupBy("host").applyInArrow(compose, "host string, place long, n_pages long, importance double, best double, doubtful boolean")


def kept_text(reader: Reader, page: str | None, best: dict[int, float]) -> str:
    """The blocks of a page outside noise, joined by line breaks. ``best``: places of the site with little importance or with doubtful text."""
    blocks, _, has_article = reader.read(page or "")
    limit = NOISE_IN_ARTICLE if has_article else NOISE_ANYWHERE

    def kept(path: tuple[int, ...], kind: int) -> bool:
        if kind == DOUBTFUL:
            return bool(path) and best.get(path[-1], 0.0) >= NOISE_ANYWHERE
        return kind == WANTED and not any(best.get(p, 1.0) < limit for p in path)

    return "\n".join(text for text, path, kind in blocks if kept(path, kind))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    sited = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).withColumn("host", host_of(F.col("url")))
    noise = stored(importance(sited).where((F.col("n_pages") >= MIN_PAGES) & ((F.col("best") < NOISE_ANYWHERE) | F.col("doubtful"))))
    few = noise.limit(MOST_SENT + 1).count() <= MOST_SENT
    sent: dict[str, dict[int, float]] = {}
    if few:
        for r in noise.collect():
            sent.setdefault(r["host"], {})[r["place"]] = r["best"]
    else:
        maps = noise.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("place", "best"))).alias("low")).withColumnRenamed("host", "__host")
        sited = sited.join(maps, F.col("host") == F.col("__host"), "left").drop("__host")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for part in slices(batches, "html"):
            maps = [sent.get(h, {}) for h in part.column("host").to_pylist()] if few else [dict(x or []) for x in part.column("low").to_pylist()]
            texts = [kept_text(reader, page, low) for page, low in zip(part.column("html").to_pylist(), maps)]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    return sited.mapInArrow(run, "page_id long, url string, text string, n_chars long")
