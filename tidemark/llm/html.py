"""HTML extraction by union-free regular-expression inference.

The pages of a host come from a few templates. All of them are read as streams of block tags and text. A stream is folded where it repeats itself, so that a list of any length becomes one repeated group, and then the
streams are aligned one after another: what stands in both stays, text that differs becomes a slot, and what stands in
one only becomes optional. The result is the host's wrapper, a regular expression without alternatives, kept as a
tree. In it the article is chosen once per host: the element whose slots hold the text. Every page of the host is then
read along the wrapper, and the article's text is taken. Elements that name themselves menus, adverts, comments and
the like are left out, and of what the template repeats only calls such as `Share this`; titles, section headings and
paragraphs that pages have in common stay. A page whose article lies outside of what the wrapper takes is read along a
wrapper of its own.

Every task aligns the pages it reads, host by host, into partial wrappers; these are aligned in rounds, a few at a time,
to one of each host. Pages are not shuffled for that. They meet their wrapper in a plain join on the host, whose hot keys
adaptive execution splits, or which is a broadcast where the wrappers are measured to be small.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher
from functools import lru_cache, reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.batches import bounded_batches, slices
from tidemark.llm.text import Shelf

#: A text is the template's if so many pages, and all of them, have it in the same place.
TEMPLATE_PAGES = 3
#: Partial wrappers that are aligned at a time, and hosts and distinct pages that a task remembers before it hands on.
ALIGNED = 16
MOST_HOSTS = 512
MOST_PAGES = 100_000
#: Parts of a wrapper. Beyond, the lightest optional ones go, and pages that hold their article in them are read on their own.
MOST_PARTS = 2000
#: A constant of more characters is kept as a digest.
LONG_TEXT = 80
SLICE_BYTES = 4 << 20
#: Elements deeper than this have no node of their own, but those that tell the article from the rest have one up to twice as deep.
MOST_DEPTH = 120

# Names of HTML elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q ruby rt rp s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "head script style noscript template nav header footer aside form button select option textarea input iframe object "
    "svg canvas audio video dialog menu map math".split()
)
CLOSES_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
# Words in a class, an id or a role that name what is not the article.
NOT_ARTICLE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disclaimer disqus footer form gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice "
    "notices notification overlay pagination paywall popup promo promoted promotion reader-comments related "
    "reply replies search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toc toolbar "
    "widget widgets complementary contentinfo alert".split()
)
_HEADING = re.compile(r"h[1-6]\b")
#: A call that is no part of an article where a template repeats it: nothing but such words.
_CALL = re.compile(
    r"(?:share|subscribe|sign\s?up|log\s?in|skip|reply|sponsored|advertisement|advert|ad)"
    r"(?:\W+(?:this|it|us|here|now|to|on|via|by|for|our|the|ad|article|page|post|story|content|email|newsletter|facebook|twitter))*\W*",
    re.I,
)
TELLING = frozenset("article main h1".split())
ARTICLE = frozenset("article main content post entry story body text".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(?P<raw>script|style|textarea|noscript|template|iframe|svg|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
# Parts of a class that say what an element is for, not what it holds, and parts that deny or mention.
PLAIN = frozenset(
    "area bar block body bottom box button buttons cell col column container content group holder inner item items left link "
    "links list outer panel right row section slot text title top unit wrap wrapper zone".split()
)
MENTIONS = frozenset("has hide hidden no not show with without".split())
#: Elements that are dropped unless they hold most of the page's text and what the article is known by.
SPARED = frozenset("form header aside".split())


@dataclass
class Element:
    """An element of one page: its key, and blocks of text and elements in page order."""

    key: str
    children: list[Element | str] = field(default_factory=list)
    depth: int = 0
    junk: bool = False


def _names(rest: str) -> str:
    """Class, id and role of a tag in lower case; numbers in them, as in ids that count, do not distinguish."""
    found = sorted((m[1].lower(), (m[2] or m[3] or m[4] or "").lower()) for m in _NAMED.finditer(rest))
    return " ".join(re.sub(r"\d+", "#", v) for _, v in found).strip()


def parse(page: str) -> Element:
    """The page's block elements and text blocks. Inline tags only go on with the block, unless they name themselves junk."""
    root = Element("")
    # All open elements by name. Those without a node stand with the node that takes their text, so end tags find their own.
    stack, tags, text, at, articles = [root], [""], [], 0, 0
    opened = Counter(tags)

    def flush() -> None:
        block = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if block:
            stack[-1].children.append(block)

    def close(name: str) -> None:
        if opened[name]:
            flush()
            while True:
                stack.pop()
                opened[tags[-1]] -= 1
                if tags.pop() == name:
                    break

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if m["end"]:
            if name not in INLINE or opened[name]:
                flush()
                close(name)
            continue
        names = _names(m["rest"]) if "=" in m["rest"] else ""
        if name in INLINE and not _is_junk(f"{name} {names}"):
            continue
        flush()
        if name in VOID:
            continue
        if name not in INLINE and opened["p"] and _in_reach(tags):
            close("p")
        if name == "body":
            close("head")
        for other in CLOSES_ITSELF.get(name, ()):
            if tags[-1] == other:
                close(other)
        # A further article that names itself a comment or the like is no article.
        shown = name
        if name == "article":
            shown = "div" if articles and _is_junk(f"div {names}") else name
            articles += shown == name
        element = Element(f"{shown} {names}".strip(), depth=stack[-1].depth + 1)
        telling = shown in TELLING or _is_junk(element.key) and not _is_junk(stack[-1].key)
        if element.depth < MOST_DEPTH or telling and element.depth < 2 * MOST_DEPTH:
            stack[-1].children.append(element)
        else:
            element = stack[-1]
        stack.append(element)
        tags.append(name)
        opened[name] += 1
    text.append(page[at:])
    flush()
    _find_junk(root)
    return root


#: Elements that an open paragraph outside of them is not closed from.
_OWN_PARAGRAPHS = set("applet button caption html marquee object table td template th".split())


def _in_reach(tags: list[str]) -> bool:
    """Whether a block that begins here ends an open paragraph."""
    for name in reversed(tags):
        if name == "p" or name in _OWN_PARAGRAPHS:
            return name == "p"
    return False


def _find_junk(root: Element) -> None:
    """Mark elements that name themselves junk, but none that holds most of the page's text and all that tells an article."""
    held: dict[int, tuple[int, int]] = {}

    def weigh(element: Element) -> tuple[int, int]:
        size, telling = 0, int(element.key.partition(" ")[0] in TELLING)
        for child in element.children:
            more = (len(child), 0) if isinstance(child, str) else weigh(child)
            size, telling = size + more[0], telling + more[1]
        name = element.key.partition(" ")[0]
        telling = 0 if name in ("header", "aside") else telling
        held[id(element)] = (0, 0) if name in DROPPED and name not in SPARED else (size, telling)
        return held[id(element)]

    total, marks = weigh(root)

    def mark(element: Element) -> None:
        for child in element.children:
            if not isinstance(child, str):
                if _is_junk(child.key):
                    size, telling = held[id(child)]
                    child.junk = size * 2 <= total or telling < min(marks, 1)
                mark(child)

    mark(root)


@lru_cache(100_000)
def _is_junk(key: str) -> bool:
    """Whether an element by its name, class, id or role is no part of an article.

    Of a class in parts, as `reader-comments` or `ad-box`, the last part counts that says what the element holds.
    """
    name, _, names = key.partition(" ")
    if name in DROPPED:
        return True
    if name in ("html", "body", "main", "article"):
        return False
    for token in names.split():
        parts = _WORD.findall(token)
        if not parts or parts[0] in MENTIONS:
            continue
        while len(parts) > 1 and parts[-1] in PLAIN:
            parts.pop()
        if parts[-1] in NOT_ARTICLE:
            return True
    return False


@dataclass
class Item:
    """A part of a wrapper: an element, a repeated group of elements (no key), or text, a constant or a slot."""

    key: str
    items: list[Item] = field(default_factory=list)
    text: str | None = None
    many: bool = False
    optional: bool = False
    mass: int = 0
    main: bool = False


TEXT = "#"


def fold(element: Element, junk: bool = False) -> Item:
    """A page's element as a wrapper: neighbours of one kind, or in turns of two or three kinds, are one repeated group.

    The mass of an item is its text outside junk.
    """
    items: list[Item] = []
    junk = junk or element.junk
    for child in element.children:
        item = Item(TEXT, text=_told(child), mass=0 if junk else len(child)) if isinstance(child, str) else fold(child, junk)
        _append(items, item)
    return Item(element.key, items, mass=sum(i.mass for i in items))


def _told(text: str) -> str:
    return text if len(text) <= LONG_TEXT else hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=16).hexdigest()


def _append(items: list[Item], item: Item) -> None:
    if items and items[-1].key == item.key:
        items[-1] = align(items[-1], item)
        items[-1].many = True
        return
    items.append(item)
    for period in (2, 3):
        last = items[-period:]
        if len(items) > period and items[-period - 1].key == "" and [i.key for i in items[-period - 1].items] == [i.key for i in last]:
            group = items[-period - 1]
            group.items = [align(a, b) for a, b in zip(group.items, last)]
            group.mass = sum(i.mass for i in group.items)
            del items[-period:]
        elif len(items) >= 2 * period and [i.key for i in items[-2 * period : -period]] == [i.key for i in last]:
            both = [align(a, b) for a, b in zip(items[-2 * period : -period], last)]
            items[-2 * period :] = [Item("", both, many=True, mass=sum(i.mass for i in both))]


def align(a: Item, b: Item) -> Item:
    """The wrapper of what both wrappers match. Both have the same key."""
    out = Item(a.key, many=a.many or b.many, optional=a.optional or b.optional, mass=a.mass + b.mass)
    if a.key == TEXT:
        out.text = a.text if a.text == b.text and not out.many else None
        return out
    left, right = [_shape(i) for i in a.items], [_shape(i) for i in b.items]
    if left == right:
        out.items = [align(x, y) for x, y in zip(a.items, b.items)]
        return out
    for kind, i, j, k, n in SequenceMatcher(None, left, right, autojunk=False).get_opcodes():
        if kind == "equal":
            out.items += [align(x, y) for x, y in zip(a.items[i:j], b.items[k:n])]
        else:
            for x in (*a.items[i:j], *b.items[k:n]):
                x.optional = True
                if out.items and _shape(out.items[-1]) == _shape(x):
                    out.items[-1] = align(out.items[-1], x)
                    out.items[-1].many = True
                else:
                    out.items.append(x)
    return out


def _shape(item: Item) -> str:
    return item.key or "|".join(i.key for i in item.items)


@dataclass
class Partial:
    """The wrapper of some pages of a host, as yet unmarked, with the number of distinct pages, up to TEMPLATE_PAGES."""

    wrapper: Item
    pages: frozenset[str]

    def join(self, other: Partial) -> Partial:
        joined = align(self.wrapper, other.wrapper)
        _lighten(joined)
        return Partial(joined, frozenset(sorted(self.pages | other.pages)[:TEMPLATE_PAGES]))


def partial(page: str) -> Partial:
    return Partial(fold(parse(page)), frozenset([_digest(page)]))


def _digest(page: str) -> str:
    return hashlib.blake2b(page.encode("utf-8", "replace"), digest_size=8).hexdigest()


def _lighten(wrapper: Item) -> None:
    """Drop the lightest optional parts of a wrapper that has too many."""

    def parts(item: Item) -> Iterator[Item]:
        for i in item.items:
            yield i
            yield from parts(i)

    def keep(item: Item, least: int) -> None:
        item.items = [i for i in item.items if not i.optional or i.mass > least]
        for i in item.items:
            keep(i, least)

    found = list(parts(wrapper))
    if len(found) > MOST_PARTS:
        masses = sorted(i.mass for i in found if i.optional)
        if masses:
            keep(wrapper, masses[len(masses) // 2])


def finished(found: Partial) -> Item:
    """The wrapper with its article marked."""
    wrapper = found.wrapper
    _keep_constants(wrapper, len(found.pages) >= TEMPLATE_PAGES)
    mark_article(wrapper)
    _keep_calls(wrapper)
    return wrapper


def infer(pages: list[str]) -> Item:
    """The wrapper of some pages of one host, with its article marked."""
    found = [partial(page) for page in dict.fromkeys(pages)]
    return finished(reduce(Partial.join, found)) if found else Item("", main=True)


def _slots(item: Item) -> int:
    """The mass of the text in which pages differ."""
    if item.text is not None:
        return 0
    return item.mass if item.key == TEXT else sum(map(_slots, item.items))


def _keep_calls(item: Item, inside: bool = False) -> None:
    """Of the constants only calls in an article are needed on; where all articles are one, they may be its own."""
    inside = inside or item.main and _slots(item) > 0
    for i in item.items:
        if i.text is not None and not (inside and not _HEADING.match(item.key) and _CALL.fullmatch(i.text)):
            i.text = None
        _keep_calls(i, inside)


def _keep_constants(item: Item, enough: bool, inside: bool = True) -> None:
    """Only text that every page has in this one place is the template's."""
    sure = inside and not item.many and not item.optional
    if item.key == TEXT and not (enough and sure):
        item.text = None
    for i in item.items:
        _keep_constants(i, enough, sure)


def mark_article(wrapper: Item) -> None:
    """Mark the element that is the article: the one named so that holds most text, or the innermost that holds most of it.

    Text that the template repeats does not count, unless nearly all is repeated, as in copies of one article.
    """
    copies = _slots(wrapper) * 3 < wrapper.mass

    def mass(item: Item) -> int:
        return item.mass if copies else _slots(item)

    def elements(item: Item) -> Iterator[tuple[Item, int]]:
        for i in item.items:
            if i.key != TEXT and i.mass:
                if i.key:
                    yield i, mass(i)
                yield from elements(i)

    total = mass(wrapper)
    found = list(elements(wrapper))
    for name in ("article", "main"):
        named = [(m, i) for i, m in found if i.key.partition(" ")[0] == name or name in i.key.split(" ")[1:]]
        best = max((i for _, i in named), key=lambda i: i.mass, default=None)
        if best and (best.mass * 3 >= wrapper.mass or any(i is best and m * 3 >= total > 0 for m, i in named)):
            best.main = True
            return
    called = [(m, i) for i, m in found if ARTICLE & set(_WORD.findall(i.key.partition(" ")[2])) and m * 2 >= total > 0]
    if called:
        min(called, key=lambda x: x[0])[1].main = True
        return
    at = wrapper
    while True:
        heavy = [i for i in at.items if i.key != TEXT and mass(i) * 10 >= total * 8 > 0 and not i.many]
        if not heavy or any(i.key.partition(" ")[0] == "h1" and i.mass for i in at.items):
            break
        at = heavy[0]
    at.main = True


def partial_to_json(found: Partial) -> str:
    def plain(i: Item) -> list:
        return [i.key, i.text, int(i.many) + 2 * int(i.optional), i.mass, [plain(x) for x in i.items]]

    return json.dumps([plain(found.wrapper), sorted(found.pages)], ensure_ascii=False, separators=(",", ":"))


def partial_from_json(told: str) -> Partial:
    def item(x: list) -> Item:
        return Item(x[0], [item(i) for i in x[4]], text=x[1], many=bool(x[2] & 1), optional=bool(x[2] & 2), mass=x[3])

    wrapper, pages = json.loads(told)
    return Partial(item(wrapper), frozenset(pages))


def to_json(item: Item) -> str:
    def plain(i: Item) -> list:
        return [i.key, i.text, i.main, [plain(x) for x in i.items]]

    return json.dumps(plain(item), ensure_ascii=False, separators=(",", ":"))


@lru_cache(512)
def from_json(told: str) -> Item:
    def item(x: list) -> Item:
        return Item(x[0], [item(i) for i in x[3]], text=x[1], main=x[2])

    return item(json.loads(told))


def _walk(element: Element, wrapper: Item) -> Iterator[tuple[Element | str, Item | None]]:
    """Each child with the part of the wrapper that matches it, in order; groups are open to all their parts."""
    flat = [i for x in wrapper.items for i in (x.items if x.key == "" else [x])]
    at = 0
    for child in element.children:
        key = TEXT if isinstance(child, str) else child.key
        order = (*range(at, len(flat)), *range(at))
        hit = next((i for i in order if flat[i].key == key), None)
        at = at if hit is None else hit
        yield child, None if hit is None else flat[hit]


def _articles(element: Element, wrapper: Item) -> Iterator[tuple[Element, Item]]:
    if wrapper.main:
        yield element, wrapper
        return
    for child, item in _walk(element, wrapper):
        if item is not None and not isinstance(child, str):
            yield from _articles(child, item)


def _blocks(element: Element, wrapper: Item | None) -> Iterator[str]:
    pairs = _walk(element, wrapper) if wrapper else ((c, None) for c in element.children)
    for child, item in pairs:
        if isinstance(child, str):
            if item is None or item.text != child:
                yield child
        elif not child.junk or _is_title(child):
            yield from _blocks(child, item)


def _is_title(element: Element) -> bool:
    """A header inside the article that holds its heading is part of it."""
    return element.key.partition(" ")[0] == "header" and any(
        isinstance(c, Element) and c.key.partition(" ")[0] in ("h1", "h2") for c in element.children
    )


def _is_named(element: Element) -> bool:
    return element.key.partition(" ")[0] in ("article", "main")


def _misses(root: Element, taken: list[Element]) -> bool:
    """Whether a named article lies outside of what was taken, or most of the page's text does."""
    inside, outside, missed, named = 0, 0, 0, False
    chosen = {id(e) for e in taken}

    def size(element: Element) -> int:
        return sum(len(c) if isinstance(c, str) else 0 if c.junk else size(c) for c in element.children)

    def holds(element: Element) -> bool:
        return any(not isinstance(c, str) and (id(c) in chosen or holds(c)) for c in element.children)

    def walk(element: Element, within: bool) -> None:
        nonlocal inside, outside, missed, named
        for child in element.children:
            if isinstance(child, str):
                outside += len(child)
            elif id(child) in chosen:
                inside += size(child)
                named = named or within or _is_named(child)
            elif not child.junk or holds(child):
                article = child.key.partition(" ")[0] == "article"
                if article and not holds(child):
                    missed = max(missed, size(child))
                walk(child, within or article)

    walk(root, False)
    return missed > (inside if named else 0) or not named and outside > inside


def extract(page: str, wrapper: Item) -> str:
    """The article's blocks, joined by one space."""
    root = parse(page)
    taken = list(_articles(root, wrapper))
    text = " ".join(b for e, i in taken for b in _blocks(e, i))
    if not wrapper.main and (not text or _misses(root, [e for e, _ in taken])):
        own = finished(Partial(fold(root), frozenset([page])))
        text = " ".join(b for e, i in _articles(root, own) for b in _blocks(e, i))
    return text


def host_of(url: str):
    """Column: the host of a URL in lower case, without user and port; empty if there is none."""
    place = F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#\s]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(place, r"^.*@", ""), r":\d*$", ""))


def extract_text(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """One row per row of `pages`: page_id, url and `text`, the main text of the whole page.

    A wrapper is inferred from all pages of each host and applied to every page; a page whose article lies outside of what it
    takes is read along a wrapper of its own. A null or empty page, or one without an article, has an empty text. Pages whose URL is null or
    names no host count as one host. Ids may be null or repeated. Without rows the result is empty. Other columns of
    `pages`, whatever their names, are not looked at.
    """
    bounded_batches(pages.sparkSession)
    shelf = Shelf(pages.sparkSession, "html")
    given = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{url_col}`").alias("url"),
        F.col(f"`{html_col}`").cast("string").alias("html"),
    ).withColumn("host", host_of("url"))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Partial] = {}
        seen: set[tuple[str, str]] = set()

        def handed() -> pa.RecordBatch:
            told = pa.RecordBatch.from_arrays(
                [pa.array(held, pa.string()), pa.array(map(partial_to_json, held.values()), pa.string())], ["host", "partial"]
            )
            held.clear()
            seen.clear()
            return told

        for part in slices(batches, "html", SLICE_BYTES):
            for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
                mark = host, _digest(page)
                if mark not in seen:
                    found = partial(page)
                    held[host] = held[host].join(found) if host in held else found
                    seen.add(mark)
            if len(held) > MOST_HOSTS or len(seen) > MOST_PAGES:
                yield handed()
        if held:
            yield handed()

    def align_some(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        found = reduce(Partial.join, map(partial_from_json, sorted(frame["partial"])))
        return pd.DataFrame({"host": [key[0]], "partial": [partial_to_json(found)]})

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [to_json(finished(partial_from_json(p))) for p in batch.column("partial").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(told, pa.string())], ["wrapped", "wrapper"])

    filled_pages = given.filter(F.length("html") > 0).select("host", "html")
    partials = shelf.put(filled_pages.mapInArrow(collect, "host string, partial string"), "partials")
    while (most := partials.groupBy("host").count().agg(F.max("count")).first()[0] or 1) > 1:
        salt = F.pmod(F.xxhash64("partial"), F.lit((most + ALIGNED - 1) // ALIGNED)).alias("salt")
        aligned = partials.groupBy("host", salt).applyInPandas(align_some, "host string, partial string")
        partials = shelf.put(aligned, "partials")
    wrappers = shelf.put(partials.mapInArrow(finish, "wrapped string, wrapper string"), "wrappers")
    joined = given.join(wrappers, F.col("host") == F.col("wrapped"), "left").select("page_id", "url", "html", "wrapper")
    schema = T.StructType([given.schema["page_id"], given.schema["url"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html", SLICE_BYTES):
            told = zip(part.column("html").to_pylist(), part.column("wrapper").to_pylist())
            texts = [extract(page, from_json(wrapper)) if page and wrapper else "" for page, wrapper in told]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    return joined.mapInArrow(run, schema)
