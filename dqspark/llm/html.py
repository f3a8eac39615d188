"""Main text of web pages by deducing the template of each host.

A page is a sequence of tokens: elements, known by the names and classes on the way to them, and texts.
Tokens of one host that share an occurrence vector, the number of times each page has them, form an
equivalence class. A class that enough different pages support and that holds an element is part of the template:
the class of what pages have once is its outer frame, and classes of tokens that repeat are nested in it if
their texts stand in an element of the same class. Texts of the template are boilerplate. The elements of the outer frame cut pages
into slots; a slot that holds links for the most part, over all pages of the host, is a menu. What stands in the
other slots, outside elements that are noise by their names, is the article. ``article`` and ``main`` are a hint: what
is in them is no template, and if they hold the greater part of what is left, they are all of it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dqspark.plans.bounds import is_bounded
from dqspark.plans.joins import salted_join
from dqspark.plans.storage import stored

ROWS = 200
LEAST_SUPPORT = 3
"""Different pages that must have a class, as the method asks: what fewer pages share may be an article."""
SHARE = 0.5
"""The share of a host's different pages that must have a class."""
MENU_SHARE = 0.8
"""The share of link text from which a slot is a menu."""

# Element names, roles and class words, by HTML and by custom.
RAW = "script|style|noscript|template|iframe|textarea|title"
NOISE = set(
    "nav footer aside script style noscript template iframe svg math object select button textarea input"
    " dialog menu title head canvas audio video label option".split()
)
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
WORDS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent"
    " gdpr notice notices alert sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment"
    " comments commentlist respond disqus reply replies related recommended share sharing social newsletter"
    " subscribe subscription popup modal overlay login signup widget widgets pagination pager toolbar".split()
)
BESIDE = set(
    "site page main top bottom left right primary secondary global user reader post article box bar block container"
    " wrapper wrap inner outer list area section links link items item panel content header form unit slot".split()
)
"""Words that may stand beside such words in a name; ``has``, ``no`` or ``work`` change what a name says."""
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr button label select option input svg math object audio video".split()
)
CLOSES_P = set(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section"
    " table ul".split()
)
MAIN = {"article", "main"}
BLANK = re.compile(r"\s+")
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?P<rattr>[^>]*)>(?P<body>.*?)(?:</(?P=raw)\s*[^>]*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attr>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attr2>[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
CAMEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass(slots=True)
class Element:
    """An element of a page: its token, the place of its parent, and what its start tag says of it."""

    name: str
    token: int
    parent: int
    noise: bool = False
    """No part of an article, nor is anything in it."""
    suspect: bool = False
    """Noise, unless it holds every article of the page."""
    main: bool = False
    in_link: bool = False
    mains: int = 0
    chars: int = 0
    link_chars: int = 0


@dataclass(slots=True)
class Block:
    """The text of a block and the place of the element it begins in."""

    text: str
    place: int
    link_chars: int


@dataclass
class Page:
    elements: list[Element] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)


def hashed(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - 2**63


def names_noise(value: str) -> bool:
    """Whether a class or an id as a whole is the name of noise: ``cookie-notice``, but not ``has-sidebar``."""
    for name in value.split():
        words = [w.lower() for w in CAMEL.findall(name)]
        if any(w in WORDS for w in words) and all(w in WORDS or w in BESIDE for w in words):
            return True
    return False


def started(name: str, attributes: str, parent: int, above: Element | None) -> Element:
    """The element that a start tag opens."""
    element = Element(name, 0, parent)
    classes = []
    element.noise = (above is not None and above.noise) or name in NOISE
    element.suspect = name == "form" or (name == "header" and not (above and above.main))
    element.main = name in MAIN or (above is not None and above.main)
    element.in_link = name == "a" or (above is not None and above.in_link)
    for key, a, b, c in ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), (a or b or c)
        low = value.lower()
        if key == "hidden" or (key == "aria-hidden" and low == "true"):
            element.noise = True
        elif key == "role":
            element.main = element.main or low in ("main", "article")
            element.noise = element.noise or (low in ROLES and low != "form")
            element.suspect = element.suspect or low == "form"
        elif key == "itemprop":
            element.main = element.main or low == "articlebody"
        elif key == "style":
            hides = re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)
            element.noise = element.noise or hides is not None
        elif key in ("class", "id") and name not in ("html", "body") and name not in MAIN and name not in HEADINGS:
            element.suspect = element.suspect or names_noise(value)
        if key == "class":
            classes += [w for w in value.split() if not any(ch.isdigit() for ch in w)]
    element.token = hashed(f"{above.token if above else 0}/{name}.{'.'.join(sorted(classes))}")
    return element


def clean(text: str) -> str:
    return BLANK.sub(" ", html.unescape(text)).strip()


def parsed(source: str) -> Page:
    """The elements of a page, parents before their children, and the texts of its blocks outside certain noise.

    Elements left open end with their parent or, paragraphs and list items, where the next one begins; the end tag of
    no element only ends a block. An open comment or tag runs to the end of the page. Once all is read it is known which
    elements hold the articles: those that hold every one are no noise, whatever their classes say. The characters
    of blocks that are neither noise nor in an article are added up for each element around them.
    """
    page, stack, parts = Page(), [], []
    elements = page.elements
    place, in_main, at = -1, False, 0

    def close() -> None:
        if text := clean("".join(t for t, _ in parts)):
            page.blocks.append(Block(text, place, sum(len(t) for t, linked in parts if linked)))
        parts.clear()

    def add(text: str) -> None:
        nonlocal place, in_main
        top = stack[-1] if stack else -1
        if top >= 0 and elements[top].noise:
            return
        main = top >= 0 and elements[top].main
        if main != in_main:
            close()
            in_main = main
        if not parts:
            place = top
        parts.append((text, top >= 0 and elements[top].in_link))

    for found in TOKEN.finditer(source):
        if found.start() > at:
            add(source[at : found.start()])
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if found["raw"] or not name:
            continue
        if found["end"] or found["end2"]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if elements[stack[i]].name == name), None)
            if depth is not None:
                if any(elements[i].name not in INLINE for i in stack[depth:]):
                    close()
                del stack[depth:]
            elif name not in INLINE:
                close()
            continue
        attributes = found["attr"] or found["attr2"] or ""
        if name in CLOSES_P or name == "li":
            inside = "li" if name == "li" else "p"
            for i in range(len(stack) - 1, -1, -1):
                if elements[stack[i]].name == inside:
                    del stack[i:]
                    break
                if elements[stack[i]].name not in INLINE:
                    break
        if name not in INLINE:
            close()
        parent = stack[-1] if stack else -1
        element = started(name, attributes, parent, elements[parent] if stack else None)
        if name == "br" and not element.noise:
            add(" ")
        elements.append(element)
        # A slash ends a tag unless it is part of a value without quotes.
        if name not in VOID and attributes != "/" and not attributes.endswith(('"/', "'/", " /")):
            stack.append(len(elements) - 1)
    if at < len(source):
        add(source[at:])
    close()

    for element in reversed(elements):
        if element.main and not element.noise and not (element.parent >= 0 and elements[element.parent].main):
            element.mains += 1
        if element.parent >= 0:
            elements[element.parent].mains += element.mains
    total = sum(e.mains for e in elements if e.parent < 0)
    for element in elements:
        above = elements[element.parent] if element.parent >= 0 else None
        # Within an article, nothing holds all of the page's articles but what nests them.
        wraps = total > 0 and element.mains == total and not (above and above.main)
        element.noise = element.noise or (element.suspect and not wraps) or (above is not None and above.noise)
    page.blocks = [b for b in page.blocks if b.place < 0 or not elements[b.place].noise]
    for b in page.blocks:
        if b.place >= 0 and not elements[b.place].main:
            elements[b.place].chars += len(b.text)
            elements[b.place].link_chars += b.link_chars
    for element in reversed(elements):
        if element.parent >= 0:
            elements[element.parent].chars += element.chars
            elements[element.parent].link_chars += element.link_chars
    return page


def counted(page: Page) -> list[tuple[int, int, int, int, int | None]]:
    """``(token, n, chars, link chars, around)`` of a page's elements and, with the token around them, its texts outside articles."""
    rows: dict[tuple[int, int | None], list[int]] = {}
    for e in page.elements:
        row = rows.setdefault((e.token, None), [0, 0, 0])
        row[0], row[1], row[2] = row[0] + 1, row[1] + e.chars, row[2] + e.link_chars
    for b in page.blocks:
        around = page.elements[b.place] if b.place >= 0 else None
        if around is not None and not around.main:
            rows.setdefault((hashed(f"{around.token} {b.text}"), around.token), [0, 0, 0])[0] += 1
    return [(token, *row, around) for (token, around), row in rows.items()]


def with_host(pages: DataFrame, url: str, html_column: str) -> DataFrame:
    """``pages`` with ``_host``, NULL where the address has none, and ``_html``, empty for NULL."""
    host = F.lower(F.regexp_extract(F.col(url).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1))
    return pages.withColumns({
        "_host": F.when(host != "", host), "_html": F.coalesce(F.col(html_column).cast("string"), F.lit(""))
    })


def with_elements(pages: DataFrame) -> DataFrame:
    """``(host, page, _html)`` of the rows with a host and an element, ``page`` being a hash of the whole page."""
    some = pages.filter(F.col("_host").isNotNull() & F.col("_html").rlike("<[A-Za-z]"))
    return some.select(F.col("_host").alias("host"), F.xxhash64("_html").alias("page"), "_html")


def different_pages(some: DataFrame, copies: DataFrame) -> DataFrame:
    """``some`` with each page of a host once; ``copies`` has the number of rows of each.

    Only pages that have copies are shuffled, if the list of these passes the size check, else all.
    """
    again = copies.filter("n > 1").select("host", "page", F.lit(True).alias("again"))
    if not is_bounded(again):
        return some.dropDuplicates(["host", "page"])
    marked = some.join(F.broadcast(again), ["host", "page"], "left")
    once = marked.filter("again IS NULL").drop("again")
    return once.unionByName(marked.filter("again").drop("again").dropDuplicates(["host", "page"]))


def equivalence_classes(pages: DataFrame) -> DataFrame:
    """``(host, token, around, pages, most, chars, link_chars, vector)`` of the tokens of different ``(host, page, _html)``.

    Tokens of a host with the same ``vector`` are one class. It stands for the occurrence vector by the sum
    of hashes of page and count, in two halves, so tasks merge their parts before the shuffle and the
    pages of a host are never gathered. ``pages`` is the number of pages with the token and ``most`` its greatest count in
    one; a text has the token ``around`` it, which elements have not.
    """
    names = ["host", "page", "token", "n", "chars", "link_chars", "around"]
    kinds = [pa.string(), *[pa.int64()] * 6]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                rows = [
                    (host, key, *row)
                    for host, key, source in zip(*(c.to_pylist() for c in some.columns), strict=True)
                    for row in counted(parsed(source))
                ]
                if rows:
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    seen = pages.mapInArrow(
        read, "host string, page long, token long, n long, chars long, link_chars long, around long"
    )
    place = F.xxhash64("page", "n")
    return seen.groupBy("host", "token", "around").agg(
        F.count("*").alias("pages"),
        F.max("n").alias("most"),
        F.sum("chars").alias("chars"),
        F.sum("link_chars").alias("link_chars"),
        F.struct(
            F.sum(F.shiftright(place, 32)).alias("high"), F.sum(place.bitwiseAND(F.lit(2**32 - 1))).alias("low")
        ).alias("vector"),
    )


def templates(pages: DataFrame) -> DataFrame:
    """``(host, texts, menus)`` of each host with a template: the hashes of its texts, and the elements that are menus.

    A class is valid if ``LEAST_SUPPORT`` pages and the ``SHARE`` of the host's pages have it and an element frames it:
    in the outer frame, whose tokens come once, any element of the class; in a nested one the very element around the text. A
    token of the template is on a large part of the host's pages, so the lists are about as long as a page.
    """
    some = with_elements(pages)
    copies = stored(some.groupBy("host", "page").agg(F.count("*").alias("n")), "copies")
    classes = stored(equivalence_classes(different_pages(some, copies)), "classes")
    hosts = copies.groupBy("host").agg(F.count("*").alias("all_pages"))
    valid = classes.join(hosts, "host").filter((F.col("pages") >= LEAST_SUPPORT) & (F.col("pages") >= SHARE * F.col("all_pages")))
    elements = valid.filter("around IS NULL")
    texts = valid.filter("around IS NOT NULL")
    frames = elements.filter("most = 1").select("host", "vector").distinct()
    outer = texts.filter("most = 1").join(frames, ["host", "vector"], "left_semi").select("host", "token")
    holders = elements.select("host", F.col("token").alias("around"), "vector")
    nested = texts.filter("most > 1").join(holders, ["host", "around", "vector"], "left_semi").select("host", "token")
    found = outer.unionAll(nested).groupBy("host").agg(F.collect_set("token").alias("texts"))
    menus = elements.filter((F.col("most") == 1) & (F.col("chars") > 0) & (F.col("link_chars") >= MENU_SHARE * F.col("chars")))
    menus = menus.groupBy("host").agg(F.collect_set("token").alias("menus"))
    return found.join(menus, "host", "full")


def main_text(source: str, texts: set[int], menus: set[int]) -> str:
    """The article of a page: its blocks that are neither noise nor template, joined by line breaks.

    Blocks outside ``article`` and ``main`` are template if they are texts of it or stand in one of its menus. What is left
    of them belongs to the article too, unless such elements hold the greater part of the text; a teaser does not.
    """
    page = parsed(source)
    linked: list[bool] = []
    for e in page.elements if menus else ():
        linked.append(e.token in menus or (e.parent >= 0 and linked[e.parent]))
    kept: list[tuple[str, bool]] = []
    for b in page.blocks:
        around = page.elements[b.place] if b.place >= 0 else None
        main = around is not None and around.main
        if around is not None and not main:
            if (menus and linked[b.place]) or (texts and hashed(f"{around.token} {b.text}") in texts):
                continue
        kept.append((b.text, main))
    inside = sum(len(t) for t, main in kept if main)
    whole = 2 * inside <= sum(len(t) for t, _ in kept)
    return "\n".join(t for t, main in kept if main or whole)


def extract_pages(pages: DataFrame, url: str = "url", html_column: str = "html") -> DataFrame:
    """``pages`` without the html column but with ``text``, the main text, and ``n_chars``, its code points.

    NULL and empty pages have an empty text, and so have pages that are all noise or template; neither they nor repeated
    pages count for a template. Pages without an address have no host and no template, nor have hosts of fewer than
    ``LEAST_SUPPORT`` different pages, as no class has that support. Equal pages of a host have equal texts;
    repeated rows are repeated. An empty table gives an empty result. Columns named as the results are
    replaced. Templates are broadcast if their size passes a check, else joined by host in salted parts.
    """
    rows = with_host(pages.drop(*[c for c in ("text", "n_chars") if c != html_column]), url, html_column)
    known = stored(templates(rows), "templates")
    kept = [c for c in rows.columns if c not in ("_host", "_html", html_column)]
    found = known.select(F.col("host").alias("_host"), "texts", "menus")
    lists = F.coalesce(F.size("texts"), F.lit(0)) + F.coalesce(F.size("menus"), F.lit(0))
    if is_bounded(found, lists * 8 + 64):
        joined = rows.join(F.broadcast(found), "_host", "left")
    else:
        joined = salted_join(rows, found, ["_host"], "left")
    joined = joined.select(*kept, F.col("texts").alias("_texts"), F.col("menus").alias("_menus"), "_html")
    names = [*kept, "text", "n_chars"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                given = zip(*(batch.column(len(kept) + i).to_pylist() for i in range(3)), strict=True)
                texts = [main_text(page, set(known or ()), set(menus or ())) for known, menus, page in given]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(texts, pa.string()), sizes], names)

    made = StructType.fromDDL("text string, n_chars long")
    return joined.mapInArrow(read, StructType(joined.select(*kept).schema.fields + made.fields))
