"""Main text of pages by template deduction from equivalence classes of tokens.

Tokens of a page are its elements, told apart by their path and place among equal siblings, and its blocks of text. Tokens
with the same occurrence vector over the pages of a host (as often as each other on every
page) form a class. Classes that most pages of the host have are taken for its template if they
are valid, that is, if the element each token lies in belongs to the template too, so that classes nest.
What the template says (a text in one class with the element that holds it) is not content; the slots
it leaves, less those that its elements mark as something other than the article, are the text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.arrow import texts_of
from smelter.llm.columns import Aside, quoted
from smelter.scratch import discard, stage

# Elements of the HTML standard by what they do
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br area embed nobr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
SCOPES = frozenset("ul ol dl table article section main div body html".split())
# Elements, roles and words of class or id that mark what is not the article
OTHER = frozenset(
    "head script style noscript template nav header footer aside form button select option textarea input dialog menu iframe "
    "object svg math canvas audio video noembed noframes title xmp datalist".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form status".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot sponsor sponsored sponsors promo promos promoted promotion banner "
    "cookie cookies consent gdpr notice notices notification alert disclaimer paywall newsletter subscribe subscription signup popup "
    "modal overlay sidebar rail nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar header "
    "masthead footer comment comments commentlist disqus replies reply respond share sharing social related recommended recommendations "
    "widget widgets login search skip".split()
)
# Words that stand beside a mark in a name without changing what it says
BESIDE = frozenset(
    "bar block box bottom button buttons col column container content group head inner item items label left link links list "
    "main module outer page panel primary right row section site slot small text title top unit wrap wrapper".split()
)
# Text outside elements for articles that outweighs theirs so many times is the article
CARDS = 3
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset("article main".split())

_MARKUP = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|itemprop|aria-hidden)(?=[\s=/>]|\Z)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass(slots=True)
class Block:
    """A block of text: the path it lies at, what its elements mark, how much of it are links."""

    path: str
    text: str
    other: bool
    main: bool
    links: int


def blocks(page: str, paths: Counter | None = None) -> list[Block]:
    """The blocks of a page in order; ``paths`` counts its elements by path."""
    out: list[Block] = []
    # Open elements: name, path, other by its kind, by its name, inside the main part, inside an article's header
    stack: list[tuple[str, str, bool, bool, bool, bool]] = [("", "", False, False, False, False)]
    # Elements of one kind in one element so far
    siblings: Counter = Counter()
    parts: list[str] = []
    linked = links = position = 0

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                _, path, by_kind, by_name, main, _ = next(x for x in reversed(stack) if x[0] not in INLINE)
                out.append(Block(path, text, by_kind or by_name, main, links))
            parts.clear()
        links = 0

    def close(down_to: int) -> None:
        nonlocal linked
        for name, *_ in stack[down_to:]:
            linked -= name == "a"
        del stack[down_to:]

    while position < len(page):
        found = _MARKUP.search(page, position)
        text = page[position : found.start()] if found else page[position:]
        if text:
            parts.append(text)
            if linked:
                links += len(text)
        if not found:
            break
        position = found.end()
        name = (found[2] or "").lower()
        if not name:
            if found[0].startswith("<![CDATA["):
                parts.append(html.escape(found[0][9:-3]))
            continue
        inline = name in INLINE
        if not inline:
            flush()
        elif name == "br":
            parts.append(" ")
        if found[1]:
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if at and not (inline and any(x[0] not in INLINE for x in stack[at + 1 :])):
                close(at)
            continue
        if not inline:
            _imply_ends(stack, name, close)
        entry = _entered(stack[-1], name, found[3], siblings)
        if paths is not None:
            paths[entry[1]] += 1
        if name in VOID or found[3].endswith("/") and name not in RAW and not inline and name in ("svg", "math", "path"):
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(page, position)
            position = end.end() if end else len(page)
            continue
        stack.append(entry)
        linked += name == "a"
    flush()
    return out


def _imply_ends(stack: list, name: str, close) -> None:
    """Ends that the standard lets authors leave out."""
    if name in CLOSES_P:
        at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == "p" or stack[i][0] in SCOPES), 0)
        if at and stack[at][0] == "p":
            close(at)
    if name in SIBLINGS:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in SIBLINGS[name]:
                close(i)
            elif stack[i][0] in SCOPES:
                break


def _named_mark(names: list[str]) -> bool:
    """Whether a class or id says that this is not the article: all its words are marks, or stand beside one."""
    for name in names:
        words = set(_WORDS.findall(_CAMEL.sub(" ", name).lower()))
        if words & MARKS and words <= MARKS | BESIDE:
            return True
    return False


def _entered(parent: tuple, name: str, attributes: str, siblings: Counter) -> tuple[str, str, bool, bool, bool, bool]:
    """The element's entry. Its path has its number among equal siblings, so that each item of a menu is a token."""
    _, path, by_kind, by_name, main, in_header = parent
    marks, hidden, role, body = [], False, "", False
    if attributes:
        for match in _ATTRIBUTE.finditer(attributes):
            key, value = match[1].lower(), match[2] or match[3] or match[4] or ""
            if key in ("class", "id"):
                marks += value.split()
            elif key == "role":
                role = value.lower()
            elif key == "itemprop":
                body = value.lower() == "articlebody"
            elif key == "hidden" or value.lower() == "true":
                hidden = True
    here = f"{path}>{name}" + (f".{'.'.join(marks)}" if marks else "")
    siblings[here] += 1
    here = f"{here}:{siblings[here]}"
    is_main = name in MAIN or role in ("main", "article") or body
    marked = bool(marks) and name not in ("html", "body") and _named_mark(marks)
    if name == "header" and main and not marked:
        in_header = True
    kind = name in OTHER or role in ROLES or hidden
    # An article's own header gives its title
    if not (in_header and name in ("header", "hgroup", "div")):
        by_kind = by_kind or kind
        # The article counts whatever the names of what is around it say
        by_name = marked if is_main and not by_kind else by_name or marked
    if in_header and name not in HEADINGS and name not in INLINE and name not in ("header", "hgroup", "div"):
        by_kind = True
    return name, here, by_kind, by_name, main or (is_main and not by_kind and not by_name), in_header


def host(url: str) -> str:
    """The host of an address, in lower case; empty if it has none."""
    rest = url.split("://", 1)[-1] if "://" in url else url.removeprefix("//")
    return re.split(r"[/?#]", rest, maxsplit=1)[0].rpartition("@")[2].split(":")[0].lower()


def digest(token: str) -> int:
    return xxhash.xxh64_intdigest(token) - (1 << 63)


def tokens(page: str) -> dict[tuple[int, int, bool], int]:
    """How often a page has each token (token, the element it lies in, is it text)."""
    paths: Counter = Counter()
    found: Counter = Counter()
    for block in blocks(page, paths):
        found[digest(f"{block.path}\0{block.text}"), digest(block.path), True] += 1
    for path, n in paths.items():
        found[digest(path), digest(path.rpartition(">")[0]), False] += n
    return found


def _token_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["host", "page", "token", "inside", "is_text", "n"]
    for batch in batches:
        rows = []
        for i, (url, page) in enumerate(zip(texts_of(batch.column("url")), texts_of(batch.column("html")))):
            here, number = host(url), batch.column("mark")[i].as_py()
            rows += [(here, number, *token, n) for token, n in tokens(page).items()]
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
        columns = zip(*rows) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)


def templates(pages: DataFrame, share: float = 0.5, least: int = 5) -> DataFrame:
    """(host, texts array<bigint>): texts of each host's template.

    An occurrence vector is held as its length and a sum of hashes of its entries, so that it
    needs no list of pages, however many a host has. ``share``: of the host's different pages
    must have a class; ``least``: so many pages, at least, and two. Pages equal in address and text count once.
    """
    marked = pages.select("url", "html", F.xxhash64("url", "html").alias("mark"))
    rows = marked.mapInArrow(_token_rows, "host string, page bigint, token bigint, inside bigint, is_text boolean, n bigint")
    entry = F.xxhash64("page", "n").cast("decimal(38,0)")
    vectors = rows.groupBy("host", "token", "inside", "is_text").agg(F.count("*").alias("support"), F.sum(entry).alias("vector"))
    vectors = stage(vectors.where(F.col("support") > 1), "vectors")
    # A host has at most as many frequent tokens as its pages have tokens, over the share
    sizes = vectors.groupBy("host").agg(F.max("support").alias("pages"))
    frequent = stage(vectors.join(sizes, "host").where((F.col("support") >= max(least, 2)) & (F.col("support") >= F.col("pages") * share)), "tokens")
    discard(vectors)
    classes = frequent.groupBy("host", "support", "vector").agg(F.min("token").alias("class"))
    placed = frequent.join(classes, ["host", "support", "vector"]).select("host", "class", "token", "inside", "is_text", "pages")
    valid = _nested(placed)
    # A text belongs to the template if its element comes with it, neither ever alone; a
    # paragraph that many articles quote lies among others of its kind
    elements = valid.where("not is_text").select("host", "class", F.col("token").alias("inside"))
    texts = valid.where("is_text").join(elements, ["host", "class", "inside"], "left_semi")
    return texts.groupBy("host").agg(F.collect_set("token").alias("texts"))


def _nested(placed: DataFrame) -> DataFrame:
    """Classes all of whose tokens lie in elements of the template."""
    elements = placed.where("not is_text").select("host", F.col("token").alias("inside")).distinct()
    roots = placed.select("host").distinct().select("host", F.lit(digest("")).alias("inside"))
    held = placed.join(elements.unionByName(roots).distinct().withColumn("held", F.lit(1)), ["host", "inside"], "left")
    bad = held.where("held is null").select("host", "class").distinct()
    return placed.join(bad, ["host", "class"], "left_anti")


def main_text(page: str, fixed: frozenset[int] | set[int] = frozenset()) -> str:
    """Text of the slots that hold the article; ``fixed``: texts of the host's template."""
    found = [b for b in blocks(page) if not b.other]
    slots = [b for b in found if digest(f"{b.path}\0{b.text}") not in fixed] if fixed else found
    # A page that says only what others of its host say too is content all the same
    slots = slots or found
    main = [b for b in slots if b.main]
    # Without an element for the article, blocks that are links are taken for menus
    rest = [b for b in slots if not b.main and (2 * b.links < len(b.text) or not b.links)]
    # Cards beside a body that no element names are not the article
    if main and sum(len(b.text) for b in rest) <= CARDS * sum(len(b.text) for b in main):
        return "\n\n".join(b.text for b in main)
    return "\n\n".join(b.text for b in rest or slots)


def extracted(pages: DataFrame, share: float = 0.5, least: int = 5) -> DataFrame:
    """``pages`` (url, html and others) without html, with ``text`` and ``n_chars`` (bigint).

    The article as blocks joined by an empty line; white space inside a block is one space.
    NULL or empty html gives the empty text, a NULL url is a host of its own kind. Columns of
    the new names are replaced.
    """
    keep = [c for c in pages.columns if c != "html" and c.lower() not in ("text", "n_chars")]
    schema = pages.select(*quoted(keep)).withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("bigint")}).schema
    fixed = stage(templates(pages, share, least), "templates").withColumnRenamed("host", "_host")
    aside = Aside(pages.select(*quoted(keep)))
    named = pages.select("html", *aside.away, _host_of(F.col("url")).alias("_name"))
    joined = named.join(fixed, F.col("_name") == F.col("_host"), "left").select("html", "texts", *[aside[c] for c in keep])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, set(t or ())) for p, t in zip(texts_of(batch.column(0)), batch.column(1).to_pylist())]
            columns = [*batch.columns[2:], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "text", "n_chars"])

    return joined.mapInArrow(run, schema)


def _host_of(url):
    """``host`` in Spark's functions."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(url.contains("://"), F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise(F.regexp_replace(url, "^//", ""))
    name = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.lower(F.regexp_replace(F.regexp_replace(name, r"^.*@", ""), r":.*$", ""))
