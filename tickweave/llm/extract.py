"""Main text of web pages by line-block distribution."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import in_batches

#: Lines in a window.
WINDOW = 3
#: A run is kept with this share of the median line's characters, or with this many.
SURGE, ENOUGH = 0.25, 40
#: Share of a line's characters that links may have.
LINKED = 0.5
#: Shares of a page's text without links that an element holds which is not skipped: with a heading or article in it, and without.
MASS, ALL = 0.5, 0.9

# Elements of HTML.
RAW = frozenset("script style textarea title noscript iframe noframes xmp".split())
BOILERPLATE = frozenset("nav footer aside form button select fieldset dialog menu template svg object audio video canvas".split())
ARTICLE = frozenset("article main".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose end tag HTML lets be left out (inline ones are ended with what holds them), and parts of tables.
OPTIONAL = frozenset("p li dt dd tr td th thead tbody tfoot caption colgroup option optgroup".split())
PARTS = frozenset("table caption colgroup thead tbody tfoot tr td th".split())
#: Elements that hold the whole article: their end doesn't stand for a missing end tag.
WHOLE = frozenset("article main body html".split())
#: Elements that end an open paragraph.
ENDS_P = frozenset(
    """address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr
    li main menu nav ol p pre search section summary table ul""".split()
)
_SCOPE, _BUTTON, _TABLE, _ITEM, _ROW = "<scope", "<button", "<table", "<item", "<row"
#: Elements out of which nothing is ended by a tag inside.
_BORDERS = {
    _SCOPE: frozenset("table caption td th template object html".split()),
    _BUTTON: frozenset("table caption td th template object html button".split()),
    _TABLE: frozenset("table template html".split()),
    _ITEM: (ENDS_P | frozenset("table caption td th tr tbody thead tfoot template object button select body html".split())) - frozenset("address div p li dt dd hr".split()),
    _ROW: frozenset("table template html tr".split()),
}
_CELL, _GROUP = (("td", "th"), _ROW), (("thead", "tbody", "tfoot", "caption", "colgroup"), _TABLE)
#: What a start tag ends: the innermost of these elements inside the border.
_SIBLINGS = {
    "li": ((("li",), _ITEM),),
    **dict.fromkeys(("dt", "dd"), ((("dt", "dd"), _ITEM),)),
    **dict.fromkeys(("td", "th"), (_CELL,)),
    "tr": ((("tr",), _TABLE), (("caption", "colgroup"), _TABLE)),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (_GROUP, (("tr",), _TABLE))),
    **dict.fromkeys(("option", "optgroup"), ((("option",), _SCOPE),)),
    "a": ((("a",), "<block"),),
}
#: Words in a class or id that name what isn't the article.
NAMES = frozenset(
    """ad ads advert advertisement advertorial adverts aside banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright
    discussion disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted
    promotion recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget""".split()
)
#: Words that may stand beside these in a hyphenated name, which else names something of its own: has-sidebar, no-comments, share-prices.
BESIDE = frozenset(
    """area article bar block bottom box button buttons container content entry form group icon icons inner item items left link links list main outer page panel
    post right section site slot text thread title top unit wrap wrapper""".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())

_TAG = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
_LABEL = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_WORDS = re.compile(r"[a-z0-9]+")
_WORDY = re.compile(r"[^\W_]")


def _named(label: str) -> bool:
    """Whether a class or id, as a whole or in all its parts, names what isn't the article."""
    parts = [x for x in _WORDS.findall(label) if not x.isdigit()]
    return not NAMES.isdisjoint(parts) and all(x in NAMES or x in BESIDE for x in parts)


def _hidden(attributes: str) -> bool:
    return any(name.lower() == "hidden" or (name.lower() == "aria-hidden" and "".join(v).lower() == "true") for name, *v in _LABEL.findall(attributes))


def _unwanted(tag: str, attributes: str, inside: bool) -> bool:
    if tag in BOILERPLATE or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    for name, *values in _LABEL.findall(attributes):
        value = "".join(values).lower()
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in ROLES):
            return True
        if name in ("class", "id") and any(map(_named, value.split())):
            return not (tag == "article" and name == "id")
    return False


@dataclass
class Token:
    """A tag of a page, or the end of the page, with where it lies; ``end`` is the token that ends the element, if one does."""

    start: int
    stop: int
    tag: str
    close: bool = False
    attributes: str = ""
    end: int | None = None
    own: bool = False


def tokens(page: str) -> list[Token]:
    """Tags in order, without comments and what raw elements hold, and a last one without name for the page's end."""
    out: list[Token] = []
    at = 0
    while m := _TAG.search(page, at):
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        close = bool(m[1] or m[4])
        if tag in RAW and not close:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = stop.start() if stop else len(page)
            tag = ""
        out.append(Token(m.start(), at, tag, close, m[3] or m[6] or ""))
    out.append(Token(len(page), len(page), ""))
    return out


def _pair(found: list[Token]) -> None:
    """Notes for every element which token ends it: its own end tag, or by HTML's rules a sibling's start or a parent's end.

    An element whose end tag may not be left out, and that only the end of the
    article or of the page cuts off, never ends.
    """
    stack: list[int] = []
    places: defaultdict[str, list[int]] = defaultdict(list)  # depths of the open elements of each name, and of each kind of border

    def names(tag: str) -> list[str]:
        return [tag, *(k for k, v in _BORDERS.items() if tag in v), *(["<block"] if tag not in INLINE else [])]

    def top(*of: str) -> int:
        return max((places[x][-1] for x in of if places[x]), default=-1)

    def close_to(depth: int, by: int, own: bool = False) -> None:
        while len(stack) > depth:
            t = found[stack.pop()]
            for x in names(t.tag):
                places[x].pop()
            mine = own and len(stack) == depth
            if mine or t.tag in OPTIONAL or not (found[by].close and found[by].tag in WHOLE):
                t.end, t.own = by, mine

    for i, t in enumerate(found[:-1]):
        if not t.tag or t.tag in RAW:
            continue
        if t.close:
            at = top(t.tag)
            border = "<block" if t.tag in INLINE else _TABLE if t.tag in PARTS else _SCOPE
            if at >= 0 and (t.tag == "table" or at >= top(border)) and not (t.tag == "li" and at < top("ul", "ol")):
                close_to(at, i, own=True)
            continue
        for mine, border in (*_SIBLINGS.get(t.tag, ()), *([(("p",), _BUTTON)] if t.tag in ENDS_P else ())):
            if (at := top(*mine)) > top(border):
                close_to(at, i)
        if t.tag not in VOID and not t.attributes.endswith("/"):
            for x in names(t.tag):
                places[x].append(len(stack))
            stack.append(i)


def _masses(page: str, found: list[Token]) -> Callable[[int], bool]:
    """A test whether an element, by its token's number, holds the page's main text, so that no name makes it unwanted."""
    text, heads, at, in_link = [0], [0], 0, False
    for t in found:
        text.append(text[-1] + (0 if in_link else len("".join(page[at : t.start].split()))))
        heads.append(heads[-1] + (not t.close and (t.tag == "h1" or t.tag in ARTICLE)))
        in_link = not t.close if t.tag == "a" else in_link
        at = t.stop

    def holds(i: int) -> bool:
        t = found[i]
        share = (text[t.end + 1] - text[i + 1]) / max(text[-1], 1)
        if share < MASS or _hidden(t.attributes):
            return False
        return heads[t.end] > heads[i + 1] or (share >= ALL and t.tag not in BOILERPLATE and t.tag != "header")

    return holds


def lines(page: str) -> list[tuple[str, int, bool]]:
    """The blocks of a page without markup, in order: (text, characters of links, inside an article).

    What lies in menus, footers, forms and the like, or in elements whose class
    or id names such, gives empty lines: gaps in the distribution.  An element
    of this kind that never ends, or that holds the page's main text, is taken as
    if it were none.
    """
    out: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    linked, in_link, inside, seen = 0, 0, 0, False
    found = tokens(page)
    _pair(found)
    holds = _masses(page, found)

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append((text, linked, inside > 0))
        parts.clear()
        linked = 0

    at, i = 0, 0
    while i < len(found):
        t = found[i]
        if t.start > at:
            text = html.unescape(page[at : t.start])
            parts.append(text)
            if in_link:
                linked += len(text)
        at, i = t.stop, i + 1
        tag, close = t.tag, t.close
        if not tag:
            continue
        if t.end is not None and _unwanted(tag, t.attributes, inside > 0) and not holds(i - 1):
            if tag not in INLINE:
                flush()
                out.append(("", 0, False))
            # an article begins: what went before never ended
            first = None if seen else next((k for k in range(i, t.end) if _begins_article(found[k])), None)
            i = t.end + t.own if first is None else first
            at = found[t.end].stop if first is None and t.own else found[i].start
            continue
        if tag == "a":
            in_link = 0 if close else 1
        if tag == "br":
            parts.append(" ")
        elif tag not in INLINE:
            flush()
            if tag in ARTICLE:
                seen = True
                inside = max(0, inside - 1) if close else inside + 1
    flush()
    return out


def _begins_article(t: Token) -> bool:
    return t.tag in ARTICLE and not t.close and not _unwanted(t.tag, t.attributes, False)


def main_text(page: str | None, window: int = WINDOW) -> str:
    """The article's blocks, each with white space as single blanks, joined by newlines; empty if there are none.

    Lengths of lines are summed over windows of three.  The distribution
    surges where windows rise from nothing and dives where they fall back to
    nothing: three lines of links, of signs alone or of what is left out.
    What lies between a surge and a dive is kept, short lines and lines of
    links with it, if it has a quarter of the characters of the page's median
    line, or 40 of them.  On pages with an article or main element lines
    outside it count nothing.  If all lines are of links or signs, those of
    signs count, and if there are none, all do.
    """
    rows = lines(page or "")
    marked = any(inside and text for text, _, inside in rows)
    rows = [(text, link, text != "" and (inside or not marked)) for text, link, inside in rows]
    size = np.zeros(len(rows), np.int64)
    for counts in (lambda t, link: link <= LINKED * len(t) and _WORDY.search(t), lambda t, link: link <= LINKED * len(t), lambda t, link: True):
        if not size.any():
            size = np.array([len(t) if own and counts(t, link) else 0 for t, link, own in rows], np.int64)
    if not size.any():
        return ""
    wide = np.convolve(size, np.ones(window, np.int64))  # window k ends with line k
    up = np.diff(np.concatenate([[0], (wide > 0).astype(np.int8), [0]]))
    least = min(ENOUGH, SURGE * float(np.median(size[size > 0])))
    kept: list[str] = []
    for surge, dive in zip(np.flatnonzero(up > 0), np.flatnonzero(up < 0), strict=True):
        run = size[surge:dive]
        if run.sum() >= least:
            within = np.flatnonzero(run) + surge
            kept += [rows[k][0] for k in range(within[0], within[-1] + 1) if rows[k][2]]
    return "\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, text, n_chars) for every page; null html is empty, repeated rows and null ids are kept."""
    schema = T.StructType(
        [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(x) for x in batch.column("html").to_pylist()]
        return pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema.names)

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(in_batches(run), schema)
