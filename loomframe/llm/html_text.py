"""Main text of web pages by the distribution of text over line blocks.

A page is cut into lines at its block elements. Markup is stripped, and every line gets
the length of its text. Lines of menus, headers, footers, sidebars, notices, adverts,
forms and reader comments have no length and never come out; entries of lists and tables
that are mostly links, and other such lines outside of a marked main part, have no length
either. The lengths are summed over sliding windows of lines: where the sums surge from
nothing to something a stretch of text begins, where they dive to nothing again it ends.
All from the first to the last line with a length in a stretch is text, linked lines
between them too; a run of linked lines as long as a window is a menu, and so is one
before or behind all text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from itertools import accumulate, pairwise
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

#: Lines in a sliding window.
WINDOW = 3
#: Share of a line's text in links above which it counts as a menu.
LINKS = 0.6

#: Elements that end a line, at their beginning and their end.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav noscript ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no text of the article, with all inside them.
ASIDE = frozenset(
    "aside audio button canvas datalist dialog footer form head header iframe label map menu nav noembed noframes "
    "noscript object option script select style svg template textarea title video".split()
)
#: Elements that close an open paragraph.
CLOSES_P = BLOCKS - frozenset("body html caption dd dt td th tr tbody thead tfoot option optgroup title noscript".split())
#: Of these, an open one ends where the next begins.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
#: Elements whose lines count as entries of a menu if they are mostly links, also in an article.
ENTRIES = frozenset("li dt dd td th".split())
#: Words of class, id and role that mark parts beside the article.
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense alert alertdialog banner breadcrumb breadcrumbs "
    "comment comments commentlist commentary complementary consent contentinfo cookie cookies disclaimer disqus footer form "
    "gdpr header masthead menu menus modal nav navbar navigation newsletter notice notices notification notifications pager "
    "pagination paywall popup promo promos promotion promotions recommended related replies reply respond rss search share "
    "sharing sidebar sidebars skip social sponsor sponsored sponsors subscribe subscription tags toolbar widget widgets".split()
)
COMMENT = frozenset("comment comments reply replies commentlist".split())
#: What may follow such a word in a name: boxes, places and lists, which change nothing in what it says.
BOXES = frozenset(
    "area articles bar block body bottom box button buttons column container content wrapper wrap entry field group head holder "
    "icons inner input item items left link links list main outer overlay panel posts region right row section slot small "
    "stories text title top unit wide".split()
)
#: Words that turn it: the element has or lacks such a part and is not one.
TURNED = frozenset("has have with without no not is hide hides hidden show shows enable enabled disable disabled before after above below".split())
#: Words that make a header one of the article's own.
OWN = frozenset("article entry post story content section title chapter".split())
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]*))?|"[^"]*"|'[^']*'""")
PARTS = re.compile(r"[-_]+")
TAG = re.compile(r"""</?[a-zA-Z](?:[^"'<>]|"[^"<]*"|'[^'<]*')*+>""")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
SPACES = re.compile(r"\s+")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """Text, opening and closing tags of a page in order, as (kind, name or text, attributes); comments are left out.

    Every step goes on from where the last one ended, so that broken markup takes no longer than sound markup.
    """
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0 or lt + 1 >= n:
            yield "text", page[at:], ""
            return
        if lt > at:
            yield "text", page[at:lt], ""
        mark = page[lt + 1]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            if page.startswith((">", "->"), lt + 4):
                end = page.find(">", lt + 4) - 2
            if end < 0:
                return
            at = end + 3
        elif mark in "!?" or (mark == "/" and not page[lt + 2 : lt + 3].isalpha()):
            end = page.find(">", lt)
            if end < 0:
                return
            at = end + 1
        elif mark == "/" or (mark.isascii() and mark.isalpha()):
            whole = TAG.match(page, lt)
            end = whole.end() if whole else page.find(">", lt) + 1
            if not end:
                return
            inner = page[lt + 1 + (mark == "/") : end - 1]
            found = NAME.match(inner)
            name = found.group().lower() if found else ""
            at = end
            if mark == "/":
                yield "close", name, ""
                continue
            yield "open", name, inner[len(name) :]
            if name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(page, at)
                stop = close.start() if close else n
                yield "raw", page[at:stop], ""
                at = stop
        else:
            yield "text", page[lt : lt + 1], ""
            at = lt + 1


def attributes_of(text: str) -> dict[str, str]:
    """Attributes by name, the first of each; what stands in a quoted value is no attribute."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        if m[1]:
            value = m[2] or ""
            found.setdefault(m[1].lower(), value[1:-1] if value[:1] in ('"', "'") else value)
    return found


def _marks(name: str, words: frozenset[str]) -> bool:
    """Whether one name of a class, id or role says that an element is one of ``words``."""
    parts = [p for p in PARTS.split(name.lower()) if p]
    if not parts or len(parts) > 3 or not TURNED.isdisjoint(parts):
        return False
    if parts[-1] in words:
        return not (parts[-1] == "header" and not OWN.isdisjoint(parts[:-1]))
    return parts[0] in words and all(p in BOXES or p in words for p in parts[1:])


#: How an element stands to the article: not beside it, beside it by what a wrapper is called, or in any case.
IN, WRAPPED, OUT = 0, 1, 2


def _beside(name: str, attributes: str, inside: bool) -> int:
    """What an element says of all in it; ``inside`` the main part its class counts as much as its name."""
    if name == "form":
        return OUT if inside else WRAPPED
    if name in ASIDE:
        return OUT
    if not attributes or name in ("html", "body"):
        return IN
    given = attributes_of(attributes)
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true":
        return OUT
    if name == "main":
        return IN
    # An article may be called anything but a comment.
    words = COMMENT if name == "article" else BESIDE
    if any(_marks(word, words) for key in ("class", "id", "role") for word in given.get(key, "").split()):
        return OUT if inside or name == "article" else WRAPPED
    return IN


class Line(NamedTuple):
    """A line of a page: its text, how it stands to the article, in a marked main part or not, and mostly links or not."""

    text: str
    beside: int
    form: bool
    main: bool
    menu: bool


class Open(NamedTuple):
    """An open element with what it and those around it say."""

    name: str
    beside: int = IN
    form: bool = False
    main: bool = False


def lines(page: str) -> list[Line]:
    """The lines of a page, cut at its block elements."""
    out: list[Line] = []
    stack: list[Open] = []
    text: list[str] = []
    linked = links = 0
    now = Open("")

    def flush() -> None:
        nonlocal linked
        line = SPACES.sub(" ", html.unescape("".join(text))).strip()
        if line or not text:
            menu = linked > LINKS * len(line) and (not now.main or any(s.name in ENTRIES for s in stack[-3:]))
            out.append(Line(line, now.beside, now.form, now.main, menu))
        text.clear()
        linked = 0

    for kind, value, attributes in tokens(page):
        if kind == "text":
            text.append(value)
            if links:
                linked += len(value.strip())
        elif kind == "open":
            if value == "br":
                text.append(" ")
                continue
            if value in BLOCKS or value in ASIDE:
                flush()
            ends = CLOSES_P and {"p"} if value in CLOSES_P else set()
            ends = ends | SIBLINGS.get(value, set())
            if ends:
                _close_open(stack, ends)
                now = _state(stack)
            if value not in VOID:
                main = value in ("article", "main")
                if value != "body" and not main and "role" in attributes.lower():
                    main = "main" in attributes_of(attributes).get("role", "").lower().split()
                inner = IN if main and value != "article" and value != "main" else _beside(value, attributes, now.main)
                # An article's own heading stands in a header without being beside it.
                if value in ("header", "hgroup") and now.main:
                    inner = IN
                form = now.form or (value == "form" and inner == WRAPPED)
                inner = IN if value == "form" and inner == WRAPPED else inner
                now = Open(value, max(now.beside, inner), form, now.main or main)
                stack.append(now)
                links += value == "a"
        elif kind == "close":
            if value in BLOCKS or value in ASIDE:
                flush()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].name == value:
                    links -= sum(s.name == "a" for s in stack[depth:])
                    del stack[depth:]
                    break
                if stack[depth].name in ("article", "main", "body", "td", "table") and value not in BLOCKS:
                    break
            now = _state(stack)
    flush()
    return out


def _state(stack: list[Open]) -> Open:
    return stack[-1] if stack else Open("")


def _close_open(stack: list[Open], names: set[str]) -> None:
    """Close the innermost of ``names`` with what is open in it, unless another block stands between."""
    for depth in range(len(stack) - 1, -1, -1):
        if stack[depth].name in names:
            del stack[depth:]
            return
        if stack[depth].name in BLOCKS:
            return


def main_text(page: str | None) -> str:
    """Main text of a page: its blocks in order, joined by line feeds; empty where there is none.

    What a wrapper around the whole article is called does not count: where nothing else
    is left, the lines of a marked main part count in spite of the names of wrappers, and
    those of a form that holds the page.
    """
    if not page:
        return ""
    found = [line for line in lines(page) if line.text]
    usable = [line.beside == IN and not line.form for line in found]
    if not any(usable):
        usable = [line.beside != OUT and (line.main or line.beside == IN) for line in found]
    marked = any(ok and line.main for line, ok in zip(found, usable, strict=True))
    usable = [ok and (line.main or not marked) for line, ok in zip(found, usable, strict=True)]
    if marked and all(line.menu for line, ok in zip(found, usable, strict=True) if ok):
        # An article of links alone is no menu.
        return "\n".join(line.text for line, ok in zip(found, usable, strict=True) if ok)
    lengths = [len(line.text) if ok and not line.menu else 0 for line, ok in zip(found, usable, strict=True)]
    return "\n".join(found[i].text for lo, hi in stretches(lengths) for i in range(lo, hi) if usable[i])


def stretches(lengths: list[int]) -> list[tuple[int, int]]:
    """Ranges of lines from a surge of the window sums to the next dive, from their first to their last line with a length."""
    n = len(lengths)
    sums = [0, *accumulate(lengths)]
    blocks = [sums[min(n, i + WINDOW)] - sums[i] for i in range(n)]
    out: list[tuple[int, int]] = []
    begin = 0
    for i, (before, block) in enumerate(pairwise([0, *blocks, 0])):
        if block and not before:
            begin = i
        if before and not block:
            full = [j for j in range(begin, min(n, i)) if lengths[j]]
            out.append((full[0], full[-1] + 1))
    return out


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts = [main_text(page) for page in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every row of ``pages`` (page_id, url, html).

    A null or empty page, and one without text, gives an empty text; null ids and
    urls stay; repeated rows give repeated results. Other columns are ignored.
    Each page is worked on alone, in time linear in its length.
    """
    pages = pages.selectExpr("page_id", "cast(url as string) url", "cast(html as string) html")
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long")
