"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element, each with the length of its text. The block of a
line is the sum of lengths over a sliding window of lines. Where blocks rise above a threshold and text
follows is a surge, where they fall to nothing is a dive; the text between is the main text.

Lines of menus, headers, footers, sidebars, notices, adverts, forms and reader comments have length 0,
known by their element or by the words of its class, id or role. If a page marks its main part by
``article`` or ``main``, the marked parts that surge are its text, unless the text is clearly denser outside.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ordermill.llm.common import replace_columns

# Elements by their part in a page.
UNREAD = frozenset("script style noscript template svg math iframe object canvas textarea select title".split())
#: Without an end tag these run to the end of the page; of the other unread elements only the tag is skipped.
RAW = frozenset(("script", "style", "textarea"))
ASIDE = frozenset("nav header footer aside form menu dialog button fieldset option".split())
MAIN = frozenset(("article", "main"))
UNCLOSED = frozenset(("p", "li", "dt", "dd", "option"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
#: Words of a class, id or role that mark what is not the article.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs header footer masthead sidebar aside widget complementary "
    "contentinfo search cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup "
    "login share sharing social related recommended comment comments commentlist disqus reply replies pagination "
    "pager toolbar skip copyright".split()
)
#: Of these, what a text element or the last part of a longer name is called after them says too little.
WEAK_WORDS = frozenset("alert notice related widget".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies".split())
#: Parts that go with such a word, and parts of names that state what a page has.
NEUTRAL_WORDS = frozenset(
    "area bar block box btn button buttons container content form inner item items link links list panel post posts "
    "section slot text wrap wrapper".split()
)
STATING_WORDS = frozenset("has have no non not with without hide show is open single".split())
TEXT_ELEMENTS = frozenset("p li dt dd blockquote pre td th h1 h2 h3 h4 h5 h6 figcaption".split())
#: Lines of so many characters are running text.
SURGE = 60
#: Text outside the marked part has to be so many times as long as it and as the surge.
OUTWEIGHS = 2

ATTRIBUTES = r"""(?:[^<>"']|"[^"]*"|'[^']*')*+"""
MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)({ATTRIBUTES})>", re.DOTALL
)
MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SPACE = re.compile(r"\s+")


class Line(NamedTuple):
    text: str
    aside: bool  # in a part that is not the article
    main: int  # number of the outermost element around it that marks the main part, or 0


class Aside(NamedTuple):
    """An element that is not the article by what it is called."""

    by_class: bool
    comments: bool


def marked_aside(name: str, token: str) -> bool:
    """Whether a class, id or role is that of an aside: as a whole, or by its last part."""
    parts = [part.lower() for part in PART.findall(token)]
    if not parts or STATING_WORDS.intersection(parts):
        return False
    known = [part for part in parts if part in ASIDE_WORDS]
    if "".join(parts) in ASIDE_WORDS or (known and all(p in ASIDE_WORDS or p in NEUTRAL_WORDS for p in parts)):
        return name not in TEXT_ELEMENTS or not WEAK_WORDS.issuperset(known or parts)
    return name not in MAIN and parts[-1] in ASIDE_WORDS and parts[-1] not in WEAK_WORDS


def aside_of(name: str, attributes: str) -> Aside | None:
    if name in ASIDE:
        return Aside(False, False)
    if name in ("html", "body", "main") or "=" not in attributes:
        return None
    tokens = [token for value in MARKED.findall(attributes) for token in value.strip("\"'").split()]
    found = [token for token in tokens if marked_aside(name, token)]
    if not found:
        return None
    return Aside(True, any(part.lower() in COMMENT_WORDS for token in found for part in PART.findall(token)))


def element_ends(html: str, name: str) -> dict[int, int]:
    """Where the end tag of each such element ends, by where its start tag ends."""
    ends: dict[int, int] = {}
    starts: list[int] = []
    for tag in re.finditer(rf"<(/?){re.escape(name)}(?=[\s/>])({ATTRIBUTES})>", html, re.IGNORECASE):
        if not tag[1]:
            if not tag[2].endswith("/"):
                starts.append(tag.end())
        elif starts:
            ends[starts.pop()] = tag.end()
    return ends


def page_lines(html: str) -> list[Line]:
    """One line per block of text. Unclosed elements end with the element around them."""
    lines: list[tuple[str, tuple[int, ...], int]] = []
    text: list[str] = []
    # Open elements that matter: (name, number as an aside, number as main). Same-named elements inside are counted.
    opened: list[tuple[str, int, int]] = []
    asides: list[Aside] = []
    holds_main: set[int] = set()
    ends: dict[str, dict[int, int]] = {}
    around: tuple[int, ...] = ()
    main = mains = 0

    def end_line() -> None:
        if text:
            joined = SPACE.sub(" ", unescape("".join(text))).strip()
            if joined:
                lines.append((joined, around, main))
            text.clear()

    at = 0
    while found := MARKUP.search(html, at):
        text.append(html[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        closing = bool(found[1])
        if name == "br":
            text.append(" ")
            continue
        if name not in INLINE:
            end_line()
        if opened and opened[-1][0] == "option" and name not in INLINE and not (closing and name == "option"):
            opened.pop()  # has text only
            around = tuple(number for _, number, _ in opened if number)
        if name in UNREAD:
            if closing or found[3].endswith("/"):
                continue
            if name in RAW:
                end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(html, at)
                at = end.end() if end else len(html)
            else:
                if name not in ends:
                    ends[name] = element_ends(html, name)
                at = max(at, ends[name].get(at, at))
            continue
        if name in VOID:
            continue
        if not closing:
            last = opened[-1][0] if opened else ""
            if (last in UNCLOSED and last == name) or (last == "p" and name not in INLINE):
                opened.pop()  # a paragraph ends where the next block begins, a list item where the next one does
            hidden = aside_of(name, found[3])
            if hidden or name in MAIN or any(name == other for other, _, _ in opened):
                if hidden:
                    end_line()
                    asides.append(hidden)
                if name == "main":
                    holds_main.update(number for _, number, _ in opened if number)
                mains += name in MAIN
                opened.append((name, len(asides) if hidden else 0, mains if name in MAIN else 0))
        else:
            for depth in range(len(opened) - 1, -1, -1):
                if opened[depth][0] == name:
                    end_line()
                    del opened[depth:]
                    break
        around = tuple(number for _, number, _ in opened if number)
        main = next((number for _, _, number in opened if number), 0)
    text.append(html[at:])
    end_line()
    spared = holds_main | spared_asides(lines, asides)
    return [Line(body, any(number not in spared for number in inside), of) for body, inside, of in lines]


def spared_asides(lines: list[tuple[str, tuple[int, ...], int]], asides: list[Aside]) -> set[int]:
    """Elements called an aside that hold running text and most of the page's, or its article.

    Reader comments may be longer than the article; they are spared only if there is no other running text.
    """
    if not asides:
        return set()
    size, dense, articles = ([0] * (len(asides) + 1) for _ in range(3))
    total = shown = longest = 0
    for body, inside, main in lines:
        total += len(body)
        if not inside:
            shown, longest = shown + len(body), max(longest, len(body))
        for number in inside:
            size[number] += len(body)
            dense[number] = max(dense[number], len(body))
            # The article is inside the element, not around it, and is no aside itself.
            articles[number] += len(body) if main and number == inside[-1] else 0
    most = lambda n: asides[n - 1].by_class and 2 * size[n] > total
    return {
        number
        for number in range(1, len(asides) + 1)
        if dense[number] >= SURGE
        and not (asides[number - 1].comments and longest >= SURGE)
        and (most(number) or (asides[number - 1].by_class and articles[number] > shown))
    }


def _blocks(length: list[int], window: int) -> list[int]:
    """Text in the window that begins at each line."""
    return [sum(length[i : i + window]) for i in range(len(length))]


def dense_parts(length: list[int], window: int, surge: int) -> list[tuple[int, int]]:
    """Runs of lines from surge to dive."""
    block = _blocks(length, window)
    if not any(block):
        return []
    # A page of short lines only still has its highest block.
    threshold = min(surge, max(block))
    parts: list[tuple[int, int]] = []
    i = 0
    while i < len(length):
        if block[i] < threshold:
            i += 1
            continue
        start, end = i, i  # surge; the text may begin with shorter lines right before it
        while start > 0 and length[start - 1]:
            start -= 1
        while end < len(length) and block[end]:  # dive: a whole window without text
            end += 1
        parts.append((start, end))
        i = end
    return parts


def main_lines(lines: list[Line], window: int = 3, surge: int = SURGE) -> list[str]:
    """Lines between surge and dive points of the line-block distribution.

    On a page with marked parts the distribution decides which of them are the text, those that surge, and
    all their lines are; asides inside make no gap there. Where a single dense run outside outweighs every
    marked part, as on a page with articles as teasers only, it is the lines outside between surge and dive, as
    on a page without marks, where a run of asides is where the text may end.
    """
    marked: dict[int, list[int]] = {}
    for line in lines:
        if line.main and not line.aside:
            marked.setdefault(line.main, []).append(len(line.text))
    length = [0 if line.aside or line.main else len(line.text) for line in lines]
    if marked:
        densest = max((sum(length[a:b]) for a, b in dense_parts(length, window, surge)), default=0)
        if densest <= OUTWEIGHS * max(surge, *map(sum, marked.values())):
            highest = {number: max(_blocks(of, window)) for number, of in marked.items()}
            threshold = min(surge, max(highest.values()))
            return [line.text for line in lines if not line.aside and line.main and highest[line.main] >= threshold]
    return [
        line.text
        for start, end in dense_parts(length, window, surge)
        for line, size in zip(lines[start:end], length[start:end])
        if size
    ]


def main_text(html: str | None) -> str:
    """Blocks of the main text, joined by line feeds; empty for a null or empty page or one without text."""
    return "\n".join(main_lines(page_lines(html or "")))


def extract_main_text(df: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``df`` with the main text of ``html`` in a new last column and ``html`` itself left out.

    Every row gives one row, whatever the page: null and empty pages give an empty text, and broken
    markup is read as far as it goes. Pages are read on their own in the task that scans them, so equal
    rows give equal texts. A column that has the name of the new one is replaced; an empty table stays
    empty.
    """
    kept = replace_columns(df, text, html)
    schema = StructType([*kept.schema.fields, StructField(text, StringType())])
    names = [*kept.columns, text]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *others, pages = batch.columns
            texts = pa.array([main_text(page.as_py()) for page in pages], pa.string())
            yield pa.RecordBatch.from_arrays([*others, texts], names)

    columns = [F.col(f"`{name}`") for name in kept.columns]
    return df.select(*columns, F.col(f"`{html}`").cast("string").alias("__html")).mapInArrow(extract, schema)
