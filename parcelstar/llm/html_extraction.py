"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags; what lies in a menu, a footer or a hidden element
goes. Forms and elements whose class, id or role names boilerplate are suspects: their blocks
go, too, unless the element holds most of the page's prose and no marked article lies outside
it. Comments, adverts and consent notices are never overruled so.
The first pass labels every other block, in an article or not, by its length, its share of
stop words and its share of linked text. Short blocks and those near the thresholds stay
undecided, as tables and code do, which have few stop words; in the second pass they take the
label of the nearest decided neighbours. A page in a language without stop words here is
judged by length and links alone. An article is evidence for its blocks: they may hold more
links, and they look for neighbours in their article only, which itself counts as good.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GOOD, BAD, NEAR, SHORT = "good", "bad", "near", "short"

#: Lengths in characters and shares of words or characters of the first pass.
SHORT_CHARS, LONG_CHARS = 70, 200
STOP_LOW, STOP_HIGH = 0.05, 0.10
LINK_SHARE = 0.3
#: Suspects around a block that are looked at, from outside.
NESTED = 8
#: The share of linked characters that makes a block bad inside an article.
ARTICLE_LINK_SHARE = 0.5

#: Frequent words of the four languages of the corpus.
STOP_WORDS = frozenset(
    """
    a about after all also an and any are as at be been but by can could for from had has
    have he her his i if in into is it its more no not of on one or other our out she so
    some than that the their them then there these they this to up was we were what when
    which who will with would you your
    aber als am an auch auf aus bei bin bis das dass dem den der des die doch durch ein
    eine einem einen einer eines er es für hat ich ihr im in ist kann mit nach nicht noch
    nur oder sich sie sind so über um und uns unter von vor war was wenn werden wie wir
    wird zu zum zur
    al como con cuando de del desde donde dos el ella ellos en entre era es esta este esto
    fue ha hay la las le lo los más me mi muy no nos o para pero por que qué se ser si sin
    sobre son su sus también te todo tu un una y ya
    au aux avec ce ces cette comme dans de des du elle en est et être eux il ils je la le
    les leur lui mais me même mes moi mon ne nos notre nous on ou où par pas plus pour qu
    que qui sa sans se ses si son sont sur tu un une vous
    """.split()
)

#: Elements whose content is no text of the page.
RAW = frozenset("script style textarea title iframe noscript noembed noframes xmp template svg math object canvas audio video select datalist".split())
#: Elements that hold what is around an article, and those that may hold the page, too.
AROUND = frozenset("nav footer aside button dialog menu fieldset label".split())
SUSPECT = frozenset(["form"])
#: Elements that no name makes a suspect.
PLAIN = frozenset("html body main article".split())
ARTICLE = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp "
    "small span strike strong sub sup time tt u var wbr img".split()
)
#: Elements that a tag of the same kind closes, and where the search for one stops.
SIBLINGS = {
    "li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table",
    "th": "tr table", "option": "select",
}
#: Words of class, id and role that name boilerplate, with those that always do, and those
#: that do so outside an article only, where a title may be called a header.
FIRM_NAMES = frozenset(
    """
    ad ads adv advert adverts advertisement advertising adbox adslot sponsor sponsored cookie
    cookies consent gdpr newsletter comment comments commentlist disqus replies reply respond
    """.split()
)
NAMES = FIRM_NAMES | frozenset(
    """
    promo promotion banner notice notices alert popup modal overlay subscribe subscription
    signup login share sharing social related recommended recommendations sidebar widget
    widgets menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer search
    toolbar skip complementary contentinfo paywall
    """.split()
)
OUTSIDE_NAMES = frozenset("header masthead topbar".split())
BODY_NAME = "main"
#: Words that say nothing by themselves. A name counts if all its other words are such.
STRUCTURE = frozenset(
    """
    area article articles bar block body bottom box boxes button buttons col column container
    content desktop fixed footer form global group header holder icon icons inner item items
    left link links list lists local main mobile module outer page pane panel post posts
    primary region right row secondary section site small sticky story stories text title top
    wrap wrapper
    """.split()
)

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|</[^a-zA-Z>][^>]*+(?:>|\Z)"
    r"|<(?P<start>[a-zA-Z][^\s/>]*+)"
    r"(?P<attrs>(?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>=]|=)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
#: Characters of scripts that write a word in one or two; they count twice.
_WIDE = re.compile("[\u2e80-\ud7ff\uf900-\ufaff\uff00-\uff60\U00020000-\U0003ffff]")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Block(NamedTuple):
    text: str
    linked: int  # characters inside links
    label: str | None  # what the elements around it say
    article: int  # where the innermost article around it begins, 0 if there is none
    suspects: tuple[tuple[int, bool], ...] = ()  # suspects around it, and whether they are firm


class Element(NamedTuple):
    tag: str
    label: str | None
    article: int
    suspects: tuple[tuple[int, bool], ...] = ()


class Says(NamedTuple):
    """What an element says of its content: a label, an article, a suspicion and how firm."""

    label: str | None
    marks: bool = False
    suspect: bool = False
    firm: bool = False


def _names(value: str) -> Iterator[frozenset[str]]:
    """The words of each name in a class, id or role that has one to look at."""
    for name in value.split():
        words = frozenset(w.lower() for w in _NAME_PARTS.findall(name))
        if words and words <= STRUCTURE | NAMES | OUTSIDE_NAMES:
            yield words


def _says(tag: str, attrs: str, inside: str | None) -> Says:
    if inside == BAD or tag in AROUND or (tag == "header" and inside != GOOD):
        return Says(BAD)
    marks, suspect, firm = tag in ARTICLE, tag in SUSPECT, False
    for name, *values in _ATTRIBUTE.findall(attrs) if attrs else ():
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return Says(BAD)
        if name == "style" and _NO_DISPLAY.search(value):
            return Says(BAD)
        if name == "itemprop":
            marks |= value.lower() == "articlebody"
        elif name in ("class", "id", "role"):
            for words in _names(value):
                if tag not in PLAIN and words & (NAMES if inside == GOOD else NAMES | OUTSIDE_NAMES):
                    suspect, firm = True, firm or bool(words & FIRM_NAMES)
                elif BODY_NAME in words:
                    marks = True
    if suspect:
        return Says(inside, False, True, firm)
    return Says(GOOD, True) if marks else Says(inside)


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, with references decoded and white space made one."""
    found: list[Block] = []
    parts: list[str] = []
    linked = 0
    links = 0  # open <a> elements
    stack: list[Element] = []
    open_tags: Counter[str] = Counter()
    at, size = 0, len(page)

    def inside() -> str | None:
        return stack[-1].label if stack else None

    def article() -> int:
        return stack[-1].article if stack else 0

    def suspects() -> tuple[tuple[int, bool], ...]:
        return stack[-1].suspects if stack else ()

    def enter(tag: str, says: Says) -> None:
        around = suspects()
        # Within a firm suspect, or many, another one changes nothing.
        if says.suspect and not (around and (around[-1][1] or len(around) >= NESTED)):
            around = (*around, (at, says.firm))
        stack.append(Element(tag, says.label, at if says.marks else article(), around))
        open_tags[tag] += 1

    def leave(place: int) -> None:
        """Close the elements from a place of the stack on."""
        open_tags.subtract(e.tag for e in stack[place:])
        del stack[place:]

    def close_block() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            found.append(Block(text, min(linked, len(text)), inside(), article(), suspects()))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and inside() != BAD:
            text = html.unescape(text)
            parts.append(text)
            if links:
                linked += len(" ".join(text.split()))

    def close(tag: str, limits: str = "") -> None:
        """Close the innermost element of this tag, unless a limit lies between."""
        if not open_tags[tag]:
            return
        stops = limits.split()
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag == tag:
                leave(i)
                return
            if stack[i].tag in stops:
                return

    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            break
        token = _TOKEN.match(page, begin)
        if not token:  # a lone bracket is text
            add(page[at : begin + 1])
            at = begin + 1
            continue
        add(page[at:begin])
        at = token.end()
        if token["cdata"] is not None:
            add(token["cdata"].replace("&", "&amp;"))
        elif token["end"]:
            tag = token["end"].lower()
            if tag == "a":
                links = max(0, links - 1)
            if tag not in INLINE:
                close_block()
                if tag not in VOID:
                    close(tag)
            elif stack and stack[-1].tag == tag:  # only those that say something are kept
                leave(len(stack) - 1)
        elif token["start"]:
            tag, attrs = token["start"].lower(), token["attrs"] or ""
            if tag in RAW and not attrs.endswith("/"):
                rest = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, at)
                if tag not in INLINE:
                    close_block()
                at = rest.start() if rest else size
            elif tag == "br":
                parts.append(" ")
            elif tag in VOID:
                if tag not in INLINE:
                    close_block()
            elif tag in INLINE:
                if tag == "a":
                    links += 1
                says = _says(tag, attrs, inside()) if attrs else Says(inside())
                if says.suspect or says.label != inside():
                    enter(tag, says)
            else:
                close_block()
                links = 0  # a link left open ends with its block
                close("p", "div section article main td th li body table ul ol dl blockquote")
                if tag in SIBLINGS:
                    close(tag, SIBLINGS[tag])
                enter(tag, _says(tag, attrs, inside()))
    add(page[at:])
    close_block()
    return found


def stop_share(block: Block) -> float:
    words = [w.strip(".,;:!?\"'()[]").lower() for w in block.text.split()]
    return sum(w in STOP_WORDS for w in words) / len(words)


def linked(block: Block) -> bool:
    share = ARTICLE_LINK_SHARE if block.label == GOOD else LINK_SHARE
    return block.linked > share * len(block.text)


def first_pass(block: Block, stops: float, known: bool = True) -> str:
    """good, bad, or undecided: near (long enough, not many stop words) or short, or without any.

    On a page in another language than the stop words', length decides without them.
    """
    if block.label == BAD:
        return BAD
    chars, article = len(block.text), block.label == GOOD
    if linked(block) or ("©" in block.text and not article):
        return BAD
    if chars + (0 if known else len(_WIDE.findall(block.text))) < SHORT_CHARS:
        return BAD if block.linked and not article else SHORT
    if not known:
        return GOOD
    if stops >= STOP_HIGH:
        return GOOD if chars > LONG_CHARS else NEAR
    return NEAR if stops >= STOP_LOW else SHORT


def second_pass(labels: list[str]) -> list[bool]:
    """Undecided blocks take the label of the nearest decided one, before or after.

    At equal distance blocks near the thresholds are good and short ones bad. A page without
    any decided block has nothing around its text, which all is good.
    """
    n = len(labels)
    before: list[tuple[int, str] | None] = []
    after: list[tuple[int, str] | None] = [None] * n
    last = None
    for i, label in enumerate(labels):
        last = (i, label) if label in (GOOD, BAD) else last
        before.append(last)
    last = None
    for i in range(n - 1, -1, -1):
        last = (i, labels[i]) if labels[i] in (GOOD, BAD) else last
        after[i] = last
    kept = []
    for i, label in enumerate(labels):
        left, right = before[i], after[i]
        if label in (GOOD, BAD):
            kept.append(label == GOOD)
        elif left and right and left[1] != right[1] and i - left[0] == right[0] - i:
            kept.append(label == NEAR)
        elif left and (not right or i - left[0] <= right[0] - i):
            kept.append(left[1] == GOOD)
        elif right:
            kept.append(right[1] == GOOD)
        else:
            kept.append(True)
    return kept


def language_known(found: list[Block], stops: list[float]) -> bool:
    """Do blocks with stop words hold half of the text outside link lists?"""
    free = [(len(b.text), s) for b, s in zip(found, stops, strict=True) if not linked(b)]
    return 2 * sum(n for n, s in free if s >= STOP_LOW) >= sum(n for n, _ in free)


def without_suspects(found: list[Block]) -> list[Block]:
    """The blocks but those in suspects.

    A suspect that is not firm is overruled if it holds more than half of the page's prose,
    which is in long blocks with few links, and no marked article has any outside it.
    """
    found = [b for b in found if not any(firm for _, firm in b.suspects)]
    if not any(b.suspects for b in found):
        return found
    stops = [stop_share(b) for b in found]
    trusted = [(b, s) for b, s in zip(found, stops, strict=True) if not b.suspects]
    known = language_known(*map(list, zip(*trusted, strict=True))) if trusted else True
    prose = [
        len(b.text)
        if not linked(b) and len(b.text) >= SHORT_CHARS and (s >= STOP_LOW or not known)
        else 0
        for b, s in zip(found, stops, strict=True)
    ]
    total, marked = sum(prose), sum(n for b, n in zip(found, prose, strict=True) if b.label == GOOD)
    inside: Counter[int] = Counter()
    marked_inside: Counter[int] = Counter()
    for block, n in zip(found, prose, strict=True):
        for number, _ in block.suspects:
            inside[number] += n
            marked_inside[number] += n if block.label == GOOD else 0
    return [
        b
        for b in found
        if not any(
            2 * inside[number] <= total or marked_inside[number] < marked
            for number, _ in b.suspects
        )
    ]


def keep(found: list[Block]) -> list[bool]:
    """Both passes over the blocks of a page, first within each article, then around them."""
    stops = [stop_share(b) for b in found]
    known = language_known(found, stops)
    labels = [first_pass(b, s, known) for b, s in zip(found, stops, strict=True)]
    articles: dict[int, list[int]] = {}
    for i, block in enumerate(found):
        if block.label == GOOD:
            articles.setdefault(block.article, []).append(i)
    for own in articles.values():
        # Between good and bad, the article speaks for its blocks, short ones too.
        decided = second_pass([NEAR if labels[i] == SHORT else labels[i] for i in own])
        for i, good in zip(own, decided, strict=True):
            labels[i] = GOOD if good else BAD
    kept = second_pass(labels)
    # Where the text of no block is good, the elements alone decide.
    return kept if any(kept) else [b.label == GOOD for b in found]


def main_text(page: str | None) -> str:
    """The good blocks, a line each."""
    if not page:
        return ""
    found = without_suspects(blocks(page))
    return "\n".join(b.text for b, good in zip(found, keep(found), strict=True) if good)


def extract(pages: DataFrame, column: str = "html", into: str = "text") -> DataFrame:
    """`pages` with the main text of a column of html; null and empty html have none."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page) for page in batch], dtype="object")

    return pages.withColumn(into, text(F.col(column)))


def op3_html_extraction(pages: DataFrame) -> DataFrame:
    """A row per page row. Rows without id and repeated rows are read one by one."""
    return extract(pages.select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )
