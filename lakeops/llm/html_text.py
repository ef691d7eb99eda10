"""Main text of web pages by the distribution of text over lines.

Markup is stripped into lines: block-level tags end a line, inline tags leave no trace, and lines without text do not count.  Text in menus, page headers, footers, sidebars,
forms, scripts and in containers whose class or role is the name of an advert, notice, comment section or the like is left out: such a line has no length.  The text lengths of
``WINDOW`` consecutive lines are summed; a surge (the sum reaches the threshold) opens a region and a dive (the sum is zero) closes it; kept is what has a length
between the first surge and the last dive.  On a page that marks its article (article, main), only lines in there have a length and any text is a surge; on other pages,
lines that are mostly link text have none and the surge threshold is ``SURGE`` characters, or half the page's highest sum if that is less.

A class counts as a whole (``ad``, ``cookie-banner``), not by a word in it (``share-prices`` is no marker), and never on headings or inline elements; an id counts outside a
marked article only, but for the usual ids of comment sections.

Character references are decoded; white space (space, 0x09-0x0D) inside a line becomes one space; lines are joined by one space.
A null or empty page has an empty text.  Broken markup (unclosed tags, missing end) is read as far as it goes.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable

from pyspark.sql import DataFrame

from lakeops.llm.rows import with_function

WINDOW, SURGE = 3, 86
LINK_SHARE = 0.5

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
SPACES = re.compile(r"[\x20\x09-\x0D]+")

# Element names of the HTML standard by how they are treated here.
RAW = frozenset("script style textarea title xmp iframe noembed noframes template noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
LEFT_OUT = frozenset("nav footer aside form menu dialog button select svg canvas object audio video head".split())
NOT_TRACKED = frozenset("p li dt dd tr td th option thead tbody tfoot colgroup html body".split())
ARTICLE = frozenset("article main".split())
CONTAINERS = frozenset("div section ul ol dl table tbody tr td li p figure blockquote fieldset details center".split())
# Names that mark what is not main text, and words that a name may add to them.
MARKERS = frozenset(
    "ad ads advert advertisement advertising adbox adslot sponsor sponsored promo promoted banner cookie cookies consent gdpr notice notices alert popup modal "
    "overlay paywall newsletter subscribe subscription signup login share sharing social nav navbar navigation menu breadcrumb breadcrumbs pagination pager "
    "sidebar sidenav aside widget related recommended comment comments discussion replies respond disqus footer masthead toolbar search complementary "
    "contentinfo".split()
)
ADDED = frozenset(
    "area bar block body bottom box button buttons column container content footer form group header holder inner item items left link links list mobile outer page panel "
    "primary region right row secondary section site slot thread top unit wrap wrapper zone".split()
)
COMMENT_IDS = frozenset("comments disqus_thread respond".split())


def names_no_text(value: str) -> bool:
    """Whether a class, id or role says that its element holds no main text: all its words do, or add to one that does."""
    if value in MARKERS:
        return True
    words = re.split(r"[_-]+", value)
    return any(w in MARKERS for w in words) and all(w in MARKERS or w in ADDED for w in words)


def attributes(text: str) -> dict[str, str]:
    """class, id and role, the first of each."""
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), value.strip("\"'").lower())
    return found


def is_marked(name: str, given: dict[str, str], article: bool) -> bool:
    if name not in CONTAINERS or not given:
        return False
    if any(map(names_no_text, given.get("class", "").split())) or names_no_text(given.get("role", "")):
        return True
    return given.get("id", "") in COMMENT_IDS if article else names_no_text(given.get("id", ""))


class TagEnds:
    """Where a tag that is open at a place ends: at the first > outside quotes; for all places in one pass over quotes and >, from the page's end."""

    def __init__(self, page: str):
        self.places = [m.start() for m in re.finditer("[>\"']", page)]
        self.ends = [0] * len(self.places)
        self.last = page.rfind(">")
        self.next = 0
        plain = double = single = -1
        for k in range(len(self.places) - 1, -1, -1):
            c = page[self.places[k]]
            if c == ">":
                plain = self.places[k]
            elif c == '"':
                plain, double = double, plain
            else:
                plain, single = single, plain
            self.ends[k] = plain

    def after(self, page: str, at: int) -> int:
        """The place of the tag's >; that of any > if a quote is never closed.  Places asked for rise."""
        while self.next < len(self.places) and self.places[self.next] < at:
            self.next += 1
        end = self.ends[self.next] if self.next < len(self.places) else -1
        return end if end >= 0 else page.find(">", at)


class Lines:
    """The lines of a page: their text, whether it is left out, inside a marked article, and how much of it is link text."""

    def __init__(self) -> None:
        self.lines: list[tuple[str, bool, bool, int]] = []
        self._text: list[str] = []
        self._links = 0

    def add(self, text: str, link: bool) -> None:
        self._text.append(text)
        if link:
            self._links += len(text)

    def end(self, left_out: bool, article: bool) -> None:
        text = SPACES.sub(" ", html.unescape("".join(self._text))).strip(" ") if self._text else ""
        if text:
            self.lines.append(("" if left_out else text, left_out, article, self._links))
        self._text, self._links = [], 0


class Open:
    """The open elements that decide whether text is left out or inside a marked article, with a count for each name."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool, bool]] = []
        self.count: dict[str, int] = {}

    @property
    def state(self) -> tuple[bool, bool]:
        return self.stack[-1][1:] if self.stack else (False, False)

    def push(self, name: str, left: bool, article: bool) -> None:
        self.stack.append((name, left, article))
        self.count[name] = self.count.get(name, 0) + 1

    def close(self, name: str) -> None:
        while self.count.get(name):
            top = self.stack.pop()[0]
            self.count[top] -= 1
            if top == name:
                break


def page_lines(page: str) -> list[tuple[str, bool, bool, int]]:
    out, open_, ends = Lines(), Open(), TagEnds(page)
    links = at = 0
    while True:
        start = page.find("<", at)
        if start < 0 or start > ends.last:
            out.add(page[at:], links > 0)
            break
        if start > at:
            out.add(page[at:start], links > 0)
        if page.startswith("<!--", start):
            close = page.find("-->", start + 4)
            at = close + 3 if close >= 0 else len(page)
            continue
        if page.startswith(("<!", "<?"), start):
            at = page.find(">", start) + 1
            continue
        m = NAME.match(page, start)
        if not m:
            out.add("<", links > 0)
            at = start + 1
            continue
        at = ends.after(page, m.end()) + 1
        closing, name, rest = m[1], m[2].lower(), page[m.end() : at - 1]
        if name == "a":
            links = 0 if closing else 1
        if name in RAW and not closing:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            at = page.find(">", end.start()) + 1 or len(page) if end else len(page)
            if name not in ("title", "script", "style"):
                out.end(*open_.state)
            continue
        if name in INLINE:
            continue
        out.end(*open_.state)
        if closing:
            open_.close(name)
            continue
        left, article = open_.state
        given = attributes(rest) if rest else {}
        marked = is_marked(name, given, article)
        if name in VOID or name in NOT_TRACKED and not marked:
            continue
        if not rest.endswith("/") or name != "path":
            article = article or name in ARTICLE or given.get("role") in ("main", "article")
            left = left or marked or name in LEFT_OUT or name == "header" and not article
            open_.push(name, left, article)
    out.end(*open_.state)
    return out.lines


def kept_range(lengths: list[int], threshold: int, window: int = WINDOW) -> range:
    """The lines from the first surge to the dive after the last one; none without a surge."""
    total = [sum(lengths[k : k + window]) for k in range(len(lengths))]
    surges = [k for k, value in enumerate(total) if value and value >= threshold]
    if not surges:
        return range(0)
    return range(surges[0], next((k for k in range(surges[-1], len(total)) if total[k] == 0), len(total)))


def main_text(page: str) -> str:
    lines = page_lines(page)
    marked = any(article and text for text, _, article, _ in lines)
    if marked:
        lengths = [len(text) if article else 0 for text, _, article, _ in lines]
        threshold = 1
    else:
        lengths = [0 if links > LINK_SHARE * len(text) else len(text) for text, _, _, links in lines]
        highest = max((sum(lengths[k : k + WINDOW]) for k in range(len(lengths))), default=0)
        threshold = min(SURGE, max(1, highest // 2))
    return " ".join(lines[k][0] for k in kept_range(lengths, threshold) if lengths[k])


def extractor() -> Callable[[str], tuple]:
    def extract(page: str) -> tuple:
        text = main_text(page)
        return text, len(text)

    return extract


def extract_text(df: DataFrame, page: str, keep: list[str]) -> DataFrame:
    """The columns ``keep``, the main text of every page and its length in code points (``n_chars``)."""
    return with_function(df, page, keep, extractor, "text string, n_chars long")
