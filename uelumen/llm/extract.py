"""Main text of web pages by line-block distribution.

Markup is stripped into *lines* (text between block-level tags, character references decoded, white space collapsed). A line weighs its
characters outside links; one inside a menu, header, footer, sidebar, notice, advert, form, script, style or reader comments weighs
nothing, one inside an element that calls itself the article (``article``, ``main``, ``role=main``, ``itemprop=articleBody``) ``NAMED`` times
as much: tags and names are evidence, the distribution decides. Weights are summed over sliding windows of ``WINDOW`` lines. Where the sum
rises above ``SURGE`` of its greatest value is a surge, where it falls to that again a dive; stretches at most ``GAP`` lines apart are one. The stretch of
greatest weight is the core of the text. It lies in a box: the article named that holds most of it, else the smallest element that holds ``SHARE`` of it.

The text is what the box holds, boilerplate left out: a named article from end to end; in another box the lines between surge and dive, short ones too,
and on both sides the lines up to one that is mostly links (if the box is the whole page, only those of the same element, and headings).

Every step is linear in the page. Defined results: null html gives empty text; unclosed and wrongly nested tags are tolerated, a tag that
nothing closes ends the page; repeated pages are extracted each; a page is read whole; of stretches of equal weight the first is the core; a page without main text
gives empty text; only page_id, url and html are read, whatever other columns there are; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from uelumen.llm.common import map_texts, text_values

WINDOW = 3
SURGE = 0.15
GAP = 2
NAMED = 3
SHARE = 0.8
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</?([a-zA-Z][\w:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+|[^>]*+)>""", re.S)
UNCLOSED = re.compile(r"<[a-zA-Z/]")
ATTRIBUTE = re.compile(r"""([\w:-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
# fixed values: HTML element kinds
RAW = frozenset("script style noscript template iframe svg math textarea title object canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split())
AWAY = frozenset("nav header footer aside form button select dialog menu head fieldset".split())
TEXT_BLOCK = frozenset("p li h1 h2 h3 h4 h5 h6 dt dd option tr td th".split())
HEADINGS = frozenset("h1 h2 h3".split())
BOX = frozenset("article aside body center details div fieldset footer form header html main nav section td th".split())
DEEP = 64
# fixed values: words of class, id and role names that mark boilerplate
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner promo promotion sponsor sponsored nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar side aside "
    "notice notices notification alert cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login comment comments commentlist respond reply replies disqus discussion "
    "share sharing social related recommended recommendations widget toolbar pagination pager search searchbox form copyright complementary contentinfo paywall".split()
)
ARTICLE_MARKS = frozenset(["articlebody", "main"])
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _kind(tag: str, attributes: str) -> str:
    """``away`` for boilerplate, ``article`` for a named article, else empty."""
    kind = "article" if tag in ("article", "main") else "away" if tag in AWAY else ""
    if not attributes.strip():
        return kind
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return "away"
        if name in ("role", "itemprop") and value.lower() in ARTICLE_MARKS:
            kind = kind or "article"
        elif name in ("class", "id", "role") and tag not in ("html", "body"):
            for one in value.split():
                words = [w.lower() for w in WORD.findall(one)]
                # a mark counts as the whole name, its first or its last word: "post-comments", "ad_top", not "main-content-header-less"
                if words and (words[0] in MARKS or words[-1] in MARKS) and kind != "article":
                    return "away"
                if words and len(words) == 1 and words[0] in MARKS:
                    return "away"
    return kind


class Line:
    __slots__ = ("text", "linked", "away", "article", "box", "heading")

    def __init__(self, text: str, linked: int, away: bool, article: int, box: int, heading: bool):
        self.text, self.linked, self.away, self.article, self.box, self.heading = text, linked, away, article, box, heading


class Page:
    """Lines of a page, and its boxes in page order: ``parent`` and ``end`` (the first box after those inside) of each, ``article`` of named ones."""

    def __init__(self, page: str):
        self.lines: list[Line] = []
        self.parent, self.end, self.article_box, self.whole = [-1], [0], {0: 0}, {0}
        self.parts: list[str] = []
        self.linked = self.away = self.links = self.articles = 0
        self.stack: list[tuple[str, str, int, int, bool]] = []  # tag, kind, article, box, heading
        self.open: Counter[str] = Counter()
        self.own, self.box, self.headings, self.menus = 0, 0, 0, 0
        self._read(page)
        self._flush()
        while self.stack:
            self._pop()
        self.end[0] = len(self.parent)

    def _flush(self) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                self.lines.append(Line(text, self.linked, self.away > 0, self.own, self.box, self.headings > 0))
            self.parts.clear()
        self.linked = 0

    def _push(self, tag: str, kind: str, *, boxed: bool) -> None:
        heading = tag in HEADINGS
        self.stack.append((tag, kind, self.own, self.box if boxed else -1, heading))
        self.open[tag] += 1
        self.headings += heading
        self.away += kind == "away"
        self.menus += kind == "away" and tag in AWAY
        self.links += tag == "a"
        if boxed:
            self.parent.append(self.box)
            self.end.append(0)
            self.box = len(self.parent) - 1
            if tag in ("html", "body"):
                self.whole.add(self.box)

    def _pop(self) -> None:
        tag, kind, own, box, heading = self.stack.pop()
        self.open[tag] -= 1
        self.headings -= heading
        self.away -= kind == "away"
        self.menus -= kind == "away" and tag in AWAY
        self.links -= tag == "a"
        self.own = own
        if box >= 0:
            self.end[self.box] = len(self.parent)
            self.box = box

    def _close(self, tag: str) -> None:
        if self.open[tag]:
            while self.stack[-1][0] != tag:
                self._pop()
            self._pop()

    def _read(self, page: str) -> None:
        last = page.rfind(">") + 1
        if m := UNCLOSED.search(page, last):  # no tag is closed from here on
            page = page[: m.start()]
        at, n = 0, len(page)
        while at < n:
            m = TOKEN.search(page, at)
            if m is None:
                self.parts.append(page[at:])
                self.linked += (n - at) * (self.links > 0)
                return
            if m.start() > at:
                self.parts.append(page[at : m.start()])
                self.linked += (m.start() - at) * (self.links > 0)
            at = m.end()
            tag = (m[1] or "").lower()
            if not tag:
                continue
            if tag in BLOCK:
                self._flush()
            if page[m.start() + 1] == "/":
                self._close(tag)
            elif tag in RAW:
                if not m[2].rstrip().endswith("/"):
                    end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
                    at = end.end() if end else n
            elif tag not in VOID and (tag in BLOCK or not m[2].rstrip().endswith("/")):
                self._start(tag, _kind(tag, m[2]))

    def _start(self, tag: str, kind: str) -> None:
        if kind == "article" and not self.own:
            while self.menus:  # an unclosed menu or header ends here
                self._pop()
            if not self.away:
                self._push(tag, kind, boxed=True)
                self.articles += 1
                self.own = self.articles
                self.article_box[self.own] = self.box
                return
        if tag in TEXT_BLOCK and tag != "li":  # its start ends an open paragraph, or one of its kind
            while self.stack and self.stack[-1][0] not in BLOCK and (self.open["p"] or self.open[tag]):
                if not self._inside(tag):
                    break
                self._pop()
            if self.stack and self.stack[-1][0] in ("p", tag):
                self._pop()
        if tag in HEADINGS and self.own and self.away and self.stack[-1][:2] == ("header", "away") and self.away == 1:
            self.away, self.menus = 0, self.menus - 1  # the title inside an article's header is the article's
            self.stack[-1] = ("header", "", *self.stack[-1][2:])
        self._push(tag, kind, boxed=tag in BOX)

    def _inside(self, tag: str) -> bool:
        """Whether the innermost block that is open is a paragraph or of the kind given."""
        inner = next((t for t, *_ in reversed(self.stack[-DEEP:]) if t in BLOCK), "")
        return inner in ("p", tag)


def stretches(sums: np.ndarray) -> list[tuple[int, int]]:
    """(surge, dive) of each rise of the window sums, dive exclusive; those with at most ``GAP`` lines between are one."""
    above = np.concatenate([[False], sums > SURGE * sums.max(), [False]])
    turns = np.flatnonzero(above[1:] != above[:-1]).reshape(-1, 2).tolist()
    found: list[tuple[int, int]] = []
    for surge, dive in turns:
        if found and surge - found[-1][1] <= GAP:
            found[-1] = found[-1][0], dive
        else:
            found.append((surge, dive))
    return found


def core_of(weights: np.ndarray) -> tuple[int, int] | None:
    """The stretch of greatest weight between surge and dive, without lines at its ends that weigh nothing."""
    if not weights.any():
        return None
    half = WINDOW // 2
    padded = np.concatenate([[0], np.cumsum(weights)])
    at = np.arange(len(weights))
    sums = padded[np.minimum(at + half + 1, len(weights))] - padded[np.maximum(at - half, 0)]
    surge, dive = max(stretches(sums), key=lambda s: padded[s[1]] - padded[s[0]])
    inside = np.flatnonzero(weights[surge:dive])
    return surge + int(inside[0]), surge + int(inside[-1]) + 1


def box_of(page: Page, weights: np.ndarray, core: tuple[int, int]) -> tuple[int, bool]:
    """The box of the core, and whether it is a named article."""
    inside = range(*core)
    named: Counter[int] = Counter()
    held = np.zeros(len(page.parent))
    for i in inside:
        if weights[i]:
            named[page.lines[i].article] += int(weights[i])
            held[page.lines[i].box] += weights[i]
    total = sum(named.values())
    article, most = max(named.items(), key=lambda x: x[1])
    if article and 2 * most > total:
        return page.article_box[article], True
    box = int(held.argmax())
    for i in range(len(held) - 1, 0, -1):  # boxes inside come later
        held[page.parent[i]] += held[i]
    while held[box] < SHARE * total:
        box = page.parent[box]
    return box, False


def main_text(text: str) -> str:
    page = Page(text)
    lines = page.lines
    weights = np.array([0 if x.away else max(0, len(x.text) - x.linked) * (NAMED if x.article else 1) for x in lines], np.int64)
    core = core_of(weights)
    if core is None:
        return ""
    box, named = box_of(page, weights, core)
    first, last = box, page.end[box]
    keep = [i for i, x in enumerate(lines) if first <= x.box < last and not x.away]
    if not named:
        surge, dive = core
        wide = box in page.whole
        plain = lambda i, by: not lines[i].away and 2 * lines[i].linked < len(lines[i].text) and (not wide or lines[i].box == lines[by].box or lines[i].heading)
        while surge and first <= lines[surge - 1].box < last and plain(surge - 1, surge):
            surge -= 1
        while dive < len(lines) and first <= lines[dive].box < last and plain(dive, dive - 1):
            dive += 1
        keep = [i for i in keep if surge <= i < dive]
    return "\n".join(lines[i].text for i in keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row."""

    def kernel(batch: pa.RecordBatch) -> dict:
        texts = [main_text(h) for h in text_values(batch.column("html"))]
        out = {n: batch.column(n) for n in ("page_id", "url")}
        return out | {"text": pa.array(texts, pa.string()), "n_chars": pa.array(list(map(len, texts)), pa.int64())}

    kinds = ", ".join(f"{n} {pages.schema[n].dataType.simpleString()}" for n in ("page_id", "url"))
    return map_texts(pages.select("page_id", "url", "html"), kernel, f"{kinds}, text string, n_chars long")
