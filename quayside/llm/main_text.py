"""Main text of web pages by the distribution of text over line blocks.

A page is cut into lines, one per block element, and parts that are no article by their markup (menus,
forms, adverts, comments and so on) are taken out, leaving empty lines. Text lengths are summed over a
sliding window of lines. A window that rises over the threshold is a surge; text is kept from the start
of its rise to the dive, where a whole window is empty. So the distribution finds where the article is; the
element that holds most of a kept text is its container, and what else is in the container stays too, however
short, unless it is mostly links: a menu or note inside the article ends no article. Article and main elements
are a hint only: they begin and end with a dive, they are containers, and where the texts with a surge inside them
are a fair share of all, the others go. Else, and on pages without such elements outside comments and scripts, all texts are
measured alike.

A class, id or role excludes an element if it is one of the known names as a whole (``sidebar``). If only a word of it is
(``search-results``), an element that holds others is excluded if it is short or mostly links, and a paragraph is not.

The markup is read by one scanner in one pass, also where it is broken or cut off: what a search did not find in the rest
of the page is not searched for again, and quotes that never close stop counting as quotes.

Pages are independent: there is no shuffle, and a task holds one Arrow batch.
"""

from __future__ import annotations

import heapq
import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Settings:
    """window: lines summed up. surge: signs in a window that begin a text. links: greatest share of link text.

    marked: least share of the text found that stands in an article or main, for the rest to go.
    """

    window: int = 3
    surge: int = 80
    links: float = 0.5
    marked: float = 0.25


DEFAULT = Settings()

_RAW = frozenset("script style noscript template textarea iframe title select svg object audio video canvas".split())
_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_PLAIN = re.compile(r"[^\"'>]*")
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_HOLDERS = frozenset("article blockquote body center details div dl figure header hgroup html main ol section table ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_OUT = frozenset("head nav aside footer form button dialog menu label".split())
# These end a text; the others may stand in the middle of one, and leave a single empty line.
_ENDS = frozenset("nav navbar navigation menu sidebar aside footer header masthead comment comments commentlist respond replies disqus".split())
_OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar aside widget footer masthead topbar toolbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations comment comments commentlist respond reply replies disqus pagination pager search".split()
)


class _Scanner:
    """The tags and texts of a page in one pass."""

    def __init__(self, page: str):
        self.page = page
        self.none: set[str] = set()  # what does not occur from some place on is not searched for again
        self.quoted = True

    def find(self, what: str, at: int) -> int:
        if what in self.none:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.none.add(what)
        return found

    def tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag, quotes minded while they close; -1 if there is none."""
        if (first := self.find(">", at)) < 0 or not self.quoted:
            return first
        place = at
        while True:
            place = _PLAIN.match(self.page, place).end()
            if place >= len(self.page):
                break
            if self.page[place] == ">":
                return place
            place = self.find(self.page[place], place + 1) + 1
            if not place:
                break
        self.quoted = False  # some quote never closes: from here on none counts
        return first

    def raw_end(self, name: str, at: int) -> int:
        """Place behind the closing tag of an element whose content is no markup."""
        if f"</{name}" in self.none:
            return len(self.page)
        found = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(self.page, at)
        if not found:
            self.none.add(f"</{name}")
            return len(self.page)
        return found.end()

    def __iter__(self) -> Iterator[tuple[str, str, bool, str]]:
        """(text, "", False, "") or ("", tag name, whether it closes, its attributes)."""
        page, at, text = self.page, 0, 0
        while (at := page.find("<", at)) >= 0:
            after = page[at + 1 : at + 2]
            stop = -1
            if page.startswith("<!--", at):
                stop = self.find("-->", at + 4) + 3
                stop = stop if stop > 2 else len(page)
            elif page.startswith("<![CDATA[", at):
                stop = self.find("]]>", at) + 3
                stop = stop if stop > 2 else len(page)
            elif after in ("!", "?"):
                stop = self.find(">", at) + 1 or len(page)
            elif tag := _TAG.match(page, at):
                end = self.tag_end(tag.end())
                if end >= 0:
                    if text < at:
                        yield page[text:at], "", False, ""
                    name, closes = tag[1].lower(), after == "/"
                    rest = page[tag.end() : end]
                    text = at = self.raw_end(name, end + 1) if name in _RAW and not closes and not rest.endswith("/") else end + 1
                    if name not in _RAW:
                        yield "", name, closes, rest
                    continue
            if stop < 0:
                at += 1  # a sign like any other
                continue
            if text < at:
                yield page[text:at], "", False, ""
            text = at = stop
        if text < len(page):
            yield page[text:], "", False, ""


def _names(rest: str) -> set[str]:
    return {token for found in _NAMED.findall(rest) for token in "".join(found).lower().split()}


def _words(names: set[str]) -> set[str]:
    return {word for name in names for word in re.split(r"[_\-]+", name)}


def _is_out(name: str, names: set[str], rest: str, inside: bool) -> bool:
    if name in _OUT or name == "header" and not inside:
        return True
    if not rest or name in ("html", "body", "article", "main"):
        return False
    return bool(names & _OUT_NAMES) or not inside and "header" in names or bool(_HIDDEN.search(rest))


@dataclass
class Lines:
    """Text lines of a page, white space made single: the signs in links of each, the article or main it stands in (0: none), and its element."""

    text: list[str]
    links: list[int]
    marks: list[int]
    holder: list[int]
    parent: list[int]  # of each element
    tag: list[str]

    def add(self, text: str, links: int, mark: int, holder: int) -> None:
        for column, value in zip((self.text, self.links, self.marks, self.holder), (text, links, mark, holder), strict=True):
            column.append(value)

    def clear(self, start: int) -> None:
        """Lines from ``start`` on become one empty line."""
        for column in (self.text, self.links, self.marks, self.holder):
            del column[start:]
        self.add("", 0, 0, 0)


def lines_of(page: str, settings: Settings = DEFAULT) -> Lines:
    lines = Lines([], [], [], [], [0], [""])
    text: list[str] = []
    linked: list[str] = []
    open_: list[tuple[str, int, int]] = []  # name, element, first line if the element is to be judged at its end, else -1
    count: Counter[str] = Counter()
    out_name, out_depth, inside, mark, anchors = "", 0, 0, 0, 0

    def end_line() -> None:
        if line := " ".join(html.unescape("".join(text)).split()):  # markup alone makes no empty line
            lines.add(line, len(" ".join(html.unescape("".join(linked)).split())), mark if inside else 0, open_[-1][1] if open_ else 0)
        text.clear()
        linked.clear()

    def gap(size: int) -> None:
        end_line()
        for _ in range(size):
            lines.add("", 0, 0, 0)

    def close(name: str) -> None:
        while count[name]:
            last, _, start = open_.pop()
            count[last] -= 1
            if start >= 0:
                size, links = sum(map(len, lines.text[start:])), sum(lines.links[start:])
                if size < settings.surge or links > settings.links * size:
                    lines.clear(start)
            if last == name:
                break

    for piece, name, closing, rest in _Scanner(page):
        if not name:
            if not out_depth:
                text.append(piece)
                if anchors:
                    linked.append(piece)
            continue
        if out_depth:
            if name == out_name:
                out_depth += -1 if closing else 0 if rest.endswith("/") else 1
            if name in ("article", "main", "body") and not closing and out_name not in ("article", "main") and out_name != name and (name == "body" or not inside):
                out_depth = 0  # an element that was never closed does not swallow the article
            elif out_name == "head" and name == "body":
                out_depth = 0
            else:
                continue
        if name == "br" and text:
            text.append(" ")
        elif name == "a":
            anchors = 0 if closing else 1
        if name in _BLOCKS:
            end_line()
        if closing:
            close(name)
            if name in ("article", "main"):
                inside = max(0, inside - 1)
                if not inside:
                    gap(settings.window)
            continue
        if name in _VOID or rest.endswith("/"):
            continue
        names = _names(rest) if rest else set()
        if name not in ("article", "main") and _is_out(name, names, rest, inside > 0):
            out_name, out_depth = name, 1
            gap(settings.window if name in _ENDS or _words(names) & _ENDS else 1)
            continue
        if name in ("article", "main"):
            if not inside:
                gap(settings.window)
                mark = len(lines.parent)
            inside += 1
        if name in _HOLDERS:
            doubtful = name not in ("html", "body", "article", "main") and _words(names) & (_OUT_NAMES if inside else _OUT_NAMES | {"header"})
            lines.parent.append(open_[-1][1] if open_ else 0)
            lines.tag.append(name)
            open_.append((name, len(lines.parent) - 1, len(lines.text) if doubtful else -1))
            count[name] += 1
    end_line()
    return lines


def _container(lines: Lines, part: np.ndarray, length: np.ndarray, share: float = 0.75) -> int:
    """The innermost element with most of the text of a part; 0 if that is the page's body."""
    weight: Counter[int] = Counter()
    for i in part:
        weight[lines.holder[i]] += int(length[i])
    total, heap = sum(weight.values()), [-k for k in weight]
    heapq.heapify(heap)
    while heap:  # elements before their parents
        element = -heapq.heappop(heap)
        if weight[element] >= share * total:
            return 0 if lines.tag[element] in ("", "body", "html") else element
        up = lines.parent[element]
        if up not in weight:
            heapq.heappush(heap, -up)
        weight[up] += weight[element]
    return 0


def _within(lines: Lines, containers: set[int]) -> np.ndarray:
    """Which lines stand in one of the elements."""
    inside = [False] * len(lines.parent)
    for element in range(1, len(lines.parent)):  # parents come first
        inside[element] = element in containers or inside[lines.parent[element]]
    return np.array([inside[h] for h in lines.holder])


def extract(page: str | None, settings: Settings = DEFAULT) -> str:
    """The main text of one page: its lines joined by line feeds, empty if there is none."""
    if not page:
        return ""
    lines = lines_of(page, settings)
    length = np.array([len(x) for x in lines.text])
    full = np.flatnonzero(length)
    if not len(full):
        return ""
    sums = np.convolve(length, np.ones(settings.window, np.int64))[: len(length)]
    dives = np.flatnonzero(np.diff(full) > settings.window)
    parts = np.split(full, dives + 1)
    peaks = [int(sums[p[0] : p[-1] + 1].max()) for p in parts]
    shares = [sum(lines.links[i] for i in p) / max(1, int(length[p].sum())) for p in parts]
    good = [k for k, (peak, share) in enumerate(zip(peaks, shares, strict=True)) if peak >= settings.surge and share <= settings.links]
    inner = [k for k in good if lines.marks[parts[k][0]]]
    if inner and sum(length[parts[k]].sum() for k in inner) >= settings.marked * sum(length[parts[k]].sum() for k in good):
        good = inner
    if not good:  # a short page has no surge: its highest part is its text, a marked one before others
        good = [max(range(len(parts)), key=lambda k: (lines.marks[parts[k][0]] > 0, shares[k] <= settings.links, peaks[k], -k))]
    containers = {lines.marks[parts[k][0]] or _container(lines, parts[k], length) for k in good} - {0}
    within = _within(lines, containers)
    kept = [p if k in good else p[within[p]] for k, p in enumerate(parts) if k in good or shares[k] <= settings.links]
    return "\n".join(lines.text[i] for p in kept for i in p)


def main_texts(pages: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """``pages`` (page_id, url, html, ...) -> page_id, url, text, n_chars, one row per row.

    Null and empty pages, and pages without text, get an empty text. Pages are read whole, whatever
    their length; markup may be broken or cut off. Character references are decoded, white space
    inside a line becomes one space, lines are joined by line feeds in page order. Null and repeated
    page_ids are carried along. Other columns are not read. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page.as_py(), settings) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    wanted = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return wanted.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
