"""Main text of pages: what stays in an article, a line-block version of its own, and time that grows with the page."""

import random
import time
from html.parser import HTMLParser

import pytest

from quayside.llm import main_text

LONG = " ".join(f"word{i}" for i in range(60))


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<article><p>{LONG}</p><aside>side</aside><p>The end.</p></article>", [LONG, "The end."]),
        (f"<article><h1>Head</h1><p>{LONG}</p><nav><a href=x>m</a></nav><h2>Sub</h2><p>Last.</p></article>", ["Head", LONG, "Sub", "Last."]),
        (f"<article><p>{LONG} <math><mi>x</mi></math> is</p></article>", [f"{LONG} x is"]),
        (f"<article><p>{LONG}</p><p class='share-price'>Up 5.</p><div class='search-results'><p>{LONG}</p></div></article>", [LONG, "Up 5.", LONG]),
        (f"<body><div id=c><p>{LONG}</p><div class=sidebar>x</div><p>End.</p></div><div class='cookie-notice'>We use</div><p>Copyright</p></body>", [LONG, "End."]),
        (f"<div><p>{LONG}</p><div class='related-links'><p><a href=1>{LONG}</a></p></div><p>End.</p></div>", [LONG, "End."]),
        (f"<main><h1>T</h1><section><p>{LONG}</p></section><section class=comments><p>{LONG}</p></section><p>End.</p></main>", ["T", LONG, "End."]),
        (f"<div><header>Site</header><article><header><h1>Title</h1></header><p>{LONG}</p></article></div>", ["Title", LONG]),
    ],
)
def test_what_markup_does_not_exclude_stays(page, want):
    assert main_text.extract(page) == "\n".join(want)


@pytest.mark.parametrize("piece", ["<script ", "<a ", '<a "', "<!-- ", "<a '\">\"", "<a '>x", '<a "> "', "</x", "<div>", '<p><div class="a-nav">', "<![CDATA[ ", "&amp", "<textarea>", "</div"])
def test_time_grows_with_the_page(piece):
    """Broken markup of up to a million signs. Four times the page may take ten times the time at most: twice four, and noise."""

    def took(size):
        page = piece * (size // len(piece))
        began = time.process_time()
        main_text.extract(page)
        return time.process_time() - began

    assert took(1_000_000) <= 0.2 + 10 * took(250_000)


def test_broken_markup():
    assert main_text.extract(f"<p>{LONG}<b") == f"{LONG}<b"
    assert main_text.extract(f"<p>{LONG}</p><a title=\"never closed>{LONG}") == f"{LONG}\n{LONG}"
    assert main_text.extract(f"<p title='a>b'>{LONG} 1 < 2 <3</p>") == f"{LONG} 1 < 2 <3"
    assert main_text.extract(f"<nav><ul><li>menu</li><article><p>{LONG}</p></article>") == LONG
    assert main_text.extract("<!--" + LONG) == "" and main_text.extract(f"<script>{LONG}") == ""


class Plain(HTMLParser):
    """Lines of well-formed pages of a few elements, by another parser and plain loops."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.text, self.linked, self.out, self.path = [], "", "", 0, []

    def end(self):
        if line := " ".join(self.text.split()):
            self.lines.append((line, len(" ".join(self.linked.split())), tuple(self.path)))
        self.text = self.linked = ""

    def handle_starttag(self, tag, attributes):
        names = dict(attributes).get("class") or ""
        if self.out or tag in ("nav", "footer") or names in ("ad", "sidebar"):
            if not self.out:
                self.end()
                self.lines += [("", 0, ())] * (main_text.DEFAULT.window if tag in ("nav", "footer") or names == "sidebar" else 1)
            self.out += 1
            return
        if tag != "a":
            self.end()
        if tag in ("div", "ul"):
            self.path.append(f"{tag}{len(self.lines)}-{self.getpos()}")
        self.link = tag == "a"

    def handle_endtag(self, tag):
        if self.out:
            self.out -= 1
            return
        if tag != "a":
            self.end()
        if tag in ("div", "ul"):
            self.path.pop()
        self.link = False

    def handle_data(self, data):
        if not self.out:
            self.text += data
            self.linked += data if getattr(self, "link", False) else ""


def brute(page):
    parser = Plain()
    parser.feed(page)
    parser.end()
    lines, rules = parser.lines, main_text.DEFAULT
    parts, gap = [[]], rules.window
    for i, line in enumerate(lines):
        if line[0]:
            if gap >= rules.window and parts[-1]:
                parts.append([])
            parts[-1].append(i)
            gap = 0
        else:
            gap += 1
    parts = [p for p in parts if p]
    kept = set()
    share = lambda p: sum(lines[i][1] for i in p) / sum(len(lines[i][0]) for i in p)
    peak = lambda p: max(sum(len(lines[k][0]) for k in range(max(0, i - rules.window + 1), i + 1)) for i in range(p[0], p[-1] + 1))
    good = [p for p in parts if peak(p) >= rules.surge and share(p) <= rules.links]
    if not parts:
        return ""
    for p in good or [max(parts, key=lambda p: (share(p) <= rules.links, peak(p), -p[0]))]:
        kept |= set(p)
        total = sum(len(lines[i][0]) for i in p)
        holders = {lines[i][2][:k] for i in p for k in range(1, len(lines[i][2]) + 1)}
        full = [h for h in holders if sum(len(lines[i][0]) for i in p if lines[i][2][: len(h)] == h) >= 0.75 * total]
        if full:
            holder = max(full, key=len)
            kept |= {i for q in parts if share(q) <= rules.links for i in q if lines[i][2][: len(holder)] == holder}
    return "\n".join(lines[i][0] for i in sorted(kept))


def random_page(rng, depth=0):
    out = []
    for _ in range(rng.randrange(1, 7)):
        words = " ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice([1, 3, 12, 40])))
        kind = rng.randrange(9)
        if kind < 4:
            out.append(f"<p>{words}</p>")
        elif kind == 4:
            out.append(f"<ul><li><a href=x>{words}</a></li><li><a href=y>more</a></li></ul>")
        elif kind == 5:
            out.append(f"<nav>{words}</nav>")
        elif kind == 6:
            out.append(rng.choice(["<div class=ad>", "<div class=sidebar>", "<footer>"]) + words + "</div>")
            out[-1] = out[-1].replace("</div>", "</footer>") if "footer" in out[-1] else out[-1]
        elif depth < 2:
            out.append(f"<div>{random_page(rng, depth + 1)}</div>")
    return "".join(out)


def test_against_a_plain_version():
    rng = random.Random(4)
    found = 0
    for _ in range(1500):
        page = random_page(rng)
        want = brute(page) if any(c.isalnum() for c in page) else ""
        assert main_text.extract(page) == want, page
        found += bool(want)
    assert found > 1200
