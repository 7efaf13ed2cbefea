"""Main text of web pages by the distribution of text over lines.

Markup is stripped to one line per block. Elements that are never main text (scripts, navigation, forms, and those whose class or id says
advert, comment, notice and the like) go first. The lengths of the other lines, without their links' text, are summed over sliding
windows. Text surges where a window's sum passes a threshold and dives where windows run empty; all that lies between a surge point and its
dive point is kept, every such stretch of the page. Lines inside <article> or <main> count some characters more: evidence, which
short lines need to surge, but neither needed nor enough by itself. Where no window surges, the fullest one does.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from html import unescape

from pyspark.sql import DataFrame

from gaugeworks.llm.common import map_texts

#: Lines of a window; characters of a window at which text surges; characters that a line inside the main part counts more.
WINDOW, SURGE, PRIOR = 3, 86, 40

#: Elements by name. Fixed values of HTML.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td "
    "tfoot th thead title tr ul".split()
)
RAW = "script|style|textarea|title|xmp|iframe|noembed|noframes|noscript|template|svg|math|object|canvas"
NEVER = set("nav footer aside form dialog menu button select fieldset datalist audio video head".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class, id or role that mark an element as no main text; those that only mark where no word of the main part stands beside
#: them (as in post-header); and words that take any mark back (as in no-sidebar).
MARKED = set(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent contentinfo "
    "cookie cookies disqus footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices overlay "
    "pager pagination popup promo promoted promotion recommended related search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription tags toolbar warning widget alert discussion replies reply respond".split()
)
LAYOUT = set("header sidebar widget warning alert".split())
OF_MAIN = set("article content body main post entry story text".split())
SPARED = set("has no with without".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<({RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?<!/)>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PARTS = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")


def dropped(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element is no main text. A <header> inside the main part holds its title."""
    if name in NEVER or name == "header" and not inside:
        return True
    if name in ("html", "body", "main", "header") or "=" not in attributes:
        return False
    words: set[str] = set()
    for _, *values in NAMED.findall(attributes):
        for value in "".join(values).split():
            own = {w.lower() for w in re.split(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])", value) if w}
            if not own & SPARED:
                words |= own - LAYOUT if own & OF_MAIN else own
    return bool(words & MARKED)


def lines_of(html: str) -> list[tuple[str, int, bool]]:
    """Text of each block, the length of its links' text, and whether it is in the main part."""
    out: list[tuple[str, int, bool]] = []
    text: list[str] = []
    state = {"links": 0}
    skip, depth, inside, anchor, at = "", 0, 0, 0, 0
    last = html.rfind(">") + 1  # no tag ends behind it
    ends: dict[str, int] = {}

    def ending_of(name: str) -> int:
        """Where the last closing tag of a name stands; searched for once."""
        if name not in ends:
            found = -1
            for m in re.finditer(f"</{re.escape(name)}", html, re.I):
                found = m.start()
            ends[name] = found
        return ends[name]

    def close() -> None:
        line = " ".join("".join(text).split())
        if line:
            out.append((line, min(state["links"], len(line)), inside > 0))
        text.clear()
        state["links"] = 0

    for m in TOKEN.finditer(html, 0, last):
        if not skip and m.start() > at:
            piece = unescape(html[at : m.start()])
            text.append(piece)
            if anchor:
                state["links"] += len(" ".join(piece.split()))
        at = m.end()
        if m[3] is None:
            if at == last and (m[0].startswith("<!--") and not m[0].endswith("-->") or m[1] and not re.search(rf"</{m[1]}\s*>\Z", m[0], re.I)):
                at = len(html)  # it never ends
            continue
        name, ending, attributes = m[3].lower(), bool(m[2]), m[4]
        if skip:
            if name == skip and not attributes.endswith("/"):
                depth += -1 if ending else 1
                if not depth:
                    skip = ""
            continue
        if name in BLOCKS:
            close()
        elif name == "br":
            text.append(" ")
        if name == "a":
            anchor = 0 if ending else 1
        if name in VOID or attributes.endswith("/"):
            continue
        if not ending and dropped(name, attributes, inside > 0):
            if ending_of(name) >= at:  # one that never ends would hide the rest of the page
                close()
                skip, depth = name, 1
                continue
        if name in ("article", "main"):
            inside = max(0, inside + (-1 if ending else 1))
    if not skip:
        text.append(unescape(html[at:].partition("<!--")[0]))
    close()
    return out


def main_text(html: str | None, window: int = WINDOW, surge: int = SURGE, prior: int = PRIOR) -> str:
    lines = lines_of(html) if html else []
    text = [len(t) - links for t, links, _ in lines]
    weight = [n + prior if inside else n for n, (*_, inside) in zip(text, lines, strict=True)]
    sums = [sum(weight[i : i + window]) for i in range(len(weight))]
    enough = min(surge, max(sums, default=0) - 1)
    kept: list[str] = []
    start = None
    for i, total in enumerate(sums):
        if start is None and weight[i] and total > enough:
            start = i
        if start is not None and not any(weight[i + 1 : i + 1 + window]):
            kept += [t for t, *_ in lines[start : i + 1]]
            start = None
    return "\n".join(kept)


def extract(pages: DataFrame, keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """The kept columns with text and n_chars (its code points).

    A null or empty page, and one without text, give an empty text; every row gives one row, repeated ones too. No page is cut short.
    """

    def make() -> Callable:
        def run(pages: list[str | None]) -> list[list]:
            texts = [main_text(p) for p in pages]
            return [texts, [len(t) for t in texts]]

        return run

    return map_texts(pages, keep, "text string, n_chars long", make, column="html")
