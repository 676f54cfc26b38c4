"""Main text of web pages by tag-path ratios.

Text is split into blocks; a block's path is the chain of block elements from the root. Over each
path the lengths of text, of punctuation and of link text are summed; their ratios are smoothed
along the page, fused into one score a path, and compared with a threshold of the page's own: paths
that reach it are the article. Only elements that by what they are hold no article text (scripts,
menus, forms, what is hidden) are left out beforehand. A class name that speaks of adverts, notices
or comments, and a place outside a marked article, lower a path's score and rule nothing out.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship

#: Elements of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg canvas math textarea title audio video noframes noembed xmp".split())
#: Of RAW, those that hold text alone: nothing but their own end tag ends them, whatever the text looks like.
TEXT_ONLY = frozenset("script style noscript iframe textarea title noframes noembed xmp".split())
END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for t in TEXT_ONLY}
BLOCK = frozenset(
    "html head body address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
LEFT_OUT = frozenset("head nav header footer aside form button select dialog menu search fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Short blocks that belong to the text around them, and the elements between the two.
PARTS = frozenset("li td th dt dd pre".split())
BETWEEN = PARTS | frozenset("ul ol menu dl dir table tbody thead tfoot tr".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs header masthead footer "
    "sidebar aside cookie cookies consent gdpr notice notification alert banner popup modal overlay newsletter subscribe subscription share sharing social comment "
    "comments commentlist discussion disqus respond replies reply related recommended recommendations widget login signin signup register search toolbar pagination "
    "pager skip copyright disclaimer paywall teaser".split()
)
#: What an opening tag closes: the tags, and the elements beyond which it does not look.
CLOSES = {
    **{t: (frozenset(["p"]), frozenset(["table", "td", "th", "caption", "button"])) for t in BLOCK - frozenset("html head body".split())},
    "li": (frozenset(["li", "p"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd", "p"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd", "p"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th", "p"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th", "p"]), frozenset(["table", "tr"])),
    "tr": (frozenset(["td", "th", "tr", "p"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "body": (frozenset(["head"]), frozenset()),
}
#: Words that make a class name speak of a page's layout and not of what the element holds.
LAYOUT = frozenset("has with no without layout".split())
#: What speaks against an element: nothing, a name, or what it is.
IN, BY_NAME, BY_KIND = 0, 1, 2
#: Smoothing along the page; the plain length of a block that counts half; what a doubt leaves of a score.
KERNEL, LENGTH, DOUBT = np.array([0.2, 0.6, 0.2]), 80.0, 0.1
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
PUNCTUATION = re.compile(r"[.,;:!?…。、！？；：]")
SPACE = re.compile(r"\s+")


def _named_out(tag: str, value: str) -> bool:
    for token in value.split():
        parts = {x.lower() for x in NAME_PART.findall(token)}
        if tag in ("html", "body", "article", "main"):
            parts = {token.lower()}
        if parts & NAMES and not parts & LAYOUT:
            return True
    return False


def _left_out(tag: str, attributes: str) -> int:
    if tag in LEFT_OUT:
        return BY_KIND
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return IN
    out = IN
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id") and _named_out(tag, value):
            out = max(out, BY_NAME)
        elif name == "role" and value.strip().lower() in ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            out = BY_KIND
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            out = BY_KIND
    return out


class _Open:
    """The open elements of a page. Positions are kept by tag, so no search walks the stack."""

    def __init__(self):
        self.tags: list[str] = []
        #: what holds for text inside: left out, inside a marked article, named, path, element, container, within a part
        self.states: list[tuple] = []
        self.at: dict[str, list[int]] = defaultdict(list)

    def push(self, tag: str, state: tuple) -> None:
        self.at[tag].append(len(self.tags))
        if tag in BLOCK:
            self.at[""].append(len(self.tags))
        self.tags.append(tag)
        self.states.append(state)

    def nearest(self, tags) -> int:
        return max((self.at[t][-1] for t in tags if self.at[t]), default=-1)

    def cut(self, to: int) -> None:
        while len(self.tags) > to:
            tag = self.tags.pop()
            self.states.pop()
            self.at[tag].pop()
            if tag in BLOCK:
                self.at[""].pop()


@dataclass
class Page:
    """Blocks with text, in page order, and the tree of block elements above them."""

    text: list[str]
    links: list[int]  # characters of a block inside links
    path: list[int]  # number of the tag path; blocks of one path agree in ``named`` and ``inside``
    inside: list[bool]  # in a marked article
    named: list[bool]  # in an element whose class or id speaks of something else
    element: list[int]
    part: list[bool]  # in a list item, table cell or the like
    container: list[int]  # nearest element above that is neither such a part nor what lies between
    parents: list[int]
    heading: list[bool]


def blocks_of(page: str) -> Page:
    """One pass over the page; what elements of ``LEFT_OUT``, roles and hidden elements hold is not read."""
    out = Page(*([] for _ in fields(Page)))
    open_ = _Open()
    paths: dict[tuple, int] = {}
    root = (False, False, False, -1, -1, -1, False)
    text: list[str] = []
    links = 0

    def flush() -> None:
        nonlocal links
        if text:
            off, inside, named, path, element, container, part = open_.states[-1] if open_.states else root
            said = "" if off else SPACE.sub(" ", html.unescape("".join(text))).strip()
            if said:
                headed = bool(open_.at[""]) and open_.tags[open_.at[""][-1]] in HEADINGS
                own = (said, min(links, len(said)), path, inside, named, element, part, container)
                for field, x in zip((out.text, out.links, out.path, out.inside, out.named, out.element, out.part, out.container), own, strict=True):
                    field.append(x)
                out.heading.append(headed)
            text.clear()
        links = 0

    at, seen, raw = 0, 0, ""
    while m := TOKEN.search(page, seen):
        seen = m.end()
        tag = (m[2] or "").lower()
        alone = tag in TEXT_ONLY and not m[1] and not m[3].rstrip().endswith("/")
        if alone:
            end = END[tag].search(page, seen)
            seen = end.end() if end else len(page)
        if raw:
            if m[1] and tag == raw:
                raw, at = "", seen
                text.append(" ")
            continue
        said = page[at : m.start()]
        if said:
            text.append(said)
            if open_.at["a"]:
                links += len(said)
        at = seen
        if m[2] is None:
            continue
        if alone:
            text.append(" ")
            continue
        if m[1]:
            if tag in BLOCK:
                flush()
            place = open_.nearest((tag,))
            if place >= 0 and (tag in BLOCK or place > open_.nearest(("",))):
                open_.cut(place)
            continue
        if tag in BLOCK or tag == "hr":
            flush()
        if tag in RAW:
            if not m[3].rstrip().endswith("/"):
                raw = tag
            continue
        if tag in VOID:
            text.append(" ")
            continue
        if tag in CLOSES:
            ends, stops = CLOSES[tag]
            while (place := open_.nearest(ends)) > open_.nearest(stops):
                open_.cut(place)
        off, inside, named, path, element, container, part = open_.states[-1] if open_.states else root
        how, marked = _left_out(tag, m[3]), tag in ("article", "main") or 'role="main"' in m[3]
        marked = marked and how == IN and not off
        off, inside = off or how == BY_KIND, inside or marked
        named = how == BY_NAME or named and not marked
        if tag in BLOCK:
            path = paths.setdefault((path, tag, named, inside), len(paths))
            out.parents.append(element)
            element = len(out.parents) - 1
            part = part or tag in PARTS
            container = container if tag in BETWEEN else element
        open_.push(tag, (off, inside, named, path, element, container, part))
    if not raw:
        text.append(page[at:])
    flush()
    return out


def path_scores(p: Page) -> tuple[np.ndarray, np.ndarray]:
    """(score, share of link text) of the path of each block.

    Over a path, plain text and punctuation are summed and divided by its blocks, and each ratio is
    brought to 0..1; both are smoothed along the page and averaged over the path again. Their product
    is lowered by the path's links, by a class name that speaks of something else, and, where the
    page marks its article, by lying outside.
    """
    _, of = np.unique(np.array(p.path), return_inverse=True)
    n = np.bincount(of)
    size = np.array([len(t) for t in p.text], dtype=np.float64)
    links = np.array(p.links, dtype=np.float64)
    marks = np.array([len(PUNCTUATION.findall(t)) for t in p.text], dtype=np.float64)
    linked = (np.bincount(of, links) / np.bincount(of, size))[of]

    def smooth(v: np.ndarray) -> np.ndarray:
        along = np.convolve(np.pad(v[of], 1, mode="edge"), KERNEL, mode="valid")
        return (np.bincount(of, along) / n)[of]

    length, signs = np.bincount(of, size - links) / n, np.bincount(of, marks) / n
    score = smooth(length / (length + LENGTH)) * smooth((signs + 0.5) / (signs + 1.5)) * (1 - linked)
    inside = np.array(p.inside)
    return score * np.where(p.named, DOUBT, 1.0) * np.where(inside | ~inside.any(), 1.0, DOUBT), linked


def main_text(page: str | None, share: float = 0.35) -> str:
    """Text of the paths that reach ``share`` of the page's text-weighted level, and of what belongs to them.

    Of a marked article all blocks stay but those of paths that are links for more than half (unless
    all are) and those that a name puts in doubt. Elsewhere list items, table cells and
    preformatted text stay with the text around them, and headings with what they head.
    """
    p = blocks_of(page or "")
    if not p.text:
        return ""
    score, linked = path_scores(p)
    weight = np.array([len(t) for t in p.text]) * score
    level = float((weight * score).sum() / weight.sum()) if weight.sum() else np.inf
    good = score >= share * level
    dense = linked > 0.5
    inside, named, heading, part = (np.array(x) for x in (p.inside, p.named, p.heading, p.part))
    keep = np.where(inside & ~named, ~dense | bool(dense[inside].all()), good)
    holds = {x for i in np.flatnonzero(keep & ~part) for x in (p.element[i], p.parents[p.element[i]] if p.element[i] >= 0 else -1)} - {-1}
    keep |= part & ~dense & np.array([c in holds for c in p.container])
    under = [p.parents[e] if e >= 0 else -1 for e in p.element]
    held = {under[i] for i in np.flatnonzero(keep & ~heading)}
    keep = np.where(heading, np.array([u in held for u in under]) | keep & (inside | (not held)), keep)
    return "\n".join(t for t, k in zip(p.text, keep, strict=True) if k)


def extract_pages(pages: DataFrame, html_col: str = "html", column: str = "text") -> DataFrame:
    """``pages`` without ``html_col``, with the main text of each in ``column`` (replacing one of that name).

    Null and empty html, and pages without article text, give an empty text. Repeated rows are
    extracted each. Nothing is cut off: the longest page is the most that a task holds at once
    besides one Arrow batch.
    """
    ship(pages.sparkSession)
    kept = [c for c in pages.columns if c not in (html_col, column)]
    given = pages.select(F.col(html_col).alias("_html"), *[f"`{c}`" for c in kept])

    def run(batches):
        for b in batches:
            texts = [main_text(x) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(texts, pa.string())], names=[*kept, column])

    return given.mapInArrow(run, pages.select(*[f"`{c}`" for c in kept]).withColumn(column, F.lit("")).schema)
