"""Operator 6: main text of HTML pages by tag-path ratios.

A page is read once into blocks: the text between two boundaries of block elements, with its
root-to-leaf tag path (tags with their class names; the outermost article or main element is part of the path). Per path, text length and punctuation count
are summed over its blocks; their means are the path's ratios. Along the page both are smoothed with a Gaussian
window and fused (length x punctuation), and a path is content if its score reaches a threshold.

On pages without an article the score is the fused mean and the threshold a share of the spread of all paths. Where a page names
articles (article, main, role=main), lying in one is a feature of a path: it adds the best fused mean of such paths, which is then the
threshold too, so all of an article stays, and a path outside has to be as rich as the best one inside. An article is one by its own ratios: a
teaser, whose mean is below `TEASER` of the strongest article's or that is mostly links, adds nothing. Inside elements that are boilerplate by their kind (navigation,
headers, footers, asides, forms, scripts) or by a plain name (adverts, comments, cookies) nothing counts. A name that may be
a topic as well (legal, discussion, notice) is a feature only: it takes away a quarter of what the article adds, or asks for the page's mean.

The page is scanned once: an element knows the elements that could close before it, so neither unclosed tags nor deep nesting are scanned again.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_OPENS = re.compile(r"<(?:(/?)([a-zA-Z][a-zA-Z0-9:-]*)|!--|[!?/])")
_STOPS = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_PUNCTUATION = re.compile(r"[.,;:!?…、。，！？；：]")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text of the page, up to their end tag.
RAW = frozenset("script style textarea title noscript template iframe svg math object select button xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
BOILERPLATE_TAGS = frozenset("nav header footer aside form dialog menu fieldset".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of class names and ids.
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo nav navbar navigation menu menus breadcrumb breadcrumbs "
    "masthead footer sidebar aside rail widget widgets comment comments disqus replies respond cookie cookies consent gdpr "
    "popup modal overlay subscribe subscription newsletter signup login share sharing social related recommended recommendations trending "
    "pagination pager toolbar".split()
)
#: Words that may name a topic: one of them is a feature of the path's score, two are boilerplate.
DOUBTFUL_NAMES = frozenset("header notice notices banner alert reply discussion form search promotion copyright legal disclaimer".split())
TEASER = 0.25
MAIN_ROLES = frozenset({"main", "article"})
#: A start tag of the key ends open elements of these kinds (within their parent).
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead"), "tfoot": ("tr", "td", "th", "tbody"),
}
SCOPES = frozenset("ul ol dl table article section div main body html blockquote td th nav aside header footer form figure".split())


@dataclass
class Block:
    path: int  # number of its tag path
    leaf: str  # tag of the path's last element
    text: str
    boilerplate: bool
    doubtful: bool  # inside an element with a doubtful name
    article: int  # number of the outermost article it lies in, or -1
    links: int  # characters inside links


@dataclass
class _Open:
    """An open element; what it inherits from those around it is copied, so it is found without a scan."""

    tag: str
    path: int
    leaf: str
    boilerplate: bool
    doubtful: bool
    article: int
    block: bool
    linked: bool
    paragraph: int  # the nearest p or scope at or below this place of the stack
    closable: int  # the nearest element at or below this place that a start tag may close, or scope


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape((m[2] or "").strip("\"'")) for m in _ATTRIBUTE.finditer(raw)}


def _judged(tag: str, attrs: dict[str, str]) -> tuple[bool, bool]:
    """Whether an element is boilerplate, and whether its name makes it doubtful."""
    if tag in BOILERPLATE_TAGS or attrs.get("role", "").lower() in BOILERPLATE_ROLES:
        return True, False
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", attrs.get("style", "")):
        return True, False
    if tag in ("html", "body", "article", "main"):
        return False, False
    names = {x.lower() for x in _NAME.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}")}
    doubts = len(names & DOUBTFUL_NAMES)
    return bool(names & BOILERPLATE_NAMES) or doubts > 1, doubts == 1


_CLOSABLE = frozenset(x for kinds in CLOSES.values() for x in kinds)
_CELLS = frozenset(("td", "th"))


def _tag_end(page: str, at: int, missing: dict[str, int]) -> int:
    """The place of the > that ends a tag, or -1; a quote without its partner is an ordinary character."""
    while True:
        m = _STOPS.search(page, at)
        if m is None:
            return -1
        if m[0] == ">":
            return m.start()
        at = m.end()
        if at > missing.get(m[0], len(page)):
            continue
        close = page.find(m[0], at)
        if close < 0:
            missing[m[0]] = at - 1
        else:
            at = close + 1


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order; broken markup (open elements, stray end tags, an end inside a tag) is tolerated."""
    out: list[Block] = []
    base = _Open("", 0, "", False, False, -1, True, False, -1, -1)
    stack: list[_Open] = []
    open_tags: dict[str, int] = {}
    holders: list[_Open] = [base]  # the open block elements
    paths: dict[tuple[int, str], int] = {}
    parts: list[str] = []
    missing: dict[str, int] = {}
    endless: set[str] = set()
    link_chars = n_articles = at = 0
    size = len(page)

    def flush() -> None:
        nonlocal link_chars
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            holder, top = holders[-1], stack[-1] if stack else base
            out.append(Block(holder.path, holder.leaf, text, top.boilerplate, top.doubtful, holder.article, link_chars))
        link_chars = 0

    def pop_to(k: int) -> None:
        around = stack[k - 1] if k else base
        if any(e.block or (e.boilerplate, e.doubtful) != (around.boilerplate, around.doubtful) for e in stack[k:]):
            flush()
        for e in stack[k:]:
            open_tags[e.tag] -= 1
            if e.block:
                holders.pop()
        del stack[k:]

    def text(chunk: str) -> None:
        nonlocal link_chars
        parts.append(chunk)
        if stack and stack[-1].linked:
            link_chars += len(chunk.strip())

    while at < size:
        m = _OPENS.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        if m[0] == "<!--":
            end = page.find("-->", m.end())
            at = size if end < 0 else end + 3
            continue
        tag = (m[2] or "").lower()
        end = _tag_end(page, m.end(), missing) if tag else page.find(">", m.end())
        if end < 0:  # no later tag can end either
            text(page[m.start() :])
            break
        raw, at = page[m.end() : end], end + 1
        if not tag:
            continue
        if m[1]:
            if open_tags.get(tag):
                pop_to(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag))
            continue
        if tag in RAW:
            found = None if tag in endless else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if found is None:
                endless.add(tag)
                if tag in ("script", "style", "title", "textarea"):
                    at = size
            else:
                at = found.end()
            if tag not in ("button", "select", "svg", "math"):
                continue
            parts.append(" ")
            continue
        inline = tag in INLINE
        if not inline:
            k = stack[-1].paragraph if stack else -1
            if k >= 0 and stack[k].tag == "p":
                pop_to(k)
            if tag in CLOSES:
                k = stack[-1].closable if stack else -1
                while k >= 0:
                    if stack[k].tag in CLOSES[tag]:
                        pop_to(k)
                        break
                    if stack[k].tag in SCOPES and stack[k].tag not in _CELLS:
                        break
                    k = stack[k - 1].closable if k else -1
        if tag == "br":
            parts.append(" ")
        if tag in VOID or raw.rstrip().endswith("/") and tag not in SCOPES and tag != "p":
            if not inline:
                flush()
            continue
        attrs = _attributes(raw) if raw.strip() else {}
        around = stack[-1] if stack else base
        bad, doubt = _judged(tag, attrs)
        bad, doubt, article = bad or around.boilerplate, doubt or around.doubtful, around.article
        if not inline or (bad, doubt) != (around.boilerplate, around.doubtful):
            flush()
        opens_article = tag in ("article", "main") or attrs.get("role", "").lower() in MAIN_ROLES or attrs.get("itemprop", "") == "articleBody"
        if article < 0 and not bad and opens_article:
            article, n_articles = n_articles, n_articles + 1
        path, leaf = around.path, around.leaf
        if not inline:
            name = tag + "".join(f".{c}" for c in sorted(attrs.get("class", "").split())) + ("" if article == around.article else f"#{article}")
            path, leaf = paths.setdefault((path, name), len(paths) + 1), tag
        here = len(stack)
        scope = not inline and tag in SCOPES
        paragraph = here if tag == "p" or scope else around.paragraph
        closable = here if tag in _CLOSABLE or tag in SCOPES else around.closable
        stack.append(_Open(tag, path, leaf, bad, doubt, article, not inline, around.linked or tag == "a", paragraph, closable))
        open_tags[tag] = open_tags.get(tag, 0) + 1
        if not inline:
            holders.append(stack[-1])
    flush()
    return out


def _smooth(values: list[float], radius: int = 2) -> list[float]:
    kernel = [math.exp(-(d**2) / 2.0) for d in range(-radius, radius + 1)]
    out = []
    for i in range(len(values)):
        near = [(kernel[d + radius], values[i + d]) for d in range(-radius, radius + 1) if 0 <= i + d < len(values)]
        out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    return out


def path_scores(found: list[Block]) -> dict[int, float]:
    """Fused, smoothed length and punctuation ratio of every tag path."""
    total: dict[int, list[float]] = {}
    for b in found:
        t = total.setdefault(b.path, [0.0, 0.0, 0.0])
        plain = max(0, len(b.text) - b.links)
        t[0] += 1
        t[1] += plain
        t[2] += len(_PUNCTUATION.findall(b.text)) if plain else 0
    lengths = _smooth([total[b.path][1] / total[b.path][0] for b in found])
    marks = _smooth([total[b.path][2] / total[b.path][0] for b in found])
    fused: dict[int, list[float]] = {}
    for b, x, y in zip(found, lengths, marks, strict=True):
        fused.setdefault(b.path, []).append(math.log1p(x) * math.log1p(y) if total[b.path][1] else 0.0)
    return {p: sum(v) / len(v) for p, v in fused.items()}


def main_parts(found: list[Block], scores: dict[int, float]) -> set[int]:
    """The articles that are no teasers: by the mean score of their text, against the strongest one's, and by their links."""
    size: dict[int, list[float]] = {}
    for b in found:
        if b.article >= 0:
            t = size.setdefault(b.article, [0.0, 0.0, 0.0])
            t[0] += len(b.text)
            t[1] += b.links
            # its own text alone: neighbours in other articles don't lend it theirs
            t[2] += len(b.text) * math.log1p(len(b.text)) * math.log1p(len(_PUNCTUATION.findall(b.text)))
    strength = {a: t[2] / t[0] for a, t in size.items()}
    best = max(strength.values(), default=0.0)
    return {a for a, x in strength.items() if len(size) == 1 or x >= TEASER * best and size[a][1] < 0.5 * size[a][0]}


def main_text(page: str | None, spread: float = 0.5) -> str:
    """The main text: content blocks in page order, one a line. Null, empty and text-free pages give ''."""
    found = [b for b in blocks(page or "") if not b.boilerplate]
    if not found:
        return ""
    scores = path_scores(found)
    parts = main_parts(found, scores)
    if parts:
        best = max(scores[b.path] for b in found if b.article in parts)
        adds = [best * (0.75 if b.doubtful else 1.0) if b.article in parts else 0.0 for b in found]
        content = [i for i, b in enumerate(found) if scores[b.path] + adds[i] >= best and (b.article in parts or scores[b.path] > 0 and not b.doubtful and b.article < 0)]
        return "\n".join(found[i].text for i in content)
    values = list(scores.values())
    mean = sum(values) / len(values)
    deviation = math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))
    least = spread * deviation if len(values) > 1 else 0.0
    content = [i for i, b in enumerate(found) if scores[b.path] >= (max(least, mean) if b.doubtful else least) and b.links < 0.5 * max(1, len(b.text))]
    if not content:
        return ""
    first, last = content[0], content[-1]
    chosen = set(content)
    for i, b in enumerate(found):  # headings between or right before content
        if i not in chosen and re.fullmatch("h[1-6]", b.leaf) and (first <= i <= last or i == first - 1):
            chosen.add(i)
    return "\n".join(found[i].text for i in sorted(chosen))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html).

    Null html is empty and gives an empty text; null ids and urls and repeated rows are kept as they are; an
    empty table gives no rows; other columns are ignored. n_chars counts code points.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": [main_text(x if isinstance(x, str) else None) for x in frame["html"]]})

    base = pages.select(F.col("page_id").cast("string").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    out = base.mapInPandas(run, "page_id string, url string, text string")
    return out.select(F.col("page_id").cast("long").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
