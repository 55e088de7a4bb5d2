"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags, while scripts, styles, forms and the elements that
markup itself declares to be menus, headers or footers are left out. Classes and ids only hint at
menus, sidebars, notices or adverts: such an element goes if it is link-dense or holds less than half
of the page's text, and else its name says nothing. Those of reader comments go whatever they hold,
unless an article or main element is within. The first pass decides each block by itself from
stop-word density, length and link density: good, bad, or ambiguous. The second gives each ambiguous
block the label of its nearest decided neighbours; they are sought in the same article or main
element only. A page without any good block and without such elements, be it short or in a language
without listed stop words, keeps its largest run of blocks that aren't bad.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of
from .encode import text_slices
from .stopwords import ALL


@dataclass(frozen=True)
class Rules:
    """Thresholds of the first pass. Lengths in characters, densities as shares of words or characters."""

    short: int = 70
    long: int = 200
    stop_high: float = 0.20
    stop_low: float = 0.10
    links: float = 0.33
    stop_words: frozenset[str] = field(default_factory=lambda: frozenset(ALL))


# Names of HTML elements and of the classes that sites use.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
LEFT_OUT = {"head", "nav", "footer", "aside", "form", "select", "button", "svg", "math", "dialog", "menu", "object", "canvas", "audio", "video", "datalist", "fieldset", "option", "label"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
LANDMARK = {"article", "main"}
CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul", "figure", "details"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
HINT = re.compile(
    r"(?:^|[_-])(?:ads?|adverts?|advertisements?|adsense|sponsor(?:ed|s)?|promo(?:s|tion|tions)?|banner|cookies?|consent|gdpr|notices?|nav|navbar|navigation|menu|menus|"
    r"breadcrumbs?|sidebar|side-?bar|widgets?|footer|site-?header|page-?header|masthead|topbar|toolbar|comments?|commentlist|disqus|replies|respond|discussion|share|sharing|"
    r"social|related|recommend(?:ed|ations)?|newsletter|subscribe|subscription|signup|login|modal|popup|overlay|pagination|pager|skip-?link|legal|copyright|disclaimer)(?:$|[_-])")
#: Of these, the ones that name reader comments.
REMARKS = re.compile(r"(?:^|[_-])(?:comments?|commentlist|disqus|replies|respond)(?:$|[_-])")
#: Tokens that say how a page is laid out or what it lacks, not what an element is.
LAYOUT = re.compile(r"(?:^|[_-])(?:has|no|not|non|with|without|is|hide|hidden)[_-]|[_-](?:open|opened|closed|free|less|on|off|enabled|disabled|none|left|right|active|visible)$")
ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
TOKEN = re.compile(r"<!--(?:.*?-->|>|.*\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/><]*)((?:[^><\"']|\"[^\"<]*\"|'[^'<]*'|[\"'])*+)>?", re.S)
LETTERS = re.compile(r"[^\W\d_]+")

GOOD, BAD, NEAR, SHORT = "good", "bad", "near", "short"


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    landmark: int  # number of the article or main element; 0 outside
    hint: int = 0  # number of the nearest element around it whose class or id is a hint; 0 without


@dataclass
class Hint:
    """An element whose class or id hints that it is no main text."""

    parent: int  # number of the next one around it
    remarks: bool  # it names reader comments
    landmark: bool = False  # an article or main element lies within


def _declared(tag: str, attributes: str, inside: bool) -> bool:
    """Whether markup itself says that an element is no main text."""
    if tag in LEFT_OUT or tag == "header" and not inside:
        return True
    if not attributes.strip() or tag in ("html", "body", "article", "main"):
        return False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value = (a or b or c).lower()
        name = name.lower()
        if name == "role" and value in ROLES:
            return True
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _hinted(tag: str, attributes: str) -> list[str]:
    """The whole class and id tokens that hint that an element is no main text."""
    if not attributes.strip() or tag in ("html", "body", "article", "main"):
        return []
    return [
        token for name, a, b, c in ATTRIBUTE.findall(attributes) if name.lower() in ("class", "id") for token in (a or b or c).lower().split()
        if HINT.search(token) and not LAYOUT.search(token)]


def blocks_of(html: str) -> tuple[list[Block], list[Hint]]:
    """The text blocks of a page in order, white space made single, and the hinted elements (from 1)."""
    out: list[Block] = []
    hints = [Hint(0, False)]
    opened: Counter = Counter()  # elements on the stack by name
    stack: list[tuple[str, bool, bool]] = []  # element, left out, hinted
    parts: list[str] = []
    linked = links = hidden = landmarks = 0
    inside: list[int] = []
    around = [0]
    heading, at, n = False, 0, len(html)

    def end_block():
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, linked, heading, inside[-1] if inside else 0, around[-1]))
        parts.clear()
        linked = 0

    def close(tag: str):
        nonlocal hidden, links, heading
        while stack:
            name, gone, hint = stack.pop()
            opened[name] -= 1
            hidden -= gone
            if hint:
                around.pop()
            if name == "a":
                links -= 1
            if name in LANDMARK and inside:
                inside.pop()
            if name == tag:
                break

    def text(chunk: str):
        nonlocal linked
        if chunk and not hidden:
            chunk = unescape(chunk)
            parts.append(chunk)
            if links:
                linked += len("".join(chunk.split()))

    while at < n:
        m = TOKEN.search(html, at)
        if not m:
            text(html[at:])
            break
        text(html[at : m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        tag, attributes = m.group(2).lower(), m.group(3)
        if m.group(1):
            if tag == "br" or tag == "p" and not opened["p"]:
                end_block()
                continue
            if tag not in INLINE:
                end_block()
            if opened[tag]:
                close(tag)
                if tag[:1] == "h" and tag[1:].isdigit():
                    heading = False
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else n
            if tag not in INLINE:
                end_block()
            continue
        if tag not in INLINE:
            end_block()
        if tag in VOID or attributes.endswith("/") and tag in ("path", "use"):
            continue
        if tag in CLOSES_P and opened["p"]:
            close("p")
        elif tag in ("li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == tag:
            close(tag)
        gone = _declared(tag, attributes, bool(inside))
        tokens = _hinted(tag, attributes) if tag not in INLINE and not gone and not hidden else []
        stack.append((tag, gone, bool(tokens)))
        opened[tag] += 1
        hidden += gone
        if tokens:
            hints.append(Hint(around[-1], any(map(REMARKS.search, tokens))))
            around.append(len(hints) - 1)
        if tag == "a":
            links += 1
        if tag in LANDMARK:
            landmarks += 1
            inside.append(landmarks)
            hints[around[-1]].landmark = True
        if tag[:1] == "h" and tag[1:].isdigit():
            heading = True
    end_block()
    return out, hints


def _linked(block: Block, rules: Rules) -> bool:
    return block.linked > rules.links * len(block.text)


def first_pass(block: Block, rules: Rules) -> str:
    """The label of a block by itself."""
    size = len(block.text)
    if _linked(block, rules):
        return BAD
    words = LETTERS.findall(block.text.lower())
    density = sum(w in rules.stop_words for w in words) / len(words) if words else 0.0
    if "\N{COPYRIGHT SIGN}" in block.text and not block.landmark and (size < rules.short or size < rules.long and density < rules.stop_high):
        return BAD
    if size < rules.short:
        return SHORT
    if density >= rules.stop_high:
        return GOOD if size >= rules.long or block.landmark else NEAR
    return NEAR if density >= rules.stop_low or size >= rules.long else SHORT


def unwanted(blocks: list[Block], hints: list[Hint], rules: Rules) -> list[bool]:
    """Which hinted elements go, for themselves or with one around them.

    They are link-dense, hold less than half of the page's unlinked text, or are reader comments.
    """
    size, linked = [0] * len(hints), [0] * len(hints)
    for b in blocks:
        size[b.hint] += len(b.text)
        linked[b.hint] += b.linked
    landmark = [h.landmark for h in hints]
    for h in range(len(hints) - 1, 0, -1):  # an element's number is above those around it
        size[hints[h].parent] += size[h]
        linked[hints[h].parent] += linked[h]
        landmark[hints[h].parent] |= landmark[h]
    whole = size[0] - linked[0]
    gone = [False] * len(hints)
    for h in range(1, len(hints)):
        own = linked[h] > rules.links * size[h] or 2 * (size[h] - linked[h]) < whole or hints[h].remarks and not landmark[h]
        gone[h] = own or gone[hints[h].parent]
    return gone


def settle(blocks: list[Block], labels: list[str], rules: Rules) -> list[str]:
    """Labels with what no block can tell by itself.

    A linked block between two unlinked ones of an article is ambiguous: lists of links have more
    than one. Without a good block and without articles, the largest run of blocks between bad ones
    is good.
    """
    labels = list(labels)
    dense = [_linked(b, rules) for b in blocks]
    for k in range(1, len(blocks) - 1):
        alike = blocks[k - 1].landmark == blocks[k].landmark == blocks[k + 1].landmark != 0
        if alike and dense[k] and not dense[k - 1] and not dense[k + 1]:
            labels[k] = SHORT
    if GOOD not in labels and not any(b.landmark for b in blocks):
        best, begin = (0, 0, 0), 0
        for k in range(len(blocks) + 1):
            if k == len(blocks) or labels[k] == BAD:
                best = max(best, (sum(len(b.text) for b in blocks[begin:k]), -begin, k))
                begin = k + 1
        labels[-best[1] : best[2]] = [GOOD] * (best[2] + best[1])
    return labels


def second_pass(blocks: list[Block], labels: list[str], rules: Rules = Rules()) -> list[bool]:
    """Which blocks are main text. Ambiguous ones take the label both neighbours agree on.

    Where decided neighbours differ, an ambiguous block with some stop words or a heading before
    good text is good, and any other takes the nearer one's label, the earlier one's in a tie.
    Without decided neighbours a block is good if it has some stop words, lies inside an article or
    main element or is long, others are bad.
    """
    n = len(blocks)
    group = [b.landmark for b in blocks]
    before, after = [(-1, "")] * n, [(-1, "")] * n
    last: dict[int, tuple[int, str]] = {}
    for k in range(n):
        before[k] = last.get(group[k], (-1, ""))
        if labels[k] in (GOOD, BAD):
            last[group[k]] = (k, labels[k])
    last = {}
    for k in reversed(range(n)):
        after[k] = last.get(group[k], (-1, ""))
        if labels[k] in (GOOD, BAD):
            last[group[k]] = (k, labels[k])
    keep = []
    for k, label in enumerate(labels):
        if label not in (GOOD, BAD):
            (i, a), (j, b) = before[k], after[k]
            if not a and not b:
                label = GOOD if blocks[k].landmark or label == NEAR or len(blocks[k].text) >= rules.long else BAD
            elif not a or not b or a == b:
                label = a or b
            elif label == NEAR or blocks[k].heading and b == GOOD:
                label = GOOD
            else:
                label = a if k - i <= j - k else b
        keep.append(label == GOOD)
    return keep


def main_text(html: str | None, rules: Rules = Rules()) -> str:
    """The page's main text; empty if there is none."""
    if not html:
        return ""
    blocks, hints = blocks_of(html)
    gone = unwanted(blocks, hints, rules)
    blocks = [b for b in blocks if not gone[b.hint]]
    kept = second_pass(blocks, settle(blocks, [first_pass(b, rules) for b in blocks], rules), rules)
    return " ".join(b.text for b, k in zip(blocks, kept) if k)


def extract(pages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """page_id, url, text and n_chars of all pages from their whole html.

    A null or empty page, and one without main text, gives an empty text. Repeated rows repeat,
    nulls in page_id and url stay, other columns are left out; an empty table gives no row. The
    time for a page grows with its length, however its elements are nested or left open, and pages
    are taken in slices, so a very long one is held alone.
    """

    def run(batches):
        for batch in batches:
            for a, b, pages in text_slices(batch.column(2)):
                part, found = batch.slice(a, b - a), [main_text(h, rules) for h in pages]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    rows = columns_of(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
