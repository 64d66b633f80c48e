"""Operator 6: the main text of web pages by two-pass block rules.

A page is cut into blocks at its block-level tags. The first pass decides blocks by themselves: by length, by the share
of the text inside links and by the share of stop words; blocks in navigation, footers, asides and in containers named as
notices, adverts or comments are boilerplate. A name counts as a whole: ``sidebar``, ``sidebar-left`` and ``site-footer``
are names of such containers, ``with-sidebar``, ``no-comments`` and ``ad-free`` are not, and ``article``, ``main`` and
``body`` are never barred by theirs. A form is barred unless it holds nearly all of the page's good text. What is too
short or too plain to decide is ambiguous. In the second pass an ambiguous block takes the label of its nearest decided
neighbour: first among the blocks of its own container, then of the containers around it, then of the page.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONG = 90
LINKED = 0.3
STOP_SHARE = 0.08
#: Share of a page's good text in a form, over which the form is the page.
NEARLY_ALL = 0.8
#: Containers inside more others than this are taken as a part of the one around them.
DEEPEST = 64

# Function words of four languages, and names of elements.
STOP_WORDS = frozenset(
    (
        "the of and to in is that it was for on are as with his they at be this from have or by one had not but what all "
        "were when we there can an your which their said if do will each about how up out them then she many some so these "
        "der die das und ist von zu den mit sich des auf für nicht ein eine dem im auch als an er es sie werden aus bei "
        "le la les de des et un une du en que qui dans pour pas sur au par plus avec ce il sont ne se "
        "el los las y una del que con para por su al lo como más o pero sus se no"
    ).split()
)
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center col dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody "
    "td tfoot th thead title tr ul".split()
)
CONTAINERS = frozenset("article aside body div footer form header main nav section table td ul ol dl figure details dialog blockquote".split())
BOILERPLATE_TAGS = frozenset("nav footer aside menu dialog".split())
#: Elements whose content is no text of the page.
RAW_TAGS = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "select", "button", "title", "head", "object", "canvas")
BOILERPLATE_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "disqus footer hidden login menu modal nav navbar navigation newsletter notice pager pagination popup promo related "
    "reply share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
#: Parts of a name that say that a container goes with such a thing, or without it.
QUALIFIERS = frozenset("with without has have no not non is hide hides show shows free less off enabled disabled".split())
NEVER_BARRED = frozenset("article main body".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
ENDS_PARAGRAPH = BLOCK_TAGS - {"body", "html"}

# An open raw element is dropped up to its end tag, or to the end of the page; quoted attribute values may hold ">".
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(t for t in RAW_TAGS if t != "head") + r")(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-z][a-z0-9:-]*+)(?P<attrs2>[^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|<[a-z][^>]*+\Z"
    r"|(?P<text>[^<]++|<)",
    re.I | re.S,
)
_NAMES = re.compile(r"""(?<![\w-])(?:class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORDS = re.compile(r"\w+")


class Block:
    """A run of text between block-level tags, with the containers around it, outermost first.

    Containers are numbered; an article's or main element's number is negative.
    """

    __slots__ = ("text", "linked", "path", "barred", "form", "heading", "label")

    def __init__(self, text: str, linked: int, path: tuple[int, ...], barred: bool, form: int, heading: bool) -> None:
        self.text, self.linked, self.path, self.barred, self.form, self.heading = text, linked, path, barred, form, heading
        self.label: bool | None = None


def _named_as_boilerplate(attrs: str) -> bool:
    if _HIDDEN.search(attrs):
        return True
    names = (name for m in _NAMES.finditer(attrs) for name in (m[1] or m[2] or m[3] or "").split())
    return any(_is_boilerplate(name) for name in names)


def _is_boilerplate(name: str) -> bool:
    """A listed word, or a name that begins or ends with one and does not qualify it."""
    parts = [p for p in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if p]
    return bool(parts) and QUALIFIERS.isdisjoint(parts) and (parts[0] in BOILERPLATE_NAMES or parts[-1] in BOILERPLATE_NAMES)


def blocks_of(page: str) -> list[Block]:
    """The page's blocks in order. Unclosed and stray tags are taken as browsers do in the common cases."""
    out: list[Block] = []
    parts: list[str] = []
    linked_parts: list[str] = []
    # Open containers: tag, path, whether it or one around it is boilerplate, number of the outermost form around it or 0.
    stack: list[tuple[str, tuple[int, ...], bool, int]] = []
    opened: Counter[str] = Counter()
    number, links, heading = 0, 0, False

    def flush() -> None:
        nonlocal parts, linked_parts
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                linked = len(" ".join(entities.unescape("".join(linked_parts)).split()))
                _, path, bad, form = stack[-1] if stack else ("", (), False, 0)
                out.append(Block(text, linked, path, bad, form, heading))
        parts, linked_parts = [], []

    for m in _TOKEN.finditer(page):
        text = m["text"]
        if text is not None:
            parts.append(text)
            if links:
                linked_parts.append(text)
            continue
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        closing = bool(m["end"] or m["end2"])
        if tag == "a":
            links = max(0, links - 1) if closing else 1
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in BLOCK_TAGS:
            continue
        flush()
        heading = not closing and len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
        if tag not in CONTAINERS:
            continue
        if closing:
            if opened[tag]:
                while True:
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == tag:
                        break
            continue
        _, path, bad, form = stack[-1] if stack else ("", (), False, 0)
        in_article = bool(opened["article"] or opened["main"])
        bad = bad or tag in BOILERPLATE_TAGS or (tag == "header" and not in_article)
        attrs = m["attrs"] or m["attrs2"]
        bad = bad or (tag not in NEVER_BARRED and bool(attrs) and _named_as_boilerplate(attrs))
        number += 1
        form = form or (number if tag == "form" else 0)
        if len(path) < DEEPEST:
            path += (-number if tag in ("article", "main") else number,)
        stack.append((tag, path, bad, form))
        opened[tag] += 1
    flush()
    return out


def _bar_forms(blocks: list[Block]) -> None:
    """Bar the blocks of forms, but not of one that holds nearly all good text, as where a page is one form."""
    good = Counter()
    for block in blocks:
        if _decide(block):
            good[block.form] += len(block.text)
    for block in blocks:
        if block.form and good[block.form] <= NEARLY_ALL * good.total():
            block.barred = True


def _decide(block: Block) -> bool | None:
    """The first pass: main text, boilerplate, or None if ambiguous."""
    if block.barred or block.linked > LINKED * len(block.text):
        return False
    if block.heading or len(block.text) < LONG:
        return None
    words = _WORDS.findall(block.text.lower())
    stops = sum(w in STOP_WORDS for w in words)
    return True if words and stops >= STOP_SHARE * len(words) else None


def _inherit(blocks: list[Block], decided: list[bool | None]) -> None:
    """The second pass: container by container outwards, each ambiguous block takes its nearest decided neighbour's label.

    At equal distance main text wins.
    """
    for depth in range(max((len(b.path) for b in blocks), default=0), -1, -1):
        groups: dict[tuple[int, ...], list[int]] = {}
        for i, b in enumerate(blocks):
            if len(b.path) >= depth:
                groups.setdefault(b.path[:depth], []).append(i)
        for path, members in groups.items():
            if any(number < 0 for number in path):
                # What stands in an article under a name of its own, as an advert, says nothing of the text around it.
                members = [i for i in members if not blocks[i].barred]
            open_ones = [i for i in members if blocks[i].label is None]
            if not open_ones:
                continue
            if path and path[-1] < 0 and not any(decided[i] for i in members):
                # An article of ambiguous blocks only has nothing nearer than the page around it to inherit from.
                for i in open_ones:
                    blocks[i].label = True
                continue
            if not any(decided[i] is not None for i in members):
                continue
            before: dict[int, tuple[int, bool]] = {}
            last = None
            for place, i in enumerate(members):
                if decided[i] is not None:
                    last = (place, decided[i])
                elif last is not None:
                    before[i] = (place - last[0], last[1])
            last = None
            for place in range(len(members) - 1, -1, -1):
                i = members[place]
                if decided[i] is not None:
                    last = (place, decided[i])
                elif blocks[i].label is None:
                    near = [x for x in (before.get(i), last and (last[0] - place, last[1])) if x]
                    blocks[i].label = min(near, key=lambda x: (x[0], not x[1]))[1]


def main_text(page: str | None) -> str:
    """The main text's blocks, one a line; empty for an empty page."""
    blocks = blocks_of(page or "")
    if any(b.form for b in blocks):
        _bar_forms(blocks)
    decided = [_decide(b) for b in blocks]
    for block, label in zip(blocks, decided):
        block.label = label
    if any(d is not None for d in decided):
        _inherit(blocks, decided)
    return "\n".join(b.text for b in blocks if b.label or b.label is None)


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``. A null page is an empty one; a page on which nothing can be
    decided is all text. No shuffle; extra columns play no part."""

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text, na_action=None)

    text = extracted(F.coalesce("html", F.lit("")))
    return pages.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
