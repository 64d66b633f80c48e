"""Visible text, tokens and link targets of an HTML column, as built-in string functions.

Every pattern takes one linear pass; alternations are repeated possessively, since other repeats would overflow the
stack of Java's matcher on a hostile page.
"""

from __future__ import annotations

from html.entities import html5
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinneret.functions.staging import fence, quoted

# --- Fixed values ---------------------------------------------------------------------------------------------------
# Elements whose start and end separate words; all others join their neighbours.
BLOCK_TAGS = [
    "html", "head", "body", "frameset", "script", "noscript", "style", "meta", "link", "title", "frame", "noframes",
    "section", "nav", "aside", "hgroup", "header", "footer", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "pre",
    "div", "blockquote", "hr", "address", "figure", "figcaption", "form", "fieldset", "ins", "del", "dl", "dt", "dd",
    "li", "table", "caption", "thead", "tfoot", "tbody", "colgroup", "col", "tr", "th", "td", "video", "audio",
    "canvas", "details", "menu", "plaintext", "template", "article", "main", "svg", "math", "center", "dir", "applet",
    "marquee", "listing", "br",
]
# --------------------------------------------------------------------------------------------------------------------

# A quoted value may hold '>'. The attributes are taken possessively, which Java runs as a loop, not on its stack.
_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)?"""
_ATTRIBUTES = rf"(?:[^>=]*=\s*{_VALUE})*+[^>]*"
TAG_REST = rf"(?:[\s/]{_ATTRIBUTES})?"

# In every pattern the part after a tag's attributes always matches ('>' or the end), so nothing is tried twice.
# The end tag of a script stays (groups 1 and 2) and is a word break later; a comment leaves nothing.
COMMENT_OR_CODE = (
    r"(?is)<!--.*?(?:-->|$)"
    rf"|<script{TAG_REST}(?:>.*?(</script\s*>|$)|$)"
    rf"|<style{TAG_REST}(?:>.*?(</style\s*>|$)|$)"
)
BODY_START = rf"(?is)^.*?<body{TAG_REST}(?:>|$)"
TITLE = rf"(?is)<title{TAG_REST}(?:>.*?(?:</title\s*>|$)|$)"
BLOCK_TAG = rf"(?i)</?(?:{'|'.join(BLOCK_TAGS)}){TAG_REST}(?:>|$)"
ANY_TAG = rf"<(?:/?[a-zA-Z][^\s/>]*{TAG_REST}|[!?][^>]*|/[^a-zA-Z>][^>]*|/)(?:>|$)"
LINK_TAG = rf"(?i)<a(?:[\s/]{_ATTRIBUTES})?(?:>|$)"
BASE_TAG = rf"(?i)<base(?:[\s/]{_ATTRIBUTES})?(?:>|$)"
# Group 1 is an attribute's name, group 2 its value with the quotes, if any.
ATTRIBUTE = r"""([^\s/>=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?"""
QUOTES = r"""^["']|["']$"""


def _named_entities() -> str:
    """Names of the HTML standard table: with ';' any of them, without it only the legacy ones, longest first."""
    with_end = sorted(n[:-1] for n in html5 if n.endswith(";"))
    by_letter = [
        f"{first}(?:{'|'.join(n[1:] for n in names)})"
        for first, names in ((k, list(g)) for k, g in groupby(with_end, key=lambda n: n[0]))
    ]
    legacy = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    return f"(?:{'|'.join(by_letter)});|(?:{'|'.join(legacy)})"


NUMERIC_ENTITY = r"(&#(?:[xX][0-9a-fA-F]+|[0-9]+));?"
# The one named entity that stands for ASCII letters.
LETTER_ENTITY = ("&fjlig;", "fj")
ENTITY = rf"&(?:#(?:[xX][0-9a-fA-F]+|[0-9]+);?|{_named_entities()})"
# Numeric entities that stand for an ASCII letter or digit: 48-57, 65-90, 97-122.
ALNUM_ENTITY = (
    r"&#(?:0*(?:4[89]|5[0-7]|6[5-9]|[78][0-9]|9[0-9]|1[01][0-9]|12[0-2])"
    r"|[xX]0*(?:3[0-9]|4[1-9a-fA-F]|5[0-9aA]|6[1-9a-fA-F]|7[0-9aA]));"
)


def alnum_entity(char: str) -> str:
    """Pattern for the ';'-ended numeric entities of one lower-case letter (in both cases) or digit."""
    codes = sorted({ord(char), ord(char.upper())})
    decimal = "|".join(str(c) for c in codes)
    hexadecimal = "|".join(f"{c:x}" for c in codes)
    return rf"(?i)&#(?:0*(?:{decimal})|x0*(?:{hexadecimal}));"


# Characters that leave no trace in a text, raw or as entities: soft hyphen and zero-width space.
INVISIBLE = "\u00ad\u200b"
_INVISIBLE_NAMES = sorted((n for n, c in html5.items() if c in tuple(INVISIBLE)), key=lambda n: (-len(n), n))
INVISIBLE_ENTITY = rf"&(?:#0*(?:173|8203);|#[xX]0*(?:[aA][dD]|200[bB]);|{'|'.join(_INVISIBLE_NAMES)})"
# Entities of characters outside ASCII whose lower case begins with an ASCII letter.
LOWERED_ENTITIES = [(r"&#(?:0*8490|[xX]0*212[aA]);", "\u212a"), (r"&(?:Idot|#0*304|#[xX]0*130);", "\u0130")]

# The pieces of an attribute value: an entity, text without '&', or a lone '&'. Without ';' only the oldest names count.
ENTITY_PIECE = r"&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[a-zA-Z][a-zA-Z0-9]*;|(?i:&(?:quot|amp|lt|gt))|[^&]+|&"
ALNUM = "0123456789abcdefghijklmnopqrstuvwxyz"


def _replace(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {quoted(pattern)}, {quoted(by)})"


def _matches(text: str, pattern: str) -> str:
    return f"{text} RLIKE {quoted(pattern)}"


def without_code(html: str) -> Column:
    """The page without comments and without what stands inside scripts and style sheets."""
    return F.regexp_replace(html, COMMENT_OR_CODE, "$1$2")


def _decode_alnum(text: str) -> str:
    for char in ALNUM:
        text = _replace(text, alnum_entity(char), char)
    return text


def with_raw_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Replace ``html`` by its body text in lower case, before other characters are cleaned up.

    One projection per step, so that a step's result is computed once although the next one uses it more than once.
    """
    kept = [f"`{c}`" for c in pages.columns if c != html]

    def stage(text: str) -> DataFrame:
        return staged.selectExpr(*kept, f"{text} AS _t")

    staged = pages.select(*kept, without_code(html).alias("_t"))
    # A page without a body tag loses its title here; elsewhere the title goes with all that comes before the body.
    has_body = _matches("_t", r"(?i)<body[\s/>]")
    staged = stage(f"CASE WHEN {has_body} THEN {_replace('_t', BODY_START, '')} ELSE {_replace('_t', TITLE, ' ')} END")
    staged = stage(_replace(_replace("_t", BLOCK_TAG, " "), ANY_TAG, ""))
    staged = stage(f"CASE WHEN contains(_t, '&#') THEN {_replace('_t', NUMERIC_ENTITY, '$1;')} ELSE _t END")
    # The 36 passes run only on pages with a numeric entity of an ASCII letter or digit.
    rare = f"contains(_t, '&#') AND {_matches('_t', ALNUM_ENTITY)}"
    staged = stage(f"CASE WHEN {rare} THEN {_decode_alnum('_t')} ELSE _t END")
    staged = stage(f"translate(CASE WHEN contains(_t, '&') THEN {_replace('_t', INVISIBLE_ENTITY, '')} ELSE _t END, {quoted(INVISIBLE)}, '')")
    letters = f"replace(_t, {quoted(LETTER_ENTITY[0])}, {quoted(LETTER_ENTITY[1])})"
    for pattern, char in LOWERED_ENTITIES:
        letters = _replace(letters, pattern, char)
    staged = stage(f"CASE WHEN contains(_t, '&') THEN {_replace(letters, ENTITY, ' ')} ELSE _t END")
    return staged.selectExpr(*kept, f"{fence('lower(_t)')} AS `{out}`")


def clean_text(text: str) -> Column:
    """Every character other than ``[a-z0-9 ]`` becomes one space."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9 ]", " ")


def tokens_of(text: str) -> Column:
    """Tokens of two or more characters, in order. One pass: they are the longest runs of ``[a-z0-9]``."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]{2,}"), F.lit(0))


def link_tags(html: str) -> Column:
    """All ``<a>`` start tags of a page without code, in order, with those cut off by the end of the page."""
    return F.regexp_extract_all(html, F.lit(LINK_TAG), F.lit(0))


def first_base_tag(html: str) -> Column:
    return F.regexp_extract(html, BASE_TAG, 0)


def with_attribute(tags: DataFrame, tag: str, element: str, name: str, out: str) -> DataFrame:
    """Add a tag's first attribute of that name, unquoted and decoded; NULL if it has none."""
    kept = [f"`{c}`" for c in tags.columns]
    rest = f"substring(`{tag}`, {len(element) + 2})"
    found = tags.selectExpr(
        *kept,
        f"cast(array_position(regexp_extract_all(lower({rest}), {quoted(ATTRIBUTE)}, 1), '{name}') AS int) AS _place",
        f"regexp_extract_all({rest}, {quoted(ATTRIBUTE)}, 2) AS _values",
    )
    value = "CASE WHEN _place > 0 THEN get(_values, _place - 1) END"
    bare = found.selectExpr(*kept, f"{_replace(value, QUOTES, '')} AS _bare")
    decoded = f"CASE WHEN contains(_bare, '&') THEN {_decoded('_bare')} ELSE _bare END"
    return bare.selectExpr(*kept, f"{fence(decoded)} AS `{out}`")


# The names that stand without ';' too, and what they mean; '&amp;' comes last, since it makes new '&'s.
_COMMON = {"quot": '"', "lt": "<", "gt": ">", "amp": "&"}


def _decoded(text: str) -> str:
    """The text with its entities decoded; numbers that are no character become U+FFFD.

    Nearly all texts with entities have ``&amp;`` alone, which is replaced as it stands. The others are cut into pieces,
    and only names that are not of the oldest go through the table of their first letter.
    """
    plain = f"length({text}) - length(replace({text}, '&', '')) = (length({text}) - length(replace({text}, '&amp;', ''))) div 5"
    pieces = f"array_join(transform(regexp_extract_all({text}, {quoted(ENTITY_PIECE)}, 0), p -> {_decoded_piece()}), '')"
    return f"CASE WHEN {plain} THEN replace({text}, '&amp;', '&') ELSE {pieces} END"


def _decoded_piece() -> str:
    """One piece ``p`` of a text, decoded."""
    is_hex = "lower(substring(p, 3, 1)) = 'x'"
    digits = f"ltrim('0', rtrim(';', substring(p, if({is_hex}, 4, 3))))"
    # Longer numbers are beyond the last character; cut off, they do not overflow on the way.
    number = f"if(length({digits}) > 7, 0, coalesce(cast(conv(substring({digits}, 1, 7), if({is_hex}, 16, 10), 10) AS bigint), 0))"
    valid = "(c BETWEEN 1 AND 55295 OR c BETWEEN 57344 AND 1114111)"
    char = f"element_at(transform(array({number}), c -> if({valid}, decode(unhex(lpad(hex(c), 8, '0')), 'UTF-32'), '\\uFFFD')), 1)"
    oldest = " ".join(f"WHEN rtrim(';', lower(p)) = '&{name}' AND (endswith(p, ';') IS FALSE OR p = '&{name};') THEN {quoted(char)}" for name, char in _COMMON.items())
    return (
        f"CASE WHEN startswith(p, '&#') AND length(p) > 2 THEN {char} WHEN NOT startswith(p, '&') OR length(p) = 1 THEN p"
        f" {oldest} ELSE {_named_piece()} END"
    )


def _named_piece() -> str:
    """A name of the table, or the piece itself. A string for each first letter holds its names with marks around each.

    A map literal of this size makes no compilable code, and one string for all letters takes long to search.
    """
    ended = sorted((n, c) for n, c in html5.items() if n.endswith(";"))
    by_letter = {k: "".join(f"\x01&{n}\x02{c}" for n, c in g) + "\x01" for k, g in groupby(ended, key=lambda x: x[0][0])}
    marked = "concat('\x01', p, '\x02')"

    def found(table: str) -> str:
        return f"if(contains({table}, {marked}), substring_index(substring_index({table}, {marked}, -1), '\x01', 1), p)"

    letters = quoted("".join(by_letter))
    tables = f"element_at(array({', '.join(quoted(t) for t in by_letter.values())}), instr({letters}, substring(p, 2, 1)))"
    is_letter = f"contains({letters}, substring(p, 2, 1))"
    return f"if({is_letter}, element_at(transform(array({tables}), t -> {found('t')}), 1), p)"
