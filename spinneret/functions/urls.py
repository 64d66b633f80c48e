"""Relative URL resolution as built-in string functions (RFC 3986, section 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from spinneret.functions.staging import fence, quoted

SCHEME = "^[a-zA-Z][a-zA-Z0-9+.-]*:"
ORIGIN = "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*"
CONTROLS = r"[\x00-\x1f]"
DOT_SEGMENT = r"(?:^|/)\.\.?(?:/|$)"


def _after(text: str, front: str) -> str:
    return f"substring({text}, length({front}) + 1)"


def _leading(text: str, pattern: str) -> str:
    return f"regexp_extract({text}, {quoted(pattern)}, 0)"


# Removes '.' and '..' segments from a path that starts with a slash.
_WITHOUT_DOTS = """
    aggregate(
        slice(split(_path, '/'), 2, length(_path) + 1),
        cast(array() AS array<string>),
        (done, segment) -> CASE
            WHEN segment = '.' THEN done
            WHEN segment = '..' THEN slice(done, 1, greatest(size(done) - 1, 0))
            ELSE array_append(done, segment) END,
        done -> concat(
            '/', array_join(done, '/'),
            CASE WHEN _path RLIKE '/[.][.]?$' AND size(done) > 0 THEN '/' ELSE '' END))"""


def with_absolute_url(df: DataFrame, base: str, href: str, out: str) -> DataFrame:
    """Add ``href`` as seen from the page ``base``; '' if it is missing or cannot be resolved. Fragments stay."""
    kept = [f"`{c}`" for c in df.columns]
    # Control characters count for nothing in a link, wherever they stand.
    link = f"trim(regexp_replace(`{href}`, {quoted(CONTROLS)}, ''))"
    staged = df.selectExpr(
        *kept,
        f"{link} AS _link",
        f"{_leading(f'`{base}`', ORIGIN)} AS _origin",
        f"{_leading(link, ORIGIN)} AS _own",
        f"{_leading(_after(f'`{base}`', _leading(f'`{base}`', ORIGIN)), '^[^?#]*')} AS _path",
    )
    has_scheme = f"_link RLIKE {quoted(SCHEME)}"
    # The result is a front that stays as it is and a path, query and fragment whose dot segments go.
    front = f"""
        CASE WHEN _own <> '' THEN _own
             WHEN {has_scheme} THEN _link
             WHEN _link IS NULL OR _origin = '' THEN ''
             WHEN _link = '' THEN `{base}`
             WHEN startswith(_link, '//') THEN concat({_leading(f'`{base}`', SCHEME)}, _link)
             WHEN startswith(_link, '#') THEN concat({_leading(f'`{base}`', '^[^#]*')}, _link)
             WHEN startswith(_link, '?') THEN concat(_origin, _path, _link)
             ELSE _origin END"""
    rest = f"""
        CASE WHEN _own <> '' THEN {_after('_link', '_own')}
             WHEN {has_scheme} OR _link IS NULL OR _origin = '' OR _link RLIKE '^(?:$|//|[#?])' THEN ''
             WHEN startswith(_link, '/') THEN _link
             WHEN _path = '' THEN concat('/', _link)
             ELSE concat({_leading('_path', '^.*/')}, _link) END"""
    staged = staged.selectExpr(*kept, f"{front} AS _front", f"{rest} AS _rest")
    staged = staged.selectExpr(*kept, "_front", "_rest", f"{_leading('_rest', '^[^?#]*')} AS _path")
    normal = f"CASE WHEN _path RLIKE {quoted(DOT_SEGMENT)} THEN concat({_WITHOUT_DOTS}, {_after('_rest', '_path')}) ELSE _rest END"
    return staged.selectExpr(*[c for c in kept if c != f"`{out}`"], f"{fence(f'concat(_front, {normal})')} AS `{out}`")
