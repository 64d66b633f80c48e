"""English Snowball (Porter2) stemming as column stages.

Each step is one or two projections over the current word ``_w`` and the starts ``_p1``, ``_p2`` of the regions R1 and R2. The
whole chain is built-in string functions inside one generated-code span: no shuffle, no Python worker.

A step first finds its suffix with one anchored pattern on the reversed word and then looks its rule up in a literal
map. One CASE branch per suffix reads better but makes a method over 8000 bytes, which the JVM never compiles: that
form ran ten times slower.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from spinneret.functions.staging import fence, quoted

# --- Fixed values of the published algorithm ------------------------------------------------------------------------
VOWELS = "aeiouy"
SPECIAL_STEMS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
}
INVARIANT_WORDS = ["sky", "news", "howe", "atlas", "cosmos", "bias", "andes"]
INVARIANT_AFTER_1A = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]
R1_PREFIXES = ["gener", "commun", "arsen"]
STEP_1B = ["eed", "eedly", "ed", "edly", "ing", "ingly"]
DOUBLES = ["bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt"]
LI_ENDINGS = "cdeghkmnrt"
# suffix -> (replacement, letters one of which must come before the suffix, or None)
STEP_2 = {
    "tional": ("tion", None), "enci": ("ence", None), "anci": ("ance", None), "abli": ("able", None),
    "entli": ("ent", None), "izer": ("ize", None), "ization": ("ize", None), "ational": ("ate", None),
    "ation": ("ate", None), "ator": ("ate", None), "alism": ("al", None), "aliti": ("al", None),
    "alli": ("al", None), "fulness": ("ful", None), "ousli": ("ous", None), "ousness": ("ous", None),
    "iveness": ("ive", None), "iviti": ("ive", None), "biliti": ("ble", None), "bli": ("ble", None),
    "ogi": ("og", "l"), "fulli": ("ful", None), "lessli": ("less", None), "li": ("", LI_ENDINGS),
}
# suffix -> (replacement, region)
STEP_3 = {
    "tional": ("tion", 1), "ational": ("ate", 1), "alize": ("al", 1), "icate": ("ic", 1), "iciti": ("ic", 1),
    "ical": ("ic", 1), "ful": ("", 1), "ness": ("", 1), "ative": ("", 2),
}
# suffix -> letters one of which must come before the suffix, or None
STEP_4 = {
    "al": None, "ance": None, "ence": None, "er": None, "ic": None, "able": None, "ible": None, "ant": None,
    "ement": None, "ment": None, "ent": None, "ism": None, "ate": None, "iti": None, "ous": None, "ive": None,
    "ize": None, "ion": "st",
}
# A word ends in a short syllable.
SHORT_SYLLABLE = "^[aeiouy][^aeiouy]$|[^aeiouy][aeiouy][^aeiouywxY]$"
# --------------------------------------------------------------------------------------------------------------------


def longest_first(suffixes) -> list[str]:
    """The longest matching suffix decides; its conditions are tested afterwards, with no second choice."""
    return sorted(suffixes, key=lambda s: (-len(s), s))


def _literal_map(pairs: dict[str, str]) -> str:
    return f"map({', '.join(quoted(x) for pair in pairs.items() for x in pair)})"


def _find(suffixes, letters_before: dict[str, str] | None = None) -> str:
    """The longest of the suffixes that the word ends in, written backwards; empty if none fits.

    A suffix that asks for certain letters before it becomes a look-ahead in the reversed word. That keeps "the longest
    decides", because no such suffix ends in a shorter one of its step.
    """
    asks = letters_before or {}
    backwards = "|".join(s[::-1] + (f"(?=[{asks[s]}])" if s in asks else "") for s in longest_first(suffixes))
    return f"regexp_extract(reverse(_w), '^(?:{backwards})', 0)"


def _cut(n: int | str, tail: str = "''") -> str:
    """The word without its last n characters, with the tail added."""
    stump = f"substring(_w, 1, length(_w) - {n})"
    return stump if tail == "''" else f"concat({stump}, {tail})"


def _is_short(word: str) -> str:
    return f"{word} RLIKE '{SHORT_SYLLABLE}'"


_STEP_1A = f"""
    CASE WHEN NOT endswith(_w, 's') AND NOT endswith(_w, 'd') THEN _w
         WHEN _w RLIKE '(?:sses|..ie[sd])$' THEN {_cut(2)}
         WHEN _w RLIKE 'ie[sd]$' THEN {_cut(1)}
         WHEN _w RLIKE '[^us]s$' AND substring(_w, 1, length(_w) - 2) RLIKE '[aeiouy]' THEN {_cut(1)}
         ELSE _w END"""
# The words that stop after step 1a end in nothing that a step after 1b would change.
_FIND_1B = f"CASE WHEN _w IN ({', '.join(map(quoted, INVARIANT_AFTER_1A))}) THEN '' ELSE {_find(STEP_1B)} END"
# A trailing '+' asks the next stage to repair the end.
_STEP_1B = f"""
    CASE WHEN _suffix = '' THEN _w
         WHEN endswith(_suffix, 'dee') AND length(_w) - length(_suffix) >= _p1 THEN {_cut('length(_suffix)', "'ee'")}
         WHEN NOT endswith(_suffix, 'dee') AND {_cut('length(_suffix)')} RLIKE '[aeiouy]'
             THEN {_cut('length(_suffix)', "'+'")}
         ELSE _w END"""
_REPAIR_1B = f"""
    CASE WHEN NOT endswith(_w, '+') THEN _w
         WHEN _w RLIKE '(?:at|bl|iz)[+]$' THEN {_cut(1, "'e'")}
         WHEN _w RLIKE '(?:{'|'.join(DOUBLES)})[+]$' THEN {_cut(2)}
         WHEN length(_w) - 1 = _p1 AND {_is_short(_cut(1))} THEN {_cut(1, "'e'")}
         ELSE {_cut(1)} END"""
_STEP_1C = f"CASE WHEN _w RLIKE '^.+[^aeiouy][yY]$' THEN {_cut(1, quoted('i'))} ELSE _w END"
_STEP_5 = f"""
    CASE WHEN endswith(_w, 'e')
              AND (length(_w) - 1 >= _p2 OR (length(_w) - 1 >= _p1 AND NOT ({_is_short(_cut(1))}))) THEN {_cut(1)}
         WHEN endswith(_w, 'll') AND length(_w) - 1 >= _p2 THEN {_cut(1)}
         ELSE _w END"""


def _by_rule(allowed: str, tails: dict[str, str] | None = None) -> str:
    tail = f"element_at({_literal_map({s[::-1]: t for s, t in tails.items()})}, _suffix)" if tails else "''"
    return f"CASE WHEN _suffix <> '' AND {allowed} THEN {_cut('length(_suffix)', tail)} ELSE _w END"


def _region(pattern: str) -> str:
    """Start of a region: the length of what the pattern takes from the left, or of the word if it does not match."""
    return f"coalesce(nullif(length(regexp_extract(_w, '{pattern}', 0)), 0), length(_w))"


def with_stem(df: DataFrame, token: str, out: str = "stem") -> DataFrame:
    """Add the stem of the lower-case ``[a-z0-9]+`` column ``token``; every other column passes through."""
    kept = [f"`{c}`" for c in df.columns]

    def stage(word: str, *extra: str) -> DataFrame:
        return staged.selectExpr(*kept, f"{word} AS _w", *extra)

    marked = f"regexp_replace(`{token}`, '(^|[aeiouy])y', '$1Y')"
    staged = df.selectExpr(*kept, f"CASE WHEN contains(`{token}`, 'y') THEN {marked} ELSE `{token}` END AS _w")

    syllable = "[^aeiouy]*[aeiouy]+[^aeiouy]"
    r1 = f"^(?>{'|'.join(R1_PREFIXES)}|{syllable})"
    staged = stage("_w", f"{_region(r1)} AS _p1", f"{_region(r1 + syllable)} AS _p2")

    regions = ("_p1", "_p2")
    staged = stage(_STEP_1A, *regions)
    staged = stage("_w", *regions, f"{_FIND_1B} AS _suffix")
    staged = stage(_STEP_1B, *regions)
    staged = stage(_REPAIR_1B, *regions)
    staged = stage(_STEP_1C, *regions)

    in_r1 = "length(_w) - length(_suffix) >= _p1"
    in_r2 = "length(_w) - length(_suffix) >= _p2"
    staged = stage("_w", *regions, f"{_find(STEP_2, {s: b for s, (_, b) in STEP_2.items() if b})} AS _suffix")
    staged = stage(_by_rule(in_r1, {s: t for s, (t, _) in STEP_2.items()}), *regions)

    staged = stage("_w", *regions, f"{_find(STEP_3)} AS _suffix")
    only_r2 = ", ".join(quoted(s[::-1]) for s, (_, region) in STEP_3.items() if region == 2)
    allowed = f"{in_r1} AND (_suffix NOT IN ({only_r2}) OR {in_r2})"
    staged = stage(_by_rule(allowed, {s: t for s, (t, _) in STEP_3.items()}), *regions)

    staged = stage("_w", *regions, f"{_find(STEP_4, {s: b for s, b in STEP_4.items() if b})} AS _suffix")
    staged = stage(_by_rule(in_r2), *regions)
    staged = stage(_STEP_5)

    # Words of one or two letters come through every step unchanged.
    special = _literal_map(SPECIAL_STEMS | {word: word for word in INVARIANT_WORDS})
    finished = f"coalesce(element_at({special}, `{token}`), translate(_w, 'Y', 'y'))"
    return staged.selectExpr(*[c for c in kept if c != f"`{out}`"], f"{fence(finished)} AS `{out}`")
