"""Operator 4: secrets, with the guess cost of credential values by dynamic programming.

Three kinds of spans come from patterns alone. The method adds a fourth, ``guess``: a value that stands in a credential
context and would take at least 2^``MIN_BITS`` guesses. The cost of a value is the least over all its segmentations
into words, dates, repeats, keyboard walks and brute-force spans, computed from left to right; a segment's cost is the
logarithm of the guesses that a pattern-aware attacker would need for it.

The words are the corpus's own most frequent ones, at most ``DICTIONARY``, ranked, after a short list of common passwords. They
are counted over all documents with map-side combining; the list that is broadcast has that fixed size.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import log2

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.session import cut_lineage

DICTIONARY = 20_000
WORD_LENGTHS = (3, 20)
MIN_BITS = 30.0
#: Bits for each cut between two segments.
CUT_BITS = 1.0
LONGEST_PERIOD = 16

# Common passwords in order of use, keyboard rows, letter substitutions.
COMMON = (
    "password 123456 qwerty letmein admin welcome monkey dragon master login abc123 iloveyou secret changeme passw0rd "
    "football baseball sunshine princess shadow superman trustno1 test guest root default hello freedom whatever"
).split()
KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
LEET = str.maketrans("013457@$", "oleastas")

ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# The values are drawn so that no two matches of a kind overlap; runs are taken whole, hence the lengths in the patterns.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")
CONTEXT = re.compile(
    r"""(?ai:pass(?:word|wd|phrase|code)|pwd|secret|token|bearer|credentials?|api[_-]?key|access[_-]?key|private[_-]?key)"""
    r"""["']?(?:\x20*(?:[:=]|=>|->)\x20*|\x20+(?ai:is)\x20+)["']?([^\x20\x09-\x0D"'<>,;]+)"""
)
_HINTS = ("pass", "pwd", "secret", "token", "bearer", "credential", "key")
_DATE = re.compile(r"(?:19|20)\d\d(?:([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01]))?|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)?\d\d")
_DATE_BITS, _YEAR_BITS = log2(365 * 120 * 4), log2(120)


def _beside() -> dict[str, set[str]]:
    """Each key's neighbours: along its row, and the nearest in the rows above and below."""
    near: dict[str, set[str]] = {}
    for r, row in enumerate(KEY_ROWS):
        for c, key in enumerate(row):
            spots = [(r, c - 1), (r, c + 1), (r - 1, c), (r - 1, c + 1), (r + 1, c - 1), (r + 1, c)]
            near[key] = {KEY_ROWS[y][x] for y, x in spots if 0 <= y < len(KEY_ROWS) and 0 <= x < len(KEY_ROWS[y])}
    return near


_NEAR = _beside()
_WALK_START, _WALK_STEP = log2(sum(map(len, KEY_ROWS))), log2(3)


def _letter_bits(letter: str) -> float:
    if letter.isdigit():
        return log2(10)
    return log2(26) if letter.isalpha() else log2(33)


def guess_bits(value: str, ranks: dict[str, int]) -> float:
    """The logarithm (base 2) of the guesses for a value; 0 for an empty one. ``ranks`` holds words from rank 1 on."""
    n, low = len(value), value.lower()
    plain = low.translate(LEET)
    best = [0.0] + [float("inf")] * n
    brute = [0.0]
    for letter in value:
        brute.append(brute[-1] + _letter_bits(letter))
    walk = 0  # start of the keyboard walk that ends here
    runs = [0] * (LONGEST_PERIOD + 1)
    dates: dict[int, list[int]] = {}
    for start in range(n):
        if low[start].isdigit() and (m := _DATE.match(low, start)):
            dates.setdefault(m.end(), []).append(start)
    open_brute = 0.0  # least of best[i] - brute[i], the start of a brute-force span; cuts are paid where it starts
    for end in range(1, n + 1):
        at = end - 1
        now = open_brute + brute[end]
        if end > 1 and low[at] not in _NEAR.get(low[at - 1], ()):
            walk = at
        if end - walk >= 4:
            now = min(now, best[walk] + CUT_BITS * (walk > 0) + _WALK_START + _WALK_STEP * (end - walk - 1))
        for start in dates.get(end, ()):
            bits = _YEAR_BITS if end - start == 4 else _DATE_BITS
            now = min(now, best[start] + CUT_BITS * (start > 0) + bits)
        for period in range(1, min(LONGEST_PERIOD, at) + 1):
            runs[period] = runs[period] + 1 if value[at] == value[at - period] else 0
            if runs[period] >= max(2, period):
                first = end - runs[period] - period
                block = brute[first + period] - brute[first]
                now = min(now, best[first] + CUT_BITS * (first > 0) + block + log2(runs[period] / period + 1))
        if low[at].isalnum() or low[at] in "@$":
            for start in range(max(0, end - WORD_LENGTHS[1]), end - WORD_LENGTHS[0] + 1):
                rank, leet = ranks.get(low[start:end]), 0.0
                if rank is None:
                    rank, leet = ranks.get(plain[start:end]), 1.0
                if rank is not None:
                    cased = value[start:end]
                    upper = 0.0 if cased == low[start:end] else 1.0 if cased[1:] == low[start + 1 : end] else 3.0
                    now = min(now, best[start] + CUT_BITS * (start > 0) + log2(rank) + upper + leet)
        best[end] = now
        open_brute = min(open_brute, now + CUT_BITS - brute[end])
    return best[n]


def spans_of(text: str, ranks: dict[str, int]) -> list[tuple[int, int, int, float]]:
    """``(start, kind number, end, bits)`` in the order of start, then kind; bits are 0 but for guesses."""
    found = []
    lowered = text.lower()
    if any(hint in lowered for hint in _HINTS):
        found += [(m.start(), 0, m.end(), 0.0) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
        for m in CONTEXT.finditer(text):
            bits = guess_bits(m[1], ranks)
            if bits >= MIN_BITS:
                found.append((m.start(1), 3, m.end(1), bits))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), 0.0) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), 0.0) for m in HEX.finditer(text)]
    return sorted(found)


def joined(spans: list[tuple[int, int, int, float]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end, _ in spans)


def word_ranks(docs: DataFrame, size: int = DICTIONARY) -> dict[str, int]:
    """The common passwords, then the corpus's most frequent words of letters, at most ``size``, each with its rank.

    How frequent a word has to be is read off a histogram of the counts, so no task sends more than the words taken.
    """
    words = docs.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")).where(F.length("word").between(*WORD_LENGTHS))
    counts = cut_lineage(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    step = F.floor(F.log2("n") * 16).cast("int")
    taken, least = 0, None
    for row in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        taken += row["count"]
        if taken > size:
            break
        least = row["step"]
    top = [] if least is None else counts.where(step >= least).collect()
    ranks = {word: i for i, word in enumerate(COMMON, 1)}
    for row in sorted(top, key=lambda r: (-r["n"], r["word"])):
        ranks.setdefault(row["word"], len(ranks) + 1)
    return ranks


def find_secrets(docs: DataFrame, ranks: dict[str, int] | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess, most_bits``.

    ``spans`` lists kind:start:end in code points; ``most_bits`` is the cost of the hardest value, 0 without one. A null text is empty.
    Whole texts are scanned whatever their length; rows stay rows; extra columns play no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(word_ranks(docs) if ranks is None else ranks)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                spans = spans_of(text or "", shared.value)
                base = [s for s in spans if s[1] < 3]
                counts = [sum(s[1] == kind for s in spans) for kind in range(4)]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((doc_id, *counts[:3], digest, joined(spans), counts[3], max((s[3] for s in spans), default=0.0)))
            yield pd.DataFrame(rows, columns=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", "most_bits"])

    told = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    schema = "doc_id string, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_guess bigint, most_bits double"
    return told.mapInPandas(scan, schema).withColumn("doc_id", F.col("doc_id").cast("bigint"))
