"""Operator 7: personal data, with information-theoretic sanitisation of the terms around it.

Four kinds of values come from patterns; each distinct value is a protected entity. The method then asks which other
terms give an entity away. Over all documents it counts the documents that hold a term, an entity, and both within
``WINDOW`` words of each other. The entity's information is IC(e) = -log2 p(e); what a term discloses of it is the
pointwise mutual information PMI(t, e) = log2 (p(t, e) / (p(t) p(e))), which is IC(e) when the term occurs with nothing
but the entity. A term that stands beside an entity and discloses at least ``REMOVE`` of its information is removed;
from ``GENERALISE`` on it is replaced by its kind of word. Pairs seen in fewer than ``SUPPORT`` documents tell nothing.

Terms are counted with map-side combining, pairs come from mentions of entities only, and both are joined by shuffles;
nothing of the corpus is collected or broadcast.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.llm.common import ROW, packed, with_row
from spinneret.session import cut_lineage

WINDOW = 5
SUPPORT = 3
GENERALISE, REMOVE = 0.8, 0.95

KINDS = ("email", "ip", "card", "phone", "generalise", "remove")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only start where a run of digits does, and takes whole runs, so no shorter run has to be tried.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,40}")
_LOCAL_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Code points beside an entity in which its window of words lies.
_REACH = 400


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` in the order of start, then kind."""
    found = []
    done = 0
    at = text.find("@")
    while at >= 0:
        # The local part is the run of its letters before the sign, from the last match's end at the earliest.
        start = at
        while start > done and text[start - 1] in _LOCAL_LETTERS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 12:
            continue
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def entity(kind: int, value: str) -> str:
    """The protected entity: the kind and the value without case or separators."""
    return f"{KINDS[kind]}:{value.lower() if kind < 2 else re.sub('[^0-9]', '', value)}"


def terms_beside(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, str, int, int]]:
    """``(entity, term, start, end)`` for the ``WINDOW`` terms on each side of a span; terms inside a span don't count."""
    for start, kind, end in spans:
        named = entity(kind, text[start:end])
        low = max(0, start - _REACH)
        before = [(low + m.start(), low + m.end()) for m in _TERM.finditer(text[low:start])][-WINDOW:]
        after = [(end + m.start(), end + m.end()) for m in _TERM.finditer(text[end : end + _REACH])][:WINDOW]
        for a, b in before + after:
            if not any(s < b and a < e for s, _, e in spans):
                yield named, text[a:b].lower(), a, b


def find_base(docs: DataFrame) -> DataFrame:
    """``(_row, doc_id, n_email, n_ip, n_card, n_phone, base, beside)``: the pattern's spans and the terms beside them, a row per document."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row, doc_id, text in zip(batch[ROW], batch["doc_id"], batch["text"]):
                text = text or ""
                spans = base_spans(text)
                beside = [{"entity": e, "term": t, "start": a, "stop": b} for e, t, a, b in terms_beside(text, spans)]
                rows.append((row, doc_id, *(sum(s[1] == k for s in spans) for k in range(4)), joined(spans), beside))
            yield pd.DataFrame(rows, columns=[ROW, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "beside"])

    told = with_row(docs.select("doc_id", "text")).select(ROW, F.col("doc_id").cast("string").alias("doc_id"), "text")
    schema = (
        f"{ROW} bigint, doc_id string, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, "
        "beside array<struct<entity: string, term: string, start: bigint, stop: bigint>>"
    )
    return told.mapInPandas(scan, schema).withColumn("doc_id", F.col("doc_id").cast("bigint"))


def disclosing_terms(mentions: DataFrame, docs: DataFrame) -> DataFrame:
    """``(entity, term, share)``: the share of the entity's information that the term discloses, ``GENERALISE`` or more.

    ``mentions`` has a row ``(_row, entity, term)`` for each term beside an entity.
    """
    pairs = mentions.select(ROW, "entity", "term").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("both"))
    pairs = pairs.where(F.col("both") >= SUPPORT)
    entities = mentions.select(ROW, "entity").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("with_entity"))
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("term"))
    wanted = pairs.select("term").distinct()
    with_term = words.groupBy("term").agg(F.count(F.lit(1)).alias("with_term")).join(wanted, "term", "left_semi")
    n_docs = docs.count()
    known = pairs.join(entities, "entity").join(with_term, "term")
    information = -F.log2(F.col("with_entity") / n_docs)
    mutual = F.log2(F.col("both") * F.lit(float(n_docs)) / (F.greatest("with_term", "both") * F.col("with_entity")))
    share = F.when(information > 0, mutual / information).otherwise(0.0)
    return known.select("entity", "term", share.alias("share")).where(F.col("share") >= GENERALISE)


def find_private(docs: DataFrame) -> DataFrame:
    """``(_row, doc_id, n_email, n_ip, n_card, n_phone, base, spans)``: ``spans`` holds all spans, in order.

    ``docs`` must be a table scan, since its rows are numbered. A null text is empty; whole texts are scanned whatever
    their length; repeated rows have results of their own. A term is removed rather than generalised if any entity asks for that.
    """
    found = cut_lineage(find_base(docs))
    mentions = found.select(ROW, F.explode("beside").alias("m")).select(ROW, "m.*")
    terms = disclosing_terms(mentions, docs)
    hits = mentions.join(terms, ["entity", "term"]).groupBy(ROW, "start", "stop").agg(F.max("share").alias("share"))
    kind = F.when(F.col("share") >= REMOVE, F.lit(KINDS.index("remove"))).otherwise(F.lit(KINDS.index("generalise")))
    added = hits.groupBy(ROW).agg(F.collect_list(F.struct("start", kind.alias("kind"), "stop")).alias("added"))
    # Base spans as (start, kind, stop) again, then all in one order.
    names = F.array(*[F.lit(k) for k in KINDS])
    parsed = F.transform(
        F.filter(F.split("base", ","), lambda x: x != ""),
        lambda x: F.struct(
            F.element_at(F.split(x, ":"), 2).cast("bigint").alias("start"),
            (F.array_position(names, F.element_at(F.split(x, ":"), 1)) - 1).cast("int").alias("kind"),
            F.element_at(F.split(x, ":"), 3).cast("bigint").alias("stop"),
        ),
    )
    all_spans = F.array_sort(F.concat(parsed, F.coalesce("added", F.array().cast("array<struct<start: bigint, kind: int, stop: bigint>>"))))
    text = F.transform(all_spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"]))
    placed = found.drop("beside").join(added, ROW, "left")
    return placed.withColumn("spans", F.array_join(text, ",")).drop("added")


def private_digest(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``."""
    found = find_private(docs)
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def sanitise(docs: DataFrame) -> DataFrame:
    """All columns, with ``text`` sanitised: values give way to their kind, terms to ``<word>`` or to nothing."""

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_replaced(t, s) for t, s in zip(texts, spans)])

    spans = find_private(docs).select(ROW, "spans")
    text = cleaned("doc.text", "spans").alias("text")
    return packed(docs).join(spans, ROW).select(*[text if c == "text" else f"doc.{c}" for c in docs.columns])


def _replaced(text: str | None, spans: str) -> str | None:
    if not text or not spans:
        return text
    out, done = [], 0
    for span in spans.split(","):
        kind, start, stop = span.split(":")
        if int(start) < done:
            continue
        out += [text[done : int(start)], {"remove": "", "generalise": "<word>"}.get(kind, f"<{kind}>")]
        done = int(stop)
    return "".join(out) + text[done:]
