"""Operator 11: fill-in-the-middle by block rotations in place.

A text is cut twice, between units (lines or characters), into prefix, middle and suffix. Its bytes go into a bytearray;
sentinels are inserted at the cuts, which gives ``<P>prefix<M>middle<S>suffix``, and the blocks then change places by
rotations of three reversals each, inside the array. For ``psm`` the last two blocks are exchanged, for ``spm`` the last
one goes before the other two. Restoring finds the sentinels, inverts the rotation and takes the sentinels out, so it
gives the text back byte by byte. A text that holds a sentinel stays plain, so the sentinels of an output are its own:
each begins with the only ``<`` it has, and no cut can make up another one.

The cuts and the form depend on the doc_id and the seed alone. It is one pass over the rows without a shuffle; a task
holds the texts of one Arrow batch. A null text is empty, an empty one stays plain; a null doc_id draws as an empty one;
rows of one doc_id and text are transformed alike; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinneret.llm.common import digest_group, id_digest

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
_MARK = len(PREFIX)
RESULT = "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: string>"


def _reverse(cells: np.ndarray, start: int, end: int) -> None:
    """Turn ``cells[start:end]`` round in place, half against half."""
    half = (end - start) // 2
    left, right = cells[start : start + half], cells[end - half : end]
    kept = left[::-1].copy()
    left[:] = right[::-1]
    right[:] = kept


def rotate(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Exchange the neighbouring blocks ``start:middle`` and ``middle:end`` by three reversals."""
    cells = np.frombuffer(buffer, np.uint8)
    _reverse(cells, start, middle)
    _reverse(cells, middle, end)
    _reverse(cells, start, end)


def unit_ends(raw: bytes | bytearray, unit: str) -> np.ndarray:
    """The byte after each unit: a line with its end, the rest after the last one, or a code point."""
    cells = np.frombuffer(raw, np.uint8)
    if unit == "char":
        return np.append(np.flatnonzero((cells & 0xC0) != 0x80)[1:], len(cells)) if len(cells) else np.empty(0, np.int64)
    ends = np.flatnonzero(cells == 10) + 1
    return ends if not len(cells) or cells[-1] == 10 else np.append(ends, len(cells))


def n_chars(raw: bytes | bytearray) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))


def rotated(buffer: bytearray, first: int, second: int, form: str) -> None:
    """Cut at two byte offsets, mark the blocks and bring them into the order of ``form``."""
    for at, mark in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[at:at] = mark
    suffix = second + 2 * _MARK
    rotate(buffer, 0 if form == SPM else first + _MARK, suffix, len(buffer))


def unrotated(buffer: bytearray, form: str) -> None:
    """The inverse of :func:`rotated`."""
    size = len(buffer)
    if form == SPM:
        moved = buffer.find(PREFIX)
        rotate(buffer, 0, moved, size)
        suffix, middle = size - moved, buffer.find(MIDDLE)
    else:
        middle, moved = buffer.find(SUFFIX), buffer.find(MIDDLE)
        rotate(buffer, middle, moved, size)
        suffix = middle + size - moved
    for at in (suffix, middle, 0):
        del buffer[at : at + _MARK]


def _transform(unit: str):
    def one(raw: bytes, h1: int, h2: int, spm: bool, asked: bool) -> tuple:
        ends = unit_ends(raw, unit)
        n = len(ends)
        if not asked or not raw or PREFIX in raw or SUFFIX in raw or MIDDLE in raw:
            return n, PLAIN, None, None, raw
        first, second = (int(ends[k - 1]) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
        buffer, form = bytearray(raw), SPM if spm else PSM
        rotated(buffer, first, second, form)
        return n, form, n_chars(raw[:first]), n_chars(raw[first:second]), bytes(buffer)

    @F.arrow_udf(RESULT)
    def transform(text: pa.Array, h1: pa.Array, h2: pa.Array, spm: pa.Array, asked: pa.Array) -> pa.Array:
        columns = zip(text.to_pylist(), h1.to_pylist(), h2.to_pylist(), spm.to_pylist(), asked.to_pylist())
        made = list(zip(*[one(*row) for row in columns])) or [[]] * 5
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        names = ("n", "form", "prefix_chars", "middle_chars", "output")
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(made, kinds)], names)

    return transform


def _restore(output: pa.Array, form: pa.Array) -> pa.Array:
    texts = []
    for raw, kind in zip(output.to_pylist(), form.to_pylist()):
        if kind in (PSM, SPM):
            buffer = bytearray(raw)
            unrotated(buffer, kind)
            raw = bytes(buffer)
        texts.append(raw)
    return pa.array(texts, pa.string())


def fill_in_middle(
    docs: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50, unit: str = "line", out: str = "fim"
) -> DataFrame:
    """All rows of ``docs(doc_id, text, ...)`` with a struct ``out`` of ``n, form, prefix_chars, middle_chars, output``.

    ``n`` counts the units, ``line`` or ``char``. ``rate`` per cent of the documents are transformed, ``spm_rate`` per
    cent of those as ``spm``; the others, and texts that are empty or hold a sentinel, are ``plain``: their output is the
    text, their numbers of characters are null. A column named ``out`` is replaced, other columns stay as they are.
    """
    if unit not in ("line", "char"):
        raise ValueError(f"unknown unit: {unit}")
    digest = id_digest(seed)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    spm, asked = digest_group(digest, 3) % 100 < spm_rate, digest_group(digest, 2) % 100 < rate
    return docs.withColumn(out, _transform(unit)(text, digest_group(digest, 0), digest_group(digest, 1), spm, asked))


def restored(output: str | Column, form: str | Column) -> Column:
    """The text that :func:`fill_in_middle` made an output from, out of the output and its form."""
    whole = F.col(output) if isinstance(output, str) else output
    return F.arrow_udf(_restore, "string")(whole.cast("binary"), form)


def fill_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of every row."""
    made = fill_in_middle(docs.select("doc_id", "text")).select("doc_id", "fim.*")
    sums = made.withColumn("restored", restored("output", "form"))
    return sums.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


#: The same as :func:`fill_digest`, by lists of lines.
FILL_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
    sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), d AS (
  SELECT doc_id, text, lines, len(lines)::BIGINT AS n,
    ('0x' || substr(h, 1, 8))::BIGINT % (len(lines) + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (len(lines) + 1) AS y,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 100
      THEN 'plain' WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM t
), b AS (
  SELECT doc_id, text, n, form, array_to_string(lines[1:least(x, y)], '') AS a,
    array_to_string(lines[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(lines[greatest(x, y) + 1:n], '') AS z
  FROM d
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256,
  sha256(CASE WHEN form = 'plain' THEN text ELSE a || m || z END) AS restored_sha256
FROM b
"""
