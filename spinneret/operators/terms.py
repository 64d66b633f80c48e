"""From page text to the distinct stems of each document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.functions.markup import clean_text, tokens_of, with_raw_text
from spinneret.functions.stemming import with_stem
from spinneret.session import cut_lineage, has_at_most

# Most words a broadcast table may hold, about 40 MB.
BROADCAST_WORDS = 500_000


def page_text(pages: DataFrame) -> DataFrame:
    """``(page_id, text)``: body text in lower case, everything but ``[a-z0-9 ]`` blanked out."""
    return with_raw_text(pages.select("page_id", "html")).select("page_id", clean_text("text").alias("text"))


def token_arrays(pages: DataFrame, *more: str) -> DataFrame:
    """``(page_id, tokens)`` with the distinct tokens of each page, and ``more`` columns of the pages."""
    return text_token_arrays(with_raw_text(pages.select("page_id", *more, "html")), "page_id", *more)


def text_token_arrays(texts: DataFrame, *keys: str) -> DataFrame:
    """``(keys, tokens)`` with the distinct tokens of each plain text."""
    return texts.select(*keys, F.array_distinct(tokens_of("text")).alias("tokens"))


def page_tokens(pages: DataFrame) -> DataFrame:
    """``(page_id, position, token)``: every token of two or more characters, duplicates kept."""
    texts = with_raw_text(pages.select("page_id", "html"))
    return texts.select("page_id", F.posexplode(tokens_of("text")).alias("position", "token"))


def vocabulary(token_rows: DataFrame) -> DataFrame:
    """``(token, n_rows)``; map-side counts go into the shuffle, so a hot token costs one row per task."""
    return token_rows.groupBy("token").agg(F.count(F.lit(1)).alias("n_rows"))


def stemmed_vocabulary(token_rows: DataFrame) -> DataFrame:
    """``(token, stem)`` for each distinct token: the stemmer runs once per word."""
    return with_stem(token_rows.select("token").distinct(), "token").select("token", "stem")


def stem_rows(token_rows: DataFrame, broadcast_words: int = BROADCAST_WORDS, counted: DataFrame | None = None) -> DataFrame:
    """Add ``stem`` to rows with a ``token``: each distinct word is stemmed once and looked up.

    ``counted`` are the same rows to take the vocabulary from, where those are cheaper to read.

    A vocabulary of at most ``broadcast_words`` words is broadcast. Of a larger one, only the words that make up more
    than 1/``broadcast_words`` of all rows are, and there cannot be more than ``broadcast_words`` of those; they hold
    nearly all rows and all hot keys. The other words go through a shuffled join, in which no key is hot.
    """
    words = cut_lineage(with_stem(vocabulary(token_rows if counted is None else counted), "token"))
    if has_at_most(words, broadcast_words):
        return token_rows.join(F.broadcast(words.select("token", "stem")), "token")
    n_rows = words.agg(F.sum("n_rows")).first()[0]
    is_common = F.col("n_rows") > n_rows / broadcast_words
    common = words.where(is_common).select("token", "stem")
    looked_up = token_rows.join(F.broadcast(common), "token", "left")
    rare = looked_up.where("stem IS NULL").drop("stem").join(words.where(~is_common).select("token", "stem"), "token")
    return looked_up.where("stem IS NOT NULL").unionByName(rare)


def distinct_stems(token_lists: DataFrame, *keys: str) -> DataFrame:
    """``(keys, token)`` with the distinct stems of each document, from ``(keys, tokens)`` of distinct words.

    Two words of a document may share a stem, so duplicates go after stemming; words that occur twice are gone already,
    which leaves a hot token at most one row per document. The lists are written down first: they are read twice, for
    the vocabulary and for the look-up, and are much smaller than the pages they were parsed from. They are dealt out by
    document while they are still lists; a broadcast look-up keeps each document's stems together, so the duplicates go
    where they are, without a shuffle of single stems.
    """
    token_lists = cut_lineage(token_lists)
    exploded = [*keys, F.explode("tokens").alias("token")]
    words = token_lists.repartition(*keys).select(*exploded)
    stems = stem_rows(words, counted=token_lists.select(*exploded)).select(*keys, F.col("stem").alias("token"))
    return stems.dropDuplicates([*keys, "token"])


def doc_terms(pages: DataFrame) -> DataFrame:
    """``(page_id, token)``: distinct stems of each page."""
    return distinct_stems(token_arrays(pages), "page_id")
