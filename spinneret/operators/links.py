"""Links of a page snapshot: extraction, resolution, removal of visited targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinneret.functions.markup import first_base_tag, link_tags, with_attribute, without_code
from spinneret.functions.urls import with_absolute_url


def page_links(pages: DataFrame) -> DataFrame:
    """``(page_id, position, href)`` for every ``<a>`` in page order, duplicates kept; NULL without the attribute."""
    pages = pages.select("page_id", without_code("html").alias("html"))
    tags = pages.select("page_id", F.posexplode(link_tags("html")).alias("position", "tag"))
    whole = tags.where(F.col("tag").endswith(">"))
    return with_attribute(whole, "tag", "a", "href", out="href").drop("tag")


def resolved_links(pages: DataFrame) -> DataFrame:
    """``(page_id, src_url, position, dst_url)`` with absolute targets; links that cannot be resolved are dropped.

    A ``<base href>`` takes the place of the page's URL. URLs are not normalised otherwise, fragments stay.
    """
    return _resolved(pages, link_tags("html"))


def distinct_targets(pages: DataFrame) -> DataFrame:
    """``(page_id, dst_url)`` of :func:`resolved_links`, where equal tags of a page are taken once, before they leave it."""
    return _resolved(pages, F.array_distinct(link_tags("html"))).select("page_id", "dst_url")


def _resolved(pages: DataFrame, tags: Column) -> DataFrame:
    pages = pages.select("page_id", "url", without_code("html").alias("html"))
    tags = pages.select("page_id", "url", first_base_tag("html").alias("base_tag"), tags.alias("tags"))
    based = with_attribute(tags, "base_tag", "base", "href", out="base_href").drop("base_tag")
    based = with_absolute_url(based, "url", "base_href", out="base_url").drop("base_href")
    base = F.when(F.col("base_url") == "", F.col("url")).otherwise(F.col("base_url"))
    rows = based.select("page_id", "url", base.alias("base"), F.posexplode("tags").alias("position", "tag"))
    links = with_attribute(rows.where(F.col("tag").endswith(">")), "tag", "a", "href", out="href").drop("tag")
    resolved = with_absolute_url(links, "base", "href", out="dst_url")
    return resolved.where(F.trim("dst_url") != "").select("page_id", F.col("url").alias("src_url"), "position", "dst_url")


def unvisited(links: DataFrame, visited: DataFrame, target: str = "dst_url") -> DataFrame:
    """Links whose target is not visited yet; duplicates stay until the target is taken from the frontier.

    A popular target may hold a large part of all links. The visited side has one row per target, so a hot target's
    links can be split over tasks at run time, each with a copy of that row.
    """
    taken = visited.select(F.col("url").alias(target)).distinct()
    return links.join(taken, target, "left_anti").select(*links.columns)
