"""Pages and feeds to rows. One page row in, one row per entry out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import markup as mk
from tidemark.functions.once import computed_once
from tidemark.functions.text import strip


def _first(text: Column, pattern: str) -> Column:
    return F.regexp_extract(text, pattern, 1)


def _field(text: Column, name: str) -> Column:
    return _first(text, fixed.FEED_FIELD.format(name))


def _has(text: Column, name: str) -> Column:
    return mk.found(text, fixed.FEED_FIELD.format(name))


def _count(text: Column) -> Column:
    """Digits as a number, anything else 0."""
    return F.coalesce(F.when(text.rlike(r"^\d+$"), text.try_cast("int")), F.lit(0))


def _explode(pages: DataFrame, keep: Sequence[str], parts: Column) -> DataFrame:
    rows = pages.select(*keep, F.posexplode_outer(parts).alias("pos", "part"))
    return rows.filter(F.col("part").isNotNull())


# --- pages ------------------------------------------------------------------

_TOPIC = mk.with_class("div", "topic_row")
_TOPIC_LINK = rf"(?is){mk.with_class('[a-z0-9]+', 'topictitle')}.*?<a\b([^>]*)>"
_TOPIC_HEADING = rf"(?is){mk.with_class('h2', 'topic-title-heading')}(.*?)</h2>"
_TOPIC_TEXT = rf"(?is){mk.with_class('[a-z0-9]+', 'topicdesc')}.*?<a\b[^>]*>(.*?)</a>"
# The body is looked at, not consumed: counters may be nested.
_TOPIC_POINTS = r"""(?is)\bid\s*=\s*["']tp([^"']*)["'](?=[^>]*>(.*?)</)"""
_TOPIC_COMMENTS = r"""(?is)<a\b[^>]*\bdata-topic-comment-count\s*=\s*["']([^"']*)["']"""


def topic_rows(pages: DataFrame, topic_url: str, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Forum pages to topics; a row without id, link or heading is skipped.

    ``topic_url`` is a template with one ``%s`` for the id.
    """
    rows = _explode(pages, keep, F.split("html", rf"(?is)(?={_TOPIC})"))
    rows = rows.filter(F.col("part").rlike(rf"(?is)\A{_TOPIC}"))
    rows = computed_once(rows, "row", mk.element_body(F.col("part"), r"\A<div\b[^>]*>", F.lit("div")))
    rows = rows.withColumn(
        "id", mk.attribute(F.regexp_extract("part", r"(?is)\A<div\b([^>]*)>", 1), "data-topic-state-id")
    )
    row = F.col("row")
    counters = F.arrays_zip(
        F.regexp_extract_all("row", F.lit(_TOPIC_POINTS), 1).alias("of"),
        F.regexp_extract_all("row", F.lit(_TOPIC_POINTS), 2).alias("body"),
    )
    mine = F.filter(counters, lambda c: F.lower(c["of"]) == F.lower(F.col("id")))
    points = F.coalesce(F.get(mine, F.lit(0))["body"], F.lit(""))
    complete = F.col("id").isNotNull() & mk.found(row, _TOPIC_LINK) & mk.found(row, _TOPIC_HEADING)
    return rows.filter(complete).select(
        *keep,
        "pos",
        "id",
        mk.unescape(mk.node_text(_first(row, _TOPIC_HEADING))).alias("title"),
        mk.unescape(F.coalesce(mk.attribute(_first(row, _TOPIC_LINK), "href"), F.lit(""))).alias("url"),
        F.format_string(topic_url, F.col("id")).alias("topic_url"),
        _count(mk.node_text(points)).alias("points"),
        _count(_first(row, _TOPIC_COMMENTS)).alias("comments"),
        mk.attribute(_first(row, r"(?is)<time\b([^>]*)>"), "data-date").alias("date"),
        mk.unescape(mk.node_text(_first(row, _TOPIC_TEXT))).alias("desc"),
    )


_REPO = rf"(?is){mk.with_class('article', 'Box-row')}(.*?)</article>"
_REPO_LINK = r"(?is)<h2\b[^>]*>.*?<a\b([^>]*)>"
_REPO_TEXT = r"(?is)<p\b[^>]*>(.*?)</p>"
_REPO_LANGUAGE = r"""(?is)<([a-z0-9]+)\b[^>]*\bitemprop\s*=\s*["']programmingLanguage["'][^>]*>(.*?)</\1"""
_REPO_STARS = r"(?is)<span\b[^>]*>(?:\s++|<[^>]*>)*+([\d,]+)(?:\s++|<[^>]*>)++stars today"


def repo_rows(
    pages: DataFrame, host: str = fixed.REPO_HOST, keep: Sequence[str] = ("page_id",)
) -> DataFrame:
    """Trending pages to repositories with the stars of the day."""
    rows = _explode(pages, keep, F.regexp_extract_all("html", F.lit(_REPO), F.lit(1)))
    part = F.col("part")
    href = F.btrim(F.coalesce(mk.attribute(_first(part, _REPO_LINK), "href"), F.lit("")), F.lit("/"))
    stars = F.replace(_first(part, _REPO_STARS), F.lit(","), F.lit(""))
    return rows.filter(mk.found(part, _REPO_LINK)).select(
        *keep,
        "pos",
        href.alias("repo"),
        F.concat(F.lit(host), href).alias("url"),
        mk.unescape(mk.node_text(_first(part, _REPO_TEXT))).alias("description"),
        mk.unescape(mk.node_text(F.regexp_extract(part, _REPO_LANGUAGE, 2))).alias("language"),
        F.coalesce(stars.try_cast("int"), F.lit(0)).alias("stars_today"),
    )


def page_body(
    pages: DataFrame,
    node_id: str = "contents",
    fallback: Column | None = None,
    keep: Sequence[str] = ("page_id",),
    min_chars: int = fixed.BODY_MIN_CHARS,
    chars: int = fixed.BODY_CHARS,
) -> DataFrame:
    """Text of the element with an id, one line, cut; the fallback when it is short."""
    attributes = rf"""\b[^>]*\bid\s*=\s*["']{node_id}["'][^>]*>"""
    opening = rf"<[a-z][a-z0-9]*{attributes}"
    tag = F.regexp_extract("html", rf"(?is)<([a-z][a-z0-9]*){attributes}", 1)
    body = mk.element_body(F.col("html"), opening, tag)
    fallback = F.lit("") if fallback is None else fallback
    rows = pages.select(
        *keep,
        fallback.alias("_fallback"),
        F.when(tag != "", mk.node_text(body, " ")).otherwise("").alias("_text"),
    )
    line = F.regexp_replace(mk.unescape(F.col("_text")), r"(?U)\s+", " ")
    return rows.withColumn("_line", line).select(
        *keep,
        F.when(F.length("_line") > min_chars, F.left("_line", F.lit(chars)))
        .otherwise(F.col("_fallback"))
        .alias("body"),
    )


def first_readme(candidates: DataFrame, chars: int = fixed.README_CHARS) -> DataFrame:
    """First usable text per repository among (branch, name) candidates in fixed order."""
    rank = F.array_position(F.lit(list(fixed.README_BRANCHES)), F.col("branch")) * 10
    rank = rank + F.array_position(F.lit(list(fixed.README_NAMES)), F.col("name"))
    usable = strip(F.col("text")) != ""
    return candidates.filter(usable).groupBy("repo").agg(
        F.min_by(F.left("text", F.lit(chars)), rank).alias("readme")
    )


def repo_content(
    repos: DataFrame, readmes: DataFrame, short: int = fixed.SHORT_DESCRIPTION
) -> DataFrame:
    """``content``: the description, or for a short one the readme, else what there is."""
    rows = repos.join(readmes, "repo", "left")
    own = F.nullif("description", F.lit(""))
    longer = F.coalesce(F.nullif("readme", F.lit("")), own, F.col("repo"))
    content = F.when(F.length("description") < short, longer).otherwise(F.col("description"))
    return rows.withColumn("content", content).drop("readme")


# --- feeds ------------------------------------------------------------------

def _items(feeds: DataFrame, keep: Sequence[str], tag: str) -> DataFrame:
    pattern = F.lit(fixed.FEED_FIELD.format(tag))
    return _explode(feeds, keep, F.regexp_extract_all("xml", pattern, F.lit(1)))


def feed_items(
    feeds: DataFrame,
    keep: Sequence[str] = ("feed_pos", "source"),
    per_feed: int = fixed.ITEMS_PER_FEED,
) -> DataFrame:
    """First items of every feed that have title and link."""
    rows = _items(feeds, keep, "item").filter(F.col("pos") < per_feed)
    part = F.col("part")
    return rows.filter(_has(part, "title") & _has(part, "link")).select(
        *keep,
        "pos",
        mk.clean_markup(_field(part, "title")).alias("title"),
        mk.clean_markup(_field(part, "link")).alias("url"),
    )


def search_items(
    feeds: DataFrame, keep: Sequence[str] = ("feed_pos",), news: int = fixed.NEWS_PER_SEARCH
) -> DataFrame:
    """Trend feeds to searches with traffic and their first news pairs."""
    rows = _items(feeds, keep, "item")
    part = F.col("part")
    every = lambda name: F.regexp_extract_all(part, F.lit(fixed.FEED_FIELD.format(f"ht:{name}")), F.lit(1))
    rows = rows.filter(_has(part, "title")).select(
        *keep,
        "pos",
        mk.clean_markup(_field(part, "title")).alias("title"),
        mk.clean_markup(_first(part, fixed.FEED_TRAFFIC)).alias("traffic"),
        every("news_item_title").alias("_titles"),
        every("news_item_url").alias("_urls"),
    )
    # A pair needs both a title and an address, so the shorter list decides.
    rows = rows.withColumn("_n", F.least(F.size("_titles"), F.size("_urls"), F.lit(news)))
    pairs = []
    for i in range(news):
        pair = F.struct(
            mk.clean_markup(F.get("_titles", F.lit(i))).alias("title"),
            mk.clean_markup(F.get("_urls", F.lit(i))).alias("url"),
        )
        pairs.append(F.when(F.col("_n") > i, pair))
    return rows.withColumn("news", F.array_compact(F.array(*pairs))).drop("_titles", "_urls", "_n")


def product_items(
    feeds: DataFrame, keep: Sequence[str] = ("feed_pos",), chars: int = fixed.TAGLINE_CHARS
) -> DataFrame:
    """Product feeds to name, address and tagline."""
    rows = _items(feeds, keep, "entry")
    part = F.col("part")
    content = _first(part, fixed.FEED_CONTENT)
    rows = rows.filter(_has(part, "title")).select(
        *keep,
        "pos",
        mk.clean_markup(_field(part, "title")).alias("name"),
        _first(part, fixed.FEED_LINK).alias("url"),
        mk.unescape(content).alias("_content"),
    )
    paragraph = fixed.FEED_PARAGRAPH
    text = F.when(mk.found(F.col("_content"), paragraph), _first(F.col("_content"), paragraph)).otherwise(
        F.col("_content")
    )
    return rows.withColumn("tagline", F.left(mk.clean_markup(text), F.lit(chars))).drop("_content")
