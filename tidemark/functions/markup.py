"""Column expressions for HTML and feed fragments."""

from __future__ import annotations

import html
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark import fixed
from tidemark.functions.text import strip

_HIDDEN = r"(?is)<!--.*?-->|<(script|style|template)\b.*?</\1\s*>"


@F.pandas_udf(StringType())
def _html_unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def unescape(text: Column) -> Column:
    """Replace all HTML entities. Texts without ``&`` never leave the JVM."""
    return F.coalesce(_html_unescape(F.when(F.contains(text, F.lit("&")), text)), text)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bare_text(text: Column) -> Column:
    """Unwrap CDATA and drop tags; entities stay."""
    unwrapped = F.regexp_replace(text, fixed.CDATA, "$1")
    return F.regexp_replace(unwrapped, fixed.TAG, "")


def clean_markup(text: Column) -> Column:
    """Text of a feed field: CDATA, tags and entities resolved, trimmed."""
    return strip(unescape(bare_text(F.coalesce(text, F.lit("")))))


def node_text(fragment: Column, separator: str = "") -> Column:
    """Visible strings of a fragment, each trimmed, empty ones dropped; entities stay."""
    visible = F.regexp_replace(fragment, _HIDDEN, "")
    strings = F.transform(F.split(visible, r"<[^>]*>"), strip)
    return F.array_join(F.filter(strings, lambda s: s != ""), separator)


def attribute(attributes: Column, name: str) -> Column:
    """Value of an attribute inside a tag; NULL when absent or empty."""
    value = F.regexp_extract(attributes, rf"""(?i)(?<![\w-]){name}\s*=\s*["']([^"']*)["']""", 1)
    return F.nullif(value, F.lit(""))


def found(text: Column, pattern: str) -> Column:
    return F.regexp_extract(text, pattern, 0) != ""


def with_class(tag: str, name: str) -> str:
    """Pattern of an open tag with a class."""
    return rf"""<{tag}\b[^>]*\bclass\s*=\s*["'][^"']*(?<![\w-]){name}(?![\w-])[^"']*["'][^>]*>"""


def element_body(text: Column, opening: str, tag: Column) -> Column:
    """Content of the first element that ``opening`` matches, up to its own end tag.

    Nested elements of the same tag are counted; an element that never closes
    reaches to the end of the text.
    """
    rest = F.regexp_extract(text, rf"(?is){opening}(.*)\z", 1)
    opens = F.concat(F.lit(r"(?i)\A<"), tag, F.lit(r"[\s>]"))
    closes = F.concat(F.lit(r"(?i)\A</"), tag)

    def step(state: Column, part: Column) -> Column:
        depth = (
            state["depth"]
            + F.when(F.rlike(part, closes), -1).when(F.rlike(part, opens), 1).otherwise(0)
        )
        n = state["n"] + F.when(depth > 0, 1).otherwise(0)
        moved = F.struct(depth.alias("depth"), n.alias("n"))
        return F.when(state["depth"] == 0, state).otherwise(moved)

    def cut(parts: Column) -> Column:
        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n"))
        n = F.aggregate(parts, start, step)["n"]
        return F.array_join(F.slice(parts, F.lit(1), n), "")

    pieces = F.split(rest, F.concat(F.lit("(?i)(?=</?"), tag, F.lit(r"[\s>])")))
    return let(pieces, cut)
