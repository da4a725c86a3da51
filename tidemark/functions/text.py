"""Column expressions for text: strip, titles, turn rendering, redaction, words."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed

# The characters that str.strip() removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_LINE_END = r"\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029"
_FIRST_LINE = rf"\A[^{_LINE_END}]*"
_NOT_WORD = r"[^\p{L}\p{N}_]+"
SECRETS = "|".join(pattern for _, pattern in fixed.SECRET_PATTERNS)
_LONG_HEX = dict(fixed.SECRET_PATTERNS)["hex"]


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any script."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def first_line(text: Column) -> Column:
    """First line of the stripped text; '' when there is none."""
    return F.regexp_extract(strip(text), _FIRST_LINE, 0)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def document_title(text: Column, fallback: Column, chars: int = fixed.TITLE_CHARS) -> Column:
    """First non-blank line with a leading ``# `` removed, else the fallback."""
    line = strip(first_line(text))
    bare = F.when(line.startswith("# "), strip(F.substr(line, F.lit(3)))).otherwise(line)
    return F.when(line != "", F.left(bare, F.lit(chars))).otherwise(fallback)


def note_title(given: Column, content: Column, chars: int = fixed.TITLE_CHARS) -> Column:
    """The given title, else the first line of the content."""
    return F.coalesce(blank_to_null(given), F.left(first_line(content), F.lit(chars)))


def render_turn(user: Column, assistant: Column) -> Column:
    """``User: …`` and ``Assistant: …`` paragraphs; an empty side is left out."""
    return F.concat_ws(
        "\n\n",
        F.when(user != "", F.concat(F.lit("User: "), user)),
        F.when(assistant != "", F.concat(F.lit("Assistant: "), assistant)),
    )


def redact(text: Column, marker: str = fixed.REDACTED) -> Column:
    """Replace every secret-shaped run in one pass.

    Every shape but the bare hex run starts with a fixed mark, and looking for
    the marks is far cheaper than trying all shapes at every position. Texts
    without a mark are searched for hex runs only.
    """
    marked = reduce(or_, (F.contains(text, F.lit(mark)) for mark in fixed.SECRET_MARKS))
    return F.when(marked, F.regexp_replace(text, SECRETS, marker)).otherwise(
        F.regexp_replace(text, _LONG_HEX, marker)
    )


def redaction_hits(text: Column, redacted: Column) -> Column:
    """Number of replaced runs; texts that redaction left alone are not scanned again."""
    count = F.regexp_count(text, F.lit(SECRETS))
    return F.when(redacted != text, count).otherwise(F.lit(0)).cast("bigint")


def words(text: Column) -> Column:
    """Lower-cased words in text order; no stemming, no stop words."""
    return F.filter(F.split(F.lower(text), _NOT_WORD), lambda w: w != "")


def preview_title(title: Column, chars: int = fixed.PREVIEW_TITLE_CHARS) -> Column:
    return F.left(F.coalesce(title, F.lit("")), F.lit(chars))


def preview_text(text: Column, chars: int = fixed.PREVIEW_TEXT_CHARS) -> Column:
    return F.replace(F.left(F.coalesce(text, F.lit("")), F.lit(chars)), F.lit("\n"), F.lit(" "))


def escape_markup(text: Column) -> Column:
    """Escape ``& < >`` for message markup; NULL becomes ''."""
    out = F.coalesce(text, F.lit(""))
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return out
