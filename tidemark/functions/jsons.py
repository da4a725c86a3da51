"""Guarded access to loosely typed JSON, on VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed

_STRINGS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def text_field(value: Column, name: str, chars: int) -> Column:
    """A field as text, cut to ``chars``; missing and null give ''."""
    found = F.try_variant_get(value, f"$.{name}", "string")
    return F.left(F.coalesce(found, F.lit("")), F.lit(chars))


def truthy_field(value: Column, name: str) -> Column:
    """A field as text, or NULL when it is missing, null, '', 0 or false."""
    raw = F.try_variant_get(value, f"$.{name}", "variant")
    found = F.try_variant_get(value, f"$.{name}", "string")
    number = F.try_variant_get(value, f"$.{name}", "double")
    is_text = F.startswith(F.to_json(raw), F.lit('"'))
    empty = F.when(is_text, found == "").otherwise((found == "false") | (number == 0))
    return F.when(F.coalesce(empty, F.lit(False)), F.lit(None)).otherwise(found)


def rendered_length(json: Column) -> Column:
    """Length of JSON text when written with ``, `` and ``: `` and ASCII escapes.

    Characters outside ASCII count as 6, those beyond the basic plane as 12.
    """
    frame = F.regexp_replace(json, _STRINGS, "")
    separators = F.length(frame) - F.length(F.translate(frame, ",:", ""))
    wide = F.regexp_count(json, F.lit(r"[^\x00-\x7f]"))
    astral = F.regexp_count(json, F.lit(r"[\x{10000}-\x{10ffff}]"))
    return F.length(json) + separators + 5 * wide + 6 * astral


def guarded_object(json: Column, chars: int = fixed.JSON_CHARS) -> Column:
    """JSON text of an object; ``{}`` for anything else and for oversized objects."""
    is_object = F.startswith(json, F.lit("{"))
    # Text that is already too long as it stands is never searched for strings.
    fits = F.when(F.length(json) > chars, False).otherwise(rendered_length(json) <= chars)
    return F.when(is_object & fits, json).otherwise("{}")
