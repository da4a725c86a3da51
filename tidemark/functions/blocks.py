"""Message content (a string, or an array of blocks) to plain text, on VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed


def _field(value: Column, name: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, f"$.{name}", kind)


def _or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _plain(value: Column) -> Column:
    """Text of a variant: strings as they are, anything else as JSON."""
    return _or_empty(F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value)))


def _part_text(part: Column) -> Column:
    """Text of one part of a result list: the ``text`` of an object, any other value as it is."""
    is_object = F.startswith(F.to_json(part), F.lit("{"))
    return F.when(is_object, _or_empty(_field(part, "text"))).otherwise(_plain(part))


def _result_text(block: Column) -> Column:
    content = _field(block, "content", "variant")
    items = _field(block, "content", "array<variant>")
    return (
        F.when(items.isNotNull(), F.array_join(F.transform(items, _part_text), " "))
        .when(content.isNotNull(), _plain(content))
        .otherwise("")
    )


def _block_text(block: Column) -> Column:
    kind = _field(block, "type")
    arguments = F.coalesce(F.to_json(_field(block, "input", "variant")), F.lit("{}"))
    return (
        F.when(kind == "text", _or_empty(_field(block, "text")))
        .when(
            kind == "tool_use",
            F.concat(
                F.lit("[tool: "),
                _or_empty(_field(block, "name")),
                F.lit("("),
                F.left(arguments, F.lit(fixed.TOOL_ARGS_CHARS)),
                F.lit(")]"),
            ),
        )
        .when(
            kind == "tool_result",
            F.concat(
                F.lit("[tool-result: "),
                F.left(_result_text(block), F.lit(fixed.TOOL_RESULT_CHARS)),
                F.lit("]"),
            ),
        )
        .otherwise("")
    )


def flatten_content(content: Column) -> Column:
    """Plain text of a content value; blocks are joined by newlines, empty ones dropped."""
    blocks = content.try_cast("array<variant>")
    texts = F.filter(F.transform(blocks, _block_text), lambda t: t != "")
    # Only strings and arrays carry text; numbers and objects do not.
    is_string = F.schema_of_variant(content) == "STRING"
    return (
        F.when(blocks.isNotNull(), F.array_join(texts, "\n"))
        .when(is_string, F.try_variant_get(content, "$", "string"))
        .otherwise("")
    )
