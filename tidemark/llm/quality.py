"""Quality rules with thresholds that follow each language and source.

A document is measured in one pass over its words and lines. Every measure is
an integer on a fixed grid, and the documents of a (language, source) are
summarised by how many of them fall on each grid point. Such a summary is a
quantile sketch that merges by addition, in any order and with the same
result, has a bounded number of points, and errs by less than one grid step.
The steps are even up to a last even point and grow by ``GROWTH`` beyond it, so
that no measure is cut off.
The thresholds are read off the sketches and joined back to the documents.

Defined results: a missing text is an empty one; an empty text has no words
and fails the base rules. Missing languages or sources form a group of their
own. Repeated rows count and are judged each. Groups of fewer than
``min_docs`` documents are judged by the merged sketch of their language, and
languages of fewer by that of all documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import rows
from tidemark.sources import workdir

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_DOCS = 100
# Measure -> (last even grid point, least distance of the fence from the middle half).
GRID = {
    "symbols": (2000, 100),  # symbols per 1000 words
    "lines": (1000, 300),  # repeated lines per 1000 lines
    "repeats": (1000, 200),  # words in repeated windows per 1000 words
    "length": (5000, 400),  # hundredths of a character per word
}
FENCE = 4
GROWTH = 1.02
HOT = 1000  # groups with over one in this many of all documents are broadcast: fewer than this


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """Words covered by a window of ``size`` words that occurs twice or more in the text.

    Windows are compared by a 64-bit hash. Documents without a repeated one
    are done after one hash set; the others sort their windows.
    """
    count = F.size(words)
    hashes = F.when(
        count >= size,
        F.transform(
            F.slice(words, 1, count - (size - 1)),
            lambda word, i: F.xxhash64(word, *[F.get(words, i + k) for k in range(1, size)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(places: Column) -> Column:
        reach = F.transform(places, lambda p, j: F.least(F.get(places, j + 1) - p, F.lit(size)))
        return F.aggregate(reach, F.lit(0), lambda total, n: total + n)

    def repeated(marked: Column) -> Column:
        same = F.filter(
            marked,
            lambda w, j: (w["h"] == F.get(marked, j - 1)["h"]) | (w["h"] == F.get(marked, j + 1)["h"]),
        )
        return rows.let(F.sort_array(F.transform(same, lambda w: w["i"])), covered)

    def count_of(found: Column) -> Column:
        marked = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(
            rows.let(marked, repeated)
        )

    return rows.let(hashes, count_of)


def measure(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", keep: Column | None = None) -> DataFrame:
    """One row per document: ``doc`` (the kept columns, all by default), its group and its measures."""
    whole = rows.text_of(text)
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select(
        (rows.packed(docs) if keep is None else keep).alias("doc"),
        F.coalesce(F.col(lang), F.lit("")).alias("lang"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
        F.regexp_count(whole, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        rows.let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("lines"),
        rows.let(
            rows.words_of(whole),
            lambda x: F.struct(
                F.size(x).alias("n"), F.length(F.concat_ws("", x)).alias("c"), repeated_words(x).alias("r")
            ),
        ).alias("words"),
    )
    return base.select(
        "doc",
        "lang",
        "source",
        F.col("words.n").cast("long").alias("n_words"),
        F.col("words.c").cast("long").alias("word_chars"),
        "n_symbols",
        F.col("lines.n").cast("long").alias("n_lines"),
        (F.col("lines.n") - F.col("lines.d")).cast("long").alias("n_dup_lines"),
        F.col("words.r").cast("long").alias("n_repeat_words"),
    )


def base_failed(min_words: int = MIN_WORDS, max_percent: int = MAX_REPEAT_PERCENT) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_percent * F.col("n_words"))


def _grid() -> dict[str, Column]:
    """Each measure on its grid; only for documents with words."""

    def per(n: str, of: str, unit: int, last: int) -> Column:
        value = F.expr(f"({n} * {unit}) div greatest({of}, 1)")
        steps = F.floor(F.log(value / last) / math.log(GROWTH))
        return F.when(value <= last, value).otherwise(F.floor(last * F.pow(F.lit(GROWTH), steps)))

    out = {}
    for name, n, of, unit in (
        ("symbols", "n_symbols", "n_words", 1000),
        ("lines", "n_dup_lines", "n_lines", 1000),
        ("repeats", "n_repeat_words", "n_words", 1000),
        ("length", "word_chars", "n_words", 100),
    ):
        out[name] = per(n, of, unit, GRID[name][0])
    return out


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, point, docs): mergeable by summing ``docs``.

    Documents that fail the base rules don't shape the thresholds.
    """
    points = F.explode(
        F.array(*[F.struct(F.lit(name).alias("measure"), at.alias("point")) for name, at in _grid().items()])
    )
    return (
        measured.filter(~base_failed())
        .select("lang", "source", points.alias("p"))
        .groupBy("lang", "source", "p.measure", "p.point")
        .agg(F.count("*").alias("docs"))
    )


def _fences(merged: DataFrame, keys: list[str]) -> DataFrame:
    """Quartiles of each sketch, and the fences beyond them: one row per group.

    A window holds one sketch: as many rows as the grid has points at most.
    """
    order = Window.partitionBy(*keys, "measure").orderBy("point")
    whole = Window.partitionBy(*keys, "measure")
    at = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("total"), F.col("point")))
    quartiles = (
        merged.withColumns({"upto": F.sum("docs").over(order), "total": F.sum("docs").over(whole)})
        .groupBy(*keys, "measure")
        .agg(F.max("total").alias("total"), at(1).alias("q1"), at(3).alias("q3"))
    )
    slack = F.create_map(*[F.lit(x) for name, (_, least) in GRID.items() for x in (name, least)])
    reach = F.greatest(FENCE * (F.col("q3") - F.col("q1")), slack[F.col("measure")])
    fenced = quartiles.select(
        *keys, "measure", "total", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high")
    )
    pick = lambda name, side: F.max(F.when(F.col("measure") == name, F.col(side))).alias(f"{name}_{side}")
    return fenced.groupBy(*keys).agg(
        F.max("total").alias("docs"),
        *[pick(name, side) for name in GRID for side in ("low", "high")],
    )


def thresholds(sketches: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source) -> its fences, from its own sketch or a merged one of enough documents."""
    sides = [f"{name}_{side}" for name in GRID for side in ("low", "high")]
    sum_by = lambda *keys: sketches.groupBy(*keys, "measure", "point").agg(F.sum("docs").alias("docs"))
    own = _fences(sketches, ["lang", "source"])
    lang = _fences(sum_by("lang"), ["lang"]).select("lang", F.struct("docs", *sides).alias("of_lang"))
    everything = _fences(sum_by().withColumn("one", F.lit(1)), ["one"]).select(F.struct("docs", *sides).alias("of_all"), "one")
    joined = (
        own.withColumn("one", F.lit(1))
        .join(lang, "lang", "left")
        .join(F.broadcast(everything), "one", "left")  # one row
    )
    return joined.select(
        "lang",
        "source",
        *[
            F.when(F.col("docs") >= min_docs, F.col(side))
            .when(F.col("of_lang.docs") >= min_docs, F.col(f"of_lang.{side}"))
            .otherwise(F.col(f"of_all.{side}"))
            .alias(side)
            for side in sides
        ],
    )


def judged(measured: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The measured documents with ``base_failed`` and ``kept``.

    ``measured`` is read several times and should be a saved table. A group
    without thresholds has no document that passes the base rules.

    Groups with more than one in ``HOT`` of all documents are fewer than
    ``HOT``: their thresholds go to the documents. The other groups are small,
    and their documents meet their thresholds by the key.
    """
    keys = ["lang", "source"]
    sizes = measured.groupBy(*keys).agg(F.count("*").alias("docs"))
    total = sizes.agg(F.coalesce(F.sum("docs"), F.lit(0))).scalar()
    found = sizes.join(thresholds(sketch(measured), min_docs), keys, "left")
    limits = workdir.saved(found.withColumn("hot", F.col("docs") * HOT > total).drop("docs"), "limits")
    hot, cold = F.broadcast(limits.filter("hot")), limits.filter(~F.col("hot"))
    few = measured.join(hot.select(*keys), keys, "left_anti")
    return _verdicts(measured.join(hot, keys), measured.columns).unionByName(
        _verdicts(few.join(cold, keys), measured.columns)
    )


def _verdicts(with_limits: DataFrame, columns: list[str]) -> DataFrame:
    inside = F.lit(True)
    for name, at in _grid().items():
        inside = inside & (at <= F.col(f"{name}_high"))
    inside = inside & (_grid()["length"] >= F.col("length_low"))
    return with_limits.select(
        *columns,
        base_failed().alias("base_failed"),
        (~base_failed() & F.coalesce(inside, F.lit(False))).alias("kept"),
    )


def quality_filter(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that pass, with their own columns."""
    measured = workdir.saved(measure(docs, text, lang, source), "quality")
    return rows.unpacked(judged(measured).filter("kept"))
