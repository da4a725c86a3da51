"""Daily brief: rankings, trend momentum, one row per day, message texts."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.text import escape_markup
from tidemark.operators import keyed, ordered
from tidemark.sources.workdir import saved, shared_dir

# --- rankings ---------------------------------------------------------------


def first_n(
    rows: DataFrame, order: Sequence[Column | str], n: int | None, by: Sequence[str] = ()
) -> DataFrame:
    """First n rows, or first n of every group, with ``rank`` from 1; all of a group when n is None.

    Without groups the cut comes first and only n rows are numbered. With
    groups Spark applies the limit in every task before the shuffle.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    if by:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        ranked = rows.withColumn("rank", place)
        return ranked if n is None else ranked.filter(F.col("rank") <= n)
    best = rows.orderBy(*order).limit(n)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def without_titles(rows: DataFrame, words: Sequence[str] = fixed.TITLE_EXCLUDES) -> DataFrame:
    return rows.filter(~reduce(or_, (F.contains("title", F.lit(w)) for w in words)))


def topics_of_day(
    topics: DataFrame, pages: DataFrame, day: str, max_pages: int | None = fixed.MAX_PAGES
) -> DataFrame:
    """Topics dated ``day`` on pages sorted from new to old.

    Paging ends with the first page that is empty or reaches back before the
    day, and after ``max_pages`` unless that is None. ``page`` counts from 1.
    """
    reach = topics.groupBy("page").agg(F.min("date").alias("oldest"), F.count("*").alias("n"))
    ends = pages.select("page").join(reach, "page", "left").filter(
        F.col("n").isNull() | (F.col("oldest") < day)
    )
    last = ends.agg(F.min("page")).scalar()
    within = F.lit(True) if max_pages is None else F.col("page") <= max_pages
    return topics.filter((F.col("date") == day) & within & (last.isNull() | (F.col("page") <= last)))


def top_topics(
    topics: DataFrame, position: Sequence[str], n: int = fixed.TOP_N, by: Sequence[str] = ()
) -> DataFrame:
    return first_n(without_titles(topics), [F.desc("points"), *position], n, by)


def top_repos(
    repos: DataFrame, position: Sequence[str], n: int = fixed.TOP_N, by: Sequence[str] = ()
) -> DataFrame:
    return first_n(repos, [F.desc("stars_today"), *position], n, by)


# --- trends -----------------------------------------------------------------

def momentum(
    series: DataFrame,
    min_points: int = fixed.SERIES_MIN_POINTS,
    side: int = fixed.SERIES_SIDE_POINTS,
    threshold: int = fixed.MOMENTUM_PCT,
) -> DataFrame:
    """Change per (segment, name): mean of the last points against the first, in percent.

    The newest point is dropped as unfinished. A series holds one point per
    week, so its window is bounded by the calendar, not by the raw data.
    """
    keys = ["segment", "name"]
    by_time = Window.partitionBy(*keys).orderBy("period")
    placed = series.select(*keys, "period", "ratio").withColumns(
        {
            "at": F.row_number().over(by_time),
            "n": F.count("*").over(Window.partitionBy(*keys)) - 1,
        }
    )
    used = placed.filter((F.col("at") <= F.col("n")) & (F.col("n") >= min_points))
    early, late = F.col("at") <= side, F.col("at") > F.col("n") - side
    means = used.groupBy(*keys).agg(
        F.avg(F.when(late, F.col("ratio"))).alias("recent"),
        F.avg(F.when(early, F.col("ratio"))).alias("earlier"),
    )
    change = F.bround((F.col("recent") - F.col("earlier")) / F.nullif("earlier", F.lit(0.0)) * 100, 0)
    pct = F.coalesce(change, F.lit(0.0)).cast("int")
    direction = (
        F.when(F.col("pct") > threshold, "up").when(F.col("pct") < -threshold, "down").otherwise("flat")
    )
    return means.select(*keys, pct.alias("pct")).withColumn("dir", direction)


def ranked_names(changes: DataFrame) -> DataFrame:
    """Names by percent, largest first, inside each segment."""
    return ordered.with_ranks(changes, ["segment"], [F.desc("pct"), F.asc("name")], "rank")


def movers(
    changes: DataFrame, up: int = fixed.MOVERS_UP, down: int = fixed.MOVERS_DOWN
) -> DataFrame:
    """Strongest risers, then strongest fallers of each segment, largest percent first.

    Two limited rankings, which Spark cuts in every task before the shuffle.
    """
    rising = Window.partitionBy("segment").orderBy(F.desc("pct"), "name")
    falling = Window.partitionBy("segment").orderBy(F.asc("pct"), F.desc("name"))
    ups = changes.filter(F.col("dir") == "up").withColumn("at", F.row_number().over(rising))
    downs = changes.filter(F.col("dir") == "down").withColumn("at", F.row_number().over(falling))
    return ups.filter(F.col("at") <= up).unionByName(
        downs.filter(F.col("at") <= down).withColumn("at", F.lit(up + down + 1) - F.col("at"))
    )


# --- one row per day --------------------------------------------------------

SECTIONS = {
    "topics": {
        "rank": "INT", "title": "STRING", "url": "STRING", "topic_url": "STRING",
        "points": "INT", "comments": "INT", "summary": "STRING",
    },
    "repos": {
        "rank": "INT", "repo": "STRING", "url": "STRING", "language": "STRING",
        "stars_today": "INT", "summary": "STRING",
    },
    "reads": {"source": "STRING", "title": "STRING", "url": "STRING"},
    "searches": {
        "title": "STRING", "traffic": "STRING",
        "news": "ARRAY<STRUCT<title: STRING, url: STRING>>",
    },
    "products": {"rank": "INT", "name": "STRING", "url": "STRING", "tagline": "STRING"},
    "segments": {
        "segment": "STRING", "items": "ARRAY<STRUCT<name: STRING, pct: INT, dir: STRING>>",
    },
}


def _section_type(name: str) -> str:
    fields = ", ".join(f"{field}: {kind}" for field, kind in SECTIONS[name].items())
    return f"ARRAY<STRUCT<{fields}>>"


def segment_items(changes: DataFrame) -> DataFrame:
    """One row per segment with its names; a segment has a short configured list of them."""
    entry = F.struct((-F.col("pct")).alias("order"), "name", "pct", "dir")
    rows = changes.groupBy("segment").agg(F.array_sort(F.collect_list(entry)).alias("_items"))
    item = lambda i: F.struct(i["name"].alias("name"), i["pct"].alias("pct"), i["dir"].alias("dir"))
    return rows.select("segment", F.transform("_items", item).alias("items"))


def isolate(
    builders: Mapping[str, Callable[[], DataFrame]]
) -> tuple[dict[str, DataFrame], list[str]]:
    """Run every section on its own: a failing one becomes an error, the others stay.

    Each result is written to the shared folder, so an error shows up here
    and not when the day is put together. Only what the data or the builder
    gets wrong is isolated. A missing folder, a full disk or a lost executor is
    a fault of the cluster and stops the run.
    """
    sections, errors = {}, []
    if builders:
        shared_dir(SparkSession.active())
    for name, build in builders.items():
        try:
            sections[name] = saved(build(), f"section-{name}")
        except Py4JError:
            raise
        except Exception as error:  # noqa: BLE001
            if isinstance(error, PySparkException) and _of_cluster(error):
                raise
            errors.append(f"{name}: {str(error).splitlines()[0]}")
    return sections, errors


def _of_cluster(error: PySparkException) -> bool:
    """Whether a Spark error names no condition of the data or the plan."""
    condition = error.getCondition() or ""
    return condition.startswith(("TASK_WRITE_FAILED", "_LEGACY_ERROR_TEMP")) or (
        not condition and not re.search(r"\[[A-Z_.]+\]", str(error))
    )


def assemble(
    days: DataFrame, sections: Mapping[str, DataFrame], errors: Sequence[str] = (), ideas: DataFrame | None = None
) -> DataFrame:
    """Rows of the daily table: ``days`` (run_date, topics_date) with one list per section.

    A section has ``run_date``, its fields and ``rank``, and is already cut to
    a few rows per day, which is what bounds the lists.
    """
    out = days
    for name, fields in SECTIONS.items():
        kind = _section_type(name)
        if name not in sections:
            out = out.withColumn(name, F.array().cast(kind))
            continue
        entry = F.struct(F.col("rank").alias("_at"), *fields)
        plain = lambda e: F.struct(*[e[f].alias(f) for f in fields])
        lists = sections[name].groupBy("run_date").agg(F.array_sort(F.collect_list(entry)).alias("_list"))
        lists = lists.select("run_date", F.transform("_list", plain).cast(kind).alias(name))
        out = out.join(lists, "run_date", "left").withColumn(
            name, F.coalesce(F.col(name), F.array().cast(kind))
        )
    if ideas is None:
        out = out.withColumn("ideas", F.lit(""))
    else:
        out = out.join(ideas, "run_date", "left").withColumn("ideas", F.coalesce("ideas", F.lit("")))
    filled = reduce(or_, (F.size(name) > 0 for name in SECTIONS))
    return out.withColumns(
        {
            "status": F.when(filled, "ok").otherwise("failed"),
            "error": F.lit(" | ".join(errors) or None).cast("string"),
        }
    )


def save_day(day: DataFrame, path: str) -> None:
    """Write a day's row over the same day's partition; other days stay."""
    (
        day.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .parquet(path)
    )


def upsert_days(days: DataFrame, path: str) -> None:
    """Write rows of ``run_date`` over the same days of a table kept in folders of a month.

    Only the months that the rows fall into are rewritten; their other days stay.
    """
    month = F.date_format("run_date", "yyyy-MM")
    rows = saved(days.withColumn("month", month), "days")
    spark = days.sparkSession
    try:
        stored = spark.read.schema(rows.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = rows.limit(0)
    touched = stored.join(rows.select("month").distinct(), "month", "left_semi").select(*rows.columns)
    # The table is read and overwritten, so what stays is set down first.
    merged = saved(keyed.upsert(touched, rows, ["run_date", "month"]), "days")
    (
        merged.repartition("month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(path)
    )


def latest_day(days: DataFrame) -> DataFrame:
    return days.orderBy(F.desc("run_date")).limit(1)


def day_of(days: DataFrame, run_date: str) -> DataFrame:
    return days.filter(F.col("run_date") == F.lit(run_date).cast("date"))


def recent_dates(days: DataFrame, n: int = fixed.RECENT_DATES) -> DataFrame:
    return days.select("run_date").orderBy(F.desc("run_date")).limit(n)


# --- texts ------------------------------------------------------------------

def _signed(pct: Column) -> Column:
    sign = F.when(pct >= 0, F.lit("+")).otherwise("")
    return F.concat(sign, pct.cast("string"), F.lit("%"))


def _lines(items: Column, line: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(items, line), "\n")


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def prompt_sections(days: DataFrame) -> DataFrame:
    """The lists that go into a prompt, cut and rendered, with a mark for empty ones."""
    first = lambda name, n: F.slice(name, 1, n)
    reads = _lines(
        first("reads", fixed.PROMPT_READS),
        lambda r: F.concat(F.lit("- ["), r["source"], F.lit("] "), r["title"]),
    )
    searches = _lines(
        first("searches", fixed.PROMPT_SEARCHES),
        lambda s: F.concat(F.lit("- "), s["title"], F.lit(" ("), _text(s["traffic"]), F.lit(")")),
    )
    names = lambda s: F.array_join(
        F.transform(F.slice(s["items"], 1, fixed.PROMPT_NAMES), lambda i: F.concat(i["name"], _signed(i["pct"]))),
        ", ",
    )
    segments = F.array_join(
        F.transform("segments", lambda s: F.concat(F.lit("- ["), s["segment"], F.lit("] "), names(s), F.lit("\n"))),
        "",
    )
    products = _lines(
        first("products", fixed.PROMPT_PRODUCTS),
        lambda p: F.concat(F.lit("- "), p["name"], F.lit(": "), _text(p["tagline"])),
    )
    filled = lambda text: F.when(text == "", F.lit(fixed.PROMPT_EMPTY)).otherwise(text)
    return days.select(
        "run_date",
        filled(reads).alias("reads"),
        searches.alias("searches"),
        filled(segments).alias("segments"),
        products.alias("products"),
    )


def prompt_text(sections: DataFrame, labels: Mapping[str, str], intro: str, outro: str) -> DataFrame:
    """One prompt per day: intro, labelled sections, outro."""
    parts = [F.concat(F.lit(f"[{label}]\n"), F.col(name)) for name, label in labels.items()]
    return sections.select(
        "run_date", F.concat_ws("\n\n", F.lit(intro), *parts, F.lit(outro)).alias("prompt")
    )


def _link(url: Column, text: Column) -> Column:
    return F.concat(F.lit('<a href="'), escape_markup(url), F.lit('">'), escape_markup(text), F.lit("</a>"))


def _numbered(rank: Column) -> Column:
    return F.concat(F.lit("<b>"), rank.cast("string"), F.lit(".</b> "))


def _summary(text: Column) -> Column:
    shown = F.concat(F.lit("\n<i>"), escape_markup(text), F.lit("</i>"))
    return F.when(_text(text) != "", shown).otherwise("")


def _movers_line(items: Column) -> Column:
    falls = F.filter(items, lambda i: i["dir"] == "down")
    start = F.greatest(F.size(falls) - (fixed.MOVERS_DOWN - 1), F.lit(1))
    picked = F.concat(
        F.slice(F.filter(items, lambda i: i["dir"] == "up"), 1, fixed.MOVERS_UP),
        F.slice(falls, start, F.lit(fixed.MOVERS_DOWN)),
    )
    arrow = lambda d: F.when(d == "up", "▲").when(d == "down", "▼").otherwise("→")
    chip = lambda i: F.concat(arrow(i["dir"]), escape_markup(i["name"]), F.lit(" "), _signed(i["pct"]))
    return F.array_join(F.transform(picked, chip), "  ")


def with_blocks(
    days: DataFrame, title: str, headings: Mapping[str, str] = fixed.HEADINGS
) -> DataFrame:
    """Add ``head`` and ``blocks``: one text per section that has content, in fixed order."""

    def listed(name: str, line: Callable[[Column], Column]) -> Column:
        body = F.concat(F.lit(headings[name] + "\n"), _lines(F.col(name), line))
        return F.when(F.size(name) > 0, body)

    ideas = F.concat(F.lit(headings["ideas"] + "\n"), escape_markup(F.col("ideas")))
    blocks = [
        F.when(_text(F.col("ideas")) != "", ideas),
        listed(
            "reads",
            lambda r: F.concat(
                F.lit("• "), _link(r["url"], r["title"]), F.lit(" <i>"), escape_markup(r["source"]), F.lit("</i>")
            ),
        ),
        listed(
            "segments",
            lambda s: F.concat(F.lit("<b>"), escape_markup(s["segment"]), F.lit("</b>\n"), _movers_line(s["items"])),
        ),
        listed(
            "searches",
            lambda s: F.concat(
                F.lit("• "),
                escape_markup(s["title"]),
                F.when(
                    _text(s["traffic"]) != "",
                    F.concat(F.lit(" <i>("), escape_markup(s["traffic"]), F.lit(")</i>")),
                ).otherwise(""),
            ),
        ),
        listed(
            "products",
            lambda p: F.concat(
                _numbered(p["rank"]),
                _link(p["url"], p["name"]),
                F.when(
                    _text(p["tagline"]) != "", F.concat(F.lit(" — "), escape_markup(p["tagline"]))
                ).otherwise(""),
            ),
        ),
        listed(
            "topics",
            lambda t: F.concat(
                _numbered(t["rank"]), _link(t["url"], t["title"]),
                F.lit("  👍"), t["points"].cast("string"), _summary(t["summary"]),
            ),
        ),
        listed(
            "repos",
            lambda r: F.concat(
                _numbered(r["rank"]), _link(r["url"], r["repo"]),
                F.lit("  ⭐+"), r["stars_today"].cast("string"), _summary(r["summary"]),
            ),
        ),
    ]
    head = F.concat(F.lit(f"🌅 <b>{title} "), F.date_format("run_date", "yyyy-MM-dd"), F.lit("</b>"))
    return days.withColumns({"head": head, "blocks": F.array_compact(F.array(*blocks))})


def packed(head: Column, blocks: Column, limit: int = fixed.MESSAGE_CHARS) -> Column:
    """Blocks joined by blank lines into messages; a block that does not fit opens a new one."""
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("done"), head.alias("open"))

    def add(state: Column, block: Column) -> Column:
        full = F.length(state["open"]) + F.length(block) + 2 > limit
        flushed = F.struct(F.array_append(state["done"], state["open"]).alias("done"), block.alias("open"))
        joined = F.struct(
            state["done"].alias("done"), F.concat(state["open"], F.lit("\n\n"), block).alias("open")
        )
        return F.when(full, flushed).otherwise(joined)

    return F.aggregate(blocks, start, add, lambda s: F.array_append(s["done"], s["open"]))


def _fitting_piece(limit: int) -> str:
    """Pattern of the next piece: all that is left, up to the last line end, or a hard cut."""
    return rf"(?s)(.{{1,{limit}}}\z|.{{1,{limit - 1}}}(?=\n)|.{{{limit}}})\n*"


def messages(blocks: DataFrame, key: str = "run_date", limit: int = fixed.MESSAGE_CHARS) -> DataFrame:
    """Message texts per day in sending order: (key, position, message)."""
    texts = packed(F.col("head"), F.col("blocks"), limit)
    pattern = F.lit(_fitting_piece(limit))
    pieces = F.flatten(F.transform(texts, lambda t: F.regexp_extract_all(t, pattern, F.lit(1))))
    rows = blocks.select(key, F.posexplode_outer(pieces).alias("position", "message"))
    return rows.filter(F.col("message").isNotNull())
