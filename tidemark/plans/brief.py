"""Registered queries over pages and feeds built from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import markup as mk
from tidemark.functions.text import escape_markup
from tidemark.operators import brief as br
from tidemark.operators import keyed, pages
from tidemark.plans import inputs
from tidemark.plans.inputs import table
from tidemark.sources.workdir import new_dir

LAST_DAY = "2024-12-31"
N_DAYS = 20
TOPICS_PER_DAY = 55
TOPIC_URL = "https://topics.example/topic?id=%s"
PER_PAGE = 20
PROMPT_INTRO = "Signals of the day:"
PROMPT_OUTRO = "Five insights, one per line."
PROMPT_LABELS = {
    "reads": "Headlines", "searches": "Search trends", "segments": "Interest by segment", "products": "New products",
}
_NAV = r'<li><a href="([^"]*)">([^<]*)</a></li>'


def _day(number):
    return F.date_sub(F.lit(LAST_DAY).cast("date"), (number % N_DAYS).cast("int"))


def _topic_day(number):
    """Newest topics first: a day has 55 of them, so pages of twenty overlap two days."""
    return F.date_sub(F.lit(LAST_DAY).cast("date"), F.floor(number / TOPICS_PER_DAY).cast("int"))


def _joined(rows, page, position, name):
    """Pages of a bounded number of blocks, in order."""
    grouped = rows.groupBy(page.alias("page_id")).agg(
        F.array_sort(F.collect_list(F.struct(position.alias("at"), "block"))).alias("blocks")
    )
    body = F.array_join(F.col("blocks.block"), "\n")
    return grouped.select("page_id", F.concat(F.lit("<html><body>"), body, F.lit("<footer>end</footer></body></html>")).alias(name))


# --- pages ------------------------------------------------------------------

def _topic_pages(spark, sf_dir):
    """Forum pages of twenty topics: every labelled document is a topic."""
    docs = inputs.documents(spark, sf_dir).select("source_id", "title")
    labels = table(spark, sf_dir, "labels").join(docs, F.col("doc_id") == F.col("source_id"))
    text = lambda c: c.cast("string")
    block = F.concat(
        F.lit('<div class="topic_row" data-topic-state-id="'), text(F.col("doc_id")),
        F.lit('"><div class="topictitle"><a href="https://t.example/?a=1&amp;id='), text(F.col("doc_id")),
        F.lit('"><h2 class="topic-title-heading"> <b>'), escape_markup(F.col("title")),
        F.lit('</b> </h2></a></div><div class="topicinfo"><div><span id="tp'), text(F.col("doc_id")),
        F.lit('">'), text(F.col("quality") * 50 + F.col("doc_id") % 37),
        F.lit('</span></div><time data-date="'), text(_topic_day(F.col("doc_id"))),
        F.lit('">then</time><a data-topic-comment-count="'), text(F.col("doc_id") % 13),
        F.lit('">talk</a></div><div class="topicdesc"><a href="#">about <i>'), text(F.col("doc_id")),
        F.lit("</i></a></div></div>"),
    )
    rows = labels.select("doc_id", block.alias("block"))
    return _joined(rows, F.floor(F.col("doc_id") / PER_PAGE).cast("bigint"), F.col("doc_id"), "html")


def _topics(spark, sf_dir):
    return pages.topic_rows(_topic_pages(spark, sf_dir), TOPIC_URL)


def page_topics(spark, sf_dir):
    rows = _topics(spark, sf_dir)
    return rows.select("id", "title", "url", "topic_url", "points", "comments", "date", F.col("desc").alias("about"))


def topics_of_day(spark, sf_dir):
    """Topics of one day; page numbers run back from the newest page."""
    numbered = lambda df: df.withColumn("page", F.col("page_id") + 1)
    source = _topic_pages(spark, sf_dir)
    rows = br.topics_of_day(
        numbered(pages.topic_rows(source, TOPIC_URL)), numbered(source), "2024-12-25", max_pages=None
    )
    return rows.select("id", "page", "date")


def top_topics(spark, sf_dir):
    """Best topics of every day."""
    rows = br.top_topics(_topics(spark, sf_dir), ["page_id", "pos"], by=["date"])
    return rows.select("date", "rank", "id", "title", "points")


def top_topics_overall(spark, sf_dir):
    rows = br.top_topics(_topics(spark, sf_dir), ["page_id", "pos"])
    return rows.select("rank", "id", "points")


def _repo_pages(spark, sf_dir):
    """Trending pages of 25 parts each, stars from the price."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    block = F.concat(
        F.lit('<article class="Box-row wide"><h2><a href="/'),
        F.lower(F.replace("p_brand", F.lit("#"), F.lit("-"))), F.lit("/"), key.cast("string"),
        F.lit('">repo</a></h2><p class="col"> '), escape_markup(F.col("p_name")),
        F.lit(' </p><span itemprop="programmingLanguage">'), F.col("p_type"),
        F.lit("</span><span>77 stars</span><span> "),
        F.format_number(F.floor(F.col("p_retailprice") * (key % 7)), 0),
        F.lit(" stars today</span></article>"),
    )
    rows = part.select("p_partkey", block.alias("block"))
    return _joined(rows, F.floor(key / 25).cast("bigint"), key, "html")


def _repos(spark, sf_dir):
    return pages.repo_rows(_repo_pages(spark, sf_dir))


def page_repos(spark, sf_dir):
    return _repos(spark, sf_dir).select("repo", "url", "description", "language", "stars_today")


def top_repos(spark, sf_dir):
    rows = br.top_repos(_repos(spark, sf_dir), ["page_id", "pos"])
    return rows.select("rank", "repo", "stars_today")


def repo_content(spark, sf_dir):
    """Short descriptions are replaced by the first usable readme."""
    repos = _repos(spark, sf_dir).select("repo", "description")
    key = F.split_part("repo", F.lit("/"), F.lit(2)).cast("bigint")
    spread = repos.select("repo", key.alias("k")).withColumn(
        "branch", F.explode(F.lit(["master", "main"]))
    ).withColumn("name", F.explode(F.lit(["README.rst", "README.md", "readme.md"])))
    kept = F.when(F.pmod(F.col("k") + F.length("name") + F.length("branch"), F.lit(3)) == 0, F.lit("  "))
    text = F.coalesce(kept, F.concat_ws(" ", "branch", "name", "repo"))
    readmes = pages.first_readme(spread.withColumn("text", text))
    return pages.repo_content(repos, readmes)


def clean_markup(spark, sf_dir):
    rows = table(spark, sf_dir, "pages")
    return rows.select("page_id", mk.clean_markup(F.col("html")).alias("text"))


def page_body(spark, sf_dir):
    html = F.replace("html", F.lit("<article>"), F.lit('<article id="contents">'))
    rows = table(spark, sf_dir, "pages").withColumn("html", html)
    return pages.page_body(rows, fallback=F.col("url"))


# --- feeds ------------------------------------------------------------------

def _links(spark, sf_dir):
    """Navigation links of every page: addresses and labels."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("feed_pos"),
        "url",
        F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract_all("html", F.lit(_NAV), F.lit(1)).alias("hrefs"),
        F.regexp_extract_all("html", F.lit(_NAV), F.lit(2)).alias("labels"),
    )


def _feeds(spark, sf_dir):
    item = lambda label, href: F.concat(
        F.lit("<item>\n<title><![CDATA["), label, F.lit("]]></title>"),
        F.when(href != "/The", F.concat(F.lit("<link> "), href, F.lit("</link>"))).otherwise(""),
        F.lit("</item>"),
    )
    xml = F.concat(
        F.lit("<rss><channel><title>feed</title>"),
        F.array_join(F.zip_with("labels", "hrefs", item), "\n"),
        F.lit("</channel></rss>"),
    )
    return _links(spark, sf_dir).select("feed_pos", F.col("url").alias("source"), xml.alias("xml"))


def feed_items(spark, sf_dir):
    return pages.feed_items(_feeds(spark, sf_dir)).select("feed_pos", "pos", "title", "url")


def _searches(spark, sf_dir):
    title = lambda t: F.concat(F.lit("<ht:news_item_title>"), t, F.lit("</ht:news_item_title>"))
    address = lambda u: F.concat(F.lit("<ht:news_item_url>"), u, F.lit("</ht:news_item_url>"))
    n_urls = (F.col("feed_pos") % 4).cast("int")
    xml = F.concat(
        F.lit("<rss><item><title>"), F.col("title"), F.lit("</title><ht:approx_traffic>"),
        F.col("feed_pos").cast("string"), F.lit("+</ht:approx_traffic>"),
        F.array_join(F.transform("labels", title), ""),
        F.array_join(F.transform(F.slice("hrefs", F.lit(1), n_urls), address), ""),
        F.lit("</item></rss>"),
    )
    return pages.search_items(_links(spark, sf_dir).select("feed_pos", xml.alias("xml")))


def search_items(spark, sf_dir):
    pair = lambda n: F.concat(n["title"], F.lit("="), n["url"])
    return _searches(spark, sf_dir).select(
        "feed_pos", "title", "traffic", F.array_join(F.transform("news", pair), "|").alias("news")
    )


def _products(spark, sf_dir):
    words = F.array_join("labels", " ")
    content = escape_markup(
        F.concat(F.lit("<p>"), F.repeat(F.concat(words, F.lit(" ")), F.lit(8)), F.lit("</p><p>more</p>"))
    )
    plain = escape_markup(F.concat(words, F.lit(" <b>and more</b>")))
    xml = F.concat(
        F.lit("<feed><entry><title>"), F.col("title"),
        F.lit('</title><link rel="alternate" type="text/html" href="'), F.col("url"),
        F.lit('"/><content type="html">'), F.when(F.col("feed_pos") % 2 == 0, content).otherwise(plain),
        F.lit("</content></entry></feed>"),
    )
    return pages.product_items(_links(spark, sf_dir).select("feed_pos", xml.alias("xml")))


def product_items(spark, sf_dir):
    return _products(spark, sf_dir).select("feed_pos", "name", "url", "tagline")


def first_reads(spark, sf_dir):
    rows = pages.feed_items(_feeds(spark, sf_dir))
    return br.first_n(rows, ["feed_pos", "pos"], br.fixed.TOP_READS).select("rank", "title", "url")


# --- trends -----------------------------------------------------------------

def _series(spark, sf_dir):
    """Orders per week, market segment and priority."""
    owners = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    week = F.floor(F.datediff(F.col("o_orderdate"), F.lit("1990-01-01")) / 7).cast("bigint")
    return (
        table(spark, sf_dir, "orders")
        .join(owners, "o_custkey")
        .groupBy(
            F.col("c_mktsegment").alias("segment"),
            F.col("o_orderpriority").alias("name"),
            week.alias("period"),
        )
        .agg(F.count("*").cast("double").alias("ratio"))
    )


def _changes(spark, sf_dir):
    return br.momentum(_series(spark, sf_dir))


def trend_momentum(spark, sf_dir):
    return _changes(spark, sf_dir)


def trend_ranking(spark, sf_dir):
    return br.ranked_names(_changes(spark, sf_dir)).select("segment", "rank", "name", "pct")


def trend_movers(spark, sf_dir):
    rows = br.movers(_changes(spark, sf_dir))
    return rows.select("segment", "name", "pct", "dir")


# --- days -------------------------------------------------------------------

def _builders(spark, sf_dir):
    def topics():
        rows = _topics(spark, sf_dir).withColumn("run_date", F.col("date").cast("date"))
        best = br.top_topics(rows, ["page_id", "pos"], by=["run_date"])
        return best.withColumn("summary", F.col("desc"))

    def repos():
        rows = _repos(spark, sf_dir).withColumn("run_date", _day(F.col("page_id")))
        best = br.top_repos(rows, ["page_id", "pos"], by=["run_date"])
        return best.withColumn("summary", F.col("description"))

    def per_day(rows, n):
        dated = rows.withColumn("run_date", _day(F.col("feed_pos")))
        return br.first_n(dated, ["feed_pos", "pos"], n, by=["run_date"])

    def segments():
        rows = br.segment_items(_changes(spark, sf_dir)).withColumn(
            "run_date", F.lit(LAST_DAY).cast("date")
        )
        return br.first_n(rows, ["segment"], None, by=["run_date"])

    return {
        "topics": topics,
        "repos": repos,
        "reads": lambda: per_day(pages.feed_items(_feeds(spark, sf_dir)), br.fixed.TOP_READS),
        "searches": lambda: per_day(_searches(spark, sf_dir), br.fixed.TOP_SEARCHES),
        "products": lambda: per_day(_products(spark, sf_dir), br.fixed.TOP_PRODUCTS),
        "segments": segments,
    }


def _days(spark, sf_dir):
    """Daily rows of all days that have an entry in some section or a labelled document."""
    sections, errors = br.isolate(_builders(spark, sf_dir))
    days = table(spark, sf_dir, "labels").select(_topic_day(F.col("doc_id")).cast("date").alias("run_date"))
    for rows in sections.values():
        days = days.unionByName(rows.select("run_date"))
    days = days.distinct()
    days = days.withColumn("topics_date", F.date_sub("run_date", 1))
    return br.assemble(days, sections, errors)


def daily_brief(spark, sf_dir):
    rows = _days(spark, sf_dir)
    ids = lambda name, field: F.array_join(
        F.transform(name, lambda e: e[field].cast("string")), ","
    ).alias(name)
    items = F.array_join(
        F.transform(
            "segments",
            lambda s: F.concat(
                s["segment"], F.lit(":"),
                F.array_join(F.transform(s["items"], lambda i: F.concat(i["name"], F.lit(" "), i["pct"].cast("string"))), ","),
            ),
        ),
        ";",
    ).alias("segments")
    return rows.select(
        F.date_format("run_date", "yyyy-MM-dd").alias("run_date"),
        F.date_format("topics_date", "yyyy-MM-dd").alias("topics_date"),
        ids("topics", "points"), ids("repos", "repo"), ids("reads", "url"), ids("searches", "traffic"),
        ids("products", "url"), items, "status", "error",
    )


def latest_brief(spark, sf_dir):
    rows = br.latest_day(_days(spark, sf_dir))
    return rows.select(F.date_format("run_date", "yyyy-MM-dd").alias("run_date"), F.size("repos").alias("n_repos"))


def recent_brief_dates(spark, sf_dir):
    return br.recent_dates(_days(spark, sf_dir)).select(F.date_format("run_date", "yyyy-MM-dd").alias("run_date"))


def brief_upsert(spark, sf_dir):
    """Order days written one row each, then the days of shipping written over them."""
    path = new_dir(spark, "days")
    first = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("run_date")).agg(
        F.count("*").alias("n"), F.lit("orders").alias("ideas")
    )
    second = table(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("run_date")).agg(
        F.count("*").alias("n"), F.lit("lines").alias("ideas")
    )
    for rows in (first, second):
        br.upsert_days(rows, path)
    return spark.read.parquet(path).select(F.col("run_date").cast("string").alias("day"), "n", "ideas")


def brief_schema_change(spark, sf_dir):
    """Order days without the later columns, lines with them; defaults fill the gaps."""
    old = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit("orders").alias("origin"))
    new = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.lit("lines").alias("origin"), F.col("l_returnflag").alias("ideas")
    )
    rows = keyed.with_new_columns(old, new, {"ideas": F.lit("-")})
    return rows.groupBy("origin", "ideas").agg(F.count("*").alias("n"))


def brief_prompt(spark, sf_dir):
    rows = br.prompt_sections(_days(spark, sf_dir))
    return rows.select(F.date_format("run_date", "yyyy-MM-dd").alias("run_date"), "reads", "searches", "segments", "products")


def brief_prompt_text(spark, sf_dir):
    """The assembled prompt of every day."""
    rows = br.prompt_text(br.prompt_sections(_days(spark, sf_dir)), PROMPT_LABELS, PROMPT_INTRO, PROMPT_OUTRO)
    return rows.select(F.date_format("run_date", "yyyy-MM-dd").alias("run_date"), "prompt")


def _blocks(spark, sf_dir):
    return br.with_blocks(_days(spark, sf_dir), "Daily brief")


def brief_blocks(spark, sf_dir):
    rows = _blocks(spark, sf_dir)
    return rows.select(
        F.date_format("run_date", "yyyy-MM-dd").alias("run_date"),
        "head",
        F.size("blocks").cast("bigint").alias("n_blocks"),
        F.get("blocks", F.lit(0)).alias("first_block"),
    )


def brief_messages(spark, sf_dir):
    rows = br.messages(_blocks(spark, sf_dir))
    return rows.select(F.date_format("run_date", "yyyy-MM-dd").alias("run_date"), "position", "message")


def document_messages(spark, sf_dir):
    """Every document as message texts: its lines are the blocks."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", F.lit("Document").alias("head"), F.split("text", "\n").alias("blocks"))
    return br.messages(rows, "doc_id").select("doc_id", "position", "message")


QUERIES = {
    f.__name__: f
    for f in (
        page_topics, topics_of_day, top_topics, top_topics_overall, page_repos, top_repos,
        repo_content, clean_markup, page_body, feed_items, first_reads, search_items,
        product_items, trend_momentum, trend_ranking, trend_movers, daily_brief, latest_brief,
        recent_brief_dates, brief_upsert, brief_schema_change, brief_prompt, brief_prompt_text, brief_blocks,
        brief_messages, document_messages,
    )
}
