import html
import random

from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import markup as mk
from tidemark.operators import brief as br
from tidemark.operators import pages


def test_unescape_matches_python(spark):
    values = ["a &amp;lt; b", "&#8217;&hellip;&middot;&nbsp;x", "&copy2024 &notit; &bogus;", "plain", None, "&#x27;&quot;"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(mk.unescape(F.col("s"))).collect()]
    assert got == [None if v is None else html.unescape(v) for v in values]


def test_clean_markup(spark):
    values = {"<![CDATA[ <b>A</b> &amp; B ]]>": "A & B", "  x ": "x", None: "", "<![CDATA[a]]><![CDATA[b\nc]]>": "ab\nc"}
    df = spark.createDataFrame([(v,) for v in values], "s string")
    assert [r[0] for r in df.select(mk.clean_markup(F.col("s"))).collect()] == list(values.values())


TOPICS = """<html><div class="topic_row x" data-topic-state-id="11"><div><div class='topictitle'>
<a href="https://a/?x=1&amp;y=2"><h2 class="big topic-title-heading"> One <b>bold</b> &amp; more </h2></a></div></div>
<span id="tp11"> 42 </span><time data-date="2024-05-01">x</time>
<div class="topicdesc"><a href="#">about <i>it</i></a></div><a data-topic-comment-count="7">c</a></div>
<div class="topic_row" data-topic-state-id="12"><div class="topictitle"><a>no heading</a></div></div>
<div class="topic_row"><div class="topictitle"><a href="u"><h2 class="topic-title-heading">no id</h2></a></div></div>
<div class="topic_row" data-topic-state-id="13"><div class="topictitle"><a href="u"><h2 class="topic-title-heading">Bare</h2></a></div>
<span id="tp13">many</span><a data-topic-comment-count="">c</a></div>
<div class="topic_row_old" data-topic-state-id="14"></div>
<footer><time data-date="1999-01-01">outside</time></footer></html>"""


def test_topic_rows(spark):
    df = spark.createDataFrame([(1, TOPICS), (2, "<html></html>"), (3, None)], "page_id int, html string")
    rows = pages.topic_rows(df, "https://t/%s").orderBy("pos").collect()
    one, two = rows
    assert one.asDict() == {
        "page_id": 1, "pos": 1, "id": "11", "title": "Onebold& more", "url": "https://a/?x=1&y=2",
        "topic_url": "https://t/11", "points": 42, "comments": 7, "date": "2024-05-01", "desc": "aboutit",
    }
    assert (two.id, two.points, two.comments, two.date, two.desc) == ("13", 0, 0, None, "")


def test_repo_rows(spark):
    page = """<article class="Box-row"><h2 class="h"><a href="/o/r/">o / r</a></h2><p class="c"> Does <b>x</b> </p>
    <span itemprop="programmingLanguage">Python</span><span>9 stars</span><span><svg></svg> 1,234 stars today </span></article>
    <article class="other"><h2><a href="/no/no">no</a></h2></article>
    <article class="a Box-row"><h2>no link</h2></article>
    <article class="Box-row"><h2><a href="/p/q">p</a></h2></article>"""
    df = spark.createDataFrame([(1, page)], "page_id int, html string")
    rows = [tuple(r)[2:] for r in pages.repo_rows(df).orderBy("pos").collect()]
    assert rows == [
        ("o/r", "https://github.com/o/r", "Doesx", "Python", 1234),
        ("p/q", "https://github.com/p/q", "", "", 0),
    ]


def test_page_body(spark):
    inner = "<div>first <script>var x = '</div>';</script></div> <!-- no --> second &amp; " + "word " * 600
    good = f'<div id="other">no</div><section class="c" id="contents">{inner}<section>in</section></section><p>after</p>'
    short = '<div id="contents">too short</div>'
    cases = [(1, good, "f1"), (2, short, "f2"), (3, "<p>none</p>", "f3"), (4, None, "f4")]
    df = spark.createDataFrame(cases, "page_id int, html string, fb string")
    got = {r.page_id: r.body for r in pages.page_body(df, fallback=F.col("fb")).collect()}
    want = ("first second & " + "word " * 600)[:2400]
    assert got == {1: want, 2: "f2", 3: "f3", 4: "f4"}


def test_readme(spark):
    rows = [("r", "main", "README.md", "  "), ("r", "master", "README.md", "M" * 3000), ("r", "main", "README.rst", "rst"),
            ("s", "master", "readme.md", None)]
    readmes = pages.first_readme(spark.createDataFrame(rows, "repo string, branch string, name string, text string"))
    assert [tuple(r) for r in readmes.collect()] == [("r", "rst")]
    repos = spark.createDataFrame([("r", "short"), ("s", "short"), ("t", ""), ("u", "l" * 30)], "repo string, description string")
    got = {r.repo: r.content for r in pages.repo_content(repos, readmes).collect()}
    assert got == {"r": "rst", "s": "short", "t": "t", "u": "l" * 30}


def test_feeds(spark):
    item = lambda i: f"<item><title><![CDATA[T{i}]]></title>{'' if i == 1 else f'<link>u{i}</link>'}</item>"
    xml = "<rss><title>feed</title>" + "".join(map(item, range(6))) + "</rss>"
    df = spark.createDataFrame([(0, "s", xml), (1, "t", None)], "feed_pos int, source string, xml string")
    assert [r.title for r in pages.feed_items(df).orderBy("pos").collect()] == ["T0", "T2", "T3"]


def test_searches_pair_to_the_shorter_side(spark):
    news = lambda n, tag: "".join(f"<ht:news_item_{tag}>{tag}{i}&amp;</ht:news_item_{tag}>" for i in range(n))
    xml = "<item><title>A</title><ht:approx_traffic>5+</ht:approx_traffic>" + news(3, "title") + news(1, "url") + "</item>"
    xml += "<item><title>B</title>" + news(3, "title") + news(3, "url") + "</item><item>none</item>"
    df = spark.createDataFrame([(0, xml)], "feed_pos int, xml string")
    rows = pages.search_items(df).orderBy("pos").collect()
    assert [(r.title, r.traffic, [tuple(n) for n in r.news]) for r in rows] == [
        ("A", "5+", [("title0&", "url0&")]),
        ("B", "", [("title0&", "url0&"), ("title1&", "url1&")]),
    ]


def test_products(spark):
    xml = """<entry><title>P</title><link rel="alternate" type="t" href="https://p"/><content type="html">&lt;p&gt;Say &amp;amp; do&lt;/p&gt;&lt;p&gt;x&lt;/p&gt;</content></entry>
    <entry><title>Q</title><content>plain</content></entry><entry>no title</entry>"""
    df = spark.createDataFrame([(0, xml)], "feed_pos int, xml string")
    rows = [(r.name, r.url, r.tagline) for r in pages.product_items(df).orderBy("pos").collect()]
    assert rows == [("P", "https://p", "Say & do"), ("Q", "", "plain")]


def topics(spark, rows):
    return spark.createDataFrame(rows, "page int, date string, title string, points int, id int")


def test_topics_of_day(spark):
    numbers = spark.createDataFrame([(p,) for p in range(1, 8)], "page int")
    rows = [(1, "2024-05-03", "a", 1, 1), (1, None, "b", 1, 2), (2, "2024-05-02", "c", 1, 3), (2, "2024-05-03", "c", 1, 4),
            (3, "2024-05-02", "d", 1, 5), (3, "2024-05-01", "e", 1, 6), (4, "2024-05-02", "late", 1, 7)]
    found = lambda day, **kw: sorted(r.id for r in br.topics_of_day(topics(spark, rows), numbers, day, **kw).collect())
    assert found("2024-05-02") == [3, 5]
    assert found("2024-05-01") == [6]
    assert found("2024-05-02", max_pages=2) == [3]
    gap = [r for r in rows if r[0] != 2]
    assert [r.id for r in br.topics_of_day(topics(spark, gap), numbers, "2024-05-02").collect()] == []


def test_top_topics(spark):
    rows = [(1, "d", "x 할인", 99, 1), (1, "d", "b", 5, 2), (1, "d", "c", 7, 3), (2, "e", "d", 5, 4), (2, "e", "출시 기념", 50, 5)]
    best = br.top_topics(topics(spark, rows), ["id"], n=2)
    assert [(r.rank, r.id) for r in best.orderBy("rank").collect()] == [(1, 3), (2, 2)]
    daily = br.top_topics(topics(spark, rows), ["id"], n=1, by=["date"])
    assert sorted((r.date, r.id) for r in daily.collect()) == [("d", 3), ("e", 4)]


def plain_momentum(ratios):
    used = ratios[:-1]
    if len(used) < 6:
        return None
    recent, earlier = sum(used[-3:]) / 3, sum(used[:3]) / 3
    pct = round((recent - earlier) / earlier * 100) if earlier else 0
    return pct, "up" if pct > 12 else "down" if pct < -12 else "flat"


def test_momentum(spark):
    rng = random.Random(6)
    series = {f"s{i}": [float(rng.randrange(0, 9)) for _ in range(rng.randrange(4, 14))] for i in range(40)}
    series["zero"] = [0.0] * 3 + [5.0] * 6
    series["half"] = [8.0, 8.0, 8.0, 9.0, 9.0, 9.0, 1.0]
    series["edge"] = [100.0] * 3 + [112.0] * 4
    rows = [("g", name, i, v) for name, values in series.items() for i, v in enumerate(values)]
    rng.shuffle(rows)
    got = br.momentum(spark.createDataFrame(rows, "segment string, name string, period int, ratio double"))
    want = {n: plain_momentum(v) for n, v in series.items() if plain_momentum(v)}
    assert {r.name: (r.pct, r.dir) for r in got.collect()} == want


def change(name, pct):
    return ("g", name, pct, "up" if pct > 12 else "down" if pct < -12 else "flat")


def test_movers(spark):
    rows = [change(n, p) for n, p in [("a", 50), ("b", 20), ("c", 90), ("d", 13), ("e", 0), ("f", -20), ("h", -50), ("i", -30)]]
    df = spark.createDataFrame(rows, "segment string, name string, pct int, dir string")
    assert [r.name for r in br.movers(df).orderBy("at").collect()] == ["c", "a", "b", "i", "h"]
    items = br.segment_items(df).first().items
    assert [i.name for i in items] == ["c", "a", "b", "d", "e", "f", "i", "h"]


def sections(spark):
    day = F.lit("2024-05-02").cast("date")
    frame = lambda rows, schema: lambda: spark.createDataFrame(rows, schema).withColumn("run_date", day)
    seg = spark.createDataFrame([change("up<", 50), change("dn", -20)], "segment string, name string, pct int, dir string")
    return {
        "topics": frame([(1, "T&1", "u", "tu", 9, 2, "sum"), (2, "T2", "u2", "t2", 8, 0, "")],
                        "rank int, title string, url string, topic_url string, points int, comments int, summary string"),
        "reads": frame([(1, "src", "R", "ru")], "rank int, source string, title string, url string"),
        "searches": frame([(1, "S", "5+", None), (2, "S2", "", None)],
                          "rank int, title string, traffic string, news array<struct<title:string,url:string>>"),
        "products": frame([(1, "P", "pu", "tag"), (2, "P2", "pu2", "")], "rank int, name string, url string, tagline string"),
        "segments": lambda: br.segment_items(seg).withColumns({"rank": F.lit(1), "run_date": day}),
    }


def days(spark, *dates):
    df = spark.createDataFrame([(d,) for d in dates], "d string")
    return df.select(F.col("d").cast("date").alias("run_date"), F.date_sub(F.col("d").cast("date"), 1).alias("topics_date"))


def test_sections_fail_alone(spark):
    def broken():
        return spark.range(1).select(F.raise_error(F.lit("no luck")).alias("x"))

    built, errors = br.isolate({**sections(spark), "repos": broken})
    assert "repos" not in built and len(errors) == 1 and errors[0].startswith("repos: ")
    rows = br.assemble(days(spark, "2024-05-02", "2024-05-03"), built, [*errors, "x: y"]).orderBy("run_date").collect()
    full, empty = rows
    assert (full.status, empty.status) == ("ok", "failed")
    assert full.error.endswith(" | x: y")
    assert [t.title for t in full.topics] == ["T&1", "T2"] and full.repos == [] and empty.topics == []


def test_blocks_and_prompt(spark):
    built, _ = br.isolate(sections(spark))
    ideas = spark.createDataFrame([("i<1",)], "ideas string").withColumn("run_date", F.lit("2024-05-02").cast("date"))
    table = br.assemble(days(spark, "2024-05-02"), built, ideas=ideas)
    row = br.with_blocks(table, "Daily").first()
    assert row.head == "🌅 <b>Daily 2024-05-02</b>" and row.error is None
    h = fixed.HEADINGS
    assert row.blocks == [
        h["ideas"] + "\ni&lt;1",
        h["reads"] + '\n• <a href="ru">R</a> <i>src</i>',
        h["segments"] + "\n<b>g</b>\n▲up&lt; +50%  ▼dn -20%",
        h["searches"] + "\n• S <i>(5+)</i>\n• S2",
        h["products"] + '\n<b>1.</b> <a href="pu">P</a> — tag\n<b>2.</b> <a href="pu2">P2</a>',
        h["topics"] + '\n<b>1.</b> <a href="u">T&amp;1</a>  👍9\n<i>sum</i>\n<b>2.</b> <a href="u2">T2</a>  👍8',
    ]
    prompt = br.prompt_sections(table).first()
    assert prompt.reads == "- [src] R" and prompt.searches == "- S (5+)\n- S2 ()"
    assert prompt.segments == "- [g] up<+50%, dn-20%\n" and prompt.products == "- P: tag\n- P2: "
    empty = br.prompt_sections(br.assemble(days(spark, "2024-05-02"), {})).first()
    assert (empty.reads, empty.searches, empty.segments) == ("(없음)", "", "(없음)")
    text = br.prompt_text(br.prompt_sections(table), {"reads": "Reads"}, "in", "out").first().prompt
    assert text == "in\n\n[Reads]\n- [src] R\n\nout"


# Worked by hand: head, blocks, and the messages of at most twenty characters.
MESSAGES = [
    ("head", [], ["head"]),
    ("head", ["one", "two"], ["head\n\none\n\ntwo"]),
    ("head", ["0123456789", "abcdef"], ["head\n\n0123456789", "abcdef"]),
    ("head", ["0123456789abcd"], ["head\n\n0123456789abcd"]),
    ("head", ["0123456789abcde"], ["head", "0123456789abcde"]),
    ("head", ["line one is here\nline two"], ["head", "line one is here", "line two"]),
    ("head", ["x" * 45], ["head", "x" * 20, "x" * 20, "x" * 5]),
    ("head", ["", "b"], ["head\n\n\n\nb"]),
    ("head", ["😀" * 21], ["head", "😀" * 20, "😀"]),
]


def packed(spark, cases):
    df = spark.createDataFrame([(i, h, b) for i, (h, b, *_) in enumerate(cases)], "run_date int, head string, blocks array<string>")
    rows = sorted(br.messages(df, limit=20).collect(), key=lambda r: (r.run_date, r.position))
    return [[r.message for r in rows if r.run_date == i] for i in range(len(cases))]


def test_messages_worked_by_hand(spark):
    assert packed(spark, MESSAGES) == [messages for *_, messages in MESSAGES]


def test_messages_hold_everything_and_are_full(spark):
    rng = random.Random(8)
    cases = []
    for _ in range(60):
        blocks = ["".join(rng.choice("abc😀") for _ in range(rng.choice([1, 3, 10, 19, 20]))) for _ in range(rng.randrange(6))]
        cases.append(("head", blocks))
    for (head, blocks), messages in zip(cases, packed(spark, cases)):
        assert all(0 < len(m) <= 20 for m in messages)
        # Blocks that fit a message are never cut, and none is lost.
        assert [part for m in messages for part in m.split("\n\n")] == [head, *blocks]
        # The next message's first block would not have fitted.
        assert all(len(a) + 2 + len(b.split("\n\n")[0]) > 20 for a, b in zip(messages, messages[1:]))


def test_saved_days(spark, tmp_path):
    path = str(tmp_path / "days")
    one = br.assemble(days(spark, "2024-05-01", "2024-05-02"), {})
    br.save_day(one, path)
    br.save_day(br.assemble(days(spark, "2024-05-02"), {}, ["again"]), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 2
    assert br.latest_day(stored).first().error == "again"
    assert br.day_of(stored, "2024-05-01").first().error is None
    assert [str(r[0]) for r in br.recent_dates(stored, 1).collect()] == ["2024-05-02"]
