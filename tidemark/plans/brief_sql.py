"""SQL counterparts of the queries in ``brief``."""

from __future__ import annotations

from tidemark.plans.brief import PROMPT_INTRO, PROMPT_LABELS, PROMPT_OUTRO
from tidemark.plans.knowledge_sql import SOURCES


def day(number: str) -> str:
    return f"(DATE '2024-12-31' - ({number} % 20)::INT)"


TOPIC_DAY = "(DATE '2024-12-31' - (doc_id // 55)::INT)"


def plain(text: str) -> str:
    """Entities that occur in the tables, resolved; these names need no semicolon in HTML."""
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{char}', 'g')"
    return text


def esc(text: str) -> str:
    return f"replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


TOPICS = f"""{SOURCES}, topics AS (
  SELECT doc_id::VARCHAR AS id, doc_id, trim(title) AS title, 'https://t.example/?a=1&id=' || doc_id AS url,
         'https://topics.example/topic?id=' || doc_id AS topic_url,
         (quality * 50 + doc_id % 37)::INT AS points, (doc_id % 13)::INT AS comments,
         strftime({TOPIC_DAY}, '%Y-%m-%d') AS date, 'about' || doc_id AS about, doc_id // 20 AS page_id
  FROM labels JOIN sources ON source_id = doc_id)"""
REPOS = """repos AS (
  SELECT lower(replace(p_brand, '#', '-')) || '/' || p_partkey AS repo, p_name AS description, p_type AS language,
         floor(p_retailprice * (p_partkey % 7))::INT AS stars_today, p_partkey, p_partkey // 25 AS page_id FROM part)"""
_NAV = '<li><a href="([^"]*)">([^<]*)</a></li>'
LINKS = f"""links AS (
  SELECT page_id AS feed_pos, url, regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
         regexp_extract_all(html, '{_NAV}', 1) AS hrefs, regexp_extract_all(html, '{_NAV}', 2) AS labels FROM pages)"""
ITEMS = f"""{LINKS}, items AS (
  SELECT feed_pos, pos, trim({plain("regexp_replace(labels[pos + 1], '<[^>]+>', '', 'g')")}) AS title,
         trim({plain('hrefs[pos + 1]')}) AS url, hrefs[pos + 1] AS href
  FROM (SELECT *, unnest(range(length(hrefs))) AS pos FROM links) WHERE pos < 4 AND hrefs[pos + 1] <> '/The')"""
SEARCHES = f"""searches AS (
  SELECT feed_pos, trim({plain("regexp_replace(title, '<[^>]+>', '', 'g')")}) AS title, feed_pos || '+' AS traffic,
         coalesce(array_to_string(list_transform(range(least(length(hrefs), feed_pos % 4, 2)),
           lambda i: trim({plain('labels[i + 1]')}) || '=' || trim({plain('hrefs[i + 1]')})), '|'), '') AS news FROM links)"""
PRODUCTS = f"""products AS (
  SELECT feed_pos, trim({plain("regexp_replace(title, '<[^>]+>', '', 'g')")}) AS name, url,
         left(trim({plain("CASE WHEN feed_pos % 2 = 0 THEN repeat(words || ' ', 8) ELSE words || ' and more' END")}), 200) AS tagline
  FROM (SELECT *, array_to_string(labels, ' ') AS words FROM links))"""
CHANGES = """series AS (
  SELECT c_mktsegment AS segment, o_orderpriority AS name,
         date_diff('day', DATE '1990-01-01', o_orderdate::DATE) // 7 AS period, count(*)::DOUBLE AS ratio
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY segment, name ORDER BY period) AS nth,
         count(*) OVER (PARTITION BY segment, name) - 1 AS n FROM series),
means AS (
  SELECT segment, name, avg(ratio) FILTER (nth > n - 3) AS recent, avg(ratio) FILTER (nth <= 3) AS earlier
  FROM placed WHERE nth <= n AND n >= 6 GROUP BY segment, name),
pcts AS (
  SELECT segment, name, CASE WHEN earlier = 0 THEN 0 ELSE round_even((recent - earlier) / earlier * 100, 0) END::INT AS pct
  FROM means),
changes AS (SELECT *, CASE WHEN pct > 12 THEN 'up' WHEN pct < -12 THEN 'down' ELSE 'flat' END AS dir FROM pcts)"""
_EXCLUDED = "NOT regexp_matches(title, '채용|구인|모집|후원|광고|이벤트|할인|프로모션|출시 기념')"
DAYS = f"""days AS (SELECT DISTINCT run_date FROM (
  SELECT {TOPIC_DAY} AS run_date FROM labels UNION ALL SELECT {day('(p_partkey // 25)')} FROM part
  UNION ALL SELECT {day('page_id')} FROM pages UNION ALL SELECT DATE '2024-12-31'))"""


def top_per_day(rows: str, date: str, order: str, n: int, name: str) -> str:
    return f"""{name} AS (SELECT *, {date} AS run_date FROM {rows}
      QUALIFY row_number() OVER (PARTITION BY {date} ORDER BY {order}) <= {n})"""


SECTIONS = f"""{TOPICS}, {REPOS}, {ITEMS}, {SEARCHES}, {PRODUCTS}, {CHANGES}, {DAYS},
{top_per_day(f'(SELECT * FROM topics WHERE {_EXCLUDED})', 'date', 'points DESC, doc_id', 5, 'day_topics')},
{top_per_day('repos', day('page_id'), 'stars_today DESC, p_partkey', 5, 'day_repos')},
{top_per_day('items', day('feed_pos'), 'feed_pos, pos', 6, 'day_reads')},
{top_per_day('searches', day('feed_pos'), 'feed_pos', 8, 'day_searches')},
{top_per_day('products', day('feed_pos'), 'feed_pos', 6, 'day_products')}"""


def listed(rows: str, value: str, order: str, sep: str = ",") -> str:
    same = "run_date = strftime(d.run_date, '%Y-%m-%d')" if rows == "day_topics" else "run_date = d.run_date"
    return f"coalesce((SELECT string_agg({value}, '{sep}' ORDER BY {order}) FROM {rows} WHERE {rows}.{same}), '')"


_SEGMENT_ROWS = """SELECT segment, string_agg(name || ' ' || pct, ',' ORDER BY pct DESC, name) AS items,
  string_agg(name || CASE WHEN pct >= 0 THEN '+' ELSE '' END || pct || '%', ', ' ORDER BY pct DESC, name)
    FILTER (place <= 5) AS first_five
  FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY pct DESC, name) AS place FROM changes) GROUP BY segment"""
_DATE = "strftime(d.run_date, '%Y-%m-%d') AS run_date"


def _joined_lines(rows: str, value: str, order: str) -> str:
    inner = listed(rows, value, order, "@@")
    return f"replace({inner}, '@@', chr(10))"


_READ_LINES = _joined_lines("day_reads", "'- [' || (SELECT url FROM pages WHERE page_id = feed_pos) || '] ' || title", "feed_pos, pos")
_ORACLE_BLOCK = _joined_lines(
    "day_reads",
    f"'• <a href=\"' || {esc('url')} || '\">' || {esc('title')} || '</a> <i>' || {esc('(SELECT p.url FROM pages p WHERE p.page_id = feed_pos)')} || '</i>'",
    "feed_pos, pos",
)

ORACLES = {
    "page_topics": f"WITH {TOPICS} SELECT id, title, url, topic_url, points, comments, date, about FROM topics",
    "topics_of_day": f"""WITH {TOPICS}, reach AS (SELECT page_id, min(date) AS oldest FROM topics GROUP BY 1),
        last AS (SELECT min(page_id) AS p FROM reach WHERE oldest < '2024-12-25')
        SELECT id, page_id + 1 AS page, date FROM topics, last
        WHERE date = '2024-12-25' AND page_id <= coalesce(p, page_id)""",
    "top_topics": f"""WITH {TOPICS} SELECT date, row_number() OVER (PARTITION BY date ORDER BY points DESC, doc_id)::INT AS rank,
        id, title, points FROM topics WHERE {_EXCLUDED}
        QUALIFY row_number() OVER (PARTITION BY date ORDER BY points DESC, doc_id) <= 5""",
    "top_topics_overall": f"""WITH {TOPICS} SELECT row_number() OVER (ORDER BY points DESC, doc_id)::INT AS rank, id, points
        FROM topics WHERE {_EXCLUDED} ORDER BY points DESC, doc_id LIMIT 5""",
    "page_repos": f"""WITH {REPOS} SELECT repo, 'https://github.com/' || repo AS url, description, language, stars_today
        FROM repos""",
    "top_repos": f"""WITH {REPOS} SELECT row_number() OVER (ORDER BY stars_today DESC, p_partkey)::INT AS rank, repo, stars_today
        FROM repos ORDER BY stars_today DESC, p_partkey LIMIT 5""",
    "repo_content": f"""WITH {REPOS}, tries AS (
          SELECT repo, branch, name, b * 10 + n AS place, (p_partkey + length(name) + length(branch)) % 3 = 0 AS is_blank
          FROM repos, (VALUES (1, 'main'), (2, 'master')) t(b, branch),
               (VALUES (1, 'README.md'), (2, 'readme.md'), (3, 'README.rst')) u(n, name)),
        best AS (SELECT repo, arg_min(branch || ' ' || name || ' ' || repo, place) AS readme FROM tries
                 WHERE NOT is_blank GROUP BY repo)
        SELECT repo, description, CASE WHEN length(description) < 30 THEN coalesce(readme, description) ELSE description END AS content
        FROM repos LEFT JOIN best USING (repo)""",
    "clean_markup": f"""SELECT page_id, trim({plain("regexp_replace(html, '<[^>]+>', '', 'g')")}) AS text FROM pages""",
    "page_body": f"""SELECT page_id, CASE WHEN length(line) > 40 THEN left(line, 2400) ELSE url END AS body FROM (
        SELECT page_id, url, regexp_replace({plain("array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]*>'), lambda s: trim(s, ' ' || chr(9) || chr(10) || chr(13))), lambda s: s <> ''), ' ')")}, '\\s+', ' ', 'g') AS line
        FROM pages)""",
    "feed_items": f"WITH {ITEMS} SELECT feed_pos, pos::INT AS pos, title, url FROM items",
    "first_reads": f"""WITH {ITEMS} SELECT row_number() OVER (ORDER BY feed_pos, pos)::INT AS rank, title, url
        FROM items ORDER BY feed_pos, pos LIMIT 6""",
    "search_items": f"WITH {LINKS}, {SEARCHES} SELECT feed_pos, title, traffic, news FROM searches",
    "product_items": f"WITH {LINKS}, {PRODUCTS} SELECT feed_pos, name, url, tagline FROM products",
    "trend_momentum": f"WITH {CHANGES} SELECT segment, name, pct, dir FROM changes",
    "trend_ranking": f"""WITH {CHANGES} SELECT segment, name, pct,
        row_number() OVER (PARTITION BY segment ORDER BY pct DESC, name)::INT AS rank FROM changes""",
    "trend_movers": f"""WITH {CHANGES} SELECT segment, name, pct, dir FROM (SELECT *,
          row_number() OVER (PARTITION BY segment, dir ORDER BY pct DESC, name) AS rising,
          row_number() OVER (PARTITION BY segment, dir ORDER BY pct, name DESC) AS falling FROM changes)
        WHERE (dir = 'up' AND rising <= 3) OR (dir = 'down' AND falling <= 2)""",
    "daily_brief": f"""WITH {SECTIONS}, per_segment AS ({_SEGMENT_ROWS})
        SELECT {_DATE}, strftime(d.run_date - 1, '%Y-%m-%d') AS topics_date,
          {listed('day_topics', 'points', 'points DESC, doc_id')} AS topics,
          {listed('day_repos', 'repo', 'stars_today DESC, p_partkey')} AS repos,
          {listed('day_reads', 'url', 'feed_pos, pos')} AS reads,
          {listed('day_searches', 'traffic', 'feed_pos')} AS searches,
          {listed('day_products', 'url', 'feed_pos')} AS products,
          CASE WHEN d.run_date = DATE '2024-12-31'
               THEN (SELECT string_agg(segment || ':' || items, ';' ORDER BY segment) FROM per_segment) ELSE '' END AS segments,
          'ok' AS status, NULL::VARCHAR AS error
        FROM days d""",
    "latest_brief": f"""WITH {REPOS}, {DAYS}, best AS (SELECT max(run_date) AS run_date FROM days)
        SELECT strftime(run_date, '%Y-%m-%d') AS run_date,
          least(5, (SELECT count(*) FROM repos WHERE {day('page_id')} = run_date))::INT AS n_repos FROM best""",
    "recent_brief_dates": f"""WITH {DAYS} SELECT strftime(run_date, '%Y-%m-%d') AS run_date FROM days
        ORDER BY run_date DESC LIMIT 30""",
    "brief_upsert": """WITH lines AS (SELECT l_shipdate::DATE AS d, count(*) AS n FROM lineitem GROUP BY 1),
        old AS (SELECT o_orderdate::DATE AS d, count(*) AS n FROM orders GROUP BY 1)
        SELECT d::VARCHAR AS day, n, 'lines' AS ideas FROM lines
        UNION ALL
        SELECT d::VARCHAR, n, 'orders' FROM old WHERE d NOT IN (SELECT d FROM lines)""",
    "brief_schema_change": """SELECT 'orders' AS origin, '-' AS ideas, count(*) AS n FROM orders
        UNION ALL SELECT 'lines', l_returnflag, count(*) FROM lineitem GROUP BY l_returnflag""",
    "brief_prompt": f"""WITH {SECTIONS}, per_segment AS ({_SEGMENT_ROWS}),
        lines AS (SELECT d.run_date AS that, {_DATE}, {_READ_LINES} AS reads,
          {_joined_lines('day_searches', "'- ' || title || ' (' || traffic || ')'", 'feed_pos')} AS searches,
          {_joined_lines('day_products', "'- ' || name || ': ' || tagline", 'feed_pos')} AS products FROM days d)
        SELECT run_date, CASE WHEN reads = '' THEN '(없음)' ELSE reads END AS reads, searches,
          CASE WHEN that = DATE '2024-12-31'
               THEN (SELECT string_agg('- [' || segment || '] ' || first_five || chr(10), '' ORDER BY segment) FROM per_segment)
               ELSE '(없음)' END AS segments, products FROM lines""",
}
_LABELLED = " || ".join(
    f"coalesce(chr(10) || chr(10) || '[{label}]' || chr(10) || {name}, '')" for name, label in PROMPT_LABELS.items()
)
ORACLES["brief_prompt_text"] = f"""SELECT run_date, '{PROMPT_INTRO}' || {_LABELLED}
    || chr(10) || chr(10) || '{PROMPT_OUTRO}' AS prompt FROM ({ORACLES['brief_prompt']})"""


def message_texts(start: str, key: str) -> str:
    """Pack and split the blocks of ``start`` (key, head, blocks) row by row."""
    nl = "chr(10)"
    return f"""WITH RECURSIVE packing AS (
      SELECT {key}, 0 AS i, head AS held, NULL::VARCHAR AS done, blocks FROM ({start})
      UNION ALL
      SELECT {key}, i + 1, CASE WHEN too_long THEN block ELSE held || {nl} || {nl} || block END,
             CASE WHEN too_long THEN held END, blocks
      FROM (SELECT *, blocks[i + 1] AS block, length(held) + length(blocks[i + 1]) + 2 > 3900 AS too_long
            FROM packing WHERE i < length(blocks))),
    texts AS (
      SELECT {key}, i AS m, done AS text FROM packing WHERE done IS NOT NULL
      UNION ALL SELECT {key}, i + 1, held FROM packing WHERE i = length(blocks)),
    splitting AS (
      SELECT {key}, m, 0 AS k, text AS rest, NULL::VARCHAR AS piece FROM texts
      UNION ALL
      SELECT {key}, m, k + 1, ltrim(substr(rest, cut + 1), {nl}), left(rest, cut)
      FROM (SELECT *, CASE WHEN length(rest) <= 3900 THEN length(rest) WHEN back BETWEEN 1 AND 3899 THEN 3900 - back
                           ELSE 3900 END AS cut
            FROM (SELECT *, strpos(reverse(left(rest, 3900)), {nl}) AS back FROM splitting WHERE rest <> '')))
    SELECT {key}, (row_number() OVER (PARTITION BY {key} ORDER BY m, k) - 1)::INT AS position, piece AS message
    FROM splitting WHERE piece IS NOT NULL"""


ORACLES["document_messages"] = message_texts(
    "SELECT doc_id, 'Document' AS head, string_split(text, chr(10)) AS blocks FROM documents", "doc_id"
)


def _link(url: str, text: str) -> str:
    return f"""'<a href="' || {esc(url)} || '">' || {esc(text)} || '</a>'"""


def _ranked(rows: str, by: str, order: str, value: str) -> str:
    """Lines of a ranked section; ``rank`` is the place within the day."""
    same = "strftime(d.run_date, '%Y-%m-%d')" if rows == "day_topics" else "d.run_date"
    return f"""(SELECT string_agg({value}, chr(10) ORDER BY rank) FROM (
      SELECT *, row_number() OVER (ORDER BY {order}) AS rank FROM {rows} WHERE {rows}.run_date = {same}))"""


_CHIP = "CASE dir WHEN 'up' THEN '▲' ELSE '▼' END || name || ' ' || CASE WHEN pct >= 0 THEN '+' ELSE '' END || pct || '%'"
_BLOCK_LINES = {
    "📣 <b>마케팅 읽을거리</b>": f"nullif({_ORACLE_BLOCK}, '')",
    "📊 <b>세그먼트별 관심사 추이</b>": """CASE WHEN d.run_date = DATE '2024-12-31' THEN
        (SELECT string_agg('<b>' || segment || '</b>' || chr(10) || coalesce(chips, ''), chr(10) ORDER BY segment) FROM chips) END""",
    "🔥 <b>오늘 한국 실시간 검색</b>": _ranked(
        "day_searches", "run_date", "feed_pos", f"'• ' || {esc('title')} || ' <i>(' || traffic || ')</i>'"
    ),
    "🚀 <b>Product Hunt</b>": _ranked(
        "day_products", "run_date", "feed_pos",
        f"'<b>' || rank || '.</b> ' || {_link('url', 'name')} || CASE WHEN tagline <> '' THEN ' — ' || {esc('tagline')} ELSE '' END",
    ),
    "📰 <b>GeekNews · 어제</b>": _ranked(
        "day_topics", "run_date", "points DESC, doc_id",
        f"'<b>' || rank || '.</b> ' || {_link('url', 'title')} || '  👍' || points || chr(10) || '<i>' || {esc('about')} || '</i>'",
    ),
    "🐙 <b>GitHub Trending · Python</b>": _ranked(
        "day_repos", "run_date", "stars_today DESC, p_partkey",
        f"'<b>' || rank || '.</b> ' || {_link(chr(39) + 'https://github.com/' + chr(39) + ' || repo', 'repo')} || '  ⭐+' || stars_today || chr(10) || '<i>' || {esc('description')} || '</i>'",
    ),
}
_ALL_BLOCKS = ", ".join(f"'{heading}' || chr(10) || {lines}" for heading, lines in _BLOCK_LINES.items())
_DAY_BLOCKS = f"""WITH {SECTIONS},
  places AS (SELECT *, row_number() OVER (PARTITION BY segment, dir ORDER BY pct DESC, name) AS rising,
               row_number() OVER (PARTITION BY segment, dir ORDER BY pct, name DESC) AS falling FROM changes),
  chips AS (SELECT segment, string_agg({_CHIP}, '  ' ORDER BY dir DESC, pct DESC, name)
              FILTER ((dir = 'up' AND rising <= 3) OR (dir = 'down' AND falling <= 2)) AS chips
            FROM places GROUP BY segment)
  SELECT {_DATE}, '🌅 <b>Daily brief ' || strftime(d.run_date, '%Y-%m-%d') || '</b>' AS head,
         list_filter([{_ALL_BLOCKS}], lambda b: b IS NOT NULL) AS blocks FROM days d"""
ORACLES["brief_messages"] = message_texts(_DAY_BLOCKS, "run_date")
ORACLES["brief_blocks"] = f"""SELECT run_date, head, length(blocks)::BIGINT AS n_blocks, blocks[1] AS first_block
    FROM ({_DAY_BLOCKS})"""
