"""Registered queries over listings built from orders, customers and nations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.operators import keyed
from tidemark.operators import listings as ls
from tidemark.plans.inputs import table

SOURCE = "portal"
VILLA_URL = "https://listings.example/villa/%s"
OFFICETEL_URL = "https://listings.example/officetel/%s"
CUT = "1998-01-01"
ALL_DAYS = None
_PREFIXES = ("11290", "11230", "11140", "11200", "11305", "11999", "26110")


def _orders(spark, sf_dir):
    """Orders with the nation of their customer."""
    owners = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment", "c_name"
    )
    return table(spark, sf_dir, "orders").join(owners, "o_custkey")


def _code(nation):
    """Area code of a nation: seven prefixes, some of them outside the monitored areas."""
    return F.concat(F.get(F.lit(list(_PREFIXES)), (nation % 7).cast("int")), F.lpad(nation.cast("string"), 5, "0"))


def _details(spark, sf_dir):
    """One detail JSON per order, as the portal would answer."""
    key = F.col("o_orderkey")
    room = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "투룸")
        .when(F.col("o_orderpriority") == "2-HIGH", "쓰리룸")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "투룸")
        .otherwise("원룸")
    )
    item = F.struct(
        key.alias("itemId"),
        F.when(key % 9 == 0, "전세").otherwise("월세").alias("salesType"),
        F.when(key % 2 == 0, "오피스텔").otherwise("빌라").alias("serviceType"),
        room.alias("roomType"),
        F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("status"),
        F.col("c_name").alias("title"),
        F.when(key % 11 == 0, "조용한 집, 여성 전용 건물").when(key % 11 < 6, F.col("c_mktsegment")).alias("description"),
        F.when(key % 13 != 0, _code(F.col("c_nationkey"))).alias("bjdCode"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("updatedAt"),
        F.when(key % 3 == 0, F.array(F.lit("에어컨"), F.lit("냉장고"))).alias("options"),
        F.struct(
            # Also amounts that no integer column holds, and fractions.
            F.when(key % 19 == 0, 5_000_000_000.0).when(key % 19 == 1, 3000.5)
            .otherwise(F.floor(F.col("o_totalprice") / 100).cast("double")).alias("deposit"),
            F.when(key % 17 != 0, (60 + key % 71) + F.when(key % 7 == 0, 0.25).otherwise(0.0)).alias("rent"),
        ).alias("price"),
        F.when(key % 5 != 0, F.struct((key % 23).alias("amount"))).alias("manageCost"),
        F.struct(((key % 4000) / 100).cast("decimal(6,2)").alias("전용면적M2")).alias("area"),
        F.struct(
            (key % 20).cast("string").alias("floor"), F.lit("20").alias("allFloors")
        ).alias("floor"),
        F.struct(F.lit("구 동").alias("localText")).alias("addressOrigin"),
    )
    return _orders(spark, sf_dir).select(F.to_json(F.struct(item.alias("item"))).alias("detail"))


def _flat(spark, sf_dir):
    return ls.flatten(ls.parse_details(_details(spark, sf_dir)), SOURCE, VILLA_URL, OFFICETEL_URL)


def listing_flatten(spark, sf_dir):
    rows = _flat(spark, sf_dir)
    return rows.select(
        "item_id", "sales_type", "service_type", "room_type", "deposit", "rent", "manage_cost",
        F.col("area_m2").cast("string").alias("area_m2"), "floor", "title", "description",
        "bjd_code", "options", "status", "detail_url",
        F.unix_micros("source_updated_at").alias("source_updated_at"),
    )


def listing_filter(spark, sf_dir):
    parsed = ls.parse_details(_details(spark, sf_dir)).filter(ls.wanted(F.col("item")))
    return ls.flatten(parsed, SOURCE, VILLA_URL, OFFICETEL_URL).select(
        "item_id", "room_type", "deposit", "rent", "manage_cost", "bjd_code"
    )


def _known(spark, sf_dir):
    """Listings stored before a run: orders up to the cut."""
    old = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < CUT)
    return old.select(F.col("o_orderkey").alias("item_id"))


def _scans(spark, sf_dir):
    """One scan per return flag, as the listing categories."""
    lines = table(spark, sf_dir, "lineitem")
    return [
        lines.filter(F.col("l_returnflag") == flag).select(F.col("l_orderkey").alias("item_id"))
        for flag in ("A", "N", "R")
    ]


def listing_scan(spark, sf_dir):
    """The source-side predicate over all order lines, with suppliers as places."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(F.get(F.lit(["wydm9", "wydq1", "wxxxx"]), (F.col("l_suppkey") % 3).cast("int")), F.lit("zz")).alias("geohash"),
        F.when(F.col("l_linestatus") == "O", "월세").otherwise("전세").alias("sales_type"),
        F.floor(F.col("l_extendedprice") / 10).alias("deposit"),
        F.floor(F.col("l_quantity") * 5).alias("rent"),
        F.col("l_orderkey").alias("item_id"),
    )
    return ls.listed_ids([ls.scan(rows)])


def listing_new_ids(spark, sf_dir):
    return ls.new_ids(ls.listed_ids(_scans(spark, sf_dir)), _known(spark, sf_dir))


def listing_seen_ids(spark, sf_dir):
    return ls.seen_ids(ls.listed_ids(_scans(spark, sf_dir)), _known(spark, sf_dir))


def listing_diff(spark, sf_dir):
    return ls.diff_flags(ls.listed_ids(_scans(spark, sf_dir)), _known(spark, sf_dir))


def listing_run_summary(spark, sf_dir):
    """The run log after one run: an opening and a closing record folded into one."""
    counts = ls.run_summary(listing_diff(spark, sf_dir))
    start = F.lit("2002-01-01T00:00:00Z").cast("timestamp")
    opened = counts.select(
        F.lit(1).alias("run_id"), start.alias("started_at"),
        F.lit(None).cast("timestamp").alias("finished_at"), F.lit("running").alias("status"),
    )
    closed = counts.select(
        F.lit(1).alias("run_id"), start.alias("started_at"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(5))).alias("finished_at"),
        F.lit("ok").alias("status"), "listed_count", "new_count", "seen_count",
    )
    log = opened.unionByName(closed, allowMissingColumns=True)
    return keyed.fold_runs(log).select(
        "run_id", "status", "listed_count", "new_count", "seen_count",
        F.unix_micros("finished_at").alias("finished_at"),
    )


def _stored(spark, sf_dir):
    """The listing table: every order, first seen on its date."""
    orders = _orders(spark, sf_dir)
    seen = times.as_utc(F.col("o_orderdate")) + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    return orders.select(
        F.lit(SOURCE).alias("source"),
        F.col("o_orderkey").cast("string").alias("item_id"),
        F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("status"),
        F.when(F.col("o_orderkey") % 13 != 0, _code(F.col("c_nationkey"))).alias("bjd_code"),
        seen.alias("first_seen_at"),
        seen.alias("last_seen_at"),
        F.lit(None).cast("timestamp").alias("source_updated_at"),
    )


def _now():
    return F.lit("2002-01-01T00:00:00Z").cast("timestamp")


def listing_upsert(spark, sf_dir):
    """Stored listings up to the cut, then all wanted details as the batch of a run."""
    stored = _stored(spark, sf_dir).filter(F.col("first_seen_at") < F.lit(f"{CUT}T00:00:00Z").cast("timestamp"))
    parsed = ls.parse_details(_details(spark, sf_dir)).filter(ls.wanted(F.col("item")))
    batch = ls.flatten(parsed, SOURCE, VILLA_URL, OFFICETEL_URL)
    rows = ls.upsert_listings(stored, batch, _now())
    return rows.select(
        "item_id", "status", "bjd_code",
        F.unix_micros("first_seen_at").alias("first_seen_at"),
        F.unix_micros("last_seen_at").alias("last_seen_at"),
        F.unix_micros("source_updated_at").alias("source_updated_at"),
    )


def listing_touch(spark, sf_dir):
    """Every stored listing that any order line lists again."""
    seen = ls.listed_ids(_scans(spark, sf_dir)).select(
        F.lit(SOURCE).alias("source"), F.col("item_id").cast("string").alias("item_id")
    )
    rows = keyed.touch(_stored(spark, sf_dir), seen, ["source", "item_id"], "last_seen_at", _now())
    return rows.select("item_id", F.unix_micros("last_seen_at").alias("last_seen_at"))


def _runs(spark, sf_dir):
    """A run per day of shipping; every seventh failed."""
    per_day = table(spark, sf_dir, "lineitem").groupBy("l_shipdate").agg(
        F.countDistinct("l_orderkey").alias("new_count")
    )
    at = times.as_utc(F.col("l_shipdate")) + F.make_dt_interval(F.lit(0), F.lit(20))
    number = F.datediff("l_shipdate", F.lit("1990-01-01"))
    return per_day.select(
        number.alias("run_id"),
        at.alias("started_at"),
        F.when(number % 7 == 0, "error").otherwise("ok").alias("status"),
        "new_count",
    )


def _by_day(spark, sf_dir, days):
    listings = _stored(spark, sf_dir)
    as_of = table(spark, sf_dir, "orders").agg(times.as_utc(F.max("o_orderdate"))).scalar()
    return ls.listings_by_day(listings, _runs(spark, sf_dir), as_of, days)


def listings_by_day(spark, sf_dir):
    rows = _by_day(spark, sf_dir, ALL_DAYS)
    return rows.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "item_id", "area", "status",
        F.unix_micros("first_seen_at").alias("first_seen_at"),
    )


def listings_recent(spark, sf_dir):
    """The default window of fourteen days."""
    rows = _by_day(spark, sf_dir, ls.fixed.DAYS)
    return rows.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "item_id", "area")


def listings_by_day_area(spark, sf_dir):
    rows = ls.day_area_counts(_by_day(spark, sf_dir, ALL_DAYS))
    return rows.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "area", "n")


def run_days(spark, sf_dir):
    as_of = table(spark, sf_dir, "orders").agg(times.as_utc(F.max("o_orderdate"))).scalar()
    rows = ls.run_days(_runs(spark, sf_dir), as_of, ALL_DAYS)
    return rows.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        F.unix_micros("started_at").alias("started_at"),
        "new_count",
    )


def latest_run(spark, sf_dir):
    return ls.latest_run(_runs(spark, sf_dir)).select(
        "run_id", "status", "new_count", F.unix_micros("started_at").alias("started_at")
    )


def active_total(spark, sf_dir):
    return ls.active_total(_stored(spark, sf_dir))


def area_counts(spark, sf_dir):
    return ls.area_counts(_stored(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        listing_scan, listing_new_ids, listing_seen_ids, listing_diff, listing_run_summary,
        listing_flatten, listing_filter, listing_upsert, listing_touch, listings_by_day,
        listings_recent, listings_by_day_area, run_days, latest_run, active_total, area_counts,
    )
}

_CODE = "['11290', '11230', '11140', '11200', '11305', '11999', '26110'][c_nationkey % 7 + 1] || lpad(c_nationkey::VARCHAR, 5, '0')"
_AREA = """CASE left(bjd_code, 5) WHEN '11290' THEN '성북' WHEN '11230' THEN '동대문' WHEN '11140' THEN '중구'
  WHEN '11200' THEN '성동' WHEN '11305' THEN '강북' ELSE '기타' END"""
_FLAT = f"""flat AS (
  SELECT o_orderkey::VARCHAR AS item_id, o_orderkey AS k,
    CASE WHEN o_orderkey % 9 = 0 THEN '전세' ELSE '월세' END AS sales_type,
    CASE WHEN o_orderkey % 2 = 0 THEN '오피스텔' ELSE '빌라' END AS service_type,
    CASE o_orderpriority WHEN '1-URGENT' THEN '투룸' WHEN '2-HIGH' THEN '쓰리룸' WHEN '3-MEDIUM' THEN '투룸' ELSE '원룸' END AS room_type,
    CASE o_orderkey % 19 WHEN 0 THEN 5e9 WHEN 1 THEN 3000.5e0 ELSE floor(o_totalprice / 100) END AS sent_deposit,
    CASE WHEN o_orderkey % 17 <> 0 THEN 60 + o_orderkey % 71 + CASE WHEN o_orderkey % 7 = 0 THEN 0.25e0 ELSE 0e0 END END AS sent_rent,
    CASE o_orderkey % 19 WHEN 0 THEN NULL WHEN 1 THEN 3000 ELSE floor(o_totalprice / 100) END::INT AS deposit,
    CASE WHEN o_orderkey % 17 <> 0 THEN 60 + o_orderkey % 71 END::INT AS rent,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 23 END::INT AS manage_cost,
    ((o_orderkey % 4000) / 100)::DECIMAL(6,2)::VARCHAR AS area_m2,
    (o_orderkey % 20)::VARCHAR AS floor, c_name AS title,
    CASE WHEN o_orderkey % 11 = 0 THEN '조용한 집, 여성 전용 건물' WHEN o_orderkey % 11 < 6 THEN c_mktsegment END AS description,
    CASE WHEN o_orderkey % 13 <> 0 THEN {_CODE} END AS bjd_code,
    CASE WHEN o_orderkey % 3 = 0 THEN '["에어컨","냉장고"]' ELSE '[]' END AS options,
    CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS status,
    'https://listings.example/' || CASE WHEN o_orderkey % 2 = 0 THEN 'officetel/' ELSE 'villa/' END || o_orderkey AS detail_url,
    epoch_us(o_orderdate) AS source_updated_at
  FROM orders JOIN customer ON c_custkey = o_custkey),
wanted AS (
  SELECT * FROM flat WHERE sales_type = '월세' AND room_type IN ('투룸', '쓰리룸') AND status = 'open'
    AND left(bjd_code, 5) IN ('11290', '11230', '11140', '11200', '11305') AND sent_deposit <= 3000
    AND coalesce(sent_rent, 0) + coalesce(manage_cost, 0) BETWEEN 80 AND 120
    AND coalesce(description, '') NOT LIKE '%여성 전용%')"""
_LISTED = f"""listed AS (SELECT DISTINCT l_orderkey AS item_id FROM lineitem),
known AS (SELECT o_orderkey AS item_id FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}')"""
_STORED = f"""stored AS (
  SELECT o_orderkey::VARCHAR AS item_id, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS status,
    CASE WHEN o_orderkey % 13 <> 0 THEN {_CODE} END AS bjd_code,
    o_orderdate + to_hours((o_orderkey % 24)::INT) AS first_seen_at
  FROM orders JOIN customer ON c_custkey = o_custkey)"""
_RUNS = """runs AS (
  SELECT date_diff('day', DATE '1990-01-01', l_shipdate::DATE) AS run_id, l_shipdate + INTERVAL 20 HOUR AS started_at,
    CASE WHEN date_diff('day', DATE '1990-01-01', l_shipdate::DATE) % 7 = 0 THEN 'error' ELSE 'ok' END AS status,
    count(DISTINCT l_orderkey) AS new_count FROM lineitem GROUP BY l_shipdate)"""


def _days(days: int | None) -> str:
    since = "'-infinity'::TIMESTAMP" if days is None else f"(SELECT max(o_orderdate) FROM orders) - to_days({days})"
    return f"""{_STORED}, {_RUNS}, recent AS (
      SELECT *, (first_seen_at + INTERVAL 9 HOUR)::DATE AS day, {_AREA} AS area FROM stored
      WHERE first_seen_at >= {since}),
    fine AS (
      SELECT (started_at + INTERVAL 9 HOUR)::DATE AS day, max(started_at) AS started_at, sum(new_count)::BIGINT AS new_count
      FROM runs WHERE status = 'ok' AND started_at >= {since} GROUP BY 1),
    by_day AS (
      SELECT day, item_id, area, status, first_seen_at FROM recent
      UNION ALL SELECT day, NULL, NULL, NULL, NULL FROM fine WHERE day NOT IN (SELECT day FROM recent))"""


ORACLES = {
    "listing_scan": """SELECT DISTINCT l_orderkey AS item_id FROM lineitem
        WHERE l_suppkey % 3 < 2 AND l_linestatus = 'O' AND floor(l_extendedprice / 10) BETWEEN 0 AND 3000
          AND floor(l_quantity * 5) BETWEEN 0 AND 120""",
    "listing_new_ids": f"WITH {_LISTED} SELECT item_id FROM listed EXCEPT SELECT item_id FROM known",
    "listing_seen_ids": f"WITH {_LISTED} SELECT item_id FROM listed INTERSECT SELECT item_id FROM known",
    "listing_diff": f"WITH {_LISTED} SELECT item_id, item_id NOT IN (SELECT item_id FROM known) AS is_new FROM listed",
    "listing_run_summary": f"""WITH {_LISTED} SELECT 1 AS run_id, 'ok' AS status, count(*) AS listed_count,
        count(*) FILTER (item_id NOT IN (SELECT item_id FROM known)) AS new_count,
        count(*) FILTER (item_id IN (SELECT item_id FROM known)) AS seen_count,
        epoch_us(TIMESTAMP '2002-01-01 00:05:00') AS finished_at FROM listed""",
    "listing_flatten": f"WITH {_FLAT} SELECT * EXCLUDE (k, sent_deposit, sent_rent) FROM flat",
    "listing_filter": f"""WITH {_FLAT} SELECT item_id, room_type, deposit, rent, manage_cost, bjd_code FROM wanted""",
    "listing_upsert": f"""WITH {_FLAT}, {_STORED},
        old AS (SELECT *, epoch_us(first_seen_at) AS seen FROM stored WHERE first_seen_at < TIMESTAMP '{CUT}')
        SELECT coalesce(o.item_id, w.item_id) AS item_id, coalesce(w.status, o.status) AS status,
               coalesce(o.bjd_code, w.bjd_code) AS bjd_code,
               coalesce(seen, epoch_us(TIMESTAMP '2002-01-01')) AS first_seen_at,
               CASE WHEN w.item_id IS NULL THEN seen ELSE epoch_us(TIMESTAMP '2002-01-01') END AS last_seen_at,
               w.source_updated_at
        FROM old o FULL JOIN wanted w ON o.item_id = w.item_id""",
    "listing_touch": f"""WITH {_STORED} SELECT item_id,
        CASE WHEN item_id IN (SELECT l_orderkey::VARCHAR FROM lineitem) THEN epoch_us(TIMESTAMP '2002-01-01')
             ELSE epoch_us(first_seen_at) END AS last_seen_at FROM stored""",
    "listings_by_day": f"""WITH {_days(ALL_DAYS)} SELECT strftime(day, '%Y-%m-%d') AS day, item_id, area, status,
        epoch_us(first_seen_at) AS first_seen_at FROM by_day""",
    "listings_recent": f"WITH {_days(14)} SELECT strftime(day, '%Y-%m-%d') AS day, item_id, area FROM by_day",
    "listings_by_day_area": f"""WITH {_days(ALL_DAYS)}
        SELECT strftime(day, '%Y-%m-%d') AS day, NULL::VARCHAR AS area, count(item_id) AS n FROM by_day GROUP BY day
        UNION ALL
        SELECT strftime(day, '%Y-%m-%d'), area, count(*) FROM recent GROUP BY day, area""",
    "run_days": f"""WITH {_days(ALL_DAYS)} SELECT strftime(day, '%Y-%m-%d') AS day,
        epoch_us(started_at) AS started_at, new_count FROM fine""",
    "latest_run": f"""WITH {_RUNS} SELECT run_id::INT AS run_id, status, new_count, epoch_us(started_at) AS started_at
        FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 1""",
    "active_total": f"WITH {_STORED} SELECT count(*) AS n FROM stored WHERE status = 'open'",
    "area_counts": f"""WITH {_STORED} SELECT {_AREA} AS name, left(bjd_code, 5) AS prefix, count(*) AS n
        FROM stored WHERE status = 'open' GROUP BY 1, 2""",
}
