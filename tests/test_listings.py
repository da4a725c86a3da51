import json

from pyspark.sql import functions as F

from tidemark.operators import listings as ls

URLS = ("portal", "https://v/%s", "https://o/%s")


def item(**fields):
    base = {
        "itemId": 7, "salesType": "월세", "serviceType": "빌라", "roomType": "투룸", "status": "open",
        "title": "t", "description": "d", "bjdCode": "1129010100", "price": {"deposit": 1000, "rent": 80},
        "manageCost": {"amount": 5},
    }
    return {**base, **fields}


def details(spark, items):
    rows = [(json.dumps({"item": i}, ensure_ascii=False) if isinstance(i, dict) else i,) for i in items]
    return ls.parse_details(spark.createDataFrame(rows, "detail string"))


def test_predicate(spark):
    cases = [
        (item(), True),
        (item(salesType="전세"), False),
        (item(salesType=None), False),
        (item(roomType="원룸"), False),
        (item(roomType="쓰리룸"), True),
        (item(bjdCode="9999900000"), False),
        (item(bjdCode=None), False),
        (item(status="closed"), False),
        (item(price={"deposit": 3000, "rent": 80}), True),
        (item(price={"deposit": 3001, "rent": 80}), False),
        (item(price={"rent": 80}), True),
        (item(price=None), False),
        (item(price={"rent": 115}), True),
        (item(price={"rent": 116}), False),
        (item(price={"rent": 75}), True),
        (item(price={"rent": 74}), False),
        (item(manageCost=None), True),
        (item(title="여성전용 집"), False),
        (item(title="깨끗한 여성", description="전용 집"), False),
        (item(title=None, description=None), True),
        (item(description="여자만 가능"), False),
    ]
    for i, (one, _) in enumerate(cases):
        one["itemId"] = i
    parsed = details(spark, [c for c, _ in cases])
    got = {r[0] for r in parsed.filter(ls.wanted(F.col("item"))).select("item.itemId").collect()}
    assert got == {i for i, (_, ok) in enumerate(cases) if ok}


def test_flatten(spark):
    full = item(
        serviceType="오피스텔", area={"전용면적M2": 33.333}, floor={"floor": "3", "allFloors": "5"},
        location={"lat": 37.5, "lng": 127.01}, addressOrigin={"localText": "구"}, updatedAt="2024-05-01 10:00:00",
        options=["a", "b"], moveinDate="now", imageThumbnail="img", jibunAddress="j",
    )
    bare = {"itemId": 8}
    rows = ls.flatten(details(spark, [full, bare, "{}", "nonsense"]), *URLS).orderBy("item_id").collect()
    assert len(rows) == 2 and len(rows[0]) == 25
    one, two = rows
    assert (one.detail_url, two.detail_url) == ("https://o/7", "https://v/8")
    assert str(one.area_m2) == "33.33" and str(one.lng) == "127.0100000"
    assert (one.options, two.options) == ('["a","b"]', "[]")
    assert one.source_updated_at is not None and two.source_updated_at is None
    assert json.loads(one.raw)["item"]["title"] == "t"
    assert two.deposit is None and two.source == "portal"


def test_scan(spark):
    rows = [("wydm9x", "월세", 0, 0, 1), ("wydm9x", "월세", 3001, 0, 2), ("zzzzz", "월세", 0, 0, 3),
            ("wydq5", "전세", 0, 0, 4), ("wydq5", "월세", 10, 121, 5), ("wydq5", "월세", 10, 120, 6),
            ("wydq5", "월세", -1, 0, 7), ("wydq5", "월세", 1, 1, None), ("wydq5", "월세", 10, 120, 6)]
    df = spark.createDataFrame(rows, "geohash string, sales_type string, deposit int, rent int, item_id long")
    scan = ls.scan(df)
    assert sorted(r[0] for r in ls.listed_ids([scan, scan]).collect()) == [1, 6]


def test_differences(spark):
    listed = spark.createDataFrame([(i,) for i in range(5)], "item_id long")
    known = spark.createDataFrame([(3,), (4,), (4,), (9,)], "item_id long")
    assert sorted(r[0] for r in ls.new_ids(listed, known).collect()) == [0, 1, 2]
    assert sorted(r[0] for r in ls.seen_ids(listed, known).collect()) == [3, 4]
    assert tuple(ls.run_summary(ls.diff_flags(listed, known)).first()) == (5, 3, 2)


def test_upsert_refreshes_three_columns(spark):
    new = ls.flatten(details(spark, [item(status="closed", title="changed"), item(itemId=9)]), *URLS)
    at = lambda d: F.lit(f"{d}T00:00:00Z").cast("timestamp")
    stored = ls.flatten(details(spark, [item()]), *URLS).withColumns({"first_seen_at": at("2024-01-01"), "last_seen_at": at("2024-01-01")})
    rows = {r.item_id: r for r in ls.upsert_listings(stored, new, at("2024-02-02")).collect()}
    assert rows["7"].title == "t" and rows["7"].status == "closed"
    assert rows["7"].first_seen_at.month == 1 and rows["7"].last_seen_at.month == 2
    assert rows["9"].first_seen_at.month == 2


def test_reports(spark):
    at = lambda c: F.col(c).cast("timestamp")
    listings = spark.createDataFrame(
        [("1", "open", "1129010100", "2024-05-01T14:00:00Z"), ("2", "open", "2611010100", "2024-05-01T15:00:00Z"),
         ("3", "closed", None, "2024-05-03T01:00:00Z"), ("4", "open", "9999900000", "2020-01-01T00:00:00Z"),
         ("5", "open", None, "2024-05-03T02:00:00Z")],
        "item_id string, status string, bjd_code string, first_seen_at string",
    ).withColumn("first_seen_at", at("first_seen_at"))
    runs = spark.createDataFrame(
        [(1, "2024-05-01T23:00:00Z", "ok", 2), (2, "2024-05-04T23:00:00Z", "ok", 0), (3, "2024-05-05T23:00:00Z", "error", 0)],
        "run_id int, started_at string, status string, new_count int",
    ).withColumn("started_at", at("started_at"))
    as_of = F.lit("2024-05-06T00:00:00Z").cast("timestamp")
    by_day = ls.listings_by_day(listings, runs, as_of)
    got = [(str(r.day), r.item_id, r.area) for r in by_day.collect()]
    assert got == [
        ("2024-05-05", None, None), ("2024-05-03", "5", "기타"), ("2024-05-03", "3", "기타"),
        ("2024-05-02", "2", "기타"), ("2024-05-01", "1", "성북"),
    ]
    counts = {(str(r.day), r.area): r.n for r in ls.day_area_counts(by_day).collect()}
    assert counts[("2024-05-05", None)] == 0 and counts[("2024-05-03", None)] == 2
    assert ("2024-05-05", "기타") not in counts
    areas = [tuple(r) for r in ls.area_counts(listings).collect()]
    assert sorted(areas, key=str) == sorted(
        [("성북", "11290", 1), ("기타", "26110", 1), ("기타", "99999", 1), ("기타", None, 1)], key=str
    )
    assert ls.active_total(listings).first().n == 4
    assert ls.latest_run(runs).first().run_id == 3
    assert ls.run_days(runs, as_of).count() == 2
