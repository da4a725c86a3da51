"""Listing monitor: scans, differences, filter, flatten, upsert, reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import times
from tidemark.functions.once import computed_once
from tidemark.operators import keyed

# Shape of the detail JSON.
DETAIL_SCHEMA = """item STRUCT<
  itemId: BIGINT, salesType: STRING, serviceType: STRING, roomType: STRING, status: STRING,
  title: STRING, description: STRING, bjdCode: STRING, jibunAddress: STRING,
  imageThumbnail: STRING, moveinDate: STRING, updatedAt: STRING, options: ARRAY<STRING>,
  price: STRUCT<deposit: DOUBLE, rent: DOUBLE>, manageCost: STRUCT<amount: DOUBLE>,
  area: STRUCT<`전용면적M2`: DECIMAL(6,2)>, floor: STRUCT<floor: STRING, allFloors: STRING>,
  location: STRUCT<lat: DECIMAL(10,7), lng: DECIMAL(10,7)>,
  addressOrigin: STRUCT<localText: STRING>>"""


# --- scans and differences --------------------------------------------------

def scan(
    listed: DataFrame,
    geohashes: Sequence[str] = fixed.GEOHASHES,
    sales_type: str = fixed.SALES_TYPE,
    deposit_max: int = fixed.DEPOSIT_MAX,
    rent_max: int = fixed.TOTAL_RENT_MAX,
) -> DataFrame:
    """Listed ids that match the source-side predicate; rows without an id are dropped.

    Plain comparisons on columns, so a stored table takes them in its scan.
    """
    return listed.filter(
        reduce(or_, (F.startswith("geohash", F.lit(prefix)) for prefix in geohashes))
        & (F.col("sales_type") == sales_type)
        & F.col("deposit").between(0, deposit_max)
        & F.col("rent").between(0, rent_max)
        & F.col("item_id").isNotNull()
    ).select("item_id")


def listed_ids(scans: Sequence[DataFrame]) -> DataFrame:
    """Distinct ids of all scans."""
    return reduce(DataFrame.unionByName, [s.select("item_id") for s in scans]).distinct()


def new_ids(listed: DataFrame, known: DataFrame) -> DataFrame:
    return listed.join(known.select("item_id"), "item_id", "left_anti")


def seen_ids(listed: DataFrame, known: DataFrame) -> DataFrame:
    return listed.join(known.select("item_id"), "item_id", "left_semi")


def diff_flags(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Every listed id with ``is_new``."""
    marks = known.select("item_id").distinct().withColumn("_known", F.lit(True))
    return listed.join(marks, "item_id", "left").select("item_id", F.col("_known").isNull().alias("is_new"))


def run_summary(flags: DataFrame) -> DataFrame:
    """Listed, new and seen counts of a run."""
    return flags.agg(
        F.count("*").alias("listed_count"),
        F.count_if("is_new").alias("new_count"),
        F.count_if(~F.col("is_new")).alias("seen_count"),
    )


# --- details ----------------------------------------------------------------

def parse_details(details: DataFrame, json: str = "detail") -> DataFrame:
    """Detail JSON to ``item`` and ``raw``; rows without an item are dropped."""
    item = F.from_json("raw", DETAIL_SCHEMA)["item"]
    rows = computed_once(details.select(F.col(json).alias("raw")), "item", item)
    return rows.filter(F.col("item.itemId").isNotNull())


def has_phrase(text: Column, phrases: Sequence[str]) -> Column:
    return reduce(or_, (F.contains(text, F.lit(p)) for p in phrases))


def wanted(
    item: Column,
    sales_type: str = fixed.SALES_TYPE,
    room_types: Sequence[str] = fixed.ROOM_TYPES,
    areas: Sequence[str] = tuple(fixed.AREA_NAMES),
    deposit_max: int = fixed.DEPOSIT_MAX,
    rent_min: int = fixed.TOTAL_RENT_MIN,
    rent_max: int = fixed.TOTAL_RENT_MAX,
    phrases: Sequence[str] = fixed.WOMEN_ONLY,
) -> Column:
    """The monitor's predicate. Missing amounts count as 0; other missing fields fail."""
    amount = lambda c: F.coalesce(c, F.lit(0))
    rent = amount(item["price"]["rent"]) + amount(item["manageCost"]["amount"])
    text = F.concat_ws(
        " ", F.coalesce(item["title"], F.lit("")), F.coalesce(item["description"], F.lit(""))
    )
    matches = (
        (item["salesType"] == sales_type)
        & item["roomType"].isin(list(room_types))
        & F.left(item["bjdCode"], F.lit(5)).isin(list(areas))
        & (item["status"] == fixed.OPEN)
        & (amount(item["price"]["deposit"]) <= deposit_max)
        & rent.between(rent_min, rent_max)
        & ~has_phrase(text, phrases)
    )
    return F.coalesce(matches, F.lit(False))


def _whole(amount: Column) -> Column:
    """An amount as the integer column holds it; NULL when it is too large for one."""
    return F.bround(amount, 0).try_cast("int")


def flatten(
    parsed: DataFrame, source: str, villa_url: str, officetel_url: str
) -> DataFrame:
    """Parsed details to the flat listing columns.

    The two URL templates hold one ``%s`` for the item id.
    """
    item = F.col("item")
    item_id = item["itemId"].cast("string")
    url = F.when(
        item["serviceType"] == fixed.OFFICETEL, F.format_string(officetel_url, item_id)
    ).otherwise(F.format_string(villa_url, item_id))
    return parsed.select(
        F.lit(source).alias("source"),
        item_id.alias("item_id"),
        item["salesType"].alias("sales_type"),
        item["serviceType"].alias("service_type"),
        item["roomType"].alias("room_type"),
        _whole(item["price"]["deposit"]).alias("deposit"),
        _whole(item["price"]["rent"]).alias("rent"),
        _whole(item["manageCost"]["amount"]).alias("manage_cost"),
        item["area"]["전용면적M2"].alias("area_m2"),
        item["floor"]["floor"].alias("floor"),
        item["floor"]["allFloors"].alias("all_floors"),
        item["title"].alias("title"),
        item["description"].alias("description"),
        item["addressOrigin"]["localText"].alias("address_local"),
        item["jibunAddress"].alias("jibun_address"),
        item["bjdCode"].alias("bjd_code"),
        item["location"]["lat"].alias("lat"),
        item["location"]["lng"].alias("lng"),
        item["imageThumbnail"].alias("image_thumbnail"),
        F.to_json(F.coalesce(item["options"], F.array().cast("array<string>"))).alias("options"),
        item["moveinDate"].alias("movein_date"),
        item["status"].alias("status"),
        url.alias("detail_url"),
        "raw",
        times.iso_as_utc(item["updatedAt"]).alias("source_updated_at"),
    )


def upsert_listings(listings: DataFrame, batch: DataFrame, now: Column) -> DataFrame:
    """New listings are inserted; known ones only get seen time, status and source time."""
    stamped = batch.withColumns({"first_seen_at": now, "last_seen_at": now})
    return keyed.upsert(
        listings, stamped, ["source", "item_id"], ["last_seen_at", "status", "source_updated_at"]
    )


# --- reports ----------------------------------------------------------------

def area_label(
    code: Column, names: Mapping[str, str] = fixed.AREA_NAMES, other: str = fixed.OTHER_AREA
) -> Column:
    """Name of the area of a code; unknown and missing codes share one name."""
    label = F.lit(other)
    for prefix, name in names.items():
        label = F.when(F.left(code, F.lit(5)) == prefix, F.lit(name)).otherwise(label)
    return label


def active_total(listings: DataFrame) -> DataFrame:
    return listings.filter(F.col("status") == fixed.OPEN).agg(F.count("*").alias("n"))


def area_counts(listings: DataFrame) -> DataFrame:
    """Open listings per area prefix, largest first; unknown prefixes stay apart."""
    prefix = F.left("bjd_code", F.lit(5))
    counted = listings.filter(F.col("status") == fixed.OPEN).groupBy(prefix.alias("prefix")).agg(
        F.count("*").alias("n")
    )
    rows = counted.select(area_label(F.col("prefix")).alias("name"), "prefix", "n")
    return rows.orderBy(F.desc("n"), "prefix")


def within_days(
    rows: DataFrame, column: str, as_of: Column, days: int | None = fixed.DAYS
) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``; all rows when ``days`` is None."""
    if days is None:
        return rows
    return rows.filter(F.col(column) >= as_of - F.make_dt_interval(F.lit(days)))


def run_days(
    runs: DataFrame, as_of: Column, days: int | None = fixed.DAYS, zone: str = fixed.LOCAL_ZONE
) -> DataFrame:
    """Successful runs per local day: last start and number of new listings."""
    fine = within_days(runs.filter(F.col("status") == "ok"), "started_at", as_of, days)
    return fine.groupBy(times.local_day(F.col("started_at"), zone).alias("day")).agg(
        F.max("started_at").alias("started_at"), F.sum("new_count").alias("new_count")
    )


def listings_by_day(
    listings: DataFrame,
    runs: DataFrame,
    as_of: Column,
    days: int | None = fixed.DAYS,
    zone: str = fixed.LOCAL_ZONE,
) -> DataFrame:
    """Listings with local day and area, newest first; a run day without any gives one NULL row.

    Rows, not one array per day: a day has no size limit.
    """
    recent = within_days(listings, "first_seen_at", as_of, days).withColumns(
        {
            "day": times.local_day(F.col("first_seen_at"), zone),
            "area": area_label(F.col("bjd_code")),
        }
    )
    ran = run_days(runs, as_of, days, zone).select("day")
    empty = ran.join(recent.select("day").distinct(), "day", "left_anti")
    both = recent.unionByName(empty, allowMissingColumns=True)
    return both.orderBy(F.desc("day"), F.desc("first_seen_at"), F.desc("item_id"))


def day_area_counts(by_day: DataFrame) -> DataFrame:
    """Per day, listings in total (``area`` NULL) and per area; empty days count 0."""
    found = by_day.withColumn("hit", F.col("item_id").isNotNull().cast("int"))
    totals = F.sum("hit").alias("n")
    per_day = found.groupBy("day").agg(totals).withColumn("area", F.lit(None).cast("string"))
    per_area = found.filter("hit = 1").groupBy("day", "area").agg(totals)
    return per_day.unionByName(per_area)


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(1)
