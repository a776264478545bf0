"""Queries over the silver and gold loads: typed, checked, published in one pass."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightshare import views as v
from nightshare.plans import gold, silver
from nightshare.registry import query
from nightshare.session import shared_dir
from nightshare.sources import readers as rd

col = F.col

#: The given parts as raw listings; the same in SQL below.
RAW_SQL = """WITH raw AS (SELECT id, accommodates, CASE WHEN accommodates <= 5 THEN 'A' ELSE 'B' END AS city, CASE WHEN id % 10 = 0 THEN NULL WHEN id % 13 = 0 THEN 9999.0 ELSE CAST(replace(replace(price_text, '$', ''), ',', '') AS DOUBLE) END AS price_num,
  id % 40 AS minimum_nights, CASE id % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'exempt' WHEN 2 THEN 'registered' ELSE 'free text' END AS licence_status, CASE WHEN id % 4 = 1 THEN 'hotel' END AS exempt_type,
  CASE WHEN id % 9 <> 0 THEN id % 3 = 0 END AS has_availability, id % 2 = 0 AS host_is_superhost, 'área ' || zone AS neighbourhood_cleansed, 'Álava ' || zone AS neighbourhood_group_cleansed FROM parts) """


def raw_listings(s, d):
    """Text columns as they land; every other zone name is garbled, and so are all group names."""
    p, i = v.parts(s, d), col("id")
    text = {
        "id": i.cast("string"),
        "accommodates": col("accommodates").cast("string"),
        "price": F.when(i % 10 == 0, None).when(i % 13 == 0, "$9,999.00").otherwise(col("price_text")),
        "minimum_nights": (i % 40).cast("string"),
        "maximum_nights": F.lit("30"),
        "license": F.when(i % 4 == 0, None).when(i % 4 == 1, "Exempt - hotel<br>").when(i % 4 == 2, "Basque Country - Regional 5").otherwise("ask"),
        "has_availability": F.when(i % 9 == 0, None).when(i % 3 == 0, "t").otherwise("f"),
        "host_is_superhost": F.when(i % 2 == 0, "t").otherwise("f"),
        "neighbourhood_cleansed": F.concat(F.when(i % 2 == 0, "Ã¡rea ").otherwise("área "), "zone"),
        "neighbourhood_group_cleansed": F.concat(F.lit("Ã\x81lava "), "zone"),
        "latitude": F.when(i % 97 == 0, "50.0").otherwise("43.2"),
        "longitude": F.lit("-2.9"),
        "availability_30": (i % 31).cast("string"),
        "availability_365": (i % 29).cast("string"),
        "number_of_reviews_ltm": (i % 7).cast("string"),
        "number_of_reviews": (i % 5).cast("string"),
    }
    declared = [*rd.LISTING_LONGS, *rd.LISTING_DOUBLES, *rd.LISTING_DATES, *rd.LISTING_STRINGS]
    city = F.when(col("accommodates") <= 5, "A").otherwise("B").alias("city")
    return p.select(city, F.lit("2025-01-01").cast("date").alias("snapshot_date"), *[text.get(c, F.lit(None).cast("string")).alias(c) for c in declared])


BOXES = {"A": (42.0, 44.0, -4.0, -1.0), "B": (42.0, 44.0, -4.0, -1.0)}


@query(
    "silver_listings",
    RAW_SQL + """SELECT city, DATE '2025-01-01' AS snapshot_date, id, price_num, price_num IS NULL AS price_missing, coalesce(price_num = 9999, false) AS price_outlier, minimum_nights >= 28 AS is_long_stay, has_availability,
    host_is_superhost, neighbourhood_cleansed, neighbourhood_group_cleansed, licence_status, exempt_type FROM raw""",
)
def _(s, d):
    path = shared_dir(s, "silver-listings")
    for _again in range(2):  # a load that is run again replaces its partitions
        silver.load_listings(raw_listings(s, d), path, BOXES)
    return s.read.parquet(path).select(
        "city", "snapshot_date", "id", "price_num", "price_missing", "price_outlier", "is_long_stay", "has_availability", "host_is_superhost", "neighbourhood_cleansed", "neighbourhood_group_cleansed", "licence_status", "exempt_type"
    )


CALENDAR_SQL = "SELECT city, snapshot, listing_id, night, taken, CAST(lead AS INT) AS lead FROM nights"


def raw_calendar(s, d):
    return v.nights(s, d).select(
        "city", col("snapshot").alias("snapshot_date"), col("listing_id").cast("string").alias("listing_id"), col("night").cast("string").alias("date"),
        F.when(col("taken") == 1, "f").otherwise("t").alias("available"), (col("lead") % 5).cast("string").alias("minimum_nights"), F.lit("3").alias("maximum_nights"),
    )


@query(
    "silver_calendar",
    "SELECT CAST(city AS INT) AS city, snapshot AS snapshot_date, listing_id, night AS date, taken = 0 AS available, CAST(lead % 5 AS INT) AS minimum_nights, 3 AS maximum_nights FROM nights",
)
def _(s, d):
    path = shared_dir(s, "silver-calendar")
    silver.load_calendar(raw_calendar(s, d), path)
    return s.read.parquet(path).select("city", "snapshot_date", "listing_id", "date", "available", "minimum_nights", "maximum_nights")


@query(
    "silver_report",
    RAW_SQL
    + """SELECT 'listings' AS "table", * FROM (SELECT 'has_availability is t or f' AS rule, 'block' AS severity, CAST(0 AS BIGINT) AS violations UNION ALL SELECT 'host_is_superhost is t or f', 'block', 0 UNION ALL SELECT 'id', 'block', 0
    UNION ALL SELECT 'price_flags', 'block', 0 UNION ALL SELECT 'long_stay_flag', 'block', 0 UNION ALL SELECT 'coordinates', 'warn', count(*) FILTER (id % 97 = 0) FROM raw UNION ALL SELECT 'capacity', 'warn', count(*) FILTER (accommodates <= 0) FROM raw
    UNION ALL SELECT 'price', 'warn', count(*) FILTER (price_num <= 0) FROM raw UNION ALL SELECT 'availability_order', 'warn', count(*) FILTER (id % 31 > id % 29) FROM raw UNION ALL SELECT 'review_dates', 'warn', 0
    UNION ALL SELECT 'review_counts', 'warn', count(*) FILTER (id % 7 > id % 5) FROM raw UNION ALL SELECT 'stay_limits', 'warn', count(*) FILTER (minimum_nights > 30) FROM raw
    UNION ALL SELECT 'unique city, snapshot_date, id', 'block', count(*) - count(DISTINCT id) FROM raw UNION ALL SELECT 'rows written', 'block', 0)
    UNION ALL SELECT 'calendar', * FROM (SELECT 'available is t or f', 'block', CAST(0 AS BIGINT) UNION ALL SELECT 'listing_id', 'block', 0 UNION ALL SELECT 'date', 'block', 0 UNION ALL SELECT 'available', 'block', 0
    UNION ALL SELECT 'least_stay', 'warn', count(*) FILTER (lead % 5 < 1) FROM nights UNION ALL SELECT 'night_not_before_capture', 'warn', count(*) FILTER (snapshot > night) FROM nights
    UNION ALL SELECT 'stay_limits', 'warn', count(*) FILTER (lead % 5 > 3) FROM nights UNION ALL SELECT 'unique city, snapshot_date, listing_id, date', 'block', count(*) - count(DISTINCT (city, snapshot, listing_id, night)) FROM nights UNION ALL SELECT 'rows written', 'block', 0)""",
)
def _(s, d):
    a = silver.load_listings(raw_listings(s, d), shared_dir(s, "silver-listings"), BOXES)
    b = silver.load_calendar(raw_calendar(s, d), shared_dir(s, "silver-calendar"))
    return a.select(F.lit("listings").alias("table"), "*").unionByName(b.select(F.lit("calendar").alias("table"), "*"))


@query(
    "gold_report",
    """SELECT * FROM (VALUES ('dim_zone', 'declared zones found', 'block'), ('dim_listing', 'listing_id', 'block'), ('fact_listing_snapshot', 'snapshot_id', 'block')) t("table", rule, severity), (SELECT CAST(0 AS BIGINT) AS violations)
    UNION ALL SELECT 'fact_calendar', 'capture missing', 'warn', count(*) FROM fact_calendar k LEFT JOIN (SELECT listing_id, city, snapshot_date FROM fact_listing WHERE captures > 1) l USING (listing_id, city, snapshot_date) WHERE l.listing_id IS NULL
    UNION ALL SELECT 'dim_zone', 'unique zone_id', 'block', count(*) - count(DISTINCT zone_id) FROM (SELECT DISTINCT grp || '|' || zone AS zone_id, grp, zone FROM listing_snap)
    UNION ALL SELECT 'dim_listing', 'unique listing_id', 'block', 0 UNION ALL SELECT 'fact_listing_snapshot', 'unique listing_id, snapshot_id', 'block', count(*) - count(DISTINCT (listing_id, city, snapshot_date)) FROM fact_listing
    UNION ALL SELECT unnest(['dim_zone', 'dim_listing', 'fact_listing_snapshot', 'fact_calendar']), 'rows written', 'block', 0""",
)
def _(s, d):
    snap = v.listing_snap(s, d).withColumn("area", col("grp"))
    zones = gold.dim_zone(snap, "grp", "zone", "area")
    listings = gold.dim_listing(snap, "listing_id", "snapshot", ["zone", "min_nights"], ["grp"])
    fact = gold.fact_listing_snapshot(v.fact_listing(s, d), "city", "snapshot_date", ["price", "price_missing"])
    captures = v.fact_listing(s, d).where("captures > 1").withColumn("capture_date", F.date_add("snapshot_date", 3))
    calendar = gold.fact_calendar(v.fact_calendar(s, d), captures).withColumn("snapshot_id", F.concat_ws("_", "city", F.date_format("snapshot_date", "yyyyMMdd")))
    declared = {"ASIA": [r.zone for r in snap.where("grp = 'ASIA'").groupBy().agg(F.min("zone").alias("zone")).collect() if r.zone]}
    return gold.load_gold(zones, listings, fact, calendar, shared_dir(s, "gold"), "grp", "zone", declared)
