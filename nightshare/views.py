"""Stand-in views over the given tables, each in Spark and in SQL.

The analytics speak of listings, nights and captures. These views read the given
tables as such, so every query can run on them and be compared with its SQL twin.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ---------------------------------------------------------------- calendar
def nights(spark: SparkSession, folder: str) -> DataFrame:
    """One row per listing, night and lead. Repeats are merged before anything else."""
    e = table(spark, folder, "events")
    lead = F.get_json_object("props", "$.k").cast("int")
    return (
        e.select(
            F.col("user_id").alias("listing_id"),
            (F.col("user_id") % 3).alias("city"),
            F.to_date("ts").alias("night"),
            lead.alias("lead"),
            F.col("event_type").isin("purchase", "signup").cast("int").alias("taken"),
            F.col("value").alias("price"),
        )
        .groupBy("listing_id", "city", "night", "lead")
        .agg(F.max("taken").alias("taken"), F.max("price").alias("price"))
        .withColumn("snapshot", F.date_sub("night", F.col("lead")))
    )


# ---------------------------------------------------------------- listings
def listing_snap(spark: SparkSession, folder: str) -> DataFrame:
    """Listing by monthly capture with its zone and group; lines are summed up before the small joins."""
    li = table(spark, folder, "lineitem")
    per = li.groupBy(
        F.col("l_suppkey").alias("listing_id"), F.to_date(F.trunc("l_shipdate", "month")).alias("snapshot")
    ).agg(
        F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.count(F.lit(1)).alias("n"),
        (F.min("l_quantity") >= 28).alias("long_stay"),
        F.min("l_quantity").alias("min_nights"),
    )
    zones = (
        table(spark, folder, "supplier")
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("listing_id"), F.col("n_name").alias("zone"), F.col("r_name").alias("grp"))
    )
    return per.join(zones, "listing_id")


def parts(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("$"), F.format_number(F.col("p_retailprice") * 10, 2)).alias("price_text"),
        F.col("p_retailprice").alias("list_price"),
        (((F.col("p_size") - 1) % 10) + 1).alias("accommodates"),
        F.col("p_brand").alias("zone"),
        F.col("p_type").alias("room_type"),
        F.col("p_name").alias("name"),
    )


def lines(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("stay_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("id"),
        F.col("l_suppkey").alias("host_id"),
        F.col("l_quantity").alias("stay_nights"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_discount").alias("discount"),
        F.to_date("l_shipdate").alias("day"),
        F.to_date(F.trunc("l_shipdate", "month")).alias("snapshot"),
        F.col("l_returnflag").alias("flag"),
    )


def monthly(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly series by city: mean order price as ADR, share of closed orders as occupancy."""
    o = table(spark, folder, "orders")
    per = o.groupBy("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("period")).agg(
        F.sum("o_totalprice").alias("s"),
        F.count(F.lit(1)).alias("c"),
        F.sum((F.col("o_orderstatus") == "F").cast("int")).alias("f"),
    )
    cities = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("n_name").alias("city"))
    )
    return (
        per.join(cities, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("city", "period")
        .agg(
            (F.sum("s") / F.sum("c")).alias("adr"),
            (F.lit(100.0) * F.sum("f") / F.sum("c")).alias("occ"),
            F.sum("c").alias("n"),
        )
        .withColumn("year", F.substring("period", 1, 4).cast("int"))
        .withColumn("month", F.substring("period", 6, 2).cast("int"))
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("id"),
            F.col("n_name").alias("zone"),
            F.col("r_name").alias("grp"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
        )
    )


def points(spark: SparkSession, folder: str) -> DataFrame:
    """Plane points in metres: the first two vector components, scaled."""
    e = table(spark, folder, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        (F.col("embedding")[0].cast("double") * 1000).alias("x"),
        (F.col("embedding")[1].cast("double") * 1000).alias("y"),
        F.col("label"),
    )


def docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


# Made-up events inside the month the calendar covers: name, city, kind, first and last night.
EVENT_RANGES = [
    (name, city, kind, f"2024-01-{first + city:02d}", f"2024-01-{last + city:02d}")
    for city in (0, 1, 2)
    for name, kind, first, last in (
        ("Winter Fair", "fair", 4, 6),
        ("Jazz Week 2024", "festival", 10, 13),
        ("Ring Race", "sport", 21, 21),
        ("Cup Match", "match", 16, 16),
        ("League Match", "match", 8, 8),
    )
]


def event_ranges(spark: SparkSession, folder: str) -> DataFrame:
    raw = spark.createDataFrame(EVENT_RANGES, "event string, city bigint, kind string, a string, b string")
    return raw.select("event", "city", "kind", F.to_date("a").alias("first_night"), F.to_date("b").alias("last_night"))


# Made-up events for the official daily series.
HOTEL_EVENTS = [
    (f"{name} {year}", city, kind, f"{year}-{a}", f"{year}-{b}")
    for year in (1996, 1997, 1999)
    for name, city, kind, a, b in (
        ("Harbour Days", "ASIA", "fair", "08-09", "08-17"),
        ("City Run", "EUROPE", "sport", "11-10", "11-10"),
        ("Film Week", "AFRICA", "festival", "09-20", "09-28"),
    )
]


def hotel_events(spark: SparkSession, folder: str) -> DataFrame:
    raw = spark.createDataFrame(HOTEL_EVENTS, "event string, city string, kind string, a string, b string")
    return raw.select("event", "city", "kind", F.to_date("a").alias("first_night"), F.to_date("b").alias("last_night"))


def hotel_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Daily occupancy by region: share of closed orders. Orders are summed by customer and day before the join."""
    per = table(spark, folder, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("night")).agg(
        F.sum((F.col("o_orderstatus") == "F").cast("int")).alias("f"), F.count(F.lit(1)).alias("c")
    )
    city = customers(spark, folder).select(F.col("id").alias("o_custkey"), F.col("grp").alias("city"))
    return per.join(city, "o_custkey").groupBy("city", "night").agg((F.lit(100.0) * F.sum("f") / F.sum("c")).alias("occ"))


def excluded(spark: SparkSession, folder: str) -> DataFrame:
    """Event nights with a day around them, and match nights, as nights that are no controls."""
    from nightshare.operators.controls import exclusion_set

    ev = event_ranges(spark, folder)
    matches = ev.where("kind = 'match'").select("city", F.col("first_night").alias("night"))
    return exclusion_set(ev.where("kind <> 'match'"), matches, matches=matches)


# Made-up districts in plane metres: two share a slanted border, one is a triangle, one lies apart.
DISTRICTS = {
    "D1": [(-300, -300), (0, -300), (50, 0), (-300, 20), (-300, -300)],
    "D2": [(0, -300), (300, -300), (300, 100), (50, 0), (0, -300)],
    "D3": [(-300, 20), (50, 0), (-40, 280), (-300, 20)],
    "D4": [(60, 20), (320, 130), (200, 350), (60, 20)],
}


def districts(spark: SparkSession, folder: str) -> DataFrame:
    rows = [(code, [(float(x), float(y)) for x, y in ring]) for code, ring in DISTRICTS.items()]
    return spark.createDataFrame(rows, "code string, ring array<struct<x:double,y:double>>")


def homes(spark: SparkSession, folder: str) -> DataFrame:
    """Listings that have a place in the plane."""
    return listing_income(spark, folder).join(points(spark, folder), "id")


def zone_nights(spark: SparkSession, folder: str) -> DataFrame:
    """Taken share by city and night from the nearest capture."""
    from nightshare.plans.occupancy import zone_nights as build

    return build(nights(spark, folder))


# ---------------------------------------------------------------- star
def capture_month():
    """Capture month of the star. Two months are added so that near nights fall in two seasons."""
    return F.to_date(F.trunc(F.date_add("snapshot", 60), "month")).alias("snapshot_date")


def fact_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Listing by monthly capture with price, flags and city, for the measures."""
    n = nights(spark, folder)
    g = n.groupBy("listing_id", "city", capture_month()).agg(
        F.max("price").alias("p"), F.min("lead").alias("lo"), F.max("lead").alias("hi"), F.count(F.lit(1)).alias("captures")
    )
    gone = (F.month("snapshot_date") == 12) & (F.col("city") != 0)
    price = (
        F.when(gone | (F.col("lo") % 9 == 0), F.lit(None).cast("double"))
        .when(F.col("lo") % 9 == 1, F.lit(9999.0))
        .otherwise(F.col("p") * 10)
    )
    return g.select(
        "listing_id",
        "city",
        "snapshot_date",
        price.alias("price"),
        price.isNull().alias("price_missing"),
        F.coalesce(price == 9999, F.lit(False)).alias("price_outlier"),
        (F.col("hi") % 40 >= 28).alias("long_stay"),
        F.col("captures"),
    )


def fact_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return nights(spark, folder).select(
        "listing_id", "city", capture_month(), "night", "lead", "taken"
    )


def dim_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Listing attributes; one market segment is left out on purpose, so facts have orphans."""
    return (
        customers(spark, folder)
        .where(F.col("segment") != "MACHINERY")
        .select(F.col("id").alias("listing_id"), (F.col("id") % 3).alias("home_city"), F.col("grp").alias("zone"))
        .withColumn("zone_id", F.concat_ws("|", F.col("home_city").cast("string"), F.col("zone")))
    )


def listing_income(spark: SparkSession, folder: str) -> DataFrame:
    """One row per listing with price, occupancy and monthly income, ready for zone and peer analyses."""
    from nightshare.operators.prefix import small_group_quantiles

    ln = lines(spark, folder)
    base = ln.groupBy("id").agg(
        (F.avg("stay_nights") / 50).alias("occ"),
        F.count(F.lit(1)).alias("reviews"),
        F.min("stay_nights").alias("min_nights"),
        F.min("host_id").alias("host_id"),
    )
    price = small_group_quantiles(ln, ["id"], "unit_price", {"price": 0.5})
    return (
        base.join(price, "id")
        .join(parts(spark, folder), "id")
        .withColumn("nights_year", F.col("occ") * 365)
        .withColumn("income", F.col("nights_year") * F.col("price") / 12)
    )


SQL_VIEWS: dict[str, str] = {
    "nights": """
SELECT user_id AS listing_id, user_id % 3 AS city, CAST(ts AS DATE) AS night,
       CAST(json_extract_string(props, '$.k') AS INT) AS lead,
       max(CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END) AS taken,
       max(value) AS price,
       CAST(ts AS DATE) - CAST(json_extract_string(props, '$.k') AS INT) AS snapshot
FROM events GROUP BY ALL""",
    "listing_snap": """
SELECT l_suppkey AS listing_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot, n_name AS zone, r_name AS grp,
       avg(l_extendedprice / l_quantity) AS price, count(*) AS n, min(l_quantity) >= 28 AS long_stay, min(l_quantity) AS min_nights
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
    "parts": """
SELECT p_partkey AS id, '$' || format('{:,.2f}', p_retailprice * 10) AS price_text, p_retailprice AS list_price,
       ((p_size - 1) % 10) + 1 AS accommodates, p_brand AS zone, p_type AS room_type, p_name AS name
FROM part""",
    "lines": """
SELECT l_orderkey AS stay_id, l_linenumber AS line, l_partkey AS id, l_suppkey AS host_id, l_quantity AS stay_nights,
       l_extendedprice / l_quantity AS unit_price, l_discount AS discount, CAST(l_shipdate AS DATE) AS day,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot, l_returnflag AS flag
FROM lineitem""",
    "monthly": """
SELECT n_name AS city, strftime(o_orderdate, '%Y-%m') AS period, avg(o_totalprice) AS adr,
       100.0 * avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS occ, count(*) AS n,
       CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""",
    "customers": """
SELECT c_custkey AS id, n_name AS zone, r_name AS grp, c_mktsegment AS segment, c_acctbal AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "points": """
SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) * 1000 AS x, CAST(embedding[2] AS DOUBLE) * 1000 AS y, label
FROM embeddings""",
    "docs": "SELECT * FROM documents",
    "event_ranges": "SELECT event, CAST(city AS BIGINT) AS city, kind, CAST(a AS DATE) AS first_night, CAST(b AS DATE) AS last_night FROM (VALUES "
    + ", ".join(f"('{e}', {c}, '{k}', '{a}', '{b}')" for e, c, k, a, b in EVENT_RANGES)
    + ") t(event, city, kind, a, b)",
    "district_edges": "SELECT code, CAST(ax AS DOUBLE) AS ax, CAST(ay AS DOUBLE) AS ay, CAST(bx AS DOUBLE) AS bx, CAST(by_ AS DOUBLE) AS by_ FROM (VALUES "
    + ", ".join(f"('{c}', {a[0]}, {a[1]}, {b[0]}, {b[1]})" for c, r in DISTRICTS.items() for a, b in zip(r, r[1:]))
    + ") t(code, ax, ay, bx, by_)",
    "located": """
SELECT p.*, min(code) FILTER (odd) AS district FROM points p LEFT JOIN (
  SELECT id, code, count(*) % 2 = 1 AS odd FROM points JOIN district_edges
  ON (ay <= y) <> (by_ <= y) AND x < (bx - ax) * (y - ay) / (by_ - ay) + ax GROUP BY id, code) h USING (id) GROUP BY ALL""",
    "homes": "SELECT i.*, x, y, label FROM listing_income i JOIN points p ON i.id = p.id",
    "hexed": """
SELECT * EXCLUDE (fq, fr, fs, rq, rr, rs),
  CAST(CASE WHEN abs(rq - fq) > abs(rs - fs) AND abs(rq - fq) > abs(rr - fr) THEN -rs - rr ELSE rq END AS BIGINT) AS q,
  CAST(CASE WHEN (abs(rq - fq) > abs(rs - fs) AND abs(rq - fq) > abs(rr - fr)) OR abs(rs - fs) > abs(rr - fr) THEN rr ELSE -rq - rs END AS BIGINT) AS r
FROM (SELECT *, round_even(fq, 0) AS rq, round_even(fr, 0) AS rr, round_even(fs, 0) AS rs FROM
  (SELECT *, -fq - fr AS fs FROM (SELECT *, (x * (sqrt(3.0) / 3) - y / 3) / 100.0 AS fq, (y * (2.0 / 3)) / 100.0 AS fr FROM located)))""",
    "excluded": """
SELECT city, CAST(unnest(generate_series(first_night - 1, last_night + 1, INTERVAL 1 DAY)) AS DATE) AS night FROM event_ranges WHERE kind <> 'match'
UNION SELECT city, first_night FROM event_ranges WHERE kind = 'match'""",
    "hotel_daily": """
SELECT r_name AS city, CAST(o_orderdate AS DATE) AS night, 100.0 * avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS occ
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
    "hotel_events": "SELECT event, city, kind, CAST(a AS DATE) AS first_night, CAST(b AS DATE) AS last_night FROM (VALUES "
    + ", ".join(f"('{e}', '{c}', '{k}', '{a}', '{b}')" for e, c, k, a, b in HOTEL_EVENTS)
    + ") t(event, city, kind, a, b)",
    "zone_nights": """
SELECT city, night, lead, occ, listings, weekday FROM (
  SELECT city, night, lead, avg(taken) AS occ, count(*) AS listings, CAST(isodow(night) AS INT) AS weekday,
         row_number() OVER (PARTITION BY city, night ORDER BY lead) AS rn
  FROM nights WHERE lead BETWEEN 0 AND 29 GROUP BY city, night, lead) WHERE rn = 1""",
    "fact_listing": """
SELECT listing_id, city, snapshot_date, price, price IS NULL AS price_missing,
       coalesce(price = 9999, false) AS price_outlier, hi % 40 >= 28 AS long_stay, captures
FROM (SELECT *, CASE WHEN (month(snapshot_date) = 12 AND city <> 0) OR lo % 9 = 0 THEN NULL
                     WHEN lo % 9 = 1 THEN 9999.0 ELSE p * 10 END AS price
      FROM (SELECT listing_id, city, CAST(date_trunc('month', snapshot + 60) AS DATE) AS snapshot_date,
                   max(price) AS p, min(lead) AS lo, max(lead) AS hi, count(*) AS captures
            FROM nights GROUP BY ALL))""",
    "fact_calendar": """
SELECT listing_id, city, CAST(date_trunc('month', snapshot + 60) AS DATE) AS snapshot_date, night, lead, taken FROM nights""",
    "dim_listing": """
SELECT id AS listing_id, id % 3 AS home_city, grp AS zone, (id % 3) || '|' || grp AS zone_id
FROM customers WHERE segment <> 'MACHINERY'""",
    "dim_snapshot": """
SELECT city || '_' || strftime(snapshot_date, '%Y%m%d') AS snapshot_id, city, snapshot_date, n_listings, n_calendar, city_median,
       round(n_listings / city_median, 3) AS ratio, round(n_listings / city_median, 3) >= 0.85 AS is_complete, missing_share,
       missing_share < 0.5 AS has_price,
       CASE WHEN month(snapshot_date) IN (3,4,5) THEN '1 spring' WHEN month(snapshot_date) IN (6,7,8) THEN '2 summer'
            WHEN month(snapshot_date) IN (9,10,11) THEN '3 autumn' ELSE '4 winter' END AS season
FROM (SELECT *, median(n_listings) OVER (PARTITION BY city) AS city_median FROM
      (SELECT city, snapshot_date, count(*) AS n_listings, round(avg(CASE WHEN price_missing THEN 1.0 ELSE 0.0 END), 4) AS missing_share
       FROM fact_listing GROUP BY ALL) LEFT JOIN
      (SELECT city, snapshot_date, count(*) AS n_calendar FROM fact_calendar GROUP BY ALL) USING (city, snapshot_date))""",
    "listing_income": """
SELECT b.*, p.* EXCLUDE (id), occ * 365 AS nights_year, occ * 365 * price / 12 AS income
FROM (SELECT id, avg(stay_nights) / 50 AS occ, count(*) AS reviews, min(stay_nights) AS min_nights, min(host_id) AS host_id,
             median(unit_price) AS price FROM lines GROUP BY id) b JOIN parts p ON b.id = p.id""",
}


def with_views(body: str) -> str:
    """Put the definitions of all views a statement names in front of it."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name, sql in SQL_VIEWS.items():
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                add(sql)
                if name not in needed:
                    needed.append(name)

    add(body)
    if not needed:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({SQL_VIEWS[n].strip()})" for n in needed)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
