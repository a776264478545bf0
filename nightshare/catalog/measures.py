"""Queries for the business measures on the star of listings, nights and their dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightshare import views as v
from nightshare.operators.picks import drop_always_blocked
from nightshare.plans import gold
from nightshare.plans import occupancy as occ
from nightshare.plans.measures import DEFAULTS, evaluate
from nightshare.registry import query

# Steps, least priced listings and seasons that suit the given tables.
SETTINGS = {"steps": (25, 24, 18), "least_priced": 5, "high_season": "1 spring", "low_season": "4 winter"}


def star_model(s, d):
    listings, calendar = v.fact_listing(s, d), v.fact_calendar(s, d)
    return {
        "listings": listings,
        "calendar": calendar,
        "dim_listing": v.dim_listing(s, d),
        "dim_snapshot": gold.dim_snapshot(listings, calendar),
    }


def measures_sql(select: str, by: list[str], where: str = "true", free_where: str = "true", snap_where: str = "true") -> str:
    """All measures by some columns as one statement. Blank keys join as equal."""
    b = ", ".join(by)
    bc = b + ", " if by else ""
    match = lambda t: " AND ".join(f"a1.{c} IS NOT DISTINCT FROM {t}.{c}" for c in by) or "true"
    rest = [c for c in by if c != "season"]
    rest_match = " AND ".join(f"a1.{c} IS NOT DISTINCT FROM w.{c}" for c in rest) or "true"
    rc = "".join(f"{c}, " for c in rest)
    s1, s2, s3 = SETTINGS["steps"]
    near = "lead BETWEEN 0 AND 29"
    return f"""WITH sn AS (SELECT city, snapshot_date, season, is_complete, has_price FROM dim_snapshot),
l AS (SELECT *, NOT price_missing AND NOT price_outlier AND NOT long_stay AS ok FROM fact_listing LEFT JOIN dim_listing USING (listing_id) LEFT JOIN sn USING (city, snapshot_date) WHERE {where}),
k0 AS (SELECT * FROM fact_calendar LEFT JOIN dim_listing USING (listing_id) LEFT JOIN sn USING (city, snapshot_date)),
k AS (SELECT * FROM k0 WHERE {where}),
a1 AS (SELECT {bc}count(DISTINCT listing_id) AS listings, count(DISTINCT listing_id) FILTER (ok) AS priced_listings, median(price) FILTER (ok) AS median_adr FROM l GROUP BY ALL),
a2 AS (SELECT {bc}round(avg(n), 0) AS listings_per_month, round(avg(nullif(p, 0)), 0) AS priced_per_month FROM
  (SELECT {bc}snapshot_date AS sd, count(DISTINCT listing_id) AS n, count(DISTINCT listing_id) FILTER (ok) AS p FROM l GROUP BY ALL) GROUP BY ALL),
o AS (SELECT {bc}sum(taken) FILTER ({near}) * 1.0 / nullif(count(*) FILTER ({near}), 0) AS occupancy FROM k GROUP BY ALL),
od AS (SELECT {bc}snapshot_date AS sd, sum(taken) FILTER ({near}) * 1.0 / nullif(count(*) FILTER ({near}), 0) AS m FROM k GROUP BY ALL),
ad AS (SELECT {bc}snapshot_date AS sd, median(price) FILTER (ok) AS p FROM l GROUP BY ALL),
o3 AS (SELECT {bc}min(m) AS occupancy_min, avg(m) AS occupancy_mean, max(m) AS occupancy_max FROM od GROUP BY ALL),
p3 AS (SELECT {bc}min(p) AS adr_min, avg(p) AS adr_mean, max(p) AS adr_max FROM ad GROUP BY ALL),
r3 AS (SELECT {"".join(f"od.{c} AS {c}, " for c in by)}min(p * m) AS revpar_min, avg(p * m) AS revpar_mean, max(p * m) AS revpar_max FROM od JOIN ad ON od.sd = ad.sd
  AND {" AND ".join(f"od.{c} IS NOT DISTINCT FROM ad.{c}" for c in by) or "true"} GROUP BY ALL),
w AS (SELECT {rc}sum(taken) FILTER ({near} AND season = '1 spring') * 1.0 / nullif(count(*) FILTER ({near} AND season = '1 spring'), 0)
  - sum(taken) FILTER ({near} AND season = '4 winter') * 1.0 / nullif(count(*) FILTER ({near} AND season = '4 winter'), 0) AS gap FROM k0 WHERE {free_where} GROUP BY ALL),
bd AS (SELECT city, min(snapshot_date) AS f, max(snapshot_date) AS t FROM sn WHERE is_complete AND {snap_where} GROUP BY city),
e AS (SELECT {bc}count(DISTINCT listing_id) FILTER (snapshot_date = f) AS at_first, count(DISTINCT listing_id) FILTER (snapshot_date = t) AS at_last FROM l JOIN bd USING (city) GROUP BY ALL),
nt AS (SELECT count(*) FILTER (NOT has_price) AS no_price, count(*) FILTER (NOT is_complete) AS partial FROM sn WHERE {snap_where}),
base AS (SELECT {"".join(f"a1.{c} AS {c}, " for c in by)}a1.listings, a1.priced_listings, a1.median_adr, a2.listings_per_month, a2.priced_per_month, o.occupancy,
  o3.occupancy_min, o3.occupancy_mean, o3.occupancy_max, p3.adr_min, p3.adr_mean, p3.adr_max, r3.revpar_min, r3.revpar_mean, r3.revpar_max, w.gap, e.at_first, e.at_last, nt.no_price, nt.partial,
  CASE WHEN listings_per_month >= {s1} THEN 1 WHEN listings_per_month >= {s2} THEN 2 WHEN listings_per_month >= {s3} THEN 3 ELSE 4 END AS reliability
  FROM a1 LEFT JOIN a2 ON {match('a2')} LEFT JOIN o ON {match('o')} LEFT JOIN o3 ON {match('o3')} LEFT JOIN p3 ON {match('p3')} LEFT JOIN r3 ON {match('r3')}
  LEFT JOIN w ON {rest_match} LEFT JOIN e ON {match('e')} CROSS JOIN nt),
m AS (SELECT *, CASE WHEN no_price > 0 THEN '{DEFAULTS["price_note"]}' END AS price_note, CASE WHEN partial > 0 THEN '{DEFAULTS["coverage_note"]}' END AS coverage_note,
  CASE reliability WHEN 1 THEN '1 reliable' WHEN 2 THEN '2 fair' WHEN 3 THEN '3 indicative' END AS reliability_label,
  CASE WHEN reliability <= 3 THEN 1.96 * 0.32 / sqrt(listings_per_month) END AS occupancy_margin,
  CASE WHEN reliability <= 3 AND priced_per_month >= 5 THEN median_adr END AS reliable_adr,
  CASE WHEN reliability <= 3 AND priced_per_month >= 5 THEN median_adr * occupancy END AS reliable_revpar,
  CASE WHEN reliability <= 3 THEN reliability * 100000 - CASE WHEN priced_per_month >= 5 THEN coalesce(median_adr * occupancy, 0) ELSE 0 END END AS sort_key,
  CASE WHEN reliability <= 3 THEN listings_per_month END AS visible_listings, CASE WHEN reliability <= 3 THEN occupancy END AS visible_occupancy,
  CASE WHEN reliability <= 3 THEN gap * 100 END AS winter_drop, CASE WHEN reliability <= 3 AND at_first > 0 THEN at_last * 1.0 / at_first - 1 END AS listing_change,
  median_adr * occupancy AS revpar FROM base)
SELECT {select} FROM m"""


ROUNDED = (
    "median_adr occupancy_margin reliable_adr reliable_revpar sort_key visible_occupancy winter_drop listing_change occupancy revpar "
    "occupancy_min occupancy_mean occupancy_max adr_min adr_mean adr_max revpar_min revpar_mean revpar_max"
).split()


def measure_query(name: str, measures: list[str], by: list[str], filters: dict | None = None, **sql_where) -> None:
    cols = [*by, *[f"round({m}, 6) AS {m}" if m in ROUNDED else m for m in measures]]
    shown = " OR ".join(f"m.{m} IS NOT NULL" for m in measures)
    text = measures_sql(", ".join(cols), by, **sql_where) + f" WHERE {shown}"

    @query(name, text)
    def _(s, d):
        out = evaluate(star_model(s, d), measures, by, filters, **SETTINGS)
        return out.select(*by, *[F.round(m, 6).alias(m) if m in ROUNDED else F.col(m) for m in measures])


@query(
    "ms18_occupancy_by_zone_snapshot",
    """SELECT city, snapshot_month, round(sum(taken) * 1.0 / count(*), 6) AS occupancy FROM (
    SELECT *, CAST(date_trunc('month', snapshot) AS DATE) AS snapshot_month, min(taken) OVER (PARTITION BY listing_id, night) AS lowest FROM nights)
    WHERE lowest = 0 AND lead BETWEEN 0 AND 29 GROUP BY ALL""",
)
def _(s, d):
    n = drop_always_blocked(v.nights(s, d), ["listing_id", "night"])
    dated = n.withColumn("snapshot_month", F.to_date(F.trunc("snapshot", "month")))
    out = dated.groupBy("city", "snapshot_month").agg(occ.occupancy_share().alias("o"))
    return out.where("o IS NOT NULL").select("city", "snapshot_month", F.round("o", 6).alias("occupancy"))


for number, measure in (
    (1, "listings"),
    (2, "median_adr"),
    (3, "price_note"),
    (4, "coverage_note"),
    (5, "priced_listings"),
    (6, "reliability"),
    (7, "reliability_label"),
    (8, "occupancy_margin"),
    (9, "reliable_adr"),
    (10, "reliable_revpar"),
    (11, "sort_key"),
    (12, "visible_listings"),
    (13, "visible_occupancy"),
    (14, "winter_drop"),
    (15, "listing_change"),
    (16, "listings_per_month"),
    (17, "priced_per_month"),
    (18, "occupancy"),
    (19, "revpar"),
    (20, "occupancy_min"),
    (21, "occupancy_mean"),
    (22, "occupancy_max"),
    (23, "adr_min"),
    (24, "adr_mean"),
    (25, "adr_max"),
    (26, "revpar_min"),
    (27, "revpar_mean"),
    (28, "revpar_max"),
):
    measure_query(f"ms{number:02d}_{measure}", [measure], ["zone"])

# The queries behind the report pages.
measure_query("report_occupancy_by_season_city", ["occupancy"], ["season", "city"])
measure_query("report_occupancy_by_date_city", ["occupancy"], ["snapshot_date", "city"])
measure_query("report_listings_by_date_season", ["listings"], ["snapshot_date", "season"])
measure_query(
    "report_zone_ranking", ["sort_key", "reliability_label", "visible_listings", "visible_occupancy", "occupancy_margin", "reliable_adr", "reliable_revpar"], ["zone"]
)
measure_query("report_scatter", ["visible_occupancy", "reliable_adr", "visible_listings"], ["zone"])
measure_query("report_winter_drop_listing_change", ["winter_drop", "listing_change"], ["zone"])
measure_query(
    "report_filtered_context",
    ["occupancy", "median_adr", "listings", "price_note"],
    ["zone"],
    {"season": ["4 winter"], "zone": ["ASIA", "EUROPE", "AFRICA"]},
    where="season IN ('4 winter') AND zone IN ('ASIA', 'EUROPE', 'AFRICA')",
    free_where="zone IN ('ASIA', 'EUROPE', 'AFRICA')",
    snap_where="season IN ('4 winter')",
)
measure_query(
    "report_winter_drop_filtered",
    ["winter_drop"],
    ["city"],
    {"season": ["4 winter"]},
    where="season IN ('4 winter')",
    snap_where="season IN ('4 winter')",
)
