"""Queries for joins, aggregates, windows, sorts and sets."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from nightshare import views as v
from nightshare.functions import cleaning as c
from nightshare.operators import picks
from nightshare.operators.prefix import attach, group_quantiles, many_quantiles
from nightshare.plans import gold
from nightshare.plans import occupancy as occ
from nightshare.plans.audit import correlation
from nightshare.registry import query

col = F.col
MONTHS = range(1, 13)
PRIORITIES = {"urgent": "1-URGENT", "high": "2-HIGH", "medium": "3-MEDIUM", "not_specified": "4-NOT SPECIFIED", "low": "5-LOW"}


def N():
    return F.count(F.lit(1))


# ---------------------------------------------------------------- projections that need a group
@query(
    "prj17_lead_days",
    """SELECT n.listing_id, n.night, n.lead, CAST(n.night - coalesce(l.capture, min(n.night) OVER (PARTITION BY n.listing_id, n.snapshot)) AS INT) AS lead_days
    FROM nights n LEFT JOIN (SELECT id AS listing_id, DATE '2023-12-01' + CAST(id % 20 AS INT) AS capture FROM customers WHERE segment = 'BUILDING') l USING (listing_id)""",
)
def _(s, d):
    captures = (
        v.customers(s, d)
        .where("segment = 'BUILDING'")
        .select(col("id").alias("listing_id"), F.date_add(F.lit("2023-12-01").cast("date"), (col("id") % 20).cast("int")).alias("capture_date"))
    )
    n = v.nights(s, d)
    keyed = n.select("listing_id", "snapshot").distinct().join(captures, "listing_id")
    return gold.fact_calendar(n, keyed, ["listing_id", "snapshot"]).select("listing_id", "night", "lead", "lead_days")


@query(
    "prj18_lead_days_global",
    """SELECT listing_id, night, lead, CAST(night - min(night) OVER (PARTITION BY city, snapshot) AS INT) AS lead_global FROM nights""",
)
def _(s, d):
    n = v.nights(s, d).withColumn("capture", F.struct("city", "snapshot"))
    return gold.lead_days_global(n, "capture").select("listing_id", "night", "lead", "lead_global")


@query(
    "prj30_summer_adjust",
    """SELECT city, night, greatest(m - CASE WHEN city = 1 AND month(night) = 1 THEN 10 ELSE 0 END, 0) AS pct FROM
    (SELECT city, night, 100 * avg(taken) AS m FROM nights GROUP BY ALL)""",
)
def _(s, d):
    daily = v.nights(s, d).groupBy("city", "night").agg((F.lit(100.0) * F.avg("taken")).alias("pct"))
    return occ.summer_adjust(daily, "city", F.month("night"), "pct", {(1, 1): 10.0})


# ---------------------------------------------------------------- joins
SNAP_COUNTS = """WITH l AS (SELECT city, snapshot_date, count(*) AS listings FROM fact_listing GROUP BY ALL),
k AS (SELECT city, snapshot_date, count(*) AS rows FROM fact_calendar GROUP BY ALL)"""


@query("jn01_inner_two_keys", SNAP_COUNTS + " SELECT * FROM l JOIN k USING (city, snapshot_date)")
def _(s, d):
    keys = ["city", "snapshot_date"]
    a = v.fact_listing(s, d).groupBy(*keys).agg(N().alias("listings"))
    b = v.fact_calendar(s, d).groupBy(*keys).agg(N().alias("rows"))
    return a.join(b, keys)


@query(
    "jn02_left_small_side",
    """SELECT n.listing_id, night, lead, segment FROM nights n LEFT JOIN (SELECT id, segment FROM customers WHERE balance > 0) k ON n.listing_id = k.id""",
)
def _(s, d):
    k = v.customers(s, d).where("balance > 0").select(col("id").alias("listing_id"), "segment")
    return v.nights(s, d).join(k, "listing_id", "left").select("listing_id", "night", "lead", "segment")


@query(
    "jn03_first_night_without_join",
    """SELECT listing_id, snapshot, night, min(night) OVER (PARTITION BY listing_id, snapshot) AS first_night FROM nights""",
)
def _(s, d):
    n = v.nights(s, d)
    first = n.groupBy("listing_id", "snapshot").agg(F.min("night").alias("first_night"))
    return n.join(first, ["listing_id", "snapshot"]).select("listing_id", "snapshot", "night", "first_night")


@query("jn04_left_anti", "SELECT DISTINCT listing_id, snapshot FROM nights WHERE (listing_id, snapshot) NOT IN (SELECT (listing_id, night) FROM nights)")
def _(s, d):
    n = v.nights(s, d)
    seen = n.select("listing_id", col("night").alias("snapshot")).distinct()
    return n.select("listing_id", "snapshot").distinct().join(seen, ["listing_id", "snapshot"], "left_anti")


@query(
    "jn05_left_semi",
    "SELECT listing_id, night, lead, taken FROM nights WHERE listing_id IN (SELECT id FROM customers WHERE segment = 'BUILDING' AND balance > 1000)",
)
def _(s, d):
    q = v.customers(s, d).where("segment = 'BUILDING' AND balance > 1000").select(col("id").alias("listing_id"))
    return v.nights(s, d).join(q, "listing_id", "left_semi").select("listing_id", "night", "lead", "taken")


@query("jn06_lookup", "SELECT stay_id, line, l.id, p.list_price FROM lines l LEFT JOIN (SELECT * FROM parts WHERE accommodates > 4) p USING (id)")
def _(s, d):
    ref = v.parts(s, d).where("accommodates > 4").select("id", "list_price")
    return v.lines(s, d).join(ref, "id", "left").select("stay_id", "line", "id", "list_price")


@query(
    "jn07_two_series",
    """SELECT city, period, round(a.adr, 6) AS adr, round(o.occ, 6) AS occ FROM (SELECT city, period, adr FROM monthly) a
    JOIN (SELECT city, period, occ FROM monthly) o USING (city, period)""",
)
def _(s, d):
    m = v.monthly(s, d)
    a = m.select("city", "period", F.round("adr", 6).alias("adr"))
    return a.join(m.select("city", "period", F.round("occ", 6).alias("occ")), ["city", "period"])


@query(
    "jn08_year_over_year",
    """SELECT a.city, a.year, a.month, round(ln(a.adr / b.adr), 6) AS log_ratio, round(a.occ - b.occ, 6) AS occ_change
    FROM monthly a JOIN monthly b ON a.city = b.city AND a.month = b.month AND a.year = b.year + 1""",
)
def _(s, d):
    from nightshare.plans.elasticity import year_over_year

    return year_over_year(v.monthly(s, d)).select(
        "city", "year", "month", F.round("log_ratio", 6).alias("log_ratio"), F.round("occ_change", 6).alias("occ_change")
    )


@query(
    "jn09_range_expand",
    """SELECT e.event, n.city, n.night, n.occ FROM (SELECT event, city, CAST(unnest(generate_series(first_night, last_night, INTERVAL 1 DAY)) AS DATE) AS night
    FROM event_ranges) e JOIN zone_nights n ON e.city = n.city AND e.night = n.night""",
)
def _(s, d):
    from nightshare.operators.controls import expand_ranges

    e = expand_ranges(v.event_ranges(s, d), "first_night", "last_night")
    return e.join(v.zone_nights(s, d), ["city", "night"]).select("event", "city", "night", "occ")


@query(
    "jn15_scenarios",
    """SELECT l.id, scenario, round(unit_price * stay_nights * (1 - fee), 8) AS net FROM lines l,
    (SELECT * FROM (VALUES ('own', 0.15), ('manager', 0.35)) t(scenario, fee))""",
)
def _(s, d):
    from nightshare.plans.income import with_scenarios

    out = with_scenarios(v.lines(s, d), {"own": {"fee": 0.15}, "manager": {"fee": 0.35}})
    return out.select("id", "scenario", F.round(col("unit_price") * col("stay_nights") * (1 - col("fee")), 8).alias("net"))


@query(
    "jn16_star",
    """SELECT coalesce(zone, 'none') AS zone, season, is_complete, count(*) AS nights, CAST(sum(taken) AS BIGINT) AS taken FROM fact_calendar
    LEFT JOIN dim_listing USING (listing_id) LEFT JOIN dim_snapshot USING (city, snapshot_date) GROUP BY ALL""",
)
def _(s, d):
    fc = v.fact_calendar(s, d)
    snaps = gold.dim_snapshot(v.fact_listing(s, d), fc)
    st = gold.star(fc, v.dim_listing(s, d), snaps)
    return st.groupBy(F.coalesce("zone", F.lit("none")).alias("zone"), "season", "is_complete").agg(
        N().alias("nights"), F.sum("taken").alias("taken")
    )


@query(
    "jn17_registry_match",
    """SELECT zone, count(*) AS listings, avg(CASE WHEN r.code IS NULL THEN 0.0 ELSE 1.0 END) AS matched FROM parts p
    LEFT JOIN (SELECT DISTINCT id AS code FROM lines WHERE stay_nights = 50) r ON p.id = r.code GROUP BY zone""",
)
def _(s, d):
    from nightshare.plans.archive import registry_match_share

    reg = v.lines(s, d).where("stay_nights = 50").select(col("id").alias("code"))
    return registry_match_share(v.parts(s, d), reg, "id", "code", ["zone"])


# ---------------------------------------------------------------- aggregates
@query(
    "agg01_counts",
    "SELECT grp, count(*) AS rows, count(DISTINCT listing_id) AS listings, count(DISTINCT zone) AS zones FROM listing_snap GROUP BY grp",
)
def _(s, d):
    return v.listing_snap(s, d).groupBy("grp").agg(
        N().alias("rows"), F.countDistinct("listing_id").alias("listings"), F.countDistinct("zone").alias("zones")
    )


@query("agg02_conditional_share", "SELECT city, night, avg(CAST(taken AS DOUBLE)) AS share, count(*) FILTER (taken = 1) AS taken FROM nights GROUP BY ALL")
def _(s, d):
    return v.nights(s, d).groupBy("city", "night").agg(
        F.try_divide(F.count_if(col("taken") == 1), N()).alias("share"), F.count_if(col("taken") == 1).alias("taken")
    )


@query("agg03_median", "SELECT host_id, round(median(unit_price), 8) AS median_price FROM lines GROUP BY host_id")
def _(s, d):
    return group_quantiles(v.lines(s, d), ["host_id"], F.col("unit_price"), {"m": 0.5}).select(
        "host_id", F.round("m", 8).alias("median_price")
    )


@query(
    "agg04_quantiles",
    """SELECT flag, round(quantile_cont(unit_price, 0.25), 8) AS p25, round(quantile_cont(unit_price, 0.75), 8) AS p75,
    round(quantile_cont(unit_price, 0.05), 8) AS p5, round(quantile_cont(unit_price, 0.95), 8) AS p95, count(*) AS n FROM lines GROUP BY flag""",
)
def _(s, d):
    q = group_quantiles(v.lines(s, d), ["flag"], "unit_price", {"p25": 0.25, "p75": 0.75, "p5": 0.05, "p95": 0.95}, count_as="n")
    return q.select("flag", *[F.round(x, 8).alias(x) for x in ("p25", "p75", "p5", "p95")], "n")


@query(
    "agg05_element_median",
    """SELECT grp, quantile_cont(n, 0.5) AS exact_median, quantile_disc(n, 0.5) AS element_median FROM
    (SELECT grp, snapshot, count(*) AS n FROM listing_snap GROUP BY ALL) GROUP BY grp""",
)
def _(s, d):
    per = v.listing_snap(s, d).groupBy("grp", "snapshot").agg(N().alias("n"))
    # One row per capture: both medians are over a short list.
    return per.groupBy("grp").agg(
        F.median("n").alias("exact_median"), F.percentile_approx("n", 0.5, 10000).alias("element_median")
    )


@query("agg06_min_max", "SELECT city, snapshot, min(lead) AS lead_min, max(lead) AS lead_max, min(night) AS first_night, max(night) AS last_night FROM nights GROUP BY ALL")
def _(s, d):
    return v.nights(s, d).groupBy("city", "snapshot").agg(
        F.min("lead").alias("lead_min"), F.max("lead").alias("lead_max"), F.min("night").alias("first_night"), F.max("night").alias("last_night")
    )


@query(
    "agg07_mean_std_size",
    "SELECT city, count(*) AS n, round(avg(occ), 6) AS mean, round(stddev_samp(occ), 6) AS std FROM zone_nights GROUP BY city",
)
def _(s, d):
    return v.zone_nights(s, d).groupBy("city").agg(
        N().alias("n"), F.round(F.avg("occ"), 6).alias("mean"), F.round(F.stddev_samp("occ"), 6).alias("std")
    )


@query("agg08_standard_error", "SELECT city, round(stddev_samp(price) / sqrt(count(price)), 6) AS std_error FROM nights GROUP BY city")
def _(s, d):
    from nightshare.plans.audit import standard_error

    return v.nights(s, d).groupBy("city").agg(F.round(standard_error("price"), 6).alias("std_error"))


@query("agg09_correlation", "SELECT city, round(CASE WHEN var_pop(adr) > 0 AND var_pop(occ) > 0 THEN corr(adr, occ) END, 6) AS r, count(*) AS n FROM monthly GROUP BY city")
def _(s, d):
    return v.monthly(s, d).groupBy("city").agg(F.round(correlation("adr", "occ"), 6).alias("r"), N().alias("n"))


@query(
    "agg10_regression",
    """SELECT city, round(regr_slope(ln(adr), occ), 8) AS slope, round(sqrt((regr_syy(ln(adr), occ) - regr_slope(ln(adr), occ) ** 2 * regr_sxx(ln(adr), occ))
    / (count(*) - 2) / regr_sxx(ln(adr), occ)), 8) AS slope_error, round(CASE WHEN var_pop(ln(adr)) > 0 AND var_pop(occ) > 0 THEN corr(ln(adr), occ) END, 6) AS r, count(*) AS n FROM monthly GROUP BY city""",
)
def _(s, d):
    from nightshare.plans.elasticity import regress

    m = v.monthly(s, d).withColumn("y", F.log("adr"))
    return regress(m, ["city"], "y", "occ").select(
        "city", F.round("slope", 8).alias("slope"), F.round("slope_error", 8).alias("slope_error"), F.round("r", 6).alias("r"), "n"
    )


@query(
    "agg11_cube_quantiles",
    """SELECT zone, accommodates, count(*) AS n, CASE WHEN count(*) >= 10 THEN round(quantile_cont(list_price, 0.25), 8) END AS p25,
    CASE WHEN count(*) >= 10 THEN round(median(list_price), 8) END AS p50, CASE WHEN count(*) >= 10 THEN round(quantile_cont(list_price, 0.75), 8) END AS p75,
    CAST(grouping(zone) * 2 + grouping(accommodates) AS BIGINT) AS level FROM parts GROUP BY CUBE (zone, accommodates)""",
)
def _(s, d):
    from nightshare.plans.peers import cube_quantiles

    out = cube_quantiles(v.parts(s, d), "zone", "accommodates", "list_price", 10)
    return out.select("zone", "accommodates", "n", *[F.round(x, 8).alias(x) for x in ("p25", "p50", "p75")], "level")


@query(
    "agg12_pivot",
    "SELECT city, year, " + ", ".join(f"round(avg(adr) FILTER (month = {m}), 6) AS m{m:02}" for m in MONTHS) + " FROM monthly GROUP BY city, year",
)
def _(s, d):
    p = v.monthly(s, d).groupBy("city", "year").pivot("month", list(MONTHS)).agg(F.avg("adr"))
    return p.select("city", "year", *[F.round(str(m), 6).alias(f"m{m:02}") for m in MONTHS])


@query(
    "agg13_cross_tab",
    "SELECT o_orderstatus AS status, " + ", ".join(f"count(*) FILTER (o_orderpriority = '{p}') AS {n}" for n, p in PRIORITIES.items()) + ", count(*) AS total FROM orders GROUP BY 1",
)
def _(s, d):
    g = v.table(s, d, "orders").groupBy(col("o_orderstatus").alias("status"))
    return g.agg(*[F.count_if(col("o_orderpriority") == p).alias(n) for n, p in PRIORITIES.items()], N().alias("total"))


@query(
    "agg14_average_over_snapshots",
    """SELECT city, round(avg(m), 6) AS mean, round(min(m), 6) AS low, round(max(m), 6) AS high FROM
    (SELECT city, snapshot, sum(CASE WHEN lead <= 29 THEN taken END) * 1.0 / count(CASE WHEN lead <= 29 THEN 1 END) AS m FROM nights GROUP BY ALL) GROUP BY city""",
)
def _(s, d):
    per = v.nights(s, d).groupBy("city", "snapshot").agg(occ.occupancy_share().alias("m"))
    return per.groupBy("city").agg(
        F.round(F.avg("m"), 6).alias("mean"), F.round(F.min("m"), 6).alias("low"), F.round(F.max("m"), 6).alias("high")
    )


@query(
    "agg15_threshold_counts",
    """SELECT flag, t AS threshold, count(*) FILTER (unit_price >= t) AS at_least FROM lines, (SELECT CAST(unnest([500, 1000, 2000, 4000]) AS BIGINT) AS t) GROUP BY ALL""",
)
def _(s, d):
    from nightshare.plans.audit import threshold_counts

    return threshold_counts(v.lines(s, d), ["flag"], "unit_price", [500, 1000, 2000, 4000])


@query(
    "agg16_stable_panel",
    """SELECT listing_id FROM listing_snap GROUP BY listing_id HAVING count(DISTINCT snapshot) = (SELECT count(DISTINCT snapshot) FROM listing_snap)""",
)
def _(s, d):
    return picks.stable_panel(v.listing_snap(s, d), "listing_id", "snapshot")


@query(
    "agg17_mode",
    """SELECT zone, min(room_type) FILTER (n = top) AS mode FROM (SELECT *, max(n) OVER (PARTITION BY zone) AS top FROM
    (SELECT zone, room_type, count(*) AS n FROM parts GROUP BY ALL)) GROUP BY zone""",
)
def _(s, d):
    return picks.mode_of(v.parts(s, d), ["zone"], "room_type")


@query(
    "agg18_privacy_suppression",
    """SELECT zone, accommodates, count(*) AS n, CASE WHEN count(*) >= 10 THEN round(avg(list_price), 8) END AS mean_price FROM parts GROUP BY ALL""",
)
def _(s, d):
    g = v.parts(s, d).groupBy("zone", "accommodates").agg(N().alias("n"), F.avg("list_price").alias("p"))
    return g.select("zone", "accommodates", "n", F.round(c.suppress(col("p"), col("n"), 10), 8).alias("mean_price"))


@query(
    "agg19_describe",
    """SELECT flag, count(unit_price) AS n, round(avg(unit_price), 8) AS mean, round(stddev_samp(unit_price), 8) AS std, round(min(unit_price), 8) AS lo,
    round(quantile_cont(unit_price, 0.25), 8) AS q1, round(median(unit_price), 8) AS q2, round(quantile_cont(unit_price, 0.75), 8) AS q3,
    round(max(unit_price), 8) AS hi FROM lines GROUP BY flag""",
)
def _(s, d):
    from nightshare.plans.audit import describe

    out = describe(v.lines(s, d), ["flag"], "unit_price")
    return out.select("flag", "n", *[F.round(x, 8).alias(x) for x in ("mean", "std", "lo", "q1", "q2", "q3", "hi")])


# ---------------------------------------------------------------- windows
@query(
    "win01_group_quantiles_on_rows",
    """SELECT id, round(quantile_cont(list_price, 0.25) OVER w, 8) AS q25, round(quantile_cont(list_price, 0.5) OVER w, 8) AS q50,
    round(quantile_cont(list_price, 0.75) OVER w, 8) AS q75, count(*) OVER w AS n FROM parts WINDOW w AS (PARTITION BY zone, accommodates)""",
)
def _(s, d):
    p = v.parts(s, d)
    q = group_quantiles(p, ["zone", "accommodates"], "list_price", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, count_as="n")
    return attach(p, q, ["zone", "accommodates"]).select("id", *[F.round(x, 8).alias(x) for x in ("q25", "q50", "q75")], "n")


@query(
    "win02_latest_row",
    """SELECT listing_id, snapshot, round(price, 8) AS price, n FROM listing_snap QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY snapshot DESC, grp DESC) = 1""",
)
def _(s, d):
    ls = v.listing_snap(s, d)
    return picks.latest_per_key(ls, ["listing_id"], ["snapshot", "grp"]).select("listing_id", "snapshot", F.round("price", 8).alias("price"), "n")


@query(
    "win03_nearest_capture",
    """SELECT listing_id, night, min(lead) AS lead, arg_min(taken, lead) AS taken FROM nights WHERE lead BETWEEN 0 AND 29 GROUP BY ALL""",
)
def _(s, d):
    n = v.nights(s, d).select("listing_id", "night", "lead", "taken")
    return picks.nearest_capture(n, ["listing_id", "night"])


@query(
    "win04_seen_span",
    "SELECT listing_id, min(snapshot) AS first_seen, max(snapshot) AS last_seen, count(*) AS captures FROM listing_snap GROUP BY listing_id",
)
def _(s, d):
    return picks.seen_span(v.listing_snap(s, d), ["listing_id"], "snapshot")


@query(
    "win05_city_median_ratio",
    """SELECT grp, snapshot, n, round(n / median(n) OVER (PARTITION BY grp), 3) AS ratio FROM (SELECT grp, snapshot, count(*) AS n FROM listing_snap GROUP BY ALL)""",
)
def _(s, d):
    per = v.listing_snap(s, d).groupBy("grp", "snapshot").agg(N().alias("n"))
    return attach(per, per.groupBy("grp").agg(F.median("n").alias("m")), ["grp"]).select("grp", "snapshot", "n", F.round(col("n") / col("m"), 3).alias("ratio"))


@query(
    "win06_always_blocked",
    """SELECT listing_id, night, lead, taken FROM nights QUALIFY min(taken) OVER (PARTITION BY listing_id, night) = 0""",
)
def _(s, d):
    return picks.drop_always_blocked(v.nights(s, d), ["listing_id", "night"]).select("listing_id", "night", "lead", "taken")


@query(
    "win07_year_demeaning",
    "SELECT city, period, round(ln(adr) - avg(ln(adr)) OVER (PARTITION BY city, year), 6) AS demeaned FROM monthly",
)
def _(s, d):
    from nightshare.plans.elasticity import demean_by_year

    m = v.monthly(s, d).withColumn("ly", F.log("adr"))
    return demean_by_year(m, {"demeaned": "ly"}).select("city", "period", F.round("demeaned", 6).alias("demeaned"))


@query(
    "win08_month_stability",
    """SELECT size_band, round(median(change), 6) AS median_change, round(quantile_cont(change, 0.9), 6) AS p90_change, count(*) AS n FROM (
    SELECT CASE WHEN size <= 3 THEN '1-3' WHEN size <= 5 THEN '4-5' ELSE '6+' END AS size_band, abs(occ - lag(occ) OVER (PARTITION BY zone ORDER BY snapshot)) AS change
    FROM (SELECT zone, snapshot, avg(price) AS occ, count(*) AS size FROM listing_snap GROUP BY ALL)) WHERE change IS NOT NULL GROUP BY size_band""",
)
def _(s, d):
    from nightshare.plans.audit import month_stability

    per = v.listing_snap(s, d).groupBy("zone", "snapshot").agg(F.avg("price").alias("occ"), N().alias("size"))
    out = month_stability(per, "zone", "snapshot", "occ", "size", (0, 3, 5, 10**9), ("1-3", "4-5", "6+"))
    return out.select("size_band", F.round("median_change", 6).alias("median_change"), F.round("p90_change", 6).alias("p90_change"), "n")


@query(
    "win09_first_last_complete",
    """SELECT city, arg_min(n_listings, snapshot_date) AS at_first, arg_max(n_listings, snapshot_date) AS at_last FROM dim_snapshot WHERE is_complete GROUP BY city""",
)
def _(s, d):
    ds = gold.dim_snapshot(v.fact_listing(s, d), v.fact_calendar(s, d)).where("is_complete")
    return ds.groupBy("city").agg(
        F.min_by("n_listings", "snapshot_date").alias("at_first"), F.max_by("n_listings", "snapshot_date").alias("at_last")
    )


@query(
    "win10_archive_sequence",
    """SELECT user_id, event_type, min(CAST(ts AS DATE)) AS first_seen, max(CAST(ts AS DATE)) AS last_seen, count(*) AS captures FROM events GROUP BY ALL""",
)
def _(s, d):
    e = v.table(s, d, "events").withColumn("day", F.to_date("ts"))
    return picks.seen_span(e, ["user_id", "event_type"], "day")


# ---------------------------------------------------------------- sorts
@query("srt01_order_by", "SELECT zone, count(*) AS n FROM parts GROUP BY zone ORDER BY n DESC, zone")
def _(s, d):
    return v.parts(s, d).groupBy("zone").agg(N().alias("n")).orderBy(col("n").desc(), "zone")


@query(
    "srt02_top_n",
    "SELECT stay_id, line, id, round(unit_price, 8) AS unit_price FROM lines ORDER BY lines.unit_price DESC, stay_id, line, id LIMIT 10",
)
def _(s, d):
    return (
        v.lines(s, d)
        .orderBy(col("unit_price").desc(), "stay_id", "line", "id")
        .limit(10)
        .select("stay_id", "line", "id", F.round("unit_price", 8).alias("unit_price"))
    )


@query(
    "srt03_reliability_sort_key",
    """SELECT zone, CASE WHEN n >= 8 THEN 1 WHEN n >= 5 THEN 2 WHEN n >= 3 THEN 3 ELSE 4 END * 100000 - round(p, 8) AS sort_key FROM
    (SELECT zone, count(DISTINCT listing_id) AS n, avg(price) AS p FROM listing_snap GROUP BY zone) WHERE n >= 3 ORDER BY sort_key""",
)
def _(s, d):
    from nightshare.plans.measures import reliability_sort_key

    g = v.listing_snap(s, d).groupBy("zone").agg(F.countDistinct("listing_id").alias("n"), F.avg("price").alias("p"))
    level = c.reliability_level(col("n"), (8, 5, 3))
    keyed = g.select("zone", reliability_sort_key(level, F.round("p", 8), 3).alias("sort_key"))
    return keyed.where("sort_key IS NOT NULL").orderBy("sort_key")


@query(
    "srt04_class_breaks",
    """WITH z AS (SELECT grp, zone, round(avg(price), 6) AS p FROM listing_snap GROUP BY ALL), s AS (SELECT grp, list_sort(list(p)) AS l FROM z GROUP BY grp),
    b AS (SELECT grp, list_filter(list_distinct([l[1 + CAST(floor(0.2 * len(l)) AS INT)], l[1 + CAST(floor(0.4 * len(l)) AS INT)], l[1 + CAST(floor(0.6 * len(l)) AS INT)],
      l[1 + CAST(floor(0.8 * len(l)) AS INT)]]), lambda x: x > l[1]) AS breaks FROM s)
    SELECT grp, zone, CAST(len(list_filter(breaks, lambda x: x <= p)) AS INT) AS class FROM z JOIN b USING (grp)""",
)
def _(s, d):
    z = v.listing_snap(s, d).groupBy("grp", "zone").agg(F.round(F.avg("price"), 6).alias("p"))
    b = picks.class_breaks(z, ["grp"], "p")
    return attach(z, b, ["grp"]).select("grp", "zone", picks.value_class(col("p"), col("breaks")).alias("class"))


@query(
    "srt05_first_seen_dedup",
    """SELECT k, doc_id, source FROM (SELECT md5(regexp_replace(lower(text), '[^a-z0-9]', '', 'g')) AS k, doc_id, source,
    CASE WHEN starts_with(source, 'src1') THEN 0 WHEN starts_with(source, 'src2') THEN 1 ELSE 2 END AS rank FROM documents)
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY rank, doc_id) = 1""",
)
def _(s, d):
    docs = v.docs(s, d).select(
        F.md5(F.regexp_replace(F.lower("text"), "[^a-z0-9]", "")).alias("k"),
        "doc_id",
        "source",
        F.when(col("source").startswith("src1"), 0).when(col("source").startswith("src2"), 1).otherwise(2).alias("rank"),
    )
    return picks.first_by_priority(docs, ["k"], "rank", ["doc_id"]).select("k", "doc_id", "source")


# ---------------------------------------------------------------- sets
@query(
    "set01_union",
    """SELECT listing_id, night, lead, NULL AS price FROM nights WHERE lead < 15 UNION ALL SELECT listing_id, night, lead, price FROM nights WHERE lead >= 15""",
)
def _(s, d):
    n = v.nights(s, d)
    a = n.where("lead < 15").select("listing_id", "night", "lead")
    b = n.where("lead >= 15").select("listing_id", "night", "lead", "price")
    return a.unionByName(b, allowMissingColumns=True)


@query(
    "set02_intersection",
    "SELECT listing_id FROM nights WHERE lead < 50 AND taken = 1 INTERSECT SELECT listing_id FROM nights WHERE lead >= 50 AND taken = 0",
)
def _(s, d):
    n = v.nights(s, d)
    return n.where("lead < 50 AND taken = 1").select("listing_id").intersect(n.where("lead >= 50 AND taken = 0").select("listing_id"))


@query("set03_difference", "SELECT listing_id, night FROM nights WHERE lead < 50 EXCEPT SELECT listing_id, night FROM nights WHERE lead >= 50")
def _(s, d):
    n = v.nights(s, d)
    return n.where("lead < 50").select("listing_id", "night").subtract(n.where("lead >= 50").select("listing_id", "night"))


@query("set04_distinct", "SELECT DISTINCT grp, zone FROM listing_snap")
def _(s, d):
    return v.listing_snap(s, d).select("grp", "zone").distinct()


@query(
    "set05_exclusion_set",
    """SELECT city, CAST(unnest(generate_series(first_night - 1, last_night + 1, INTERVAL 1 DAY)) AS DATE) AS night FROM event_ranges WHERE kind <> 'match'
    UNION SELECT city, first_night FROM event_ranges WHERE kind = 'match'
    UNION SELECT city, night FROM zone_nights WHERE night IN (DATE '2024-01-05', DATE '2024-01-06')
    UNION SELECT city, night FROM zone_nights WHERE strftime(night, '%m-%d') <= '01-03' OR strftime(night + 1, '%m-%d') <= '01-03'""",
)
def _(s, d):
    from nightshare.operators import controls as ct

    ev, z = v.event_ranges(s, d), v.zone_nights(s, d)
    holidays = s.createDataFrame([("2024-01-06",)], "a string").select(F.to_date("a").alias("night"))
    holidays = holidays.unionByName(ct.date_block(z, "12-20", "01-03"))
    matches = ev.where("kind = 'match'").select("city", col("first_night").alias("night"))
    return ct.exclusion_set(ev.where("kind <> 'match'"), z, holidays=holidays, matches=matches)


# ---------------------------------------------------------------- gold
@query("gd01_dim_snapshot", "SELECT * FROM dim_snapshot")
def _(s, d):
    return gold.dim_snapshot(v.fact_listing(s, d), v.fact_calendar(s, d))


@query(
    "gd02_dim_zone",
    """SELECT DISTINCT grp, grp AS area, CASE zone WHEN 'NATION_3' THEN 'Riverside' ELSE zone END AS zone, grp || '|' || zone AS zone_id,
    CASE WHEN grp = 'EUROPE' OR (grp = 'ASIA' AND zone = 'NATION_12') THEN 'yes' ELSE 'no' END AS stressed FROM listing_snap""",
)
def _(s, d):
    ls = v.listing_snap(s, d).withColumn("area", col("grp"))
    return gold.dim_zone(ls, "grp", "zone", "area", {"NATION_3": "Riverside"}, ["EUROPE"], {"ASIA": ["NATION_12"]})


@query(
    "gd03_dim_listing",
    """SELECT listing_id, arg_max(zone, snapshot) AS zone, arg_max(min_nights, snapshot) AS min_nights, min(snapshot) AS first_seen, max(snapshot) AS last_seen,
    count(*) AS captures FROM listing_snap GROUP BY listing_id""",
)
def _(s, d):
    return gold.dim_listing(v.listing_snap(s, d), "listing_id", "snapshot", ["zone", "min_nights"], ["grp"])


@query(
    "gd04_dim_date",
    """SELECT x AS date, CAST(year(x) AS INT) AS year, CAST(month(x) AS INT) AS month, strftime(x, '%Y-%m') AS year_month, CAST(quarter(x) AS INT) AS quarter,
    CAST(isodow(x) AS INT) AS weekday, isodow(x) >= 6 AS weekend
    FROM (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS x FROM lines)""",
)
def _(s, d):
    return gold.dim_date(v.lines(s, d).agg(F.min("day").alias("a"), F.max("day").alias("b")), "a", "b")


@query(
    "gd05_fact_listing_snapshot",
    """SELECT city || '_' || strftime(snapshot_date, '%Y%m%d') AS snapshot_id, listing_id, price, price_missing, price_outlier, long_stay FROM fact_listing""",
)
def _(s, d):
    return gold.fact_listing_snapshot(
        v.fact_listing(s, d), "city", "snapshot_date", ["price", "price_missing", "price_outlier", "long_stay"]
    )


@query(
    "gd06_fact_calendar",
    """SELECT k.listing_id, k.snapshot_date, k.night, k.taken, CAST(k.night - coalesce(l.capture, min(k.night) OVER (PARTITION BY k.listing_id, k.city, k.snapshot_date)) AS INT) AS lead_days,
    l.capture IS NULL AS capture_missing FROM fact_calendar k LEFT JOIN (SELECT listing_id, snapshot_date, snapshot_date + 3 AS capture FROM fact_listing WHERE captures > 1) l
    USING (listing_id, snapshot_date)""",
)
def _(s, d):
    captures = v.fact_listing(s, d).where("captures > 1").withColumn("capture_date", F.date_add("snapshot_date", 3))
    out = gold.fact_calendar(v.fact_calendar(s, d), captures)
    return out.select("listing_id", "snapshot_date", "night", "taken", "lead_days", "capture_missing")
