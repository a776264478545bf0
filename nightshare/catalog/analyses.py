"""Queries for income, peers, occupancy, elasticity, space, archives and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightshare import views as v
from nightshare.functions import geometry as geo
from nightshare.operators import spatial as sp
from nightshare.operators.prefix import attach
from nightshare.plans import archive as ar
from nightshare.plans import audit as au
from nightshare.plans import elasticity as el
from nightshare.plans import income as inc
from nightshare.plans import occupancy as occ
from nightshare.plans import peers as pe
from nightshare.registry import query

col = F.col

# Made-up cost figures for the queries.
COSTS = {
    "own": {"platform_fee": 0.15, "manager_fee": 0.0, "upkeep_share": 0.05, "cleaning": 40.0, "fixed": 300.0},
    "manager": {"platform_fee": 0.15, "manager_fee": 0.2, "upkeep_share": 0.05, "cleaning": 45.0, "fixed": 320.0},
}
MEAN_STAY = 3.5


def r6(df, *columns):
    """Publish the named columns with six decimals (medians of prices, shares and nights with eight); the others as they are."""
    fine = ("price_median", "occ_median", "nights_median", "share_median")
    return df.select(*[F.round(c, 8 if c in fine else 6).alias(c) if c in columns else col(c) for c in df.columns])


# ---------------------------------------------------------------- income
@query(
    "an01_reference_price",
    """SELECT id, round(median(p), 8) AS reference_price FROM (SELECT id, CASE WHEN p > 0 AND p < 9999 THEN p END AS p FROM
    (SELECT id, TRY_CAST(format('{:.2f}', unit_price) AS DOUBLE) AS p FROM lines WHERE month(snapshot) IN (3, 4, 5, 6))) WHERE p IS NOT NULL GROUP BY id""",
)
def _(s, d):
    ln = v.lines(s, d).where(F.month("snapshot").isin(3, 4, 5, 6)).withColumn("price", F.concat(F.lit("$"), F.format_number("unit_price", 2)))
    return inc.reference_price(ln).select("id", F.round("reference_price", 8).alias("reference_price"))


@query(
    "an02_annual_occupancy",
    """SELECT listing_id, avg(taken) AS occupancy, count(*) AS nights FROM (
      SELECT listing_id, night, arg_min(taken, lead * 10 + taken) AS taken FROM (SELECT * FROM nights QUALIFY min(taken) OVER (PARTITION BY listing_id) = 0)
      WHERE lead BETWEEN 0 AND 29 AND night BETWEEN DATE '2024-01-02' AND DATE '2024-01-29' GROUP BY listing_id, night) GROUP BY listing_id HAVING count(*) >= 10""",
)
def _(s, d):
    start, end = F.lit("2024-01-02").cast("date"), F.lit("2024-01-29").cast("date")
    return occ.annual_occupancy(v.nights(s, d), start, end, min_nights=10, block=["listing_id"])


@query(
    "an03_supply_per_1000",
    """SELECT zone, residents, coalesce(homes, 0) AS homes, round(coalesce(homes, 0) * 1000.0 / residents, 6) AS per_1000 FROM
    (SELECT zone, count(*) AS residents FROM customers GROUP BY zone) LEFT JOIN (SELECT zone, count(DISTINCT listing_id) AS homes FROM listing_snap WHERE NOT long_stay GROUP BY zone) USING (zone)""",
)
def _(s, d):
    population = v.customers(s, d).groupBy("zone").agg(F.count("*").alias("residents"))
    homes = v.listing_snap(s, d).where("NOT long_stay").select("zone", "listing_id").distinct()
    return r6(inc.supply_per_1000(homes, population), "per_1000")


@query(
    "an04_population_by_district",
    """SELECT city AS district, CAST(sum(n) AS DOUBLE) AS residents FROM monthly GROUP BY city""",
)
def _(s, d):
    months = [str(m) for m in range(1, 13)]
    m = v.monthly(s, d).groupBy("city", "year").pivot("month", list(range(1, 13))).agg(F.sum("n").cast("string"))
    wide = m.select(col("city").alias("district"), col("year").cast("string").alias("section"), *months)
    total = wide.groupBy("district").agg(F.lit("total").alias("section"), *[F.sum(col(c).cast("double")).cast("string").alias(c) for c in months])
    out = inc.population_by_district(wide.unionByName(total), "district", months, col("section") == "total")
    return r6(out, "residents")


ACTIVE_SQL = "SELECT * FROM listing_income WHERE min_nights <= 30 AND reviews > 0"


def active(s, d):
    return v.listing_income(s, d).where("min_nights <= 30 AND reviews > 0")


@query(
    "an05_income_by_zone",
    f"""SELECT zone, count(*) AS active, CASE WHEN count(*) >= 10 THEN round(median(price), 8) END AS price_median, CASE WHEN count(*) >= 10 THEN round(median(nights_year), 8) END AS nights_median,
    CASE WHEN count(*) >= 10 THEN round(quantile_cont(income, 0.25), 6) END AS income_p25, CASE WHEN count(*) >= 10 THEN round(median(income), 6) END AS income_median, CASE WHEN count(*) >= 10 THEN round(quantile_cont(income, 0.75), 6) END AS income_p75
    FROM ({ACTIVE_SQL}) GROUP BY zone""",
)
def _(s, d):
    return r6(inc.income_by_zone(active(s, d)), "price_median", "nights_median", "income_p25", "income_median", "income_p75")


SCENARIO_SQL = "(SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', {c['platform_fee']}, {c['manager_fee']}, {c['upkeep_share']}, {c['cleaning']}, {c['fixed']})" for k, c in COSTS.items()
) + ") t(scenario, pf, mf, us, cl, fx))"


@query(
    "an06_net_by_scenario",
    f"""SELECT zone, scenario, round(gross, 6) AS gross, round(gross - gross * (pf + mf + us) - n / 12 / 3.5 * cl - fx, 6) AS net, CAST(800 AS DOUBLE) AS long_let_net FROM
    (SELECT zone, median(income) AS gross, median(nights_year) AS n FROM ({ACTIVE_SQL}) GROUP BY zone HAVING count(*) >= 10), {SCENARIO_SQL}""",
)
def _(s, d):
    return r6(inc.net_by_scenario(active(s, d), COSTS, MEAN_STAY, 950.0, 150.0), "gross", "net")


@query(
    "an07_break_even_nights",
    f"""SELECT id, scenario, round(fx / m, 6) AS break_even, round((fx + 800) / m, 6) AS equal_long_let FROM
    (SELECT *, price * (1 - (pf + mf + us)) - cl / 3.5 AS m FROM listing_income, {SCENARIO_SQL})""",
)
def _(s, d):
    out = inc.break_even_nights(v.listing_income(s, d).select("id", "price"), COSTS, MEAN_STAY, 800.0)
    return r6(out.select("id", "scenario", "break_even", "equal_long_let"), "break_even", "equal_long_let")


@query(
    "an08_compare_zones",
    f"""SELECT zone, active, round(net, 6) AS net, CAST(rent - 150 AS DOUBLE) AS long_let_net, round(net / (rent - 150), 6) AS net_ratio FROM
    (SELECT zone, count(*) AS active, median(income) - median(income) * 0.2 - median(nights_year) / 12 / 3.5 * 40 - 300 AS net FROM ({ACTIVE_SQL}) GROUP BY zone HAVING count(*) >= 30)
    JOIN (SELECT DISTINCT p_brand AS zone, 700.0 + 10 * length(p_brand) AS rent FROM part) USING (zone)""",
)
def _(s, d):
    rents = v.table(s, d, "part").select(
        col("p_brand").alias("zone"), (F.lit(700.0) + F.length("p_brand") * 10).alias("rent")
    ).distinct()
    out = inc.compare_zones(active(s, d), rents, COSTS["own"], MEAN_STAY, 150.0)
    return r6(out.select("zone", "active", "net", "long_let_net", "net_ratio"), "net", "net_ratio")


PEERED_SQL = f"""WITH banded AS (SELECT *, CASE WHEN accommodates <= 2 THEN '1-2' WHEN accommodates <= 4 THEN '3-4' WHEN accommodates <= 6 THEN '5-6' ELSE '7+' END AS band
FROM ({ACTIVE_SQL})), peered AS (SELECT *, count(*) OVER w AS peers, quantile_cont(income, 0.25) OVER w AS iq25, median(income) OVER w AS imed,
quantile_cont(occ, 0.75) OVER w AS oq75, quantile_cont(price, 0.25) OVER w AS pq25, median(price) OVER w AS pmed FROM banded WINDOW w AS (PARTITION BY zone, band)),
flagged AS (SELECT *, income < iq25 AS under, CASE WHEN income < iq25 THEN imed - income ELSE 0 END AS gap, occ >= oq75 AND price <= pq25 AS cheap,
CASE WHEN occ >= oq75 AND price <= pq25 THEN (pmed - price) * nights_year / 12 ELSE 0 END AS upside FROM peered WHERE peers >= 10) """
GAP_SQL = "count(*) AS listings, count(*) FILTER (under) AS underperformers, round(sum(gap), 4) AS gap, count(*) FILTER (cheap) AS cheap_and_full, round(sum(upside), 4) AS upside"


def _gap(df):
    return df.withColumn("gap", F.round("gap", 4)).withColumn("upside", F.round("upside", 4))


@query("an09_peer_gap_by_zone", PEERED_SQL + f"SELECT zone, {GAP_SQL} FROM flagged GROUP BY zone")
def _(s, d):
    return _gap(pe.peer_gap(active(s, d)))


@query("an09_peer_gap_total", PEERED_SQL + f"SELECT {GAP_SQL} FROM flagged")
def _(s, d):
    return _gap(pe.peer_gap(active(s, d), by=[]))


@query(
    "an10_host_segments",
    PEERED_SQL
    + """SELECT CASE WHEN host_homes <= 1 THEN 'private' WHEN host_homes <= 9 THEN 'small' ELSE 'professional' END AS segment, count(*) AS listings,
    round(avg(CASE WHEN under THEN 1.0 ELSE 0.0 END), 6) AS below_q25, round(median(price), 8) AS price_median, round(median(occ), 8) AS occ_median, round(median(income), 6) AS income_median
    FROM (SELECT f.*, h.host_homes FROM flagged f JOIN (SELECT host_id, count(*) AS host_homes FROM listing_income GROUP BY host_id) h USING (host_id)) GROUP BY 1""",
)
def _(s, d):
    hosts = v.lines(s, d).groupBy("id").agg(F.min("host_id").alias("host_id")).groupBy("host_id").agg(F.count("*").alias("host_homes"))
    out = pe.host_segments(active(s, d).join(hosts, "host_id"), "host_homes")
    return r6(out, "below_q25", "price_median", "occ_median", "income_median")


@query(
    "an11_stay_levy",
    """SELECT stay_id, line, id, round(2.5 * persons * least(stay_nights, 7), 6) AS levy, round(2.5 * persons * least(stay_nights, 7) / stay_nights, 6) AS levy_per_night,
    round(100 * 2.5 * persons * least(stay_nights, 7) / stay_nights / unit_price, 6) AS levy_pct FROM (SELECT l.*, accommodates AS persons FROM lines l JOIN parts USING (id))""",
)
def _(s, d):
    stays = v.lines(s, d).join(v.parts(s, d).select("id", "accommodates"), "id")
    out = inc.stay_levy(stays, 2.5, 7, "accommodates", "stay_nights", "unit_price")
    return r6(out.select("stay_id", "line", "id", "levy", "levy_per_night", "levy_pct"), "levy", "levy_per_night", "levy_pct")


@query(
    "an12_price_index",
    """SELECT flag, snapshot, round(median(unit_price / ref), 8) AS "index", count(*) AS n, CAST(dayofyear(snapshot) AS INT) AS day_of_year FROM lines
    JOIN (SELECT id, median(unit_price) AS ref FROM lines WHERE month(snapshot) BETWEEN 3 AND 6 GROUP BY id) USING (id) GROUP BY flag, snapshot HAVING count(*) >= 50""",
)
def _(s, d):
    from nightshare.operators.prefix import small_group_quantiles

    ln = v.lines(s, d)
    ref = small_group_quantiles(ln.where(F.month("snapshot").between(3, 6)), ["id"], "unit_price", {"reference_price": 0.5})
    out = inc.price_index(ln, ref, "flag", price="unit_price")
    return out.withColumn("index", F.round("index", 8))


@query(
    "an13_winter_index",
    """SELECT city, month, count(*) AS years, round(1 + 0.5 * (avg(adr / base) - 1), 6) AS "index" FROM monthly
    JOIN (SELECT city, year, avg(adr) AS base FROM monthly WHERE month IN (4, 5, 6) GROUP BY ALL) USING (city, year) WHERE month IN (10, 11, 12, 1, 2, 3) GROUP BY city, month""",
)
def _(s, d):
    return r6(el.winter_index(v.monthly(s, d), 0.5), "index")


# ---------------------------------------------------------------- occupancy series
#: Listings with a free night; the others are blocked, not let.
ALIVE_SQL = "(SELECT * FROM nights QUALIFY min(taken) OVER (PARTITION BY listing_id) = 0)"


@query(
    "an14_monthly_occupancy",
    f"""SELECT city, month, round(occ, 6) AS occ, nights, greatest(round_even(occ * 100, 0) - CASE WHEN city = 2 AND month LIKE '%-01' THEN 4 ELSE 0 END, 0) AS pct FROM
    (SELECT city, strftime(night, '%Y-%m') AS month, avg(occ) AS occ, count(*) AS nights FROM
    (SELECT city, night, avg(taken) AS occ FROM {ALIVE_SQL} WHERE lead BETWEEN 0 AND 29 GROUP BY city, night, lead QUALIFY row_number() OVER (PARTITION BY city, night ORDER BY lead) = 1)
    GROUP BY ALL HAVING count(*) >= 20)""",
)
def _(s, d):
    return r6(occ.monthly_occupancy(v.nights(s, d), adjust={(2, 1): 4.0}, drop_blocked=["listing_id"]), "occ")


@query(
    "an15_daily_occupancy",
    f"""WITH seen AS (SELECT city, night, lead, avg(taken) AS occ FROM {ALIVE_SQL} WHERE lead <= 45 GROUP BY ALL), curve AS (SELECT city, lead, avg(occ) AS c FROM seen GROUP BY ALL)
    SELECT city, night, n.lead, greatest(round_even(100 * least(greatest(occ - (c - ref), 0), 1), 0) - CASE WHEN city = 2 AND month(night) = 1 THEN 4 ELSE 0 END, 0) AS pct FROM (SELECT * FROM seen QUALIFY row_number() OVER (PARTITION BY city, night ORDER BY lead) = 1) n
    JOIN curve USING (city, lead) JOIN (SELECT city, c AS ref FROM curve WHERE lead = 15) USING (city)""",
)
def _(s, d):
    return occ.daily_occupancy(v.nights(s, d), adjust={(2, 1): 4.0}, drop_blocked=["listing_id"])


@query("an16_zone_nights", "SELECT * FROM zone_nights")
def _(s, d):
    return v.zone_nights(s, d)


@query(
    "an34_polarisation",
    """SELECT city, count(*) AS listings, avg(CASE WHEN lo = hi THEN 1.0 ELSE 0.0 END) AS polarised FROM
    (SELECT city, listing_id, min(taken) AS lo, max(taken) AS hi FROM nights GROUP BY ALL) GROUP BY city""",
)
def _(s, d):
    return occ.polarisation(v.nights(s, d), ["city"])


@query(
    "an35_pickup",
    """WITH nx AS (SELECT city, snapshot, lead(snapshot) OVER (PARTITION BY city ORDER BY snapshot) AS nxt FROM (SELECT DISTINCT city, snapshot FROM nights))
    SELECT a.city, a.lead, count(*) AS seen_twice, count(*) FILTER (a.taken = 0 AND b.taken = 1) AS picked_up FROM nights a JOIN nx ON a.city = nx.city AND a.snapshot = nx.snapshot
    JOIN nights b ON b.listing_id = a.listing_id AND b.night = a.night AND b.snapshot = nx.nxt GROUP BY ALL""",
)
def _(s, d):
    n = v.nights(s, d)
    return occ.pickup(n, n)


@query(
    "an36_zone_revpar",
    """SELECT zone, count(*) AS listings, round(median(share), 8) AS share_median, round(median(price), 8) AS price_median, round(median(share) * median(price), 6) AS revpar
    FROM (SELECT id AS listing_id, zone, price FROM listing_income) JOIN (SELECT listing_id, avg(taken) AS share FROM nights GROUP BY 1) USING (listing_id) GROUP BY zone HAVING count(*) >= 5""",
)
def _(s, d):
    listings = v.listing_income(s, d).select(col("id").alias("listing_id"), "zone", "price")
    return r6(occ.zone_revpar(v.nights(s, d), listings, "zone", min_listings=5), "share_median", "price_median", "revpar")


# ---------------------------------------------------------------- elasticity
EXCLUDED_MONTHS = ("1996-05", "1998-08")
MONTHLY_CALM = "(SELECT * FROM monthly WHERE NOT (city = 'NATION_1' AND period IN ('1996-05', '1998-08')))"
FIT = """round(100 * (exp(10 * regr_slope(y, x)) - 1), 6) AS pct_per_10pp,
round(1000 * sqrt((regr_syy(y, x) - regr_slope(y, x) ** 2 * regr_sxx(y, x)) / (count(*) - 2) / regr_sxx(y, x)), 6) AS error_pct, round(CASE WHEN var_pop(y) > 0 AND var_pop(x) > 0 THEN corr(y, x) END, 6) AS r, count(*) AS months"""
ELASTICITY_SQL = f"""WITH calm AS {MONTHLY_CALM}, xy AS (
    SELECT a.city, 'year over year' AS method, ln(a.adr / b.adr) AS y, a.occ - b.occ AS x FROM calm a JOIN calm b ON a.city = b.city AND a.month = b.month AND a.year = b.year + 1
    UNION ALL SELECT city, 'within year', ln(adr) - avg(ln(adr)) OVER w, occ - avg(occ) OVER w FROM calm WINDOW w AS (PARTITION BY city, year)) """


def _elasticity(s, d):
    excluded = s.createDataFrame([("NATION_1", p) for p in EXCLUDED_MONTHS], "city string, period string")
    return el.price_elasticity(v.monthly(s, d), excluded)


@query("an22_price_elasticity", ELASTICITY_SQL + f"SELECT city, method, {FIT} FROM xy GROUP BY city, method")
def _(s, d):
    return r6(_elasticity(s, d), "pct_per_10pp", "error_pct", "r")


DID_SQL = """WITH m AS (SELECT *, ln(adr) - avg(ln(adr)) OVER (PARTITION BY city, year) AS la, CASE WHEN period IN ('1996-05', '1998-08') THEN 0 ELSE 1 END AS u FROM monthly),
s AS (SELECT *, sum(u * la) OVER w AS sla, sum(u * occ) OVER w AS so, sum(u) OVER w AS nu FROM m WINDOW w AS (PARTITION BY city, month)),
own AS (SELECT city, period, la - (sla - u * la) / (nu - u) AS a, occ - (so - u * occ) / (nu - u) AS o FROM s WHERE nu - u >= 3),
t AS (SELECT *, sum(a) OVER p AS sa, sum(o) OVER p AS soo, count(*) OVER p AS c FROM own WINDOW p AS (PARTITION BY period)),
did AS (SELECT city, period, 100 * (exp(a - (sa - a) / (c - 1)) - 1) AS adr_uplift_pct, o - (soo - o) / (c - 1) AS occ_uplift_pp FROM t WHERE c = (SELECT count(DISTINCT city) FROM monthly)) """


@query("an23_diff_in_diff", DID_SQL + "SELECT city, period, round(adr_uplift_pct, 6) AS adr_uplift_pct, round(occ_uplift_pp, 6) AS occ_uplift_pp FROM did")
def _(s, d):
    return r6(el.diff_in_diff(v.monthly(s, d), EXCLUDED_MONTHS), "adr_uplift_pct", "occ_uplift_pp")


@query(
    "an24_did_noise",
    DID_SQL + "SELECT city, count(*) AS months, round(stddev_samp(adr_uplift_pct), 6) AS deviation FROM did WHERE period NOT IN ('1996-05', '1998-08') GROUP BY city",
)
def _(s, d):
    return r6(el.did_noise(v.monthly(s, d), EXCLUDED_MONTHS), "deviation")


@query(
    "an25_event_price_range",
    ELASTICITY_SQL
    + f""", e AS (SELECT city, max(p) FILTER (method = 'year over year') AS a, max(p) FILTER (method = 'within year') AS b FROM
    (SELECT city, method, 100 * (exp(10 * regr_slope(y, x)) - 1) AS p FROM xy GROUP BY ALL) GROUP BY city),
    f AS (SELECT city, 'Month ' || month AS family, count(*) AS editions, avg(occ - 30) AS diff_pp, avg(30 + month) AS control_occ FROM monthly WHERE n >= 8 GROUP BY ALL)
    SELECT f.*  REPLACE (round(diff_pp, 6) AS diff_pp), round(least(100 * ((1 + a / 100) ** (greatest(diff_pp, 0) / 10) - 1), 100 * ((1 + b / 100) ** (greatest(diff_pp, 0) / 10) - 1)), 6) AS price_low_pct,
    round(greatest(100 * ((1 + a / 100) ** (greatest(diff_pp, 0) / 10) - 1), 100 * ((1 + b / 100) ** (greatest(diff_pp, 0) / 10) - 1)), 6) AS price_high_pct FROM f JOIN e USING (city)""",
)
def _(s, d):
    effects = v.monthly(s, d).where("n >= 8").select(
        "city",
        F.concat(F.lit("Month "), col("month").cast("string")).alias("family"),
        (col("occ") - 30).alias("diff_pp"),
        (col("month") + 30).alias("control_occ"),
    )
    return r6(el.event_price_range(effects, _elasticity(s, d)), "diff_pp", "price_low_pct", "price_high_pct")


VALIDATION_SQL = """WITH v AS (SELECT a.city, a.period, a.occ AS official, b.pct AS measured, b.pct - a.occ AS difference FROM monthly a
JOIN (SELECT city, period, least(100, occ * 0.9 + month) AS pct FROM monthly WHERE n >= 3) b USING (city, period)) """


def _validation(s, d):
    m = v.monthly(s, d)
    measured = m.where("n >= 3").select("city", "period", F.least(F.lit(100.0), col("occ") * 0.9 + col("month")).alias("measured"))
    return el.validate_occupancy(m.select("city", "period", col("occ").alias("official")), measured)


@query("an32_validate_occupancy_rows", VALIDATION_SQL + "SELECT city, period, round(official, 6) AS official, round(measured, 6) AS measured, round(difference, 6) AS difference FROM v")
def _(s, d):
    return r6(_validation(s, d)[0], "official", "measured", "difference")


@query(
    "an32_validate_occupancy",
    VALIDATION_SQL
    + """SELECT city, count(*) AS months, round(avg(official), 6) AS official_mean, round(avg(measured), 6) AS measured_mean, round(avg(difference), 6) AS difference_mean,
    round(avg(difference) FILTER (substring(period, 6, 2) IN ('07', '08')), 6) AS summer_difference, round(CASE WHEN var_pop(official) > 0 AND var_pop(measured) > 0 THEN corr(official, measured) END, 6) AS r FROM v GROUP BY city""",
)
def _(s, d):
    return r6(_validation(s, d)[1], "official_mean", "measured_mean", "difference_mean", "summer_difference", "r")


# ---------------------------------------------------------------- space
CELL = 100.0
RADIUS = 100.0


@query("jn12_point_in_polygon", "SELECT id, district FROM located")
def _(s, d):
    return sp.locate(v.points(s, d), v.districts(s, d), CELL).select("id", "district")


@query(
    "jn13_reference_points",
    """SELECT code, string_agg(name, ', ' ORDER BY name) AS landmarks FROM (SELECT code, name FROM (SELECT code, name, count(*) AS k FROM
    (SELECT 'L' || label AS name, avg(x) AS x, avg(y) AS y FROM points GROUP BY label) JOIN district_edges ON (ay <= y) <> (by_ <= y) AND x < (bx - ax) * (y - ay) / (by_ - ay) + ax
    GROUP BY code, name) WHERE k % 2 = 1) GROUP BY code""",
)
def _(s, d):
    marks = v.points(s, d).groupBy("label").agg(F.avg("x").alias("x"), F.avg("y").alias("y")).withColumn(
        "name", F.concat(F.lit("L"), col("label").cast("string"))
    )
    inside = sp.reference_points(v.districts(s, d), marks, CELL)
    # One landmark per label: the list of a district is short however many points there are.
    return inside.groupBy("code").agg(F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("landmarks"))


@query(
    "jn14_hex_district",
    """WITH h AS (SELECT DISTINCT q, r, 100.0 * sqrt(3.0) * (q + r / 2) AS cx, 150.0 * r AS cy FROM hexed),
    c AS (SELECT q, r, min(code) AS centre FROM (SELECT q, r, code, count(*) AS k FROM h JOIN district_edges ON (ay <= cy) <> (by_ <= cy) AND cx < (bx - ax) * (cy - ay) / (by_ - ay) + ax
    GROUP BY ALL) WHERE k % 2 = 1 GROUP BY q, r),
    m AS (SELECT q, r, min(district) FILTER (n = top) AS common FROM (SELECT *, max(n) OVER (PARTITION BY q, r) AS top FROM (SELECT q, r, district, count(*) AS n FROM hexed WHERE district IS NOT NULL GROUP BY ALL)) GROUP BY q, r)
    SELECT h.q, h.r, coalesce(centre, common) AS district FROM h LEFT JOIN c USING (q, r) LEFT JOIN m USING (q, r)""",
)
def _(s, d):
    return sp.hex_district(v.points(s, d), v.districts(s, d), RADIUS, CELL)


@query(
    "fn14_hex_corners",
    """SELECT DISTINCT q, r, i, round(100.0 * sqrt(3.0) * (q + r / 2) + 100 * cos(radians(60 * i - 30)), 6) AS x, round(150.0 * r + 100 * sin(radians(60 * i - 30)), 6) AS y
    FROM hexed, (SELECT unnest([0, 1, 2, 3, 4, 5]) AS i)""",
)
def _(s, d):
    cells = sp.with_hex(v.points(s, d), RADIUS).select("q", "r").distinct()
    corners = cells.select("q", "r", F.posexplode(geo.hex_corners(col("q"), col("r"), RADIUS)).alias("i", "p"))
    # Adding zero turns a negative zero into zero.
    return corners.select("q", "r", "i", (F.round("p.x", 6) + 0.0).alias("x"), (F.round("p.y", 6) + 0.0).alias("y"))


@query(
    "fn15_utm",
    """WITH c AS (SELECT 1 / 298.257222101 AS f), k AS (SELECT f / (2 - f) AS n FROM c), g AS (SELECT n, 6378137.0 / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64) AS a, 2 * sqrt(n) / (1 + n) AS e,
    n / 2 - 2.0 / 3 * n ** 2 + 5.0 / 16 * n ** 3 AS a1, 13.0 / 48 * n ** 2 - 3.0 / 5 * n ** 3 AS a2, 61.0 / 240 * n ** 3 AS a3 FROM k),
    p AS (SELECT id, g.*, radians(43 + y / 1000) AS phi, radians(x / 250) AS lam FROM points, g),
    t AS (SELECT *, (exp(z) - exp(-z)) / 2 AS t FROM (SELECT *, atanh(sin(phi)) - e * atanh(e * sin(phi)) AS z FROM p)),
    w AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM t),
    h AS (SELECT *, (exp(2 * eta) - exp(-2 * eta)) / 2 AS s2, (exp(4 * eta) - exp(-4 * eta)) / 2 AS s4, (exp(6 * eta) - exp(-6 * eta)) / 2 AS s6,
      (exp(2 * eta) + exp(-2 * eta)) / 2 AS c2, (exp(4 * eta) + exp(-4 * eta)) / 2 AS c4, (exp(6 * eta) + exp(-6 * eta)) / 2 AS c6 FROM w)
    SELECT id, round(500000 + 0.9996 * a * (eta + a1 * cos(2 * xi) * s2 + a2 * cos(4 * xi) * s4 + a3 * cos(6 * xi) * s6), 3) AS east,
    round(0.9996 * a * (xi + a1 * sin(2 * xi) * c2 + a2 * sin(4 * xi) * c4 + a3 * sin(6 * xi) * c6), 3) AS north FROM h""",
)
def _(s, d):
    p = v.points(s, d).select("id", (col("x") / 250 - 3).alias("lon"), (col("y") / 1000 + 43).alias("lat"))
    east, north = geo.utm(col("lon"), col("lat"), 30)
    return p.select("id", F.round(east, 3).alias("east"), F.round(north, 3).alias("north"))


METRICS = """count(*) FILTER (room_type <> 'PROMO') AS homes, round(avg(CASE WHEN room_type <> 'PROMO' THEN 0.0 ELSE 1.0 END), 6) AS room_share,
CASE WHEN count(*) FILTER (room_type <> 'PROMO') >= 10 THEN round(count(*) FILTER (room_type <> 'PROMO' AND reviews >= 30) * 1.0 / count(*) FILTER (room_type <> 'PROMO'), 6) END AS pro_share,
count(*) FILTER (act) AS active, CASE WHEN count(*) FILTER (act) >= 10 THEN round(median(price) FILTER (act), 8) END AS price_median,
CASE WHEN count(*) FILTER (act) >= 10 THEN round(median(occ) FILTER (act), 8) END AS occ_median, CASE WHEN count(*) FILTER (act) >= 10 THEN round(quantile_cont(income, 0.25) FILTER (act), 6) END AS income_p25,
CASE WHEN count(*) FILTER (act) >= 10 THEN round(median(income) FILTER (act), 6) END AS income_median, CASE WHEN count(*) FILTER (act) >= 10 THEN round(quantile_cont(income, 0.75) FILTER (act), 6) END AS income_p75,
CASE WHEN count(*) FILTER (act) >= 10 THEN round(median(income) FILTER (act) / 900.0, 6) END AS times_long_let"""


@query(
    "an29_zone_metrics",
    f"""WITH h AS (SELECT i.*, g.district, g.q, g.r, room_type <> 'PROMO' AND min_nights <= 30 AS act FROM homes i JOIN hexed g USING (id) WHERE district IS NOT NULL)
    SELECT 'district' AS level, district AS zone, {METRICS} FROM h GROUP BY district UNION ALL SELECT 'hex', q || ':' || r, {METRICS} FROM h GROUP BY q, r
    UNION ALL SELECT 'city', 'all', {METRICS} FROM h""",
)
def _(s, d):
    located = sp.locate(v.points(s, d), v.districts(s, d), CELL).where("district IS NOT NULL")
    hexed = sp.with_hex(located, RADIUS)
    homes = v.listing_income(s, d).join(hexed, "id")
    out = pe.zone_metrics(
        homes,
        {"district": col("district"), "hex": F.concat_ws(":", col("q").cast("string"), col("r").cast("string")), "city": F.lit("all")},
        entire=col("room_type") != "PROMO",
        professional=col("reviews") >= 30,
        active=(col("room_type") != "PROMO") & (col("min_nights") <= 30),
        rent=900.0,
    )
    return r6(out, "room_share", "pro_share", "price_median", "occ_median", "income_p25", "income_median", "income_p75", "times_long_let")


@query(
    "an29_zone_metrics_residents",
    """WITH h AS (SELECT i.*, g.district FROM homes i JOIN hexed g USING (id) WHERE district IS NOT NULL),
    r AS (SELECT 'district' AS level, district AS zone, 50.0 * count(*) AS residents FROM located WHERE district IS NOT NULL GROUP BY district UNION ALL SELECT 'city', 'all', 50.0 * count(*) FROM located WHERE district IS NOT NULL),
    m AS (SELECT 'district' AS level, district AS zone, count(*) FILTER (room_type <> 'PROMO') AS homes FROM h GROUP BY district UNION ALL SELECT 'city', 'all', count(*) FILTER (room_type <> 'PROMO') FROM h)
    SELECT level, zone, homes, round(homes * 1000.0 / residents, 6) AS per_1000 FROM m LEFT JOIN r USING (level, zone)""",
)
def _(s, d):
    """Homes per 1 000 residents; every point stands for 50 of them."""
    located = sp.locate(v.points(s, d), v.districts(s, d), CELL).where("district IS NOT NULL")
    counted = located.rollup("district").agg((F.count("*") * 50.0).alias("residents"))
    residents = counted.select(F.when(col("district").isNull(), "city").otherwise("district").alias("level"), F.coalesce("district", F.lit("all")).alias("zone"), "residents")
    entire = col("room_type") != "PROMO"
    out = pe.zone_metrics(v.listing_income(s, d).join(located, "id"), {"district": col("district"), "city": F.lit("all")}, entire=entire, professional=col("reviews") >= 30, active=entire, residents=residents)
    return r6(out.select("level", "zone", "homes", "per_1000"), "per_1000")


@query(
    "an30_hex_bins",
    "SELECT q, r, count(*) FILTER (label < 7) AS homes, count(*) AS points FROM hexed GROUP BY q, r HAVING count(*) FILTER (label < 7) >= 10",
)
def _(s, d):
    return sp.hex_bins(v.points(s, d), RADIUS, col("label") < 7)


@query(
    "an31_label_points",
    "SELECT district, round(avg(x), 6) AS label_x, round(avg(y), 6) AS label_y, count(*) AS homes FROM located WHERE district IS NOT NULL GROUP BY district HAVING count(*) >= 10",
)
def _(s, d):
    located = sp.locate(v.points(s, d), v.districts(s, d), CELL).where("district IS NOT NULL")
    return r6(sp.label_points(located, ["district"]), "label_x", "label_y")


# ---------------------------------------------------------------- archives
CAPTURES_SQL = """WITH a AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'),
b AS (SELECT o_orderkey AS id, CASE WHEN o_totalprice > 400000 THEN 'X' ELSE o_orderstatus END AS status, CASE WHEN o_totalprice < 20000 THEN NULL ELSE o_orderpriority END AS priority,
CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01') """


def captures(s, d):
    o = v.table(s, d, "orders")
    base = [col("o_orderkey").alias("id"), "o_orderstatus", "o_orderpriority", F.to_date("o_orderdate").alias("day"), "o_totalprice", "o_orderdate"]
    o = o.select(*base)
    a = o.where(col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz")).select(
        "id", col("o_orderstatus").alias("status"), col("o_orderpriority").alias("priority"), "day"
    )
    b = o.where(col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")).select(
        "id",
        F.when(col("o_totalprice") > 400000, "X").otherwise(col("o_orderstatus")).alias("status"),
        F.when(col("o_totalprice") >= 20000, col("o_orderpriority")).alias("priority"),
        "day",
    )
    return a, b


def day(text):
    return F.lit(text).cast("date")


@query(
    "str02_archive_changes",
    CAPTURES_SQL
    + """SELECT id, DATE '2025-02-01' AS captured, 'status' AS field, a.status AS "before", b.status AS "after" FROM a JOIN b USING (id) WHERE a.status IS DISTINCT FROM b.status
    UNION ALL SELECT id, DATE '2025-02-01', 'priority', a.priority, b.priority FROM a JOIN b USING (id) WHERE a.priority IS DISTINCT FROM b.priority""",
)
def _(s, d):
    a, b = captures(s, d)
    return ar.changes(a, b, "id", ["status", "priority"], day("2025-02-01"))


MERGED_SQL = CAPTURES_SQL + """, z AS (SELECT coalesce(b.id, a.id) AS id, CASE WHEN b.id IS NOT NULL THEN b.status ELSE a.status END AS status, CASE WHEN b.id IS NOT NULL THEN b.priority ELSE a.priority END AS priority,
coalesce(b.day, a.day) AS day, CASE WHEN a.id IS NOT NULL THEN DATE '2025-01-01' ELSE DATE '2025-02-01' END AS first_seen, CASE WHEN b.id IS NOT NULL THEN DATE '2025-02-01' ELSE DATE '2025-01-01' END AS last_seen,
CASE WHEN a.id IS NOT NULL AND b.id IS NOT NULL THEN 2::BIGINT ELSE 1::BIGINT END AS captures FROM a FULL JOIN b ON a.id = b.id) """


def merged(s, d):
    a, b = captures(s, d)
    first = ar.merge(None, a, "id", day("2025-01-01"))
    return ar.merge(first, b, "id", day("2025-02-01"))


@query("str02_archive_merge", MERGED_SQL + "SELECT * FROM z")
def _(s, d):
    return merged(s, d)


@query("str03_disappeared", MERGED_SQL + "SELECT id, day, last_seen FROM z WHERE last_seen < DATE '2025-02-01' AND day > DATE '1995-06-30'")
def _(s, d):
    # Days of the given orders are long past, so the look-ahead is taken from mid 1995.
    gone = ar.disappeared(merged(s, d).withColumn("start", F.add_months("day", 12 * 30)), day("2025-02-01"), "start")
    return gone.where(col("day") > day("1995-06-30")).select("id", "day", "last_seen")


@query(
    "str04_joins_and_leaves",
    """WITH p AS (SELECT DISTINCT grp, listing_id, snapshot FROM listing_snap), o AS (SELECT grp, snapshot, lead(snapshot) OVER w AS nxt, lag(snapshot) OVER w AS bef FROM (SELECT DISTINCT grp, snapshot FROM p) WINDOW w AS (PARTITION BY grp ORDER BY snapshot)),
    a AS (SELECT p.grp, p.snapshot, 1 AS j, 0 AS l FROM p JOIN o USING (grp, snapshot) WHERE bef IS NOT NULL AND NOT EXISTS (SELECT 1 FROM p x WHERE x.grp = p.grp AND x.listing_id = p.listing_id AND x.snapshot = o.bef)
      UNION ALL SELECT p.grp, o.nxt, 0, 1 FROM p JOIN o USING (grp, snapshot) WHERE nxt IS NOT NULL AND NOT EXISTS (SELECT 1 FROM p x WHERE x.grp = p.grp AND x.listing_id = p.listing_id AND x.snapshot = o.nxt))
    SELECT grp, snapshot, CAST(sum(j) AS BIGINT) AS joined, CAST(sum(l) AS BIGINT) AS "left" FROM a GROUP BY ALL""",
)
def _(s, d):
    return ar.joins_and_leaves(v.listing_snap(s, d), "listing_id", "snapshot", ["grp"])


@query("str04_additions_by_month", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS added FROM orders GROUP BY 1")
def _(s, d):
    return ar.additions_by_month(v.table(s, d, "orders"), "o_orderdate")


@query(
    "an37_listing_turnover",
    """SELECT grp, count(*) AS listings, count(*) FILTER (n = 1) AS seen_once, round(avg(n), 6) AS mean_captures FROM
    (SELECT grp, listing_id, count(DISTINCT snapshot) AS n FROM listing_snap GROUP BY ALL) GROUP BY grp""",
)
def _(s, d):
    out = ar.listing_turnover(v.listing_snap(s, d), "listing_id", "snapshot", ["grp"])
    return r6(out, "mean_captures")


# ---------------------------------------------------------------- audits
@query(
    "jn18_distinguishable_pairs",
    """WITH z AS (SELECT zone, avg(price) - stddev_samp(price) / sqrt(count(*)) AS lo, avg(price) + stddev_samp(price) / sqrt(count(*)) AS hi FROM listing_snap GROUP BY zone)
    SELECT (SELECT count(*) FROM z) AS zones, count(*) AS pairs, count(*) FILTER (a.lo > b.hi OR b.lo > a.hi) AS apart, count(*) FILTER (a.lo > b.hi OR b.lo > a.hi) * 1.0 / count(*) AS share
    FROM z a JOIN z b ON a.zone < b.zone""",
)
def _(s, d):
    z = v.listing_snap(s, d).groupBy("zone").agg(F.avg("price").alias("m"), au.standard_error("price").alias("e"))
    return au.distinguishable_pairs(z.select((col("m") - col("e")).alias("lo"), (col("m") + col("e")).alias("hi")), "lo", "hi")


STEPS = " + ".join(f"CASE WHEN u >= {p} THEN 1 ELSE 0 END" for p in au.POISSON_ONE)


@query(
    "an33_bootstrap_ci",
    f"""WITH l AS (SELECT listing_id, city, avg(taken) AS occ, max(price) AS price FROM nights GROUP BY ALL),
    dr AS (SELECT *, {STEPS} AS w FROM (SELECT *, CAST('0x' || left(md5(listing_id || '|' || rep), 8) AS BIGINT) / 4294967296.0 AS u FROM l, (SELECT unnest(generate_series(1, 400)) AS rep))),
    mn AS (SELECT city, rep, sum(w * occ) / sum(w) AS stat FROM dr WHERE w > 0 GROUP BY ALL),
    md AS (SELECT city, rep, median(price) AS stat FROM (SELECT city, rep, price, unnest(generate_series(1, w)) FROM dr WHERE w > 0) GROUP BY ALL)
    SELECT city, round(a.lo, 6) AS mean_low, round(a.hi, 6) AS mean_high, round(b.lo, 6) AS median_low, round(b.hi, 6) AS median_high FROM
    (SELECT city, quantile_cont(stat, 0.025) AS lo, quantile_cont(stat, 0.975) AS hi FROM mn GROUP BY city) a JOIN
    (SELECT city, quantile_cont(stat, 0.025) AS lo, quantile_cont(stat, 0.975) AS hi FROM md GROUP BY city) b USING (city)""",
)
def _(s, d):
    per = v.nights(s, d).groupBy("listing_id", "city").agg(F.avg("taken").alias("occ"), F.max("price").alias("price"))
    out = au.bootstrap_ci(per, "city", "listing_id", "occ", "price")
    return r6(out, "mean_low", "mean_high", "median_low", "median_high")
