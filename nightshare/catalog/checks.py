"""Queries for the data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightshare import views as v
from nightshare.operators import quality as qa
from nightshare.registry import query

col = F.col


@query(
    "qa01_check_report",
    """SELECT 'price_positive' AS rule, 'block' AS severity, count(*) FILTER (unit_price <= 0) AS violations FROM lines
    UNION ALL SELECT 'short_stay', 'warn', count(*) FILTER (stay_nights > 30) FROM lines
    UNION ALL SELECT 'known_flag', 'block', count(*) FILTER (flag NOT IN ('A', 'N', 'R')) FROM lines""",
)
def _(s, d):
    return qa.check_report(
        v.lines(s, d),
        {
            "price_positive": (qa.BLOCK, col("unit_price") <= 0),
            "short_stay": (qa.WARN, col("stay_nights") > 30),
            "known_flag": (qa.BLOCK, qa.allowed_values(col("flag"), ["A", "N", "R"])),
        },
    )


@query(
    "qa02_unique_key",
    """SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys, CAST(sum(n - 1) AS BIGINT) AS surplus FROM (SELECT count(*) AS n FROM lines GROUP BY stay_id, line)""",
)
def _(s, d):
    return qa.unique_key(v.lines(s, d), ["stay_id", "line"])


@query(
    "qa03_not_null",
    """SELECT 'price' AS rule, 'warn' AS severity, count(*) FILTER (price IS NULL) AS violations FROM fact_listing
    UNION ALL SELECT 'missing_flag', 'block', count(*) FILTER (price_missing IS NULL) FROM fact_listing""",
)
def _(s, d):
    return qa.check_report(
        v.fact_listing(s, d),
        {"price": (qa.WARN, qa.not_null(col("price"))), "missing_flag": (qa.BLOCK, qa.not_null(col("price_missing")))},
    )


@query(
    "qa04_in_range",
    """SELECT 'x' AS rule, 'warn' AS severity, count(*) FILTER (x IS NULL OR x < -200 OR x > 200) AS violations FROM points
    UNION ALL SELECT 'y', 'warn', count(*) FILTER (label = 3 OR y < -200 OR y > 200) FROM points""",
)
def _(s, d):
    y = F.when(col("label") != 3, col("y"))
    return qa.check_report(
        v.points(s, d), {"x": (qa.WARN, qa.in_range(col("x"), -200, 200)), "y": (qa.WARN, qa.in_range(y, -200, 200))}
    )


@query(
    "qa05_ordered",
    """SELECT 'night_after_snapshot' AS rule, 'block' AS severity, count(*) FILTER (snapshot > night) AS violations FROM nights
    UNION ALL SELECT 'lead_within_30', 'warn', count(*) FILTER (lead > 30) FROM nights""",
)
def _(s, d):
    return qa.check_report(
        v.nights(s, d),
        {
            "night_after_snapshot": (qa.BLOCK, qa.ordered(col("snapshot"), col("night"))),
            "lead_within_30": (qa.WARN, qa.ordered(col("lead"), F.lit(30))),
        },
    )


@query(
    "qa06_allowed_values",
    """SELECT 'event_type' AS rule, 'block' AS severity, count(*) FILTER (event_type NOT IN ('view', 'click', 'purchase')) AS violations FROM events""",
)
def _(s, d):
    return qa.check_report(
        v.table(s, d, "events"),
        {"event_type": (qa.BLOCK, qa.allowed_values(col("event_type"), ["view", "click", "purchase"]))},
    )


@query(
    "qa07_functional_dependency",
    """SELECT grp, count(DISTINCT zone) AS n FROM listing_snap GROUP BY grp HAVING count(DISTINCT zone) > 1
    UNION ALL SELECT zone, count(DISTINCT grp) FROM listing_snap GROUP BY zone HAVING count(DISTINCT grp) > 1""",
)
def _(s, d):
    ls = v.listing_snap(s, d)
    broken = qa.dependency_violations(ls, "grp", "zone")
    kept = qa.dependency_violations(ls, "zone", "grp").withColumnRenamed("zone", "grp")
    return broken.unionByName(kept)


@query(
    "qa08_expected_matches",
    """SELECT DISTINCT n_name AS zone FROM nation WHERE n_name NOT IN (SELECT zone FROM listing_snap WHERE price > 60 AND month(snapshot) = 1 AND n >= 14)""",
)
def _(s, d):
    listed = v.table(s, d, "nation").select(col("n_name").alias("zone"))
    found = v.listing_snap(s, d).where((col("price") > 60) & (F.month("snapshot") == 1) & (col("n") >= 14))
    return qa.missing_from(listed, found, ["zone"])


@query(
    "qa09_date_coverage",
    """SELECT DISTINCT day FROM lines n WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE CAST(o.o_orderdate AS DATE) = n.day)""",
)
def _(s, d):
    calendar = v.table(s, d, "orders").select(F.to_date("o_orderdate").alias("day"))
    return qa.missing_from(v.lines(s, d), calendar, ["day"])


@query(
    "qa10_set_reconcile",
    """SELECT coalesce(a.city, b.city) AS city, coalesce(a.day, b.day) AS day, CASE WHEN b.day IS NULL THEN 'missing' ELSE 'surplus' END AS status
    FROM (SELECT DISTINCT city, night AS day FROM nights) a FULL JOIN (SELECT DISTINCT city, snapshot AS day FROM nights) b
    ON a.city = b.city AND a.day = b.day WHERE a.day IS NULL OR b.day IS NULL""",
)
def _(s, d):
    n = v.nights(s, d)
    return qa.reconcile_sets(
        n.select("city", col("night").alias("day")), n.select("city", col("snapshot").alias("day")), ["city", "day"]
    )


@query(
    "qa11_null_profile",
    """SELECT c AS "column", round(1 - n / total, 3) AS null_share FROM (SELECT count(*) AS total, count(price) AS price, count(city) AS city,
    count(captures) AS captures FROM fact_listing) UNPIVOT (n FOR c IN (price, city, captures)) ORDER BY null_share DESC, c LIMIT 2""",
)
def _(s, d):
    profile = qa.null_profile(v.fact_listing(s, d), ["price", "city", "captures"])
    return profile.orderBy(col("null_share").desc(), "column").limit(2)


@query(
    "qa12_row_reconcile",
    """SELECT snapshot_date, a AS rows_a, b AS rows_b, b - a AS difference FROM
    (SELECT snapshot_date, count(*) AS a FROM fact_calendar GROUP BY 1) JOIN (SELECT snapshot_date, count(*) AS b FROM fact_listing GROUP BY 1) USING (snapshot_date)""",
)
def _(s, d):
    return qa.reconcile_counts(v.fact_calendar(s, d), v.fact_listing(s, d), ["snapshot_date"])


@query(
    "qa15_orphans",
    """SELECT 'left' AS side, count(DISTINCT id) AS ids, min(day) AS first_day, max(day) AS last_day FROM
      (SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderpriority = '1-URGENT') WHERE id NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority <> '1-URGENT')
    UNION ALL SELECT 'right', count(DISTINCT id), min(day), max(day) FROM
      (SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderpriority <> '1-URGENT') WHERE id NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def _(s, d):
    o = v.table(s, d, "orders").select(col("o_custkey").alias("id"), F.to_date("o_orderdate").alias("day"), "o_orderpriority")
    return qa.orphans(o.where("o_orderpriority = '1-URGENT'"), o.where("o_orderpriority <> '1-URGENT'"), "id", "day")


@query(
    "qa16_parse_agreement",
    """SELECT count(*) AS compared, avg(CASE WHEN abs(p - list_price * 10) < 0.01 THEN 1.0 ELSE 0.0 END) AS agreement FROM
    (SELECT list_price, TRY_CAST(regexp_replace(price_text, '[$,]', '', 'g') AS DOUBLE) AS p FROM parts)""",
)
def _(s, d):
    from nightshare.functions.cleaning import parse_price

    return qa.parse_agreement(v.parts(s, d), parse_price(col("price_text")), col("list_price") * 10)
