"""Queries for event effects, placebo noise and the event calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightshare import views as v
from nightshare.catalog.analyses import r6
from nightshare.operators import controls as ct
from nightshare.plans import events as ev
from nightshare.registry import query

col = F.col

# Control nights of any night: same city and weekday, three weeks around, similar lead, nothing going on.
CONTROLS = """WITH ctl AS (SELECT t.city, t.night, any_value(t.lead) AS lead, any_value(t.occ) AS occ, avg(p.occ) AS control, count(*) AS n_controls FROM zone_nights t JOIN zone_nights p
ON p.city = t.city AND isodow(p.night) = isodow(t.night) AND p.night BETWEEN t.night - 21 AND t.night + 21 AND p.night <> t.night AND abs(p.lead - t.lead) <= 7
WHERE NOT EXISTS (SELECT 1 FROM excluded x WHERE x.city = p.city AND x.night = p.night) GROUP BY t.city, t.night HAVING count(*) >= 2),
en AS (SELECT event, city, kind, CAST(unnest(generate_series(first_night, last_night, INTERVAL 1 DAY)) AS DATE) AS night FROM event_ranges),
met AS (SELECT e.event, e.kind, c.*, (c.occ - c.control) * 100 AS diff_pp FROM en e JOIN ctl c USING (city, night)) """
EFFECT = """eff AS (SELECT event, city, kind, count(*) AS nights, 100 * avg(occ) AS event_occ, 100 * avg(control) AS control_occ, avg(diff_pp) AS diff_pp, avg(lead) AS mean_lead,
any_value(all_nights) AS all_nights, count(*) * 1.0 / any_value(all_nights) AS coverage FROM met JOIN (SELECT event, city, count(*) AS all_nights FROM en GROUP BY ALL) USING (event, city) GROUP BY event, city, kind) """
EFFECT_COLUMNS = "SELECT event, city, kind, nights, round(event_occ, 6) AS event_occ, round(control_occ, 6) AS control_occ, round(diff_pp, 6) AS diff_pp, round(mean_lead, 6) AS mean_lead, all_nights, round(coverage, 6) AS coverage FROM eff"


@query("jn10_band_controls", CONTROLS + "SELECT city, night, round(control, 6) AS control, n_controls FROM ctl")
def _(s, d):
    z = v.zone_nights(s, d).select("city", "night", "lead", "occ")
    out = ct.with_controls(z, z, v.excluded(s, d))
    return r6(out.select("city", "night", "control", "n_controls"), "control")


@query(
    "jn11_offset_controls",
    """SELECT t.city, t.night, round(avg(p.occ), 6) AS control, count(*) AS n_controls FROM hotel_daily t JOIN hotel_daily p ON p.city = t.city
    AND p.night - t.night IN (-21, -14, -7, 7, 14, 21) GROUP BY t.city, t.night HAVING count(*) >= 2""",
)
def _(s, d):
    h = v.hotel_daily(s, d)
    none = h.select("city", "night").where("false")
    return r6(ct.with_controls(h, h, none, lead=None).select("city", "night", "control", "n_controls"), "control")


def _effects(s, d):
    return ev.event_effect(v.event_ranges(s, d), v.zone_nights(s, d), v.excluded(s, d))


EFFECT_R6 = ("event_occ", "control_occ", "diff_pp", "mean_lead", "coverage")


@query("an17_event_effect", CONTROLS + ", " + EFFECT + EFFECT_COLUMNS)
def _(s, d):
    return r6(_effects(s, d), *EFFECT_R6)


@query(
    "an18_match_effect",
    CONTROLS + "SELECT city, isodow(night) >= 5 AS weekend, count(*) AS nights, round(avg(diff_pp), 6) AS diff_pp FROM met WHERE kind = 'match' GROUP BY ALL",
)
def _(s, d):
    matches = v.event_ranges(s, d).where("kind = 'match'")
    return r6(ev.match_effect(ev.measured_nights(matches, v.zone_nights(s, d), v.excluded(s, d))), "diff_pp")


@query(
    "an18_match_pool",
    CONTROLS
    + """SELECT city, count(*) AS nights, round(100 * avg(occ), 6) AS event_occ, round(100 * avg(control), 6) AS control_occ, round(avg(diff_pp), 6) AS diff_pp,
    round(median(diff_pp), 6) AS diff_median FROM met WHERE kind = 'match' GROUP BY city""",
)
def _(s, d):
    matches = v.event_ranges(s, d).where("kind = 'match'")
    out = ev.match_pool(ev.measured_nights(matches, v.zone_nights(s, d), v.excluded(s, d)))
    return r6(out, "event_occ", "control_occ", "diff_pp", "diff_median")


@query(
    "an19_placebo",
    CONTROLS
    + """SELECT city, count(*) AS nights, round(avg(g), 6) AS mean, round(stddev_samp(g), 6) AS deviation, round(quantile_cont(g, 0.05), 6) AS p5, round(quantile_cont(g, 0.95), 6) AS p95 FROM
    (SELECT city, 100 * (occ - control) AS g FROM ctl c WHERE NOT EXISTS (SELECT 1 FROM excluded x WHERE x.city = c.city AND x.night = c.night)) GROUP BY city""",
)
def _(s, d):
    return r6(ev.placebo(v.zone_nights(s, d), v.excluded(s, d)), "mean", "deviation", "p5", "p95")


@query(
    "an20_stable_panel_effect",
    """WITH panel AS (SELECT listing_id FROM (SELECT DISTINCT listing_id, date_trunc('month', snapshot) AS m FROM nights) GROUP BY listing_id HAVING count(*) = (SELECT count(DISTINCT date_trunc('month', snapshot)) FROM nights)),
zn AS (SELECT * FROM (SELECT city, night, lead, avg(taken) AS occ FROM nights WHERE lead BETWEEN 0 AND 29 AND listing_id IN (SELECT listing_id FROM panel) GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY city, night ORDER BY lead) = 1), """
    + CONTROLS[5:].replace("zone_nights t", "zn t").replace("zone_nights p", "zn p")
    + ", "
    + EFFECT
    + EFFECT_COLUMNS,
)
def _(s, d):
    n = v.nights(s, d)
    captures = n.select("listing_id", F.trunc("snapshot", "month").alias("snapshot"))
    return r6(ev.stable_panel_effect(n, captures, v.event_ranges(s, d), v.excluded(s, d)), *EFFECT_R6)


@query(
    "an21_hotel_event_uplift",
    """WITH e AS (SELECT event, city, kind, CAST(CASE WHEN kind = 'sport' THEN first_night - 1 ELSE first_night END AS DATE) AS a, last_night AS b FROM hotel_events),
    x AS (SELECT DISTINCT city, CAST(unnest(generate_series(a - 1, b + 1, INTERVAL 1 DAY)) AS DATE) AS night FROM e),
    en AS (SELECT event, city, kind, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS night FROM e),
    met AS (SELECT event, en.city, kind, en.night, any_value(t.occ) AS occ, avg(p.occ) AS control FROM en JOIN hotel_daily t ON t.city = en.city AND t.night = en.night
      JOIN hotel_daily p ON p.city = en.city AND p.night - en.night IN (-21, -14, -7, 7, 14, 21) WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.city = p.city AND x.night = p.night)
      GROUP BY event, en.city, kind, en.night HAVING count(*) >= 2)
    SELECT event, city, kind, count(*) AS nights, round(avg(occ), 6) AS event_occ, round(avg(control), 6) AS control_occ, round(avg(occ - control), 6) AS diff_pp FROM met GROUP BY event, city, kind""",
)
def _(s, d):
    events = ev.sport_starts_earlier(v.hotel_events(s, d))
    series = v.hotel_daily(s, d)
    out = ev.event_effect(events, series, ct.exclusion_set(events, series), lead=None, scale=1.0)
    return r6(out.select("event", "city", "kind", "nights", "event_occ", "control_occ", "diff_pp"), "event_occ", "control_occ", "diff_pp")


@query(
    "an26_effect_summary",
    CONTROLS
    + ", "
    + EFFECT
    + """SELECT city, kind, count(*) AS events, round(avg(diff_pp), 6) AS diff_pp, round(stddev_samp(diff_pp) / sqrt(count(*)), 6) AS std_error, CAST(grouping(city) AS INT) AS level
    FROM eff GROUP BY GROUPING SETS ((city, kind), ())""",
)
def _(s, d):
    return r6(ev.effect_summary(_effects(s, d)), "diff_pp", "std_error")


AGENDA_SQL = """SELECT doc_id, text AS name, text AS price, source AS place, lang AS kind, lang || ' hall ' || doc_id % 3 AS venue,
'2024-' || lpad(CAST(doc_id % 13 AS VARCHAR), 2, '0') || '-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') AS a,
'2024-' || lpad(CAST((n_chars + 3) % 12 + 1 AS VARCHAR), 2, '0') || '-15T20:00' AS b FROM documents"""


def agenda(s, d):
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    i = col("doc_id")
    return v.docs(s, d).select(
        "doc_id",
        col("text").alias("name"),
        col("text").alias("price"),
        col("source").alias("place"),
        col("lang").alias("kind"),
        F.concat("lang", F.lit(" hall "), i % 3).alias("venue"),
        F.concat(F.lit("2024-"), two(i % 13), F.lit("-"), two(i % 28 + 1)).alias("start"),
        F.concat(F.lit("2024-"), two((col("n_chars") + 3) % 12 + 1), F.lit("-15T20:00")).alias("end"),
    )


def normalised(s, d):
    return ev.normalise_events(agenda(s, d), F.lit("2024-03-01").cast("date"), {"src1": "A", "src2": "B"}, free_word="the")


@query(
    "an28_normalise_events",
    f"""SELECT doc_id, TRY_CAST(a AS DATE) AS start_date, TRY_CAST(left(b, 10) AS DATE) AS end_date, coalesce(TRY_CAST(a AS DATE) <= TRY_CAST(left(b, 10) AS DATE), false) AS dates_valid,
    CASE WHEN len(n) > 0 THEN list_min(n) WHEN contains(lower(name), 'the') THEN 0.0 END AS price_min, CASE WHEN len(n) > 0 THEN list_max(n) WHEN contains(lower(name), 'the') THEN 0.0 END AS price_max,
    CASE WHEN starts_with(place, 'src1') THEN 'A' WHEN starts_with(place, 'src2') THEN 'B' ELSE 'Other' END AS city,
    md5(regexp_replace(name, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}', '[email]', 'g')) AS name_md5
    FROM (SELECT *, list_transform(regexp_extract_all(price, '[0-9]+(?:[.,][0-9]+)?'), lambda x: CAST(replace(x, ',', '.') AS DOUBLE)) AS n FROM ({AGENDA_SQL}))""",
)
def _(s, d):
    return normalised(s, d).select(
        "doc_id", "start_date", "end_date", "dates_valid", "price_min", "price_max", "city", F.md5("name").alias("name_md5")
    )


@query(
    "an27_event_calendar",
    f"""WITH ag AS (SELECT regexp_replace(name, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}', '[email]', 'g') AS name, kind, venue, TRY_CAST(a AS DATE) AS start_date, TRY_CAST(left(b, 10) AS DATE) AS end_date,
      CASE WHEN starts_with(place, 'src1') THEN 'A' WHEN starts_with(place, 'src2') THEN 'B' ELSE 'Other' END AS city FROM ({AGENDA_SQL})),
    st AS (SELECT left(trim(replace(regexp_replace(regexp_replace(trim(name, '"'), '(?i)\\A\\s*entradas\\s+', ''), '\\s*\\([^)0-9]*[0-9][^)]*\\)\\s*\\z', ''), '"', ''), ' -'), 70) AS name, city, kind, start_date, end_date, 3 AS rank
      FROM ag WHERE start_date <= end_date AND city IN ('A', 'B') AND regexp_matches(venue, '^(en|fr|es) hall') AND (kind <> 'fr' OR regexp_matches(venue, 'hall [01]$')) AND start_date >= DATE '2024-03-01' AND kind IN ('en', 'fr') AND NOT contains(upper(name), 'CANCELAD')
      UNION ALL SELECT n_name, 'A', 'curated', DATE '2024-06-01' + CAST(n_nationkey AS INT), DATE '2024-06-03' + CAST(n_nationkey AS INT), 1 FROM nation
      UNION ALL SELECT lower(n_name), 'A', 'match', DATE '2024-06-01' + CAST(n_nationkey AS INT), DATE '2024-06-01' + CAST(n_nationkey AS INT), 2 FROM nation)
    SELECT md5(name) AS name_md5, city, kind, start_date, end_date, rank FROM (SELECT *, row_number() OVER (PARTITION BY city, start_date,
      regexp_replace(translate(lower(name), 'áàâäãåéèêëíìîïóòôöõúùûüýÿñç', 'aaaaaaeeeeiiiiooooouuuuyync'), '[^a-z0-9]', '', 'g') ORDER BY rank, end_date, name, kind) AS rn FROM st) WHERE rn = 1""",
)
def _(s, d):
    nation = v.table(s, d, "nation")
    first = F.date_add(F.lit("2024-06-01").cast("date"), col("n_nationkey").cast("int"))
    curated = nation.select(
        col("n_name").alias("name"), F.lit("A").alias("city"), F.lit("curated").alias("kind"), first.alias("start_date"), F.date_add(first, 2).alias("end_date")
    )
    matches = nation.select(
        F.lower("n_name").alias("name"), F.lit("A").alias("city"), F.lit("match").alias("kind"), first.alias("start_date"), first.alias("end_date")
    )
    out = ev.event_calendar(
        normalised(s, d), curated, F.lit("2024-03-01").cast("date"), ["A", "B"], ["en", "fr"], "^(en|fr|es) hall", matches=matches, venues_of={"fr": "hall [01]$"}
    )
    return out.select(F.md5("name").alias("name_md5"), "city", "kind", "start_date", "end_date", "rank")
