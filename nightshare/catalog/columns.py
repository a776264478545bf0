"""Queries for typing, flags, labels, text, dates and numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightshare import views as v
from nightshare.functions import cleaning as c
from nightshare.functions import dates as dt
from nightshare.functions import text as tx
from nightshare.operators import quality as qa
from nightshare.registry import query

col = F.col


@query(
    "prj01_cast_groups",
    """SELECT TRY_CAST(id AS BIGINT) AS id, TRY_CAST(price_text AS DOUBLE) AS price_text, TRY_CAST(list_price AS DOUBLE) AS list_price,
    TRY_CAST(name AS DATE) AS name, room_type FROM parts""",
)
def _(s, d):
    return c.cast_groups(v.parts(s, d), ["id"], ["price_text", "list_price"], ["name"], ["room_type"])


@query("prj02_parse_price", "SELECT id, TRY_CAST(regexp_replace(price_text, '[$,]', '', 'g') AS DOUBLE) AS price FROM parts")
def _(s, d):
    return v.parts(s, d).select("id", c.parse_price(col("price_text")).alias("price"))


@query(
    "prj03_parse_price_strict",
    """SELECT id, CASE WHEN p > 0 AND p < 9999 THEN p END AS price FROM (
    SELECT id, TRY_CAST(regexp_replace(price_text, '[^0-9.]', '', 'g') AS DOUBLE) AS p FROM parts)""",
)
def _(s, d):
    return v.parts(s, d).select("id", c.parse_price_strict(col("price_text")).alias("price"))


@query(
    "prj04_tri_bool",
    """SELECT event_id, CASE t WHEN 't' THEN true WHEN 'f' THEN false END AS flag
    FROM (SELECT event_id, CASE event_type WHEN 'purchase' THEN 't' WHEN 'view' THEN 'f' END AS t FROM events)""",
)
def _(s, d):
    e = v.table(s, d, "events")
    raw = F.when(col("event_type") == "purchase", "t").when(col("event_type") == "view", "f")
    return e.select("event_id", c.tri_bool(raw).alias("flag"))


@query(
    "prj05_is_taken",
    """SELECT event_id, CASE WHEN lower(CASE event_type WHEN 'purchase' THEN 'F' WHEN 'signup' THEN 'False' WHEN 'view' THEN 't' END)
    IN ('f', 'false') THEN 1 ELSE 0 END AS taken FROM events""",
)
def _(s, d):
    e = v.table(s, d, "events")
    raw = F.when(col("event_type") == "purchase", "F").when(col("event_type") == "signup", "False").when(
        col("event_type") == "view", "t"
    )
    return e.select("event_id", c.is_taken(raw).alias("taken"))


@query(
    "prj06_price_flags",
    """SELECT id, p IS NULL AS missing, coalesce(p = 9999, false) AS outlier FROM (
    SELECT id, CASE WHEN list_price > 950 THEN TRY_CAST(regexp_replace(price_text, '[$,]', '', 'g') AS DOUBLE) + 9 END AS p FROM parts)""",
)
def _(s, d):
    p = F.when(col("list_price") > 950, c.parse_price(col("price_text")) + 9)
    return v.parts(s, d).select("id", c.price_missing(p).alias("missing"), c.price_outlier(p).alias("outlier"))


@query(
    "prj07_long_stay_flag",
    """SELECT stay_id, line, id, coalesce(stay_nights >= 28, false) AS long_stay, coalesce(stay_nights >= 31, false) AS over_30 FROM lines""",
)
def _(s, d):
    n = col("stay_nights")
    return v.lines(s, d).select(
        "stay_id", "line", "id", c.long_stay(n).alias("long_stay"), c.long_stay(n, 31).alias("over_30")
    )


@query(
    "prj08_repair_mojibake",
    # Texts with a letter from À to ÿ come back whole; other damage cannot be told and stays, byte by byte.
    """SELECT doc_id, md5(text) AS plain, md5(CASE WHEN regexp_matches(text, '[À-ÿ]') OR NOT regexp_matches(text, '[^\\x00-\\x7F]') THEN text
    ELSE list_aggregate(list_transform(range(0, strlen(text)), lambda i: chr(CAST('0x' || substr(hex(encode(text)), CAST(2 * i + 1 AS BIGINT), 2) AS INT))), 'string_agg', '') END) AS repaired
    FROM documents""",
)
def _(s, d):
    docs = v.docs(s, d)
    broken = F.encode("text", "UTF-8")
    # Reading UTF-8 bytes as latin-1 is what broke such names; the repair must give the old text back.
    garbled = F.decode(broken, "ISO-8859-1")
    return docs.select(
        "doc_id", F.md5("text").alias("plain"), F.md5(c.repair_mojibake(garbled)).alias("repaired")
    )


@query(
    "prj10_licence_status",
    """SELECT doc_id, CASE WHEN l IS NULL THEN 'none' WHEN contains(l, 'License') THEN 'exempt'
    WHEN contains(l, 'http') OR contains(l, '@') THEN 'registered' ELSE 'free text' END AS status
    FROM (SELECT doc_id, CASE WHEN lang <> 'de' THEN text END AS l FROM documents)""",
)
def _(s, d):
    text = F.when(col("lang") != "de", col("text"))
    return v.docs(s, d).select("doc_id", c.licence_status(text, "License", ("http", "@")).alias("status"))


@query(
    "prj11_exempt_type",
    "SELECT doc_id, nullif(trim(regexp_extract(text, 'Licen[sc]e([^.\\n]*)', 1)), '') AS kind FROM documents",
)
def _(s, d):
    return (
        v.docs(s, d)
        .withColumn("kind", c.exempt_type(col("text"), r"Licen[sc]e([^.\n]*)"))
        .select("doc_id", "kind")
    )


@query(
    "prj12_add_partition_keys",
    "SELECT id, 'Harbour' AS city, DATE '2025-09-29' AS snapshot_date FROM parts",
)
def _(s, d):
    return c.add_partition_keys(v.parts(s, d).select("id"), "Harbour", "2025-09-29")


@query(
    "prj13_snapshot_key",
    "SELECT listing_id, snapshot, grp || '_' || strftime(snapshot, '%Y%m%d') AS snapshot_id FROM listing_snap",
)
def _(s, d):
    return v.listing_snap(s, d).select("listing_id", "snapshot", c.snapshot_key(col("grp"), col("snapshot")).alias("snapshot_id"))


@query("prj14_zone_key", "SELECT DISTINCT grp || '|' || zone AS zone_id FROM listing_snap")
def _(s, d):
    return v.listing_snap(s, d).select(c.zone_key(col("grp"), col("zone")).alias("zone_id")).distinct()


@query(
    "prj15_rename_values",
    """SELECT DISTINCT grp || '|' || zone AS zone_id, CASE zone WHEN 'NATION_1' THEN 'Old Town' WHEN 'NATION_2' THEN 'Harbour' ELSE zone END AS zone
    FROM listing_snap""",
)
def _(s, d):
    keyed = v.listing_snap(s, d).select(c.zone_key(col("grp"), col("zone")).alias("zone_id"), "zone").distinct()
    return c.rename_values(keyed, "zone", {"NATION_1": "Old Town", "NATION_2": "Harbour"})


@query(
    "prj16_stressed_flag",
    """SELECT DISTINCT grp, zone, CASE WHEN grp = 'ASIA' OR (grp = 'AFRICA' AND zone IN ('NATION_0', 'NATION_5')) THEN 'yes' ELSE 'no' END AS stressed
    FROM listing_snap""",
)
def _(s, d):
    z = v.listing_snap(s, d).select("grp", "zone").distinct()
    return z.withColumn("stressed", c.stressed_flag(col("grp"), col("zone"), ["ASIA"], {"AFRICA": ["NATION_0", "NATION_5"]}))


@query(
    "prj19_season",
    """SELECT snapshot, CASE WHEN month(snapshot) IN (3,4,5) THEN '1 spring' WHEN month(snapshot) IN (6,7,8) THEN '2 summer'
    WHEN month(snapshot) IN (9,10,11) THEN '3 autumn' ELSE '4 winter' END AS season, count(*) AS n FROM listing_snap GROUP BY ALL""",
)
def _(s, d):
    return v.listing_snap(s, d).groupBy("snapshot", c.season(F.month("snapshot")).alias("season")).agg(F.count("*").alias("n"))


@query(
    "prj20_has_price",
    """SELECT city, snapshot_date, round(avg(CASE WHEN price_missing THEN 1.0 ELSE 0.0 END), 4) AS missing_share,
    round(avg(CASE WHEN price_missing THEN 1.0 ELSE 0.0 END), 4) < 0.5 AS has_price FROM fact_listing GROUP BY ALL""",
)
def _(s, d):
    g = v.fact_listing(s, d).groupBy("city", "snapshot_date")
    return g.agg(F.round(F.avg(col("price_missing").cast("double")), 4).alias("missing_share")).withColumn(
        "has_price", col("missing_share") < 0.5
    )


@query(
    "prj21_capacity_band",
    """SELECT p_partkey AS id, CASE WHEN p_size BETWEEN 1 AND 2 THEN '1-2' WHEN p_size BETWEEN 3 AND 4 THEN '3-4' WHEN p_size BETWEEN 5 AND 6 THEN '5-6'
    WHEN p_size BETWEEN 7 AND 99 THEN '7+' END AS band FROM part""",
)
def _(s, d):
    return v.table(s, d, "part").select(col("p_partkey").alias("id"), c.capacity_band(col("p_size")).alias("band"))


@query(
    "prj22_host_segment",
    """SELECT host_id, count(DISTINCT id) AS homes, CASE WHEN count(DISTINCT id) = 1 THEN 'private' WHEN count(DISTINCT id) <= 9 THEN 'small'
    ELSE 'professional' END AS segment FROM lines GROUP BY host_id""",
)
def _(s, d):
    g = v.lines(s, d).groupBy("host_id").agg(F.countDistinct("id").alias("homes"))
    return g.withColumn("segment", c.host_segment(col("homes")))


@query(
    "prj23_reliability_level",
    """SELECT zone, count(DISTINCT listing_id) AS n, CASE WHEN count(DISTINCT listing_id) >= 8 THEN 1 WHEN count(DISTINCT listing_id) >= 5 THEN 2
    WHEN count(DISTINCT listing_id) >= 3 THEN 3 ELSE 4 END AS level FROM listing_snap GROUP BY zone""",
)
def _(s, d):
    g = v.listing_snap(s, d).groupBy("zone").agg(F.countDistinct("listing_id").alias("n"))
    return g.withColumn("level", c.reliability_level(col("n"), (8, 5, 3)))


@query(
    "prj24_city_by_prefix",
    """SELECT doc_id, CASE WHEN starts_with(source, 'src1') THEN 'A' WHEN starts_with(source, 'src2') THEN 'B' END AS city,
    CASE WHEN starts_with(source, 'src1') THEN 'A' WHEN starts_with(source, 'src2') THEN 'B' ELSE 'Other' END AS city_or_other FROM documents""",
)
def _(s, d):
    p = {"src1": "A", "src2": "B"}
    return v.docs(s, d).select(
        "doc_id", c.by_prefix(col("source"), p).alias("city"), c.by_prefix(col("source"), p, "Other").alias("city_or_other")
    )


@query(
    "prj25_zone_group",
    """SELECT zone, CASE WHEN zone IN ('NATION_0', 'NATION_3') THEN 'north coast' WHEN zone IN ('NATION_4', 'NATION_7', 'NATION_9') THEN 'south coast' END AS area,
    count(*) AS n FROM listing_snap GROUP BY ALL""",
)
def _(s, d):
    groups = {"north coast": ["NATION_0", "NATION_3"], "south coast": ["NATION_4", "NATION_7", "NATION_9"]}
    return v.listing_snap(s, d).groupBy("zone", c.zone_group(col("zone"), groups).alias("area")).agg(F.count("*").alias("n"))


@query(
    "prj26_active_filter",
    """SELECT id, zone, round(price, 8) AS price FROM listing_income
    WHERE room_type IN ('STANDARD', 'PROMO') AND min_nights <= 30 AND reviews > 0 AND price IS NOT NULL AND occ IS NOT NULL""",
)
def _(s, d):
    keep = c.active(col("room_type"), col("min_nights"), col("reviews"), col("price"), col("occ"), ("STANDARD", "PROMO"))
    return v.listing_income(s, d).where(keep).select("id", "zone", F.round("price", 8).alias("price"))


@query(
    "prj27_valid_price_filter",
    "SELECT listing_id, snapshot_date, price FROM fact_listing WHERE NOT price_missing AND NOT price_outlier AND NOT long_stay",
)
def _(s, d):
    ok = c.valid_price(col("price_missing"), col("price_outlier"), col("long_stay"))
    return v.fact_listing(s, d).where(ok).select("listing_id", "snapshot_date", "price")


@query(
    "prj28_month_filter",
    """SELECT listing_id, strftime(night, '%Y-%m') AS month, count(*) AS nights FROM nights GROUP BY ALL HAVING count(*) >= 60""",
)
def _(s, d):
    g = v.nights(s, d).groupBy("listing_id", F.date_format("night", "yyyy-MM").alias("month"))
    return g.agg(F.count("*").alias("nights")).where("nights >= 60")


@query(
    "prj29_clip01_percent",
    """SELECT city, night, CAST(round_even(100 * least(greatest(avg(taken) * 3 - 0.5, 0), 1), 0) AS INT) AS pct FROM nights GROUP BY ALL""",
)
def _(s, d):
    return v.nights(s, d).groupBy("city", "night").agg(c.clip01_percent(F.avg("taken") * 3 - 0.5).alias("pct"))


@query(
    "prj31_all_null_columns",
    """SELECT c AS "column" FROM (SELECT count(text) AS text, count(lang) AS lang, count(CASE WHEN n_chars < 0 THEN 1 END) AS never FROM documents)
    UNPIVOT (n FOR c IN (text, lang, never)) WHERE n = 0""",
)
def _(s, d):
    docs = v.docs(s, d).withColumn("never", F.when(col("n_chars") < 0, 1))
    return qa.all_null_columns(docs, ["text", "lang", "never"])


@query(
    "prj32_privacy_drop",
    "SELECT doc_id, lang, n_chars FROM documents",
)
def _(s, d):
    from nightshare.sources.readers import allow_only

    return allow_only(v.docs(s, d), ["doc_id", "lang", "n_chars", "phone"], private=["text", "source", "phone"])


# ---------------------------------------------------------------- scalar groups
@query(
    "fn01_string_functions",
    """SELECT doc_id, md5(regexp_replace(text, '[0-9]+', '#', 'g')) AS masked, regexp_extract(text, '([A-Za-z]+)@', 1) AS account,
    CAST(len(regexp_extract_all(text, '[0-9]+')) AS INT) AS numbers, contains(text, 'http') AS has_link, starts_with(lower(trim(text)), 'the') AS the_first,
    source || '/' || lang AS place, lpad(CAST(doc_id AS VARCHAR), 6, '0') AS padded, substring(text, 3, 5) AS piece,
    split_part(source, 'c', 2) AS tail FROM documents""",
)
def _(s, d):
    t = col("text")
    return v.docs(s, d).select(
        "doc_id",
        F.md5(F.regexp_replace(t, "[0-9]+", "#")).alias("masked"),
        F.regexp_extract(t, "([A-Za-z]+)@", 1).alias("account"),
        F.size(F.regexp_extract_all(t, F.lit("[0-9]+"), F.lit(0))).alias("numbers"),
        t.contains("http").alias("has_link"),
        F.lower(F.trim(t)).startswith("the").alias("the_first"),
        F.concat("source", F.lit("/"), "lang").alias("place"),
        F.lpad(col("doc_id").cast("string"), 6, "0").alias("padded"),
        F.substring(t, 3, 5).alias("piece"),
        F.element_at(F.split("source", "c"), -1).alias("tail"),
    )


@query(
    "fn02_text_key",
    """SELECT doc_id, md5(regexp_replace(translate(lower(text), 'áàâäãåéèêëíìîïóòôöõúùûüýÿñçºª²', 'aaaaaaeeeeiiiiooooouuuuyyncoa2'), '[^a-z0-9]', '', 'g')) AS text_key
    FROM documents""",
)
def _(s, d):
    return v.docs(s, d).select("doc_id", F.md5(tx.text_key(col("text"))).alias("text_key"))


@query(
    "fn03_clean_name",
    """SELECT p_partkey AS id, left(trim(replace(regexp_replace(regexp_replace(trim(n, '"'), '(?i)^\\s*entradas\\s+', ''),
    '\\s*\\([^)0-9]*[0-9][^)]*\\)\\s*$', ''), '"', ''), ' -'), 70) AS name
    FROM (SELECT p_partkey, '"Entradas ' || p_name || ' "' || p_type || '" (sala ' || p_size || ') ' AS n FROM part)""",
)
def _(s, d):
    p = v.table(s, d, "part")
    raw = F.concat(
        F.lit('"Entradas '), "p_name", F.lit(' "'), "p_type", F.lit('" (sala '), col("p_size").cast("string"), F.lit(") ")
    )
    return p.select(col("p_partkey").alias("id"), tx.clean_name(raw).alias("name"))


@query(
    "fn04_email_redaction",
    """SELECT doc_id, md5(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', '[email]', 'g')) AS masked,
    regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}') AS had_email FROM documents""",
)
def _(s, d):
    t = col("text")
    return v.docs(s, d).select("doc_id", F.md5(tx.mask_emails(t)).alias("masked"), t.rlike(tx.EMAIL).alias("had_email"))


@query(
    "fn05_price_range",
    """SELECT doc_id, CASE WHEN len(n) > 0 THEN list_min(n) WHEN contains(lower(text), 'the') THEN 0.0 END AS low,
    CASE WHEN len(n) > 0 THEN list_max(n) WHEN contains(lower(text), 'the') THEN 0.0 END AS high
    FROM (SELECT doc_id, text, list_transform(regexp_extract_all(text, '[0-9]+(?:[.,][0-9]+)?'), lambda x: CAST(replace(x, ',', '.') AS DOUBLE)) AS n FROM documents)""",
)
def _(s, d):
    t = col("text")
    return v.docs(s, d).select("doc_id", tx.price_low(t, "the").alias("low"), tx.price_high(t, "the").alias("high"))


@query(
    "fn06_family_name",
    "SELECT o_orderkey AS id, regexp_replace(o_orderpriority || ' fair ' || year(o_orderdate), '\\s*[0-9]{4}$', '') AS family FROM orders",
)
def _(s, d):
    o = v.table(s, d, "orders")
    name = F.concat("o_orderpriority", F.lit(" fair "), F.year("o_orderdate").cast("string"))
    return o.select(col("o_orderkey").alias("id"), tx.family_name(name).alias("family"))


@query(
    "fn07_date_functions",
    """SELECT o_orderkey AS id, CAST(year(x) AS INT) AS y, CAST(month(x) AS INT) AS m, CAST(quarter(x) AS INT) AS q, strftime(x, '%Y-%m') AS ym,
    CAST(isodow(x) AS INT) AS wd, isodow(x) >= 6 AS weekend, CAST(dayofyear(x) AS INT) AS doy, x + 7 AS next_week, CAST(x - DATE '1995-01-01' AS INT) AS days,
    CAST(date_trunc('month', x) AS DATE) AS month_start FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS x FROM orders)""",
)
def _(s, d):
    x = F.to_date("o_orderdate")
    return v.table(s, d, "orders").select(
        col("o_orderkey").alias("id"),
        F.year(x).alias("y"),
        F.month(x).alias("m"),
        F.quarter(x).alias("q"),
        F.date_format(x, "yyyy-MM").alias("ym"),
        dt.iso_weekday(x).alias("wd"),
        dt.is_weekend(x).alias("weekend"),
        F.dayofyear(x).alias("doy"),
        F.date_add(x, 7).alias("next_week"),
        dt.lead_days(x, F.lit("1995-01-01").cast("date")).alias("days"),
        F.to_date(F.trunc(x, "month")).alias("month_start"),
    )


@query(
    "fn08_rule_dates",
    """SELECT o_orderkey AS id, x + CAST(CASE WHEN isodow(x) >= 6 THEN 13 - isodow(x) ELSE 6 - isodow(x) END AS INT) AS sat_after,
    x - CAST(CASE WHEN isodow(x) = 7 THEN 1 WHEN isodow(x) = 6 THEN 7 ELSE isodow(x) + 1 END AS INT) AS sat_before,
    CAST(date_trunc('month', x) AS DATE) + CAST((7 - isodow(date_trunc('month', x))) + 7 AS INT) AS second_sunday
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS x FROM orders)""",
)
def _(s, d):
    x = F.to_date("o_orderdate")
    return v.table(s, d, "orders").select(
        col("o_orderkey").alias("id"),
        dt.saturday_after(x).alias("sat_after"),
        dt.saturday_before(x).alias("sat_before"),
        dt.nth_weekday(F.to_date(F.trunc(x, "month")), "Sun", 2).alias("second_sunday"),
    )


@query(
    "fn09_date_validity",
    """SELECT o_orderkey AS id, coalesce(a <= b AND year(a) - 1999 BETWEEN -2 AND 3, false) AS valid
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a,
    TRY_CAST(CAST(year(o_orderdate) AS VARCHAR) || '-' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '-' || lpad(CAST(o_custkey % 31 + 1 AS VARCHAR), 2, '0') AS DATE) AS b FROM orders)""",
)
def _(s, d):
    a = F.to_date("o_orderdate")
    end_text = F.concat(F.date_format("o_orderdate", "yyyy-MM-"), F.lpad((col("o_custkey") % 31 + 1).cast("string"), 2, "0"))
    b = end_text.try_cast("date")
    return v.table(s, d, "orders").select(
        col("o_orderkey").alias("id"), dt.dates_valid(a, b, F.lit("1999-06-01").cast("date")).alias("valid")
    )


@query(
    "fn10_math",
    """SELECT city, period, round(ln(adr), 6) AS ln_adr, round(exp(occ / 100), 6) AS e, round(sqrt(adr), 6) AS root, round(power(adr, 0.25), 6) AS fourth,
    abs(occ - 50) < 10 AS near_half, least(month, 6) AS lo, greatest(month, 6) AS hi FROM monthly""",
)
def _(s, d):
    return v.monthly(s, d).select(
        "city",
        "period",
        F.round(F.log("adr"), 6).alias("ln_adr"),
        F.round(F.exp(col("occ") / 100), 6).alias("e"),
        F.round(F.sqrt("adr"), 6).alias("root"),
        F.round(F.pow("adr", F.lit(0.25)), 6).alias("fourth"),
        (F.abs(col("occ") - 50) < 10).alias("near_half"),
        F.least("month", F.lit(6)).alias("lo"),
        F.greatest("month", F.lit(6)).alias("hi"),
    )


@query(
    "fn11_rounding",
    """SELECT stay_id, line, id, round_even(stay_nights / 4, 0) AS half_even, round(stay_nights / 4, 0) AS half_away FROM lines""",
)
def _(s, d):
    x = col("stay_nights") / 4
    return v.lines(s, d).select("stay_id", "line", "id", F.bround(x, 0).alias("half_even"), F.round(x, 0).alias("half_away"))


@query(
    "fn12_conditional_text",
    """SELECT city, period, CASE WHEN n < 3 THEN 'few' WHEN n < 8 THEN 'some' END AS note FROM monthly""",
)
def _(s, d):
    return v.monthly(s, d).select("city", "period", F.when(col("n") < 3, "few").when(col("n") < 8, "some").alias("note"))


@query(
    "fn13_arrays_maps_json",
    """SELECT id, CAST(x + i AS BIGINT) AS step, i AS i FROM (SELECT id, round(x) AS x FROM points), (SELECT unnest([0, 1, 2]) AS i)""",
)
def _(s, d):
    p = v.points(s, d).select("id", F.bround("x").alias("x"))
    packed = p.select("id", F.to_json(F.struct(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct(i.alias("i"), (col("x") + i).cast("bigint").alias("step"))).alias("steps"))).alias("j"))
    back = packed.select("id", F.explode(F.from_json("j", "steps array<struct<i:int,step:bigint>>")["steps"]).alias("e"))
    return back.select("id", "e.step", "e.i")
