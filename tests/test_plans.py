import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from nightshare.plans import archive as ar
from nightshare.plans import elasticity as el
from nightshare.plans import events as ev
from nightshare.plans import gold
from nightshare.plans import income as inc
from nightshare.plans import occupancy as occ
from nightshare.plans import peers as pe
from nightshare.plans.measures import evaluate

D = lambda s: dt.date.fromisoformat(s)


@pytest.fixture(scope="module")
def model(spark):
    # Zone z1 has three listings in two captures, z2 one listing, and listing 9 has no dimension row.
    rows = [(i, "A", D(s), p, p is None, p == 9999.0, i == 3) for s in ("2025-01-01", "2025-07-01") for i, p in ((1, 100.0), (2, 200.0), (3, 50.0), (4, None), (9, 80.0))]
    listings = spark.createDataFrame(rows, "listing_id int, city string, snapshot_date date, price double, price_missing boolean, price_outlier boolean, long_stay boolean")
    cal = []
    for s, taken in (("2025-01-01", 1), ("2025-07-01", 3)):
        for i in (1, 2, 3, 4, 9):
            for lead in (0, 10, 29, 30):
                cal.append((i, "A", D(s), D(s) + dt.timedelta(days=lead), lead, int(lead // 10 < taken)))
    calendar = spark.createDataFrame(cal, "listing_id int, city string, snapshot_date date, night date, lead int, taken int")
    dims = spark.createDataFrame([(1, "z1"), (2, "z1"), (3, "z1"), (4, "z2")], "listing_id int, zone string")
    snaps = spark.createDataFrame(
        [("A_1", "A", D("2025-01-01"), True, True, "4 winter"), ("A_2", "A", D("2025-07-01"), True, False, "2 summer")],
        "snapshot_id string, city string, snapshot_date date, is_complete boolean, has_price boolean, season string",
    )
    return {"listings": listings, "calendar": calendar, "dim_listing": dims, "dim_snapshot": snaps}


def by_zone(df):
    return {r["zone"]: r for r in df.collect()}


def test_measures_by_zone(model):
    names = ["listings", "median_adr", "occupancy", "revpar", "listings_per_month", "reliability", "winter_drop", "price_note", "listing_change"]
    got = by_zone(evaluate(model, names, ["zone"], steps=(3, 2, 1), least_priced=1))
    z1 = got["z1"]
    assert z1["listings"] == 3 and z1["median_adr"] == 150.0 and z1["listings_per_month"] == 3 and z1["reliability"] == 1
    # Near nights only: one of three in winter, all three in summer.
    assert z1["occupancy"] == pytest.approx(4 / 6) and z1["revpar"] == pytest.approx(100.0) and z1["winter_drop"] == pytest.approx(200 / 3)
    assert z1["listing_change"] == 0.0 and z1["price_note"] is not None
    assert got["z2"]["median_adr"] is None and got["z2"]["revpar"] is None and got["z2"]["listings"] == 1
    assert got[None]["listings"] == 1  # the orphan keeps a null member


def test_blank_rows_are_dropped(model):
    assert set(by_zone(evaluate(model, ["median_adr"], ["zone"]))) == {"z1", None}


def test_season_filter_is_replaced_for_the_winter_drop(model):
    out = by_zone(evaluate(model, ["winter_drop", "occupancy"], ["zone"], {"season": ["4 winter"]}, steps=(3, 2, 1)))
    assert out["z1"]["occupancy"] == pytest.approx(1 / 3) and out["z1"]["winter_drop"] == pytest.approx(200 / 3)


def test_grouping_by_season_and_over_all(model):
    rows = {r["season"]: r["occupancy"] for r in evaluate(model, ["occupancy"], ["season"]).collect()}
    assert rows == {"4 winter": pytest.approx(1 / 3), "2 summer": 1.0}
    total = evaluate(model, ["listings", "occupancy", "coverage_note", "winter_drop"], steps=(3, 2, 1)).first()
    assert total["listings"] == 5 and total["coverage_note"] is None and total["winter_drop"] == pytest.approx(200 / 3)


def test_dim_snapshot_keeps_captures_without_calendar(spark, model):
    listings = model["listings"]
    out = {r["snapshot_id"]: r for r in gold.dim_snapshot(listings, model["calendar"].where("snapshot_date < '2025-02-01'")).collect()}
    assert out["A_20250701"]["n_calendar"] is None and out["A_20250101"]["n_calendar"] == 20
    assert out["A_20250101"]["missing_share"] == 0.2 and out["A_20250101"]["has_price"] and out["A_20250101"]["season"] == "4 winter"
    assert gold.dim_snapshot(listings, model["calendar"].where("snapshot_date < '2025-02-01'"), inner=True).count() == 1


def test_fact_calendar_lead_falls_back_to_first_night(spark):
    cal = spark.createDataFrame([("A", D("2025-01-01"), i, D(n)) for i, n in ((1, "2025-01-05"), (1, "2025-01-07"), (2, "2025-01-05"))], "city string, snapshot_date date, listing_id int, night date")
    cap = spark.createDataFrame([("A", D("2025-01-01"), 2, D("2025-01-02"))], "city string, snapshot_date date, listing_id int, capture_date date")
    got = {(r["listing_id"], str(r["night"])): (r["lead_days"], r["capture_missing"]) for r in gold.fact_calendar(cal, cap).collect()}
    assert got == {(1, "2025-01-05"): (0, True), (1, "2025-01-07"): (2, True), (2, "2025-01-05"): (3, False)}


def test_dim_date_has_no_gaps(spark):
    b = spark.createDataFrame([(D("2025-12-30"), D("2026-01-02"))], "a date, b date")
    rows = gold.dim_date(b, "a", "b").collect()
    assert [(str(r["date"]), r["year_month"], r["quarter"], r["weekday"], r["weekend"]) for r in rows] == [
        ("2025-12-30", "2025-12", 4, 2, False), ("2025-12-31", "2025-12", 4, 3, False), ("2026-01-01", "2026-01", 1, 4, False), ("2026-01-02", "2026-01", 1, 5, False)]


def test_small_zones_show_their_count_only(spark):
    rows = [("big", float(i), 0.5) for i in range(1, 13)] + [("small", 10.0, 0.5)] * 3
    df = inc.with_income(spark.createDataFrame(rows, "zone string, price double, occ double"))
    got = by_zone(inc.income_by_zone(df))
    assert got["small"]["active"] == 3 and got["small"]["income_median"] is None
    assert got["big"]["price_median"] == 6.5 and got["big"]["income_median"] == pytest.approx(6.5 * 0.5 * 365 / 12)


def test_cube_levels(spark):
    rows = [("a", 1, float(i)) for i in range(12)] + [("a", 2, 5.0), ("b", 1, 7.0)]
    got = {(r["z"], r["c"], r["level"]): (r["n"], r["p50"]) for r in pe.cube_quantiles(spark.createDataFrame(rows, "z string, c int, p double"), "z", "c", "p").collect()}
    assert got[("a", 1, 0)] == (12, 5.5) and got[("a", 2, 0)] == (1, None) and got[("a", None, 1)][0] == 13
    assert got[(None, 1, 2)][0] == 13 and got[(None, None, 3)][0] == 14 and len(got) == 8


def test_elasticity_recovers_a_known_slope(spark):
    r = random.Random(3)
    rows = []
    for y in range(2018, 2026):
        for m in range(1, 13):
            o = 50 + 20 * math.sin(m / 2) + r.gauss(0, 4)
            rows.append(("A", y, m, f"{y}-{m:02d}", math.exp(4 + 0.02 * o + 0.03 * (y - 2018)), o))
    df = spark.createDataFrame(rows, "city string, year int, month int, period string, adr double, occ double")
    got = {x["method"]: x for x in el.price_elasticity(df).collect()}
    assert got["within year"]["pct_per_10pp"] == pytest.approx(100 * (math.exp(0.2) - 1), rel=1e-6)
    assert got["year over year"]["pct_per_10pp"] == pytest.approx(100 * (math.exp(0.2) - 1), rel=0.02)
    assert got["year over year"]["months"] == 84 and got["within year"]["r"] == pytest.approx(1.0)


def test_diff_in_diff_finds_a_planted_event(spark):
    rows = []
    for c in "ABC":
        for y in range(2018, 2024):
            for m in range(1, 13):
                bump = 0.3 if (c, y, m) == ("A", 2022, 5) else 0.0
                rows.append((c, y, m, f"{y}-{m:02d}", math.exp(4 + m / 50 + bump), 50.0 + 100 * bump))
    df = spark.createDataFrame(rows, "city string, year int, month int, period string, adr double, occ double")
    got = {(x["city"], x["period"]): x for x in el.diff_in_diff(df, ["2022-05"]).collect()}
    # The year's own mean takes a twelfth of the bump.
    assert got[("A", "2022-05")]["adr_uplift_pct"] == pytest.approx(100 * (math.exp(0.3 * 11 / 12) - 1))
    assert got[("A", "2022-05")]["occ_uplift_pp"] == pytest.approx(30.0)
    noise = {x["city"]: x for x in el.did_noise(df, ["2022-05"]).collect()}
    assert noise["B"]["months"] == 71 and noise["B"]["deviation"] < 1.0


def test_placebo_mean_is_near_zero(spark):
    r = random.Random(11)
    rows = [("A", D("2024-01-01") + dt.timedelta(days=i), r.random(), 5) for i in range(400)]
    series = spark.createDataFrame(rows, "city string, night date, occ double, lead int")
    none = series.select("city", "night").where("false")
    p = ev.placebo(series, none).first()
    assert p["nights"] == 400 and abs(p["mean"]) < 5 and p["p5"] < p["mean"] < p["p95"]


def test_event_effect_on_a_planted_event(spark):
    rows = [("A", D("2024-03-01") + dt.timedelta(days=i), 0.9 if i == 30 else 0.5, 5) for i in range(61)]
    series = spark.createDataFrame(rows, "city string, night date, occ double, lead int")
    event = spark.createDataFrame([("Fair", "A", "fair", D("2024-03-31"), D("2024-04-01"))], "event string, city string, kind string, first_night date, last_night date")
    from nightshare.operators.controls import exclusion_set

    out = ev.event_effect(event, series, exclusion_set(event, series)).first()
    assert out["nights"] == 2 and out["diff_pp"] == pytest.approx(20.0) and out["coverage"] == 1.0 and out["control_occ"] == pytest.approx(50.0)


def test_daily_occupancy_moves_to_the_reference_lead(spark):
    rows = [(1, "A", D("2025-01-01") + dt.timedelta(days=i), lead, int(i % 10 < (8 if lead == 0 else 4))) for i in range(20) for lead in (0, 15)]
    df = spark.createDataFrame(rows, "listing_id int, city string, night date, lead int, taken int")
    got = [r["pct"] for r in occ.daily_occupancy(df).collect()]
    # Seen on the day 80 per cent are taken, at the reference 40: each night comes down by 40 points, held at zero.
    assert sorted(set(got)) == [0, 60]


def test_archive(spark):
    schema = "id int, name string, price double"
    first = ar.merge(None, spark.createDataFrame([(1, "a", 1.0), (2, "b", None)], schema), "id", F.lit("d1"))
    nxt = spark.createDataFrame([(2, "b", 5.0), (3, "c", 1.0)], schema)
    log = [tuple(r) for r in ar.changes(first, nxt, "id", ["name", "price"], F.lit("d2")).collect()]
    assert log == [(2, "d2", "price", None, "5.0")]
    got = {r["id"]: (r["first_seen"], r["last_seen"], r["captures"], r["price"]) for r in ar.merge(first, nxt, "id", F.lit("d2")).collect()}
    assert got == {1: ("d1", "d1", 1, 1.0), 2: ("d1", "d2", 2, 5.0), 3: ("d2", "d2", 1, 1.0)}


def test_joins_and_leaves(spark):
    rows = [(1, "d1"), (2, "d1"), (2, "d2"), (3, "d2"), (3, "d3"), (1, "d3")]
    df = spark.createDataFrame(rows, "id int, photo string")
    assert {tuple(r) for r in ar.joins_and_leaves(df, "id", "photo").collect()} == {("d2", 1, 1), ("d3", 1, 1)}


def test_first_source_wins_in_the_event_calendar(spark):
    raw = spark.createDataFrame(
        [("Óperá (2)", "5 €", "Bilbao", "show", "Hall", "2025-06-01", "2025-06-01"), ("Fair", "", "Bilbao", "show", "Hall", "2025-02-30", "2025-06-01"), ("CANCELADO x", "", "Bilbao", "show", "Hall", "2025-06-02", "2025-06-02")],
        "name string, price string, place string, kind string, venue string, start string, end string",
    )
    today = F.lit("2025-05-01").cast("date")
    agenda = ev.normalise_events(raw, today, {"Bilbao": "Bilbao"})
    curated = spark.createDataFrame([("opera", "Bilbao", "big", D("2025-06-01"), D("2025-06-03"))], "name string, city string, kind string, start_date date, end_date date")
    out = ev.event_calendar(agenda, curated, today, ["Bilbao"], ["show"], "Hall").collect()
    assert [(r["name"], r["rank"], str(r["end_date"])) for r in out] == [("opera", 1, "2025-06-03")]


def test_constant_series_has_no_correlation(spark):
    rows = [("A", "2024-07", 50.0, 50.0), ("A", "2024-08", 50.0, 60.0), ("B", "2024-07", 40.0, 41.0), ("B", "2024-08", 50.0, 51.0)]
    df = spark.createDataFrame(rows, "city string, period string, official double, measured double")
    _, summary = el.validate_occupancy(df.drop("measured"), df.drop("official"))
    got = {r["city"]: (r["r"], r["summer_difference"]) for r in summary.collect()}
    assert got["A"] == (None, 5.0) and got["B"][0] == pytest.approx(1.0)
