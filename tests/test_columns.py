import datetime as dt

import pytest
from pyspark.sql import functions as F

from nightshare.functions import cleaning as c
from nightshare.functions import dates as d
from nightshare.functions import geometry as geo
from nightshare.functions import text as tx
from nightshare.operators import quality as qa


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("text, price", [("$1,234.50", 1234.5), ("80", 80.0), (None, None), ("n/a", None), ("$9,999.00", 9999.0)])
def test_price(spark, text, price):
    assert one(spark, text, c.parse_price) == price


@pytest.mark.parametrize("text, price", [("€ 85.00", 85.0), ("$9,999.00", None), ("0", None), ("$9,998.99", 9998.99), ("", None)])
def test_strict_price(spark, text, price):
    assert one(spark, text, c.parse_price_strict) == price


@pytest.mark.parametrize("text, flag", [("t", True), ("f", False), (None, None), ("x", None)])
def test_tri_bool(spark, text, flag):
    assert one(spark, text, c.tri_bool) is flag


@pytest.mark.parametrize("text, taken", [("f", 1), ("False", 1), ("t", 0), (None, 0), ("?", 0)])
def test_taken(spark, text, taken):
    assert one(spark, text, c.is_taken) == taken


@pytest.mark.parametrize(
    "text, fixed",
    [
        ("Donostia-San SebastiÃ¡n", "Donostia-San Sebastián"),
        ("LekeitioÃ", "LekeitioÃ"),  # cut off in the middle of a letter: left as it is
        ("Ã€ € 5", "Ã€ € 5"),  # a sign outside latin-1
        ("Getxo", "Getxo"),
        (None, None),
    ],
)
def test_mojibake(spark, text, fixed):
    assert one(spark, text, c.repair_mojibake) == fixed


@pytest.mark.parametrize(
    "text, status, kind",
    [
        (None, "none", None),
        ("Exempt - hotel ", "exempt", "hotel"),
        ("Exempt", "exempt", None),
        ("Basque Country - Regional registration number: X1", "registered", None),
        ("Exempt - rural<br />Spain - National", "exempt", "rural"),
        ("soon", "free text", None),
        ("Spain - National registration", "registered", None),
    ],
)
def test_licence(spark, text, status, kind):
    assert one(spark, text, c.licence_status) == status
    assert one(spark, text, c.exempt_type) == kind


def test_flags_are_never_null(spark):
    row = spark.createDataFrame([(None, None), (9999.0, 28), (80.0, 27)], "p double, n int").select(
        c.price_missing(F.col("p")).alias("m"), c.price_outlier(F.col("p")).alias("o"), c.long_stay(F.col("n")).alias("l")
    )
    assert [tuple(r) for r in row.collect()] == [(True, False, False), (False, True, True), (False, False, False)]


@pytest.mark.parametrize("n, label", [(0, None), (1, "1-2"), (2, "1-2"), (4, "3-4"), (6, "5-6"), (99, "7+"), (100, None)])
def test_capacity_band(spark, n, label):
    assert one(spark, n, c.capacity_band, "int") == label


@pytest.mark.parametrize("n, level", [(100, 1), (99, 2), (49, 3), (29, 4), (None, None)])
def test_reliability(spark, n, level):
    assert one(spark, n, c.reliability_level, "int") == level


@pytest.mark.parametrize("share, pct", [(0.125, 12), (0.375, 38), (-1.0, 0), (2.0, 100)])
def test_percent_rounds_to_even(spark, share, pct):
    assert one(spark, share, c.clip01_percent, "double") == pct


def test_prefix_takes_the_first(spark):
    assert one(spark, "Donostia / X", lambda x: c.by_prefix(x, {"Don": "first", "Donostia": "second"}, "Other")) == "first"
    assert one(spark, "Irun", lambda x: c.by_prefix(x, {"Don": "first"}, "Other")) == "Other"
    assert one(spark, "Irun", lambda x: c.by_prefix(x, {"Don": "first"})) is None


def test_stressed_flag_with_null_zone(spark):
    rows = spark.createDataFrame([("B", None), ("B", "z"), ("D", "q"), ("E", "z")], "city string, zone string")
    out = rows.select(c.stressed_flag(F.col("city"), F.col("zone"), ["D"], {"B": ["z"]}).alias("f"))
    assert [r["f"] for r in out.collect()] == ["no", "yes", "yes", "no"]


def test_text_helpers(spark):
    assert one(spark, "Ñandú, ÁÉ 3", tx.text_key) == "nanduae3"
    assert one(spark, '"Entradas  Gran Concierto" (Sala 2)', tx.clean_name) == "Gran Concierto"
    assert one(spark, "Fiesta (mayor)", tx.clean_name) == "Fiesta (mayor)"
    assert one(spark, "x" * 100, tx.clean_name) == "x" * 70
    assert one(spark, "write to a.b@mail.eus now", tx.mask_emails) == "write to [email] now"
    assert one(spark, "10,50 - 20 €", tx.price_low) == 10.5
    assert one(spark, "10,50 - 20 €", tx.price_high) == 20.0
    assert one(spark, "Entrada GRATIS", tx.price_low) == 0.0
    assert one(spark, "ask", tx.price_low) is None
    assert one(spark, "Jazz 2024", tx.family_name) == "Jazz"


def test_rule_dates(spark):
    day = lambda y, m, n: dt.date(y, m, n)
    assert one(spark, day(2024, 8, 15), d.saturday_after, "date") == day(2024, 8, 17)
    assert one(spark, day(2024, 8, 17), d.saturday_after, "date") == day(2024, 8, 24)
    assert one(spark, day(2024, 8, 15), d.saturday_before, "date") == day(2024, 8, 10)
    assert one(spark, day(2024, 8, 17), d.saturday_before, "date") == day(2024, 8, 10)
    assert one(spark, day(2024, 11, 1), lambda x: d.nth_weekday(x, "Sun", 2), "date") == day(2024, 11, 10)
    assert one(spark, day(2024, 12, 1), lambda x: d.nth_weekday(x, "Sun", 2), "date") == day(2024, 12, 8)
    assert one(spark, day(2024, 9, 2), d.iso_weekday, "date") == 1


def test_utm_known_point(spark):
    # A tower in Toronto, 43 38' 33.24" N, 79 23' 13.7" W, is published as zone 17 630084 m E, 4833438 m N.
    lat, lon = 43 + 38 / 60 + 33.24 / 3600, -(79 + 23 / 60 + 13.7 / 3600)
    p = spark.createDataFrame([(lon, lat)], "lon double, lat double")
    e, n = geo.utm(F.col("lon"), F.col("lat"), 17)
    row = p.select(e.alias("e"), n.alias("n")).first()
    assert abs(row["e"] - 630084) < 1 and abs(row["n"] - 4833438) < 1


def test_checks_block(spark):
    df = spark.createDataFrame([("t", 1), ("x", 2), (None, 3)], "flag string, n int")
    report = qa.check_report(df, {"flag": (qa.BLOCK, qa.allowed_values(F.col("flag"), ["t", "f"])), "n": (qa.WARN, qa.in_range(F.col("n"), 2, 3))})
    assert {r["rule"]: r["violations"] for r in report.collect()} == {"flag": 1, "n": 1}
    with pytest.raises(qa.BlockedByCheck, match="flag: 1"):
        qa.enforce(report)
    qa.enforce(report.where("rule = 'n'"))


def test_reconcile(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert {tuple(r) for r in qa.reconcile_sets(a, b, ["k"]).collect()} == {(1, "missing"), (3, "surplus")}
    assert {tuple(r) for r in qa.reconcile_counts(a, b, ["k"]).collect()} == {(1, 1, 0, -1), (2, 2, 1, -1), (3, 0, 1, 1)}
