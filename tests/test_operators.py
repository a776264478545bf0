import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightshare.operators import controls as ct
from nightshare.operators import picks
from nightshare.operators import prefix as pf
from nightshare.operators import spatial as sp
from nightshare.plans import audit as au


def values(seed, n):
    r = random.Random(seed)
    # One group holds most rows; values repeat, are negative, tiny, huge and missing.
    rows = []
    for _ in range(n):
        k = "hot" if r.random() < 0.6 else r.choice(["a", "b", None])
        v = r.choice([None, 0.0, -5.5, r.gauss(100, 30), r.expovariate(0.001), -r.random() * 1e-9, r.random() * 1e12, 42.0])
        rows.append((k, v))
    return rows


def test_quantiles_match_numpy(spark):
    rows = values(1, 4000)
    df = spark.createDataFrame(rows, "k string, v double")
    qs = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q90": 0.9, "q100": 1.0}
    got = {r["k"]: r for r in pf.group_quantiles(df, ["k"], "v", qs, count_as="n").collect()}
    for k in {"hot", "a", "b", None}:
        x = np.array([v for kk, v in rows if kk == k and v is not None])
        assert got[k]["n"] == len(x)
        for name, p in qs.items():
            assert got[k][name] == pytest.approx(np.quantile(x, p), rel=1e-12, abs=1e-15)


def test_quantiles_without_keys_and_all_null_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("b", None)], "k string, v double")
    assert [tuple(r) for r in pf.group_quantiles(df, ["k"], "v", {"m": 0.5}).collect()] == [("a", 2.5)]
    assert pf.group_quantiles(df, [], "v", {"m": 0.5}).first()["m"] == 2.5


def slices(df):
    """Value and slice of every row of (k, v)."""
    return pf._sliced(df.select(F.struct("k").alias("__key"), F.col("v").alias("__v"), F.lit(1).alias("__n"))).select(F.col("__key.k").alias("k"), F.col("__v").alias("v"), F.col("__slice").alias("s"))


def test_slices_never_fall(spark):
    xs = sorted([-1e300, -7.0, -1e-30, -0.0, 0.0, 1e-30, 1e-9, 0.1, 0.1000001, 1.0, 99.99, 100.0, 1e300, float("inf")] + [random.Random(2).uniform(-1e4, 1e4) for _ in range(500)])
    got = [r["s"] for r in sorted(slices(spark.createDataFrame([("a", x) for x in xs], "k string, v double")).collect(), key=lambda r: r["v"])]
    assert got == sorted(got) and got[-1] > 200


def test_hot_group_is_spread_over_slices(spark):
    df = spark.range(20000).select(F.lit("hot").alias("k"), (F.rand(3) * 5000 + 20).alias("v"))
    assert slices(df).groupBy("s").count().agg(F.max("count")).first()[0] < 20000 * 0.02


def test_prefix_sums(spark):
    df = spark.createDataFrame([("a", 1.0, 2), ("a", 3.0, 1), ("a", 200.0, 5), (None, 7.0, 4)], "k string, v double, n int")
    got = {(r["k"], r["v"]): (r["before"], r["total"]) for r in pf.prefix_sums(df, ["k"], "v", "n").collect()}
    assert got == {("a", 1.0): (0, 8), ("a", 3.0): (2, 8), ("a", 200.0): (3, 8), (None, 7.0): (0, 4)}


def test_quantile_plan_shares_one_layout(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.rand(1).alias("v"))
    out = pf.group_quantiles(df, ["k"], "v", {"m": 0.5})
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan


def test_nearest_capture_and_ties(spark):
    rows = [(1, "n1", 5, 0), (1, "n1", 2, 1), (1, "n1", 2, 0), (1, "n2", 40, 1)]
    df = spark.createDataFrame(rows, "id int, night string, lead int, taken int")
    assert [tuple(r) for r in picks.nearest_capture(df, ["id", "night"], tie=["taken"]).collect()] == [(1, "n1", 2, 0)]


def test_always_blocked(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (2, 0)], "id int, taken int")
    assert {r["id"] for r in picks.drop_always_blocked(df, ["id"]).collect()} == {2}


def test_stable_panel_and_mode(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "a"), (3, "b"), (3, "a")], "id int, s string")
    assert {r["id"] for r in picks.stable_panel(df, "id", "s").collect()} == {1, 3}
    assert {tuple(r) for r in picks.mode_of(df, ["id"], "s").collect()} == {(1, "a"), (2, "a"), (3, "a")}


def test_class_breaks(spark):
    df = spark.createDataFrame([("z", float(x)) for x in (1, 1, 1, 2, 3, 4, 5, 6, 7, 8)], "k string, v double")
    # Positions 2, 4, 6 and 8 of the sorted values; the first equals the smallest and is left out.
    assert picks.class_breaks(df, ["k"], "v").first()["breaks"] == [3.0, 5.0, 7.0]
    one = spark.createDataFrame([("z", 5.0)], "k string, v double")
    assert picks.class_breaks(one, ["k"], "v").first()["breaks"] == []


def test_controls_match_brute_force(spark):
    r = random.Random(5)
    start = dt.date(2025, 3, 1)
    series = {("c%d" % c, start + dt.timedelta(days=i)): (r.random(), r.randint(0, 20)) for c in range(2) for i in range(90) if r.random() < 0.9}
    excluded = {k for k in series if r.random() < 0.1}
    rows = [(c, n, v, lead) for (c, n), (v, lead) in series.items()]
    df = spark.createDataFrame(rows, "city string, night date, occ double, lead int")
    ex = spark.createDataFrame(list(excluded), "city string, night date")
    got = {(x["city"], x["night"]): (x["control"], x["n_controls"]) for x in ct.with_controls(df, df, ex).collect()}
    want = {}
    for (c, n), (_, lead) in series.items():
        pool = [
            v for (c2, n2), (v, l2) in series.items()
            if c2 == c and n2 != n and n2.weekday() == n.weekday() and abs((n2 - n).days) <= 21 and abs(l2 - lead) <= 7 and (c2, n2) not in excluded
        ]
        if len(pool) >= 2:
            want[(c, n)] = (sum(pool) / len(pool), len(pool))
    assert got.keys() == want.keys() and len(want) > 50
    for k, (m, n) in want.items():
        assert got[k][0] == pytest.approx(m) and got[k][1] == n


def test_exclusion_set(spark):
    day = lambda n: dt.date(2025, 5, n)
    ev = spark.createDataFrame([("A", day(10), day(11))], "city string, first_night date, last_night date")
    series = spark.createDataFrame([(c, day(i)) for c in "AB" for i in range(1, 21)], "city string, night date")
    hol = spark.createDataFrame([(day(1),), (day(16),)], "night date")
    got = {(x["city"], x["night"].day) for x in ct.exclusion_set(ev, series, holidays=hol).collect()}
    assert got == {("A", i) for i in (9, 10, 11, 12)} | {(c, i) for c in "AB" for i in (1, 15, 16)}


def test_date_block_over_new_year(spark):
    days = spark.createDataFrame([(dt.date(2024, 12, 19),), (dt.date(2024, 12, 20),), (dt.date(2025, 1, 7),), (dt.date(2025, 1, 8),)], "night date")
    assert {r["night"].day for r in ct.date_block(days, "12-20", "01-07").collect()} == {20, 7}


SQUARES = [
    ("A", [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]),
    ("B", [(10.0, 0.0), (20.0, 0.0), (20.0, 10.0), (10.0, 10.0), (10.0, 0.0)]),
    ("C", [(2.0, 2.0), (4.0, 2.0), (4.0, 4.0), (2.0, 4.0), (2.0, 2.0)]),
]


def test_point_in_polygon_edges(spark):
    polys = spark.createDataFrame(SQUARES, "code string, ring array<struct<x:double,y:double>>")
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, 10.0, 5.0), (3, 25.0, 5.0), (4, 3.0, 3.0), (5, -0.1, 5.0)], "id int, x double, y double")
    got = {r["id"]: r["district"] for r in sp.locate(pts, polys, 3.0).collect()}
    # A point on the shared border is in exactly one square; of overlapping ones the lowest code counts.
    assert got == {1: "A", 2: "B", 3: None, 4: "A", 5: None}


@pytest.mark.parametrize("size", [0.7, 3.0, 50.0])
def test_cell_size_does_not_matter(spark, size):
    r = random.Random(9)
    polys = spark.createDataFrame(SQUARES, "code string, ring array<struct<x:double,y:double>>")
    rows = [(i, r.uniform(-5, 25), r.uniform(-5, 15)) for i in range(300)]
    pts = spark.createDataFrame(rows, "id int, x double, y double")
    got = {x["id"]: x["district"] for x in sp.locate(pts, polys, size).collect()}
    for i, x, y in rows:
        assert got[i] == ("A" if 0 <= x < 10 and 0 <= y <= 10 else "B" if 10 <= x < 20 and 0 <= y <= 10 else None)


def test_hex_is_the_nearest_centre(spark):
    r = random.Random(4)
    rows = [(i, r.uniform(-2000, 2000), r.uniform(-2000, 2000)) for i in range(500)]
    pts = spark.createDataFrame(rows, "id int, x double, y double")
    for row in sp.with_hex(pts, 230.0).collect():
        def dist(q, rr):
            cx, cy = 230 * 3**0.5 * (q + rr / 2), 230 * 1.5 * rr
            return (cx - row["x"]) ** 2 + (cy - row["y"]) ** 2

        best = dist(row["q"], row["r"])
        assert best <= 230**2 + 1e-6
        assert all(best <= dist(row["q"] + a, row["r"] + b) + 1e-6 for a in (-1, 0, 1) for b in (-1, 0, 1))


def test_distinguishable_pairs_match_brute_force(spark):
    r = random.Random(8)
    rows = []
    for g in "xy":
        for _ in range(40):
            lo = round(r.uniform(0, 10), 1)
            rows.append((g, lo, lo + round(r.uniform(0, 3), 1)))
    df = spark.createDataFrame(rows, "g string, lo double, hi double")
    got = {x["g"]: (x["zones"], x["pairs"], x["apart"]) for x in au.distinguishable_pairs(df, "lo", "hi", ["g"]).collect()}
    for g in "xy":
        part = [(lo, hi) for gg, lo, hi in rows if gg == g]
        apart = sum(a[1] < b[0] or b[1] < a[0] for i, a in enumerate(part) for b in part[:i])
        assert got[g] == (40, 780, apart)


def test_bootstrap_agrees_with_theory(spark):
    r = random.Random(6)
    xs = [r.gauss(10, 2) for _ in range(400)]
    df = spark.createDataFrame([("z", i, x, x) for i, x in enumerate(xs)], "zone string, id int, m double, p double")
    a = au.bootstrap_ci(df, "zone", "id", "m", "p", replicates=200).first()
    half = 1.96 * np.std(xs, ddof=1) / 20
    assert (a["mean_high"] - a["mean_low"]) / 2 == pytest.approx(half, rel=0.2)
    assert a["mean_low"] < np.mean(xs) < a["mean_high"] and a["median_low"] <= np.median(xs) <= a["median_high"]
    b = au.bootstrap_ci(df.repartition(7), "zone", "id", "m", "p", replicates=200).first()
    assert tuple(a)[1:] == pytest.approx(tuple(b)[1:])


def test_locate_keeps_equal_points(spark):
    from nightshare.operators.spatial import locate

    points = spark.createDataFrame([(1, 0.5, 0.5), (1, 0.5, 0.5), (2, 9.0, 9.0), (3, None, 1.0)], "id int, x double, y double")
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    shapes = spark.createDataFrame([("b", square), ("a", square)], "code string, ring array<struct<x:double,y:double>>")
    got = sorted((r["id"], r["district"] or "") for r in locate(points, shapes, 1.0).collect())
    assert got == [(1, "a"), (1, "a"), (2, ""), (3, "")]


def test_fact_calendar_keeps_every_night(spark):
    import datetime as dt

    from nightshare.plans.gold import fact_calendar

    day = dt.date(2025, 1, 1)
    nights = spark.createDataFrame([("A", day, 1, day), ("A", day, None, day), (None, day, 2, day)], "city string, snapshot_date date, listing_id int, night date")
    captures = spark.createDataFrame([("A", day, 1, day), ("A", day, 1, dt.date(2024, 12, 31)), (None, day, 2, None)], "city string, snapshot_date date, listing_id int, capture_date date")
    got = sorted((r["city"] or "", r["listing_id"] or 0, r["lead_days"], r["capture_missing"]) for r in fact_calendar(nights, captures).collect())
    assert got == [("", 2, 0, True), ("A", 0, 0, True), ("A", 1, 1, False)]


def test_quantiles_with_nan_and_infinity(spark):
    from pyspark.sql import functions as F

    from nightshare.operators.prefix import group_quantiles

    rows = [("n", x) for x in (1.0, 2.0, 3.0, float("nan"), float("nan"))] + [("i", x) for x in (1.0, float("inf"), float("-inf"))]
    frame = spark.createDataFrame(rows, "k string, x double")
    want = {r["k"]: (r["m"], r["t"]) for r in frame.groupBy("k").agg(F.median("x").alias("m"), F.percentile("x", 1.0).alias("t")).collect()}
    got = {r["k"]: (r["m"], r["t"]) for r in group_quantiles(frame, ["k"], "x", {"m": 0.5, "t": 1.0}).collect()}
    assert repr(got["n"]) == repr(want["n"]) and got["i"] == (1.0, float("inf"))


def test_districts_of_several_parts_with_holes(spark):
    """Two parts, a hole and an island in it, against even-odd by hand; border cells alone are tested by ray."""
    box = lambda a, b, c, d: [(a, b), (c, b), (c, d), (a, d)]
    shapes = {"P": [box(0, 0, 10, 10), box(2, 2, 8, 8), box(4, 4, 6, 6), box(20, 0, 23, 3)], "Q": [[(10, 0), (20, 0), (15, 9)]]}
    polygons = spark.createDataFrame([(k, [[(float(x), float(y)) for x, y in [*r, r[0]]] for r in rings]) for k, rings in shapes.items()], "code string, rings array<array<struct<x:double,y:double>>>")
    rng = random.Random(4)
    points = [(rng.uniform(-2, 25), rng.uniform(-2, 12)) for _ in range(3000)] + [(5.0, 5.0), (3.0, 3.0), (10.0, 5.0), (2.0, 5.0)]

    def inside(x, y, rings):
        crossings = 0
        for r in rings:
            for (ax, ay), (bx, by) in zip(r, r[1:] + r[:1]):
                crossings += (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
        return crossings % 2 == 1

    df = spark.createDataFrame(points, "x double, y double")
    for size in (0.7, 3.0, 50.0):
        got = {(r.x, r.y): r.district for r in sp.locate(df, polygons, size).collect()}
        assert len(got) == len(points)
        assert all(got[x, y] == next((k for k in "PQ" if inside(x, y, shapes[k])), None) for x, y in points)
    cells = sp.polygon_cells(polygons, 0.7).groupBy("code", "__inner").count().collect()
    assert {(r["code"], r["__inner"]) for r in cells} == {("P", True), ("P", False), ("Q", True), ("Q", False)}
    names = sp.reference_points(polygons, df.withColumn("name", F.concat_ws(" ", "x", "y")), 1.0).count()
    assert names == sum(inside(x, y, rings) for x, y in points for rings in shapes.values())


@pytest.mark.parametrize("weighted", [False, True])
def test_hot_narrow_group_is_spread_and_exact(spark, weighted):
    """A group with nearly all rows, all within a thousandth, beside small ones: even slices, quantiles as the built-in ones."""
    df = spark.range(120000).select(
        F.when(F.col("id") % 50 == 0, F.col("id") % 7).otherwise(99).alias("k"),
        F.when(F.col("id") % 1000 == 1, float("nan")).when(F.col("id") % 1000 == 2, float("inf")).otherwise(100 + F.pmod(F.xxhash64("id"), F.lit(30011)) / 1e6).alias("v"),
        (F.col("id") % 3 + 1).alias("w"),
    )
    qs = {"a": 0.0, "b": 0.013, "c": 0.5, "d": 0.75, "e": 0.998, "f": 1.0}
    got = {r["k"]: r for r in pf.group_quantiles(df, ["k"], "v", qs, "n", weight="w" if weighted else None).collect()}
    p = f"array({', '.join(f'{x}D' for x in qs.values())})"
    want = df.groupBy("k").agg(F.expr(f"percentile(v, {p}{', w' if weighted else ''})").alias("q"), F.sum("w" if weighted else F.lit(1)).alias("n")).collect()
    for r in want:
        assert got[r["k"]]["n"] == r["n"]
        for name, x in zip(qs, r["q"]):
            assert repr(got[r["k"]][name]) == repr(x) or got[r["k"]][name] == pytest.approx(x, rel=1e-14)
    counts = df.select(F.struct("k").alias("__key"), F.col("v").alias("__v")).groupBy("__key", "__v").agg(F.expr("count(1) AS __n"))
    sizes = [r["count"] for r in pf._sliced(counts).where("__key.k = 99").groupBy("__slice").count().collect()]
    assert len(sizes) > 200 and max(sizes) < 4 * sum(sizes) / len(sizes)


def test_small_group_quantiles_equal_the_general_ones(spark):
    df = spark.range(3000).select((F.col("id") % 40).alias("k"), F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id"), F.lit(17)).cast("double")).alias("v"))
    a, b = (f(df.where("k <> 3 or v is null"), ["k"], "v", {"m": 0.5, "t": 0.9}, "n") for f in (pf.group_quantiles, pf.small_group_quantiles))
    a, b = (np.array(sorted(map(tuple, x.collect()))) for x in (a, b))
    assert len(a) == 39 and np.allclose(a, b, rtol=1e-14)


def test_accents_beyond_western_letters(spark):
    from nightshare.functions.text import text_key

    rows = spark.createDataFrame([("Šibenik",), ("Ōsaka",), ("Łódź Öl",), ("1º Día 2ª",), ("ﬁesta ½ m² Ⅷ",), ("ＡＢ１",)], "t string")
    want = ["sibenik", "osaka", "odzol", "1odia2a", "fiesta12m2viii", "ab1"]
    assert [r[0] for r in rows.select(text_key(rows.t)).collect()] == want
