"""Loads whose checks are counted while they write, and captures whose files are corrected."""

import os

import pytest
from pyspark.sql import functions as F

from nightshare.operators import quality as qa
from nightshare.plans import gold, silver
from nightshare.sources import writers as wr

CAL = "city string, snapshot_date date, listing_id string, date string, available string, minimum_nights string, maximum_nights string"


def calendar(spark, rows):
    df = spark.createDataFrame([(c, s, i, d, a, "2", "30") for c, s, i, d, a in rows], CAL.replace("snapshot_date date", "snapshot_date string"))
    return df.withColumn("snapshot_date", F.to_date("snapshot_date"))


def rows_of(spark, path):
    return sorted((r.city, str(r.snapshot_date), r.listing_id, str(r.date), r.available) for r in spark.read.parquet(path).collect())


def test_load_replaces_its_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    silver.load_calendar(calendar(spark, [("A", "2025-01-01", "1", "2025-01-02", "t"), ("B", "2025-01-01", "2", "2025-01-02", "f")]), path)
    report = silver.load_calendar(calendar(spark, [("B", "2025-01-01", "3", "2025-01-02", "t"), ("B", "2025-02-01", "3", "2025-01-02", "t")]), path)
    assert {r.rule: r.violations for r in report.collect()}["night_not_before_capture"] == 1
    assert rows_of(spark, path) == [("A", "2025-01-01", 1, "2025-01-02", True), ("B", "2025-01-01", 3, "2025-01-02", True), ("B", "2025-02-01", 3, "2025-01-02", True)]
    assert not [n for _, d, _ in os.walk(path) for n in d if n.startswith(("_", "."))]


@pytest.mark.parametrize(
    "bad, rule",
    [
        ([("A", "2025-01-01", "1", "2025-01-02", "f")], "unique city, snapshot_date, listing_id, date: 1"),
        ([("A", "2025-01-01", "5", "2025-01-02", "yes")], "available is t or f: 1, available: 1"),
        ([("A", "2025-01-01", "x", "2025-01-02", "f")], "listing_id: 1"),
        ([("A", "2025-01-01", "7", None, "f")], "date: 1"),
    ],
)
def test_blocked_load_leaves_the_table_alone(spark, tmp_path, bad, rule):
    path, good = str(tmp_path / "t"), [("A", "2025-01-01", "1", "2025-01-02", "t")]
    silver.load_calendar(calendar(spark, good), path)
    before = rows_of(spark, path)
    with pytest.raises(qa.BlockedByCheck, match=rule):
        silver.load_calendar(calendar(spark, good + bad), path)
    assert rows_of(spark, path) == before
    assert not [n for n in os.listdir(path) if n.startswith("_staged")]


def test_duplicate_listing_blocks_and_group_names_are_repaired(spark, tmp_path):
    from nightshare.catalog.silver import BOXES, raw_listings

    raw = raw_listings(spark, "/root/testdata/sf0.001")
    with pytest.raises(qa.BlockedByCheck, match="unique city, snapshot_date, id"):
        silver.load_listings(raw.unionByName(raw.limit(1)), str(tmp_path / "t"), BOXES)
    assert not (tmp_path / "t").exists() or not [n for n in os.listdir(tmp_path / "t") if not n.startswith(".")]
    assert {r.g[:5] for r in silver.silver_listings(raw).select(F.col("neighbourhood_group_cleansed").alias("g")).distinct().collect()} == {"Álava"}


def test_checks_are_counted_in_the_pass_that_writes(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(1000).selectExpr("id", "id % 3 AS k").mapInPandas(count, "id long, k long")
    report = wr.write_observed(df, str(tmp_path / "t"), {"odd": (qa.WARN, F.col("id") % 2 == 1)}, ("k",), ("id",))
    assert {r.rule: r.violations for r in report.collect()} == {"odd": 500, "unique id": 0, "rows written": 0}
    assert seen.value == 1000 and spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_table_without_keys_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (5, 3):
        wr.write_observed(spark.range(n), path, {}, ())
    assert spark.read.parquet(path).count() == 3 and os.listdir(tmp_path) == ["t"]


def test_gold_keys_block(spark, tmp_path):
    zones = spark.createDataFrame([("A", "x", "A|x"), ("A", "y", "A|y")], "city string, zone string, zone_id string")
    listings = spark.createDataFrame([(1, "A|x")], "listing_id int, zone_id string")
    fact = spark.createDataFrame([(1, "A_1", 5.0), (1, "A_2", 5.0)], "listing_id int, snapshot_id string, price double")
    cal = spark.createDataFrame([(1, "A_1", True)], "listing_id int, snapshot_id string, capture_missing boolean")
    args = lambda z=zones, f=fact: (z, listings, f, cal, str(tmp_path), "city", "zone")
    report = {(r.table, r.rule): r.violations for r in gold.load_gold(*args(), {"A": ["y"]}).collect()}
    assert report["fact_calendar", "capture missing"] == 1 and report["dim_zone", "declared zones found"] == 0
    with pytest.raises(qa.BlockedByCheck, match="declared zones found"):
        gold.load_gold(*args(), {"A": ["z"]})
    with pytest.raises(qa.BlockedByCheck, match="unique zone_id"):
        gold.load_gold(*args(z=zones.unionByName(zones)))
    with pytest.raises(qa.BlockedByCheck, match="unique listing_id, snapshot_id"):
        gold.load_gold(*args(f=fact.unionByName(fact)))
    assert spark.read.parquet(f"{tmp_path}/fact_listing_snapshot").count() == 2
