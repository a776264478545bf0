"""Gold tables: snapshot, zone, listing and date dimensions, listing and calendar facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightshare.functions import cleaning as c
from nightshare.functions import dates as dt
from nightshare.operators import quality as qa
from nightshare.operators.prefix import attach
from nightshare.sources.writers import write_observed

COMPLETE_RATIO = 0.85
MIN_PRICED_SHARE = 0.5


def dim_snapshot(
    listings: DataFrame, calendar: DataFrame, city: str = "city", day: str = "snapshot_date",
    missing: str = "price_missing", complete_ratio: float = COMPLETE_RATIO, inner: bool = False,
) -> DataFrame:
    """One row per city and capture. A capture without calendar rows stays, with a null row count, unless ``inner``."""
    keys = [city, day]
    n_listings = listings.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_listings"),
        F.round(F.avg(F.col(missing).cast("double")), 4).alias("missing_share"),
    )
    n_calendar = calendar.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_calendar"))
    base = n_listings.join(n_calendar, keys, "inner" if inner else "left")
    # A city has one row per capture here, so its exact median is over a short list.
    median = base.groupBy(city).agg(F.median("n_listings").alias("city_median"))
    return attach(base, median, [city]).select(
        c.snapshot_key(F.col(city), F.col(day)).alias("snapshot_id"),
        *keys,
        "n_listings",
        "n_calendar",
        "city_median",
        F.round(F.col("n_listings") / F.col("city_median"), 3).alias("ratio"),
        (F.round(F.col("n_listings") / F.col("city_median"), 3) >= complete_ratio).alias("is_complete"),
        "missing_share",
        (F.col("missing_share") < MIN_PRICED_SHARE).alias("has_price"),
        c.season(F.month(day)).alias("season"),
    )


def dim_zone(
    listings: DataFrame, city: str, zone: str, group: str, names: Mapping[str, str] | None = None,
    stressed_cities: Sequence[str] = (), stressed_zones: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Distinct zones with key, shown name and declared-market flag. The key is built before renaming."""
    zones = listings.select(city, group, zone).where(F.col(zone).isNotNull()).distinct()
    keyed = zones.withColumn("zone_id", c.zone_key(F.col(city), F.col(zone))).withColumn(
        "stressed", c.stressed_flag(F.col(city), F.col(zone), list(stressed_cities), stressed_zones or {})
    )
    return c.rename_values(keyed, zone, names or {})


def dim_listing(listings: DataFrame, key: str, snapshot: str, attributes: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Latest attributes of each listing with the span of captures it was seen in, in one aggregate."""
    order = F.struct(snapshot, *tie) if tie else F.col(snapshot)
    return listings.groupBy(key).agg(
        *[F.max_by(a, order).alias(a) for a in attributes],
        F.min(snapshot).alias("first_seen"), F.max(snapshot).alias("last_seen"), F.count(F.lit(1)).alias("captures"),
    )


def dim_date(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """A row per day between the bounds (one row with two dates), without gaps."""
    day = F.col("date")
    return bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("date")).select(
        "date",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.quarter(day).alias("quarter"),
        dt.iso_weekday(day).alias("weekday"),
        dt.is_weekend(day).alias("weekend"),
    )


def fact_listing_snapshot(listings: DataFrame, city: str, day: str, columns: Sequence[str]) -> DataFrame:
    return listings.select(c.snapshot_key(F.col(city), F.col(day)).alias("snapshot_id"), "listing_id", *columns)


def fact_calendar(
    calendar: DataFrame, captures: DataFrame, keys: Sequence[str] = ("city", "snapshot_date", "listing_id"),
    night: str = "night", capture: str = "capture_date",
) -> DataFrame:
    """Night rows with their lead and a flag for a missing capture date.

    The lead counts from the listing's capture date or, where that is missing, from the
    first night its calendar shows. First nights are a small aggregate per listing and
    capture; they join together with the capture dates, so the calendar is joined once.
    No night is lost or doubled: null keys match null keys, and of several capture rows of
    one key the earliest date counts.
    """
    keys = list(keys)
    first = calendar.groupBy(*keys).agg(F.min(night).alias("__first"))
    starts = attach(first, captures.groupBy(*keys).agg(F.min(capture).alias(capture)), keys)
    joined = attach(calendar, starts, keys)
    return joined.select(
        *calendar.columns,
        F.datediff(night, F.coalesce(capture, "__first")).alias("lead_days"),
        F.col(capture).isNull().alias("capture_missing"),
    )


def lead_days_global(calendar: DataFrame, snapshot: str, night: str = "night") -> DataFrame:
    """Lead counted from the first night of the whole capture."""
    first = calendar.groupBy(snapshot).agg(F.min(night).alias("__first"))
    return attach(calendar, first, [snapshot]).withColumn("lead_global", F.datediff(night, "__first")).drop("__first")


def star(facts: DataFrame, listings: DataFrame, snapshots: DataFrame, dates: DataFrame | None = None, night: str = "night") -> DataFrame:
    """Facts with their dimensions. Left joins: a fact without a member keeps a null member."""
    out = facts.join(listings, "listing_id", "left").join(
        snapshots.drop("snapshot_id"), ["city", "snapshot_date"], "left"
    )
    return out if dates is None else out.join(dates, out[night] == dates["date"], "left").drop("date")


def unmatched_zones(zones: DataFrame, city: str, zone: str, declared: Mapping[str, Sequence[str]]) -> DataFrame:
    """Declared zones that no zone of the dimension matches by name; the lists are short and fixed."""
    named = zones.sparkSession.createDataFrame([(a, b) for a, names in declared.items() for b in names], "__city string, __zone string")
    return named.join(zones, (F.col("__city") == F.col(city).cast("string")) & (F.col("__zone") == F.col(zone)), "left_anti").select(F.col("__city").alias("city"), F.col("__zone").alias("zone"))


def load_gold(zones: DataFrame, listings: DataFrame, fact: DataFrame, calendar: DataFrame, root: str, city: str, zone: str, declared: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Dimensions and facts to their tables below ``root``, each published only if its keys are unique. Returns the reports together.

    ``zones`` with the zone names as they are declared; a declared zone that is not found blocks the zone dimension.
    """
    missing = unmatched_zones(zones, city, zone, declared or {}).count() if declared else 0
    reports = [
        write_observed(zones.withColumn("__missing", F.lit(missing) > 0), f"{root}/dim_zone", {"declared zones found": (qa.BLOCK, F.col("__missing"))}, (), ("zone_id",), ("__missing",)),
        write_observed(listings, f"{root}/dim_listing", {"listing_id": (qa.BLOCK, qa.not_null(F.col("listing_id")))}, (), ("listing_id",)),
        write_observed(fact, f"{root}/fact_listing_snapshot", {"snapshot_id": (qa.BLOCK, qa.not_null(F.col("snapshot_id")))}, ("snapshot_id",), ("listing_id", "snapshot_id")),
        write_observed(calendar, f"{root}/fact_calendar", {"capture missing": (qa.WARN, F.col("capture_missing"))}, ("snapshot_id",)),
    ]
    out = None
    for name, report in zip(("dim_zone", "dim_listing", "fact_listing_snapshot", "fact_calendar"), reports):
        named = report.select(F.lit(name).alias("table"), "*")
        out = named if out is None else out.unionByName(named)
    return out
