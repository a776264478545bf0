"""Occupancy from calendars: slices, annual figures, monthly and daily series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshare.functions.cleaning import clip01_percent
from nightshare.functions.dates import iso_weekday
from nightshare.operators.picks import drop_always_blocked, nearest_capture
from nightshare.operators.prefix import attach

NEAR_LEAD = 29
FAR_LEAD = 45
REFERENCE_LEAD = 15


def occupancy_share(taken: str = "taken", lead: str = "lead", max_lead: int = NEAR_LEAD) -> Column:
    """Taken nights over nights seen at most ``max_lead`` days ahead; null when there are none."""
    near = F.col(lead).between(0, max_lead)
    return F.try_divide(F.count_if(near & (F.col(taken) == 1)), F.count_if(near))


def occupancy_slice(calendar: DataFrame, by: Sequence[str], snapshot: Sequence[str] = ("listing_id", "snapshot"), drop_blocked: bool = True) -> DataFrame:
    src = drop_always_blocked(calendar, snapshot) if drop_blocked else calendar
    return src.groupBy(*by).agg(occupancy_share().alias("occupancy"))


def zone_nights(calendar: DataFrame, zone: str = "city", max_lead: int = NEAR_LEAD) -> DataFrame:
    """Per zone and night: taken share, listings, lead and weekday, from the nearest capture."""
    daily = (
        calendar.where(F.col("lead").between(0, max_lead))
        .groupBy(zone, "night", "lead")
        .agg(F.avg("taken").alias("occ"), F.count(F.lit(1)).alias("listings"))
    )
    return nearest_capture(daily, [zone, "night"], max_lead=None).withColumn("weekday", iso_weekday(F.col("night")))


def annual_occupancy(
    calendar: DataFrame, start, end, min_nights: int = 180, block: Sequence[str] = ("listing_id", "snapshot"), max_lead: int = NEAR_LEAD
) -> DataFrame:
    """Mean taken share per listing over the window, one capture per night, only well measured listings."""
    alive = drop_always_blocked(calendar, block)
    window = alive.where(F.col("night").between(start, end))
    picked = nearest_capture(window.select("listing_id", "night", "lead", "taken"), ["listing_id", "night"], tie=["taken"], max_lead=max_lead)
    return (
        picked.groupBy("listing_id")
        .agg(F.avg("taken").alias("occupancy"), F.count(F.lit(1)).alias("nights"))
        .where(F.col("nights") >= min_nights)
    )


def summer_adjust(df: DataFrame, zone: str, month: Column, value: str, table: Mapping[tuple[str, int], float], add: bool = False) -> DataFrame:
    """Take the points of (zone, month) off, not below zero; ``add`` puts them back for comparison."""
    points = F.lit(0.0)
    for (z, m), p in table.items():
        points = F.when((F.col(zone) == z) & (month == m), float(p)).otherwise(points)
    shifted = F.col(value) + points if add else F.greatest(F.col(value) - points, F.lit(0.0))
    return df.withColumn(value, shifted)


def monthly_occupancy(
    calendar: DataFrame, zone: str = "city", min_nights: int = 20, adjust: Mapping[tuple[str, int], float] | None = None,
    drop_blocked: Sequence[str] | None = ("listing_id", "snapshot"),
) -> DataFrame:
    """Monthly mean of the daily zone share, in whole per cent; thin months are left out."""
    src = drop_always_blocked(calendar, drop_blocked) if drop_blocked else calendar
    monthly = (
        zone_nights(src, zone)
        .groupBy(zone, F.date_format("night", "yyyy-MM").alias("month"))
        .agg(F.avg("occ").alias("occ"), F.count(F.lit(1)).alias("nights"))
        .where(F.col("nights") >= min_nights)
        .withColumn("pct", F.bround(F.col("occ") * 100))
    )
    return summer_adjust(monthly, zone, F.substring("month", 6, 2).cast("int"), "pct", adjust or {})


def daily_occupancy(
    calendar: DataFrame, zone: str = "city", max_lead: int = FAR_LEAD, reference: int = REFERENCE_LEAD,
    adjust: Mapping[tuple[str, int], float] | None = None, drop_blocked: Sequence[str] | None = None,
) -> DataFrame:
    """Daily share moved to a common lead: the mean curve by (zone, lead) is taken off and its reference value put back.

    Always blocked listings (by the columns of ``drop_blocked``) leave before the curve; the points of (zone, month) in ``adjust`` are taken off after it.
    Curves weigh every captured night of a zone the same, as the share of each (zone, night, lead).
    """
    src = drop_always_blocked(calendar, drop_blocked) if drop_blocked else calendar
    seen = (
        src.where(F.col("lead").between(0, max_lead))
        .groupBy(zone, "night", "lead")
        .agg(F.avg("taken").alias("occ"))
    )
    curve = seen.groupBy(zone, "lead").agg(F.avg("occ").alias("at_lead"))
    levels = curve.groupBy(zone).agg(F.max(F.when(F.col("lead") == reference, F.col("at_lead"))).alias("at_reference"))
    near = nearest_capture(seen, [zone, "night"], max_lead=None)
    moved = attach(attach(near, curve, [zone, "lead"]), levels, [zone])
    daily = moved.select(
        zone, "night", "lead", clip01_percent(F.col("occ") - (F.col("at_lead") - F.col("at_reference"))).cast("double").alias("pct")
    )
    return summer_adjust(daily, zone, F.month("night"), "pct", adjust or {})


def pickup(calendar: DataFrame, captures: DataFrame, city: str = "city", snapshot: str = "snapshot") -> DataFrame:
    """Nights that were free in one capture of a city and taken in the next.

    The order of captures is a small table per city; it turns the look-ahead into an
    equality join on a unique key.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(city).orderBy(snapshot)
    following = captures.select(city, snapshot).distinct().withColumn("__next", F.lead(snapshot).over(w))
    now = calendar.select("listing_id", city, "night", snapshot, "taken").join(following, [city, snapshot])
    later = calendar.select("listing_id", city, "night", F.col(snapshot).alias("__next"), F.col("taken").alias("__later"))
    pairs = now.join(later, ["listing_id", city, "night", "__next"])
    return pairs.groupBy(city, F.datediff("night", snapshot).alias("lead")).agg(
        F.count(F.lit(1)).alias("seen_twice"), F.count_if((F.col("taken") == 0) & (F.col("__later") == 1)).alias("picked_up")
    )


def zone_revpar(calendar: DataFrame, listings: DataFrame, zone: str, price: str = "price", min_listings: int = 30) -> DataFrame:
    """Zone medians of listing shares and prices, and their product."""
    from nightshare.operators.prefix import many_quantiles
    from nightshare.session import settled

    share = calendar.groupBy("listing_id").agg(F.avg("taken").alias("share"))
    joined = settled(listings.join(share, "listing_id"), "shares")
    sizes = joined.groupBy(zone).agg(F.count(F.lit(1)).alias("listings")).where(F.col("listings") >= min_listings)
    med = many_quantiles(joined, [zone], {"share": "share", "price": price}, {"median": 0.5})
    return sizes.join(med, zone).withColumn("revpar", F.col("share_median") * F.col("price_median"))


def polarisation(calendar: DataFrame, by: Sequence[str]) -> DataFrame:
    """Share of listings that are exactly empty or exactly full."""
    per = calendar.groupBy(*by, "listing_id").agg(F.min("taken").alias("lo"), F.max("taken").alias("hi"))
    return per.groupBy(*by).agg(
        F.count(F.lit(1)).alias("listings"), F.avg((F.col("lo") == F.col("hi")).cast("double")).alias("polarised")
    )
