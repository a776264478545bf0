"""What events do to occupancy, the noise to compare with, and the event calendar itself."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshare.functions import text as tx
from nightshare.functions.cleaning import by_prefix
from nightshare.functions.dates import dates_valid
from nightshare.operators.controls import expand_ranges, noise_table, with_controls
from nightshare.operators.picks import first_by_priority, stable_panel
from nightshare.operators.prefix import attach, group_quantiles
from nightshare.plans.occupancy import zone_nights

SPORT = "sport"


def sport_starts_earlier(events: DataFrame, kind: str = "kind", start: str = "first_night") -> DataFrame:
    """Runners from elsewhere sleep in town the night before, so sport counts one more night."""
    return events.withColumn(start, F.when(F.col(kind) == SPORT, F.date_sub(start, 1)).otherwise(F.col(start)))


def measured_nights(
    events: DataFrame, series: DataFrame, excluded: DataFrame, zone: str = "city", value: str = "occ",
    lead: str | None = "lead", scale: float = 100.0, min_controls: int = 2,
) -> DataFrame:
    """Event nights with their value, control mean and difference in points."""
    per_night = expand_ranges(events, "first_night", "last_night").select("event", zone, "kind", "night")
    targets = per_night.join(series.select(zone, "night", value, *([lead] if lead else [])), [zone, "night"])
    met = with_controls(targets, series, excluded, zone, value, lead=lead, min_controls=min_controls)
    return met.withColumn("diff_pp", (F.col(value) - F.col("control")) * scale)


def event_effect(
    events: DataFrame, series: DataFrame, excluded: DataFrame, zone: str = "city", value: str = "occ",
    lead: str | None = "lead", scale: float = 100.0,
) -> DataFrame:
    """Per event: measured nights, means, difference and the share of its nights that could be measured."""
    nights = measured_nights(events, series, excluded, zone, value, lead, scale)
    whole = expand_ranges(events, "first_night", "last_night").groupBy("event", zone).agg(F.count(F.lit(1)).alias("all_nights"))
    per = nights.groupBy("event", zone, "kind").agg(
        F.count(F.lit(1)).alias("nights"),
        (F.avg(value) * scale).alias("event_occ"),
        (F.avg("control") * scale).alias("control_occ"),
        F.avg("diff_pp").alias("diff_pp"),
        *([F.avg(lead).alias("mean_lead")] if lead else []),
    )
    return per.join(whole, ["event", zone]).withColumn("coverage", F.col("nights") / F.col("all_nights"))


def match_effect(nights: DataFrame, zone: str = "city") -> DataFrame:
    """Single nights pooled by zone, and by weekend (Friday to Sunday) or weekday."""
    marked = nights.withColumn("weekend", F.weekday("night") >= 4)
    return marked.groupBy(zone, "weekend").agg(F.count(F.lit(1)).alias("nights"), F.avg("diff_pp").alias("diff_pp"))


def match_pool(nights: DataFrame, zone: str = "city") -> DataFrame:
    base = nights.groupBy(zone).agg(
        F.count(F.lit(1)).alias("nights"),
        (F.avg("occ") * 100).alias("event_occ"),
        (F.avg("control") * 100).alias("control_occ"),
        F.avg("diff_pp").alias("diff_pp"),
    )
    return attach(base, group_quantiles(nights, [zone], "diff_pp", {"diff_median": 0.5}), [zone])


def placebo_nights(
    series: DataFrame, excluded: DataFrame, zone: str = "city", value: str = "occ", lead: str | None = "lead", scale: float = 100.0
) -> DataFrame:
    """The same difference for every night nothing happened on: the event operator with another left side."""
    calm = series.join(excluded, [zone, "night"], "left_anti").select(zone, "night", value, *([lead] if lead else []))
    met = with_controls(calm, series, excluded, zone, value, lead=lead)
    return met.withColumn("diff_pp", (F.col(value) - F.col("control")) * scale)


def placebo(series: DataFrame, excluded: DataFrame, zone: str = "city", value: str = "occ", lead: str | None = "lead", scale: float = 100.0) -> DataFrame:
    return noise_table(placebo_nights(series, excluded, zone, value, lead, scale), [zone])


def stable_panel_effect(calendar: DataFrame, captures: DataFrame, events: DataFrame, excluded: DataFrame, zone: str = "city") -> DataFrame:
    """Event effects from the listings that are in every capture only."""
    panel = stable_panel(captures, "listing_id", "snapshot")
    series = zone_nights(calendar.join(panel, "listing_id", "left_semi"), zone)
    return event_effect(events, series, excluded, zone)


def effect_summary(effects: DataFrame, zone: str = "city") -> DataFrame:
    """Mean effect by (zone, kind) and over all events, with its standard error. ``level`` 0 is the finer one."""
    g = effects.groupingSets([[F.col(zone), F.col("kind")], []], F.col(zone), F.col("kind"))
    return g.agg(
        F.count(F.lit(1)).alias("events"),
        F.avg("diff_pp").alias("diff_pp"),
        (F.stddev_samp("diff_pp") / F.sqrt(F.count("diff_pp"))).alias("std_error"),
        F.grouping(zone).cast("int").alias("level"),
    )


def normalise_events(
    raw: DataFrame, capture: Column, cities: Mapping[str, str], price: str = "price", masked: Sequence[str] = ("name", "price"),
    start: str = "start", end: str = "end", place: str = "place", free_word: str = "gratis",
) -> DataFrame:
    """Dates, their validity, the price range, the city and masked addresses. Odd dates are marked, not dropped."""
    a, b = F.substring(start, 1, 10).try_cast("date"), F.substring(end, 1, 10).try_cast("date")
    out = (
        raw.withColumn("start_date", a)
        .withColumn("end_date", b)
        .withColumn("dates_valid", dates_valid(a, b, capture))
        .withColumn("price_min", tx.price_low(F.col(price), free_word))
        .withColumn("price_max", tx.price_high(F.col(price), free_word))
        .withColumn("city", by_prefix(F.coalesce(F.col(place), F.lit("")), cities, "Other"))
    )
    for m in masked:
        out = out.withColumn(m, tx.mask_emails(F.col(m)))
    return out.drop(start, end)


def event_calendar(
    agenda: DataFrame, curated: DataFrame | None, capture: Column, cities: Sequence[str], kinds: Sequence[str],
    venue_pattern: str, cancelled: str = "CANCELAD", matches: DataFrame | None = None, venues_of: Mapping[str, str] | None = None,
) -> DataFrame:
    """One calendar from curated events, matches and the agenda, the better source first.

    Agenda events count at venues that match ``venue_pattern``; kinds named in ``venues_of`` (such as fairs and congresses)
    only at venues that match the kind's own pattern as well.

    Sources share (name, city, kind, start_date, end_date); the agenda also has venue and dates_valid.
    The key of an event is its city, first day and folded name.
    """
    cols = ["name", "city", "kind", "start_date", "end_date"]
    kept = agenda.where(
        F.col("dates_valid")
        & F.col("city").isin(*cities)
        & F.col("venue").rlike(venue_pattern)
        & (F.col("start_date") >= capture)
        & F.col("kind").isin(*kinds)
        & ~F.upper("name").contains(cancelled)
        & reduce(and_, [(F.col("kind") != kind) | F.col("venue").rlike(pattern) for kind, pattern in (venues_of or {}).items()], F.lit(True))
    ).withColumn("name", tx.clean_name(F.col("name")))
    stacked = kept.select(*cols, F.lit(3).alias("rank"))
    if matches is not None:
        stacked = stacked.unionByName(matches.select(*cols, F.lit(2).alias("rank")))
    if curated is not None:
        stacked = stacked.unionByName(curated.select(*cols, F.lit(1).alias("rank")))
    keyed = stacked.withColumn("name_key", tx.text_key(F.col("name")))
    return first_by_priority(keyed, ["city", "start_date", "name_key"], "rank", ["end_date", "name", "kind"]).select(*cols, "rank")
