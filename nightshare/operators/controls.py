"""Event nights, exclusion sets and the control nights they are compared with.

Controls lie within some weeks of a night on the same weekday, so their distance is
a multiple of seven days. That turns the band join into one equality join per
offset: rows are spread over the few offsets and joined on (zone, night).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expand_ranges(events: DataFrame, start: str = "start", end: str = "end", out: str = "night") -> DataFrame:
    """One row per night of each event; an event whose end is before its start has none."""
    valid = F.when(F.col(start) <= F.col(end), F.sequence(start, end))
    return events.withColumn(out, F.explode(valid)).drop(start, end)


def week_offsets(window_days: int = 21) -> list[int]:
    weeks = window_days // 7
    return [7 * k for k in range(-weeks, weeks + 1) if k != 0]


def exclusion_set(
    events: DataFrame, series: DataFrame, zone: str = "city", start: str = "first_night", end: str = "last_night",
    margin: int = 1, holidays: DataFrame | None = None, matches: DataFrame | None = None,
) -> DataFrame:
    """(zone, night) pairs that may not serve as controls.

    Event nights with a margin, single match nights, and the nights of the series that
    are a holiday or its eve (``holidays`` has one column ``night`` and holds in every zone).
    """
    padded = events.select(zone, F.date_sub(start, margin).alias("__a"), F.date_add(end, margin).alias("__b"))
    out = expand_ranges(padded, "__a", "__b").select(zone, "night")
    if holidays is not None:
        eves = holidays.select(F.explode(F.array("night", F.date_sub("night", 1))).alias("night")).distinct()
        out = out.unionByName(series.select(zone, "night").join(eves, "night", "left_semi").select(zone, "night"))
    if matches is not None:
        out = out.unionByName(matches.select(zone, "night"))
    return out.distinct()


def date_block(series: DataFrame, month_day_from: str, month_day_to: str, night: str = "night") -> DataFrame:
    """Nights of the series inside a yearly block such as 12-20 to 01-07, as a holiday table."""
    md = F.date_format(night, "MM-dd")
    inside = (
        md.between(month_day_from, month_day_to)
        if month_day_from <= month_day_to
        else (md >= month_day_from) | (md <= month_day_to)
    )
    return series.where(inside).select(F.col(night).alias("night")).distinct()


def with_controls(
    targets: DataFrame,
    series: DataFrame,
    excluded: DataFrame,
    zone: str = "city",
    value: str = "occ",
    window_days: int = 21,
    lead: str | None = "lead",
    lead_tolerance: int = 7,
    min_controls: int = 2,
) -> DataFrame:
    """Add ``control`` (mean of the control nights) and ``n_controls`` to the target nights.

    ``series`` and ``targets`` hold one row per (zone, night), so each target meets at
    most as many rows as there are offsets. Targets with too few controls are dropped.
    """
    allowed = series.join(excluded, [zone, "night"], "left_anti")
    pool = allowed.select(
        F.col(zone), F.col("night").alias("__night"), F.col(value).alias("__value"), *([F.col(lead).alias("__lead")] if lead else [])
    )
    spread = targets.withColumn("__offset", F.explode(F.array(*[F.lit(o) for o in week_offsets(window_days)]))).withColumn(
        "__night", F.date_add("night", F.col("__offset"))
    )
    met = spread.join(pool, [zone, "__night"])
    if lead:
        met = met.where(F.abs(F.col("__lead") - F.col(lead)) <= lead_tolerance)
    cols = targets.columns
    return (
        met.groupBy(*cols)
        .agg(F.avg("__value").alias("control"), F.count("__value").alias("n_controls"))
        .where(F.col("n_controls") >= min_controls)
    )


def points_difference(value: Column, control: Column, scale: float = 100.0) -> Column:
    return (value - control) * scale


def noise_table(placebo: DataFrame, keys: Sequence[str], diff: str = "diff_pp") -> DataFrame:
    """Number, mean, sample deviation and 5 % and 95 % quantiles of differences where nothing happened."""
    from nightshare.operators.prefix import attach, group_quantiles

    base = placebo.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("nights"), F.avg(diff).alias("mean"), F.stddev_samp(diff).alias("deviation")
    )
    return attach(base, group_quantiles(placebo, keys, diff, {"p5": 0.05, "p95": 0.95}), keys)
