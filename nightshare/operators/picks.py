"""Picking one row per key and simple per-key histories, as aggregates that combine before the shuffle.

Number columns picked by one number stay in a hash aggregate. Text, and order by several columns (a struct), make Spark
aggregate by sorting; rows of a task are sorted by key then, which spills, and are still combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], chooser) -> DataFrame:
    """The row that is first or last in an order.

    With a single ordering column every other column is picked by it on its own, which keeps
    number columns in a hash aggregate. All picks of one aggregate see the rows in the same
    turn, so they come from the same row.
    """
    rest = [c for c in df.columns if c not in keys]
    if len(order) == 1 and isinstance(order[0], str):
        picked = df.groupBy(*keys).agg(*[chooser(c, order[0]).alias(c) for c in rest])
        return picked.select(*df.columns)
    best = df.groupBy(*keys).agg(chooser(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*keys, "__row.*").select(*df.columns)


def nearest_capture(df: DataFrame, keys: Sequence[str], lead: str = "lead", tie: Sequence[str | Column] = (), max_lead: int | None = 29) -> DataFrame:
    """Per key the row with the smallest lead. ``tie`` decides between rows of the same lead."""
    src = df if max_lead is None else df.where(F.col(lead).between(0, max_lead))
    return _pick(src, keys, [lead, *tie], F.min_by)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Per key the row that is last in the given order."""
    return _pick(df, keys, order, F.max_by)


def seen_span(df: DataFrame, keys: Sequence[str], snapshot: str) -> DataFrame:
    """First capture, last capture and number of captures per key."""
    return df.groupBy(*keys).agg(
        F.min(snapshot).alias("first_seen"), F.max(snapshot).alias("last_seen"), F.count(F.lit(1)).alias("captures")
    )


def stable_panel(df: DataFrame, key: str, snapshot: str) -> DataFrame:
    """Keys that are in every capture."""
    pairs = df.select(key, snapshot).distinct()
    captures = df.select(snapshot).distinct().agg(F.count(F.lit(1))).scalar()
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias("captures")).where(F.col("captures") == captures).select(key)


def drop_always_blocked(df: DataFrame, keys: Sequence[str], taken: str = "taken") -> DataFrame:
    """Drop groups that have no free night at all."""
    alive = df.groupBy(*keys).agg(F.min(taken).alias("__min")).where(F.col("__min") == 0).select(*keys)
    return df.join(alive, list(keys), "left_semi")


def mode_of(df: DataFrame, keys: Sequence[str], value: str, out: str = "mode") -> DataFrame:
    """Most frequent value per key, the smallest on a tie. Counting per (key, value) first keeps groups small."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    ranked = counts.groupBy(*keys).agg(F.max("__n").alias("__top"), F.min(F.struct((-F.col("__n")).alias("n"), F.col(value).alias("v"))).alias("__best"))
    return ranked.select(*keys, F.col("__best.v").alias(out))


def first_by_priority(df: DataFrame, keys: Sequence[str], rank: str, tie: Sequence[str | Column] = ()) -> DataFrame:
    """First-seen de-duplication: the row of the best ranked source stays."""
    return _pick(df, keys, [rank, *tie], F.min_by)


def class_breaks(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float] = (0.2, 0.4, 0.6, 0.8)) -> DataFrame:
    """Element breaks at the given shares, without repeats and above the smallest value."""
    from nightshare.operators.prefix import group_quantiles

    names = {f"__b{i}": p for i, p in enumerate(shares)}
    q = group_quantiles(df, keys, value, {"__min": 0.0, **names}, interpolate=False)
    breaks = F.filter(F.array_distinct(F.array(*names)), lambda b: b > F.col("__min"))
    return q.select(*keys, breaks.alias("breaks"))


def value_class(value: Column, breaks: Column) -> Column:
    return F.size(F.filter(breaks, lambda b: b <= value))
