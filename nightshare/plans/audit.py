"""How far the figures can be trusted: spread, stability, intervals and pairs that differ."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightshare.functions.cleaning import band
from nightshare.operators.prefix import attach, group_quantiles, prefix_sums


def standard_error(value: str) -> Column:
    return F.stddev_samp(value) / F.sqrt(F.count(value))


def correlation(y: str, x: str) -> Column:
    """Correlation over complete pairs, null for a constant series. The built-in one stops the job there."""
    yy = F.when(F.col(x).isNotNull(), F.col(y))
    xx = F.when(F.col(y).isNotNull(), F.col(x))
    return F.try_divide(F.covar_pop(y, x), F.stddev_pop(yy) * F.stddev_pop(xx))


def threshold_counts(df: DataFrame, by: Sequence[str], value: str, thresholds: Sequence[float]) -> DataFrame:
    """Rows at or above each threshold, counted in one pass."""
    names = [str(t) for t in thresholds]
    one = df.groupBy(*by).agg(*[F.count_if(F.col(value) >= t).alias(n) for t, n in zip(thresholds, names)])
    return one.unpivot(list(by), names, "threshold", "at_least").withColumn(
        "threshold", F.col("threshold").cast("double" if any(isinstance(t, float) for t in thresholds) else "bigint")
    )


def describe(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    base = df.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("lo"),
        F.max(value).alias("hi"),
    )
    return attach(base, group_quantiles(df, by, value, {"q1": 0.25, "q2": 0.5, "q3": 0.75}), by)


def month_stability(
    per_snapshot: DataFrame, zone: str, snapshot: str, value: str, size: str, edges: Sequence[float], labels: Sequence[str]
) -> DataFrame:
    """Absolute change of a zone between captures: median and 90 % quantile by size band."""
    w = Window.partitionBy(zone).orderBy(snapshot)
    moved = per_snapshot.select(
        band(F.col(size), edges, labels).alias("size_band"), F.abs(F.col(value) - F.lag(value).over(w)).alias("change")
    )
    return group_quantiles(moved, ["size_band"], "change", {"median_change": 0.5, "p90_change": 0.9}, count_as="n")


def distinguishable_pairs(intervals: DataFrame, low: str, high: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of pairs of zones whose intervals do not meet.

    A pair is apart when one interval ends below the start of the other. Counting, for every
    start, the ends below it gives the number of such pairs without building any pair.
    """
    by = list(by)
    helper = [] if by else ["__all"]
    keys = [*by, *helper]
    src = intervals.select(*by, *[F.lit(0).alias(h) for h in helper], F.col(low).alias("__lo"), F.col(high).alias("__hi"))
    marks = src.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col("__lo").alias("v"), F.lit(1).alias("starts"), F.lit(0).alias("ends")),
                F.struct(F.col("__hi").alias("v"), F.lit(0).alias("starts"), F.lit(1).alias("ends")),
            )
        ).alias("m"),
    ).select(*keys, "m.*")
    points = marks.groupBy(*keys, "v").agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))
    ranked = prefix_sums(points, keys, "v", "ends")
    out = ranked.groupBy(*keys).agg(F.max("total").alias("zones"), F.sum(F.col("starts") * F.col("before")).alias("apart"))
    pairs = (F.col("zones") * (F.col("zones") - 1) / 2).cast("bigint")
    return out.select(*by, "zones", pairs.alias("pairs"), "apart", F.try_divide(F.col("apart").cast("double"), pairs).alias("share"))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) fixed by its parts, the same on every run and executor."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("double") / 4294967296.0


#: Cumulative probabilities of a Poisson variable with mean 1, up to a tail below the finest step of ``uniform`` (2 ** -32).
POISSON_ONE = tuple(itertools.accumulate(math.exp(-1) / math.factorial(k) for k in range(13)))


def poisson_weight(u: Column) -> Column:
    out = F.lit(0)
    for p in POISSON_ONE:
        out = out + (u >= p).cast("int")
    return out


def bootstrap_ci(
    listings: DataFrame, by: str, key: str, mean_of: str, median_of: str, replicates: int = 400, tail: float = 0.025
) -> DataFrame:
    """Interval of a mean and a median per zone, by resampling listings within the zone.

    Each listing draws a Poisson(1) weight in each replicate from a hash of both, which
    stands for drawing with replacement and needs no sequential state. Means are weighted
    sums; medians are read off running weights, sliced like any other large group.
    """
    copies = listings.select(by, key, mean_of, median_of, F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("rep"))
    drawn = copies.withColumn("w", poisson_weight(uniform(F.col(key), F.col("rep")))).where(F.col("w") > 0)
    means = drawn.groupBy(by, "rep").agg((F.sum(F.col("w") * F.col(mean_of)) / F.sum("w")).alias("stat"))
    medians = group_quantiles(drawn, [by, "rep"], median_of, {"stat": 0.5}, weight="w")
    stats = means.select(by, F.lit("mean").alias("what"), "stat").unionByName(medians.select(by, F.lit("median").alias("what"), "stat"))
    q = group_quantiles(stats, [by, "what"], "stat", {"low": tail, "high": 1 - tail})
    return q.groupBy(by).agg(
        *[
            F.max(F.when(F.col("what") == w, F.col(e))).alias(f"{w}_{e}")
            for w in ("mean", "median")
            for e in ("low", "high")
        ]
    )
