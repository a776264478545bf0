"""How prices move with occupancy, and what single months did to them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshare.operators.prefix import attach
from nightshare.plans.audit import correlation


def year_over_year(monthly: DataFrame, city: str = "city") -> DataFrame:
    """Each month with the same month a year before. Missing years leave gaps, so this is a join and not a lag."""
    before = monthly.select(
        city, "month", (F.col("year") + 1).alias("year"), F.col("adr").alias("__adr"), F.col("occ").alias("__occ")
    )
    return monthly.join(before, [city, "year", "month"]).select(
        city,
        "year",
        "month",
        F.log(F.col("adr") / F.col("__adr")).alias("log_ratio"),
        (F.col("occ") - F.col("__occ")).alias("occ_change"),
    )


def demean_by_year(monthly: DataFrame, columns: Mapping[str, str], city: str = "city") -> DataFrame:
    """Each column minus its mean in the same city and year."""
    means = monthly.groupBy(city, "year").agg(*[F.avg(c).alias(f"__mean_{o}") for o, c in columns.items()])
    out = attach(monthly, means, [city, "year"])
    for o, c in columns.items():
        out = out.withColumn(o, F.col(c) - F.col(f"__mean_{o}"))
    return out.drop(*[f"__mean_{o}" for o in columns])


def regress(df: DataFrame, by: Sequence[str], y: str, x: str) -> DataFrame:
    """Simple regression of y on x: slope, its standard error, correlation and size."""
    slope, sxx, syy = F.regr_slope(y, x), F.regr_sxx(y, x), F.regr_syy(y, x)
    g = df.groupBy(*by).agg(
        slope.alias("slope"), sxx.alias("__sxx"), syy.alias("__syy"), correlation(y, x).alias("r"), F.regr_count(y, x).alias("n")
    )
    rest = F.greatest(F.col("__syy") - F.col("slope") * F.col("slope") * F.col("__sxx"), F.lit(0.0))
    error = F.sqrt(F.try_divide(F.try_divide(rest, F.col("n") - 2), F.col("__sxx")))
    return g.withColumn("slope_error", F.when(F.col("n") > 2, error)).drop("__sxx", "__syy")


def percent_per_ten_points(slope: Column) -> Column:
    return F.lit(100.0) * (F.exp(slope * 10) - 1)


def price_elasticity(monthly: DataFrame, excluded: DataFrame | None = None, city: str = "city") -> DataFrame:
    """Per cent of price per ten points of occupancy, from years and from seasons.

    ``excluded`` holds (city, period) months with single events.
    """
    m = monthly if excluded is None else monthly.join(excluded.select(city, "period"), [city, "period"], "left_anti")
    yearly = year_over_year(m, city).select(city, F.lit("year over year").alias("method"), F.col("log_ratio").alias("y"), F.col("occ_change").alias("x"))
    seasonal = demean_by_year(m.withColumn("ly", F.log("adr")), {"y": "ly", "x": "occ"}, city).select(
        city, F.lit("within year").alias("method"), "y", "x"
    )
    fit = regress(yearly.unionByName(seasonal), [city, "method"], "y", "x")
    return fit.select(
        city,
        "method",
        percent_per_ten_points(F.col("slope")).alias("pct_per_10pp"),
        (F.col("slope_error") * 1000).alias("error_pct"),
        "r",
        F.col("n").alias("months"),
    )


def diff_in_diff(monthly: DataFrame, event_periods: Sequence[str] = (), min_years: int = 3, city: str = "city") -> DataFrame:
    """Every city and month against the same month of other years, less the mean of the other cities.

    Log prices are first taken relative to the year's mean. Months with single events never
    serve as another year. Only periods all cities are measured in give a result. All months
    come out of one job: sums over a group minus the row itself replace a loop.
    """
    m = demean_by_year(monthly.withColumn("__ly", F.log("adr")), {"__la": "__ly"}, city)
    usable = (~F.col("period").isin(*event_periods)).cast("int") if event_periods else F.lit(1)
    m = m.withColumn("__u", usable)
    sums = m.groupBy(city, "month").agg(
        F.sum(F.col("__u") * F.col("__la")).alias("__sla"), F.sum(F.col("__u") * F.col("occ")).alias("__socc"), F.sum("__u").alias("__n")
    )
    other = F.col("__n") - F.col("__u")
    own = (
        attach(m, sums, [city, "month"])
        .where(other >= min_years)
        .select(
            city,
            "period",
            (F.col("__la") - (F.col("__sla") - F.col("__u") * F.col("__la")) / other).alias("__a"),
            (F.col("occ") - (F.col("__socc") - F.col("__u") * F.col("occ")) / other).alias("__o"),
        )
    )
    cities = monthly.select(city).distinct().agg(F.count(F.lit(1))).scalar()
    all_cities = own.groupBy("period").agg(F.sum("__a").alias("__sa"), F.sum("__o").alias("__so"), F.count(F.lit(1)).alias("__c"))
    joined = attach(own, all_cities.where((F.col("__c") == cities) & (F.col("__c") > 1)), ["period"], "inner")
    rest = F.col("__c") - 1
    a = F.col("__a") - (F.col("__sa") - F.col("__a")) / rest
    o = F.col("__o") - (F.col("__so") - F.col("__o")) / rest
    return joined.select(city, "period", (F.lit(100.0) * (F.exp(a) - 1)).alias("adr_uplift_pct"), o.alias("occ_uplift_pp"))


def did_noise(monthly: DataFrame, event_periods: Sequence[str] = (), min_years: int = 3, city: str = "city") -> DataFrame:
    """Sample deviation of the uplift over months without a single event."""
    d = diff_in_diff(monthly, event_periods, min_years, city)
    calm = d.where(~F.col("period").isin(*event_periods)) if event_periods else d
    return calm.groupBy(city).agg(F.count(F.lit(1)).alias("months"), F.stddev_samp("adr_uplift_pct").alias("deviation"))


def event_price_range(effects: DataFrame, elasticity: DataFrame, city: str = "city") -> DataFrame:
    """Per event family: mean uplift and the price range the two elasticities give for it."""
    families = effects.groupBy(city, "family").agg(
        F.count(F.lit(1)).alias("editions"), F.avg("diff_pp").alias("diff_pp"), F.avg("control_occ").alias("control_occ")
    )
    e = elasticity.groupBy(city).agg(
        F.max(F.when(F.col("method") == "year over year", F.col("pct_per_10pp"))).alias("__y"),
        F.max(F.when(F.col("method") == "within year", F.col("pct_per_10pp"))).alias("__s"),
    )

    def price(pct: str) -> Column:
        return F.lit(100.0) * (F.pow(1 + F.col(pct) / 100, F.greatest(F.col("diff_pp"), F.lit(0.0)) / 10) - 1)

    return families.join(e, city).select(
        city, "family", "editions", "diff_pp", "control_occ",
        F.least(price("__y"), price("__s")).alias("price_low_pct"), F.greatest(price("__y"), price("__s")).alias("price_high_pct"),
    )


def winter_index(monthly: DataFrame, factor: Mapping[str, float] | float, base: Sequence[int] = (4, 5, 6), months: Sequence[int] = (10, 11, 12, 1, 2, 3), city: str = "city") -> DataFrame:
    """Month price over the spring mean of its year, averaged over years and damped: 1 + k (ratio - 1)."""
    base_level = monthly.where(F.col("month").isin(*base)).groupBy(city, "year").agg(F.avg("adr").alias("__base"))
    ratios = attach(monthly.where(F.col("month").isin(*months)), base_level, [city, "year"], "inner")
    mean = ratios.groupBy(city, "month").agg(F.avg(F.col("adr") / F.col("__base")).alias("ratio"), F.count(F.lit(1)).alias("years"))
    if isinstance(factor, Mapping):
        k = F.lit(None).cast("double")
        for z, f in factor.items():
            k = F.when(F.col(city) == z, float(f)).otherwise(k)
    else:
        k = F.lit(float(factor))
    return mean.select(city, "month", "years", (1 + k * (F.col("ratio") - 1)).alias("index"))


def validate_occupancy(official: DataFrame, measured: DataFrame, summer: Sequence[str] = ("07", "08"), zone: str = "city") -> tuple[DataFrame, DataFrame]:
    """Zone months of an official survey beside measured occupancy, and their agreement by zone."""
    both = official.select(zone, "period", "official").join(measured.select(zone, "period", "measured"), [zone, "period"])
    rows = both.where(F.col("measured").isNotNull()).withColumn("difference", F.col("measured") - F.col("official"))
    hot = F.substring("period", 6, 2).isin(*summer)
    summary = rows.groupBy(zone).agg(
        F.count(F.lit(1)).alias("months"),
        F.avg("official").alias("official_mean"),
        F.avg("measured").alias("measured_mean"),
        F.avg("difference").alias("difference_mean"),
        F.avg(F.when(hot, F.col("difference"))).alias("summer_difference"),
        correlation("official", "measured").alias("r"),
    )
    return rows, summary
