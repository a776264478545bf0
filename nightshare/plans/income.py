"""Prices, income, costs and levies by zone. All cost figures come from the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshare.functions.cleaning import parse_price_strict, suppress
from nightshare.operators.prefix import group_quantiles, many_quantiles, small_group_quantiles

LEAST_CELL = 10


def with_scenarios(df: DataFrame, scenarios: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Each row once per scenario, with the scenario's figures as columns. No join is needed for a literal table."""
    rows = [
        F.struct(F.lit(name).alias("scenario"), *[F.lit(float(x)).alias(k) for k, x in figures.items()])
        for name, figures in scenarios.items()
    ]
    return df.withColumn("__s", F.explode(F.array(*rows))).select("*", "__s.*").drop("__s")


def reference_price(listings: DataFrame, snapshots: Sequence | None = None, key: str = "id", price: str = "price", snapshot: str = "snapshot") -> DataFrame:
    """Median valid price per listing over the chosen captures, of which a listing has few; ``price`` is raw text."""
    src = listings if snapshots is None else listings.where(F.col(snapshot).isin(*snapshots))
    return small_group_quantiles(src, [key], parse_price_strict(F.col(price)), {"reference_price": 0.5})


def with_income(df: DataFrame, occupancy: str = "occ", price: str = "price") -> DataFrame:
    return df.withColumn("nights_year", F.col(occupancy) * 365).withColumn(
        "income", F.col("nights_year") * F.col(price) / 12
    )


def income_by_zone(active: DataFrame, zone: str = "zone", least: int = LEAST_CELL) -> DataFrame:
    """Active listings with median price and nights and the income quartiles; small zones show their count only.

    Active listings have an income, so their number comes out of the same pass.
    """
    q = many_quantiles(
        active,
        [zone],
        {"income": "income", "price": "price", "nights": "nights_year"},
        {"p25": 0.25, "median": 0.5, "p75": 0.75},
        count_as="active",
    )
    shown = {
        "price_median": "price_median", "nights_median": "nights_median",
        "income_p25": "income_p25", "income_median": "income_median", "income_p75": "income_p75",
    }
    return q.select(
        zone, "active", *[suppress(F.col(c), F.col("active"), least).alias(o) for o, c in shown.items()]
    )


def net_income(gross: Column, nights_month: Column, mean_stay: float, figures: Mapping[str, Column]) -> Column:
    """Gross less fees, upkeep, cleaning per stay and fixed costs."""
    shares = figures["platform_fee"] + figures["manager_fee"] + figures["upkeep_share"]
    return gross - gross * shares - nights_month / mean_stay * figures["cleaning"] - figures["fixed"]


def net_by_scenario(
    active: DataFrame, scenarios: Mapping[str, Mapping[str, float]], mean_stay: float, long_rent: float, long_fixed: float,
    zone: str = "zone", least: int = LEAST_CELL,
) -> DataFrame:
    """Monthly net of the median home of each zone by scenario, beside a long let."""
    z = income_by_zone(active, zone, least).where(F.col("active") >= least)
    cols = {c: F.col(c) for c in ("platform_fee", "manager_fee", "upkeep_share", "cleaning", "fixed")}
    return with_scenarios(z, scenarios).select(
        zone,
        "scenario",
        F.col("income_median").alias("gross"),
        net_income(F.col("income_median"), F.col("nights_median") / 12, mean_stay, cols).alias("net"),
        F.lit(long_rent - long_fixed).alias("long_let_net"),
    )


def break_even_nights(df: DataFrame, scenarios: Mapping[str, Mapping[str, float]], mean_stay: float, long_net: float, price: str = "price") -> DataFrame:
    """Nights a month that cover the fixed costs, and nights that equal the long let."""
    shares = F.col("platform_fee") + F.col("manager_fee") + F.col("upkeep_share")
    margin = F.col(price) * (1 - shares) - F.col("cleaning") / mean_stay
    return (
        with_scenarios(df, scenarios)
        .withColumn("margin", margin)
        .withColumn("break_even", F.when(margin > 0, F.col("fixed") / margin))
        .withColumn("equal_long_let", F.when(margin > 0, (F.col("fixed") + long_net) / margin))
        .drop(*next(iter(scenarios.values())))
    )


def compare_zones(active: DataFrame, rents: DataFrame, figures: Mapping[str, float], mean_stay: float, long_fixed: float, zone: str = "zone", least: int = 30) -> DataFrame:
    """Income, net and long let side by side for the zones of a rent table (``zone``, ``rent``)."""
    z = income_by_zone(active, zone, least).where(F.col("active") >= least).join(rents, zone)
    cols = {k: F.lit(float(x)) for k, x in figures.items()}
    net = net_income(F.col("income_median"), F.col("nights_median") / 12, mean_stay, cols)
    long_net = F.col("rent") - long_fixed
    return z.select(
        zone, "active", "price_median", "income_p25", "income_median", "income_p75",
        net.alias("net"), long_net.alias("long_let_net"), F.try_divide(net, long_net).alias("net_ratio"),
    )


def supply_per_1000(homes: DataFrame, population: DataFrame, zone: str = "zone") -> DataFrame:
    """Homes per 1 000 residents; zones without homes show zero."""
    counted = homes.groupBy(zone).agg(F.count(F.lit(1)).alias("homes"))
    return population.join(counted, zone, "left").select(
        zone,
        "residents",
        F.coalesce("homes", F.lit(0)).alias("homes"),
        F.try_divide(F.coalesce("homes", F.lit(0)) * 1000.0, F.col("residents")).alias("per_1000"),
    )


def population_by_district(wide: DataFrame, district: str, columns: Sequence[str], total_row: Column) -> DataFrame:
    """Residents by district: the age columns of every section added up, without the total row."""
    long = wide.where(~total_row).unpivot([district], list(columns), "age", "raw")
    return long.groupBy(district).agg(F.sum(F.col("raw").try_cast("double")).alias("residents"))


def stay_levy(stays: DataFrame, rate: float, cap: int, persons: str, nights: str, price: str) -> DataFrame:
    """Levy of a stay: rate by person and night up to a cap, per night, and as a share of the price."""
    levy = F.lit(rate) * F.col(persons) * F.least(F.col(nights), F.lit(cap))
    return (
        stays.withColumn("levy", levy)
        .withColumn("levy_per_night", levy / F.col(nights))
        .withColumn("levy_pct", F.lit(100.0) * levy / F.col(nights) / F.col(price))
    )


def price_index(listings: DataFrame, reference: DataFrame, zone: str, snapshot: str = "snapshot", key: str = "id", price: str = "price", least: int = 50) -> DataFrame:
    """Median of price over the listing's reference price, by capture and zone."""
    ratio = listings.join(reference, key).withColumn("ratio", F.try_divide(F.col(price), F.col("reference_price")))
    out = group_quantiles(ratio, [zone, snapshot], "ratio", {"index": 0.5}, count_as="n")
    return out.where(F.col("n") >= least).withColumn("day_of_year", F.dayofyear(snapshot))
