"""Comparisons of a listing with its peers, and one set of metrics for any zoning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshare.functions.cleaning import capacity_band, host_segment, suppress
from nightshare.operators.prefix import attach, group_quantiles, many_quantiles
from nightshare.session import settled

LEAST_PEERS = 10
PROFESSIONAL_HOMES = 10


def cube_quantiles(df: DataFrame, zone: str, capacity: str, price: str, least: int = LEAST_PEERS) -> DataFrame:
    """Price quartiles for (zone, capacity), zone, capacity and all, hidden below ``least`` rows.

    Rows are counted by (zone, capacity, price) before they are copied to the four levels.
    ``level`` is 0 for the finest cells, 1 without capacity, 2 without zone and 3 for all.
    """
    counted = df.groupBy(zone, capacity, price).agg(F.count(F.lit(1)).alias("__n"))
    levels = F.array(
        *[
            F.struct(
                (F.col(zone) if not lv & 2 else F.lit(None)).alias("z"),
                (F.col(capacity) if not lv & 1 else F.lit(None)).alias("c"),
                F.lit(lv).cast("bigint").alias("level"),
            )
            for lv in range(4)
        ]
    )
    copied = counted.select(F.explode(levels).alias("g"), price, "__n").select(
        F.col("g.z").alias(zone), F.col("g.c").alias(capacity), "g.level", price, "__n"
    )
    q = group_quantiles(copied, [zone, capacity, "level"], price, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, count_as="n", weight="__n")
    return q.select(zone, capacity, "level", "n", *[suppress(F.col(c), F.col("n"), least).alias(c) for c in ("p25", "p50", "p75")])


def with_peers(active: DataFrame, zone: str = "zone", guests: str = "accommodates", least: int = LEAST_PEERS) -> DataFrame:
    """Each listing with the quartiles of its zone and capacity band; thin groups and unknown bands are left out."""
    banded = settled(active.withColumn("band", capacity_band(F.col(guests))).where(F.col("band").isNotNull()), "banded")
    keys = [zone, "band"]
    q = many_quantiles(
        banded, keys, {"income": "income", "price": "price", "occ": "occ"}, {"q25": 0.25, "med": 0.5, "q75": 0.75}, count_as="peers"
    )
    return attach(banded, q.where(F.col("peers") >= least), keys, "inner")


def flag_gaps(peered: DataFrame) -> DataFrame:
    """Underperformer: income below the peers' lower quartile. Cheap and full: top occupancy at a bottom price."""
    under = F.col("income") < F.col("income_q25")
    return (
        peered.withColumn("underperforms", under)
        .withColumn("gap", F.when(under, F.col("income_med") - F.col("income")).otherwise(F.lit(0.0)))
        .withColumn("cheap_and_full", (F.col("occ") >= F.col("occ_q75")) & (F.col("price") <= F.col("price_q25")))
        .withColumn("upside", F.when(F.col("cheap_and_full"), (F.col("price_med") - F.col("price")) * F.col("nights_year") / 12).otherwise(F.lit(0.0)))
    )


def peer_gap(active: DataFrame, by: Sequence[str] = ("zone",), zone: str = "zone", guests: str = "accommodates", least: int = LEAST_PEERS) -> DataFrame:
    """Per zone (or over all with ``by=[]``): listings, underperformers, missing income, cheap and full homes and their upside."""
    flagged = flag_gaps(with_peers(active, zone, guests, least))
    return flagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("listings"),
        F.count_if("underperforms").alias("underperformers"),
        F.sum("gap").alias("gap"),
        F.count_if("cheap_and_full").alias("cheap_and_full"),
        F.sum("upside").alias("upside"),
    )


def host_segments(active: DataFrame, homes: str, zone: str = "zone", guests: str = "accommodates", least: int = LEAST_PEERS) -> DataFrame:
    """By host size: listings, medians, and the share below the peers' lower income quartile."""
    peered = settled(with_peers(active, zone, guests, least).withColumn("segment", host_segment(F.col(homes))), "peered")
    sizes = peered.groupBy("segment").agg(
        F.count(F.lit(1)).alias("listings"), F.avg((F.col("income") < F.col("income_q25")).cast("double")).alias("below_q25")
    )
    med = many_quantiles(peered, ["segment"], {"price": "price", "occ": "occ", "income": "income"}, {"median": 0.5})
    return attach(sizes, med, ["segment"])


def zone_metrics(
    listings: DataFrame, levels: Mapping[str, Column], entire: Column, professional: Column, active: Column,
    residents: DataFrame | None = None, rent: Column | float | None = None, least: int = LEAST_PEERS,
) -> DataFrame:
    """The same metrics for several zonings at once.

    ``levels`` maps a level name to the column that holds its zone; rows without a zone
    stay out of that level. ``residents`` has (level, zone, residents).
    """
    rows = F.array(*[F.struct(F.lit(n).alias("level"), z.cast("string").alias("zone")) for n, z in levels.items()])
    spread = (
        listings.withColumn("__entire", entire)
        .withColumn("__pro", professional)
        .withColumn("__active", active)
        .select("__entire", "__pro", "__active", "price", "occ", "income", F.explode(rows).alias("__z"))
        .select("*", "__z.*")
        .drop("__z")
        .where(F.col("zone").isNotNull())
    )
    keys, spread = ["level", "zone"], settled(spread, "spread")
    base = spread.groupBy(*keys).agg(
        F.count_if("__entire").alias("homes"),
        F.avg((~F.col("__entire")).cast("double")).alias("room_share"),
        F.count_if(F.col("__entire") & F.col("__pro")).alias("__pros"),
        F.count_if("__active").alias("active"),
    )
    q = many_quantiles(spread.where("__active"), keys, {"price": "price", "occ": "occ", "income": "income"}, {"p25": 0.25, "median": 0.5, "p75": 0.75})
    out = attach(base, q, keys)
    if residents is not None:
        out = attach(out, residents, keys).withColumn("per_1000", F.try_divide(F.col("homes") * 1000.0, F.col("residents")))
    shown = ("price_median", "occ_median", "income_p25", "income_median", "income_p75")
    times = [] if rent is None else [suppress(F.col("income_median") / rent, F.col("active"), least).alias("times_long_let")]
    return out.select(
        *keys,
        "homes",
        "room_share",
        suppress(F.try_divide(F.col("__pros").cast("double"), F.col("homes")), F.col("homes"), least).alias("pro_share"),
        "active",
        *[suppress(F.col(c), F.col("active"), least).alias(c) for c in shown],
        *times,
        *(["per_1000"] if residents is not None else []),
    )
