"""Typing, flags and labels for single columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The price that stands for "unknown", and the two minimum-stay thresholds in use.
UNKNOWN_PRICE = 9999.0
LONG_STAY_NIGHTS = 28
SHORT_STAY_MAX_NIGHTS = 30

# Marks found in the source's licence text, and where the kind of exemption stands in it.
EXEMPT_MARK = "Exempt"
REGISTERED_MARKS = ("Basque Country - Regional", "Spain - National")
EXEMPT_KIND = r"Exempt - ([^<]+)"


def cast_groups(
    df: DataFrame,
    longs: Iterable[str] = (),
    doubles: Iterable[str] = (),
    dates: Iterable[str] = (),
    strings: Iterable[str] = (),
) -> DataFrame:
    """Keep the named columns only, each with its type. A value that does not parse becomes null."""
    return df.select(
        *[F.col(c).try_cast("bigint").alias(c) for c in longs],
        *[F.col(c).try_cast("double").alias(c) for c in doubles],
        *[F.col(c).try_cast("date").alias(c) for c in dates],
        *[F.col(c).cast("string").alias(c) for c in strings],
    )


def parse_price(text: Column) -> Column:
    return F.regexp_replace(text, "[$,]", "").try_cast("double")


def parse_price_strict(text: Column) -> Column:
    """Digits and dots only, and only prices above 0 and below the unknown mark."""
    p = F.regexp_replace(text, "[^0-9.]", "").try_cast("double")
    return F.when((p > 0) & (p < UNKNOWN_PRICE), p)


def tri_bool(text: Column) -> Column:
    """``t`` and ``f`` to a boolean. Other text gives null; block it with a check on the raw text."""
    return F.when(text == "t", True).when(text == "f", False)


def is_taken(text: Column) -> Column:
    """1 when the night is not available. Missing or odd text counts as free."""
    return F.coalesce(F.lower(text).isin("f", "false"), F.lit(False)).cast("int")


def price_missing(price: Column) -> Column:
    return price.isNull()


def price_outlier(price: Column) -> Column:
    return F.coalesce(price == UNKNOWN_PRICE, F.lit(False))


def long_stay(min_nights: Column, threshold: int = LONG_STAY_NIGHTS) -> Column:
    return F.coalesce(min_nights >= threshold, F.lit(False))


def repair_mojibake(text: Column) -> Column:
    """UTF-8 that was read as latin-1, put right. Text that cannot be such a case stays as it is."""
    suspect = text.contains("Ã") & text.rlike(r"^[\x00-\xFF]*$")
    raw = F.when(suspect, F.encode(F.when(suspect, text), "ISO-8859-1"))
    fixed = F.when(F.is_valid_utf8(raw.cast("string")), F.try_validate_utf8(raw.cast("string")))
    return F.coalesce(fixed, text)


def licence_status(text: Column, exempt: str = EXEMPT_MARK, registered: Sequence[str] = REGISTERED_MARKS) -> Column:
    """none, exempt, registered or free text; the first that fits wins."""
    marked = F.lit(False)
    for m in registered:
        marked = marked | text.contains(m)
    return (
        F.when(text.isNull(), "none").when(text.contains(exempt), "exempt").when(marked, "registered").otherwise("free text")
    )


def exempt_type(text: Column, pattern: str = EXEMPT_KIND) -> Column:
    return F.nullif(F.trim(F.regexp_extract(text, pattern, 1)), F.lit(""))


def add_partition_keys(df: DataFrame, city: str, snapshot: str) -> DataFrame:
    return df.withColumn("city", F.lit(city)).withColumn("snapshot_date", F.to_date(F.lit(snapshot)))


def snapshot_key(city: Column, day: Column) -> Column:
    return F.concat_ws("_", city.cast("string"), F.date_format(day, "yyyyMMdd"))


def zone_key(city: Column, zone: Column) -> Column:
    return F.concat_ws("|", city.cast("string"), zone)


def rename_values(df: DataFrame, column: str, names: Mapping[str, str]) -> DataFrame:
    """Show other names. Keys built before stay as they were."""
    return df.replace(dict(names), subset=[column]) if names else df


def stressed_flag(city: Column, zone: Column, whole_cities: Sequence[str], zones: Mapping[str, Sequence[str]]) -> Column:
    """Yes when the whole city is declared, or the city is listed and the zone is on its list."""
    cond = city.isin(*whole_cities) if whole_cities else F.lit(False)
    for c, zs in zones.items():
        cond = cond | ((city == c) & zone.isin(*zs))
    return F.when(F.coalesce(cond, F.lit(False)), "yes").otherwise("no")


def season(month: Column) -> Column:
    return (
        F.when(month.between(3, 5), "1 spring")
        .when(month.between(6, 8), "2 summer")
        .when(month.between(9, 11), "3 autumn")
        .otherwise("4 winter")
    )


def band(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands: edges[i] < value <= edges[i + 1]. Outside gives null."""
    out = None
    for lo, hi, label in zip(edges, edges[1:], labels):
        cond = (value > lo) & (value <= hi)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


def capacity_band(guests: Column) -> Column:
    return band(guests, (0, 2, 4, 6, 99), ("1-2", "3-4", "5-6", "7+"))


def host_segment(homes: Column) -> Column:
    return band(homes, (0, 1, 9, 1_000_000), ("private", "small", "professional"))


def reliability_level(n: Column, steps: Sequence[float] = (100, 50, 30)) -> Column:
    """1 is best, 4 is below the last step; null stays null."""
    out = F.when(n.isNull(), F.lit(None).cast("int"))
    for i, s in enumerate(steps, 1):
        out = out.when(n >= s, i)
    return out.otherwise(len(steps) + 1)


def by_prefix(text: Column, prefixes: Mapping[str, str], default: str | None = None) -> Column:
    out = None
    for p, label in prefixes.items():
        out = F.when(text.startswith(p), label) if out is None else out.when(text.startswith(p), label)
    return out.otherwise(default) if default is not None else out


def zone_group(zone: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    out = None
    for name, zones in groups.items():
        out = F.when(zone.isin(*zones), name) if out is None else out.when(zone.isin(*zones), name)
    return out


def clip01_percent(share: Column) -> Column:
    """Whole per cent of a share held within 0 and 1, halves to the even number."""
    return F.bround(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * 100).cast("int")


def suppress(value: Column, n: Column, least: int) -> Column:
    """No figure for cells with fewer than ``least`` members."""
    return F.when(n >= least, value)


def valid_price(missing: Column, outlier: Column, is_long: Column) -> Column:
    return ~missing & ~outlier & ~is_long


def active(
    room_type: Column, min_nights: Column, reviews_year: Column, price: Column, occupancy: Column,
    entire: Sequence[str] = ("Entire home/apt",), most_nights: int = SHORT_STAY_MAX_NIGHTS,
) -> Column:
    return (
        room_type.isin(*entire) & (min_nights <= most_nights) & (reviews_year > 0) & price.isNotNull() & occupancy.isNotNull()
    )
