"""From raw text to typed, checked silver tables. All captures go through one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshare.functions import cleaning as c
from nightshare.operators import quality as qa
from nightshare.sources import readers as rd
from nightshare.sources.writers import write_observed


def silver_listings(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed listings with price, flags and licence class; the raw licence is dropped.

    ``keep`` names columns that come along as they are, such as city and capture date.
    """
    typed = raw.select(
        *keep,
        *[F.col(x).try_cast("bigint").alias(x) for x in rd.LISTING_LONGS],
        *[F.col(x).try_cast("double").alias(x) for x in rd.LISTING_DOUBLES],
        *[F.col(x).try_cast("date").alias(x) for x in rd.LISTING_DATES],
        *[F.col(x) for x in rd.LISTING_STRINGS],
    )
    price = c.parse_price(F.col("price"))
    return (
        typed.withColumn("price_num", price)
        .withColumn("price_missing", c.price_missing(F.col("price_num")))
        .withColumn("price_outlier", c.price_outlier(F.col("price_num")))
        .withColumn("is_long_stay", c.long_stay(F.col("minimum_nights")))
        .withColumn("has_availability", c.tri_bool(F.col("has_availability")))
        .withColumn("host_is_superhost", c.tri_bool(F.col("host_is_superhost")))
        .withColumn("neighbourhood_cleansed", c.repair_mojibake(F.col("neighbourhood_cleansed")))
        .withColumn("neighbourhood_group_cleansed", c.repair_mojibake(F.col("neighbourhood_group_cleansed")))
        .withColumn("licence_status", c.licence_status(F.col("license")))
        .withColumn("exempt_type", c.exempt_type(F.col("license")))
        .drop("license")
    )


def listing_rules(box: Column) -> dict[str, tuple[str, Column]]:
    """Rules of the listings table. ``box`` is true where the coordinates suit the row's own city."""
    return {
        "id": (qa.BLOCK, qa.not_null(F.col("id"))),
        "price_flags": (qa.BLOCK, qa.not_null(F.col("price_missing")) | qa.not_null(F.col("price_outlier"))),
        "long_stay_flag": (qa.BLOCK, qa.not_null(F.col("is_long_stay"))),
        "coordinates": (qa.WARN, ~F.coalesce(box, F.lit(False))),
        "capacity": (qa.WARN, F.col("accommodates") <= 0),
        "price": (qa.WARN, F.col("price_num") <= 0),
        "availability_order": (qa.WARN, qa.ordered(F.col("availability_30"), F.col("availability_365"))),
        "review_dates": (qa.WARN, qa.ordered(F.col("first_review"), F.col("last_review"))),
        "review_counts": (qa.WARN, qa.ordered(F.col("number_of_reviews_ltm"), F.col("number_of_reviews"))),
        "stay_limits": (qa.WARN, qa.ordered(F.col("minimum_nights"), F.col("maximum_nights"))),
    }


def raw_flag_rules(columns: list[str]) -> dict[str, tuple[str, Column]]:
    """Blocks text other than t and f before it is turned into booleans."""
    return {x: (qa.BLOCK, qa.allowed_values(F.col(x), ["t", "f"])) for x in columns}


def city_box(boxes: dict[str, tuple[float, float, float, float]], city: Column, lat: Column, lon: Column) -> Column:
    """Whether a point lies in its city's box (lat from, lat to, lon from, lon to)."""
    out = F.lit(None).cast("boolean")
    for name, (a, b, w, e) in boxes.items():
        out = F.when(city == name, lat.between(a, b) & lon.between(w, e)).otherwise(out)
    return out


def silver_calendar(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return raw.select(
        *keep,
        F.col("listing_id").try_cast("bigint").alias("listing_id"),
        F.col("date").try_cast("date").alias("date"),
        c.tri_bool(F.col("available")).alias("available"),
        F.col("minimum_nights").try_cast("int").alias("minimum_nights"),
        F.col("maximum_nights").try_cast("int").alias("maximum_nights"),
    )


def calendar_rules(snapshot: Column) -> dict[str, tuple[str, Column]]:
    return {
        "listing_id": (qa.BLOCK, qa.not_null(F.col("listing_id"))),
        "date": (qa.BLOCK, qa.not_null(F.col("date"))),
        "available": (qa.BLOCK, qa.not_null(F.col("available"))),
        "least_stay": (qa.WARN, F.col("minimum_nights") < 1),
        "night_not_before_capture": (qa.WARN, qa.ordered(snapshot, F.col("date"))),
        "stay_limits": (qa.WARN, qa.ordered(F.col("minimum_nights"), F.col("maximum_nights"))),
    }


def _with_raw_flags(raw: DataFrame, columns: list[str]) -> tuple[DataFrame, dict[str, tuple[str, Column]], list[str]]:
    """The rules on raw text as columns, since the text itself is gone after typing."""
    rules = raw_flag_rules(columns)
    names = {f"__raw_{x}": rule for x, (_, rule) in rules.items()}
    return raw.withColumns(names), {f"{x} is t or f": (qa.BLOCK, F.col(f"__raw_{x}")) for x in columns}, list(names)


def load_listings(raw: DataFrame, path: str, boxes: dict[str, tuple[float, float, float, float]], keys: tuple[str, ...] = ("city", "snapshot_date")) -> DataFrame:
    """Raw listings (text, with ``keys``) to the silver table: typed, checked and published in one pass. Returns the report.

    A listing that stands twice in one capture, a missing id or flag, and odd true-or-false text block the load.
    """
    flagged, rules, helpers = _with_raw_flags(raw, ["has_availability", "host_is_superhost"])
    df = silver_listings(flagged, (*keys, *helpers))
    box = city_box(boxes, F.col(keys[0]), F.col("latitude"), F.col("longitude"))
    return write_observed(df, path, rules | listing_rules(box), keys, (*keys, "id"), helpers)


def load_calendar(raw: DataFrame, path: str, keys: tuple[str, ...] = ("city", "snapshot_date")) -> DataFrame:
    """Raw calendar (text, with ``keys``) to the silver table; a night that stands twice for a listing and capture blocks."""
    flagged, rules, helpers = _with_raw_flags(raw, ["available"])
    df = silver_calendar(flagged, (*keys, *helpers))
    return write_observed(df, path, rules | calendar_rules(F.col(keys[1])), keys, (*keys, "listing_id", "date"), helpers)
