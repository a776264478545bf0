"""Business measures evaluated by any dimension columns under any dimension filters.

``model`` holds four tables: ``listings`` (listing by capture), ``calendar`` (listing by
night and capture), ``dim_listing`` and ``dim_snapshot``. Filters name dimension columns
and reach the facts through the dimensions only. Facts without a member keep a null one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshare.functions.cleaning import reliability_level, valid_price
from nightshare.operators.prefix import attach, group_quantiles
from nightshare.plans.occupancy import NEAR_LEAD

DATE = "snapshot_date"
SEASON = "season"

# Reliability steps, the least priced listings, the spread between listings and the normal quantile.
DEFAULTS = {
    "steps": (100, 50, 30),
    "least_priced": 30,
    "listing_spread": 0.32,
    "normal_quantile": 1.96,
    "high_season": "2 summer",
    "low_season": "4 winter",
    "price_note": "Some captures have no prices: the median price is not computed for them",
    "coverage_note": "Some captures are incomplete: compare with care",
    "labels": ("1 reliable", "2 fair", "3 indicative"),
}

# Which base aggregates each measure is made of.
NEEDS: dict[str, set[str]] = {
    "listings": {"count"},
    "median_adr": {"adr"},
    "price_note": {"count"},
    "coverage_note": {"count"},
    "priced_listings": {"count"},
    "reliability": {"per_date"},
    "reliability_label": {"per_date"},
    "occupancy_margin": {"per_date"},
    "reliable_adr": {"per_date", "adr"},
    "reliable_revpar": {"per_date", "adr", "occ"},
    "sort_key": {"per_date", "adr", "occ"},
    "visible_listings": {"per_date"},
    "visible_occupancy": {"per_date", "occ"},
    "winter_drop": {"per_date", "seasons"},
    "listing_change": {"per_date", "ends"},
    "listings_per_month": {"per_date"},
    "priced_per_month": {"per_date"},
    "occupancy": {"occ"},
    "revpar": {"adr", "occ"},
    "occupancy_min": {"occ_dates"},
    "occupancy_mean": {"occ_dates"},
    "occupancy_max": {"occ_dates"},
    "adr_min": {"adr_dates"},
    "adr_mean": {"adr_dates"},
    "adr_max": {"adr_dates"},
    "revpar_min": {"revpar_dates"},
    "revpar_mean": {"revpar_dates"},
    "revpar_max": {"revpar_dates"},
}


def reliability_sort_key(level: Column, revpar: Column, worst: int = 3) -> Column:
    """Level first, then revenue from high to low; nothing beyond the worst shown level."""
    return F.when(level <= worst, level * 100000 - F.coalesce(revpar, F.lit(0.0)))


def _filtered(df: DataFrame, where: Mapping[str, Sequence], skip: Sequence[str] = ()) -> DataFrame:
    for c, values in where.items():
        if c in df.columns and c not in skip:
            df = df.where(F.col(c).isin(*values))
    return df


def _in_context(
    model: Mapping[str, DataFrame], fact: str, used: Sequence[str], where: Mapping[str, Sequence], skip: Sequence[str] = ()
) -> DataFrame:
    """A fact with those dimensions joined whose columns are used. A dimension nobody asks for costs nothing."""
    out = model[fact]
    for dim, keys in (("dim_listing", ["listing_id"]), ("dim_snapshot", ["city", DATE])):
        table = model[dim]
        extra = [c for c in table.columns if c in {*used, *where} and c not in out.columns]
        if extra:
            out = out.join(table.select(*keys, *extra), keys, "left")
    return _filtered(out, where, skip)


def _ok() -> Column:
    return valid_price(F.col("price_missing"), F.col("price_outlier"), F.col("long_stay"))


def _occ_parts() -> list[Column]:
    near = F.col("lead").between(0, NEAR_LEAD)
    return [F.count_if(near & (F.col("taken") == 1)).alias("__taken"), F.count_if(near).alias("__seen")]


def evaluate(
    model: Mapping[str, DataFrame], measures: Sequence[str], by: Sequence[str] = (), where: Mapping[str, Sequence] | None = None,
    **settings,
) -> DataFrame:
    """One row per combination of ``by`` with the measures as columns. Rows with blanks only are dropped."""
    opt = {**DEFAULTS, **settings}
    by, where = list(by), dict(where or {})
    need = set().union(*[NEEDS[m] for m in measures])
    listings = _in_context(model, "listings", by, where)
    calendar = _in_context(model, "calendar", by, where)
    share = F.try_divide(F.sum("__taken"), F.sum("__seen"))
    pieces: list[DataFrame] = []

    # One row per listing first: distinct counts then need no copies of the fact rows, and a large
    # group is spread over its listings.
    if "count" in need:
        once = listings.groupBy(*by, "listing_id").agg(F.max(_ok().cast("int")).alias("__priced"))
        pieces.append(
            once.groupBy(*by).agg(F.count("listing_id").alias("listings"), F.sum("__priced").alias("priced_listings"))
        )
    if "per_date" in need:
        once = listings.groupBy(*_with(by, DATE), "listing_id").agg(F.max(_ok().cast("int")).alias("__priced"))
        dated = once.groupBy(*_with(by, DATE)).agg(F.count("listing_id").alias("__n"), F.nullif(F.sum("__priced"), F.lit(0)).alias("__p"))
        pieces.append(
            dated.groupBy(*by).agg(
                F.round(F.avg("__n"), 0).alias("listings_per_month"), F.round(F.avg("__p"), 0).alias("priced_per_month")
            )
        )
    if "adr" in need:
        pieces.append(group_quantiles(listings.where(_ok()), by, "price", {"median_adr": 0.5}))
    if need & {"occ", "occ_dates", "revpar_dates"}:
        occ_dated = calendar.groupBy(*_with(by, DATE)).agg(*_occ_parts())
        if "occ" in need:
            pieces.append(occ_dated.groupBy(*by).agg(share.alias("occupancy")))
        per_date = occ_dated.withColumn("__m", F.try_divide("__taken", "__seen"))
        if "occ_dates" in need:
            pieces.append(per_date.groupBy(*by).agg(*_three("__m", "occupancy")))
    if need & {"adr_dates", "revpar_dates"}:
        adr_dated = group_quantiles(listings.where(_ok()), _with(by, DATE), "price", {"__adr": 0.5})
        if "adr_dates" in need:
            pieces.append(adr_dated.groupBy(*by).agg(*_three("__adr", "adr")))
        if "revpar_dates" in need:
            both = attach(adr_dated, per_date.select(*_with(by, DATE), "__m"), _with(by, DATE), "inner")
            pieces.append(both.withColumn("__rp", F.col("__adr") * F.col("__m")).groupBy(*by).agg(*_three("__rp", "revpar")))
    if "ends" in need:
        snap_by = [b for b in by if b in model["dim_snapshot"].columns and b != "city"]
        bounds = (
            _filtered(model["dim_snapshot"], where)
            .where("is_complete")
            .groupBy("city", *snap_by)
            .agg(F.min(DATE).alias("__first"), F.max(DATE).alias("__last"))
        )
        ends = attach(listings, bounds, ["city", *snap_by], "inner").groupBy(*by, "listing_id").agg(
            F.max((F.col(DATE) == F.col("__first")).cast("int")).alias("__a"),
            F.max((F.col(DATE) == F.col("__last")).cast("int")).alias("__b"),
        )
        pieces.append(ends.groupBy(*by).agg(F.sum("__a").alias("__at_first"), F.sum("__b").alias("__at_last")))

    out = _side_by_side(pieces, by)

    if "seasons" in need:
        # The season filter and grouping are replaced here, not added to.
        rest = [b for b in by if b != SEASON]
        free = _in_context(model, "calendar", [*rest, SEASON], where, skip=[SEASON])
        seasonal = free.groupBy(*rest, F.col(SEASON).alias("__season")).agg(*_occ_parts())

        def of(name: str) -> Column:
            hit = F.col("__season") == name
            return F.try_divide(F.sum(F.when(hit, F.col("__taken"))), F.sum(F.when(hit, F.col("__seen"))))

        drop = seasonal.groupBy(*rest).agg((of(opt["high_season"]) - of(opt["low_season"])).alias("__drop"))
        out = attach(out, drop, rest) if rest else out.withColumn("__drop", drop.scalar())

    notes = [m for m in measures if m in ("price_note", "coverage_note")]
    if notes:
        # Notes follow the snapshot dimension alone, so a zone does not change them.
        snap_by = [b for b in by if b in model["dim_snapshot"].columns]
        flagged = _filtered(model["dim_snapshot"], where).groupBy(*snap_by).agg(
            F.count_if(~F.col("has_price")).alias("__no_price"), F.count_if(~F.col("is_complete")).alias("__partial")
        )
        if snap_by:
            out = attach(out, flagged, snap_by)
        else:
            out = out.withColumn("__no_price", flagged.select("__no_price").scalar()).withColumn(
                "__partial", flagged.select("__partial").scalar()
            )

    exprs = _measure_columns(opt)
    shown = out.select(*by, *[exprs[m].alias(m) for m in measures])
    any_value = F.lit(False)
    for m in measures:
        any_value = any_value | F.col(m).isNotNull()
    return shown.where(any_value)


def _with(by: Sequence[str], extra: str) -> list[str]:
    return [*by] if extra in by else [*by, extra]


def _three(value: str, name: str) -> list[Column]:
    return [F.min(value).alias(f"{name}_min"), F.avg(value).alias(f"{name}_mean"), F.max(value).alias(f"{name}_max")]


def _side_by_side(pieces: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """Full outer join of small per-group tables, as a union that is grouped once."""
    out = None
    for p in pieces:
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    if out is None:
        raise ValueError("no measure asks for a base aggregate")
    if len(pieces) == 1:
        return out
    return out.groupBy(*by).agg(*[F.max(c).alias(c) for c in out.columns if c not in by])


def _measure_columns(opt: Mapping) -> dict[str, Column]:
    level = reliability_level(F.col("listings_per_month"), opt["steps"])
    worst = len(opt["steps"])
    shown = level <= worst
    priced = shown & (F.col("priced_per_month") >= opt["least_priced"])
    revpar = F.col("median_adr") * F.col("occupancy")
    label = F.when(level == 1, opt["labels"][0])
    for i, text in enumerate(opt["labels"][1:], 2):
        label = label.when(level == i, text)
    change = F.try_divide(F.col("__at_last").cast("double"), F.col("__at_first")) - 1
    plain = (
        "listings priced_listings listings_per_month priced_per_month median_adr occupancy occupancy_min occupancy_mean occupancy_max "
        "adr_min adr_mean adr_max revpar_min revpar_mean revpar_max"
    ).split()
    return {
        **{m: F.col(m) for m in plain},
        "price_note": F.when(F.col("__no_price") > 0, opt["price_note"]),
        "coverage_note": F.when(F.col("__partial") > 0, opt["coverage_note"]),
        "reliability": level,
        "reliability_label": label,
        "occupancy_margin": F.when(shown, opt["normal_quantile"] * opt["listing_spread"] / F.sqrt("listings_per_month")),
        "reliable_adr": F.when(priced, F.col("median_adr")),
        "reliable_revpar": F.when(priced, revpar),
        "sort_key": reliability_sort_key(level, F.when(priced, revpar), worst),
        "visible_listings": F.when(shown, F.col("listings_per_month")),
        "visible_occupancy": F.when(shown, F.col("occupancy")),
        "winter_drop": F.when(shown, F.col("__drop") * 100),
        "listing_change": F.when(shown & (F.col("__at_first") > 0), change),
        "revpar": revpar,
    }
