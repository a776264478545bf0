"""Keyed archives of captures: what is new, what changed, what is gone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def changes(archive: DataFrame, capture: DataFrame, key: str, watched: Sequence[str], day: Column) -> DataFrame:
    """One row per known key and watched field whose value differs, with both values as text."""
    old = archive.select(key, F.struct(*watched).alias("__a"))
    new = capture.select(key, F.struct(*watched).alias("__b"))
    rows = [
        F.when(
            ~F.col(f"__a.{w}").eqNullSafe(F.col(f"__b.{w}")),
            F.struct(
                F.lit(w).alias("field"),
                F.col(f"__a.{w}").cast("string").alias("before"),
                F.col(f"__b.{w}").cast("string").alias("after"),
            ),
        )
        for w in watched
    ]
    pairs = old.join(new, key).select(key, F.explode(F.filter(F.array(*rows), lambda x: x.isNotNull())).alias("c"))
    return pairs.select(key, day.alias("captured"), "c.field", "c.before", "c.after")


def merge(archive: DataFrame | None, capture: DataFrame, key: str, day: Column) -> DataFrame:
    """The archive after a capture: new keys start, known keys move on, unseen keys stay as they are."""
    fields = [c for c in capture.columns if c != key]
    if archive is None:
        return capture.select(
            key, *fields, day.alias("first_seen"), day.alias("last_seen"), F.lit(1).cast("bigint").alias("captures")
        )
    new = capture.select(F.col(key).alias("__key"), F.struct(*fields).alias("__new"))
    both = archive.join(new, archive[key] == new["__key"], "full_outer")
    seen = F.col("__key").isNotNull()
    return both.select(
        F.coalesce(F.col("__key"), archive[key]).alias(key),
        *[F.when(seen, F.col(f"__new.{f}")).otherwise(archive[f]).alias(f) for f in fields],
        F.coalesce(archive["first_seen"], day).alias("first_seen"),
        F.when(seen, day).otherwise(archive["last_seen"]).alias("last_seen"),
        (F.coalesce(archive["captures"], F.lit(0)) + seen.cast("bigint")).alias("captures"),
    )


#: Columns of an archive's state that are not fields of the captures.
LEDGER = ("first_seen", "last_seen", "captures", "counted", "steps")


def keyed_captures(batch: DataFrame, key: str, watched: Sequence[str], day: str) -> DataFrame:
    """One row per key: its captures as a sorted array of (day, watched, other), one entry a day.

    Of several rows of a key and day the largest counts, by the watched fields first, so the outcome
    does not depend on the order in which they land. Rows without a key or a day are no captures.
    The array has an entry per capture day, so its length does not grow with the data.
    """
    other = [c for c in batch.columns if c not in (key, day, *watched)]
    rows = batch.where(F.col(key).isNotNull() & F.col(day).isNotNull())
    rows = rows.select(key, F.to_date(day).alias("__day"), F.struct(F.struct(*watched).alias("w"), F.struct(*other, F.lit(True).alias("__there")).alias("o")).alias("__row"))
    # Dealt by key first, both aggregates find a key's rows in one task.
    daily = rows.repartition(F.col(key)).groupBy(key, "__day").agg(F.max("__row").alias("__row"))
    return daily.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("__day").alias("day"), "__row.w", "__row.o"))).alias("__new"))


def advance(state: DataFrame | None, captures: DataFrame, key: str, watched: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """The state of every key of ``captures`` (see :func:`keyed_captures`) after them.

    ``state`` holds, per key, the fields of its last capture, ``counted`` (its capture days as words of 64 bits)
    and ``steps`` (the watched fields on the first day and on each day that changed them). These say what
    the watched fields were on every counted day, so a capture that lands again, late or in another
    order leads to the same state. For a key whose new days all follow its last one only the last step is looked at; a single
    day at either end, or with the watched fields already known for it, is added without looking at the other days.
    """
    if state is None:
        both = captures.withColumn("__old", F.lit(None).cast(_state_struct(captures, watched, fields)))
    else:
        old = state.select(F.col(key).alias("__key"), F.struct(*fields, *LEDGER).alias("__old"))
        both = captures.join(old, F.col(key) == F.col("__key"), "left").drop("__key")
    value = "named_struct(" + ", ".join(f"'{w}', __old.`{w}`" for w in watched) + ")"
    other = [f for f in fields if f not in watched]
    rest = "named_struct(" + ", ".join([*[f"'{f}', __old.`{f}`" for f in other], "'__there', true"]) + ")"
    # Most keys bring one day that is new at an end, or that changes no step: their state needs no walk over the days.
    both = both.selectExpr(
        "*",
        "size(__new) = 1 AND (__old IS NULL OR __new[0].day > __old.last_seen OR __new[0].day < __old.first_seen"
        " OR try_element_at(filter(__old.steps, s -> s.day <= __new[0].day), -1).w <=> __new[0].w) AS __plain",
    )
    late = "(NOT __plain AND __old IS NOT NULL AND __new[0].day <= __old.last_seen)"
    both = both.selectExpr(
        f"`{key}`",
        "__new",
        "__old",
        "__plain",
        f"CASE WHEN {late} THEN flatten(transform(__old.counted, x -> transform(filter(sequence(0, 63), i -> (shiftright(x.bits, i) & 1) = 1), i -> date_from_unix_date(cast(x.word * 64 + i AS INT)))))"
        " ELSE cast(array() AS ARRAY<DATE>) END AS __days",
    )
    # The watched fields by day: of the days counted before, where a capture lands among them, and of the new ones.
    held = "transform(filter(array(d), x -> array_contains(__days, x)), x -> try_element_at(filter(__old.steps, s -> s.day <= x), -1).w)"
    both = both.selectExpr(
        "*",
        f"CASE WHEN __plain THEN NULL ELSE transform(array_sort(array_union(__days, transform(__new, x -> x.day))), d -> named_struct('day', d, 'w', array_max(concat({held}, transform(filter(__new, x -> x.day = d), x -> x.w))))) END AS __points",
        f"CASE WHEN {late} OR __old IS NULL THEN NULL ELSE named_struct('day', __old.last_seen, 'w', {value}) END AS __before",
    )
    both = both.selectExpr("*", "CASE WHEN __before IS NULL THEN __points ELSE concat(array(__before), __points) END AS __line")
    changed = "filter(__line, (x, i) -> (i = 0 AND __before IS NULL) OR (i > 0 AND NOT (x.w <=> __line[i - 1].w)))"
    last = "element_at(__new, -1)"
    # Captures of one day weigh against each other as in keyed_captures.
    newest = (
        f"CASE WHEN __old IS NULL OR {last}.day > __old.last_seen THEN named_struct('w', {last}.w, 'o', {last}.o)"
        f" WHEN {last}.day < __old.last_seen THEN named_struct('w', {value}, 'o', {rest})"
        f" ELSE greatest(named_struct('w', {value}, 'o', {rest}), named_struct('w', {last}.w, 'o', {last}.o)) END"
    )
    words = "array_union(coalesce(transform(__old.counted, x -> x.word), cast(array() AS ARRAY<INT>)), transform(__new, x -> cast(floor(unix_date(x.day) / 64) AS INT)))"
    bits = (
        "aggregate(filter(__new, x -> cast(floor(unix_date(x.day) / 64) AS INT) = k), coalesce(try_element_at(filter(__old.counted, x -> x.word = k), 1).bits, 0L),"
        " (a, x) -> a | shiftleft(1L, pmod(unix_date(x.day), 64)))"
    )
    # The same for a plain key.
    word, bit = "cast(floor(unix_date(__new[0].day) / 64) AS INT)", "shiftleft(1L, pmod(unix_date(__new[0].day), 64))"
    entry, step = f"array(named_struct('word', {word}, 'bits', {bit}))", "array(named_struct('day', __new[0].day, 'w', __new[0].w))"
    one_counted = (
        f"CASE WHEN __old IS NULL THEN {entry} WHEN exists(__old.counted, x -> x.word = {word})"
        f" THEN transform(__old.counted, x -> named_struct('word', x.word, 'bits', CASE WHEN x.word = {word} THEN x.bits | {bit} ELSE x.bits END))"
        f" ELSE sort_array(concat(__old.counted, {entry})) END"
    )
    one_steps = (
        f"CASE WHEN __old IS NULL THEN {step}"
        f" WHEN __new[0].day > __old.last_seen THEN CASE WHEN __new[0].w <=> {value} THEN __old.steps ELSE concat(__old.steps, {step}) END"
        f" WHEN __new[0].day < __old.first_seen THEN concat({step}, CASE WHEN __new[0].w <=> __old.steps[0].w THEN slice(__old.steps, 2, size(__old.steps)) ELSE __old.steps END)"
        " ELSE __old.steps END"
    )
    both = both.selectExpr(
        "*",
        f"{newest} AS __last",
        f"CASE WHEN __plain THEN {one_counted} ELSE transform(array_sort({words}), k -> named_struct('word', k, 'bits', {bits})) END AS counted",
        f"CASE WHEN __plain THEN {one_steps} WHEN __before IS NULL THEN {changed} ELSE concat(__old.steps, {changed}) END AS steps",
    )
    return both.selectExpr(
        f"`{key}`",
        *[f"__last.w.`{f}` AS `{f}`" if f in watched else f"__last.o.`{f}` AS `{f}`" for f in fields],
        "least(__old.first_seen, __new[0].day) AS first_seen",
        f"greatest(__old.last_seen, {last}.day) AS last_seen",
        "aggregate(counted, 0L, (a, x) -> a + bit_count(x.bits)) AS captures",
        "counted",
        "steps",
    )


def _state_struct(captures: DataFrame, watched: Sequence[str], fields: Sequence[str]) -> T.StructType:
    entry = captures.schema["__new"].dataType.elementType
    types = {f.name: f.dataType for part in ("w", "o") for f in entry[part].dataType}
    step = T.StructType([T.StructField("day", T.DateType()), T.StructField("w", entry["w"].dataType)])
    word = T.StructType([T.StructField("word", T.IntegerType()), T.StructField("bits", T.LongType())])
    ledger = [T.DateType(), T.DateType(), T.LongType(), T.ArrayType(word), T.ArrayType(step)]
    return T.StructType([T.StructField(f, types[f]) for f in fields] + [T.StructField(n, t) for n, t in zip(LEDGER, ledger)])


def change_log(state: DataFrame, key: str, watched: Sequence[str]) -> DataFrame:
    """One row per step and watched field that it changed: key, captured, field, before, after."""
    differ = ", ".join(
        f"CASE WHEN NOT (steps[i].w.`{w}` <=> a.w.`{w}`) THEN named_struct('captured', a.day, 'field', '{w}', 'before', cast(steps[i].w.`{w}` AS STRING), 'after', cast(a.w.`{w}` AS STRING)) END"
        for w in watched
    )
    found = f"flatten(transform(slice(steps, 2, size(steps) - 1), (a, i) -> array({differ})))"
    return state.where("size(steps) > 1").selectExpr(f"`{key}`", f"explode(filter({found}, x -> x IS NOT NULL)) AS c").select(key, "c.*")


def disappeared(archive: DataFrame, last_capture: Column, start: str) -> DataFrame:
    """Entries still to come that the last capture no longer showed."""
    return archive.where((F.col("last_seen") < last_capture) & (F.col(start) > last_capture))


def joins_and_leaves(photos: DataFrame, key: str, photo: str, group: Sequence[str] = ()) -> DataFrame:
    """Keys added and removed between consecutive full photos of a register.

    The order of photos is a small table per group; a photo is matched with the one
    before through it, so both sides join on a unique key.
    """
    from pyspark.sql import Window

    group = list(group)
    order = photos.select(*group, photo).distinct()
    w = Window.partitionBy(*group).orderBy(photo)
    steps = order.select(*group, photo, F.lead(photo).over(w).alias("__next"), F.lag(photo).over(w).alias("__before"))
    rows = photos.select(*group, key, photo).distinct().join(steps, [*group, photo])
    present = photos.select(*group, key, photo).distinct()
    added = rows.where(F.col("__before").isNotNull()).join(
        present.withColumnRenamed(photo, "__before"), [*group, key, "__before"], "left_anti"
    )
    removed = rows.where(F.col("__next").isNotNull()).join(
        present.withColumnRenamed(photo, "__next"), [*group, key, "__next"], "left_anti"
    )
    marked = added.select(*group, photo, F.lit("joined").alias("move")).unionByName(
        removed.select(*group, F.col("__next").alias(photo), F.lit("left").alias("move"))
    )
    return marked.groupBy(*group, photo).agg(
        F.count_if(F.col("move") == "joined").alias("joined"), F.count_if(F.col("move") == "left").alias("left")
    )


def additions_by_month(register: DataFrame, registered: str) -> DataFrame:
    return register.groupBy(F.date_format(registered, "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("added"))


def registry_match_share(listings: DataFrame, registry: DataFrame, code: str, registry_code: str, by: Sequence[str]) -> DataFrame:
    """Share of listings whose code is in the register."""
    known = registry.select(F.col(registry_code).alias(code), F.lit(1).alias("__hit")).distinct()
    return listings.join(known, code, "left").groupBy(*by).agg(
        F.count(F.lit(1)).alias("listings"), F.avg(F.col("__hit").isNotNull().cast("double")).alias("matched")
    )


def listing_turnover(listings: DataFrame, key: str, snapshot: str, by: Sequence[str] = ()) -> DataFrame:
    """Listings seen once only, and the mean number of captures a listing is in."""
    per = listings.select(*by, key, snapshot).distinct().groupBy(*by, key).agg(F.count(F.lit(1)).alias("__n"))
    return per.groupBy(*by).agg(
        F.count(F.lit(1)).alias("listings"), F.count_if(F.col("__n") == 1).alias("seen_once"), F.avg("__n").alias("mean_captures")
    )
