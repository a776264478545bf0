"""Checks that count violations. All row rules of a table are counted in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, WARN = "block", "warn"


class BlockedByCheck(Exception):
    """Raised when a blocking rule has violations."""


def check_report(df: DataFrame, rules: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """One row per rule with its severity and number of violating rows. A rule that is null counts as kept."""
    counted = df.agg(*[F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, (_, cond) in rules.items()])
    rows = [
        F.struct(F.lit(name).alias("rule"), F.lit(sev).alias("severity"), F.col(name).alias("violations"))
        for name, (sev, _) in rules.items()
    ]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def enforce(report: DataFrame) -> None:
    """Stop the job when a blocking rule is violated. The report has one row per rule."""
    broken = [r for r in report.where((F.col("severity") == BLOCK) & (F.col("violations") > 0)).collect()]
    if broken:
        raise BlockedByCheck(", ".join(f"{r['rule']}: {r['violations']}" for r in broken))


def not_null(c: Column) -> Column:
    return c.isNull()


def in_range(c: Column, lo, hi) -> Column:
    """Violated by null as well as by a value outside."""
    return c.isNull() | ~c.between(lo, hi)


def ordered(a: Column, b: Column) -> Column:
    return a > b


def allowed_values(c: Column, values: Sequence) -> Column:
    return c.isNotNull() & ~c.isin(*values)


def unique_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows. Counting per key first keeps a hot key in the map side."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def dependency_violations(df: DataFrame, determinant: str, dependent: str) -> DataFrame:
    """Values of one column that go with more than one value of another."""
    return (
        df.select(determinant, dependent)
        .distinct()
        .groupBy(determinant)
        .agg(F.count(dependent).alias("n"))
        .where("n > 1")
    )


def missing_from(expected: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    return expected.select(*keys).distinct().join(found.select(*keys).distinct(), list(keys), "left_anti")


def reconcile_sets(expected: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are only on one side, marked missing or surplus."""
    marked = expected.select(*keys, F.lit(1).alias("e"), F.lit(0).alias("f")).unionByName(
        found.select(*keys, F.lit(0).alias("e"), F.lit(1).alias("f"))
    )
    sides = marked.groupBy(*keys).agg(F.max("e").alias("e"), F.max("f").alias("f"))
    return sides.where("e <> f").select(*keys, F.when(F.col("e") == 1, "missing").otherwise("surplus").alias("status"))


def reconcile_counts(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts of two layers by key, with their difference."""
    one = F.count(F.lit(1))
    both = (
        a.groupBy(*keys).agg(one.alias("rows_a"))
        .withColumn("rows_b", F.lit(0).cast("bigint"))
        .unionByName(b.groupBy(*keys).agg(one.alias("rows_b")).withColumn("rows_a", F.lit(0).cast("bigint")))
    )
    return (
        both.groupBy(*keys)
        .agg(F.sum("rows_a").alias("rows_a"), F.sum("rows_b").alias("rows_b"))
        .withColumn("difference", F.col("rows_b") - F.col("rows_a"))
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of nulls by column, three decimals."""
    columns = list(columns or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(c) for c in columns])
    return (
        one.unpivot("__n", columns, "column", "filled")
        .select("column", F.round(1 - F.try_divide("filled", "__n"), 3).alias("null_share"))
    )


def all_null_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    one = df.agg(*[F.count(c).alias(c) for c in columns])
    return one.unpivot([], columns, "column", "filled").where("filled = 0").select("column")


def orphans(a: DataFrame, b: DataFrame, key: str, day: str) -> DataFrame:
    """Keys in one table only, both ways: how many, and the days they span."""

    def side(x, y, label):
        only = x.join(y.select(key).distinct(), key, "left_anti")
        return only.agg(
            F.lit(label).alias("side"),
            F.countDistinct(key).alias("ids"),
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
        )

    return side(a, b, "left").unionByName(side(b, a, "right"))


def parse_agreement(df: DataFrame, a: Column, b: Column, tol: float = 0.01) -> DataFrame:
    both = a.isNotNull() & b.isNotNull()
    return df.where(both).agg(
        F.count(F.lit(1)).alias("compared"), F.avg((F.abs(a - b) < tol).cast("double")).alias("agreement")
    )
