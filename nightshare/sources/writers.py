"""Writers: partition-safe reloads, dimensions, facts, logs and reports."""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from nightshare.operators.quality import BLOCK, BlockedByCheck, enforce, unique_key
from nightshare.sources import folders


def _rebalanced(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a partition side by side in tasks of the advisory size.

    A large partition is split over many tasks and small ones share a task, so a capture
    that holds a third of all rows does not end in one task.
    """
    return df.hint("rebalance", *[F.col(k) for k in keys])


def write_partition(df: DataFrame, path: str, keys: Sequence[str] = ("city", "snapshot_date"), fmt: str = "parquet") -> None:
    """Replace only the partitions the rows belong to. Running it again gives the same table."""
    out = _rebalanced(df, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy(*keys).format(fmt).save(path)


def write_dim(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a whole dimension, columns included."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("overwriteSchema", "true").format(fmt).save(path)


def write_fact(df: DataFrame, path: str, key: str = "snapshot_id", fmt: str = "parquet") -> None:
    """Replace a fact partitioned by ``key``."""
    out = _rebalanced(df, [key]).write.mode("overwrite").option("partitionOverwriteMode", "static")
    out.partitionBy(key).format(fmt).save(path)


def write_checked(df: DataFrame, report: DataFrame, path: str, keys: Sequence[str] = ("city", "snapshot_date")) -> None:
    """Write only when no blocking rule is violated."""
    enforce(report)
    write_partition(df, path, keys)


def write_observed(
    df: DataFrame, path: str, rules: Mapping[str, tuple[str, Column]], keys: Sequence[str] = ("city", "snapshot_date"), unique: Sequence[str] = (), helpers: Sequence[str] = ()
) -> DataFrame:
    """Write with the checks counted in the same pass; publish only if no blocking rule has violations. Returns the report.

    The rows go to a hidden folder in or beside the table while an observation counts each rule over them. It stands in the
    last stage of the write, where each task counts once however often it is tried. Keys that have to be
    ``unique`` are then counted from the written key columns alone. Partitions of the new rows replace the old ones by
    a rename each; without ``keys`` the whole table is replaced. ``helpers`` are columns that rules need and the table does not.
    Blocked output is removed and :class:`BlockedByCheck` raised, with the table as it was.
    """
    spark = df.sparkSession
    base = path if "://" in path or path.startswith("file:") else os.path.abspath(path)
    head, _, name = base.rstrip("/").rpartition("/")
    staged = f"{base}/_staged-{uuid.uuid4().hex}" if keys else f"{head}/_staged-{name}-{uuid.uuid4().hex}"
    seen = Observation()
    counts = [F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, (_, cond) in rules.items()]
    laid = _rebalanced(df, keys) if keys else df
    laid.observe(seen, F.count(F.lit(1)).alias("__rows"), *counts).drop(*helpers).write.partitionBy(*keys).parquet(staged)
    # Keys come back as they were, not as the folder names would be read.
    found = [(name, severity, seen.get[name]) for name, (severity, _) in rules.items()]
    back = spark.read.schema(df.drop(*helpers).schema).parquet(staged)
    if unique:
        found.append((f"unique {', '.join(unique)}", BLOCK, unique_key(back, unique).first()["surplus"]))
    written = back.count()  # from the files' footers
    found.append(("rows written", BLOCK, abs(written - seen.get["__rows"])))
    report = spark.createDataFrame(found, "rule string, severity string, violations long")
    try:
        enforce(report)
    except BlockedByCheck:
        folders.drop(staged)
        raise
    if keys:
        for inner in _partitions(staged, len(keys)):
            folders.move(f"{staged}/{inner}", f"{base}/{inner}")
        folders.drop(staged)
    else:
        folders.move(staged, base)
    return report


def _partitions(root: str, depth: int) -> list[str]:
    """Paths below ``root`` of its partition folders, ``depth`` names deep."""
    found = [""]
    for _ in range(depth):
        found = [f"{a}/{b}".lstrip("/") for a in found for b in folders.names(f"{root}/{a}".rstrip("/")) if "=" in b]
    return found


def nested_json(df: DataFrame, outer: str, inner: str, value: str) -> DataFrame:
    """One JSON line per outer key: ``{"outer": {"inner": value, ...}}``.

    Meant for published series: an outer key has one entry per period.
    """
    inside = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(inner).cast("string"), F.col(value)))))
    per = df.groupBy(outer).agg(inside.alias("__m"))
    return per.select(F.to_json(F.map_from_arrays(F.array(F.col(outer).cast("string")), F.array("__m"))).alias("value"))


def write_nested_json(df: DataFrame, path: str, outer: str, inner: str, value: str) -> None:
    nested_json(df, outer, inner, value).write.mode("overwrite").text(path)


def append_log(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("append").format(fmt).save(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
