"""A keyed archive on disk: hash buckets, each a base and a few deltas, and commits that name what counts.

A batch writes the new state of the keys it touches, by bucket, as one delta. A bucket with ``MOST_DELTAS``
of them is rewritten as a new base in the same write. The commit is a single small file, so it is there
or not; what no commit of the last two names is removed. Untouched buckets are neither read nor written.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightshare.plans import archive as ar
from nightshare.sources import folders

BUCKETS, MOST_DELTAS = 32, 8


def uri(root: str) -> str:
    return root if "://" in root or root.startswith("file:") else os.path.abspath(root)


def commits(spark: SparkSession, root: str) -> list[dict]:
    """The commits that are left, oldest first: version, buckets, runs (last batch by run), live (versions by bucket)."""
    there = [n for n in folders.names(f"{uri(root)}/commits") if n.startswith("v")]
    if not there:
        return []
    # A folder without its file is an attempt that did not end; the reader skips what is not committed.
    rows = spark.read.text([f"{root}/commits/{n}" for n in there]).collect()  # a line a commit, two commits or three
    return sorted((json.loads(r.value) for r in rows), key=lambda c: c["version"])


def _live(spark: SparkSession, root: str, commit: dict, buckets: Sequence[int] | None = None) -> DataFrame | None:
    """State rows of the live files of the given buckets, newest version per key."""
    live = {int(b): v for b, v in commit["live"].items() if buckets is None or int(b) in set(buckets)}
    paths = [f"{root}/archive/version={v}/bucket={b}" for b, versions in live.items() for v in versions]
    if not paths:
        return None
    rows = spark.read.option("basePath", f"{root}/archive").schema(T.StructType.fromJson(commit["schema"])).parquet(*paths)
    fields = [c for c in rows.columns if c not in ("version", commit["key"])]
    if all(len(v) == 1 for v in live.values()):
        return rows.drop("version")
    # By the key alone, which settles the bucket: a join on the key needs no other shuffle. Versions of a key lie in different
    # files, so nothing is combined before the shuffle.
    newest = rows.repartition(F.col(commit["key"])).groupBy(commit["key"]).agg(F.max_by(F.struct(*fields), "version").alias("__row"))
    return newest.select(commit["key"], "__row.*")


def read_state(spark: SparkSession, root: str) -> DataFrame | None:
    """The archive with its ledger; None while nothing is committed."""
    found = commits(spark, root)
    rows = _live(spark, root, found[-1]) if found else None
    return None if rows is None else rows.drop("bucket")


def read_archive(spark: SparkSession, root: str) -> DataFrame | None:
    """Key, fields of the last capture, first_seen, last_seen and number of captures."""
    state = read_state(spark, root)
    return None if state is None else state.drop("counted", "steps")


def read_changes(spark: SparkSession, root: str) -> DataFrame | None:
    """Every change of a watched field between one capture of a key and its next."""
    found = commits(spark, root)
    rows = _live(spark, root, found[-1]) if found else None
    return None if rows is None else ar.change_log(rows, found[-1]["key"], found[-1]["watched"])


def apply_batch(batch: DataFrame, root: str, run: str, epoch: int, key: str, watched: Sequence[str], day: str, buckets: int = BUCKETS, most_deltas: int = MOST_DELTAS) -> None:
    """Bring the archive below ``root`` to the state after a batch; a batch that a commit names already changes nothing."""
    spark = batch.sparkSession
    found = commits(spark, root)
    last = found[-1] if found else {"version": -1, "buckets": buckets, "runs": {}, "live": {}}
    if epoch <= last["runs"].get(run, -1):
        return
    number, version = last["buckets"], last["version"] + 1
    fields = [c for c in batch.columns if c not in (key, day)]
    # The batch, one row a key, is written first: it is read for its buckets and for its rows.
    staged = f"{root}/staged/{run}_{epoch}"
    ar.keyed_captures(batch, key, watched, day).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(number)).cast("int")).write.mode("overwrite").parquet(staged)
    fresh = spark.read.parquet(staged)
    touched = sorted(r.bucket for r in fresh.select("bucket").distinct().collect())  # at most the number of buckets
    if not touched:
        folders.drop(f"{uri(root)}/staged/{run}_{epoch}")
        return
    before = _live(spark, root, last, touched) if last["live"] else None
    after = ar.advance(None if before is None else before.drop("bucket"), fresh.drop("bucket"), key, watched, fields).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(number)).cast("int"))
    full = [b for b in touched if len(last["live"].get(str(b), [])) >= most_deltas]
    if full:
        others = before.where(F.col("bucket").isin(full)).join(fresh.select(F.col(key).alias("__k")), F.col(key) == F.col("__k"), "left_anti")
        after = after.unionByName(others)
    after.hint("rebalance", F.col("bucket")).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{root}/archive/version={version}")
    live = dict(last["live"]) | {str(b): [version] if b in full else [*last["live"].get(str(b), []), version] for b in touched}
    commit = {"version": version, "buckets": number, "runs": last["runs"] | {run: epoch}, "live": live, "key": key, "watched": list(watched), "schema": after.withColumn("version", F.lit(0)).schema.jsonValue()}
    spark.createDataFrame([(json.dumps(commit),)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/commits/v{version:09d}")
    _sweep(root, [*found[-1:], commit])
    folders.drop(f"{uri(root)}/staged/{run}_{epoch}")


def _sweep(root: str, kept: list[dict]) -> None:
    """Remove bucket folders and commits that none of the kept commits needs."""
    base = uri(root)
    needed = {(v, int(b)) for c in kept for b, versions in c["live"].items() for v in versions}
    newest = max(c["version"] for c in kept)
    for name in folders.names(f"{base}/archive"):
        v = int(name.removeprefix("version=")) if name.startswith("version=") else newest + 1
        if v > newest:
            continue
        mine = {b for w, b in needed if w == v}
        if not mine:
            folders.drop(f"{base}/archive/{name}")
            continue
        for part in folders.names(f"{base}/archive/{name}"):
            if part.startswith("bucket=") and int(part.removeprefix("bucket=")) not in mine:
                folders.drop(f"{base}/archive/{name}/{part}")
    for name in folders.names(f"{base}/commits"):
        if name.startswith("v") and int(name[1:]) < min(c["version"] for c in kept):
            folders.drop(f"{base}/commits/{name}")
