"""Captures and archives that keep arriving, on Structured Streaming with batch functions inside."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from nightshare.sources import folders
from nightshare.sources.writers import append_log, write_partition
from nightshare.streaming.archive import apply_batch, read_archive, read_changes, uri  # noqa: F401  (part of this module's interface)


#: A file name with a revision (``listings-v2.csv``) corrects the file of the same name without it or with a lower one.
REVISION = r"[-_.]v(\d+)(?=\.[^/]*$)"


def ingest_snapshots(
    source: DataFrame, clean: Callable[[DataFrame], DataFrame], target: str, checkpoint: str,
    keys: Sequence[str] = ("city", "snapshot_date"), revision: str = REVISION,
) -> StreamingQuery:
    """Clean each newly landed capture and write it below its partition.

    ``source`` is a streaming read of landed files, each of which belongs to one capture. Below a capture's partition a file has
    one of its own (``landed``, which ``clean`` has to keep), named by its path without the revision. So a late file adds to its
    capture, a corrected file replaces the one it supersedes, a revision that lands after a later one changes
    nothing, and a batch that is run again replaces what it wrote.
    """
    path = F.col("_metadata.file_path")

    def load(batch: DataFrame, epoch: int) -> None:
        spark, ledger = batch.sparkSession, f"{target}/_revisions"
        # A row per file, here and in the ledger.
        newest = batch.groupBy(F.col("landed").alias("__l")).agg(F.max("__revision").alias("__r"))
        if folders.names(uri(ledger)):
            known = spark.read.schema("landed string, revision int").parquet(ledger).groupBy("landed").agg(F.max("revision").alias("known"))
            newest = newest.join(known, F.col("__l") == F.col("landed"), "left").where("known is null or __r >= known").select("__l", "__r")
        kept = batch.join(newest, (F.col("landed") == F.col("__l")) & (F.col("__revision") == F.col("__r")), "left_semi")
        write_partition(clean(kept.drop("__revision")), target, [*keys, "landed"])
        append_log(newest.select(F.col("__l").alias("landed"), F.col("__r").alias("revision")), ledger)

    landed = source.withColumn("landed", F.md5(F.regexp_replace(path, revision, ""))).withColumn("__revision", F.coalesce(F.regexp_extract(path, revision, 1).try_cast("int"), F.lit(0)))
    return landed.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def archive_changes(
    source: DataFrame, root: str, checkpoint: str, key: str, watched: Sequence[str], day: str = "captured"
) -> StreamingQuery:
    """Keep a keyed archive and its change log up to date from captures that land as files.

    Archive and log are those of the set of captures that have landed, whatever batches they came in:
    captures that land again, late, out of order or under a new checkpoint change nothing else (see
    :mod:`nightshare.streaming.archive`). A batch that is run again finds itself in the commits.
    """

    def load(batch: DataFrame, epoch: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or hashlib.md5(checkpoint.encode()).hexdigest()
        apply_batch(batch, root, run.replace("-", ""), epoch, key, watched, day)

    return source.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def log_run(spark: SparkSession, path: str, **facts: Column | str | int) -> None:
    """One row per run."""
    append_log(spark.range(1).select(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in facts.items()]), path)
