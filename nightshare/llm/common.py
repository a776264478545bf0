"""Shared helpers: tables of the shared folder, plain text keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightshare.session import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors, gives Spark real sizes."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is; null stays null."""
    return F.translate(text, UPPER, LOWER)


def hash_share(*parts: Column) -> Column:
    """A fixed number in [0, 1) from the hash of the parts."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """The rows of a stream sorted by ``keys`` as tables that end where a group ends."""
    held: list[pa.Table] = []
    for batch in batches:
        t = pa.table(batch)
        if not t.num_rows:
            continue
        differs = np.zeros(t.num_rows, bool)
        for c in keys:
            differs |= t[c].to_numpy() != t[c][t.num_rows - 1].as_py()
        cut = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
        if cut:
            yield pa.concat_tables([*held, t.slice(0, cut)]).combine_chunks()
            held = [t.slice(cut)]
        else:
            held.append(t)
    if held:
        yield pa.concat_tables(held).combine_chunks()


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it of a folder in the shared store (file, hdfs, s3, gs, abfs)."""
    return fs.FileSystem.from_uri(path)
