"""What the vector indexes share: checked vectors, pivots from a bounded sample, blocks of fixed size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nightshare.llm.common import saved

SAMPLE = 4096


def checked(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec): one row per id. Rows with a null id, a null vector or a null or non-finite component leave.

    Of several vectors of one id the smallest in array order stays; shorter vectors count as
    filled up with zeros.
    """
    vec = F.col(vec_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).where("vec_id is not null and vec is not null")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite)
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def width(rows: DataFrame) -> int:
    return rows.agg(F.max(F.size("vec"))).first()[0] or 0


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy() - column.offsets[0].as_py()
    sizes = np.diff(offsets)
    if (sizes == dim).all():
        return flat.reshape(-1, dim).astype(float)
    out = np.zeros((len(sizes), dim))
    for i, (a, n) in enumerate(zip(offsets, sizes, strict=False)):
        out[i, :n] = flat[a : a + n]
    return out


def pivots(rows: DataFrame, dim: int, count: int, sample: int = SAMPLE, unit: bool = False, spread: bool = True) -> np.ndarray:
    """``count`` pivots at most from a sample of ``sample`` rows (by hash of the id): each next one farthest from the others, or just any."""
    held = rows.orderBy(F.xxhash64(F.lit("pivot"), "vec_id"), "vec_id").limit(sample).select("vec").toArrow()["vec"].combine_chunks()
    held = pa.concat_arrays(held.chunks) if isinstance(held, pa.ChunkedArray) else held
    if not len(held):
        return np.zeros((0, dim))
    x = np.unique(matrix(held, dim), axis=0)
    if unit:
        norms = np.linalg.norm(x, axis=1, keepdims=True)
        x = np.unique(x[norms[:, 0] > 0] / norms[norms[:, 0] > 0], axis=0)
    if not len(x):
        return np.zeros((0, dim))
    if not spread:
        return x[np.random.default_rng(len(x)).permutation(len(x))[:count]]
    chosen, far = [0], np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < min(count, len(x)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(x - x[chosen[-1]], axis=1))
    return x[chosen]


def top(rows: DataFrame, k: int) -> DataFrame:
    """The k best (query_id, vec_id, score) of each query, ties to smaller ids; partial tops are cut before the shuffle."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def best_rows(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(score) > 4 * k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= edge)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))[:k]]


def blocks_of(keyed: DataFrame, order: list[str], size: int, make, schema: str, name: str) -> DataFrame:
    """Sort rows by ``order`` over range partitions and turn runs of ``size`` rows into one row by ``make`` (rows, block number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, block = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= size:
                t = pa.Table.from_batches(held).combine_chunks()
                yield make(t.slice(0, size), block)
                held, n, block = t.slice(size).to_batches(), n - size, block + 1
        if n:
            yield make(pa.Table.from_batches(held), block)

    return saved(keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema), name)
