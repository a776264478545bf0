"""Exact top-k inner products over a pivot-distance index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshare.llm.common import saved
from nightshare.llm.vectors import best_rows, blocks_of, checked, matrix, pivots, top, width

PIVOTS, BLOCK, SCALE, EXACT = 32, 1024, 256.0, float(1 << 53)


def coded(x: np.ndarray, scale: float = SCALE) -> np.ndarray:
    """floor(scale * component); codes beyond 2**53 are held there."""
    with np.errstate(over="ignore"):
        return np.floor(np.clip(x * scale, -EXACT, EXACT))


def packed(x: np.ndarray) -> bytes:
    return x.astype("<i4" if not x.size or np.abs(x).max() < 2**31 else "<f8").tobytes()


def unpacked(data: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, "<f8" if len(data) == 8 * rows * dim else "<i4").reshape(rows, dim).astype(float)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond 2**53 by whole numbers, held at the bounds of a long."""
    if not q.size or not x.size or np.abs(q).max() * np.abs(x).max() * q.shape[1] < EXACT:
        return (q @ x.T).astype(np.int64)
    whole = lambda a: np.array([[int(v) for v in row] for row in a], dtype=object)
    return np.clip(whole(q) @ whole(x).T, -(2**63), 2**63 - 1).astype(np.int64)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x**2).sum(1)[:, None] + (y**2).sum(1)[None] - 2 * x @ y.T, 0))


def exact_top(table: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = SCALE, n_pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each query row over all other rows.

    Vectors are keyed by nearest pivot and distance to it, sorted, and cut into blocks: slices of an
    annulus. In its own slice each query finds k scores to beat. A product is half of
    |q|^2 + |x|^2 - d(q, x)^2, and d is at least |d(q, pivot) - d(x, pivot)|; so a slice whose distances
    lie too far from the query's to reach the score to beat is left out, first for all queries of a
    slice together (a join on the pivot), then query by query. Queries are met with rows in blocks.
    How much is left out depends on the vectors: without any structure little is.

    ``is_query`` is a condition on vec_id. Vectors take part as said in ``checked``; ties go to smaller
    ids; all candidates are returned where there are fewer than k; an empty table gives no row.
    """
    rows = saved(checked(table, id_col, vec_col), "vectors")
    dim = width(rows)
    centres = pivots(rows, dim, n_pivots) if dim else np.zeros((0, 0))
    if not len(centres):  # no vector, or vectors without components: every product is 0
        centres, dim = np.zeros((1, max(1, dim))), max(1, dim)
    centres = coded(centres, scale)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = coded(matrix(batch.column(1), dim), scale)
            d = distances(x, centres)
            near = d.argmin(axis=1)
            codes = pa.array([packed(row) for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), codes, pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(x)), near])], names=["vec_id", "q", "codes", "pivot", "dist"])

    def make(t: pa.Table, number: int) -> pa.RecordBatch:
        ids, asks = t["vec_id"].to_numpy(), t["q"].to_numpy()
        x = np.stack([unpacked(c, 1, dim)[0] for c in t["codes"].to_pylist()])
        pivot, d, norms = t["pivot"].to_numpy(), t["dist"].to_numpy(), (x**2).sum(1)
        # A slice may run over the end of a pivot's rows: one range per pivot it holds.
        ranges = [{"pivot": int(p), "lo": float(d[pivot == p].min()), "hi": float(d[pivot == p].max()), "norm": float(norms[pivot == p].max())} for p in np.unique(pivot)]
        q, q_ids = x[asks], ids[asks]
        beat = np.full(len(q), -np.inf)
        if len(q) and len(x) > k:
            s = products(q, x).astype(float)
            s[q_ids[:, None] == ids[None]] = -np.inf
            beat = np.partition(s, len(x) - k, axis=1)[:, len(x) - k]
        to = distances(q, centres) if len(q) else np.zeros((0, len(centres)))
        room = (q**2).sum(1) - 2 * beat
        asked = [{"pivot": p, "lo": float(to[:, p].min()), "hi": float(to[:, p].max())} for p in range(len(centres))] if len(q) else []
        values = (number, len(ids), ids.tolist(), packed(x), ranges, q_ids.tolist(), packed(q), beat.tolist(), asked, float(room.max()) if len(q) else -np.inf)
        return pa.RecordBatch.from_arrays([pa.array([v], t_) for v, t_ in zip(values, types, strict=True)], names=names)

    span = lambda *f: pa.list_(pa.struct([("pivot", pa.int32()), *((n, pa.float64()) for n in f)]))
    names = ["block", "n", "ids", "codes", "ranges", "q_ids", "q_codes", "beat", "asked", "room"]
    types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), span("lo", "hi", "norm"), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.float64()), span("lo", "hi"), pa.float64()]
    schema = "block bigint, n int, ids array<bigint>, codes binary, ranges array<struct<pivot:int,lo:double,hi:double,norm:double>>, q_ids array<bigint>, q_codes binary, beat array<double>, asked array<struct<pivot:int,lo:double,hi:double>>, room double"
    index = rows.withColumn("q", is_query).select("vec_id", "vec", "q").mapInArrow(keyed, "vec_id bigint, q boolean, codes binary, pivot int, dist double")
    index = blocks_of(index, ["pivot", "dist", "vec_id"], block, make, schema, "pivot-index")

    slices = index.select("block", F.inline("ranges"))
    packs = index.where(F.size("q_ids") > 0).select(F.col("block").alias("pack"), "room", F.inline("asked")).select("pack", "room", F.col("pivot").alias("p"), F.col("lo").alias("q_lo"), F.col("hi").alias("q_hi"))
    apart = F.greatest(F.lit(0.0), F.col("q_lo") - F.col("hi"), F.col("lo") - F.col("q_hi"))
    reach = apart * apart <= (F.col("room") + F.col("norm")) * (1 + 1e-9) + 1e-3
    pairs = packs.join(slices, (F.col("p") == F.col("pivot")) & reach).select("pack", "block").distinct()
    asks = index.select(F.col("block").alias("pack"), "q_ids", "q_codes", "beat")
    met = pairs.join(asks, "pack").join(index.select("block", "n", "ids", "codes", "ranges"), "block").select("q_ids", "q_codes", "beat", "n", "ids", "codes", "ranges")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_ids, q_codes, beat, n, ids, codes, ranges in zip(*batch.columns, strict=True):
                q_id, ids, beat = np.array(q_ids.as_py()), np.array(ids.as_py()), np.array(beat.as_py())
                q, x = unpacked(q_codes.as_py(), len(q_id), dim), unpacked(codes.as_py(), n.as_py(), dim)
                to, own, may = distances(q, centres), (q**2).sum(1), np.zeros(len(q), bool)
                for r in ranges.as_py():
                    gap = np.maximum(0, np.maximum(to[:, r["pivot"]] - r["hi"], r["lo"] - to[:, r["pivot"]]))
                    may |= gap**2 <= (own + r["norm"] - 2 * beat) * (1 + 1e-9) + 1e-3
                out = []
                if may.any():
                    s = products(q[may], x)
                    for i, row in zip(np.flatnonzero(may), s, strict=True):
                        ok = np.flatnonzero((row >= beat[i]) & (ids != q_id[i]))
                        at = ok[best_rows(row[ok], ids[ok], k)]
                        out += [(int(q_id[i]), int(ids[j]), int(row[j])) for j in at]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["query_id", "vec_id", "score"])

    return top(met.mapInArrow(scored, "query_id bigint, vec_id bigint, score bigint"), k)
