"""Approximate nearest neighbours by pivot permutations: inverted files, footrule ranking, exact reranking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshare.llm.common import saved
from nightshare.llm.vectors import best_rows, checked, matrix, pivots, top, width

PIVOTS, NEAR, RERANK, BLOCK = 128, 64, 256, 2048


def positions(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """(pivots, rows): place of each pivot in each row's list of pivots by falling cosine; ties to the lower pivot."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    order = np.argsort(-(unit @ centres.T), axis=1, kind="stable")
    out = np.empty(order.shape, np.uint8)
    np.put_along_axis(out, order, np.arange(order.shape[1], dtype=np.uint8)[None].repeat(len(x), 0), axis=1)
    return np.ascontiguousarray(out.T)


def footrule(query: np.ndarray, posted: np.ndarray, near: int) -> np.ndarray:
    """Spearman's footrule of a query's ``near`` first pivots, from those pivots' inverted files only."""
    files = np.flatnonzero(query < near)
    return np.abs(posted[files].astype(np.int16) - query[files].astype(np.int16)[:, None]).sum(axis=0, dtype=np.int64)


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


def permutation_top(table: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", n_pivots: int = PIVOTS, near: int = NEAR, rerank: int = RERANK, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: about the k nearest rows by cosine of each query row.

    Pivots come from a bounded sample (``vectors.SAMPLE`` rows); every row is indexed. Rows are dealt by the
    hash of their id to blocks of about ``block`` rows; a block's inverted file holds, pivot by pivot,
    the place of that pivot in each row's permutation. A query reads the files of its ``near``
    nearest pivots, ranks the block's rows by footrule, and the best ``rerank`` of them (ties to smaller ids)
    are reranked by their exact cosine: an eighth of a full block. As blocks are random parts, a
    block's best eighth is about the whole table's. The queries meet all rows in blocks.

    ``is_query`` is a condition on vec_id. Zero vectors and those that ``checked`` drops take no part; an
    empty table gives no row. At most 255 pivots.
    """
    rows = checked(table, id_col, vec_col).where(F.exists("vec", lambda x: x != 0))
    rows = saved(rows, "vectors")
    dim, n = width(rows), rows.count()
    blocks = max(1, -(-n // block))
    centres = pivots(rows, dim, min(n_pivots, 255), unit=True, spread=False) if n else np.zeros((0, 0))

    def make(t: pa.Table) -> pa.Table:
        t = t.sort_by("vec_id")
        vec = t["vec"].combine_chunks()
        vec = pa.concat_arrays(vec.chunks) if isinstance(vec, pa.ChunkedArray) else vec
        x, ids, asks = matrix(vec, dim), t["vec_id"].to_numpy(), t["q"].to_numpy()
        x = x / np.abs(x).max(axis=1, keepdims=True) if np.abs(x).max() > 1e100 or np.abs(x).max(axis=1).min() < 1e-100 else x  # squares stay finite
        posted = positions(x, centres)
        values = (t["block"][0].as_py(), ids.tolist(), x.tobytes(), posted.tobytes(), ids[asks].tolist(), x[asks].tobytes(), np.ascontiguousarray(posted[:, asks].T).tobytes())
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary())
        return pa.table([pa.array([v], kind) for v, kind in zip(values, kinds, strict=True)], names=["block", "ids", "vecs", "posted", "q_ids", "q_vecs", "q_places"])

    schema = "block bigint, ids array<bigint>, vecs binary, posted binary, q_ids array<bigint>, q_vecs binary, q_places binary"
    dealt = rows.withColumn("q", is_query).withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.lit(blocks)))
    index = saved(dealt.groupBy("block").applyInArrow(make, schema), "permutation-index")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    packs = index.where(F.size("q_ids") > 0).select("q_ids", "q_vecs", "q_places", every)
    met = packs.join(index.select("block", "ids", "vecs", "posted"), "block").drop("block")

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_ids, q_vecs, q_places, ids, vecs, posted in zip(*batch.columns, strict=True):
                q_id, ids = np.array(q_ids.as_py()), np.array(ids.as_py())
                q, x = (np.frombuffer(v.as_py()).reshape(len(i), dim) for v, i in ((q_vecs, q_id), (vecs, ids)))
                places = np.frombuffer(q_places.as_py(), np.uint8).reshape(len(q_id), -1)
                files = np.frombuffer(posted.as_py(), np.uint8).reshape(-1, len(ids))
                out = []
                for i in range(len(q_id)):
                    at = best_rows(-footrule(places[i], files, near), ids, max(rerank, k + 1))
                    at = at[ids[at] != q_id[i]]
                    score = cosines(q[i], x[at])
                    out += [(int(q_id[i]), int(ids[at[j]]), float(score[j])) for j in best_rows(score, ids[at], k)]
                if out:
                    cols = [*zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())], names=["query_id", "vec_id", "score"])

    return top(met.mapInArrow(ranked, "query_id bigint, vec_id bigint, score double"), k)
