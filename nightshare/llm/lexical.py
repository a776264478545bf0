"""Ranked lexical search over per-term posting lists, blocked geometrically, with exact summary bounds.

The documents are read once per pack of items: a task finds the terms of whole texts and keeps, per
document, its length and its counts of the pack's terms. From the written table come the corpus counts.
Search reads that table in shards. In a shard every posting list is cut into blocks of documents that
lie near the same pivot document, and each block holds, coordinate by coordinate, the largest weight
that any of its documents has. A query goes through the lists of its essential terms: those without
which a document cannot reach the tenth best score so far. It skips a block only if the sum of the
block's summary over the query's terms stays below that score, and scores the documents of the others.
Each task gives its best documents per item; a ranking window takes the best of all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightshare.llm import flat
from nightshare.llm.common import saved

#: Documents of a block about, cells of a shard's weights and of its summaries, bytes of item texts in a pack about.
BLOCK, CELLS, SUMMARY_CELLS, PACK = 64, 8 << 20, 24 << 20, 64 << 10
#: Summaries hold weights in such steps, rounded up, so that 32 bits do for any weight.
GRAIN = 64
#: Documents a query takes at once, best blocks first, so that its bar rises early.
STEP = 256
TERMS = flat.byte_classes(blank=bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
LAST = np.iinfo(np.int64).max


def item_terms(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(row, term) of every term of every text."""
    found, row, _ = flat.words(column, TERMS)
    return row, found


def count_terms(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """Per document with at least one term: doc_id, n, and the numbers and counts of the given terms in it."""
    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType()))]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(terms, pa.binary())
        for batch in batches:
            for part in flat.chunks(batch, "text"):
                row, found = item_terms(part.column(1))
                n = np.bincount(row, minlength=len(part))
                number = pc.fill_null(pc.index_in(found, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                hit = number >= 0
                keys, counts = np.unique(row[hit] * len(terms) + number[hit], return_counts=True)
                held = np.bincount(keys // max(1, len(terms)), minlength=len(part))
                bounds = pa.array(np.concatenate([[0], np.cumsum(held)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in (keys % max(1, len(terms)), counts)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), *lists], names=schema.names).filter(pa.array(n > 0))

    return docs.select("doc_id", "text").mapInArrow(task, schema)


class Shard:
    """The documents of a shard with their weights, and the posting lists in blocks with summaries.

    Lists that no longer fit ``SUMMARY_CELLS`` have no summary; their documents are always looked at.
    """

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        has = weights > 0
        self.top = weights.max(axis=0)
        norm = np.sqrt((weights.astype(np.float64) ** 2).sum(axis=1))
        unit = weights / np.maximum(norm, 1)[:, None]
        pivots = np.arange(0, len(weights), BLOCK)
        near = unit @ unit[pivots].T
        coarse = (-(-weights // GRAIN)).astype(np.int32)
        lists = np.split(np.nonzero(has.T)[1], np.cumsum(has.sum(axis=0))[:-1])
        self.members: list[np.ndarray] = []
        self.summaries, held = np.zeros((max(1, SUMMARY_CELLS // weights.shape[1]), weights.shape[1]), np.int32), 0
        self.first, row_of = [0], []
        for t, rows in enumerate(lists):
            cuts = np.zeros(0, np.int64)
            if len(rows) > BLOCK:
                # Of the pivots that hold the term as many as the list has blocks; a document goes to the nearest.
                own = np.flatnonzero(has[pivots, t])[: -(-len(rows) // BLOCK)]
                which = own[near[np.ix_(rows, own)].argmax(axis=1)] if len(own) else np.arange(len(rows)) // BLOCK
                turn = np.argsort(which, kind="stable")
                rows, cuts = rows[turn], np.flatnonzero(np.diff(which[turn])) + 1
            self.members += np.split(rows, cuts)
            n = len(cuts) + 1
            if held + n <= len(self.summaries):
                np.maximum.reduceat(coarse[rows], np.concatenate([[0], cuts]), axis=0, out=self.summaries[held : held + n])
                row_of += range(held, held + n)
                held += n
            else:
                row_of += [-1] * n
            self.first.append(len(self.members))
        self.first, self.row_of = np.array(self.first), np.array(row_of)

    def bounds(self, blocks: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """No document of the block has a higher score."""
        rows = self.row_of[blocks]
        return np.where(rows >= 0, self.summaries[np.ix_(rows, terms)].sum(axis=1, dtype=np.int64) * GRAIN, LAST)

    def search(self, terms: np.ndarray, best: tuple[np.ndarray, np.ndarray], ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (score, id) of ``best`` and of this shard's documents; equal scores by ascending id."""
        bar = best[0][-1] if len(best[0]) == k else 1
        order = terms[np.argsort(-self.top[terms], kind="stable")]
        # What the terms from here on can give together: below the bar, documents without the terms before are out.
        left = np.cumsum(self.top[order][::-1])[::-1]
        essential = order[left >= bar]
        at = np.concatenate([np.arange(self.first[t], self.first[t + 1]) for t in essential]) if len(essential) else np.zeros(0, np.int64)
        bounds = self.bounds(at, terms)
        at = at[bounds >= bar]
        bounds = bounds[bounds >= bar]
        turn = np.argsort(-bounds, kind="stable")
        at, bounds = at[turn], bounds[turn]
        met = np.zeros(len(self.weights), bool)
        while len(at):
            upto = max(1, int(np.searchsorted(np.cumsum([len(self.members[b]) for b in at[:STEP]]), STEP, side="right")))
            rows = np.unique(np.concatenate([self.members[b] for b in at[:upto]]))
            rows = rows[~met[rows]]
            met[rows] = True
            scores = self.weights[np.ix_(rows, terms)].sum(axis=1)
            rows, scores = rows[scores >= bar], scores[scores >= bar]
            if len(rows):
                best = top_of(np.concatenate([best[0], scores]), np.concatenate([best[1], ids[rows]]), k)
                bar = best[0][-1] if len(best[0]) == k else 1
            at, bounds = at[upto:], bounds[upto:]
            at, bounds = at[bounds >= bar], bounds[bounds >= bar]
        return best


def top_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def search(table: DataFrame, queries: list[tuple], weights: list[int], documents: int, length: int, k: int) -> DataFrame:
    """Rows item, doc_id, score: the best of each task per item. ``queries`` are (item, term numbers)."""
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    asked = [np.array(sorted(terms), np.int64) for _, terms in queries]
    weight = np.array(weights, np.int64)

    size = max(BLOCK, min(2048, CELLS // max(1, len(weights))))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            while sum(map(len, held)) >= size:
                rows = pa.Table.from_batches(held)
                yield rows.slice(0, size)
                held = rows.slice(size).to_batches()
        if sum(map(len, held)):
            yield pa.Table.from_batches(held)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in asked]
        for rows in shards(batches):
            rows = rows.combine_chunks()
            long = 10 + (90 * rows["n"].to_numpy() * documents) // length
            row = np.repeat(np.arange(len(rows)), pc.list_value_length(rows["terms"]).to_numpy())
            number, count = (pc.list_flatten(rows[c]).to_numpy().astype(np.int64) for c in ("terms", "counts"))
            part = weight[number] * ((1_000_000_000 * count) // (1000 * count + 8 * long[row]))
            row, number, part = row[part > 0], number[part > 0], part[part > 0]
            if not len(row):
                continue
            # Only columns of terms that stand in the shard.
            own, column = np.unique(number, return_inverse=True)
            matrix = np.zeros((len(rows), len(own)), np.int64)
            matrix[row, column] = part
            ids = pc.fill_null(rows["doc_id"], LAST).to_numpy()
            place = np.full(len(weight), -1)
            place[own] = np.arange(len(own))
            shard = Shard(matrix)
            best = [shard.search(mine, b, ids, k) if len(mine := place[terms][place[terms] >= 0]) else b for terms, b in zip(asked, best)]
        item = np.repeat(np.arange(len(best)), [len(s) for s, _ in best]).astype(np.int32)
        if len(item):
            scores, ids = (np.concatenate([b[i] for b in best]) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=ids == LAST), pa.array(scores)], names=schema.names)

    return table.mapInArrow(task, schema)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` documents of highest score above 0 per item: item_id, rank, doc_id, score.

    ``docs`` has doc_id (a whole number) and text, ``items`` item_id and text; other columns are not read.
    Terms are runs of ASCII letters, digits and all letters beyond ASCII, A-Z in lower case, of the
    whole text; null and empty texts have none. Rows of one item_id (also a null one) are one item with
    the terms of all of them. Each row of documents counts by itself, so repeated rows rank side by side;
    a null doc_id comes last among equal scores. Items without a term in any document have no rows, nor has
    an empty table. Items are taken in packs of about ``PACK`` bytes of text, each against all documents,
    so what a task holds of them stays bounded; a pack's terms, item ids and counts go over the driver.
    """
    spark = docs.sparkSession
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    packs = -(-size // PACK)
    results = []
    for pack in range(packs):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(packs)) == pack).select("item_id", "text").where("text is not null")
        rows = own.toArrow().combine_chunks()
        if not len(rows):
            continue
        row, found = item_terms(pa.concat_arrays(rows["text"].chunks))
        distinct = found.dictionary_encode()
        terms = distinct.dictionary.to_pylist()
        if not terms:
            continue
        of: dict = {}
        names = rows["item_id"].to_pylist()
        for r, t in zip(row.tolist(), distinct.indices.to_pylist()):
            of.setdefault(names[r], set()).add(t)
        table = saved(count_terms(docs, terms), "term-counts")
        documents, length = table.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not documents:
            continue
        holding = dict(table.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        weights = [term_weight(documents, holding.get(t, 0)) for t in range(len(terms))]
        queries = list(of.items())
        found_rows = search(table, queries, weights, documents, length, k)
        numbered = spark.createDataFrame([(i, q) for i, (q, _) in enumerate(queries)], T.StructType([T.StructField("item", T.IntegerType()), items.schema["item_id"]]))
        results.append(found_rows.join(numbered, "item").select("item", "item_id", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], T.StructType([items.schema["item_id"], T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    every = results[0]
    for more in results[1:]:
        every = every.unionByName(more)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


#: The same in DuckDB SQL.
LEXICAL_SQL = """
WITH d AS (SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
w AS (SELECT row, unnest(terms) AS term FROM d),
f AS (SELECT row, term, count(*) AS tf FROM w GROUP BY ALL),
l AS (SELECT row, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM l),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
t AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM f, c GROUP BY term, docs),
p AS (SELECT f.row, f.term, doc_id, weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))) AS part FROM f JOIN l USING (row) JOIN t USING (term), c),
s AS (SELECT item_id, doc_id, row, CAST(sum(part) AS BIGINT) AS score FROM q JOIN p USING (term) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10
"""
