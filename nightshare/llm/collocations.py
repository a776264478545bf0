"""Phrase collocations from stripes: each prefix keys an associative counter of the words that follow it.

Level k of the stripes counts phrases of k words: a task turns whole texts into flat word arrays, counts, and
gives one stripe per prefix of k - 1 words; stripes of one prefix are merged elementwise. A phrase can only
reach the least count if both its parts of k - 1 words do, so a level reads the texts with a bit filter of
the level before; the filter lets too much through at worst, so nothing is lost. From the stripes come the
counts of all phrases, the totals of the prefixes, and the largest count of any extension.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nightshare.llm import flat
from nightshare.llm.common import saved, whole_groups

LONGEST, LEAST, TOP, DROP_PERCENT, NO_LANG = 5, 100, 2000, 100, "und"
CLASSES = flat.byte_classes(blank=b" \t", breaks=b".,;:!?\n\x0b\x0c\r")
#: Bits of a filter at most (16 MB), and per phrase.
FILTER_BITS, BITS_EACH = 1 << 27, 16
#: A prefix with at least this share of a level's words is heavy: its stripe is cut in so many slices by the next word.
HEAVY_SHARE, SLICES = 1 / 512, 1024
#: Bytes of text counted together, so that stripes combine before they are sent.
CHUNK = 16 << 20
STRIPE = "lang string, prefix string, slice int, next array<string>, n array<long>"
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(distinct: pa.Array, seed: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in distinct.to_pylist()), np.uint64, len(distinct))


def chain(hashes: list[np.ndarray]) -> np.ndarray:
    """One number for a row of words."""
    out = hashes[0]
    for h in hashes[1:]:
        out = (out ^ (out >> np.uint64(29))) * _MULTIPLY + h
    return out ^ (out >> np.uint64(32))


def bit_places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places in a filter of ``bits`` (a power of two) bits."""
    return (hashes & np.uint64(bits - 1)).astype(np.int64), ((hashes * _MULTIPLY) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)


def bit_filter(phrases: DataFrame, count: int) -> np.ndarray:
    """Bits of the phrases (lang, phrase) as bytes; at most ``FILTER_BITS`` bits whatever the number of phrases."""
    bits = min(FILTER_BITS, 1 << max(15, (count * BITS_EACH).bit_length()))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, parts = batch.column(0).to_pylist(), [p.encode().split(b" ") for p in batch.column(1).to_pylist()]
            if not parts:
                continue
            seeds = [_seed(x) for x in langs]
            rows = [np.array([xxhash.xxh64_intdigest(p[i], s) for p, s in zip(parts, seeds)], np.uint64) for i in range(len(parts[0]))]
            places = np.concatenate(bit_places(chain(rows), bits))
            yield pa.RecordBatch.from_arrays([pa.array(places)], names=["place"])

    spots = phrases.select("lang", "phrase").mapInArrow(task, "place long")
    maps = spots.groupBy(F.expr("bitmap_bucket_number(place + 1)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place + 1))").alias("bitmap"))
    out = np.zeros(bits // 8, np.uint8)
    for bucket, bitmap in maps.collect():  # at most FILTER_BITS bits in all
        out[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(bitmap, np.uint8)[: max(0, len(out) - (bucket - 1) * 4096)]
    return out


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 42)


def _holds(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    hit = np.ones(len(hashes), bool)
    for place in bit_places(hashes, len(bitmap) * 8):
        hit &= (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return hit


def count_stripes(texts: DataFrame, k: int, bitmap: np.ndarray | None, heavy: set[tuple[str, str]]) -> DataFrame:
    """Stripes of phrases of ``k`` words from (lang, text); parts of one prefix come from many tasks."""
    spark = texts.sparkSession
    sent = spark.sparkContext.broadcast(bitmap)  # bounded by FILTER_BITS

    def stripes(lang: str, column: pa.Array) -> Iterator[pa.RecordBatch]:
        found, _, piece = flat.words(column, CLASSES)
        coded = found.dictionary_encode()
        word, distinct = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        at = np.arange(len(word))
        if k > 1:
            at = np.flatnonzero(piece[k - 1 :] == piece[: len(piece) - k + 1]) if len(piece) >= k else at[:0]
            h = word_hashes(distinct, _seed(lang))[word]
            at = at[_holds(sent.value, chain([h[at + i] for i in range(k - 1)]))]
            at = at[_holds(sent.value, chain([h[at + i] for i in range(1, k)]))]
        if not len(at):
            return
        # Prefixes get exact numbers, word by word; a stripe is a run of equal prefixes.
        prefix = np.zeros(len(at), np.int64)
        for i in range(k - 1):
            prefix = np.unique(prefix * len(distinct) + word[at + i], return_inverse=True)[1]
        key, first, n = np.unique(prefix * len(distinct) + word[at + k - 1], return_index=True, return_counts=True)
        owner, nxt, stands = key // len(distinct), key % len(distinct), at[first]
        begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        names = distinct.cast(pa.string())
        if k > 1:
            joined = pc.binary_join_element_wise(*[names.take(pa.array(word[stands[begins] + i])) for i in range(k - 1)], " ")
        else:
            joined = pa.array([""] * len(begins))
        cut = np.zeros(len(key), np.int64)
        weighty = np.isin(np.arange(len(begins)), [i for i, p in enumerate(joined.to_pylist()) if (lang, p) in heavy]) if heavy else np.zeros(len(begins), bool)
        if weighty.any():
            spread = weighty[np.cumsum(np.isin(np.arange(len(key)), begins)) - 1]
            cut[spread] = 1 + (word_hashes(names.take(pa.array(nxt[spread])).cast(pa.binary()), 7) % np.uint64(SLICES)).astype(np.int64)
            order = np.lexsort((cut, owner))
            owner, nxt, n, cut = owner[order], nxt[order], n[order], cut[order]
        bounds = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (cut[1:] != cut[:-1])]))
        ends = pa.array(np.append(bounds, len(owner)).astype(np.int32))
        of = np.unique(owner[bounds], return_inverse=True)[1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(bounds)),
                joined.take(pa.array(of)),
                pa.array(cut[bounds].astype(np.int32)),
                pa.ListArray.from_arrays(ends, names.take(pa.array(nxt))),
                pa.ListArray.from_arrays(ends, pa.array(n.astype(np.int64))),
            ],
            names=["lang", "prefix", "slice", "next", "n"],
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in flat.chunks(batch, "text", CHUNK):
                for lang in pc.unique(part.column(0)).to_pylist():
                    yield from stripes(lang, part.column(1).filter(pc.equal(part.column(0), lang)))

    return texts.mapInArrow(task, STRIPE)


def merge_stripes(parts: DataFrame, least: int) -> DataFrame:
    """Stripes of one prefix merged elementwise: total is the sum of all counts, of the words those stay that reach ``least``."""

    def merged(rows: pa.Table) -> pa.RecordBatch:
        of = rows.select(["lang", "prefix", "slice"])
        key = pa.table({"row": pc.list_parent_indices(rows["next"].combine_chunks()), "next": pc.list_flatten(rows["next"]), "n": pc.list_flatten(rows["n"])})
        first = np.ones(len(rows), bool)
        if len(rows) > 1:
            same = [pc.equal(of[c].slice(1), of[c].slice(0, len(rows) - 1)).to_numpy() for c in of.column_names]
            first[1:] = ~np.logical_and.reduce(same)
        group = np.cumsum(first) - 1
        key = key.set_column(0, "row", pa.array(group[key["row"].to_numpy()]))
        summed = key.group_by(["row", "next"], use_threads=False).aggregate([("n", "sum")])
        row, n = summed["row"].to_numpy(), summed["n_sum"].to_numpy()
        total = np.zeros(group[-1] + 1, np.int64)
        np.add.at(total, row, n)
        kept = np.flatnonzero(n >= least)
        kept = kept[np.argsort(row[kept], kind="stable")]
        ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[kept], minlength=len(total)))]).astype(np.int32))
        names = of.take(pa.array(np.flatnonzero(first))).combine_chunks()
        lists = [pa.ListArray.from_arrays(ends, _one(x)) for x in (summed["next"].take(pa.array(kept)), pa.chunked_array([pa.array(n[kept])]))]
        return pa.RecordBatch.from_arrays([*[_one(names[c]) for c in names.column_names], pa.array(total), *lists], names=["lang", "prefix", "slice", "total", "next", "n"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ("lang", "prefix", "slice")):
            yield merged(rows)

    dealt = parts.repartition("lang", "prefix", "slice").sortWithinPartitions("lang", "prefix", "slice")
    return dealt.mapInArrow(task, "lang string, prefix string, slice int, total long, next array<string>, n array<long>")


def _one(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def phrases_of(stripes: DataFrame) -> DataFrame:
    """(lang, phrase, f) of the words that a stripe holds."""
    pairs = stripes.select("lang", "prefix", F.explode(F.arrays_zip("next", "n")).alias("e"))
    return pairs.select("lang", F.when(F.col("prefix") == "", F.col("e.next")).otherwise(F.concat_ws(" ", "prefix", "e.next")).alias("phrase"), F.col("e.n").alias("f"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST, drop_percent: int = DROP_PERCENT) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words per language that score highest: lang, rank, phrase, a, l, r, n, score.

    ``docs`` has lang and text; other columns are not read. A phrase counts as often as its words stand next
    to each other within a piece, overlaps included; only A-Z are lower-cased. A null language is ``und``, as
    is a language of that name; null and empty texts have no words, a table without words gives no rows.
    Repeated rows count each time. Of equal scores the larger ``a``, then the smaller phrase in byte order
    goes first. Texts are read whole, whatever their length; a task holds ``CHUNK`` bytes of text or one longer text.
    """
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text").where("text is not null")
    levels: list[DataFrame] = []
    bitmap, heavy, words = None, set(), None
    for k in range(1, longest + 1):
        parts = count_stripes(texts, k, bitmap, heavy or set())
        # The one empty prefix of each language is heavy.
        parts = count_stripes(texts, k, bitmap, _Every() if k == 1 else heavy)
        levels.append(saved(merge_stripes(parts, least), f"stripes-{k}"))
        if k == 1:
            words = levels[0].groupBy("lang").agg(F.sum("total").alias("words"))
        found = saved(phrases_of(levels[-1]), f"phrases-{k}")
        count, occurrences = found.agg(F.count(F.lit(1)), F.sum("f")).first()
        if not count or k == longest:
            break
        # Fewer than 1 / HEAVY_SHARE phrases of a level can have that share of all its occurrences.
        heavy = {(x.lang, x.phrase) for x in found.where(F.col("f") >= HEAVY_SHARE * occurrences).select("lang", "phrase").collect()}
        bitmap = bit_filter(found, count)
    return rank_phrases(levels, words, least, top, drop_percent)


class _Every:
    """All prefixes are heavy."""

    def __contains__(self, key: tuple[str, str]) -> bool:
        return True


def rank_phrases(levels: list[DataFrame], words: DataFrame, least: int, top: int, drop_percent: int) -> DataFrame:
    """Scores, subsumption and ranks from the merged stripes."""
    counts = phrases_of(levels[0])
    for level in levels[1:]:
        counts = counts.unionByName(phrases_of(level))
    counts = saved(counts.withColumn("size", F.size(F.split("phrase", " ", -1))), "phrases")
    candidates = counts.where((F.col("size") > 1) & (F.col("f") >= least))
    # The largest count of a phrase that is longer by one word, on the right from its stripe, on the left from the stripes of
    # the longer ones. A still longer one has no larger count than one of these, which it contains, so these are enough.
    longer = candidates.where(F.col("size") > 2).select("lang", "f", F.explode(F.array(F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substr(phrase, instr(phrase, ' ') + 1)"))).alias("phrase"))
    largest = longer.groupBy("lang", "phrase").agg(F.max("f").alias("extended"))
    kept = candidates.join(largest, ["lang", "phrase"], "left").where(F.expr(f"extended is null or 100 * extended < {int(drop_percent)} * f"))
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.expr("transform(sequence(1, size - 1), k -> struct(k, substring_index(phrase, ' ', k) as head, substring_index(phrase, ' ', k - size) as tail))")).alias("cut"))
    known = counts.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), "f")
    ends = cuts.select("lang", "phrase", "a", "cut.*")
    ends = ends.join(known.withColumnRenamed("f", "l"), (F.col("lang") == F.col("of")) & (F.col("head") == F.col("part"))).drop("of", "part")
    ends = ends.join(known.withColumnRenamed("f", "r"), (F.col("lang") == F.col("of")) & (F.col("tail") == F.col("part"))).drop("of", "part")
    ends = ends.join(words.withColumnRenamed("words", "n"), "lang")
    exact = "cast(1000 * a as decimal(19, 0)) * cast(n as decimal(18, 0)) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))"
    scored = ends.withColumn("score", F.expr(exact))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("s")).select("lang", "phrase", "a", "s.l", "s.r", "n", "s.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocation_sql(least: int = LEAST, top: int = TOP, longest: int = LONGEST, drop_percent: int = DROP_PERCENT) -> str:
    """The same in DuckDB SQL."""
    rows = " UNION ALL ".join(f"SELECT lang, {k} AS size, w[i:i + {k - 1}] AS p FROM s, unnest(range(1, CAST(len(w) AS INTEGER) - {k - 2})) AS u(i)" for k in range(1, longest + 1))
    return f"""
WITH d AS (SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
s AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM d),
g AS ({rows}),
f AS (SELECT lang, size, p, CAST(count(*) AS BIGINT) AS f FROM g GROUP BY ALL HAVING count(*) >= {least}),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM s GROUP BY lang),
x AS (SELECT lang, p, max(f) AS f FROM (SELECT lang, f, p[1:size - 1] AS p FROM f WHERE size > 2 UNION ALL SELECT lang, f, p[2:size] FROM f WHERE size > 2) GROUP BY ALL),
c AS (SELECT f.* FROM f LEFT JOIN x ON f.lang = x.lang AND f.p = x.p WHERE size > 1 AND (x.f IS NULL OR 100 * x.f < {drop_percent} * f.f)),
k AS (SELECT c.lang, c.p, c.f AS a, k, h.f AS l, t.f AS r, n.n, CAST((CAST(1000 AS HUGEINT) * c.f * n.n) // (CAST(h.f AS HUGEINT) * t.f) AS BIGINT) AS score
  FROM c, unnest(range(1, c.size)) AS u(k) JOIN f h ON h.lang = c.lang AND h.p = c.p[1:k] JOIN f t ON t.lang = c.lang AND t.p = c.p[k + 1:c.size] JOIN n ON n.lang = c.lang),
b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
r AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM b)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM r QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= {top}
"""
