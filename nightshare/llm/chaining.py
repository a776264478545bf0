"""Substring dedup by collinear chaining: winnowed k-mer seeds, Fenwick-tree chains, aligned passages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nightshare.llm.common import saved, whole_groups
from nightshare.llm.simhash import mixed

K, WINDOW, MIN_WORDS, IDENTITY, GAP, PAD = 8, 20, 50, 0.8, 0.08, 40


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def grams_of(words: list[bytes], k: int) -> np.ndarray:
    """Hash of the k words at each position."""
    n = max(0, len(words) - k + 1)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    h = np.zeros(n, np.uint64)
    for i in range(k if n else 0):
        h = h * np.uint64(0x100000001B3) + w[i : i + n]
    return mixed(h, 1)


def pairs_of(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of each seed with the next one and their distance; the last seed has none."""
    both = h[:-1].view(np.uint64) * np.uint64(0x100000001B3) + h[1:].view(np.uint64)
    return mixed(both * np.uint64(0x100000001B3) + np.diff(at).astype(np.uint64), 2).view(np.int64)


def seeds_of(words: list[bytes], k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed k-mers: hash and position of the smallest hash of each run of ``window`` k-mers.

    Any run of k + window - 1 equal words holds an equal seed, wherever it stands.
    """
    h = grams_of(words, k)
    n = len(h)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    if n <= window:
        at = np.array([int(h.argmin())])
    else:
        runs = np.lib.stride_tricks.sliding_window_view(h, window)
        at = np.unique(np.concatenate([runs[i : i + 65536].argmin(axis=1) + i + np.arange(len(runs[i : i + 65536])) for i in range(0, len(runs), 65536)]))
    return h[at].astype(np.int64), at.astype(np.int32)


def _seed_rows(docs: DataFrame, id_col: str, text_col: str, k: int, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hs, ps, pairs, steps = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                h, p = seeds_of(words_of(text.as_py()), k, window)
                ids.append(np.full(len(h), i))
                hs.append(h)
                ps.append(p)
                pairs.append(np.r_[pairs_of(h, p), np.zeros(min(1, len(h)), np.int64)])
                steps.append(np.r_[np.diff(p), np.zeros(min(1, len(p)), np.int32)])
            if ids:
                step = np.concatenate(steps).astype(np.int32)
                columns = [pa.array(np.concatenate(hs)), batch.column(0).take(pa.array(np.concatenate(ids))), pa.array(np.concatenate(ps)), pa.array(np.concatenate(pairs), mask=step == 0), pa.array(step, mask=step == 0)]
                yield pa.RecordBatch.from_arrays(columns, names=["seed", "doc_id", "pos", "pair", "step"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).where("doc_id is not null").mapInArrow(run, "seed bigint, doc_id bigint, pos int, pair bigint, step int")


def _repeats(places: DataFrame, key: str, name: str) -> DataFrame:
    """(s, ref_id, ref_pos) of each key of ``places`` (key, doc_id, pos) that stands in several places, with its first one."""
    first = places.groupBy(key).agg(F.min(F.struct("doc_id", "pos")).alias("at"), F.count(F.lit(1)).alias("places")).where("places > 1")
    # Written, so that the join has plain shuffles on both sides and a frequent key's rows are split.
    return saved(first.select(F.col(key).alias("s"), F.col("at.doc_id").alias("ref_id"), F.col("at.pos").alias("ref_pos")), name)


def _uncovered(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (doc_id, lo, hi, ...) that do not lie inside one passage of ``found``."""
    spans = found.groupBy(F.col("doc_id").alias("_d")).agg(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end"))).alias("_spans"))
    inside = F.exists("_spans", lambda p: (p.start <= F.col("lo")) & (p.end >= F.col("hi")))
    return rows.join(saved(spans, "spans"), F.col("doc_id") == F.col("_d"), "left").where(~F.coalesce(inside, F.lit(False))).drop("_d", "_spans")


def _exact_rest(texts: DataFrame, seeds: DataFrame, found: DataFrame, k: int, min_words: int) -> DataFrame:
    """Runs of ``min_words`` or more equal words of an earlier place that ``found`` does not cover.

    Such a run holds two neighbouring seeds, in both places with the same distance. Of the pairs that
    stand in several places, those near words that are not covered are followed up: each run of
    ``min_words`` words around one of their places is matched with its own first occurrence.
    """
    pairs = seeds.where("pair is not null")
    first = _repeats(pairs, "pair", "pairs")
    later = pairs.join(first, F.col("pair") == F.col("s")).where("doc_id != ref_id or pos != ref_pos")
    around = later.select("pair", "doc_id", F.greatest(F.lit(0), F.col("pos") + F.col("step") + (k - min_words)).alias("lo"), (F.col("pos") + min_words).alias("hi"))
    asked = saved(_uncovered(around, found).select(F.col("pair").alias("s")).distinct(), "asked")
    places = pairs.join(asked, F.col("pair") == F.col("s"), "left_semi").groupBy(F.col("doc_id").alias("id")).agg(F.collect_set(F.struct("pos", "step")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, places, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h = grams_of(words_of(text), min_words)
                use = np.zeros(len(h), bool)
                for p in places:
                    use[max(0, p["pos"] + p["step"] + k - min_words) : p["pos"] + 1] = True
                at = np.flatnonzero(use)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(np.full(len(at), doc, np.int64)), pa.array(at.astype(np.int32))], names=["gram", "doc_id", "pos"])

    grams = saved(texts.join(places.hint("merge"), F.col("doc_id") == F.col("id")).select("id", "places", "text").mapInArrow(run, "gram bigint, doc_id bigint, pos int"), "grams")
    matches = grams.join(_repeats(grams, "gram", "first-grams"), F.col("gram") == F.col("s")).where("doc_id != ref_id or pos != ref_pos")
    matches = matches.select("doc_id", "ref_id", F.col("pos").cast("long").alias("lo"), (F.col("pos") + min_words).cast("long").alias("hi"), (F.col("pos") - F.col("ref_pos")).cast("long").alias("off"))
    rest = _uncovered(matches.distinct(), found)
    order = Window.partitionBy("doc_id", "ref_id", "off").orderBy("lo")
    runs = rest.withColumn("run", F.col("lo") - F.row_number().over(order)).groupBy("doc_id", "ref_id", "off", "run").agg(F.min("lo").alias("start"), F.max("hi").alias("end"))
    size = F.col("end") - F.col("start")
    return runs.select("doc_id", "ref_id", "start", size.alias("length"), (F.col("start") - F.col("off")).alias("ref_start"), size.alias("ref_length"), size.alias("equal_words"), F.lit(1.0).alias("identity"))


class Fenwick:
    """Prefix maxima of (score, index) over 1..n."""

    def __init__(self, n: int):
        self.best = [(0.0, -1)] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def upto(self, i: int) -> tuple[float, int]:
        found = (-1e18, -1)
        while i:
            if self.best[i][1] >= 0 and self.best[i] > found:
                found = self.best[i]
            i -= i & -i
        return found


def chains(x: np.ndarray, y: np.ndarray, k: int = K, gap: float = GAP) -> list[list[tuple[int, int]]]:
    """Disjoint best chains of matches (x, y), both rising, best first.

    A match adds k; a step costs ``gap`` per word passed on each side. The best predecessor of a
    match is a prefix maximum over y of score + gap * (x + y), held in a Fenwick tree.
    """
    order = np.lexsort((y, x))
    x, y = x[order].tolist(), y[order].tolist()
    rank = {v: i + 1 for i, v in enumerate(sorted(set(y)))}
    tree, score, back, i, n = Fenwick(len(rank)), [], [], 0, len(x)
    while i < n:
        j = i
        while j < n and x[j] == x[i]:  # equal x do not follow each other
            best, at = tree.upto(rank[y[j]] - 1)
            best -= gap * (x[j] + y[j])
            score.append(k + max(0.0, best))
            back.append(at if best > 0 else -1)
            j += 1
        for m in range(i, j):
            tree.put(rank[y[m]], (score[m] + gap * (x[m] + y[m]), m))
        i = j
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda m: (-score[m], m)):
        chain, at = [], i
        while at >= 0 and not used[at]:
            used[at] = True
            chain.append((x[at], y[at]))
            at = back[at]
        if chain:
            out.append(chain[::-1])
    return out


def _chain_rows(matches: DataFrame, k: int, gap: float, least: int) -> DataFrame:
    """Chains of at least ``least`` matches per pair of documents, with their anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ("doc_id", "ref_id")):
            d, r, x, y = (t[c].to_numpy() for c in ("doc_id", "ref_id", "pos", "ref_pos"))
            edges = np.r_[np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (r[1:] != r[:-1])]), len(d)]
            out = []
            for e in np.flatnonzero(np.diff(edges) >= least).tolist():
                lo, hi = int(edges[e]), int(edges[e + 1])
                out += [(int(d[lo]), int(r[lo]), [p for p, _ in c], [q for _, q in c]) for c in chains(x[lo:hi], y[lo:hi], k, gap) if len(c) >= least]
            if out:
                ids, refs, xs, ys = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(refs, pa.int64()), pa.array(xs, pa.list_(pa.int64())), pa.array(ys, pa.list_(pa.int64()))], names=["doc_id", "ref_id", "xs", "ys"])

    return matches.repartition("doc_id", "ref_id").sortWithinPartitions("doc_id", "ref_id", "pos", "ref_pos").mapInArrow(run, "doc_id bigint, ref_id bigint, xs array<bigint>, ys array<bigint>")


def _run(a: list[bytes], b: list[bytes], drop: int = 3) -> tuple[int, int]:
    """Words that go on alike, with single words that differ, as far as the score (equal 1, other -1) is highest: (words, equal ones)."""
    best, at, score, equal, kept = 0, 0, 0, 0, 0
    for i, (u, v) in enumerate(zip(a, b, strict=False)):
        score += 1 if u == v else -1
        equal += u == v
        if score > best:
            best, at, kept = score, i + 1, equal
        elif score < best - drop:
            break
    return at, kept


def align(a: list[bytes], b: list[bytes], anchors: list[tuple[int, int]], k: int = K, most: int = 10) -> list[tuple[int, int, int, int, int]]:
    """Passages along a chain: (a from, a to, b from, b to, equal words).

    Between anchors of one diagonal words are compared one by one. Where the diagonal changes, the
    equal words of the gap from its left and its right end are aligned and the rest counts as
    different. A gap with over ``most`` different words on a side splits the passage. Both ends
    go on while words are alike.
    """
    out, first = [], 0
    equal = [0]
    for i in range(1, len(anchors)):
        (x0, y0), (x1, y1) = anchors[i - 1], anchors[i]
        p, q = a[x0:x1], b[y0:y1]
        if len(p) == len(q):
            same = sum(u == v for u, v in zip(p, q, strict=True))
        else:
            short = min(len(p), len(q))
            head = next((n for n in range(short) if p[n] != q[n]), short)
            same = head + next((n for n in range(short - head) if p[-1 - n] != q[-1 - n]), short - head)
        if max(len(p), len(q)) - same > most:
            out.append((first, i - 1, sum(equal)))
            first, equal = i, [0]
        else:
            equal.append(same)
    out.append((first, len(anchors) - 1, sum(equal)))
    found = []
    for i, j, inner in out:
        (x0, y0), (x1, y1) = anchors[i], anchors[j]
        left, right = _run(a[:x0][::-1], b[:y0][::-1]), _run(a[x1 + k :], b[y1 + k :])
        found.append((x0 - left[0], x1 + k + right[0], y0 - left[0], y1 + k + right[0], inner + k + left[1] + right[1]))
    return found


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW, min_words: int = MIN_WORDS, identity: float = IDENTITY, gap: float = GAP, pad: int = PAD) -> DataFrame:
    """Passages of at least ``min_words`` words that stand in an earlier document too.

    Returns doc_id, ref_id, start, length, ref_start, ref_length (words), equal_words, identity.
    A seed is matched with its first occurrence only (smallest id, then position), so a seed in n
    documents gives n - 1 matches, never pairs of a group. Matches of two documents are chained
    with gap costs; chains are aligned on their words with ``pad`` words to each side, and kept at
    ``identity`` equal words or more. Exact repeats that this leaves, as their seeds first stand in
    several documents, are found by the first occurrences of their runs of ``min_words`` words: no
    run of so many equal words stays outside the passages. The first document of a passage
    appears as ref_id. Repeats inside one document count (ref_id = doc_id).

    Null and empty texts have no passages; rows with null id take no part; repeated rows with one
    id count as one document.
    Other columns are ignored. An empty table gives an empty result.
    """
    seeds = saved(_seed_rows(docs, id_col, text_col, k, window), "seeds")
    first = _repeats(seeds, "seed", "first")
    matches = seeds.join(first, F.col("seed") == F.col("s")).where("doc_id != ref_id or pos != ref_pos").select("doc_id", "ref_id", "pos", "ref_pos")
    # min_words equal words hold that many disjoint windows, each with a seed.
    least = max(1, (min_words - k + 1) // window)
    ends = {"x0": F.element_at("xs", 1), "x1": F.element_at("xs", -1) + k, "y0": F.element_at("ys", 1), "y1": F.element_at("ys", -1) + k}
    found = saved(_chain_rows(matches, k, gap, least).withColumns(ends), "chains")
    asked = found.select(F.explode(F.array(F.struct("doc_id", (F.col("x0") - pad).alias("lo"), (F.col("x1") + pad).alias("hi")), F.struct(F.col("ref_id").alias("doc_id"), (F.col("y0") - pad).alias("lo"), (F.col("y1") + pad).alias("hi")))).alias("a")).select(F.col("a.doc_id").alias("id"), "a.lo", "a.hi").distinct()
    asked = asked.groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, spans, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                out += [(i, s["lo"], s["hi"], b" ".join(words[max(0, s["lo"]) : max(0, s["hi"])])) for s in spans]
            if out:
                ids, lo, hi, cuts = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(cuts, pa.binary())], names=["id", "lo", "hi", "words"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Texts and spans both grow with the corpus: a sort-merge join at every size, which can spill.
    slices = texts.join(asked.hint("merge"), F.col("doc_id") == F.col("id")).select("id", "spans", "text").mapInArrow(cut, "id bigint, lo bigint, hi bigint, words binary")
    slices = saved(slices.groupBy("id", "lo", "hi").agg(F.first("words").alias("words")), "slices")
    left = slices.select(F.col("id").alias("doc_id"), (F.col("lo") + pad).alias("x0"), (F.col("hi") - pad).alias("x1"), F.col("words").alias("a"))
    right = slices.select(F.col("id").alias("ref_id"), (F.col("lo") + pad).alias("y0"), (F.col("hi") - pad).alias("y1"), F.col("words").alias("b"))

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for d, r, xs, ys, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at, to = max(0, xs[0] - pad), max(0, ys[0] - pad)
                for s, e, t, f, equal in align(a.split(), b.split(), [(x - at, y - to) for x, y in zip(xs, ys, strict=True)], k):
                    size = max(e - s, f - t)
                    if e - s >= min_words and equal >= identity * size:
                        out.append((d, r, at + s, e - s, to + t, f - t, equal, equal / size))
            if out:
                cols = [*zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:7]), pa.array(cols[7], pa.float64())], names=["doc_id", "ref_id", "start", "length", "ref_start", "ref_length", "equal_words", "identity"])

    direct = (
        found.join(left, ["doc_id", "x0", "x1"])
        .join(right, ["ref_id", "y0", "y1"])
        .select("doc_id", "ref_id", "xs", "ys", "a", "b")
        .mapInArrow(aligned, "doc_id bigint, ref_id bigint, start bigint, length bigint, ref_start bigint, ref_length bigint, equal_words bigint, identity double")
        .distinct()
    )
    direct = saved(direct, "direct")
    return direct.unionByName(_exact_rest(texts.where("doc_id is not null"), seeds, direct, k, min_words))


def without_passages(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each found passage cut out of its later document; the first document keeps it.

    Texts without a passage stay as they are, to the byte; of the others the words outside the
    passages stay with the white space that follows them.
    """
    from pyspark.sql.types import StructType

    spans = found.where("doc_id != ref_id or start >= ref_start + ref_length").groupBy(F.col("doc_id").alias("_d")).agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("_spans"))
    names, at = docs.columns, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans_ = batch.column(len(names)).to_pylist()
            texts = [remove_spans(t.as_py(), [(s["start"], s["end"]) for s in sp]) if sp else t.as_py() for t, sp in zip(batch.column(at), spans_, strict=True)]
            cols = list(batch.columns[: len(names)])
            cols[at] = pa.array(texts, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names[: len(names)])

    joined = docs.join(spans.hint("merge"), F.col(id_col).cast("long") == F.col("_d"), "left").drop("_d")
    return joined.mapInArrow(run, StructType(docs.schema.fields))


def remove_spans(text: str, spans: list[tuple[int, int]]) -> str:
    import re

    places = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text)]
    out, at = [], 0
    for start, end in spans:
        if end <= at:
            continue
        start = max(start, at)
        if start < len(places):
            lo = places[at][0] if at else 0
            out.append(text[lo : places[start][0]])
        at = min(end, len(places))
    if at < len(places):
        out.append(text[places[at][0] if at else 0 :])
    return "".join(out)
