"""Quality classifier by hierarchical empirical Bayes: text evidence, shrunk host and path posteriors."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshare.llm.common import saved

BUCKETS, SHAPES, SAMPLE = 1 << 18, 12, 12_000
STEMS = (4, 6)
_BREAKS = bytes.maketrans(b".,;:!?\"'()#$%&*", b" " * 15)
_UPPER, _LOWER, _DIGIT = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
_PLAIN, _SIGNS = b",.;:'\"-()", b"#$%&*@|<>{}[]^~=+_/\\"


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Shape figures of a whole text, and the hashed words and word beginnings that occur in it.

    Beginnings (of ``STEMS`` bytes) tell inflected forms of a word that the sample does not hold.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    parts = raw.split()
    n, w = max(1, len(raw)), max(1, len(parts))
    share = [(len(raw) - len(raw.translate(None, kind))) / n for kind in (_UPPER, _LOWER, _DIGIT, _PLAIN, _SIGNS, b"!?")]
    lines = [x for x in raw.split(b"\n") if x.strip()]
    words = set(parts)
    shape = np.array([*share, np.log1p(len(parts)), n / w / 10, len(words) / w, len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)), raw.count(b" | ") / w])
    plain = set(raw.lower().translate(_BREAKS).split())
    kept = {zlib.crc32(x) & (BUCKETS - 1) for x in plain}
    for size in STEMS:
        kept.update(zlib.crc32(x, size) & (BUCKETS - 1) for x in {x[:size] for x in plain if len(x) > size})
    return shape, np.fromiter(kept, np.int32, len(kept))


def sample_of(labels: DataFrame, id_col: str, size: int) -> DataFrame:
    """``size`` labelled rows at most, by the hash of the id: a bound that is a parameter."""
    return labels.orderBy(F.xxhash64(id_col), *labels.columns).limit(size)


class Model:
    """Logistic regression over shape figures and hashed words, fitted on a bounded sample in the driver."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, shape: np.ndarray, word: np.ndarray, bias: float, prior: float):
        self.mean, self.scale, self.shape, self.word, self.bias, self.prior = mean, scale, shape, word, bias, prior

    @classmethod
    def fit(cls, shapes: np.ndarray, words: list[np.ndarray], good: np.ndarray, rounds: int = 300, rate: float = 0.5, ridge: float = 1e-4) -> Model:
        if not len(good) or good.min() == good.max():  # nothing to tell apart: every text gets the one class seen, or a half
            prior = float(good.mean()) if len(good) else 0.5
            prior = min(max(prior, 1e-3), 1 - 1e-3)
            return cls(np.zeros(SHAPES), np.ones(SHAPES), np.zeros(SHAPES), np.zeros(BUCKETS, np.float32), float(np.log(prior / (1 - prior))), prior)
        mean, scale = shapes.mean(0), shapes.std(0) + 1e-6
        x = np.clip((shapes - mean) / scale, -8, 8)
        sizes = np.array([len(w) for w in words])
        row, col = np.repeat(np.arange(len(words), dtype=np.int32), sizes), np.concatenate(words)
        seen = np.bincount(col, minlength=BUCKETS)
        use = (seen[col] >= 3) & (seen[col] <= 0.2 * len(words) + 3)  # words of nearly all or of single texts tell nothing
        row, col = row[use], col[use]
        # The entries by row and by word, so that sums are sums of runs.
        held, at_row = np.unique(row, return_index=True)
        kinds, col = np.unique(col, return_inverse=True)
        row_of, order = row[np.argsort(col, kind="stable")], np.sort(col)
        at_col = np.flatnonzero(np.r_[True, order[1:] != order[:-1]]) if len(order) else order
        n = len(good)
        a, b, c = np.zeros(SHAPES), np.zeros(len(kinds)), 0.0
        ga, gb, gc = np.full(SHAPES, 1e-6), np.full(len(kinds), 1e-6), 1e-6
        for _ in range(rounds):  # full gradients, steps scaled by their own history
            z = x @ a + c
            if len(col):
                z[held] += np.add.reduceat(b[col], at_row)
            e = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - good
            da, dc = x.T @ e / n + ridge * a, e.mean()
            db = (np.add.reduceat(e[row_of], at_col) / n if len(col) else b) + ridge * b
            ga, gb, gc = ga + da**2, gb + db**2, gc + dc**2
            a, b, c = a - rate * da / np.sqrt(ga), b - rate * db / np.sqrt(gb), c - rate * dc / np.sqrt(gc)
        word = np.zeros(BUCKETS, np.float32)
        word[kinds] = b
        prior = float(np.clip(good.mean(), 1e-3, 1 - 1e-3))
        return cls(mean, scale, a, word, c, prior)

    def logit(self, text: str | None) -> float:
        shape, words = features(text)
        z = np.clip((shape - self.mean) / self.scale, -8, 8) @ self.shape + float(self.word[words].sum()) + self.bias
        return float(np.clip(z, -12, 12))


def fit(docs: DataFrame, labels: DataFrame, good: Column, id_col: str = "doc_id", text_col: str = "text", size: int = SAMPLE) -> Model:
    """Fit on at most ``size`` labelled rows; their ids (a bounded list) are broadcast, so no text is shuffled."""
    chosen = saved(sample_of(labels.where(F.col(id_col).isNotNull() & good.isNotNull()).select(F.col(id_col).alias("_id"), good.cast("int").alias("_good")).distinct(), "_id", size), "labelled")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([s.tobytes() for s, _ in made], pa.binary()), pa.array([w.tobytes() for _, w in made], pa.binary())], names=["id", "good", "shape", "words"])

    rows = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("_id")).select(F.col("_id").cast("string"), "_good", text_col).mapInArrow(run, "id string, good int, shape binary, words binary").toPandas()
    rows = rows.sort_values(["id", "good", "shape"], kind="stable")  # the same model whatever the order of tasks
    shapes = np.array([np.frombuffer(s) for s in rows["shape"]]).reshape(len(rows), SHAPES)
    return Model.fit(shapes, [np.frombuffer(w, np.int32) for w in rows["words"]], rows["good"].to_numpy(float))


def with_evidence(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns and ``quality_logit``, the classifier's log odds of a good document. Texts are read whole, one at a time, whatever their length."""
    docs = docs.drop("quality_logit")  # an input column of that name is replaced
    at = docs.columns.index(text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array([held.value.logit(t.as_py()) for t in batch.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=[*batch.schema.names, "quality_logit"])

    from pyspark.sql.types import DoubleType, StructType

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add("quality_logit", DoubleType()))


def _shrunk(level: DataFrame, keys: list[str], up: Column, name: str) -> DataFrame:
    """Beta posterior means of groups around ``up``; its weight comes from the spread between groups (moments)."""
    rate = F.col("good") / F.col("n")
    fit_ = level.agg(
        (F.sum(F.col("n") * (rate - up) ** 2) / F.sum("n")).alias("spread"),
        (F.sum(F.col("noise")) / F.sum("n")).alias("within"),
        (F.sum(up * (1 - up) * F.col("n")) / F.sum("n")).alias("total"),
    )
    between = F.greatest(F.col("spread") - F.col("within"), F.col("total") / 1e6)
    weight = F.greatest(F.lit(1.0), F.col("total") / between - 1)
    return level.crossJoin(F.broadcast(fit_.select(weight.alias("w")))).withColumn(name, (F.col("good") + F.col("w") * up) / (F.col("n") + F.col("w"))).drop("w", "noise", "good", "n")


def posteriors(evidence: DataFrame, host: Column, path: Column) -> DataFrame:
    """(host, path, global_rate, host_rate, path_rate): one row per path of a host, by grouped aggregates only."""
    p = 1 / (1 + F.exp(-F.col("quality_logit")))
    rows = evidence.select(host.alias("host"), path.alias("path"), p.alias("p"))
    sums = saved(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("good"), F.sum(F.col("p") * (1 - F.col("p"))).alias("var")), "paths")
    whole = F.broadcast(sums.agg((F.sum("good") / F.sum("n")).alias("global_rate")))
    hosts = sums.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("var").alias("var"))
    hosts = hosts.crossJoin(whole).withColumn("noise", F.col("var") / F.col("n")).drop("var")
    hosts = saved(_shrunk(hosts, ["host"], F.col("global_rate"), "host_rate"), "hosts").withColumnRenamed("host", "h")
    paths = sums.join(hosts, F.col("host").eqNullSafe(F.col("h"))).withColumn("noise", F.col("var") / F.col("n")).drop("h", "var")
    return saved(_shrunk(paths, ["host", "path"], F.col("host_rate"), "path_rate"), "posteriors")


def classify(evidence: DataFrame, host: Column, path: Column, threshold: float = 0.5) -> DataFrame:
    """Rows of ``evidence`` with host_rate, path_rate, quality_score and quality_keep.

    The classifier's odds are moved from the global prior to the posterior of the row's path:
    logit(score) = logit(text) + logit(path rate) - logit(global rate). A host with few rows
    stays near the global rate, a path with few rows near its host.

    Null and empty texts are scored on their shape like any text; null hosts and paths form
    groups of their own; repeated rows get equal scores; clashing column names of the input
    are kept, own columns are quality_logit, host_rate, path_rate, quality_score and
    quality_keep (an input column of one of these names is replaced). Empty in, empty out.
    """
    table = posteriors(evidence, host, path).select(F.col("host").alias("_h"), F.col("path").alias("_p"), F.col("global_rate").alias("_g"), F.col("host_rate").alias("_hr"), F.col("path_rate").alias("_pr"))

    def logit(c: Column) -> Column:
        c = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), c))
        return F.log(c / (1 - c))

    joined = evidence.join(table, host.eqNullSafe(F.col("_h")) & path.eqNullSafe(F.col("_p")))
    score = 1 / (1 + F.exp(-(F.col("quality_logit") + logit(F.col("_pr")) - logit(F.col("_g")))))
    return joined.withColumns({"host_rate": F.col("_hr"), "path_rate": F.col("_pr"), "quality_score": score}).withColumn("quality_keep", F.col("quality_score") >= threshold).drop("_h", "_p", "_g", "_hr", "_pr")


def good_label() -> Column:
    """A document is good if it is of quality and not toxic; an unknown part leaves the other to decide."""
    return (F.coalesce(F.col("quality"), F.lit(1)) == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
