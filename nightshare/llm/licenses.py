"""License scan by diagonal voting: word k-grams joined to template positions, votes counted per offset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nightshare.llm.common import lower_ascii

# Fixed values: (label, phrase, whether it is a base phrase).
TEMPLATES = (
    ("gpl", "gnu general public license", True),
    ("apache", "apache license", True),
    ("cc-by", "cc by", True),
    ("mit", "mit license", True),
    ("apache", "licensed under the apache license version 2 0", False),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", False),
    ("cc-by", "creative commons attribution", False),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", False),
    ("lgpl", "gnu lesser general public license", False),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", False),
    ("mpl", "mozilla public license", False),
)
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K, DRIFT, COVERAGE, LONG = 2, 2, 0.7, 4


def template_grams(spark: SparkSession, templates=TEMPLATES, k: int = K) -> DataFrame:
    """One row per k-gram of each template; a fixed list, so its broadcast has a known size."""
    rows = []
    for t, (label, phrase, base) in enumerate(templates):
        words = phrase.split()
        if len(words) < k:
            raise ValueError(f"template shorter than {k} words: {phrase}")
        n = len(words) - k + 1
        rows += [F.struct(F.lit(t).alias("template"), F.lit(label).alias("label"), F.lit(base).alias("base"), F.lit(n).alias("grams"), F.lit(j).alias("t_pos"), F.lit(" ".join(words[j : j + k])).alias("t_gram")) for j in range(n)]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows))).withColumn("t_hash", F.xxhash64("t_gram"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, k: int = K, drift: int = DRIFT, coverage: float = COVERAGE, long: int = LONG) -> DataFrame:
    """Licenses named in each document; DataFrame functions only.

    Every rolling k-gram is joined to the template grams by hash (and by the gram itself, so a
    hash collision counts for nothing). A hit votes for its diagonal, position minus template
    position. A diagonal with all votes is an exact place. Diagonals of one template that lie
    at most ``drift`` words apart are merged (words put in or left out), and a merged span is
    verified when it is at most ``2 * drift`` words longer than its template and holds at least
    ``coverage`` of the template's grams; merged spans count for templates of ``long`` grams or more.

    Null text counts as empty: no words, no labels, score 0. Rows with equal id and text give
    equal results each; rows of one id with different texts are kept apart. Null ids are kept.
    Other columns of the input are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    words = F.regexp_extract_all(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))), F.lit(WORD), F.lit(0))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"), words.alias("words"))

    def gram(word, i):
        return F.concat_ws(" ", word, *[F.get(F.col("words"), i + j) for j in range(1, k)])

    grams = rows.select("doc_id", "text_key", F.posexplode(F.transform("words", gram)).alias("pos", "gram")).withColumn("hash", F.xxhash64("gram"))
    table = template_grams(spark, templates, k)
    hits = (
        grams.join(F.broadcast(table), (F.col("hash") == F.col("t_hash")) & (F.col("gram") == F.col("t_gram")))
        .groupBy("doc_id", "text_key", "template", "label", "base", "grams", "t_pos", "pos")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("diagonal", F.col("pos") - F.col("t_pos"))
    )
    one = ["doc_id", "text_key", "template", "label", "base", "grams"]
    # Hits of one template in one document: bounded by that document.
    ordered = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal", "pos")
    step = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(ordered), F.lit(0))
    grouped = hits.withColumn("step", step).withColumn("band", F.sum((F.col("step") > drift).cast("int")).over(ordered))
    by_diagonal = grouped.groupBy(*one, "band", "diagonal").agg(F.count(F.lit(1)).alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.collect_set("t_pos").alias("seen"))
    bands = by_diagonal.groupBy(*one, "band").agg(
        F.count_if(F.col("votes") == F.col("grams")).alias("places"),
        F.min(F.when(F.col("votes") == F.col("grams"), F.col("diagonal"))).alias("first"),
        F.max(F.when(F.col("votes") == F.col("grams"), F.col("diagonal"))).alias("last"),
        F.max(F.col("votes") / F.col("grams")).alias("best"),
        (F.size(F.array_distinct(F.flatten(F.collect_list("seen")))) / F.col("grams")).alias("merged"),
        (F.max("hi") - F.min("lo") + 1).alias("span"),
    )
    near = (F.col("span") <= F.col("grams") + 2 * drift) & (F.col("grams") >= long)
    share = F.greatest(F.col("best"), F.when(near, F.col("merged")).otherwise(0.0))
    found = (
        bands.withColumn("share", share)
        .groupBy("doc_id", "text_key")
        .agg(
            F.sum(F.when(F.col("base"), F.col("places")).otherwise(0)).alias("n_base"),
            F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"),
            F.max(F.when(F.col("base"), F.col("last"))).alias("last_word"),
            F.array_join(F.sort_array(F.collect_set(F.when(F.col("base") & (F.col("places") > 0), F.col("label")))), ",").alias("base_labels"),
            F.array_join(F.sort_array(F.collect_set(F.when((F.col("places") > 0) | (near & (F.col("share") >= coverage)), F.col("label")))), ",").alias("labels"),
            F.max("share").alias("score"),
        )
        .select(F.col("doc_id").alias("f_id"), F.col("text_key").alias("f_key"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    )
    counts = rows.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"))
    return counts.join(found, counts.doc_id.eqNullSafe(found.f_id) & (counts.text_key == found.f_key), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def license_sql(templates=TEMPLATES, k: int = K, drift: int = DRIFT, coverage: float = COVERAGE, long: int = LONG) -> str:
    """The same answer in DuckDB SQL over ``documents``; written over places in word lists, without votes for exact places."""
    rows = ", ".join(f"({t}, '{label}', {'true' if base else 'false'}, '{phrase}')" for t, (label, phrase, base) in enumerate(templates))
    pairs = " || ' ' || ".join(f"words[i + {j}]" for j in range(k))
    t_pairs = " || ' ' || ".join(f"tw[j + {j}]" for j in range(k))
    return f"""
WITH t AS (SELECT t, label, base, string_split(phrase, ' ') AS tw FROM (VALUES {rows}) v(t, label, base, phrase)),
tg AS (SELECT t, label, base, len(tw) - {k - 1} AS grams, j - 1 AS t_pos, {t_pairs} AS gram FROM (SELECT *, unnest(range(1, len(tw) - {k - 2})) AS j FROM t)),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
dg AS (SELECT r, i - 1 AS pos, {pairs} AS gram FROM (SELECT r, words, unnest(range(1, len(words) - {k - 2})) AS i FROM d)),
hit AS (SELECT r, t, label, base, grams, t_pos, pos, pos - t_pos AS diag FROM dg JOIN tg USING (gram)),
banded AS (SELECT *, sum(CASE WHEN diag - prev > {drift} THEN 1 ELSE 0 END) OVER (PARTITION BY r, t ORDER BY diag, pos ROWS UNBOUNDED PRECEDING) AS band
  FROM (SELECT *, lag(diag) OVER (PARTITION BY r, t ORDER BY diag, pos) AS prev FROM hit)),
full_place AS (SELECT r, t, diag FROM hit GROUP BY r, t, grams, diag HAVING count(*) = grams),
best AS (SELECT r, t, max(n / grams) AS best FROM (SELECT r, t, grams, diag, count(*) AS n FROM hit GROUP BY ALL) GROUP BY r, t),
merged AS (SELECT r, t, label, grams, band, count(DISTINCT t_pos) / grams AS share, max(pos) - min(pos) + 1 AS span FROM banded GROUP BY r, t, label, grams, band),
near AS (SELECT r, label, share FROM merged WHERE span <= grams + {2 * drift} AND grams >= {long}),
named AS (SELECT r, label, base FROM full_place JOIN t USING (t)),
base_of AS (SELECT r, count(*) AS n_base, min(diag) AS first_word, max(diag) AS last_word FROM full_place JOIN t USING (t) WHERE base GROUP BY r),
base_l AS (SELECT r, string_agg(label, ',' ORDER BY label) AS base_labels FROM (SELECT DISTINCT r, label FROM named WHERE base) GROUP BY r),
all_l AS (SELECT r, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM named UNION SELECT r, label FROM near WHERE share >= {coverage}) GROUP BY r),
score AS (SELECT r, max(s) AS score FROM (SELECT r, best AS s FROM best UNION ALL SELECT r, share FROM near) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN base_of USING (r) LEFT JOIN base_l USING (r) LEFT JOIN all_l USING (r) LEFT JOIN score USING (r)
"""
