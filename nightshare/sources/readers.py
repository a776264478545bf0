"""Readers for landed files. Types are declared; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightshare.sources.files import file_heads, read_json_objects, read_named_csv

# The input columns by type.
LISTING_LONGS = (
    "id",
    "host_id",
    "accommodates",
    "availability_30",
    "availability_60",
    "availability_90",
    "availability_365",
    "number_of_reviews",
    "number_of_reviews_ltm",
    "number_of_reviews_l30d",
    "calculated_host_listings_count",
    "calculated_host_listings_count_entire_homes",
    "calculated_host_listings_count_private_rooms",
    "calculated_host_listings_count_shared_rooms",
    "estimated_occupancy_l365d",
)
LISTING_DOUBLES = (
    "latitude",
    "longitude",
    "bathrooms",
    "bedrooms",
    "beds",
    "minimum_nights",
    "maximum_nights",
    "review_scores_rating",
    "review_scores_location",
    "review_scores_value",
    "reviews_per_month",
    "estimated_revenue_l365d",
)
LISTING_DATES = ("last_scraped", "calendar_last_scraped", "first_review", "last_review")
LISTING_STRINGS = (
    "neighbourhood_cleansed",
    "neighbourhood_group_cleansed",
    "property_type",
    "room_type",
    "price",
    "license",
    "has_availability",
    "host_is_superhost",
)
CALENDAR_COLUMNS = ("listing_id", "date", "available", "minimum_nights", "maximum_nights")


def allow_only(df: DataFrame, allowed: Sequence[str], private: Sequence[str] = ()) -> DataFrame:
    """Keep the allowed columns that are there and are not private; anything else never leaves the reader."""
    return df.select(*[c for c in allowed if c in df.columns and c not in private])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns by name, cast; a missing column or a value that does not parse becomes null."""
    return df.select(
        *[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def read_quoted_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with quoted line breaks and doubled quotes, all text. One task reads a whole file; many files run side by side."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def read_listings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw listings as text, the declared columns only, whatever columns a capture's file has."""
    return read_named_csv(spark, path, [*LISTING_LONGS, *LISTING_DOUBLES, *LISTING_DATES, *LISTING_STRINGS], quoted=True).drop("file")


def read_calendar(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw calendar as text: the five columns all files share. Files with and without the price columns may be mixed."""
    return read_named_csv(spark, path, CALENDAR_COLUMNS).drop("file")


def read_worklist(spark: SparkSession, path: str | list[str], kind: str | None = None) -> DataFrame:
    """Rows of the flat work list, optionally of one file kind such as ``calendar``."""
    df = read_json_objects(spark, path, "ciudad string, ruta string, fecha string, ruta_fichero string")
    df = df.select(
        F.col("ciudad").alias("city"), F.col("ruta").alias("route"), F.col("fecha").alias("date"), F.col("ruta_fichero").alias("file")
    )
    return df.where(F.col("file").contains(kind)) if kind else df


def wide_to_long(df: DataFrame, dims: Sequence[str], pattern: str = r"^\d{4}-\d{2}$") -> DataFrame:
    """Turn one column per period into rows; cells that are not numbers are dropped."""
    import re

    periods = [c for c in df.columns if re.match(pattern, c)]
    text = df.select(*[F.col(f"`{c}`") for c in dims], *[F.col(f"`{p}`").cast("string").alias(p) for p in periods])
    long = text.unpivot([F.col(f"`{c}`") for c in dims], [F.col(f"`{p}`") for p in periods], "period", "raw")
    return long.withColumn("value", F.col("raw").try_cast("double")).drop("raw").where(F.col("value").isNotNull())


def read_wide_series(spark: SparkSession, paths: str | Sequence[str], dims: Sequence[str], encoding: str = "ISO-8859-1", pattern: str = r"^\d{4}-\d{2}$") -> DataFrame:
    """Wide part files, each with its own period columns, as one long table; cells that are not numbers are dropped."""
    wide = read_named_csv(spark, paths, dims, quoted=True, encoding=encoding, rest=pattern)
    long = wide.select(*[F.col(f"`{c}`") for c in dims], F.explode("cells").alias("period", "raw"))
    return long.withColumn("value", F.col("raw").try_cast("double")).drop("raw").where(F.col("value").isNotNull())


def european_number(text: Column) -> Column:
    """``1.234,5`` to a double."""
    return F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def month_period(text: Column) -> Column:
    """``2025M07`` to ``2025-07``."""
    return F.regexp_replace(text, r"^(\d{4})M(\d{2})$", "$1-$2")


def read_long_series(spark: SparkSession, path: str, value: str, period: str) -> DataFrame:
    """Long official table: semicolons, a byte-order mark, European numbers, monthly periods. Columns keep their names."""
    df = spark.read.option("header", True).option("sep", ";").option("encoding", "UTF-8").csv(path)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    return df.withColumn(value, european_number(F.col(f"`{value}`"))).withColumn(period, month_period(F.col(f"`{period}`")))


def read_registry(
    spark: SparkSession, path: str, fields: Sequence[str], dates: Sequence[str], province: str, municipality: str,
    private: Sequence[str] = (),
) -> DataFrame:
    """Register of dwellings: text objects with absent keys; contact fields are never loaded."""
    wanted = [f for f in fields if f not in private]
    schema = T.StructType([T.StructField(f, T.StringType()) for f in wanted])
    df = read_json_objects(spark, path, schema)
    for c in dates:
        df = df.withColumn(c, F.try_to_date(F.col(c), "dd/MM/yyyy"))
    return df.withColumn("municipality_code", F.concat(F.lpad(province, 2, "0"), F.lpad(municipality, 3, "0")))


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """Path and size of every file below ``<root>/<city>/<date>/``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    pattern = r"/([^/]+)/(\d{4}-\d{2}-\d{2})/([^/]+)$"
    part = lambda i: F.regexp_extract("path", pattern, i)
    return files.select(
        part(1).alias("city"), F.try_to_date(part(2)).alias("date"), part(3).alias("file"), "length", "path"
    ).where("file <> ''")


def list_landed(spark: SparkSession, root: str) -> DataFrame:
    return landed_files(spark, root).select("city", "date", "file")


def file_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Bytes, digest, rows and header line of every landed text file; files are read in pieces, whatever their size."""
    heads = file_heads(spark, root, digest=True)
    return heads.select("path", "bytes", "sha256", (F.col("lines") - 1).alias("rows"), "header")


def read_matches(spark: SparkSession, path: str, home_teams: dict[str, tuple[str, str]]) -> DataFrame:
    """Home matches of the named teams, in date order. The team table gives city and full name."""
    df = spark.read.option("header", True).csv(path)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    team = F.create_map(*[x for t, (c, n) in home_teams.items() for x in (F.lit(t), F.struct(F.lit(c).alias("city"), F.lit(n).alias("name")))])
    known = df.where(F.col("HomeTeam").isin(*home_teams)).withColumn("team", team[F.col("HomeTeam")])
    return known.select(
        F.try_to_date("Date", "dd/MM/yyyy").alias("date"),
        F.col("Time").alias("time"),
        F.col("team.city").alias("city"),
        F.col("team.name").alias("home_team"),
        F.col("AwayTeam").alias("rival"),
    ).orderBy("date", "city", "rival")


def series_rows(nested: DataFrame, measures: dict[str, str]) -> DataFrame:
    """Rows of nested series objects; empty values dropped, the measure read from the series name.

    ``measures`` maps a text the name must hold to the measure; the first that fits wins.
    """
    label = None
    for text, m in measures.items():
        label = F.when(F.col("name").contains(text), m) if label is None else label.when(F.col("name").contains(text), m)
    return (
        nested.select(F.col("Nombre").alias("name"), F.explode("Data").alias("p"))
        .select(
            "name",
            label.alias("measure"),
            F.concat_ws("-", F.col("p.Anyo").cast("string"), F.lpad(F.col("p.FK_Periodo").cast("string"), 2, "0")).alias("period"),
            F.col("p.Valor").alias("value"),
        )
        .where(F.col("value").isNotNull() & F.col("measure").isNotNull())
    )


def read_stat_api_json(spark: SparkSession, path: str, measures: dict[str, str]) -> DataFrame:
    schema = "Nombre string, Data array<struct<Anyo:int,FK_Periodo:int,Valor:double>>"
    return series_rows(read_json_objects(spark, path, schema), measures)


def header_columns(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file and column name, read from the header line; nothing else of a file is read."""
    return (
        file_heads(spark, path)
        .select("path", F.explode(F.split("header", ",")).alias("column"))
        .withColumn("column", F.btrim(F.col("column"), F.lit('"\r ')))
    )


def schema_drift(columns: DataFrame) -> DataFrame:
    """Per column: how many files have it, and whether all do."""
    total = columns.agg(F.countDistinct("path")).scalar()
    per = columns.groupBy("column").agg(F.countDistinct("path").alias("files"))
    return per.withColumn("in_all", F.col("files") == total)


def filled_share(df: DataFrame, columns: Sequence[str], file_column: str = "path") -> DataFrame:
    """Share of filled values by file and column."""
    one = df.groupBy(file_column).agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(c) for c in columns])
    return one.unpivot([file_column, "__n"], list(columns), "column", "filled").select(
        file_column, "column", F.round(F.col("filled") / F.col("__n"), 6).alias("share")
    )
