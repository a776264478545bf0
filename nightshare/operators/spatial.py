"""Points in polygons by an equality join on grid cells, and hexagon zoning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshare.functions.geometry import hex_centre, hex_id, in_ring
from nightshare.operators.picks import mode_of
from nightshare.operators.prefix import attach


def _cell(v: Column, size: float) -> Column:
    return F.floor(v / size)


def with_rings(polygons: DataFrame) -> DataFrame:
    """Polygons with ``rings``, parts and holes alike; a single ``ring`` is one of them."""
    return polygons if "rings" in polygons.columns else polygons.withColumn("rings", F.array("ring"))


def in_rings(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd over all rings: inside an odd number of them, so a hole is outside and a part in a hole inside."""
    return F.aggregate(rings, F.lit(False), lambda odd, ring: odd != in_ring(x, y, ring))


def polygon_cells(polygons: DataFrame, size: float) -> DataFrame:
    """(all columns, __cx, __cy, __inner): the grid cells of each polygon with ``rings``.

    Cells that an edge may cross are border cells. No edge crosses any other cell, so its middle tells for the whole
    of it: inside (``__inner``) or left out. Rows are told apart by all their columns.
    """
    span = lambda a, b: F.sequence(_cell(F.least(a, b), size), _cell(F.greatest(a, b), size))
    shapes = polygons.withColumn("__p", F.xxhash64(*polygons.columns))
    edges = shapes.select("__p", F.explode("rings").alias("r")).select("__p", F.explode(F.arrays_zip(F.col("r").alias("a"), F.concat(F.slice("r", 2, F.greatest(F.size("r") - 1, F.lit(0))), F.slice("r", 1, 1)).alias("b"))).alias("e"))
    ax, ay, bx, by = (F.col(f"e.{p}.{c}") for p in "ab" for c in "xy")
    # Column by column an edge crosses the rows between its heights at the column's two sides; a hair more for rounding.
    cut = edges.withColumn("__cx", F.explode(span(ax, bx)))
    height = lambda at: F.when(ax == bx, ay).otherwise(ay + (by - ay) * (F.greatest(F.least(at, F.greatest(ax, bx)), F.least(ax, bx)) - ax) / (bx - ax))
    low, high = height(F.col("__cx") * size), F.when(ax == bx, by).otherwise(height((F.col("__cx") + 1) * size))
    hair = size * 1e-9
    cut = cut.withColumn("__cy", F.explode(span(F.least(low, high) - hair, F.greatest(low, high) + hair))).select("__p", "__cx", "__cy").distinct()
    points = F.flatten("rings")
    side = lambda axis, f: f(F.transform(points, lambda p: p[axis]))
    box = shapes.withColumn("__cx", F.explode(span(side("x", F.array_min), side("x", F.array_max)))).withColumn("__cy", F.explode(span(side("y", F.array_min), side("y", F.array_max))))
    middle = in_rings((F.col("__cx") + 0.5) * size, (F.col("__cy") + 0.5) * size, F.col("rings"))
    inner = box.join(cut, ["__p", "__cx", "__cy"], "left_anti").where(middle).withColumn("__inner", F.lit(True))
    border = shapes.join(cut, "__p").withColumn("__inner", F.lit(False))
    return border.unionByName(inner).drop("__p")


def locate(points: DataFrame, polygons: DataFrame, size: float, code: str = "code", x: str = "x", y: str = "y", out: str = "district") -> DataFrame:
    """Points with the polygon that holds them, the lowest code if several do, null outside.

    Polygons have a closed ``ring``, or closed ``rings`` with all parts and holes. Each row of points gives one row. The polygons of a cell are one array, so a point meets its
    cell once and nothing is grouped after the join, which is left open for the engine: a
    small polygon side is broadcast by its measured size, a crowded cell is split. Only points in border cells are tested against rings.
    """
    cells = polygon_cells(with_rings(polygons).select(F.col(code).alias("__code"), "rings"), size)
    held = F.struct("__code", F.when(~F.col("__inner"), F.col("rings")).alias("rings"))
    cells = cells.groupBy("__cx", "__cy").agg(F.collect_list(held).alias("__held"))
    placed = points.withColumn("__cx", _cell(F.col(x), size)).withColumn("__cy", _cell(F.col(y), size))
    met = placed.join(cells, ["__cx", "__cy"], "left")
    inside = F.filter("__held", lambda h: h["rings"].isNull() | in_rings(F.col(x), F.col(y), h["rings"]))
    return met.select(*points.columns, F.array_min(F.transform(inside, lambda h: h["__code"])).alias(out))


def reference_points(polygons: DataFrame, landmarks: DataFrame, size: float, code: str = "code", name: str = "name") -> DataFrame:
    """One row per polygon and landmark inside it."""
    cells = polygon_cells(with_rings(polygons).select(code, "rings"), size)
    placed = landmarks.withColumn("__cx", _cell(F.col("x"), size)).withColumn("__cy", _cell(F.col("y"), size))
    met = placed.join(cells, ["__cx", "__cy"])
    return met.where(F.col("__inner") | in_rings(F.col("x"), F.col("y"), F.col("rings"))).select(code, name).distinct()


def with_hex(points: DataFrame, radius: float, x: str = "x", y: str = "y") -> DataFrame:
    return points.withColumn("__h", hex_id(F.col(x), F.col(y), radius)).select(*points.columns, "__h.q", "__h.r")


def hex_bins(points: DataFrame, radius: float, homes: Column, least: int = 10) -> DataFrame:
    """Hexagons with at least ``least`` homes, with the homes and all points in them."""
    g = with_hex(points.withColumn("__home", homes), radius).groupBy("q", "r")
    return g.agg(F.count_if("__home").alias("homes"), F.count(F.lit(1)).alias("points")).where(F.col("homes") >= least)


def hex_district(points: DataFrame, polygons: DataFrame, radius: float, size: float, code: str = "code") -> DataFrame:
    """The district of each hexagon: the one that holds its centre, else the commonest among its points."""
    hexed = with_hex(locate(points, polygons, size, code), radius)
    cells = hexed.select("q", "r").distinct()
    cx, cy = hex_centre(F.col("q"), F.col("r"), radius)
    centres = locate(cells.withColumn("x", cx).withColumn("y", cy), polygons, size, code, out="__centre")
    common = mode_of(hexed, ["q", "r"], "district", "__common")
    return attach(centres, common, ["q", "r"]).select("q", "r", F.coalesce("__centre", "__common").alias("district"))


def label_points(points: DataFrame, by: Sequence[str], least: int = 10, x: str = "x", y: str = "y") -> DataFrame:
    """Where to write a zone's name: the mean of its homes, for zones with enough of them."""
    return (
        points.groupBy(*by)
        .agg(F.avg(x).alias("label_x"), F.avg(y).alias("label_y"), F.count(F.lit(1)).alias("homes"))
        .where(F.col("homes") >= least)
    )
