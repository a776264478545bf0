"""Plane geometry as column expressions: rings, hexagons and a map projection."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The GRS80 ellipsoid and the usual transverse Mercator constants.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
SCALE = 0.9996
FALSE_EASTING = 500000.0

ROOT3 = math.sqrt(3.0)


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd test against a closed ring of (x, y) structs.

    An edge owns its lower end and not its upper end, so a point on a shared
    border falls in exactly one of two rings that tile the plane.
    """
    starts = F.slice(ring, F.lit(1), F.size(ring) - 1)
    ends = F.slice(ring, F.lit(2), F.size(ring) - 1)
    crossings = F.filter(
        F.arrays_zip(starts.alias("a"), ends.alias("b")),
        lambda e: ((e["a"]["y"] <= y) != (e["b"]["y"] <= y))
        & (
            x
            < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"]
        ),
    )
    return F.size(crossings) % 2 == 1


def hex_id(x: Column, y: Column, radius: float) -> Column:
    """Axial coordinates (q, r) of the pointy-top hexagon that holds the point."""
    q = (x * (ROOT3 / 3) - y / 3) / radius
    r = (y * (2.0 / 3)) / radius
    s = -q - r
    rq, rr, rs = F.bround(q), F.bround(r), F.bround(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    worst_q = (dq > ds) & (dq > dr)
    worst_s = ~worst_q & (ds > dr)
    return F.struct(
        F.when(worst_q, -rs - rr).otherwise(rq).cast("bigint").alias("q"),
        F.when(worst_q | worst_s, rr).otherwise(-rq - rs).cast("bigint").alias("r"),
    )


def hex_centre(q: Column, r: Column, radius: float) -> tuple[Column, Column]:
    return F.lit(radius * ROOT3) * (q + r / 2), F.lit(radius * 1.5) * r


def hex_corners(q: Column, r: Column, radius: float) -> Column:
    """The six corners in plane metres, in turn."""
    cx, cy = hex_centre(q, r, radius)
    return F.transform(
        F.sequence(F.lit(0), F.lit(5)),
        lambda i: F.struct(
            (cx + F.lit(radius) * F.cos(F.radians(i * 60 - 30))).alias("x"),
            (cy + F.lit(radius) * F.sin(F.radians(i * 60 - 30))).alias("y"),
        ),
    )


def utm(lon: Column, lat: Column, zone: int = 30) -> tuple[Column, Column]:
    """Easting and northing of WGS84 degrees, by the third-order Krueger series (northern half)."""
    n = FLATTENING / (2 - FLATTENING)
    a = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 / 3 * n**2 + 5 / 16 * n**3, 13 / 48 * n**2 - 3 / 5 * n**3, 61 / 240 * n**3)
    e = 2 * math.sqrt(n) / (1 + n)
    phi, lam = F.radians(lat), F.radians(lon - F.lit(float(zone * 6 - 183)))
    sin_phi = F.sin(phi)
    t = F.sinh(F.atanh(sin_phi) - F.lit(e) * F.atanh(F.lit(e) * sin_phi))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(t * t + 1))
    east, north = eta, xi
    for j, c in enumerate(alpha, 1):
        east = east + F.lit(c) * F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j))
        north = north + F.lit(c) * F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j))
    return F.lit(FALSE_EASTING) + F.lit(SCALE * a) * east, F.lit(SCALE * a) * north
