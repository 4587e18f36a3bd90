"""Distances, point-in-polygon tests and the map projection, as Column maths."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from corridor.functions import wkt

# the Arrow function below travels with its job: executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# GRS80 and WGS84 ellipsoids, and UTM zone 30 north.
GRS80_AXIS = 6378137.0
GRS80_FLATTENING = 1 / 298.257222101
WGS84_AXIS = 6378137.0
WGS84_FLATTENING = 1 / 298.257223563
EARTH_RADIUS = 6371008.8
UTM30_MERIDIAN = -3.0
UTM_SCALE = 0.9996
UTM_FALSE_EASTING = 500000.0

# Arc on the auxiliary sphere from which on the azimuth is searched.
NEARLY_HALF_TURN = 3.0
# Nodes of the integrals along a geodesic, and halvings of the azimuth's half turn.
NODES = 32
HALVINGS = 60

Vertex = tuple[float, float]


def planar_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x2 - x1, y2 - y1
    return F.sqrt(dx * dx + dy * dy)


def haversine_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle metres on a sphere: the cheap stand-in for the ellipsoid."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    half = (
        F.pow(F.sin(dlat / 2), 2.0)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2.0)
    )
    return F.asin(F.sqrt(half)) * (2 * EARTH_RADIUS)


def _vincenty(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    a, f = WGS84_AXIS, WGS84_FLATTENING
    b = a * (1 - f)
    u1 = np.arctan((1 - f) * np.tan(np.radians(lat1)))
    u2 = np.arctan((1 - f) * np.tan(np.radians(lat2)))
    su1, cu1, su2, cu2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    span = np.radians(lon2 - lon1)
    lam = span.copy()
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(200):
            sl, cl = np.sin(lam), np.cos(lam)
            s = np.hypot(cu2 * sl, cu1 * su2 - su1 * cu2 * cl)
            c = su1 * su2 + cu1 * cu2 * cl
            sigma = np.arctan2(s, c)
            sin_alpha = np.where(s == 0, 0.0, cu1 * cu2 * sl / s)
            cos2_alpha = 1 - sin_alpha**2
            cos_2m = np.where(cos2_alpha == 0, 0.0, c - 2 * su1 * su2 / cos2_alpha)
            k = f / 16 * cos2_alpha * (4 + f * (4 - 3 * cos2_alpha))
            longer = span + (1 - k) * f * sin_alpha * (
                sigma + k * s * (cos_2m + k * c * (2 * cos_2m**2 - 1))
            )
            moved = np.abs(longer - lam)
            lam = longer
            if not np.nanmax(moved, initial=0.0) > 1e-13:
                break
    # among nearly antipodal points some do not settle, others lose digits
    unsettled = ~(moved <= 1e-13) | (sigma > NEARLY_HALF_TURN)
    usq = cos2_alpha * (a * a - b * b) / (b * b)
    big_a = 1 + usq / 16384 * (4096 + usq * (-768 + usq * (320 - 175 * usq)))
    big_b = usq / 1024 * (256 + usq * (-128 + usq * (74 - 47 * usq)))
    cubic = cos_2m / 6 * big_b * (4 * s**2 - 3) * (4 * cos_2m**2 - 3)
    bend = big_b * s * (cos_2m + big_b / 4 * (c * (2 * cos_2m**2 - 1) - cubic))
    metres = b * big_a * (sigma - bend)
    known = unsettled & ~np.isnan(lon1 + lat1 + lon2 + lat2)
    if known.any():
        metres[known] = _by_azimuth(*(part[known] for part in (lon1, lat1, lon2, lat2)))
    return metres


def _by_azimuth(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    """Geodesic metres by searching the azimuth at which a geodesic must start; for any pair of points.

    With the point farther from the equator first and in the south, the difference of longitude at
    which a geodesic meets the other point's latitude grows with its azimuth from 0 to 180 degrees,
    so halving finds the one wanted. Longitude and length are integrals along the great circle of the
    auxiliary sphere, smooth enough for a fixed number of nodes.
    """
    a, f = WGS84_AXIS, WGS84_FLATTENING
    b = a * (1 - f)
    span = np.abs(np.remainder(np.radians(lon2 - lon1) + np.pi, 2 * np.pi) - np.pi)
    u = np.arctan((1 - f) * np.tan(np.radians(np.stack([lat1, lat2]))))
    far = np.abs(u[0]) >= np.abs(u[1])
    start, end = np.where(far, u[0], u[1]), np.where(far, u[1], u[0])
    flip = np.where(start > 0, -1.0, 1.0)
    # on the equator itself: just south of it
    start, end = np.minimum(start * flip, -1e-200), end * flip
    ss, cs, se, ce = np.sin(start), np.cos(start), np.sin(end), np.cos(end)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)

    def meets(azimuth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Difference of longitude and length of the geodesic up to the other latitude, and metres a radian
        by which the length grows with that difference."""
        sin_az, cos_az = np.sin(azimuth), np.cos(azimuth)
        sin0 = sin_az * cs
        cos0 = np.hypot(cos_az, sin_az * ss)
        arrive = np.sqrt((cos_az * cs) ** 2 + np.maximum((cs - ce) * (cs + ce) * -1.0, 0.0))
        s1, s2 = np.arctan2(ss, cos_az * cs), np.arctan2(se, arrive)
        w1 = np.arctan2(sin0 * np.sin(s1), np.cos(s1))
        w2 = np.arctan2(sin0 * np.sin(s2), np.cos(s2))
        half = (s2 - s1) / 2
        at = half[:, None] * nodes + ((s1 + s2) / 2)[:, None]
        stretch = np.sqrt(1 + (cos0**2 * (a * a - b * b) / (b * b))[:, None] * np.sin(at) ** 2)
        lag = f * sin0 * half * ((2 - f) / (1 + (1 - f) * stretch) @ weights)
        return w2 - w1 - lag, b * half * (stretch @ weights), a * sin0

    low, high = np.zeros_like(span), np.full_like(span, np.pi)
    for _ in range(HALVINGS):
        middle = (low + high) / 2
        short = meets(middle)[0] < span
        low, high = np.where(short, middle, low), np.where(short, high, middle)
    # beside the equator a last bit of the azimuth is metres; along it every azimuth but one is too long or too short
    reached, metres, slope = meets(high)
    return metres - slope * (reached - span)


@F.pandas_udf(DoubleType())
def _spheroid(
    batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]],
) -> Iterator[pd.Series]:
    for lon1, lat1, lon2, lat2 in batches:
        yield pd.Series(_vincenty(*(part.to_numpy(dtype="float64") for part in (lon1, lat1, lon2, lat2))))


def spheroid_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Geodesic metres on the WGS84 ellipsoid, antipodal points included; input outside lon/lat range fails."""
    degrees = [_checked(lon1, 180.0), _checked(lat1, 90.0), _checked(lon2, 180.0), _checked(lat2, 90.0)]
    return _spheroid(*degrees)


def _checked(degrees: Column, limit: float) -> Column:
    wrong = F.raise_error(F.concat(F.lit("not a longitude or latitude: "), degrees.cast("string")))
    return F.when(F.abs(degrees) > limit, wrong.cast("double")).otherwise(degrees)


def to_utm30(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Latitude and longitude in degrees to easting and northing (EPSG:25830).

    Third-order Krueger series of the transverse Mercator projection.
    """
    f = GRS80_FLATTENING
    n = f / (2 - f)
    radius = GRS80_AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    series = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16,
        13 * n**2 / 48 - 3 * n**3 / 5,
        61 * n**3 / 240,
    ]
    ecc = 2 * n**0.5 / (1 + n)
    phi, lam = F.radians(lat), F.radians(lon - UTM30_MERIDIAN)
    t = F.sinh(F.atanh(F.sin(phi)) - F.atanh(F.sin(phi) * ecc) * ecc)
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(t * t + 1))
    east, north = eta, xi
    for order, weight in enumerate(series, start=1):
        east = east + F.cos(xi * (2 * order)) * F.sinh(eta * (2 * order)) * weight
        north = north + F.sin(xi * (2 * order)) * F.cosh(eta * (2 * order)) * weight
    return east * (UTM_SCALE * radius) + UTM_FALSE_EASTING, north * (UTM_SCALE * radius)


def transform_points(points: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Add ``x`` and ``y`` in metres to a table of geographic points."""
    east, north = to_utm30(F.col(lat), F.col(lon))
    return points.withColumn("x", east).withColumn("y", north)


def study_area(spark: SparkSession, wkt_text: str, geographic: bool = True, lat_first: bool = True) -> list[list[Vertex]]:
    """The rings of a polygon given as a parameter, in projected metres.

    The polygon is a short user parameter, so its corners come to the driver.
    ``lat_first`` says the text writes latitude before longitude.
    """
    corners = wkt.ring_vertices(spark.createDataFrame([("area", wkt_text)], "id string, geom string"), "id", "geom")
    if geographic:
        lat, lon = ("x", "y") if lat_first else ("y", "x")
        east, north = to_utm30(F.col(lat), F.col(lon))
        corners = corners.select("ring", "seq", east.alias("x"), north.alias("y"))
    found: dict[int, list[Vertex]] = {}
    for corner in sorted(corners.select("ring", "seq", "x", "y").collect()):
        found.setdefault(corner["ring"], []).append((corner["x"], corner["y"]))
    return [found[ring] for ring in sorted(found)]


def _edges(area: Sequence[Sequence[Vertex]]) -> list[tuple[Vertex, Vertex]]:
    return [(ring[i], ring[i + 1]) for ring in area for i in range(len(ring) - 1)]


def _crosses(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Whether an edge crosses the ray to the right of a point (half-open in y)."""
    spans = (y1 > py) != (y2 > py)
    return F.when(spans, px < (x2 - x1) * (py - y1) / (y2 - y1) + x1).otherwise(False)


def _touches(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    straight = (x2 - x1) * (py - y1) == (y2 - y1) * (px - x1)
    return (
        straight
        & px.between(F.least(x1, x2), F.greatest(x1, x2))
        & py.between(F.least(y1, y2), F.greatest(y1, y2))
    )


def within_area(px: Column, py: Column, area: Sequence[Sequence[Vertex]]) -> Column:
    """Whether a point lies strictly inside a fixed polygon (even-odd rule).

    Holes and several parts are further rings. The bounding box is tested first.
    """
    edges = _edges(area)
    xs = [corner[0] for ring in area for corner in ring]
    ys = [corner[1] for ring in area for corner in ring]
    in_box = (px > min(xs)) & (px < max(xs)) & (py > min(ys)) & (py < max(ys))
    literal = [tuple(F.lit(float(v)) for v in (*start, *end)) for start, end in edges]
    crossings = reduce(lambda a, b: a + b, [_crosses(px, py, *edge).cast("int") for edge in literal])
    on_edge = reduce(lambda a, b: a | b, [_touches(px, py, *edge) for edge in literal])
    return in_box & ~on_edge & (crossings % 2 == 1)


def within_rings(px: Column, py: Column, polygon_rings: Column) -> Column:
    """The same test against a polygon held in a column as an array of rings."""

    def ring_edges(ring: Column) -> Column:
        return F.transform(
            F.slice(ring, F.lit(1), F.size(ring) - 1),
            lambda start, i: F.struct(start.alias("a"), F.get(ring, i + 1).alias("b")),
        )

    def corners(edge: Column) -> tuple[Column, ...]:
        return edge["a"]["x"], edge["a"]["y"], edge["b"]["x"], edge["b"]["y"]

    edges = F.flatten(F.transform(polygon_rings, ring_edges))
    crossings = F.size(F.filter(edges, lambda e: _crosses(px, py, *corners(e))))
    on_edge = F.exists(edges, lambda e: _touches(px, py, *corners(e)))
    return ~on_edge & (crossings % 2 == 1)
