"""Transverse Mercator zones of WGS 84: longitudes and latitudes to metres and back, as built-in functions.

The series in the third flattening is taken to its fourth power, which is exact to well under a millimetre within a zone's surroundings.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ellipsoid's axis and flattening, the scale on the central meridian, the false origin.
AXIS, FLATTENING = 6378137.0, 1 / 298.257223563
SCALE, FALSE_EASTING, FALSE_NORTHING = 0.9996, 500000.0, 10000000.0

_N = FLATTENING / (2 - FLATTENING)
ECCENTRICITY = (FLATTENING * (2 - FLATTENING)) ** 0.5
RADIUS = SCALE * AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)

# The coefficients of the forward and inverse series, and of latitudes from conformal ones.
FORWARD = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
INVERSE = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
LATITUDE = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)


def zone_code(lon: Column, lat: Column) -> Column:
    """The EPSG code of the regular six-degree zone of a place; the irregular zones of Norway and Svalbard are not applied."""
    zone = F.least(F.lit(60), F.floor((lon + 180) / 6).cast("int") + 1)
    return F.when(lat < 0, F.lit(32700)).otherwise(F.lit(32600)) + zone


def _zone(epsg: Column) -> tuple[Column, Column]:
    """The central meridian in degrees and the false northing of a code; another code than a zone's is an error, and null stays null."""
    zone = epsg % 100
    good = epsg.between(32601, 32660) | epsg.between(32701, 32760)
    checked = F.when(good, zone).when(epsg.isNotNull(), F.raise_error(F.concat(F.lit("not a transverse Mercator zone: "), epsg.cast("string"))).cast("int"))
    return checked * 6 - 183, F.when(epsg >= 32700, F.lit(FALSE_NORTHING)).otherwise(F.lit(0.0))


def _series(factors: Sequence[float], along: Column, across: Column) -> tuple[Column, Column]:
    """The sums that each coordinate gains, over multiples of twice the coordinates."""
    first, second = F.lit(0.0), F.lit(0.0)
    for i, factor in enumerate(factors, 1):
        first = first + F.lit(factor) * F.sin(along * (2 * i)) * F.cosh(across * (2 * i))
        second = second + F.lit(factor) * F.cos(along * (2 * i)) * F.sinh(across * (2 * i))
    return first, second


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, where the optimizer would write it out at each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def forward(lon: Column, lat: Column, epsg: Column) -> Column:
    """``struct<x, y>`` in metres of degrees; null where one of them is."""
    meridian, north = _zone(epsg)

    def bent(s: Column) -> Column:
        bend = F.sinh(F.lit(ECCENTRICITY) * F.atanh(F.lit(ECCENTRICITY) * s["t"] / F.sqrt(s["t"] * s["t"] + 1)))
        return _let(bend, lambda b: _let(s["t"] * F.sqrt(b * b + 1) - b * F.sqrt(s["t"] * s["t"] + 1), lambda q: turned(s, q)))

    def turned(s: Column, q: Column) -> Column:
        across = F.asinh(F.sin(s["turn"]) / F.sqrt(q * q + F.cos(s["turn"]) * F.cos(s["turn"])))
        return _let(F.struct(F.atan2(q, F.cos(s["turn"])).alias("along"), across.alias("across")), lambda c: metres(s, c))

    def metres(s: Column, c: Column) -> Column:
        more_along, more_across = _series(FORWARD, c["along"], c["across"])
        return F.struct((F.lit(FALSE_EASTING) + F.lit(RADIUS) * (c["across"] + more_across)).alias("x"), (s["north"] + F.lit(RADIUS) * (c["along"] + more_along)).alias("y"))

    start = F.struct(F.radians(lon - meridian).alias("turn"), F.tan(F.radians(lat)).alias("t"), north.alias("north"))
    return _let(start, lambda s: F.when(s["turn"].isNotNull() & s["t"].isNotNull(), bent(s)))


def inverse(x: Column, y: Column, epsg: Column) -> Column:
    """``struct<lon, lat>`` in degrees of metres; null where one of them is."""
    meridian, north = _zone(epsg)

    def back(s: Column) -> Column:
        less_along, less_across = _series(INVERSE, s["along"], s["across"])
        return _let(F.struct((s["along"] - less_along).alias("along"), (s["across"] - less_across).alias("across")), lambda c: _let(F.asin(F.sin(c["along"]) / F.cosh(c["across"])), lambda q: degrees(s, c, q)))

    def degrees(s: Column, c: Column, q: Column) -> Column:
        lat = q
        for i, factor in enumerate(LATITUDE, 1):
            lat = lat + F.lit(factor) * F.sin(q * (2 * i))
        return F.struct((F.degrees(F.atan2(F.sinh(c["across"]), F.cos(c["along"]))) + s["meridian"]).alias("lon"), F.degrees(lat).alias("lat"))

    start = F.struct(((y - north) / RADIUS).alias("along"), ((x - FALSE_EASTING) / RADIUS).alias("across"), meridian.alias("meridian"))
    return _let(start, lambda s: F.when(s["along"].isNotNull() & s["across"].isNotNull() & s["meridian"].isNotNull(), back(s)))


def projected_ring(ring: Column, epsg: Column, digits: int = 6) -> Column:
    """A ring of (longitude, latitude) pairs as one of metres in a zone, rounded."""
    return F.transform(ring, lambda p: _let(forward(p[0], p[1], epsg), lambda q: _pair(q, "x", "y", digits)))


def geographic_ring(ring: Column, epsg: Column, digits: int = 12) -> Column:
    """A ring of pairs of metres in a zone as one of (longitude, latitude), rounded."""
    return F.transform(ring, lambda p: _let(inverse(p[0], p[1], epsg), lambda q: _pair(q, "lon", "lat", digits)))


def _pair(place: Column, first: str, second: str, digits: int) -> Column:
    return F.array(F.round(place[first], digits), F.round(place[second], digits))


def grid_ring(transform: Column, height: Column, width: Column) -> Column:
    """The outline of a grid of affine terms (a, b, c, d, e, f), its corners in order from the first pixel's."""

    def corner(column: Column, row: Column) -> Column:
        return F.array(transform[0] * column + transform[1] * row + transform[2], transform[3] * column + transform[4] * row + transform[5])

    zero, h, w = F.lit(0.0), height.cast("double"), width.cast("double")
    return F.array(corner(zero, zero), corner(w, zero), corner(w, h), corner(zero, h))
