"""Geometry on arrays of points, as column expressions.

A point is a struct (x, y) of doubles, a ring an array of points whose closing edge is implied, a box a struct
(x0, y0, x1, y1).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = ("x0", "y0", "x1", "y1")


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, use) -> Column:
    """Bind a value once for use in an expression."""
    return F.element_at(F.transform(F.array(value), use), 1)


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0.0), lambda acc, x: acc + x)


def points(coords: Column | str) -> Column:
    """Points from a flat array x, y, x, y, ...; a last odd value is dropped."""
    coords = col(coords)
    pairs = F.sequence(F.lit(0), F.floor(F.size(coords) / 2).cast("int") - 1)
    at = lambda i: F.struct(F.get(coords, 2 * i).alias("x"), F.get(coords, 2 * i + 1).alias("y"))
    return F.when(F.size(coords) >= 2, F.transform(pairs, at)).otherwise(F.array().cast("array<struct<x:double,y:double>>"))


def area(ring: Column | str) -> Column:
    """Shoelace area."""
    ring = col(ring)
    shifted = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.abs(total(F.zip_with(ring, shifted, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]))) / 2


def bbox(ring: Column | str) -> Column:
    ring = col(ring)
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def box_area(box: Column) -> Column:
    return F.greatest(box["x1"] - box["x0"], F.lit(0.0)) * F.greatest(box["y1"] - box["y0"], F.lit(0.0))


def box_iou(one: Column | str, other: Column | str) -> Column:
    """Intersection over union of two boxes; 0 when the union is empty."""
    one, other = col(one), col(other)
    width = F.greatest(F.least(one["x1"], other["x1"]) - F.greatest(one["x0"], other["x0"]), F.lit(0.0))
    height = F.greatest(F.least(one["y1"], other["y1"]) - F.greatest(one["y0"], other["y0"]), F.lit(0.0))
    common = width * height
    union = box_area(one) + box_area(other) - common
    return F.when(union > 0, common / union).otherwise(0.0)


def boxes_touch(one: Column | str, other: Column | str) -> Column:
    """Closed overlap test: touching counts."""
    one, other = col(one), col(other)
    return (one["x0"] <= other["x1"]) & (other["x0"] <= one["x1"]) & (one["y0"] <= other["y1"]) & (other["y0"] <= one["y1"])


def tile_starts(length: Column | str, size: int, stride: int) -> Column:
    """Starts of windows over a length: multiples of the stride, and one that ends at the edge."""
    if size <= 0 or stride <= 0:
        raise ValueError("tile size and stride must be positive")
    length = col(length)
    regular = F.sequence(F.lit(0), length - size, F.lit(stride))
    return F.when(length <= size, F.array(F.lit(0))).otherwise(F.array_distinct(F.array_append(regular, length - size)))


def clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def normalise(ring: Column | str, x_off: Column, y_off: Column, size: Column) -> Column:
    """A ring relative to a window, clamped to [0, 1]; null under three points."""
    ring = col(ring)
    moved = F.transform(ring, lambda p: F.struct(clamp((p["x"] - x_off) / size).alias("x"), clamp((p["y"] - y_off) / size).alias("y")))
    return F.when(F.size(ring) >= 3, moved)


def label_line(class_id: Column, ring: Column) -> Column:
    """`class x y x y ...` with six decimals; null where the ring is null."""
    numbers = F.flatten(F.transform(ring, lambda p: F.array(F.format_string("%.6f", p["x"]), F.format_string("%.6f", p["y"]))))
    return F.when(ring.isNotNull(), F.concat_ws(" ", class_id.cast("string"), F.array_join(numbers, " ")))


def to_pixel(ring: Column | str, transform: Column | str) -> Column:
    """Map coordinates to (column, row) by the inverse of an affine transform [a, b, c, d, e, f].

    x = a * column + b * row + c, y = d * column + e * row + f.
    """
    ring, t = col(ring), col(transform)
    a, b, c, d, e, f = (F.get(t, F.lit(k)) for k in range(6))
    det = a * e - b * d
    return F.transform(
        ring,
        lambda p: F.struct(
            ((e * (p["x"] - c) - b * (p["y"] - f)) / det).alias("x"), ((a * (p["y"] - f) - d * (p["x"] - c)) / det).alias("y")
        ),
    )


def open_ring(ring: Column | str) -> Column:
    """Without a closing vertex that repeats the first; null under three points."""
    ring = col(ring)
    closed = (F.size(ring) > 1) & (F.get(ring, F.lit(0)) == F.element_at(ring, -1))
    ring = F.when(closed, F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(1)))).otherwise(ring)
    return F.when(F.size(ring) >= 3, ring)


def centroid(ring: Column | str) -> Column:
    """Area centroid; the mean of the vertices when the area is 0."""

    def of(r: Column) -> Column:
        n = F.size(r)
        shifted = F.concat(F.slice(r, 2, F.greatest(n - 1, F.lit(0))), F.slice(r, 1, 1))
        parts = F.zip_with(r, shifted, lambda a, b: F.struct((a["x"] * b["y"] - b["x"] * a["y"]).alias("k"), (a["x"] + b["x"]).alias("x"), (a["y"] + b["y"]).alias("y")))
        mean = lambda k: total(F.transform(r, lambda p: p[k])) / n

        def weighted(parts: Column) -> Column:
            along = lambda k: total(F.transform(parts, lambda s: s["k"] * s[k]))
            found = lambda twice, k: F.when(twice != 0, F.try_divide(along(k), 3 * twice)).otherwise(mean(k)).alias(k)
            return let(total(F.transform(parts, lambda s: s["k"])), lambda twice: F.struct(found(twice, "x"), found(twice, "y")))

        return let(parts, weighted)

    return let(col(ring), of)


def contains_point(ring: Column | str, x: Column, y: Column) -> Column:
    """Even-odd ray casting."""
    ring = col(ring)
    shifted = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    crosses = F.zip_with(
        ring, shifted,
        lambda a, b: ((a["y"] > y) != (b["y"] > y)) & (x < F.coalesce(F.try_divide((b["x"] - a["x"]) * (y - a["y"]), b["y"] - a["y"]), F.lit(0.0)) + a["x"]),
    )
    return F.size(F.filter(crosses, lambda c: c)) % 2 == 1


# fixed values: the ellipsoid and the scale of UTM
_A, FLATTENING, _K0 = 6378137.0, 1 / 298.257222101, 0.9996


def utm_constants() -> tuple[float, tuple[float, ...], float]:
    """Scale, coefficients and eccentricity of Krueger's series to the fourth order."""
    n = FLATTENING / (2 - FLATTENING)
    scale = _K0 * _A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280,
    )
    return scale, alpha, 2 * math.sqrt(n) / (1 + n)


def utm(lon: Column | str, lat: Column | str, zone: int, south: bool) -> Column:
    """Easting and northing of a UTM zone by Krueger's series to the fourth order; a struct (x, y) of metres."""
    lon, lat = col(lon), col(lat)
    scale, alpha, e = utm_constants()
    phi, lam = F.radians(lat), F.radians(lon - (6 * zone - 183))
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(alpha, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return F.struct((500000 + scale * x).alias("x"), ((10_000_000 if south else 0) + scale * y).alias("y"))
