"""What needs arrays of pixels or general polygons: Arrow functions in numpy."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

MASK = 256
RING = ArrayType(StructType([StructField("x", DoubleType()), StructField("y", DoubleType())]))


def polygon_mask(coords: np.ndarray, size: int = MASK) -> np.ndarray:
    """Boolean mask of a polygon with coordinates in [0, 1], boundary pixels included."""
    mask = np.zeros((size, size), bool)
    pts = np.trunc(np.asarray(coords, np.float64).reshape(-1, 2) * size).astype(np.int64)
    if not len(pts):
        return mask
    x, y = pts.T
    x2, y2 = np.roll(x, -1), np.roll(y, -1)
    for row in range(max(0, y.min()), min(size - 1, y.max()) + 1):  # interior by even-odd crossings of the row
        hits = (y <= row) != (y2 <= row)
        cross = np.sort(x[hits] + (row - y[hits]) * (x2[hits] - x[hits]) / (y2[hits] - y[hits]))
        for a, b in zip(cross[0::2], cross[1::2], strict=False):
            low, high = max(0, int(np.ceil(a))), min(size - 1, int(np.floor(b)))
            if low <= high:
                mask[row, low : high + 1] = True
    for a, b, c, d in zip(x, y, x2, y2, strict=True):  # and the edges
        n = int(max(abs(c - a), abs(d - b))) + 1
        xs, ys = np.rint(np.linspace(a, c, n)).astype(int), np.rint(np.linspace(b, d, n)).astype(int)
        inside = (xs >= 0) & (xs < size) & (ys >= 0) & (ys < size)
        mask[ys[inside], xs[inside]] = True
    return mask


def mask_iou(one: np.ndarray, other: np.ndarray) -> float:
    union = np.logical_or(one, other).sum()
    return float(np.logical_and(one, other).sum() / union) if union else 0.0


@F.pandas_udf(ArrayType(ArrayType(DoubleType())))
def mask_iou_matrix(truth: pd.Series, found: pd.Series) -> pd.Series:
    """IoU of every polygon of one list with every polygon of another, each a flat array of coordinates."""

    def matrix(a, b) -> list[list[float]]:
        a, b = [polygon_mask(p) for p in a], [polygon_mask(p) for p in b]
        return [[mask_iou(p, q) for q in b] for p in a]

    return pd.Series([matrix(a, b) for a, b in zip(truth, found, strict=True)])


# --- clipping to a rectangle


def _cut(ring: list[tuple[float, float]], axis: int, at: float, above: bool) -> list[tuple[float, float]]:
    """The part of a ring on one side of an axis-parallel line; parts that fall apart stay joined along the line."""
    out: list[tuple[float, float]] = []
    inside = lambda p: p[axis] >= at if above else p[axis] <= at
    for k, q in enumerate(ring):
        p = ring[k - 1]
        if inside(p) != inside(q):
            t = (at - p[axis]) / (q[axis] - p[axis])
            cross = (p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1]))
            out.append((at, cross[1]) if axis == 0 else (cross[0], at))
        if inside(q):
            out.append(q)
    return out


def _parts(ring: list[tuple[float, float]], axis: int, at: float) -> list[list[tuple[float, float]]]:
    """Split a ring that was cut along a line where it runs along that line: crossings pair off in order."""
    on = [k for k in range(len(ring)) if ring[k][axis] == at]
    if len(on) < 3:
        return [ring]
    # chains of points off the line, each with its end points on the line
    first = on[0]
    order = [ring[(first + k) % len(ring)] for k in range(len(ring) + 1)]
    chains, chain = [], order[:1]
    for p in order[1:]:
        chain.append(p)
        if p[axis] == at:
            if len(chain) > 2:
                chains.append(chain)
            chain = [p]
    # chains whose spans on the line nest or are apart; a chain inside another cuts a notch into it
    span = lambda c: tuple(sorted((c[0][1 - axis], c[-1][1 - axis])))
    chains.sort(key=lambda c: (span(c)[0], -span(c)[1]))
    out: list[list[list[tuple[float, float]]]] = []
    stack: list[tuple[float, int, int]] = []
    for c in chains:
        low, high = span(c)
        while stack and stack[-1][0] <= low:
            stack.pop()
        depth = len(stack)
        if depth % 2 and stack:
            out[stack[-1][1]].append(c)
            stack.append((high, stack[-1][1], depth))
        else:
            out.append([c])
            stack.append((high, len(out) - 1, depth))
    rings = []
    for group in out:
        outer, *notches = group
        if outer[0][1 - axis] > outer[-1][1 - axis]:
            outer = outer[::-1]
        ring_out = list(outer)
        for notch in sorted(notches, key=span, reverse=True):
            notch = notch if notch[0][1 - axis] > notch[-1][1 - axis] else notch[::-1]
            ring_out += notch
        rings.append(ring_out)
    return rings


def _ring_area(ring: list[tuple[float, float]]) -> float:
    x, y = np.asarray(ring, np.float64).T
    return float(abs((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2)


def clip_ring(ring: list[tuple[float, float]], x0: float, y0: float, x1: float, y1: float) -> list[list[tuple[float, float]]]:
    """The parts of a simple polygon within a rectangle, as separate rings of positive area."""
    rings = [list(ring)]
    for axis, at, above in ((0, x0, True), (0, x1, False), (1, y0, True), (1, y1, False)):
        cut = (_cut(r, axis, at, above) for r in rings)
        rings = [part for r in cut if len(r) >= 3 for part in _parts(r, axis, at)]
    return [r for r in rings if len(r) >= 3 and _ring_area(r) > 0]


@F.pandas_udf(ArrayType(RING))
def clip(ring: pd.Series, x0: pd.Series, y0: pd.Series, x1: pd.Series, y1: pd.Series) -> pd.Series:
    """clip_ring over columns."""
    rows = zip(ring, x0, y0, x1, y1, strict=True)
    return pd.Series([
        [[{"x": x, "y": y} for x, y in part] for part in clip_ring([(p["x"], p["y"]) for p in r], a, b, c, d)] for r, a, b, c, d in rows
    ])


# --- rings and images


def is_simple(ring: list[tuple[float, float]]) -> bool:
    """Whether no two edges of a ring cross."""
    n = len(ring)
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    for i in range(n):
        a, b = ring[i], ring[(i + 1) % n]
        for j in range(i + 2, n):
            if i == 0 and j == n - 1:
                continue
            c, d = ring[j], ring[(j + 1) % n]
            if turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0:
                return False
    return True


def repair_ring(ring: list[tuple[float, float]]) -> list[tuple[float, float]] | None:
    """Without repeated vertices; a ring that crosses itself becomes the loop of largest area; null if nothing is left."""
    ring = [p for k, p in enumerate(ring) if p != ring[k - 1]] if len(ring) > 1 else []
    if len(ring) < 3:
        return None
    n = len(ring)
    for i in range(n):
        for j in range(i + 2, n - (i == 0)):
            a, b, c, d = ring[i], ring[(i + 1) % n], ring[j], ring[(j + 1) % n]
            det = (b[0] - a[0]) * (d[1] - c[1]) - (b[1] - a[1]) * (d[0] - c[0])
            if det == 0:
                continue
            t = ((c[0] - a[0]) * (d[1] - c[1]) - (c[1] - a[1]) * (d[0] - c[0])) / det
            u = ((c[0] - a[0]) * (b[1] - a[1]) - (c[1] - a[1]) * (b[0] - a[0])) / det
            if 0 < t < 1 and 0 < u < 1:
                at = (a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1]))
                loops = [repair_ring([at, *ring[i + 1 : j + 1]]), repair_ring([at, *ring[j + 1 :], *ring[: i + 1]])]
                return max((x for x in loops if x), key=_ring_area, default=None)
    return ring if _ring_area(ring) > 0 else None


@F.pandas_udf(RING)
def repair(ring: pd.Series) -> pd.Series:
    found = (None if r is None else repair_ring([(p["x"], p["y"]) for p in r]) for r in ring)
    return pd.Series([None if r is None else [{"x": x, "y": y} for x, y in r] for r in found])


def _jpeg_error(content: bytes) -> str | None:
    """Segments up to the scan, which must come after a frame header with a size."""
    at, sized = 2, False
    while at + 4 <= len(content) and content[at] == 0xFF:
        kind, size = content[at + 1], int.from_bytes(content[at + 2 : at + 4], "big")
        if kind == 0xFF:  # padding
            at += 1
            continue
        if kind == 0xDA:
            return None if sized else "JPEG sem dimensões"
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            frame = content[at + 5 : at + 9]
            sized = len(frame) == 4 and 0 < int.from_bytes(frame[:2], "big") and 0 < int.from_bytes(frame[2:], "big")
        if size < 2:
            return "JPEG com segmento inválido"
        at += 2 + size
    return "JPEG truncado"


def _tiff_error(content: bytes) -> str | None:
    """The first directory lies within the file and names width and height."""
    order = "little" if content[:2] == b"II" else "big"
    number = lambda at, n: int.from_bytes(content[at : at + n], order)
    first = number(4, 4)
    if first < 8 or first + 2 > len(content) or first + 2 + 12 * number(first, 2) > len(content):
        return "TIFF truncado"
    tags = {number(first + 2 + 12 * k, 2) for k in range(number(first, 2))}
    return None if {256, 257} <= tags else "TIFF sem dimensões"


def _bmp_error(content: bytes) -> str | None:
    """The header names a place for the pixels within the file."""
    if len(content) < 26:
        return "BMP truncado"
    return None if 14 < int.from_bytes(content[10:14], "little") <= len(content) and int.from_bytes(content[14:18], "little") >= 12 else "BMP inválido"


def image_error(content: bytes | None) -> str | None:
    """Why a file is no readable image, or null: PNG by the checksums of its chunks, others by the structure of their headers."""
    content = content or b""
    if content.startswith(b"\x89PNG\r\n\x1a\n"):
        at, kinds = 8, []
        while at + 12 <= len(content):
            size, kind = struct.unpack(">I4s", content[at : at + 8])
            body = content[at + 4 : at + 8 + size]
            if at + 12 + size > len(content):
                return "PNG truncado"
            if zlib.crc32(body) != struct.unpack(">I", content[at + 8 + size : at + 12 + size])[0]:
                return f"PNG com checksum inválido em {kind.decode('latin-1')}"
            kinds.append(kind)
            at += 12 + size
            if kind == b"IEND":
                break
        return None if kinds[:1] == [b"IHDR"] and kinds[-1:] == [b"IEND"] else "PNG incompleto"
    for begins, judge in ((b"\xff\xd8\xff", _jpeg_error), (b"II*\0", _tiff_error), (b"MM\0*", _tiff_error), (b"BM", _bmp_error)):
        if content.startswith(begins):
            return judge(content)
    if content.startswith(b"RIFF") and content[8:12] == b"WEBP":
        return None if len(content) >= 20 and len(content) >= 8 + int.from_bytes(content[4:8], "little") else "WEBP truncado"
    return "formato de imagem não identificado"


@F.pandas_udf(StringType())
def image_problem(content: pd.Series) -> pd.Series:
    return content.map(image_error)
