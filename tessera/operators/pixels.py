"""Pixels of rasters: tile windows, centred crops, previews. A raster is decoded once, where it is read, by Arrow batches."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import png
from tessera.functions.raster import polygon_mask

CROP = 224
Decoder = Callable[[bytes], np.ndarray]
# fixed values: the colours of the classes in order, and of predictions
COLOURS, PREDICTED = [(60, 180, 75), (0, 130, 200), (245, 130, 48), (145, 30, 180)], (230, 25, 75)
# fixed values: digits and the point as five rows of three pixels
DIGITS = {
    "0": "75557", "1": "26227", "2": "71747", "3": "71717", "4": "55711", "5": "74717", "6": "74757", "7": "71111", "8": "75757", "9": "75717", ".": "00002",
}


def window(pixels: np.ndarray, x_off: int, y_off: int, size: int) -> np.ndarray:
    """A window of a raster; what lies beyond the raster is not there."""
    return pixels[y_off : y_off + size, x_off : x_off + size]


def valid_ratio(pixels: np.ndarray) -> float:
    """The share of pixels that the alpha band shows; 1 without one."""
    return float((pixels[..., -1] > 0).mean()) if pixels.shape[2] in (2, 4) and pixels.size else 1.0


def centred(pixels: np.ndarray, column: float, row: float, size: int = CROP) -> np.ndarray:
    """A square around the rounded centre, zero beyond the raster."""
    out = np.zeros((size, size, pixels.shape[2]), pixels.dtype)
    x, y = round(column) - size // 2, round(row) - size // 2
    x0, y0, x1, y1 = max(x, 0), max(y, 0), min(x + size, pixels.shape[1]), min(y + size, pixels.shape[0])
    if x0 < x1 and y0 < y1:
        out[y0 - y : y1 - y, x0 - x : x1 - x] = pixels[y0:y1, x0:x1]
    return out


def _cut(rasters: DataFrame, places: DataFrame, columns: list[str], cut, schema: str, decode: Decoder) -> DataFrame:
    """Rows (path, *columns, made by cut) for the places of each raster; a raster's places travel to it as one array."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    wanted = places.groupBy(F.col("path").alias("of_path")).agg(F.collect_list(F.struct(*columns)).alias("places"))
    both = rasters.select("path", "content").join(wanted, F.col("path") == F.col("of_path")).select("path", "content", "places")
    kept = StructType([places.schema["path"], *(places.schema[c] for c in columns)])
    whole = StructType(kept.fields + StructType.fromDDL(schema).fields)
    arrow = to_arrow_schema(whole)

    def run(batches):
        for batch in batches:
            for path, content, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pixels = decode(content)
                for at in range(0, len(places), 32):
                    rows = [(path, *p.values(), *cut(pixels, p)) for p in places[at : at + 32]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], names=arrow.names)

    return both.mapInArrow(run, whole)


def tile_pixels(rasters: DataFrame, tiles: DataFrame, decode: Decoder = png.decode) -> DataFrame:
    """path, stem, x_off, y_off, size, valid_ratio, image of the tiles (path, stem, x_off, y_off, size) of rasters (path, content).

    image is a PNG without the alpha band.
    """

    def cut(pixels: np.ndarray, p: dict) -> tuple[float, bytes]:
        part = window(pixels, p["x_off"], p["y_off"], p["size"])
        shown = part[..., : part.shape[2] - (part.shape[2] in (2, 4))]
        return valid_ratio(part), png.encode(shown)

    return _cut(rasters, tiles, ["stem", "x_off", "y_off", "size"], cut, "valid_ratio double, image binary", decode)


def crop_pixels(rasters: DataFrame, points: DataFrame, size: int = CROP, decode: Decoder = png.decode) -> DataFrame:
    """path, crop, column, row, image of the squares around points (path, crop, column, row) of rasters (path, content)."""
    return _cut(rasters, points, ["crop", "column", "row"], lambda pixels, p: (png.encode(centred(pixels, p["column"], p["row"], size)),), "image binary", decode)


def _edge(coords: list[float], height: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a polygon's outline on an image."""
    x, y = np.asarray(coords, float).reshape(-1, 2).T * [[width - 1], [height - 1]]
    rows, columns = [], []
    for a, b, c, d in zip(x, y, np.roll(x, -1), np.roll(y, -1), strict=True):
        n = int(max(abs(c - a), abs(d - b))) + 1
        columns.append(np.rint(np.linspace(a, c, n)).astype(int))
        rows.append(np.rint(np.linspace(b, d, n)).astype(int))
    rows, columns = np.concatenate(rows), np.concatenate(columns)
    inside = (rows >= 0) & (rows < height) & (columns >= 0) & (columns < width)
    return rows[inside], columns[inside]


def _number(pixels: np.ndarray, text: str, row: int, column: int) -> None:
    for k, letter in enumerate(text):
        for r, bits in enumerate(DIGITS[letter]):
            for c in range(3):
                at = row + r, column + 4 * k + c
                if int(bits) >> (2 - c) & 1 and 0 <= at[0] < pixels.shape[0] and 0 <= at[1] < pixels.shape[1]:
                    pixels[at] = PREDICTED


def preview(tile: bytes, truth: list[tuple[int, list[float]]], found: list[tuple[list[float], float]], title: str | None = None, decode: Decoder = png.decode) -> bytes:
    """A tile as PNG with annotations (class, coordinates) filled and outlined by class, and predictions (coordinates,
    confidence) outlined in red with their confidence beside the first point. A title stands above as a bar and as the image's text.
    """
    pixels = decode(tile)[..., :3]
    pixels = np.repeat(pixels, 3, axis=2) if pixels.shape[2] < 3 else pixels.copy()
    height, width = pixels.shape[:2]
    for class_id, coords in truth:
        colour = np.asarray(COLOURS[class_id % len(COLOURS)])
        mask = polygon_mask(np.asarray(coords), 256)[np.arange(height)[:, None] * 256 // height, np.arange(width)[None, :] * 256 // width]
        pixels[mask] = (0.7 * pixels[mask] + 0.3 * colour).astype(np.uint8)
        pixels[_edge(coords, height, width)] = colour
    for coords, conf in found:
        pixels[_edge(coords, height, width)] = PREDICTED
        _number(pixels, f"{conf:.2f}", int(coords[1] * (height - 1)) - 7, int(coords[0] * (width - 1)))
    if title is None:
        return png.encode(pixels)
    return png.encode(np.concatenate([np.zeros((12, width, 3), np.uint8), pixels]), {"Title": title})


def previews(tiles: DataFrame, decode: Decoder = png.decode) -> DataFrame:
    """path, image of tiles (path, content, truth array of (class_id, coords), found array of (coords, conf), title)."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            drawn = [preview(content, [(t["class_id"], t["coords"]) for t in truth or []], [(f["coords"], f["conf"]) for f in found or []], title, decode) for _, content, truth, found, title in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(drawn, pa.binary())], names=["path", "image"])

    return tiles.select("path", "content", "truth", "found", "title").mapInArrow(run, "path string, image binary")
