"""Tiles over rasters, polygons over tiles, and sources of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import geometry as G
from tessera.functions.raster import clip, repair
from tessera.functions.text import tile_stem

TILE, STRIDE = 1024, 896
LEAST_VALID, LEAST_AREA, KEEP_EMPTY = 0.5, 1e-4, 0.05


def windows(rasters: DataFrame, size: int = TILE, stride: int = STRIDE) -> DataFrame:
    """The tile windows of rasters (talhao, width, height): adds row, col, x_off, y_off, size and stem."""
    out = rasters.select("*", F.posexplode(G.tile_starts("height", size, stride)).alias("row", "y_off"))
    out = out.select("*", F.posexplode(G.tile_starts("width", size, stride)).alias("col", "x_off")).withColumn("size", F.lit(size))
    return out.withColumn("stem", tile_stem(F.col("talhao"), F.col("row"), F.col("col")))


def match_class(names: DataFrame, name: str, classes: dict[str, int]) -> DataFrame:
    """Adds class_id: of the keys a name contains, whatever the case, the longest, the first of equal ones; else null."""
    found = F.lit(None).cast("int")
    by_length = sorted(classes.items(), key=lambda item: -len(item[0]))
    for key, class_id in reversed(by_length):  # the longest is tested first
        found = F.when(F.contains(F.lower(F.col(name)), F.lit(key.lower())), F.lit(class_id)).otherwise(found)
    return names.withColumn("class_id", found)


def pairs(files: DataFrame, classes: dict[str, int]) -> DataFrame:
    """talhao, tif_path, geojsons array of (class_id, path), is_complete, from paths `<talhao>/...`.

    Rasters in imagem/ and polygons in daninhas/ come before those beside them; the first raster in order counts; a
    polygon file whose name matches no class is left out.
    """
    parts = F.split("path", "/")
    own = files.withColumn("depth", F.size(parts)).withColumn("name", F.element_at(parts, -1)).withColumn("folder", F.try_element_at(parts, F.lit(-2)))
    nested = F.col("folder").isin("imagem", "daninhas")
    own = own.withColumn("talhao", F.when(nested, F.try_element_at(parts, F.lit(-3))).otherwise(F.col("folder"))).withColumn("flat", F.when(nested, 0).otherwise(1))
    kind = F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1))
    tif = own.where(kind.isin("tif", "tiff") & (F.col("folder") != "daninhas")).groupBy("talhao").agg(F.min_by("path", F.struct("flat", "path")).alias("tif_path"))
    geo = match_class(own.where((kind == "geojson") & (F.col("folder") != "imagem")), "name", classes)
    best = geo.groupBy("talhao").agg(F.min("flat").alias("best")).withColumnRenamed("talhao", "of_talhao")
    geo = geo.join(best, (F.col("talhao") == F.col("of_talhao")) & (F.col("flat") == F.col("best"))).where("class_id is not null")
    geo = geo.groupBy(F.col("talhao").alias("of_geo")).agg(F.array_sort(F.collect_list(F.struct("class_id", "path"))).alias("geojsons"))
    both = tif.join(geo, F.col("talhao") == F.col("of_geo"), "full_outer")
    none = F.array().cast("array<struct<class_id:int,path:string>>")
    both = both.select(F.coalesce("talhao", "of_geo").alias("talhao"), "tif_path", F.coalesce("geojsons", none).alias("geojsons"))
    return both.withColumn("is_complete", F.col("tif_path").isNotNull() & (F.size("geojsons") > 0))


def polygons(features: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Exterior rings of Polygon and MultiPolygon features and of a collection's Polygons, one row a part.

    geometry is a struct (type, coordinates text); a GeometryCollection has its geometries as text there.
    """
    kind = F.col(f"{geometry}.type")
    point = "array<double>"
    one = F.from_json(F.col(f"{geometry}.coordinates"), f"array<array<{point}>>")
    many = F.from_json(F.col(f"{geometry}.coordinates"), f"array<array<array<{point}>>>")
    members = F.from_json(F.col(f"{geometry}.coordinates"), "array<struct<type:string,coordinates:string>>")
    own = F.transform(F.filter(members, lambda m: m["type"] == "Polygon"), lambda m: F.get(F.from_json(m["coordinates"], f"array<array<{point}>>"), F.lit(0)))
    parts = F.when(kind == "GeometryCollection", own).when(kind == "Polygon", F.array(F.get(one, F.lit(0)))).when(kind == "MultiPolygon", F.transform(many, lambda p: F.get(p, F.lit(0))))
    out = features.select("*", F.posexplode(parts).alias("part", "exterior"))
    ring = F.transform("exterior", lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    return out.withColumn("ring", G.open_ring(ring)).drop("exterior")


def load_polygons(features: DataFrame, zone: int | None = None, south: bool = True) -> DataFrame:
    """Repaired rings of features (path, crs, idx, type, coordinates), each with the index of its feature.

    With a zone, degrees become metres of that UTM zone; other named systems are taken as metres already. Rings that are
    empty after the repair go.
    """
    out = polygons(features.withColumn("geometry", F.struct("type", "coordinates"))).where("ring is not null")
    if zone is not None:
        metres = F.transform("ring", lambda p: G.utm(p["x"], p["y"], zone, south))
        out = out.withColumn("ring", F.when(F.col("crs").rlike("CRS84$|4326$"), metres).otherwise(F.col("ring")))
    return out.withColumn("ring", repair("ring")).where("ring is not null").drop("geometry")


def cells(box: Column, width: Column, height: Column, size: int, stride: int) -> tuple[Column, Column]:
    """Arrays of the window starts, by x and by y, whose windows a box may touch."""
    def near(starts: Column, low: Column, high: Column) -> Column:
        return F.filter(starts, lambda s: (s <= high) & (s + size >= low))

    return near(G.tile_starts(width, size, stride), box["x0"], box["x1"]), near(G.tile_starts(height, size, stride), box["y0"], box["y1"])


def tile_polygons(rings: DataFrame, size: int = TILE, stride: int = STRIDE, least_area: float = LEAST_AREA) -> DataFrame:
    """Parts of polygons within each tile they touch, with slivers dropped and rings normalised to the tile.

    rings has talhao, width, height, class_id and ring in pixels. Each polygon names the tiles that its box touches, so no
    tile meets a polygon that is elsewhere.
    """
    out = rings.withColumn("box", G.bbox("ring"))
    xs, ys = cells(F.col("box"), F.col("width"), F.col("height"), size, stride)
    out = out.withColumn("x_off", F.explode(xs)).withColumn("y_off", F.explode(ys))
    edge = lambda c: F.col(c).cast("double")
    out = out.withColumn("clipped", clip("ring", edge("x_off"), edge("y_off"), edge("x_off") + size, edge("y_off") + size))
    out = out.select("talhao", "class_id", "x_off", "y_off", F.posexplode("clipped").alias("piece", "ring"))
    out = out.withColumn("area", G.area("ring")).where(F.col("area") >= least_area * size * size)
    normal = G.normalise("ring", F.col("x_off"), F.col("y_off"), F.lit(float(size)))
    return out.withColumn("ring", normal).withColumn("line", G.label_line(F.col("class_id"), F.col("ring")))


def label_files(tiles: DataFrame, pieces: DataFrame, keep_empty: float = KEEP_EMPTY, seed: int = 42, least_valid: float = LEAST_VALID) -> DataFrame:
    """talhao, stem, lines, background for the tiles that stay.

    tiles has talhao, x_off, y_off, stem and valid_ratio. Empty tiles stay by a hash of stem and seed, so the choice does
    not depend on the order in which tiles are visited.
    """
    lines = pieces.groupBy(F.col("talhao").alias("of_talhao"), F.col("x_off").alias("of_x"), F.col("y_off").alias("of_y")).agg(F.array_sort(F.collect_list("line")).alias("lines"))
    good = tiles.where(F.col("valid_ratio") >= least_valid)
    both = good.join(lines, (F.col("talhao") == F.col("of_talhao")) & (F.col("x_off") == F.col("of_x")) & (F.col("y_off") == F.col("of_y")), "left")
    both = both.withColumn("background", F.col("lines").isNull())
    stay = ~F.col("background") | (hash_share("stem", seed) <= keep_empty)
    return both.where(stay).select("talhao", "stem", F.coalesce("lines", F.array().cast("array<string>")).alias("lines"), "background")


def hash_share(key: str, seed: int) -> Column:
    """A number in [0, 1) that depends on key and seed only: the first 8 hexadecimal digits of a digest."""
    digits = F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"), 256), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / 2.0**32
