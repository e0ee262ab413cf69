import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import geometry as G
from tessera.functions.raster import clip_ring, is_simple, mask_iou, polygon_mask, repair_ring
from tessera.operators import tiling


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def ring(*points):
    return F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points))


SQUARE = ((0, 0), (4, 0), (4, 4), (0, 4))


def test_area_box_centroid(spark):
    assert value(spark, G.area(ring(*SQUARE))) == 16
    assert tuple(value(spark, G.bbox(ring(*SQUARE)))) == (0, 0, 4, 4)
    assert tuple(value(spark, G.centroid(ring(*SQUARE)))) == (2, 2)
    assert tuple(value(spark, G.centroid(ring((1, 1), (1, 1))))) == (1, 1)


def test_box_iou(spark):
    box = lambda *v: F.struct(*(F.lit(float(x)).alias(k) for k, x in zip(G.BOX, v, strict=True)))
    assert value(spark, G.box_iou(box(0, 0, 2, 2), box(1, 0, 3, 2))) == pytest.approx(1 / 3)
    assert value(spark, G.box_iou(box(0, 0, 0, 0), box(0, 0, 0, 0))) == 0
    assert value(spark, G.boxes_touch(box(0, 0, 2, 2), box(2, 2, 3, 3))) and not value(spark, G.boxes_touch(box(0, 0, 2, 2), box(2.1, 2, 3, 3)))


@pytest.mark.parametrize(("length", "starts"), [(500, [0]), (1024, [0]), (1025, [0, 1]), (2000, [0, 896, 976]), (1500, [0, 476]), (1920, [0, 896])])
def test_tile_starts(spark, length, starts):
    assert value(spark, G.tile_starts(F.lit(length), 1024, 896)) == starts


def test_tile_starts_need_positive_sizes():
    with pytest.raises(ValueError):
        G.tile_starts(F.lit(10), 0, 5)


def test_windows(spark):
    rows = tiling.windows(spark.createDataFrame([("f", 2000, 2000)], "talhao string, width int, height int")).collect()
    assert len(rows) == 9 and {r.stem for r in rows} >= {"f_r000_c000", "f_r002_c002"}


def test_label_line(spark):
    line = lambda pts, x, y, size: value(spark, G.label_line(F.lit(1), G.normalise(ring(*pts), F.lit(float(x)), F.lit(float(y)), F.lit(float(size)))))
    assert line([(100, 100), (1100, 100), (100, 1100)], 100, 100, 1000) == "1 0.000000 0.000000 1.000000 0.000000 0.000000 1.000000"
    assert line([(-1, 0), (10, 11), (5, 5)], 0, 0, 10) == "1 0.000000 0.000000 1.000000 1.000000 0.500000 0.500000"
    assert line([(0, 0), (1, 1)], 0, 0, 10) is None


def test_pixels_and_open_rings(spark):
    t = F.array(*(F.lit(v) for v in (0.5, 0.0, 100.0, 0.0, -0.5, 200.0)))
    assert [tuple(p) for p in value(spark, G.to_pixel(ring((101, 199), (100, 200)), t))] == [(2, 2), (0, 0)]
    assert len(value(spark, G.open_ring(ring(*SQUARE, SQUARE[0])))) == 4
    assert value(spark, G.open_ring(ring((0, 0), (1, 1), (0, 0)))) is None


def test_point_in_ring(spark):
    inside = lambda x, y: value(spark, G.contains_point(ring((0, 0), (4, 0), (4, 4), (2, 1), (0, 4)), F.lit(float(x)), F.lit(float(y))))
    assert inside(1, 0.5) and inside(0.5, 2) and not inside(2, 3) and not inside(5, 1)


def test_utm(spark):
    """The central meridian, a quarter of a degree beside it, and symmetry."""
    at = lambda lon, lat: value(spark, G.utm(F.lit(lon), F.lit(lat), 25, True))
    p = at(-33.0, 0.0)
    assert p.x == pytest.approx(500000, abs=1e-6) and p.y == pytest.approx(10_000_000, abs=1e-6)
    assert at(-33.0, -8.0).y == pytest.approx(10_000_000 - 0.9996 * meridian(8.0), abs=1e-3)
    assert at(-32.0, -8.0).x - 500000 == pytest.approx(500000 - at(-34.0, -8.0).x, abs=1e-6)


def meridian(degrees: float) -> float:
    """Length of the meridian from the equator, by summing small steps."""
    a, f = 6378137.0, 1 / 298.257222101
    e2 = f * (2 - f)
    phi = np.radians((np.arange(200_000) + 0.5) * degrees / 200_000)
    return float((a * (1 - e2) / (1 - e2 * np.sin(phi) ** 2) ** 1.5).sum() * math.radians(degrees) / 200_000)


def test_masks():
    half = polygon_mask(np.asarray([0, 0, 0.5, 0, 0.5, 0.99, 0, 0.99]))
    assert half.sum() == 129 * 254 and mask_iou(half, half) == 1 and mask_iou(half, np.zeros_like(half)) == 0
    assert polygon_mask(np.asarray([0.5, 0.5])).sum() == 1 and mask_iou(np.zeros((2, 2)), np.zeros((2, 2))) == 0


def area(ring):
    x, y = np.asarray(ring, float).T
    return abs((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2


def test_clip_splits_parts():
    comb = [(0, 0), (10, 0), (10, 10), (8, 10), (8, 2), (6, 2), (6, 10), (4, 10), (4, 2), (2, 2), (2, 10), (0, 10)]
    parts = clip_ring(comb, 0, 5, 10, 10)
    assert sorted(round(area(p), 6) for p in parts) == [10, 10, 10]
    assert clip_ring(comb, 20, 20, 30, 30) == [] and area(clip_ring(comb, -5, -5, 20, 20)[0]) == area(comb)


def test_clip_area_equals_sampling():
    rng = random.Random(2)
    for _ in range(60):
        k = rng.randint(3, 12)
        turn = sorted(rng.random() * 2 * math.pi for _ in range(k))
        reach = [rng.uniform(1, 5) for _ in turn]
        star = [(5 + r * math.cos(t), 5 + r * math.sin(t)) for r, t in zip(reach, turn, strict=True)]
        if not is_simple(star):
            continue
        parts = clip_ring(star, 2, 3, 7, 6)
        xs, ys = np.meshgrid(np.linspace(2, 7, 500, endpoint=False) + 0.005, np.linspace(3, 6, 300, endpoint=False) + 0.005)
        inside = np.zeros(xs.shape, bool)
        for (x1, y1), (x2, y2) in zip(star, star[1:] + star[:1], strict=True):
            with np.errstate(divide="ignore", invalid="ignore"):
                inside ^= ((y1 > ys) != (y2 > ys)) & (xs < (x2 - x1) * (ys - y1) / (y2 - y1) + x1)
        assert sum(map(area, parts)) == pytest.approx(inside.mean() * 15, abs=0.12)


def test_repair():
    bow = [(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 2.0)]
    fixed = repair_ring(bow)
    assert not is_simple(bow) and is_simple(fixed) and area(fixed) > 2
    assert repair_ring([(0.0, 0.0), (0.0, 0.0), (1.0, 1.0)]) is None
    assert repair_ring(list(map(lambda p: (float(p[0]), float(p[1])), SQUARE))) is not None


def test_class_names(spark):
    rows = spark.createDataFrame([("DaninhasFolhaLargaSul",), ("folha2",), ("Mamonas",), ("outro",)], "name string")
    found = tiling.match_class(rows, "name", {"Folha": 0, "FolhaLarga": 1, "Mamona": 2, "mamona": 3}).collect()
    assert [r.class_id for r in found] == [1, 0, 2, None]


def test_pairs(spark):
    paths = ["r/A/imagem/a.tif", "r/A/b.tif", "r/A/daninhas/FolhaLarga.geojson", "r/A/Mamona.geojson", "r/B/b.tif", "r/C/Mamona.geojson", "r/C/x.geojson"]
    rows = {r.talhao: r for r in tiling.pairs(spark.createDataFrame([(p,) for p in paths], "path string"), {"FolhaLarga": 0, "Mamona": 2}).collect()}
    assert rows["A"].tif_path == paths[0] and [tuple(g) for g in rows["A"].geojsons] == [(0, paths[2])] and rows["A"].is_complete
    assert not rows["B"].is_complete and not rows["C"].is_complete and len(rows["C"].geojsons) == 1


def test_tile_polygons_cover_areas(spark):
    """The parts of a ring in disjoint tiles add up to the ring."""
    r = ring((10, 10), (190, 30), (120, 180), (60, 90))
    rows = spark.range(1).select(F.lit("f").alias("talhao"), F.lit(1).alias("class_id"), F.lit(200).alias("width"), F.lit(200).alias("height"), r.alias("ring"))
    found = tiling.tile_polygons(rows, 50, 50, 0.0).agg(F.sum("area").alias("a")).first()["a"]
    assert found == pytest.approx(value(spark, G.area(r)))


def test_convert_drops_tiles_by_validity(spark, tmp_path):
    from tessera import cli

    r = ring((10, 10), (190, 30), (120, 180), (60, 90))
    rows = spark.range(1).select(F.lit("f").alias("talhao"), F.lit(1).alias("class_id"), F.lit(200).alias("width"), F.lit(200).alias("height"), r.alias("ring"))
    rows.write.parquet(f"{tmp_path}/rings")
    valid = [("f", x, y, 0.4 if x else 0.6) for x in (0, 100) for y in (0, 100)]
    spark.createDataFrame(valid, "talhao string, x_off int, y_off int, valid_ratio double").write.parquet(f"{tmp_path}/valid")
    found = []
    for more in ([], ["--valid", f"{tmp_path}/valid"]):
        a = cli.parser().parse_args(["convert", f"{tmp_path}/rings", f"{tmp_path}/out", "--size", "100", "--stride", "100", *more])
        a.run(spark, a)
        found.append(sorted(r.stem for r in spark.read.parquet(f"{tmp_path}/out").collect()))
    assert {s[-4:] for s in found[0]} == {"c000", "c001"} and found[1] == [s for s in found[0] if s.endswith("c000")]


def test_label_files_keep_background_by_hash(spark):
    tiles = spark.createDataFrame([("f", 0, 0, "f_r000_c000", 1.0), ("f", 9, 0, "f_r000_c001", 0.4), ("f", 18, 0, "f_r000_c002", 0.9)], "talhao string, x_off int, y_off int, stem string, valid_ratio double")
    pieces = spark.createDataFrame([("f", 0, 0, "1 0 0"), ("f", 9, 0, "1 1 1")], "talhao string, x_off int, y_off int, line string")
    every = {r.stem: r.background for r in tiling.label_files(tiles, pieces, 1.0).collect()}
    assert every == {"f_r000_c000": False, "f_r000_c002": True}
    assert [r.stem for r in tiling.label_files(tiles, pieces, 0.0).collect()] == ["f_r000_c000"]
