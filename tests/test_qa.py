import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.functions.raster import image_error
from tessera.operators import qa

TRIANGLE = "0.1 0.1 0.5 0.1 0.3 0.5"


def png() -> bytes:
    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\0\0\0")) + chunk(b"IEND", b"")


@pytest.fixture
def check(spark):
    def run(labels: dict[str, str], images: dict[str, bytes] | None = None, background=(), classes=2):
        images = {k: png() for k in labels} if images is None else images
        image_rows = [(f"/i/{k}.png", k, f"{k}.png", v) for k, v in images.items()]
        label_rows = [(f"/l/{k}.txt", k, f"{k}.txt", v) for k, v in labels.items()]
        empty = spark.createDataFrame([(s,) for s in background], "stem string")
        found = qa.check(
            spark.createDataFrame(image_rows, "path string, stem string, file_name string, content binary"),
            spark.createDataFrame(label_rows, "path string, stem string, file_name string, raw string"), classes, empty,
        )
        return sorted((r.image, r.issue, r.severity, r.detail) for r in found.collect())

    return run


def issues(found):
    return [f[1] for f in found]


def test_clean_dataset_has_no_finding(check):
    assert check({"a": f"0 {TRIANGLE}\n\n1 0.6 0.6 0.9 0.6 0.7 0.9\n"}) == []


def test_orphans_and_bare_images(check):
    found = check({"a": f"0 {TRIANGLE}", "c": "garbage"}, {"a": png(), "b": png()})
    assert [f[:3] for f in found] == [("b.png", "imagem_sem_label", "alta"), ("c.txt", "label_orfao", "alta")]


@pytest.mark.parametrize(
    ("line", "issue"),
    [
        (f"5 {TRIANGLE}", "classe_invalida"), (f"-1 {TRIANGLE}", "classe_invalida"), (f"99999999999999999999 {TRIANGLE}", "classe_invalida"), ("0 0.1 0.1 0.5 0.1", "poligono_degenerado"),
        ("0 0.1 0.1 0.5 0.1 0.3 0.5 0.2", "poligono_degenerado"), ("0 1.2 0.1 0.5 0.1 0.3 0.5", "coord_fora_do_range"), ("0 nan 0.1 0.5 0.1 0.3 0.5", "coord_fora_do_range"),
        ("zero um dois", "linha_malformada"), ("0 0.1 1d 0.5 0.1 0.3 0.5", "linha_malformada"), ("0 0.1 0.1 0.101 0.1 0.1 0.101", "instancia_minuscula"),
    ],
)
def test_each_defect(check, line, issue):
    assert issues(check({"a": line})) == [issue]


def test_numbers_may_be_grouped_by_underscores(check):
    assert check({"a": "0_1 .1 0.1 +0.5 1e-1 0.3 0.5"}) == []


def test_empty_label_unless_background(check):
    assert issues(check({"a": " \n\n"})) == ["label_vazio"]
    assert check({"a": ""}, background=["a"]) == []


def test_duplicates_and_conflicts_number_surviving_instances(check):
    tiny = "0 0.1 0.1 0.101 0.1 0.1 0.101"
    found = check({"a": f"{tiny}\n0 {TRIANGLE}\n0 {TRIANGLE}\n1 {TRIANGLE}"})
    assert [f[1] for f in found] == ["conflito_de_classe"] * 2 + ["instancia_duplicada", "instancia_minuscula"]
    assert found[2][3].startswith("L1 e L2")


def test_image_headers():
    assert image_error(png()) is None
    assert image_error(png()[:-6]) and image_error(b"") and image_error(b"text") and image_error(None)
    broken = bytearray(png())
    broken[20] ^= 1
    assert "checksum" in image_error(bytes(broken))


def test_headers_of_other_images():
    frame = b"\xff\xc0\x00\x0b\x08\x00\x10\x00\x20\x01\x01\x11\x00"
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab" + frame + b"\xff\xda\x00\x02data\xff\xd9"
    assert image_error(jpeg) is None and image_error(jpeg[:12]) == "JPEG truncado" and image_error(jpeg.replace(frame, b"")) == "JPEG sem dimensões"
    assert image_error(jpeg.replace(b"\x00\x10\x00\x20", bytes(4))) == "JPEG sem dimensões" and image_error(b"\xff\xd8\xff\xe0\x00\x00ab") == "JPEG com segmento inválido"
    entry = lambda tag: struct.pack("<HHII", tag, 3, 1, 9)
    tiff = b"II*\0" + struct.pack("<IH", 8, 2) + entry(256) + entry(257) + bytes(4)
    assert image_error(tiff) is None and image_error(tiff[:20]) == "TIFF truncado" and image_error(tiff.replace(entry(257), entry(259))) == "TIFF sem dimensões"
    bmp = b"BM" + struct.pack("<IHHI", 58, 0, 0, 54) + struct.pack("<I", 40) + bytes(40)
    assert image_error(bmp) is None and image_error(bmp[:30]) == "BMP inválido" and image_error(b"BM") == "BMP truncado"
    webp = b"RIFF" + struct.pack("<I", 14) + b"WEBPVP8 " + bytes(6)
    assert image_error(webp) is None and image_error(webp[:-3]) == "WEBP truncado"


def test_summary_counts(spark):
    rows = spark.createDataFrame([("a", "x", "alta", ""), ("a", "x", "alta", ""), ("b", "y", "media", "")], "image string, issue string, severity string, detail string")
    assert [tuple(r) for r in qa.summary(rows).collect()] == [("x", 2, 2), ("y", 1, 0)]


def test_like_pairs_equal_all_pairs(spark):
    import random

    rng = random.Random(4)
    boxes = []
    for i in range(120):
        x, y, w = rng.random(), rng.random(), rng.choice([0.1, 0.2, 0.21, 0.5]) * (1 + 0.02 * rng.random())
        boxes.append((i + 1, i % 3, x if i % 4 else 0.3 + 0.004 * rng.random(), y if i % 4 else 0.3, w))
    df = spark.createDataFrame(boxes, "nth int, class_id int, x double, y double, w double")
    box = F.struct(F.col("x").alias("x0"), F.col("y").alias("y0"), (F.col("x") + F.col("w")).alias("x1"), (F.col("y") + F.col("w")).alias("y1"))
    found = {(r.i, r.j) for r in qa.overlapping(df.withColumn("image", F.lit("a")).withColumn("box", box)).collect()}

    def iou(a, b):
        w = max(0, min(a[2] + a[4], b[2] + b[4]) - max(a[2], b[2]))
        h = max(0, min(a[3] + a[4], b[3] + b[4]) - max(a[3], b[3]))
        return w * h / (a[4] ** 2 + b[4] ** 2 - w * h)

    assert found == {(a[0], b[0]) for a in boxes for b in boxes if a[0] < b[0] and iou(a, b) >= 0.85} and found
