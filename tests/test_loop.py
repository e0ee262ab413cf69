"""Pixels, the board, the ready-batch handler, and the head that audits crops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import png
from tessera.operators import board, pixels
from tessera.plans import cycle, head
from tests.test_cycle import rows


def image(seed, height=40, width=50, bands=3):
    return np.random.default_rng(seed).integers(0, 256, (height, width, bands)).astype(np.uint8)


def filtered(pixels_, kind):
    """A PNG whose rows all have one filter, written plainly."""
    import struct
    import zlib

    height, width, bands = pixels_.shape
    flat, body = pixels_.reshape(height, -1).astype(int), b""
    for r in range(height):
        line = [kind]
        for k in range(width * bands):
            left = flat[r, k - bands] if k >= bands else 0
            up = flat[r - 1, k] if r else 0
            corner = flat[r - 1, k - bands] if r and k >= bands else 0
            p = left + up - corner
            paeth = min(((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner)))[2]
            line.append((flat[r, k] - [0, left, up, (left + up) // 2, paeth][kind]) % 256)
        body += bytes(line)
    part = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    colour = {1: 0, 2: 4, 3: 2, 4: 6}[bands]
    return png.SIGNATURE + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)) + part(b"IDAT", zlib.compress(body)) + part(b"IEND", b"")


@pytest.mark.parametrize("bands", [1, 2, 3, 4])
def test_png_round_trip(bands):
    one = image(1, bands=bands)
    assert (png.decode(png.encode(one, {"Title": "é"})) == one).all()
    assert all((png.decode(filtered(one, kind)) == one).all() for kind in range(5))
    with pytest.raises(ValueError):
        png.decode(b"x")


def test_tiles_and_crops(spark):
    one = image(2, 100, 120, 4)
    one[:, :, 3] = 255 * (np.arange(120) < 70)
    rasters = spark.createDataFrame([("r", bytearray(png.encode(one)))], "path string, content binary")
    tiles = spark.createDataFrame([("r", "a", 0, 0, 64), ("r", "b", 56, 36, 64)], "path string, stem string, x_off int, y_off int, size int")
    found = {r.stem: r for r in pixels.tile_pixels(rasters, tiles).collect()}
    assert (png.decode(bytes(found["b"].image)) == one[36:100, 56:120, :3]).all()
    assert found["a"].valid_ratio == 1 and found["b"].valid_ratio == pytest.approx(14 / 64)
    points = spark.createDataFrame([("r", 1, 50.4, 60.6), ("r", 2, 0.0, 0.0)], "path string, crop long, column double, row double")
    crops = {r.crop: png.decode(bytes(r.image)) for r in pixels.crop_pixels(rasters, points, 20).collect()}
    assert (crops[1] == one[51:71, 40:60]).all() and not crops[2][:10, :10].any() and (crops[2][10:, 10:] == one[:10, :10]).all()


def test_previews(spark):
    tile = np.full((64, 64, 3), 200, np.uint8)
    square = [0.2, 0.2, 0.8, 0.2, 0.8, 0.8, 0.2, 0.8]
    tiles = spark.createDataFrame([("t", bytearray(png.encode(tile)), [(0, square)], [([0.5, 0.5, 0.9, 0.5, 0.9, 0.9], 0.75)], "título")], "path string, content binary, truth array<struct<class_id:int,coords:array<double>>>, found array<struct<coords:array<double>,conf:double>>, title string")
    drawn = png.decode(bytes(pixels.previews(tiles).first().image))
    assert drawn.shape == (76, 64, 3) and not drawn[:12].any()
    assert tuple(drawn[12 + 13, 30]) == pixels.COLOURS[0] and (drawn[12 + 20, 20] != 200).any() and (drawn == pixels.PREDICTED).all(2).sum() > 60
    assert (drawn[12 + 3, 3] == 200).all()


def test_board(spark, tmp_path):
    own = board.TableTracker(spark, str(tmp_path / "board"))
    assert own.issue_table().count() == 0
    lote = own.create_label("lote")
    assert own.create_label("lote") == lote and own.labels() == {"lote": lote}
    one = own.create_issue("t", "b", "Selecionadas", ["lote", "unknown"])
    two = own.create_issue("u", "b", "Selecionadas", [], one)
    own.move(two, "Avaliado")
    own.comment(two, "c")
    assert [(r["id"], r["labels"]) for r in own.issues("Selecionadas", "lote")] == [(one, ["lote"])] and own.issues("Avaliado")[0]["parent"] == one
    with pytest.raises(ValueError):
        own.move(one, "?")
    (tmp_path / "x.png").write_bytes(b"abc")
    place = own.upload(str(tmp_path / "x.png"), "image/png")
    assert spark.read.format("binaryFile").load(place).first().content == b"abc" and own.events().where("kind = 'upload'").count() == 1


class Fake:
    def train(self, version, golden):
        assert version.count() and golden.count()
        return {"seg_mAP50-95": 0.3, "seg_recall": 0.5}, "w.pt"


class Broken:
    def train(self, version, golden):
        raise RuntimeError("no")


def test_ready_batches_are_handled_once(spark, tmp_path):
    from tessera.sources import files
    from tessera.streaming import watch

    for folder in ("live/labels", "golden"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "a.txt").write_text("0")
    own = board.TableTracker(spark, str(tmp_path / "board"))
    first = own.create_issue("t", "b", "Pronto para treino", [])
    setup = cycle.Setup(str(tmp_path / "live"), str(tmp_path / "versions"), str(tmp_path / "history"), str(tmp_path / "golden"), {"arch": "a"})
    go = lambda trainer: watch.watch(watch.ready_once(watch.board_stream(spark, own.folder), "Pronto para treino"), cycle.handle_batch(spark, own, trainer, setup), str(tmp_path / "c")).awaitTermination()
    go(Fake())
    go(Fake())
    assert files.read_runs(spark, setup.history).select("promoted", "version").collect() == [(True, "v1")]
    told = [r.body for r in own.events().where("kind = 'comment'").orderBy("at").collect()]
    assert len(told) == 2 and "**snapshot criado:** `v1`" in told[0] and "- **seg_mAP50-95:** 0.3000" in told[1] and "✔ promovido — primeiro run" in told[1]
    assert [r["id"] for r in own.issues("Avaliado")] == [first]
    second = own.create_issue("u", "b", "Pronto para treino", [])
    go(Broken())
    go(Fake())  # a failed issue counts as handled
    assert [r["id"] for r in own.issues("Em treinamento")] == [second] and cycle.version_numbers(spark, setup.versions) == [1, 2]


def test_cards_of_a_batch(spark, tmp_path):
    own = board.TableTracker(spark, str(tmp_path / "board"))
    own.create_label("lote")
    schema = "image string, reason string, score double, mean_iou double, gt_perdidos_ratio double, ghost_conf double, n_gt int, n_pred int, issues array<string>"
    queue = spark.createDataFrame([("a", "qa_alta", float("inf"), None, None, None, None, None, ["x: 1"]), ("b", "xval", 1.5, 0.5, 0.25, 0.75, 2, 3, [])], schema)
    parent, cards = cycle.create_cards(queue, own, 7)
    bodies = {r.issue: r.body for r in own.events().where("kind = 'issue'").collect()}
    assert bodies[cards[0]] == "**imagem:** `a`\n**motivo:** qa_alta\n**achados QA:**\n- x: 1"
    assert bodies[cards[1]].endswith("ghost_conf: 0.7500\nn_gt: 2 · n_pred: 3") and "Total: 2 imagens" in bodies[parent]


@pytest.fixture(scope="module")
def crops(spark):
    rng = random.Random(2)
    made = []
    for i in range(160):
        label = i % 2
        pixels_ = np.clip(np.random.default_rng(i).normal(110 + 40 * label, 30, (28, 28, 3)), 0, 255).astype(np.uint8)
        made.append((f"s{i % 2}", "positive" if label else "negative", "g", i, label, 300.0 * i + rng.random(), 0.0, 0.0, 0.0, bytearray(png.encode(pixels_))))
    schema = "site string, kind string, geojson_source string, polygon_id long, label int, centroid_col double, centroid_row double, centroid_lon double, centroid_lat double, image binary"
    return head.with_features(spark.createDataFrame(made, schema)).drop("image").cache()


def test_head_resumes_where_it_was_cut_off(spark, crops, tmp_path):
    weights = spark.createDataFrame([(0, 1.0), (1, 1.0)], "label int, weight double")
    recipe = head.Recipe(epochs=4, warmup=1, patience=9)
    whole = head.train(crops, crops, weights, None, recipe)
    path = str(tmp_path / "state.json")
    head.train(crops, crops, weights, path, recipe, stop_after=2)
    assert (tmp_path / "state.json").exists()
    resumed = head.train(crops, crops, weights, path, recipe)
    assert np.allclose(whole.weights, resumed.weights) and not (tmp_path / "state.json").exists()
    assert head.learning_rate(recipe, 0) == recipe.rate and head.f1(np.asarray([[3, 1], [1, 3]])) == 0.75


def test_audit_of_crops(spark, crops, tmp_path):
    sites = crops.withColumn("site", F.lit("s"))
    found = cycle.crop_audit(sites, head.fit, str(tmp_path / "c.json"))
    assert found["confusion"].first()["f1"] > 0.9 and found["weights"].count() == 2
    assert found["suspects"].count() == rows(found["counts"])[0][0]
    judged = cycle.crop_audit(sites.withColumn("label", 1 - F.col("label")).withColumn("kind", F.lit("positive")), head.fit)
    assert judged["suspects"].count() >= 70 and judged["suspects"].first().kind == "misclass"


def test_commands_of_the_loop(spark, tmp_path, capsys, monkeypatch):
    import json

    from tessera import cli
    from tessera.sources import files

    monkeypatch.setattr(cli, "_session", lambda: spark)
    tile, path = png.encode(np.full((32, 32, 3), 90, np.uint8)), lambda name: str(tmp_path / name)
    for name, content in (("live/f_r0_c0.png", tile), ("live/f_r0_c0.txt", b"0 0.1 0.1 0.6 0.1 0.3 0.6"), ("live/g_r0_c0.txt", b"9 0"), ("golden/a.txt", b"0"), ("rasters/r.png", tile)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    spark.createDataFrame([("f_r0_c0.png", 1, [0.1, 0.1, 0.6, 0.1, 0.3, 0.6], 0.9), ("f_r0_c0.png", 2, [0.5, 0.5, 0.9, 0.5, 0.9, 0.9], 0.1)], "image string, idx int, coords array<double>, conf double").write.parquet(path("predictions"))
    cli.main(["snapshot", path("live"), path("versions")])
    training = ["--trainer", "tests.test_loop:Fake", "--arch", "a"]
    cli.main(["train", path("live"), path("versions"), path("history"), path("golden"), "--version", "1", "--tag", "x y", *training])
    assert files.read_runs(spark, path("history")).first().tag == "x-y"
    cli.main(["preview", path("live"), path("predictions"), path("previews"), "--stems", "f_r0_c0"])
    assert png.decode(bytes(spark.read.parquet(path("previews")).first().image)).shape == (44, 32, 3)
    own = board.TableTracker(spark, path("board"))
    for label in ("lote", "ciclo", "suspeita", "run"):
        own.create_label(label)
    cli.main(["cards", path("live"), path("predictions"), path("board"), "--classes", "2", "--cycle", "3"])
    assert capsys.readouterr().out.strip().endswith(" 1") and "label_orfao" in " ".join(r.body for r in own.events().where("kind = 'issue'").collect())
    scores = "image string, score double, mean_iou double, gt_perdidos_ratio double, ghost_conf double, n_gt int, n_pred int"
    spark.createDataFrame([("a.png", 1.5, 0.2, 0.5, 0.8, 2, 1), ("b.png", 0.1, 0.9, 0.0, 0.0, 1, 1)], scores).write.parquet(path("scores"))
    cli.main(["suspect-cards", path("scores"), path("board"), "--model", "m"])
    cli.main(["link-run", path("history"), path("board")])
    assert [r["labels"] for r in own.issues("Aprovado")] == [["run"]] and len(own.issues("Selecionadas", "suspeita")) == 1
    spark.createDataFrame([("x",)], "path string").crossJoin(files.read_files(spark, path("rasters")).select("path").withColumnRenamed("path", "p")).selectExpr("p as path", "'s' as stem", "0 as x_off", "0 as y_off", "16 as size").write.parquet(path("tiles"))
    cli.main(["tiles", path("rasters"), path("tiles"), path("cut")])
    assert spark.read.parquet(path("cut")).first().valid_ratio == 1
    own.create_issue("t", "b", "Pronto para treino", [])
    cli.main(["watch", path("live"), path("versions"), path("history"), path("golden"), path("board"), path("checkpoint"), *training])
    assert files.read_runs(spark, path("history")).count() == 2 and len(own.issues("Avaliado")) == 1
    feature = {"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [1, 2]}}
    (tmp_path / "geo").mkdir()
    (tmp_path / "geo/x.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature, feature]}))
    (tmp_path / "geo/y.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature]}))
    cli.main(["dedup", path("geo"), "--out", path("deduplicated")])
    kept = list((tmp_path / "deduplicated").glob("file=*/*.txt"))
    assert [p.parent.name for p in kept] == ["file=x.dedup.geojson"] and len(json.loads(kept[0].read_text())["features"]) == 1
