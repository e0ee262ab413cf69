import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import learning, text
from tessera.operators import crops, dedup, folds, history, review, scoring, tracker, versions
from tessera.sources import files, sinks


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- versions


def manifest(spark, items):
    return versions.scan(spark.createDataFrame(list(items.items()), "rel_path string, content string"))


def test_versions(spark):
    one = manifest(spark, {"images/a.png": "x", "labels/a.txt": "0"})
    two = manifest(spark, {"images/a.png": "x", "labels/a.txt": "1", "images/b.png": "y", "labels/b.txt": "0"})
    assert rows(versions.counts(one)) == [(1, 1, 2)]
    assert rows(versions.change_summary(versions.diff(one, two))) == [(2, 0, 1, 1)]
    assert rows(versions.diff(two, two)) == []
    names = spark.createDataFrame([("v1",), ("v12",), ("x3",), (None,)], "n string")
    assert rows(versions.next_version(names, "n")) == [(13,)] and rows(versions.next_version(names.limit(0), "n")) == [(1,)]
    log = json.loads(sinks.changelog_json(versions.diff(one, two), F.lit("v1"), F.lit("v2")).first()["json"])
    assert log["modificados"] == ["labels/a.txt"] and log["resumo"]["adicionados"] == 2
    body = json.loads(sinks.manifest_json(one, F.lit("v1"), F.lit(None).cast("string"), F.lit("t"), F.lit(None).cast("string")).first()["json"])
    assert body["count_images"] == 1 and body["note"] is None and body["files"]["labels/a.txt"]["size"] == 1


# --- folds


@pytest.mark.parametrize(("stem", "group"), [("MorroRedondo_r012_c034", "MorroRedondo"), ("a_r1_c2_r3_c4", "a_r1_c2"), ("sem_sufixo", "sem_sufixo"), ("x_r1_c", "x_r1_c")])
def test_group_key(spark, stem, group):
    assert spark.range(1).select(text.group_key(F.lit(stem))).first()[0] == group


def test_round_robin_keeps_groups_together(spark):
    items = spark.createDataFrame([(g, i) for g in "dbca" for i in range(16)], "g string, i int")
    found = folds.round_robin(items, "g", 3)
    assert found.count() == 64 and dict(rows(found.select("g", "fold").distinct())) == {"a": 0, "b": 1, "c": 2, "d": 0}
    with pytest.raises(ValueError):
        folds.round_robin(items, "g", 0)


def test_ordinals_over_many_partitions(spark):
    keys = spark.range(2000).select(F.format_string("k%05d", (F.col("id") * 7919) % 2000).alias("k"))
    found = dict(rows(folds.ordinals(keys.repartition(13), "k")))
    assert found == {f"k{i:05d}": i for i in range(2000)}


def test_gap_split(spark):
    crops_ = spark.createDataFrame([("s", float(300 * i)) for i in range(10)] + [("t", 1.0), ("t", 2.0)], "site string, p double")
    found = rows(folds.gap_split(crops_, "site", "p", 0.2, 224.0).groupBy("site", "split").count())
    assert sorted(found) == [("s", "train", 8), ("s", "val", 2), ("t", "train", 2)]


def test_gap_split_over_many_ranges(spark):
    rng = random.Random(6)
    data = [(site, round(rng.random() * 9000, 1)) for site, n in (("big", 3000), ("mid", 41), ("one", 1)) for _ in range(n)] + [(None, 5.0)] * 9
    found = folds.gap_split(spark.createDataFrame(data, "site string, p double").repartition(9), "site", "p", 0.2, 224.0).collect()
    assert len(found) == len(data)
    for site in ("big", "mid", "one", None):
        own = sorted(p for s, p in data if s == site)
        target = round(len(own) * 0.2)
        start = own[len(own) - target] if target else None
        judge = lambda p: "train" if start is None or p < start - 224 else "val" if p >= start else "gap"  # noqa: E731,B023
        assert sorted((r.p, r.split) for r in found if r.site == site) == [(p, judge(p)) for p in own]


def test_leave_one_out_and_pending(spark):
    items = spark.createDataFrame([("a",), ("a",), ("b",)], "g string")
    loo = folds.leave_one_out(items, "g")
    assert sorted(rows(loo)) == [("a", "train", 1), ("a", "val", 2), ("b", "train", 2), ("b", "val", 1)]
    done = spark.createDataFrame([("loo_a",)], "tag string")
    assert sorted(rows(folds.pending(loo, done).select("held_out").distinct())) == [("b",)]
    assert sorted(rows(folds.shares(items, "g").select("g", "n"))) == [("a", 2), ("b", 1)]


# --- scoring


def greedy_by_hand(matrix, low=0.1):
    used, ious, missed = [], [], 0
    for line in matrix:
        free = [(v, -j) for j, v in enumerate(line) if j not in used and v > 0]
        v, j = max(free, default=(0, 1))
        if v >= low:
            used.append(-j)
            ious.append(v)
        else:
            missed += 1
            ious.append(0.0)
    return used, ious, missed


def test_greedy(spark):
    rng = random.Random(1)
    cases = [[[0.3, 0.3], [0.7, 0.0]], [], [[]], [[0.05], [0.1]]]
    cases += [[[rng.choice([0.0, 0.05, 0.1, 0.4, 0.4, rng.random()]) for _ in range(p)] for _ in range(g)] for g in range(5) for p in range(5) for _ in range(4)]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, m array<array<double>>")
    for r in df.select("i", scoring.greedy("m").alias("f")).collect():
        used, ious, missed = greedy_by_hand(cases[r.i])
        assert (sorted(j for j, free in enumerate(r.f.free) if not free), list(r.f.ious), r.f.missed) == (sorted(used), ious, missed)


def test_image_signals(spark):
    images = spark.createDataFrame([("none",), ("missed",), ("ghost",), ("good",)], "image string")
    box = "struct<x0:double,y0:double,x1:double,y1:double>"
    truth = spark.createDataFrame([("missed", 1, (0.0, 0.0, 1.0, 1.0)), ("good", 1, (0.0, 0.0, 1.0, 1.0))], f"image string, idx int, box {box}")
    found = spark.createDataFrame([("ghost", 1, (0.0, 0.0, 1.0, 1.0), 0.9), ("good", 1, (0.0, 0.0, 1.0, 1.0), 0.8)], f"image string, idx int, box {box}, conf double")
    scores = scoring.score_images(images, truth, found)
    assert {r.image: (r.mean_iou, r.gt_perdidos_ratio, r.ghost_conf, r.score) for r in scores.collect()} == {
        "none": (1, 0, 0, 0), "missed": (0, 1, 0, 2), "ghost": (1, 0, 0.9, 0.9), "good": (1, 0, 0, 0),
    }
    assert [r.image for r in scoring.ranked(scoring.suspicious(scores)).collect()] == ["missed", "ghost"]


def test_queue(spark):
    findings = spark.createDataFrame([("b", "x", "alta", "1"), ("b", "w", "alta", "2"), ("c", "y", "media", "3")], "image string, issue string, severity string, detail string")
    scores = spark.createDataFrame([("a", 0.1, 0.5, 0.0, 2.0, 1, 2), ("b", 0.1, 0.5, 0.0, 3.0, 1, 2)], "image string, mean_iou double, gt_perdidos_ratio double, ghost_conf double, score double, n_gt int, n_pred int")
    queue = review.queue(findings, scores)
    assert [(r.image, r.reason, r.issues) for r in queue.collect()] == [("b", "qa_alta", ["w: 2", "x: 1"]), ("a", "xval", [])]
    assert [r.image for r in review.queue(findings, scores, 1).collect()] == ["b"]
    lines = rows(sinks.queue_lines(queue))
    assert lines[0][2] == "inf" and lines[0][3] is None and lines[0][-1] == "w: 2 | x: 1"


# --- history


def runs(spark, values):
    schema = "seq long, run_id string, version string, tag string, metrics map<string,double>, promoted boolean, ciclo long"
    return spark.createDataFrame([(i, f"r{i}", f"v{i}", None, m, True, None) for i, m in enumerate(values)], schema)


def metric(m, recall=0.5):
    return {"seg_mAP50-95": m, "seg_recall": recall}


def test_promotion(spark):
    found = history.promotion(runs(spark, [metric(0.1), metric(0.15, 0.47), metric(0.105), metric(0.3), metric(0.3), {"seg_recall": 0.5}]) .limit(5))
    assert [(r.promoted_now, r.prev_best) for r in found.orderBy("seq").collect()] == [(True, None), (False, "r0"), (False, "r1"), (True, "r1"), (False, "r3")]
    verdicts = [r.verdict_now for r in found.orderBy("seq").collect()]
    assert verdicts[0].startswith("primeiro") and "guarda" in verdicts[1] and "min_delta" in verdicts[2] and verdicts[3] == "ganho real de +0.1500 em seg_mAP50-95"


def test_report(spark):
    past = runs(spark, [metric(0.017), metric(0.089), metric(0.05)])
    r = history.report(past, 3).first()
    assert r.title == "Ciclo 3 — resumo · 3 run(s)"
    assert "| `v1` | `-` | 0.0890 | +0.0720 | ✓ |" in r.body and "**Melhor run**: `r1` — seg_mAP50-95=0.0890" in r.body
    assert "0.0170 → 0.0500  (+0.0330)" in r.body and "| `v0` | `-` | 0.0170 | — | ✓ |" in r.body
    marked = past.withColumn("ciclo", F.when(F.col("seq") > 0, 2))
    assert history.of_cycle(marked, 2).count() == 2 and history.of_cycle(marked, 7).count() == 3
    assert history.select_run(past).first().run_id == "r2" and history.select_run(past, "r0").first().run_id == "r0" and history.select_run(past, "zz").isEmpty()


def test_decimals_round_the_exact_value(spark):
    rng = random.Random(2)
    values = [0.00015, 0.12345, 0.00125, -0.00005, -0.00001, 2.5, 1e-9, 0.99995, 1e12, 123456.78905, *(rng.randrange(10**6) / 10**5 for _ in range(800)), *(rng.uniform(-3, 3) for _ in range(200)), *(k / 32 for k in range(40))]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", *(text.fixed(F.col("v"), n).alias(f"p{n}") for n in (0, 2, 4))).collect():
        assert [r.p2, r.p4] == [f"{r.v:.2f}", f"{r.v:.4f}"] and float(r.p0) == float(f"{r.v:.0f}")


def test_texts(spark):
    one = lambda c: spark.range(1).select(c.alias("v")).first()["v"]
    m = F.create_map(F.lit("seg_mAP50-95"), F.lit(0.017), F.lit("seg_recall"), F.lit(0.5))
    assert one(text.run_title(F.lit("v1"), F.lit(None).cast("string"), m)) == "v1 · run · seg_mAP50-95=0.0170"
    assert one(text.metrics_table(m)).split("\n")[2:] == ["| seg_mAP50-95 | 0.0170 |", "| seg_recall | 0.5000 |"]
    assert one(text.fixed(F.lit(0.125), 2)) == "0.12" and one(text.signed(F.lit(-0.5))) == "-0.5000"
    assert one(text.clean_tag(F.lit("a b/c"))) == "a-b-c" and one(text.mime_type(F.lit("x.JPG"))) == "image/jpeg" and one(text.mime_type(F.lit("x"))) == "application/octet-stream"
    assert one(text.file_stem(F.lit("a/b.c.txt"))) == "b.c" and one(text.extension(F.lit("a/b.TXT"))) == "txt"
    assert one(text.suspicion_reasons(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0))) == "- (motivo genérico)"
    assert "**50%**" in one(text.suspicion_reasons(F.lit(0.5), F.lit(0.6), F.lit(0.2), F.lit(2)))
    run = {k: F.lit(k) for k in ("run_id", "version", "tag", "arch", "imgsz", "seed", "epochs", "created_at", "verdict", "weights")} | {"metrics": m, "promoted": F.lit(True)}
    body = one(text.run_description(run, F.create_map(F.lit("k"), F.lit("v"))))
    assert "**Promoted**: sim" in body and body.endswith("- **k**: v")


# --- crops and learning


def test_learning(spark):
    one = lambda c: spark.range(1).select(c.alias("v")).first()["v"]
    assert one(learning.learning_rate(F.lit(0.0), 5, 50)) == pytest.approx(0.2) and one(learning.learning_rate(F.lit(50.0), 5, 50)) == pytest.approx(0)
    assert one(learning.softmax(F.array(F.lit(1000.0), F.lit(1000.0)))) == [0.5, 0.5] and one(learning.argmax(F.array(F.lit(1.0), F.lit(1.0)))) == 0
    assert one(learning.metric(F.create_map(F.lit("b"), F.lit(2.0)), "a", "b")) == 2


def test_crops(spark):
    schema = "kind string, site string, geojson_source string, polygon_id int, prob_daninha double, centroid_col double, centroid_row double, centroid_lon double, centroid_lat double"
    data = [("positive", "s", "g", i, p, 0.0, 0.0, 0.0, 0.0) for i, p in enumerate([0.55, 0.5, 0.2, 0.6, 0.9])] + [("negative", "s", "g", 9, 0.1, 0.0, 0.0, 0.0, 0.0)]
    found = crops.suspects(spark.createDataFrame(data, schema))
    assert [(r.polygon_id, r.kind) for r in crops.suspect_order(found).collect()] == [(2, "misclass"), (1, "misclass"), (0, "low_conf")]
    assert rows(crops.suspect_counts(found)) == [(3, 2, 1)] and found.columns == crops.SUSPECT
    pairs = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "t int, p int")
    assert rows(crops.confusion(pairs, "t", "p")) == [(2, 0, 1, 1, 0.75, 1.0, 0.5, pytest.approx(2 / 3))]
    assert [r.support for r in crops.class_report(pairs, "t", "p").collect()] == [2, 2]
    assert rows(crops.confusion(pairs.limit(0), "t", "p"))[0][4:] == (0.0, 0.0, 0.0, 0.0)
    weights = crops.class_weights(spark.createDataFrame([(0,)] * 99 + [(1,)], "label int"))
    assert sorted(rows(weights)) == [(0, 99, pytest.approx(100 / 198)), (1, 1, 20.0)]


def test_site_changes(spark):
    schema = "site string, basename string, exists boolean, sha256 string, n_polygons int"
    old = spark.createDataFrame([("s", "a", True, "1", 3), ("s", "b", True, "2", 1), ("s", "gone", True, "9", 1)], schema)
    new = spark.createDataFrame([("s", "a", True, "x", 5), ("s", "b", False, None, -1), ("s", "c", True, "4", 2)], schema)
    assert sorted(rows(crops.site_changes(new, old))) == [("s", "a", "modificado", 2), ("s", "b", "removido", None), ("s", "c", "novo", None)]
    assert rows(crops.polygon_total(new)) == [("s", 7)]
    assert len(spark.range(1).select(crops.site_signature(F.lit("c"), F.array(F.struct(F.lit("n").alias("basename"), F.lit(1).alias("size"), F.lit(2).alias("mtime"))))).first()[0]) == 16


def test_negatives_obey_their_predicates(spark):
    square = lambda a, b: [{"x": float(a), "y": float(a)}, {"x": float(b), "y": float(a)}, {"x": float(b), "y": float(b)}, {"x": float(a), "y": float(b)}]
    ring = "array<struct<x:double,y:double>>"
    sites = spark.createDataFrame([("s", 0.0, 0.0, 1000.0, 1000.0, 20)], "site string, x0 double, y0 double, x1 double, y1 double, n_target int")
    field = spark.createDataFrame([("s", square(0, 800))], f"site string, ring {ring}")
    weeds = spark.createDataFrame([("s", square(300, 600))], f"site string, ring {ring}")
    found = crops.negatives(crops.candidates(sites), field, weeds, 1000.0, 1000.0).collect()
    assert len(found) == 20 and all(112 <= r.x <= 800 and 112 <= r.y <= 800 and not (300 < r.x < 600 and 300 < r.y < 600) for r in found)
    outside = crops.negatives(crops.candidates(sites), field, weeds, 1000.0, 1000.0, invert=True).collect()
    assert outside and all(r.x > 800 or r.y > 800 for r in outside)


# --- files


def test_dedup(spark):
    ring = lambda *p: json.dumps([list(map(list, p))])
    a = ring((0, 0), (1, 0), (1, 1), (0, 0))
    data = [("f", 0, "Polygon", a), ("f", 1, "Polygon", ring((1e-9, 0), (1, 0), (1, 1), (0, 0))), ("f", 2, "Polygon", ring((1, 0), (1, 1), (0, 0), (1, 0))), ("g", 0, "Polygon", a), ("f", 3, "Point", "[1,2]"), ("f", 4, "Point", "[1,2]")]
    found = dedup.geojson(spark.createDataFrame(data, "file string, idx int, type string, coordinates string"))
    assert sorted((r.file, r.idx) for r in found.collect()) == [("f", 0), ("f", 2), ("f", 3), ("g", 0)]


def test_geojson_and_background(spark, tmp_path):
    feature = {"type": "Feature", "properties": {"k": 1}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [4, 0], [4, 4], [0, 0]]], [[[9, 9], [8, 9], [8, 8], [9, 9]]]]}}
    (tmp_path / "FolhaLarga.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature, {"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}))
    found = files.read_geojson(spark, str(tmp_path))
    assert [(r.idx, r.type, "CRS84" in r.crs) for r in found.orderBy("idx").collect()] == [(0, "MultiPolygon", True), (1, "Point", True)]
    from tessera.operators import tiling

    parts = tiling.polygons(found.withColumn("geometry", F.struct("type", "coordinates")))
    assert [len(r.ring) for r in parts.orderBy("part").collect()] == [3, 3]
    target = sinks.write_geojson(found, 1, str(tmp_path / "x.geojson"))
    back = files.read_geojson(spark, str(tmp_path)).where(F.col("path").contains("FolhaLarga"))
    assert back.count() == 2 and len(json.loads(spark.read.text(target, wholetext=True).first()[0])["features"]) == 2
    assert sinks.write_geojson(found, 0, "unused") is None


def test_collections_keep_their_polygons(spark, tmp_path):
    from tessera.operators import tiling

    square = lambda k: [[[k, 0], [k + 1, 0], [k + 1, 1], [k, 0]]]
    shape = lambda *ks: {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [0, 0]}, *({"type": "Polygon", "coordinates": square(k)} for k in ks)]}
    features = [{"type": "Feature", "properties": {}, "geometry": shape(*ks)} for ks in ((1, 2), (3,), (1, 2))]
    (tmp_path / "x.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    found = files.read_geojson(spark, str(tmp_path)).withColumnRenamed("path", "file")
    kept = dedup.geojson(found)
    assert sorted(r.idx for r in kept.collect()) == [0, 1]
    rings = tiling.polygons(kept.withColumn("geometry", F.struct("type", "coordinates"))).collect()
    assert sorted((r.idx, r.part, r.ring[0].x) for r in rings) == [(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0)]
    back = json.loads(spark.read.text(sinks.write_geojson(kept, 1, str(tmp_path / "y.geojson"))).first()["value"])
    assert [f["geometry"] for f in back["features"]] == [f["geometry"] for f in features[:2]]
    (tmp_path / "bg.json").write_text('{"stems": ["a", "b"]}')
    (tmp_path / "bad.json").write_text("{")
    assert sorted(rows(files.read_background(spark, str(tmp_path / "bg.json")))) == [("a",), ("b",)] and files.read_background(spark, str(tmp_path / "bad.json")).isEmpty()
    assert files.read_background(spark, str(tmp_path / "none" / "bg.json")).isEmpty()
    assert sinks.background_json(spark.createDataFrame([("b",), ("a",), ("b",)], "stem string")).first()[0] == '{"stems":["a","b"]}'


def test_history_files(spark, tmp_path):
    (tmp_path / "history.json").write_text(json.dumps([{"run_id": "a", "version": "v1", "metrics": {"seg_mAP50-95": 0.1}, "promoted": True}, {"run_id": "b"}]))
    found = files.read_history(spark, str(tmp_path / "history.json"))
    assert [(r.seq, r.run_id) for r in found.orderBy("seq").collect()] == [(0, "a"), (1, "b")] and found.orderBy("seq").first().metrics == {"seg_mAP50-95": 0.1}
    (tmp_path / "broken.json").write_text("[{")
    assert files.read_history(spark, str(tmp_path / "broken.json")).where("run_id is not null").isEmpty()
    sinks.append_history(found, str(tmp_path / "t"))
    sinks.append_history(found, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4


def test_findings_round_trip(spark, tmp_path):
    data = [("a.txt", "x", "alta", 'L1: "q", r')]
    sinks.write_findings(spark.createDataFrame(data, "image string, issue string, severity string, detail string"), str(tmp_path / "qa"))
    assert rows(files.read_findings(spark, str(tmp_path / "qa")).drop("place")) == data
    data = [(f"{k % 7}.txt", f"x{k}", "alta", "") for k in range(50)]
    found = spark.createDataFrame([(*d, k) for k, d in enumerate(data)], "image string, issue string, severity string, detail string, place int")
    sinks.write_findings(found.repartition(5), str(tmp_path / "many"))
    back = files.read_findings(spark, str(tmp_path / "many"))
    assert rows(back.orderBy("place").select("image", "issue", "severity")) == [d[:3] for d in data]
    # severe issues, and their images, in the order of the report
    queue = review.queue(back, spark.createDataFrame([], "image string, mean_iou double, gt_perdidos_ratio double, ghost_conf double, score double, n_gt int, n_pred int")).collect()
    assert [r.image for r in queue] == [f"{k}.txt" for k in range(7)] and queue[1].issues[:2] == ["x1: ", "x8: "]


def test_unreadable_labels_and_report_order(spark):
    from tessera.operators import qa

    found = files.labels_of(files.named(spark.createDataFrame([("/l/b.txt", b"9 1"), ("/l/a.txt", b"\xff\xfe"), ("/l/c.txt", b"0 x\n0 .1 .1 .5 .1 .3 zz"), ("/l/d.jpg", b"")], "path string, content binary")))
    assert found.count() == 3
    told = qa.label_findings(found, 2).orderBy("place").collect()
    assert [(r.image, r.issue) for r in told] == [("a.txt", "linha_malformada"), ("b.txt", "classe_invalida"), ("c.txt", "linha_malformada"), ("c.txt", "linha_malformada")]
    assert told[0].detail == qa.UNREADABLE and told[2].detail == "L1: linha_malformada: could not convert string to float: 'x'"


def test_fields_roles_and_confidence(spark):
    live, golden = (spark.createDataFrame([(s,) for s in names], "stem string") for names in (["b_r0_c1", "a_r0_c0"], ["a_r1_c1", "c"]))
    assert rows(files.fields(live, golden)) == [("a",), ("b",), ("c",)]
    items = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "g string, i int")
    assert sorted(rows(folds.leave_one_out_roles(items, "g").select("held_out", "i", "role"))) == [("x", 1, "val"), ("x", 2, "val"), ("x", 3, "train"), ("y", 1, "train"), ("y", 2, "train"), ("y", 3, "val")]
    assert folds.leave_one_out_roles(items, "g", ["y"]).where("role = 'val'").count() == 1
    assert scoring.confident(spark.createDataFrame([(0.25,), (0.2,)], "conf double")).count() == 1


def test_versions_leave_spark_and_archives_stay(spark, tmp_path):
    version = spark.createDataFrame([("images/a.png", b"x"), ("labels/a.txt", b"0")], "rel_path string, content binary")
    folder = f"file://{tmp_path}/v1"
    assert sorted(rows(sinks.extract(version, folder))) == [("images/a.png", True), ("labels/a.txt", True)] and (tmp_path / "v1/labels/a.txt").read_bytes() == b"0"
    assert sorted(rows(sinks.extract(version, folder))) == [("images/a.png", False), ("labels/a.txt", False)]
    kept = version.withColumnRenamed("rel_path", "path")
    for rows_ in (kept, kept.limit(1)):
        sinks.archive_files(rows_, str(tmp_path / "cycle=1"))
    assert spark.read.parquet(str(tmp_path / "cycle=1")).count() == 2
    assert "val: g" in sinks.training_config("t", "g", ["a", "b"])
    with pytest.raises(ValueError):
        sinks.training_config("t", "", ["a"])


def test_label_numbers(spark):
    labels = spark.createDataFrame([("a.txt", "a", "0 .1 .1 .2 .2 .3 .3 9\nx\n7 1 2 3 4 5 6\n0 1 2")], "file_name string, stem string, raw string")
    assert [(r.idx, r.class_id, len(r.coords)) for r in files.polygon_numbers(labels).collect()] == [(3, 7, 6)]
    assert [(r.idx, len(r.coords)) for r in files.polygon_numbers(labels, strict=False).collect()] == [(1, 6), (3, 6)]


def test_tracker(spark):
    issues = spark.createDataFrame([("Avaliado", ["run"]), ("Avaliado", []), ("?", ["run"])], "state string, labels array<string>")
    counts = tracker.state_counts(issues)
    assert [r.n for r in counts.orderBy("place").collect()] == [0, 0, 0, 0, 0, 2, 0] and tracker.ready(counts, "Avaliado", 2).count() == 1
    assert rows(tracker.labelled(issues, "run")) == [(2,)] and rows(tracker.labelled(issues, "zz", 1)) == [(1,)]


def test_watch_survives_a_failing_handler(spark, tmp_path):
    from tessera.streaming import watch

    source = spark.createDataFrame([(1, "Pronto para treino", ["lote"]), (1, "Pronto para treino", ["lote"]), (2, "Pronto para treino", []), (3, "Avaliado", ["lote"])], "id long, state string, labels array<string>")
    source.write.parquet(str(tmp_path / "in"))
    issues = watch.issue_stream(spark, str(tmp_path / "in"), source.schema)
    seen = []

    def handler(batch, number):
        seen.extend(r.id for r in batch.collect())
        raise RuntimeError("broken")

    ready = watch.ready_once(issues, "Pronto para treino", "lote")
    watch.watch(ready, handler, str(tmp_path / "c")).awaitTermination()
    watch.watch(watch.ready_once(watch.issue_stream(spark, str(tmp_path / "in"), source.schema), "Pronto para treino", "lote"), handler, str(tmp_path / "c")).awaitTermination()
    assert seen == [1]
    watch.collect_counts(issues, "state", str(tmp_path / "counts"), str(tmp_path / "c2"))
    assert sorted(rows(spark.read.parquet(str(tmp_path / "counts")))) == [("Avaliado", 1), ("Pronto para treino", 3)]


def test_flag_and_train(spark, tmp_path):
    from tests.test_qa import png

    from tessera.plans import cycle

    (tmp_path / "live/images").mkdir(parents=True)
    (tmp_path / "live/labels").mkdir()
    for stem, label in (("f_r000_c000", "0 0.1 0.1 0.5 0.1 0.3 0.5"), ("g_r000_c000", "9 0.1 0.1 0.5 0.1 0.3 0.5")):
        (tmp_path / f"live/images/{stem}.png").write_bytes(png())
        (tmp_path / f"live/labels/{stem}.txt").write_text(label)
    live = str(tmp_path / "live")
    data = cycle.Dataset(files.read_images(spark, live), files.read_labels(spark, live), 2)
    none = spark.createDataFrame([], "image string, idx int, coords array<double>, conf double")
    queue = cycle.flag(data, none).collect()
    assert [(r.image, r.reason) for r in queue] == [("g_r000_c000.txt", "qa_alta"), ("f_r000_c000.png", "xval"), ("g_r000_c000.png", "xval")]
    version, first, changes = cycle.snapshot(spark, live, str(tmp_path / "versions"))
    assert version == 1 and changes.count() == 4
    (tmp_path / "live/labels/g_r000_c000.txt").write_text("1 0.1 0.1 0.5 0.1 0.3 0.5")
    version, second, changes = cycle.snapshot(spark, live, str(tmp_path / "versions"), first)
    assert version == 2 and rows(changes) == [("labels/g_r000_c000.txt", "modificado")]

    class Fake:
        def train(self, version, golden):
            return {"seg_mAP50-95": 0.3, "seg_recall": 0.5}, "w.pt"

    past = runs(spark, [metric(0.2)])
    row = cycle.train(spark, Fake(), 2, second, second, past, {"arch": "a"}, "t/x").first()
    assert row.promoted and row.seq == 1 and row.run_id.startswith("v2_t-x_") and row.version == "v2"
    with pytest.raises(ValueError):
        cycle.train(spark, Fake(), 2, second, second.limit(0), past, {})


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("project:\n  classes: {1: b, 0: a, 10: c}\npaths:\n  live: work/live\n")
    config = files.load_config(tmp_path / "c.yaml")
    assert config.class_names == ["a", "b", "c"] and config.path("live") == str(tmp_path / "work/live")


def test_early_stop(spark):
    run = lambda values: spark.createDataFrame(list(enumerate(values)), "epoch int, f1 double")
    assert rows(history.early_stop(run([0.1, 0.3, 0.3, 0.2, 0.9]), patience=2)) == [(1, 3)]
    assert rows(history.early_stop(run([0.1, 0.3, 0.2, 0.4]), patience=2)) == [(3, 3)]


def test_tiles_and_commits(spark, tmp_path):
    for name in ("a.png", "a.jpg", "b.tif"):
        (tmp_path / name).write_bytes(b"x")
    images = files.read_images(spark, str(tmp_path))
    assert files.tile_path(images, "a").endswith("a.jpg")
    with pytest.raises(FileNotFoundError):
        files.tile_path(images, "b")
    assert files.git_commit(tmp_path / "none") is None


def test_suspicion_body(spark):
    body = text.suspicion_body(F.lit("t.png"), F.lit(1.5), F.lit(2), F.lit(3), F.lit("- r"), "m.pt", F.lit("u"))
    found = spark.range(1).select(body.alias("v")).first()["v"]
    assert found.startswith("**Tile**: `t.png`\n**Score de suspeita**: 1.500\n") and "![preview](u)" in found and found.endswith("`m.pt`")


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    from tests.test_qa import png

    from tessera import cli

    monkeypatch.setattr(cli, "_session", lambda: spark)
    for name, content in (("f_r000_c000.png", png()), ("g_r000_c000.png", png()), ("f_r000_c000.txt", b"0 0.1 0.1 0.5 0.1 0.3 0.5")):
        (tmp_path / name).write_bytes(content)
    cli.main(["qa", str(tmp_path), str(tmp_path / "qa"), "--classes", "2"])
    assert "imagem_sem_label" in capsys.readouterr().out
    cli.main(["split", str(tmp_path), str(tmp_path / "split"), "--held", "f"])
    assert sorted(rows(spark.read.parquet(str(tmp_path / "split")).select("field", "split"))) == [("f", "golden"), ("g", "live")]
    cli.main(["folds", str(tmp_path), str(tmp_path / "folds"), "--k", "2"])
    (tmp_path / "history.json").write_text(json.dumps([{"run_id": "a", "version": "v1", "tag": "loo_f", "metrics": {"seg_mAP50-95": 0.1}, "promoted": True}]))
    cli.main(["loo", str(tmp_path), str(tmp_path / "history.json")])
    assert capsys.readouterr().out.strip().endswith("g")
    cli.main(["report", str(tmp_path / "history.json")])
    assert "Melhor run" in capsys.readouterr().out
