"""Command line: python -m tessera.cli COMMAND ... Each command reads a folder or a configuration and writes a report."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.functions.text import group_key
from tessera.operators import board, dedup, folds, history, pixels, qa, review, scoring, tiling, tracker
from tessera.plans import cycle
from tessera.sources import files, sinks


def _session() -> SparkSession:
    return SparkSession.builder.appName("tessera").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _dataset(spark: SparkSession, folder: str, classes: int, background: str | None) -> cycle.Dataset:
    empty = files.read_background(spark, background) if background else None
    return cycle.Dataset(files.read_images(spark, folder), files.read_labels(spark, folder), classes, empty)


def run_qa(spark, a) -> None:
    data = _dataset(spark, a.folder, a.classes, a.background)
    findings = qa.check(data.images, data.labels, data.classes, data.background).cache()
    sinks.write_findings(findings, a.out)
    qa.summary(findings).show(truncate=False)


def run_flag(spark, a) -> None:
    """The review queue of a cycle, from predictions (image, idx, coords, conf) in Parquet."""
    data = _dataset(spark, a.folder, a.classes, a.background)
    queue = cycle.flag(data, spark.read.parquet(a.predictions), batch=a.batch)
    print(sinks.write_queue(queue, a.out, a.cycle))


def run_suspects(spark, a) -> None:
    scores = scoring.suspicious(spark.read.parquet(a.scores))
    sinks.write_scores(scoring.ranked(scores, a.top), a.out)


def run_snapshot(spark, a) -> None:
    old = spark.read.parquet(a.previous).drop("content") if a.previous else None
    version, manifest, changes = cycle.snapshot(spark, a.folder, a.versions, old)
    print(sinks.dumps(sinks.changelog_json(changes, F.lit(a.previous), F.lit(f"v{version}"))))


def run_split(spark, a) -> None:
    stems = files.read_images(spark, a.folder).select("path", group_key("stem").alias("field"))
    folds.holdout(stems, "field", a.held).write.mode("overwrite").parquet(a.out)
    folds.shares(stems, "field").orderBy("field").show(truncate=False)


def run_folds(spark, a) -> None:
    stems = files.read_images(spark, a.folder).select("path", group_key("stem").alias("field"))
    folds.round_robin(stems, "field", a.k).write.mode("overwrite").parquet(a.out)


def run_loo(spark, a) -> None:
    items = files.read_images(spark, a.folder).select(group_key("stem").alias("field"))
    print("\n".join(cycle.leave_one_out(items, "field", files.read_history(spark, a.history))))


def run_dedup(spark, a) -> None:
    features = files.read_geojson(spark, a.folder).withColumnRenamed("path", "file")
    sinks.write_deduplicated(features, dedup.geojson(features), a.out or f"{a.folder.rstrip('/')}/dedup")


def run_convert(spark, a) -> None:
    """Label lines of polygons (talhao, width, height, class_id, ring in pixels) over their tiles.

    The shares of valid pixels come from a table (talhao, x_off, y_off, valid_ratio); without it every pixel is valid.
    """
    rings = spark.read.parquet(a.rings)
    tiles = tiling.windows(rings.select("talhao", "width", "height").distinct(), a.size, a.stride)
    if a.valid:
        key = ["talhao", "x_off", "y_off"]
        tiles = tiles.join(spark.read.parquet(a.valid).select(*key, "valid_ratio"), key, "left").withColumn("valid_ratio", F.coalesce("valid_ratio", F.lit(0.0)))
    else:
        tiles = tiles.withColumn("valid_ratio", F.lit(1.0))
    tiling.label_files(tiles, tiling.tile_polygons(rings, a.size, a.stride)).write.mode("overwrite").parquet(a.out)


def run_report(spark, a) -> None:
    row = history.report(files.read_history(spark, a.history), a.cycle).first()
    print(row["title"], row["body"], sep="\n\n")


def run_promotion(spark, a) -> None:
    history.promotion(files.read_history(spark, a.history)).select("seq", "run_id", "promoted_now", "verdict_now").orderBy("seq").show(truncate=False)


def run_run(spark, a) -> None:
    history.select_run(files.read_history(spark, a.history), a.run_id).show(truncate=False)


def run_states(spark, a) -> None:
    tracker.state_counts(spark.read.parquet(a.issues)).orderBy("place").show(truncate=False)


def _trainer(name: str) -> cycle.Trainer:
    """The trainer that `module:name` makes."""
    from importlib import import_module

    module, _, made = name.partition(":")
    return getattr(import_module(module), made)()


def _setup(a) -> cycle.Setup:
    return cycle.Setup(a.folder, a.versions, a.history, a.golden, {"arch": a.arch, "seed": a.seed, "imgsz": a.imgsz, "epochs": a.epochs})


def run_watch(spark, a) -> None:
    """Handle issues that become ready, each once: freeze, train, record and tell the board, a folder of events."""
    from tessera.streaming import watch

    tracker_ = board.TableTracker(spark, a.board)
    ready = watch.ready_once(watch.board_stream(spark, a.board), a.state, a.label)
    watch.watch(ready, cycle.handle_batch(spark, tracker_, _trainer(a.trainer), _setup(a)), a.checkpoint, a.every).awaitTermination()


def run_train(spark, a) -> None:
    """Train on a version, judge it against all runs before and append it to the history."""
    data = spark.read.parquet(f"{a.versions.rstrip('/')}/version={a.version}")
    past = files.read_runs(spark, a.history)
    entry = cycle.train(spark, _trainer(a.trainer), a.version, data, files.read_files(spark, a.golden), past, _setup(a).run, a.tag)
    sinks.append_history(entry, a.history)
    entry.select("run_id", "promoted", "verdict").show(truncate=False)


def run_preview(spark, a) -> None:
    """Draw the annotations and predictions (image, coords, conf) of tiles; a table (path, image) of PNG images."""
    images = files.read_images(spark, a.folder).where(F.col("stem").isin(a.stems)) if a.stems else files.read_images(spark, a.folder)
    shape = F.struct("class_id", "coords")
    truth = files.polygon_numbers(files.read_labels(spark, a.folder), strict=False).groupBy(F.col("stem").alias("of_stem")).agg(F.collect_list(shape).alias("truth"))
    found = spark.read.parquet(a.predictions).groupBy(F.col("image").alias("of_image")).agg(F.collect_list(F.struct("coords", "conf")).alias("found"))
    tiles = images.join(truth, F.col("stem") == F.col("of_stem"), "left").join(found, F.col("file_name") == F.col("of_image"), "left")
    pixels.previews(tiles.withColumn("title", F.col("file_name"))).write.mode("overwrite").parquet(a.out)


def run_cards(spark, a) -> None:
    """Review cards for a batch: a card of the batch and one below it for each image."""
    data = _dataset(spark, a.folder, a.classes, a.background)
    queue = cycle.flag(data, spark.read.parquet(a.predictions), batch=a.batch)
    parent, cards = cycle.create_cards(queue, board.TableTracker(spark, a.board), a.cycle)
    print(parent, len(cards))


def run_suspect_cards(spark, a) -> None:
    """Cards for the worst suspicions (image, score, ..., with paths of previews where there are any)."""
    tracker_ = board.TableTracker(spark, a.board)
    rows = scoring.ranked(scoring.suspicious(spark.read.parquet(a.scores)), a.top)
    reasons = text.suspicion_reasons(F.col("gt_perdidos_ratio"), F.col("ghost_conf"), F.col("mean_iou"), F.col("n_gt"))
    body = text.suspicion_body(F.col("image"), F.col("score"), F.col("n_gt"), F.col("n_pred"), reasons, a.model)
    made = [tracker_.create_issue(r["image"], r["body"], a.state, ["suspeita"]) for r in rows.select("image", body.alias("body")).collect()]  # top rows
    print(len(made))


def run_link_run(spark, a) -> None:
    """A card of a run: the last one, or that of an id."""
    row = history.select_run(files.read_runs(spark, a.history), a.run_id)
    if row.isEmpty():
        raise SystemExit("no such run")
    run = {k: F.col(k) for k in ("run_id", "version", "tag", "arch", "imgsz", "seed", "epochs", "created_at", "metrics", "verdict", "promoted", "weights")}
    card = row.select(text.run_title(run["version"], run["tag"], run["metrics"]).alias("title"), text.run_description(run).alias("body"), text.run_state("promoted").alias("state")).first()
    print(board.TableTracker(spark, a.board).create_issue(card["title"], card["body"], card["state"], ["run"]))


def run_tiles(spark, a) -> None:
    """Cut rasters (PNG) into tiles with their valid shares, from a table of tiles (path, stem, x_off, y_off, size)."""
    rasters = files.read_files(spark, a.folder, "*.png").select("path", "content")
    pixels.tile_pixels(rasters, spark.read.parquet(a.tiles)).write.mode("overwrite").parquet(a.out)


def run_bootstrap(spark, a) -> None:
    seed = files.read_states(a.seed)["states"]
    wanted = spark.createDataFrame([(s["name"] if isinstance(s, dict) else s,) for s in seed], "state string")
    tracker.missing_states(wanted, spark.read.parquet(a.existing)).show(truncate=False)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tessera", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def add(name: str, run, *names: str, **options):
        own = commands.add_parser(name, help=run.__doc__)
        own.set_defaults(run=run)
        for n in names:
            own.add_argument(n)
        for n, settings in options.items():
            own.add_argument(f"--{n.replace('_', '-')}", **settings)

    data = {"classes": {"type": int, "required": True}, "background": {}}
    add("qa", run_qa, "folder", "out", **data)
    add("flag", run_flag, "folder", "predictions", "out", **data, cycle={"type": int, "required": True}, batch={"type": int, "default": review.BATCH})
    add("suspects", run_suspects, "scores", "out", top={"type": int, "default": 20})
    add("snapshot", run_snapshot, "folder", "versions", previous={})
    add("split", run_split, "folder", "out", held={"nargs": "+", "required": True})
    add("folds", run_folds, "folder", "out", k={"type": int, "default": 4})
    add("loo", run_loo, "folder", "history")
    add("dedup", run_dedup, "folder", out={})
    add("convert", run_convert, "rings", "out", size={"type": int, "default": tiling.TILE}, stride={"type": int, "default": tiling.STRIDE}, valid={"help": "Parquet of valid_ratio by talhao, x_off, y_off; tiles that it lacks have no valid pixel"})
    add("report", run_report, "history", cycle={"type": int})
    add("promotion", run_promotion, "history")
    add("run", run_run, "history", run_id={})
    add("states", run_states, "issues")
    training = {"trainer": {"required": True, "help": "module:name of what makes a trainer"}, "arch": {}, "seed": {"type": int}, "imgsz": {"type": int}, "epochs": {"type": int}}
    add("watch", run_watch, "folder", "versions", "history", "golden", "board", "checkpoint", state={"default": "Pronto para treino"}, label={}, every={"help": "an interval such as '300 seconds'; without it, what there is"}, **training)
    add("train", run_train, "folder", "versions", "history", "golden", version={"type": int, "required": True}, tag={}, **training)
    add("preview", run_preview, "folder", "predictions", "out", stems={"nargs": "*"})
    add("tiles", run_tiles, "folder", "tiles", "out")
    add("cards", run_cards, "folder", "predictions", "board", **data, cycle={"type": int, "required": True}, batch={"type": int, "default": review.BATCH})
    add("suspect-cards", run_suspect_cards, "scores", "board", model={"required": True}, top={"type": int, "default": 20}, state={"default": "Selecionadas"})
    add("link-run", run_link_run, "history", "board", run_id={})
    add("bootstrap", run_bootstrap, "seed", "existing")
    return top


def main(args: list[str] | None = None) -> None:
    chosen = parser().parse_args(args)
    chosen.run(_session(), chosen)


if __name__ == "__main__":
    main()
