"""The plans of a cycle, with model training and trackers behind protocols."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.functions.text import clean_tag, group_key, run_id
from tessera.operators import folds, history, qa, review, scoring, tracker, versions
from tessera.sources import files, sinks


class Predictor(Protocol):
    """A model: fitted on rows, it predicts (image, idx, box or coords, conf) for others."""

    def fit(self, train: DataFrame) -> None: ...

    def predict(self, images: DataFrame) -> DataFrame: ...


class Trainer(Protocol):
    """Trains on a version, evaluates on the golden set and gives the metrics and where the weights are."""

    def train(self, version: DataFrame, golden: DataFrame) -> tuple[dict[str, float], str]: ...


def out_of_fold(items: DataFrame, make, k: int, group: str | None = None) -> Iterator[DataFrame]:
    """For each fold the predictions of a model that never saw its groups. items has image, and stem unless a group is named."""
    items = items if group else items.withColumn("group", group_key("stem"))
    dealt = folds.round_robin(items, group or "group", k)
    for fold in range(k):
        model = make()
        model.fit(dealt.where(F.col("fold") != fold))
        yield model.predict(dealt.where(F.col("fold") == fold))


class Prototypes:
    """A predictor that needs no network: every image is said to hold the mean box of each class it was shown.

    fit takes rows (image, class_id, box); predict gives (image, idx, box, conf), the confidence being the class's share.
    """

    def __init__(self):
        self.means: DataFrame | None = None

    def fit(self, train: DataFrame) -> None:
        mean = F.struct(*(F.avg(F.col("box")[k]).alias(k) for k in ("x0", "y0", "x1", "y1")))
        by_class = train.groupBy("class_id").agg(mean.alias("box"), F.count(F.lit(1)).alias("n"))
        total = by_class.agg(F.sum("n").alias("total"))
        shares = by_class.join(F.broadcast(total))  # one row
        self.means = shares.select(F.col("class_id").alias("idx"), "box", (F.col("n") / F.col("total")).alias("conf"))

    def predict(self, images: DataFrame) -> DataFrame:
        few = self.means.agg(F.collect_list(F.struct("idx", "box", "conf")).alias("means"))  # a row for all classes
        return images.select("image").distinct().join(F.broadcast(few)).select("image", F.inline("means"))


@dataclass(frozen=True)
class Dataset:
    """A live dataset: images and labels as sources.files reads them, and its number of classes."""

    images: DataFrame
    labels: DataFrame
    classes: int
    background: DataFrame | None = None


def flag(data: Dataset, predictions: DataFrame, limits: scoring.Thresholds = scoring.Thresholds(), batch: int = review.BATCH, matrix=None) -> DataFrame:
    """The review queue: severe findings first, then images whose annotations the model disputes.

    predictions has image, idx, coords, conf; those below the least confidence do not count. Checking, scoring, thresholds, ranking and the limit are one plan.
    """
    from tessera.functions.raster import mask_iou_matrix

    findings = qa.check(data.images, data.labels, data.classes, data.background)
    by_stem = data.images.select(F.col("stem").alias("of_stem"), F.col("file_name").alias("image"))
    truth = files.polygon_numbers(data.labels).join(by_stem, F.col("stem") == F.col("of_stem")).select("image", "idx", "coords")
    images = data.images.select(F.col("file_name").alias("image"))
    scores = scoring.score_images(images, truth, scoring.confident(predictions), "coords", matrix or mask_iou_matrix)
    return review.queue(findings, scoring.suspicious(scores, limits), batch)


def version_numbers(spark: SparkSession, versions_dir: str) -> list[int]:
    """The versions there are, by the names of their folders; their files are not listed."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(versions_dir)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in store.listStatus(where)] if store.exists(where) else []
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version=") and n.removeprefix("version=").isdigit())


def snapshot(spark: SparkSession, live: str, versions_dir: str, previous: DataFrame | None = None) -> tuple[int, DataFrame, DataFrame]:
    """Freeze a folder: (version, its manifest, changes since the previous manifest).

    Content, digest and size are written by one pass over the files, without a shuffle.
    """
    found = files.read_files(spark, live).withColumn("rel_path", files.relative(F.col("path"), live))
    known = version_numbers(spark, versions_dir)
    version = max(known, default=0) + 1
    path = sinks.write_version(found.select(*versions.scan_columns(), "content"), versions_dir, version)
    manifest = spark.read.parquet(path).drop("content")
    old = previous if previous is not None else manifest.limit(0)
    return version, manifest, versions.diff(old, manifest)


def train(spark: SparkSession, trainer: Trainer, version: int, data: DataFrame, golden: DataFrame, past: DataFrame, setup: dict, tag: str | None = None, rule: history.Promotion = history.Promotion()) -> DataFrame:
    """Train on a version and give its history row, promoted or not against the best of all runs before."""
    if golden.isEmpty():
        raise ValueError("the golden set is missing")
    metrics, weights = trainer.train(data, golden)
    entry = spark.createDataFrame([(f"v{version}", tag, setup.get("arch"), setup.get("seed"), setup.get("imgsz"), setup.get("epochs"), metrics, weights)], "version string, tag string, arch string, seed long, imgsz long, epochs long, metrics map<string,double>, weights string")
    entry = entry.withColumn("tag", clean_tag("tag")).withColumn("run_id", run_id(F.col("version"), F.col("tag"))).withColumn("created_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"))
    last = past.agg(F.coalesce(F.max("seq"), F.lit(-1)).alias("last"))
    entry = entry.join(F.broadcast(last)).withColumn("seq", F.col("last") + 1).drop("last")  # one row
    row = entry.first()  # fixes the random run id
    entry = spark.createDataFrame([row], entry.schema)
    both = past.select("seq", "run_id", "metrics").unionByName(entry.select("seq", "run_id", "metrics"))
    judged = history.promotion(both, rule).where(F.col("seq") == row["seq"]).select(F.col("promoted_now").alias("promoted"), F.col("verdict_now").alias("verdict"))
    return entry.join(F.broadcast(judged))  # one row


def leave_one_out(items: DataFrame, group: str, past: DataFrame) -> list[str]:
    """The groups that still lack a run as the held-out one, in order; there are as many as fields."""
    left = folds.pending(folds.leave_one_out(items, group).select("held_out").distinct(), past)
    return [r["held_out"] for r in left.orderBy("held_out").collect()]


def create_cards(queue: DataFrame, board: tracker.Tracker, number: int, state: str = "Selecionadas", labels: tuple[str, ...] = ("lote", "ciclo")) -> tuple[str, list[str]]:
    """A card of the batch and one below it for each image; a batch is bounded by what people review."""
    rows = queue.select("image", text.review_title(F.col("image")).alias("title"), text.review_body(F.col("image"), F.col("reason"), {k: F.col(k) for k in review.COLUMNS[2:8]}, F.col("issues")).alias("body")).collect()
    parent = board.create_issue(f"Lote ciclo {number}", f"Lote gerado por run_cycle flag. Total: {len(rows)} imagens.", state, list(labels))
    return parent, [board.create_issue(r["title"], r["body"], state, [], parent) for r in rows]


@dataclass(frozen=True)
class Setup:
    """Where a cycle's data lie, and how its runs are described."""

    live: str
    versions: str
    history: str
    golden: str
    run: dict


def handle_ready(spark: SparkSession, board: tracker.Tracker, trainer: Trainer, setup: Setup, issue: str, tag: str) -> DataFrame:
    """What a batch that is ready for training sets off: claim, freeze, tell, train, record, tell, move on.

    The history is a folder of Parquet; its rows are the runs, and the new one is returned.
    """
    board.move(issue, "Em treinamento")
    known = version_numbers(spark, setup.versions)
    previous = spark.read.parquet(f"{setup.versions.rstrip('/')}/version={known[-1]}").drop("content") if known else None
    version, _, changes = snapshot(spark, setup.live, setup.versions, previous)
    log = sinks.dumps(sinks.changelog_json(changes, F.lit(f"v{known[-1]}" if known else None), F.lit(f"v{version}")))
    board.comment(issue, text.snapshot_comment(f"v{version}", log))
    data = spark.read.parquet(f"{setup.versions.rstrip('/')}/version={version}")
    past = files.read_runs(spark, setup.history)
    entry = train(spark, trainer, version, data, files.read_files(spark, setup.golden), past, setup.run, tag)
    sinks.append_history(entry, setup.history)
    told = entry.select(text.run_comment(*(F.col(c) for c in ("run_id", "version", "metrics", "promoted", "verdict"))).alias("body")).first()["body"]
    board.comment(issue, told)
    board.move(issue, "Avaliado")
    return entry


def handle_batch(spark: SparkSession, board: tracker.Tracker, trainer: Trainer, setup: Setup):
    """A handler of streaming.watch: each issue of a batch in turn; one that fails is logged and counts as processed."""
    import logging

    def handle(batch: DataFrame, _: int) -> None:
        for row in batch.select(F.col("id").cast("string").alias("id")).collect():  # issues that became ready since the last batch
            try:
                handle_ready(spark, board, trainer, setup, row["id"], row["id"])
            except Exception:
                logging.getLogger(__name__).exception("issue %s failed", row["id"])

    return handle


def crop_audit(crops: DataFrame, fit, checkpoint: str | None = None, fraction: float = 0.2, gap: float = 224.0) -> dict[str, DataFrame]:
    """The audit of crops (site, centroid_col, label, features, ...): split, weights, training, report and suspects.

    fit(train, val, weights, checkpoint) gives a function that adds prob_daninha and pred to crops; head.fit is one.
    """
    from tessera.operators import crops as C

    dealt = folds.gap_split(crops, "site", "centroid_col", fraction, gap)
    own, held = dealt.where("split = 'train'"), dealt.where("split = 'val'")
    weights = C.class_weights(own)
    predict = fit(own, held, weights, checkpoint)
    judged = predict(held)
    suspects = C.suspects(predict(crops))
    return {"weights": weights, "confusion": C.confusion(judged, "label", "pred"), "report": C.class_report(judged, "label", "pred"), "suspects": C.suspect_order(suspects), "counts": C.suspect_counts(suspects)}
