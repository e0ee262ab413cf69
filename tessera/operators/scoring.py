"""Disagreement between annotations and predictions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import geometry as G
from tessera.functions.geometry import col, let

IOU_LOW, CONF_LEAST = 0.1, 0.25


@dataclass(frozen=True)
class Thresholds:
    mean_iou_below: float = 0.55
    missed_above: float = 0.34
    ghost_above: float = 0.70


def greedy(matrix: Column | str, low: float = IOU_LOW) -> Column:
    """Greedy one-to-one matching over an IoU matrix: a struct (free, ious, missed).

    Each annotation, in order, takes the free prediction of the largest IoU, the first on a tie; below `low` it is missed
    and leaves the prediction free. free has a flag a prediction, so a step costs by the predictions only.
    """
    def step(acc: Column, row: Column) -> Column:
        cells = F.zip_with(row, acc["free"], lambda v, free: F.struct(v.alias("v"), free.alias("free")))
        cells = F.transform(cells, lambda c, j: F.struct(F.when(c["free"], c["v"]).alias("v"), (-j).alias("before")))
        best = F.array_max(F.filter(cells, lambda c: c["v"] > 0))  # the first of equal ones is the greatest -j

        def place(b: Column) -> Column:
            taken = F.coalesce(b["v"] >= low, F.lit(False))
            return F.struct(
                F.transform(acc["free"], lambda f, j: f & ~(taken & (j == -b["before"]))).alias("free"),
                F.array_append(acc["ious"], F.when(taken, b["v"]).otherwise(0.0)).alias("ious"),
                (acc["missed"] + F.when(taken, 0).otherwise(1)).alias("missed"),
            )

        return let(best, place)

    def matched(m: Column) -> Column:
        free = F.transform(F.coalesce(F.get(m, F.lit(0)), F.array().cast("array<double>")), lambda _: F.lit(True))
        start = F.struct(free.alias("free"), F.array().cast("array<double>").alias("ious"), F.lit(0).alias("missed"))
        return F.aggregate(m, start, step)

    return let(col(matrix), matched)


def signals(match: Column, n_gt: Column, confs: Column) -> Column:
    """A struct (mean_iou, gt_perdidos_ratio, ghost_conf, score) of one image."""
    n = n_gt.cast("double")
    mean = F.when(n_gt > 0, G.total(match["ious"]) / n).otherwise(1.0)
    missed = F.when(n_gt > 0, match["missed"] / n).otherwise(0.0)
    # without annotations there is no matrix, and every prediction is free
    free = F.when(n_gt > 0, F.zip_with(confs, match["free"], lambda c, free: F.when(free, c))).otherwise(confs)
    ghost = F.coalesce(F.array_max(free), F.lit(0.0))
    return F.struct(mean.alias("mean_iou"), missed.alias("gt_perdidos_ratio"), ghost.alias("ghost_conf"), ((1 - mean) + missed + ghost).alias("score"))


def box_matrix(truth: Column, found: Column) -> Column:
    return F.transform(truth, lambda a: F.transform(found, lambda b: G.box_iou(a, b)))


def by_image(rows: DataFrame, image: str, order: str, values: list[str], name: str) -> DataFrame:
    """(of_image, name): the values of each image's rows as an array in order. An image's rows are few."""
    gathered = F.array_sort(F.collect_list(F.struct(F.col(order), *values)))
    return rows.groupBy(F.col(image).alias(f"of_{name}")).agg(gathered.alias(name))


def confident(predictions: DataFrame, least: float = CONF_LEAST) -> DataFrame:
    """Predictions that a model would show: of at least that confidence."""
    return predictions.where(F.col("conf") >= least)


def score_images(images: DataFrame, truth: DataFrame, found: DataFrame, value: str = "box", matrix=box_matrix) -> DataFrame:
    """Suspicion of each image, from truth (image, idx, value) and found (image, idx, value, conf).

    matrix(truth values, found values) gives the IoU matrix: of boxes by default, of masks by raster.mask_iou_matrix.
    """
    gt = by_image(truth, "image", "idx", [value], "gt")
    pred = by_image(found, "image", "idx", [value, "conf"], "pred")
    both = images.select("image").join(gt, F.col("image") == F.col("of_gt"), "left").join(pred, F.col("image") == F.col("of_pred"), "left")
    gt_type, pred_type = dict(gt.dtypes)["gt"], dict(pred.dtypes)["pred"]
    both = both.select("image", F.coalesce("gt", F.array().cast(gt_type)).alias("gt"), F.coalesce("pred", F.array().cast(pred_type)).alias("pred"))
    both = both.withColumn("m", matrix(F.transform("gt", lambda s: s[value]), F.transform("pred", lambda s: s[value])))
    both = both.withColumn("n_gt", F.size("gt")).withColumn("n_pred", F.size("pred")).withColumn("match", greedy("m"))
    both = both.withColumn("s", signals(F.col("match"), F.col("n_gt"), F.transform("pred", lambda s: s["conf"])))
    return both.select("image", "s.*", "n_gt", "n_pred")


def suspicious(scores: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    strict = (F.col("mean_iou") < limits.mean_iou_below) | (F.col("gt_perdidos_ratio") > limits.missed_above) | (F.col("ghost_conf") > limits.ghost_above)
    return scores.where(strict)


def ranked(scores: DataFrame, top: int | None = None) -> DataFrame:
    out = scores.orderBy(F.desc("score"), "image")
    return out.limit(top) if top is not None else out
