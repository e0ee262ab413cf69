"""The queue of images for review."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH = 40
# fixed values: the columns of a batch; its reasons are qa_alta and xval
COLUMNS = ["image", "reason", "score", "mean_iou", "gt_perdidos_ratio", "ghost_conf", "n_gt", "n_pred", "issues"]


def severe(findings: DataFrame) -> DataFrame:
    """image, issues, place: the severe findings of each image as texts, in the order of the report, and where the first stands.

    Findings that bear no place stand by their text.
    """
    text = F.concat("issue", F.lit(": "), F.coalesce("detail", F.lit("")))
    at = F.col("place") if "place" in findings.columns else text
    told = findings.where("severity = 'alta'").groupBy("image").agg(F.array_sort(F.collect_list(F.struct(at.alias("place"), text.alias("text")))).alias("all"))
    return told.select("image", F.transform("all", lambda s: s["text"]).alias("issues"), F.col("all")[0]["place"].alias("place"))


def queue(findings: DataFrame, suspicions: DataFrame, batch: int = BATCH) -> DataFrame:
    """Images with severe findings first, in the order of the report, then suspicions by score that are not queued yet, up to a batch."""
    first = severe(findings)
    at = dict(first.dtypes)["place"] if "place" in findings.columns else "string"
    none = lambda kind: F.lit(None).cast(kind)
    qa = first.select(
        F.lit(0).alias("priority"), "image", F.lit("qa_alta").alias("reason"), F.lit(float("inf")).alias("score"), none("double").alias("mean_iou"),
        none("double").alias("gt_perdidos_ratio"), none("double").alias("ghost_conf"), none("int").alias("n_gt"), none("int").alias("n_pred"), "issues",
        (F.col("place") if "place" in findings.columns else F.lit(None).cast("string")).alias("place"),
    )
    rest = suspicions.join(first.select(F.col("image").alias("of_image")), F.col("image") == F.col("of_image"), "left_anti")
    rest = rest.select(
        F.lit(1).alias("priority"), "image", F.lit("xval").alias("reason"), "score", "mean_iou", "gt_perdidos_ratio", "ghost_conf", "n_gt", "n_pred",
        F.array().cast("array<string>").alias("issues"), none(at).alias("place"),
    )
    both = qa.unionByName(rest)
    return both.orderBy("priority", F.desc("score"), "place", "image").limit(batch).select(*COLUMNS)
