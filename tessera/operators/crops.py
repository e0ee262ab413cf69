"""Audit of image crops: sampling, weights, metrics, suspects, and changes of source files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions import geometry as G
from tessera.functions.learning import class_weight

CROP = 224
LOW_CONF = 0.6
# fixed values: the columns of the crop report, and its classes
SUSPECT = ["kind", "site", "geojson_source", "polygon_id", "true_class", "pred_class", "prob_daninha", "prob_cultivo", "centroid_lon", "centroid_lat", "centroid_col", "centroid_row"]
CLASSES = ["cultivo", "daninha"]


def usable(polygons: DataFrame, least_pixels: float = 25.0) -> DataFrame:
    """Polygons (ring in pixels, width, height) whose centroid lies in the raster and whose box has enough pixels."""
    out = polygons.withColumn("centroid", G.centroid("ring")).withColumn("box", G.bbox("ring"))
    within = lambda c: (c["x"] >= 0) & (c["x"] < F.col("width")) & (c["y"] >= 0) & (c["y"] < F.col("height"))
    inside = G.let(F.col("centroid"), within)  # named once, as a filter takes the expression along
    return out.where(inside & (G.box_area(F.col("box")) >= least_pixels))


def class_weights(crops: DataFrame, label: str = "label", classes: int = 2) -> DataFrame:
    """label, n, weight for every class, present or not."""
    counts = crops.groupBy(F.col(label).alias("of_label")).agg(F.count(F.lit(1)).alias("n"))
    every = crops.sparkSession.range(classes).select(F.col("id").cast("int").alias("label"))
    both = F.broadcast(every).join(counts, F.col("label") == F.col("of_label"), "left")  # `classes` rows
    both = both.select("label", F.coalesce("n", F.lit(0)).alias("n"))
    total = both.agg(F.sum("n").alias("total"))
    return both.join(F.broadcast(total)).select("label", "n", class_weight(F.col("total"), F.col("n"), classes).alias("weight"))  # one row


def confusion(rows: DataFrame, true: str, pred: str) -> DataFrame:
    """One row: the cells of a two-class table with accuracy, precision, recall and F1 of class 1; 0 for 0 / 0."""
    cell = lambda t, p: F.count_if((F.col(true) == t) & (F.col(pred) == p))
    cells = rows.agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn, tn = map(F.col, ("tp", "fp", "fn", "tn"))
    return cells.select(
        "*", ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def class_report(rows: DataFrame, true: str, pred: str) -> DataFrame:
    """label, precision, recall, f1, support of both classes."""
    one = confusion(rows, true, pred)
    other = confusion(rows.withColumn(true, 1 - F.col(true)).withColumn(pred, 1 - F.col(pred)), true, pred)
    line = lambda df, label: df.select(F.lit(label).alias("label"), "precision", "recall", "f1", (F.col("tp") + F.col("fn")).alias("support"))
    return line(other, CLASSES[0]).unionByName(line(one, CLASSES[1]))


def suspects(crops: DataFrame, low: float = LOW_CONF) -> DataFrame:
    """Annotated positives that the model rejects (misclass) or barely accepts (low_conf).

    crops has kind, site, geojson_source, polygon_id, centroid columns and prob_daninha. A probability of exactly one
    half counts as a rejection.
    """
    p = F.col("prob_daninha")
    kind = F.when(p <= 0.5, "misclass").when(p < low, "low_conf")
    out = crops.where("kind = 'positive'").withColumn("kind", kind).where("kind is not null")
    out = out.withColumn("true_class", F.lit(CLASSES[1])).withColumn("pred_class", F.when(p <= 0.5, CLASSES[0]).otherwise(CLASSES[1]))
    return out.withColumn("prob_cultivo", 1 - p).select(*SUSPECT)


def suspect_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.when(F.col("kind") == "misclass", 0).otherwise(1), "prob_daninha", "site", "polygon_id")


def suspect_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("kind") == "misclass").alias("n_misclass"), F.count_if(F.col("kind") == "low_conf").alias("n_low_conf"))


def site_changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """site, basename, change, delta: files of the current sites that are new, gone or modified since a manifest.

    Manifests have site, basename, exists, sha256 and n_polygons. Files that the current manifest no longer names do not show.
    """
    old = previous.select(*(F.col(c).alias(f"old_{c}") for c in ("site", "basename", "exists", "sha256", "n_polygons")))
    both = current.join(old, (F.col("site") == F.col("old_site")) & (F.col("basename") == F.col("old_basename")), "left")
    was, here = F.coalesce("old_exists", F.lit(False)), F.coalesce("exists", F.lit(False))
    changed = F.coalesce(F.col("old_sha256") != "", F.lit(False)) & ~F.col("old_sha256").eqNullSafe(F.col("sha256"))
    change = F.when(~was & here, "novo").when(was & ~here, "removido").when(changed, "modificado")
    delta = F.when(change == "modificado", F.col("n_polygons") - F.col("old_n_polygons"))
    return both.select("site", "basename", change.alias("change"), delta.alias("delta")).where("change is not null")


def polygon_total(manifest: DataFrame) -> DataFrame:
    return manifest.where("exists").groupBy("site").agg(F.sum(F.greatest("n_polygons", F.lit(0))).alias("n_polygons"))


def site_signature(config: Column, files: Column) -> Column:
    """16 hexadecimal digits over a configuration and an array of (basename, size, mtime)."""
    stats = F.array_join(F.transform(files, lambda f: F.concat_ws(":", f["basename"], f["size"].cast("string"), f["mtime"].cast("string"))), "|")
    return F.substring(F.sha2(F.concat_ws("|", config, stats).cast("binary"), 256), 1, 16)


def candidates(sites: DataFrame, tries: int = 15, seed: int = 42) -> DataFrame:
    """Points spread evenly over each site's bounds: `tries` times the target, by hashes of site, number and seed.

    sites has site, x0, y0, x1, y1, n_target. Adds nth, x, y.
    """
    digits = lambda k: F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed + k)), F.col("site").cast("string"), F.col("nth").cast("string")).cast("binary"), 256), 1, 8)
    share = lambda k: F.conv(digits(k), 16, 10).cast("double") / 2.0**32
    out = sites.withColumn("nth", F.explode(F.sequence(F.lit(0), F.col("n_target") * tries - 1)))
    out = out.withColumn("x", F.col("x0") + share(0) * (F.col("x1") - F.col("x0")))
    return out.withColumn("y", F.col("y0") + share(1) * (F.col("y1") - F.col("y0")))


def negatives(points: DataFrame, plantation: DataFrame, weeds: DataFrame, width: float, height: float, grid: float = 256.0, crop: int = CROP, invert: bool = False) -> DataFrame:
    """Per site the first n_target points inside (or outside) the plantation, on no weed, with a whole window around.

    points has site, nth, n_target, x, y; plantation and weeds have site and ring; both are met by grid cell, then exactly.
    """
    half = crop / 2
    cell = lambda c: F.floor(c / grid)
    own = points.where(F.col("x").between(half, width - half) & F.col("y").between(half, height - half))
    own = own.withColumn("cx", cell(F.col("x"))).withColumn("cy", cell(F.col("y")))

    def by_cell(rings: DataFrame, name: str) -> tuple[DataFrame, Column]:
        """Rings by the cells that their boxes touch, and when a point lies in one."""
        span = lambda a, b: F.explode(F.sequence(cell(F.col(f"{name}_box.{a}")), cell(F.col(f"{name}_box.{b}"))))
        inside = F.struct(*(F.least(F.greatest(F.col("box")[k], F.lit(0.0)), F.lit(float(most))).alias(k) for k, most in zip(G.BOX, (width, height, width, height), strict=True)))
        out = rings.select(F.col("site").alias(f"{name}_site"), F.col("ring").alias(f"{name}_ring"), G.bbox("ring").alias("box")).withColumn(f"{name}_box", inside).drop("box")
        out = out.withColumn(f"{name}_x", span("x0", "x1")).withColumn(f"{name}_y", span("y0", "y1"))
        meet = (F.col("site") == F.col(f"{name}_site")) & (F.col("cx") == F.col(f"{name}_x")) & (F.col("cy") == F.col(f"{name}_y"))
        return out, meet & G.contains_point(f"{name}_ring", F.col("x"), F.col("y"))

    own = own.join(*by_cell(plantation, "planted"), "left_anti" if invert else "left_semi")
    free = own.join(*by_cell(weeds, "weed"), "left_anti").drop("cx", "cy")
    first = Window.partitionBy("site").orderBy("nth")
    return free.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= F.col("n_target")).drop("rank")
