"""Grouped folds, hold-outs and splits without leakage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.geometry import col
from tessera.sources.staging import frozen


def ranged(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows dealt into ranges of an order, with the number of their range as part.

    Range bounds come from a sample that may differ between runs, so the result is frozen before it is used twice.
    """
    return frozen(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))


def ordinals(keys: DataFrame, key: str) -> DataFrame:
    """(of_key, ordinal) of distinct keys in order, from 0, without one task ordering them all.

    Keys are numbered within ranges and shifted by the counts of the ranges before.
    """
    ordered = ranged(keys.select(F.col(key).alias("of_key")).distinct(), ["of_key"])
    ordered = ordered.withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy("of_key")))
    sizes = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row a range
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = sizes.select(F.col("part").alias("of_part"), before.alias("before"))
    return ordered.join(before, F.col("part") == F.col("of_part")).select("of_key", (F.col("before") + F.col("nth") - 1).alias("ordinal"))


def round_robin(items: DataFrame, group: str, k: int) -> DataFrame:
    """Adds fold: the groups in order go to folds 0 ... k-1 in turn, so that no group lies in two folds."""
    if k <= 0:
        raise ValueError("k must be positive")
    return items.join(ordinals(items, group), F.col(group) == F.col("of_key")).withColumn("fold", (F.col("ordinal") % k).cast("int")).drop("of_key", "ordinal")


def holdout(items: DataFrame, group: str, held: list[str]) -> DataFrame:
    """Adds split: golden for the held-out groups, live for the rest."""
    return items.withColumn("split", F.when(F.col(group).isin(held), "golden").otherwise("live"))


def leave_one_out(items: DataFrame, group: str) -> DataFrame:
    """Each group once as the held-out one: item counts of (held_out, role). No row is copied."""
    sizes = items.groupBy(F.col(group).alias("of_group")).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n").alias("total"))
    both = sizes.join(F.broadcast(total))  # one row
    role = F.explode(F.array(F.struct(F.lit("val").alias("role"), F.col("n").alias("n_items")), F.struct(F.lit("train").alias("role"), (F.col("total") - F.col("n")).alias("n_items"))))
    return both.select(F.col("of_group").alias("held_out"), role.alias("r")).select("held_out", "r.role", "r.n_items")


def leave_one_out_roles(items: DataFrame, group: str, held: list[str] | None = None) -> DataFrame:
    """Every item with its role for each held-out group: val where it belongs to the group, else train.

    The result holds each item once a hold-out, as the training runs of all of them read it; held names some groups only.
    Fields are few, so their names are one array that is joined as a single row.
    """
    names = items.where(F.col(group).isNotNull()).agg(F.array_sort(F.collect_set(group)).alias("held")) if held is None else items.sparkSession.range(1).select(F.array(*map(F.lit, held)).alias("held"))
    both = items.join(F.broadcast(names)).withColumn("held_out", F.explode("held")).drop("held")  # one row
    return both.withColumn("role", F.when(F.col(group) == F.col("held_out"), "val").otherwise("train"))


def pending(folds: DataFrame, history: DataFrame, group: str = "held_out") -> DataFrame:
    """Folds whose tag `loo_<group>` has no run yet."""
    done = history.select(F.col("tag").alias("of_tag")).distinct()
    return folds.join(done, F.concat(F.lit("loo_"), F.col(group)) == F.col("of_tag"), "left_anti")


def shares(items: DataFrame, group: str) -> DataFrame:
    """Items of each group and their percentage; null for none at all."""
    sizes = items.groupBy(F.col(group)).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n").alias("total"))
    return sizes.join(F.broadcast(total)).select(group, "n", (F.try_divide(F.col("n"), F.col("total")) * 100).alias("percent"))  # one row


def gap_split(crops: DataFrame, site: str, position: str, fraction: float, gap: float) -> DataFrame:
    """Adds split within each site: the last share by position is val, what lies a gap before it train, the rest gap.

    The target count rounds half to even; a site whose target is 0 is train whole.
    """
    starts = val_starts(crops, site, position, fraction)
    both = crops.join(starts, F.col(site).eqNullSafe(F.col("of_site")))
    split = (
        F.when(F.col("target") == 0, "train").when(F.col(position) >= F.col("start"), "val")
        .when(F.col(position) < F.col("start") - gap, "train").otherwise("gap")
    )
    return both.withColumn("split", split).drop("of_site", "target", "start")


def val_starts(crops: DataFrame, site: str, position: str, fraction: float) -> DataFrame:
    """(of_site, target, start): the position where each site's last share begins; null where the target is 0.

    An order statistic by ranges over the distinct positions with their counts: counts tell the range that holds it, and
    only that range is numbered. A site of any size is spread over many tasks, and a position counts once however many
    crops share it.
    """
    at = crops.groupBy(F.col(site).alias("of_site"), F.col(position).alias("at")).agg(F.count(F.lit(1)).alias("n"))
    rows = ranged(at, ["of_site", "at"])
    by_site = Window.partitionBy("of_site")
    upto = lambda over, n: F.coalesce(F.sum(n).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = rows.groupBy("of_site", "part").agg(F.sum("n").alias("n"))
    sizes = sizes.withColumn("before", upto(by_site.orderBy("part"), "n")).withColumn("total", F.sum("n").over(by_site))
    sizes = sizes.withColumn("target", F.bround(F.col("total") * F.lit(fraction)).cast("int"))
    want = F.col("total") - F.col("target") + 1 - F.col("before")
    here = sizes.where((F.col("target") > 0) & (want >= 1) & (want <= F.col("n"))).select(F.col("of_site").alias("here"), F.col("part").alias("of_part"), want.alias("want"))
    numbered = rows.join(here, F.col("of_site").eqNullSafe(F.col("here")) & (F.col("part") == F.col("of_part")))
    numbered = numbered.withColumn("upto", upto(Window.partitionBy("here", "of_part").orderBy("at"), "n"))
    starts = numbered.where("upto < want and want <= upto + n").select("here", F.col("at").alias("start"))
    targets = sizes.select("of_site", "target").distinct()
    return targets.join(starts, F.col("of_site").eqNullSafe(F.col("here")), "left").drop("here")


def split_stems(stems: DataFrame, group: Column, held: list[str]) -> DataFrame:
    """The union of background stems, dealt to golden and live by their group."""
    return stems.distinct().withColumn("split", F.when(col(group).isin(held), "golden").otherwise("live"))
