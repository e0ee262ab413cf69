"""Run history: promotion, reports, selections. A history is one row a run with its sequence number."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.text import fixed, signed

# fixed values: the metric; the words of verdicts and of the report below are fixed too
METRIC = "seg_mAP50-95"


@dataclass(frozen=True)
class Promotion:
    metric: str = METRIC
    min_delta: float = 0.01
    guards: dict[str, float] = field(default_factory=lambda: {"seg_recall": -0.02})


def _metric(name: str) -> Column:
    return F.try_element_at(F.col("metrics"), F.lit(name))


# A history grows by one row a training run, so ordering it whole in one task is bounded by the runs ever made.
def _runs():
    return Window.partitionBy(F.lit(0)).orderBy("seq")


def _best(over: Window, rule: Promotion) -> Column:
    """The first run of the greatest metric; a missing metric counts as minus infinity."""
    guards = [F.coalesce(_metric(g), F.lit(0.0)).alias(f"g{k}") for k, g in enumerate(rule.guards)]
    rank = F.struct(F.coalesce(_metric(rule.metric), F.lit(float("-inf"))), -F.col("seq"))
    return F.max_by(F.struct(F.col("run_id").alias("run_id"), F.coalesce(_metric(rule.metric), F.lit(0.0)).alias("m"), *guards), rank).over(over)


def promotion(history: DataFrame, rule: Promotion = Promotion()) -> DataFrame:
    """Adds prev_best, delta, promoted and verdict: each run against the best of all runs before it."""
    out = history.withColumn("best", _best(_runs().rowsBetween(Window.unboundedPreceding, -1), rule))
    delta = _metric(rule.metric) - F.col("best.m")
    drops = [F.coalesce(_metric(g), F.lit(0.0)) - F.col(f"best.g{k}") for k, g in enumerate(rule.guards)]
    bad = [d < limit for d, limit in zip(drops, rule.guards.values(), strict=True)]
    broken = F.lit(False)
    for b in bad:
        broken = broken | b
    first = F.col("best").isNull()
    promoted = F.when(first, True).when(delta < rule.min_delta, False).when(broken, False).otherwise(True)
    verdict = F.when(first, "primeiro run: promovido como baseline")
    verdict = verdict.when(delta < rule.min_delta, F.concat(F.lit("ganho de "), signed(delta), F.lit(f" em {rule.metric} abaixo de min_delta={rule.min_delta}")))
    for (guard, limit), d, b in zip(rule.guards.items(), drops, bad, strict=True):
        verdict = verdict.when(b, F.concat(F.lit(f"métrica de guarda violada: {guard} caiu "), signed(d), F.lit(f" (limite {limit})")))
    verdict = verdict.otherwise(F.concat(F.lit("ganho real de "), signed(delta), F.lit(f" em {rule.metric}")))
    return out.select("*", F.col("best.run_id").alias("prev_best"), delta.alias("delta"), promoted.alias("promoted_now"), verdict.alias("verdict_now")).drop("best")


def progress(history: DataFrame, metric: str = METRIC) -> DataFrame:
    """Adds value, delta to the run before, best so far and progression since the first."""
    value = F.coalesce(_metric(metric), F.lit(0.0))
    out = history.withColumn("value", value)
    so_far = _runs().rowsBetween(Window.unboundedPreceding, 0)
    return (
        out.withColumn("delta", F.col("value") - F.lag("value").over(_runs())).withColumn("best_so_far", F.max("value").over(so_far))
        .withColumn("since_first", F.col("value") - F.first("value").over(so_far))
    )


def of_cycle(history: DataFrame, cycle: int | None) -> DataFrame:
    """Runs of a cycle; all runs where none bears it. Cycle 0 and an unset one never match."""
    if cycle is None:
        return history
    match = F.coalesce(F.col("ciclo").cast("string") == str(cycle), F.lit(False)) & (F.col("ciclo") != 0)
    marked = history.withColumn("match", F.coalesce(match, F.lit(False)))
    some = marked.agg(F.max("match").alias("some"))
    return marked.join(F.broadcast(some)).where("match or not coalesce(some, false)").drop("match", "some")  # one row


def report(history: DataFrame, cycle: int | None = None, metric: str = METRIC) -> DataFrame:
    """title, body: the markdown report of a cycle."""
    runs = progress(of_cycle(history, cycle), metric)
    tag = F.coalesce(F.nullif(F.col("tag"), F.lit("")), F.lit("-"))
    delta = F.when(F.col("delta").isNull(), "—").otherwise(signed(F.col("delta")))
    mark = F.when(F.coalesce("promoted", F.lit(False)), "✓").otherwise("✗")
    line = F.concat(F.lit("| `"), F.col("version"), F.lit("` | `"), tag, F.lit("` | "), fixed(F.col("value")), F.lit(" | "), delta, F.lit(" | "), mark, F.lit(" |"))
    told = runs.select("seq", "run_id", "value", line.alias("line")).agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("seq", "line"))).alias("rows"),
        F.max_by("run_id", F.struct("value", -F.col("seq"))).alias("best"), F.max("value").alias("top"),
        F.min_by("value", "seq").alias("first"), F.max_by("value", "seq").alias("last"),
    )
    n = F.col("n").cast("string")
    head = F.array(F.concat(F.lit("**Runs incluídos**: "), n), F.lit(f"**Métrica principal**: `{metric}`"), F.lit(""), F.lit(f"| versão | tag | {metric} | Δ | promoted |"), F.lit("|---|---|---|---|---|"))
    tail = F.array(
        F.lit(""), F.concat(F.lit("**Melhor run**: `"), F.col("best"), F.lit(f"` — {metric}="), fixed(F.col("top"))),
        F.concat(F.lit("**Progressão do ciclo**: "), fixed(F.col("first")), F.lit(" → "), fixed(F.col("last")), F.lit("  ("), signed(F.col("last") - F.col("first")), F.lit(")")),
    )
    lines = F.concat(head, F.transform("rows", lambda r: r["line"]), F.when(F.col("n") > 0, tail).otherwise(F.array(F.lit(""))))
    label = f"Ciclo {cycle}" if cycle is not None else "Todos os ciclos"
    return told.select(F.concat(F.lit(f"{label} — resumo · "), n, F.lit(" run(s)")).alias("title"), F.array_join(lines, "\n").alias("body"))


def select_run(history: DataFrame, run_id: str | None = None) -> DataFrame:
    """The last run, or the last run of an id; empty where there is none."""
    own = history if run_id is None else history.where(F.col("run_id") == run_id)
    return own.orderBy(F.desc("seq")).limit(1)


def fold_table(history: DataFrame) -> DataFrame:
    """One row a leave-one-out run with its metrics."""
    name = F.regexp_extract("tag", r"^loo_(.*)$", 1)
    metrics = [F.coalesce(_metric(m), F.lit(0.0)).alias(a) for m, a in (("seg_mAP50-95", "map50_95"), ("seg_mAP50", "map50"), ("seg_precision", "precision"), ("seg_recall", "recall"))]
    return history.where(F.col("tag").startswith("loo_")).select("seq", name.alias("held_out"), *metrics)


def early_stop(epochs: DataFrame, value: str = "f1", patience: int = 7) -> DataFrame:
    """best_epoch, stop_epoch of a run's epochs (epoch, value): it stops after `patience` epochs without a strict gain.

    stop_epoch is the last epoch there is where training never stalled that long.
    """
    before = Window.partitionBy(F.lit(0)).orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(F.lit(0)).orderBy("epoch").rowsBetween(Window.unboundedPreceding, 0)
    gain = F.col(value) > F.coalesce(F.max(value).over(before), F.lit(float("-inf")))
    rows = epochs.withColumn("gain", gain).withColumn("at", F.max(F.when(F.col("gain"), F.col("epoch"))).over(upto))
    stalled = F.col("epoch") - F.col("at") >= patience
    stop = rows.withColumn("stalled", stalled).agg(F.min(F.when(F.col("stalled"), F.col("epoch"))).alias("stop"), F.max("epoch").alias("last"))
    rows = rows.join(F.broadcast(stop)).where(F.col("stop").isNull() | (F.col("epoch") <= F.col("stop")))  # one row
    return rows.agg(F.max("at").alias("best_epoch"), F.max(F.coalesce("stop", "last")).alias("stop_epoch"))
