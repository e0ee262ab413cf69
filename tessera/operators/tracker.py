"""Issue-tracker data as tables; calls to a tracker go through the Tracker protocol."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import STATES


class Tracker(Protocol):
    """What a tracker client offers; the library brings none."""

    def issues(self, state: str, label: str | None = None) -> list[dict]: ...

    def create_issue(self, title: str, body: str, state: str, labels: list[str], parent: str | None = None) -> str: ...

    def move(self, issue: str, state: str) -> None: ...

    def comment(self, issue: str, body: str) -> None: ...

    def upload(self, path: str, mime: str) -> str: ...


def state_counts(issues: DataFrame, state: str = "state", states: list[str] = STATES) -> DataFrame:
    """state, n for every state of the board, in its order, whether it has issues or not."""
    counts = issues.groupBy(F.col(state).alias("of_state")).agg(F.count(F.lit(1)).alias("n"))
    board = issues.sparkSession.createDataFrame(list(enumerate(states)), "place int, state string")
    both = F.broadcast(board).join(counts, F.col("state") == F.col("of_state"), "left")  # the board's few states
    return both.select("place", "state", F.coalesce("n", F.lit(0)).alias("n"))


def ready(counts: DataFrame, state: str, least: int) -> DataFrame:
    """The state's row if it has at least that many issues."""
    return counts.where((F.col("state") == state) & (F.col("n") >= least))


def resolve_labels(wanted: DataFrame, labels: DataFrame) -> DataFrame:
    """Ids of label names; unknown names are dropped. wanted has label, labels has name and id."""
    return wanted.join(labels.select(F.col("name").alias("of_name"), F.col("id").alias("label_id")), F.col("label") == F.col("of_name")).drop("of_name")


def missing_states(seed: DataFrame, existing: DataFrame) -> DataFrame:
    """States of the seed that the board lacks."""
    return seed.join(existing.select(F.col("state").alias("of_state")).distinct(), F.col("state") == F.col("of_state"), "left_anti")


def labelled(issues: DataFrame, label: str, least: int = 0) -> DataFrame:
    """The number of issues that bear a label, at least `least`: the number of a cycle."""
    return issues.agg(F.greatest(F.count_if(F.array_contains("labels", label)), F.lit(least)).alias("n"))
