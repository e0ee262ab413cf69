"""The watcher: issues that become ready are handled once each, and states are counted as they change."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

log = logging.getLogger(__name__)


def issue_stream(spark: SparkSession, folder: str, schema: StructType, glob: str | None = None) -> DataFrame:
    """Issue events that arrive as Parquet files in a folder."""
    reader = spark.readStream.schema(schema)
    return (reader.option("pathGlobFilter", glob) if glob else reader).parquet(folder)


def board_stream(spark: SparkSession, folder: str) -> DataFrame:
    """id, state, labels of a board's events (operators.board) as they come: issues when they are made and when they move.

    Labels are known from the event that made an issue only, so a label is asked of issues that are made ready.
    """
    from tessera.operators.board import EVENTS

    events = spark.readStream.schema(EVENTS).parquet(f"{folder.rstrip('/')}/events")
    return events.where("kind in ('issue', 'move')").select(F.col("issue").alias("id"), "state", "labels")


def ready_once(issues: DataFrame, state: str, label: str | None = None) -> DataFrame:
    """Each id at most once, when it first is in a state (and bears a label). The ids seen are the query's state."""
    ready = issues.where(F.col("state") == state)
    if label is not None:
        ready = ready.where(F.array_contains("labels", label))
    return ready.dropDuplicates(["id"])


def watch(issues: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run a handler on each batch of ready issues.

    An error of the handler is logged and its issues count as processed, so one bad issue does not stop the watch. Without
    an interval the query takes what there is and ends.
    """

    def handle(batch: DataFrame, number: int) -> None:
        try:
            handler(batch, number)
        except Exception:
            log.exception("the handler failed on batch %d", number)

    writer = issues.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def counts(issues: DataFrame, state: str = "state") -> DataFrame:
    """Issues by state so far; use with output mode complete."""
    return issues.groupBy(state).agg(F.count(F.lit(1)).alias("n"))


def collect_counts(issues: DataFrame, state: str, target: str, checkpoint: str) -> None:
    """Count what there is, replacing the table at target after every batch."""
    query = counts(issues, state).writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    query = query.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(target)).trigger(availableNow=True).start()
    query.awaitTermination()


def collect_ready(issues: DataFrame, target: str, checkpoint: str) -> None:
    """Write each batch to a folder of its own number, so that a batch that runs again replaces itself."""
    query = watch(issues, lambda batch, n: batch.write.mode("overwrite").parquet(f"{target}/batch={n}"), checkpoint)
    query.awaitTermination()
