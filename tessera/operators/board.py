"""An issue tracker kept as a table of events: every change is a row, and the board is what the rows add up to."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import STATES

EVENTS = "at long, kind string, issue string, title string, body string, state string, labels array<string>, parent string, name string"


class TableTracker:
    """The Tracker protocol over a folder of Parquet events.

    An unknown state is an error, unknown labels are dropped, and creating a label that is there gives the known one.
    """

    def __init__(self, spark: SparkSession, folder: str, states: list[str] = STATES):
        self.spark, self.folder, self.states = spark, folder.rstrip("/"), list(states)

    def events(self) -> DataFrame:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/events")
        if not where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            return self.spark.createDataFrame([], EVENTS)
        return self.spark.read.schema(EVENTS).parquet(f"{self.folder}/events")

    def _add(self, kind: str, **fields) -> None:
        row = {"at": time.time_ns(), "kind": kind} | fields
        names = [f.split()[0] for f in EVENTS.split(", ")]
        self.spark.createDataFrame([tuple(row.get(n) for n in names)], EVENTS).write.mode("append").parquet(f"{self.folder}/events")

    def _known(self, state: str) -> str:
        if state not in self.states:
            raise ValueError(f"the board has no state {state}")
        return state

    def issue_table(self) -> DataFrame:
        """id, title, state, labels, parent of every issue as it stands now."""
        events = self.events()
        made = events.where("kind = 'issue'").select(F.col("issue").alias("id"), "title", "labels", "parent")
        last = events.where("kind in ('issue', 'move')").groupBy(F.col("issue").alias("of_issue")).agg(F.max_by("state", "at").alias("state"))
        return made.join(last, F.col("id") == F.col("of_issue")).select("id", "title", "state", "labels", "parent")

    def labels(self) -> dict[str, str]:
        """Names and ids of the labels there are; a board has few."""
        rows = self.events().where("kind = 'label'").groupBy("name").agg(F.min_by("issue", "at").alias("id")).collect()
        return {r["name"]: r["id"] for r in rows}

    def create_label(self, name: str) -> str:
        known = self.labels().get(name)
        if known:
            return known
        made = uuid.uuid4().hex
        self._add("label", issue=made, name=name)
        return made

    def create_state(self, name: str) -> None:
        if name not in self.states:
            self.states.append(name)

    def issues(self, state: str, label: str | None = None) -> list[dict]:
        found = self.issue_table().where(F.col("state") == self._known(state))
        found = found if label is None else found.where(F.array_contains("labels", label))
        return [r.asDict() for r in found.orderBy("id").collect()]

    def create_issue(self, title: str, body: str, state: str, labels: list[str], parent: str | None = None) -> str:
        issue, known = uuid.uuid4().hex, self.labels() if labels else {}
        self._add("issue", issue=issue, title=title, body=body, state=self._known(state), labels=[x for x in labels if x in known], parent=parent)
        return issue

    def move(self, issue: str, state: str) -> None:
        self._add("move", issue=issue, state=self._known(state))

    def comment(self, issue: str, body: str) -> None:
        self._add("comment", issue=issue, body=body)

    def upload(self, path: str, mime: str) -> str:
        """Reserve a place, copy the file there, record it; returns the place."""
        target = f"{self.folder}/uploads/{uuid.uuid4().hex}/{path.rsplit('/', 1)[-1]}"
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        one, other = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, target))
        jvm.org.apache.hadoop.fs.FileUtil.copy(one.getFileSystem(conf), one, other.getFileSystem(conf), other, False, conf)
        self._add("upload", name=target, body=mime)
        return target
