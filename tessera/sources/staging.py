"""The shared folder, and cutting lineage where a result must not be computed twice in two ways."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """A path as a whole URI; without a scheme it lies in the default file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    scheme, _, rest = whole.partition(":")
    return whole if rest.startswith("//") else f"{scheme}://{rest}"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as a whole URI.

    It is spark.checkpoint.dir, or else the context's checkpoint folder. Where neither is set, a local session takes a
    temporary folder; on a cluster that is an error, as no machine's own disk is shared.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context._jsc.sc().isLocal():
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="tessera-"))
        found = context.getCheckpointDir()
    return qualified(spark, found)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_folder(spark)}/tessera-{name}-{uuid.uuid4().hex}"

    def gone() -> None:
        try:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001  the session may have ended before
            pass

    atexit.register(gone)
    return path


def frozen(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of a table, in the shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()
