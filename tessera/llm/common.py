"""Helpers shared by the training-data operators: tables, staged tables, shipping of the package."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.staging import shared_folder

#: Rows and bytes of an Arrow batch. Texts can be long, so batches stay far below Spark's default of 10,000 rows.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20
#: Rows of a partition of a staged table of small rows, and of a table of texts.
ROWS_A_PART, TEXTS_A_PART = 20_000, 8_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Make the package importable on executors and bound an Arrow batch by rows and bytes.

    The bounds are settings of the session, as Spark takes them when a query is planned; lower ones stay.
    """
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for setting, read, most in (("maxRecordsPerBatch", int, BATCH_ROWS), ("maxBytesPerBatch", size, BATCH_BYTES)):
        if not 0 < read(spark.conf.get(f"spark.sql.execution.arrow.{setting}")) <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{setting}", str(most))
    context = spark.sparkContext
    if getattr(context, "_tessera_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(), f"{package.name}_package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(target)  # executors fetch it from the driver
    context._tessera_shipped = True


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends."""
    path = f"{shared_folder(spark)}/tessera/{name}-{uuid.uuid4().hex}"

    def gone() -> None:
        try:
            drop_path(spark, path)
        except Exception:  # noqa: BLE001  the session may have ended before
            pass

    atexit.register(gone)
    return path


def sized(df: DataFrame, rows: int, rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """Merge partitions, without a shuffle, to about rows_a_part rows each; rows bounds the rows of df."""
    return df.coalesce(max(1, -(-rows // rows_a_part)))


def staged(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write a table into the shared folder and read it back: cuts the lineage, and lost executors lose nothing.

    rows, a bound on its rows where one is known, keeps small tables in few files.
    """
    path = new_path(df.sparkSession, name)
    df = df if rows is None else sized(df, rows)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(key: str, folds: int):
    """crc32 of a key as text, modulo a number of folds; a null key falls in fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds, F.lit(0))


def map_column(df: DataFrame, keep: list[str], column: str, make: Callable, schema: str, rows: bool = False) -> DataFrame:
    """Apply Python to one column by Arrow batches, beside kept columns that never leave Arrow.

    make() is called once a task and gives a function from a list of values to a list of columns in the order of
    schema. With rows=True that function returns (index of the input row for each output row, columns) instead, so
    that a row may give any number of rows.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    prepare(df.sparkSession)
    made = StructType.fromDDL(schema)
    whole = StructType([df.schema[k] for k in keep] + made.fields)
    types = [field.type for field in to_arrow_schema(made)]
    columns = keep if column in keep else [*keep, column]
    read, width = columns.index(column), len(keep)

    def run(batches):
        work = make()
        for batch in batches:
            kept = [batch.column(k) for k in range(width)]
            out = work(batch.column(read).to_pylist())
            if rows:
                index, out = out
                index = pa.array(index, type=pa.int64())
                kept = [k.take(index) for k in kept]
            made_columns = [pa.array(values, type=kind) for values, kind in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*kept, *made_columns], names=whole.names)

    return df.select(*columns).mapInArrow(run, whole)
