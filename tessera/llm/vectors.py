"""Helpers for tables of vectors: valid rows with an id of their own, and streaming over sorted groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged


def valid_vectors(rows: DataFrame, column: str = "embedding"):
    """Not null, not empty, and without null or non-finite components."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(column).isNotNull() & (F.size(column) > 0) & finite, F.lit(False))


def numbered(vectors: DataFrame, *more) -> DataFrame:
    """A staged copy with a row id (`row`), so that rows with equal ids stay apart."""
    return staged(vectors.select(F.monotonically_increasing_id().alias("row"), "*", *more), "vectors")


def by_group(rows: DataFrame, key: list[str], work: Callable, schema: str, order: list[str] | None = None) -> DataFrame:
    """Deal rows by key and apply work to each group, given as a list of tuples in the order of the columns.

    Groups stream past in sorted order, so that a task holds one group at a time; whoever calls this bounds a group.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow, width = to_arrow_schema(StructType.fromDDL(schema)), len(key)
    rest = [c for c in rows.columns if c not in key]

    def out(found: list[tuple]):
        import pyarrow as pa

        columns = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], names=arrow.names)

    def run(batches):
        group: list[tuple] = []
        for batch in batches:
            found: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[:width] != group[0][:width]:
                    found += work(group)
                    group = []
                group.append(row)
            if found:
                yield out(found)
        if group and (found := work(group)):
            yield out(found)

    dealt = rows.select(*key, *rest).repartition(*key).sortWithinPartitions(*key, *(order or []))
    return dealt.mapInArrow(run, schema)
