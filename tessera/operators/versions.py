"""Content-addressed dataset versions and their differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.geometry import col


def scan_columns(path: str = "rel_path", content: str = "content") -> list[Column]:
    """rel_path, sha256 and size of a file. Content is binary or text."""
    data = F.col(content).cast("binary")
    return [F.col(path).alias("rel_path"), F.sha2(data, 256).alias("sha256"), F.octet_length(data).cast("long").alias("size")]


def scan(files: DataFrame, path: str = "rel_path", content: str = "content") -> DataFrame:
    """rel_path, sha256, size of every file."""
    return files.select(*scan_columns(path, content))


def diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """rel_path, change: adicionado, removido or modificado, by path and digest."""
    a = old.select(F.col("rel_path").alias("old_path"), F.col("sha256").alias("old_sha"))
    b = new.select(F.col("rel_path").alias("new_path"), F.col("sha256").alias("new_sha"))
    change = (
        F.when(F.col("old_path").isNull(), "adicionado").when(F.col("new_path").isNull(), "removido")
        .when(~F.col("old_sha").eqNullSafe(F.col("new_sha")), "modificado")
    )
    both = a.join(b, F.col("old_path") == F.col("new_path"), "full_outer")
    return both.select(F.coalesce("new_path", "old_path").alias("rel_path"), change.alias("change")).where("change is not null")


def change_summary(changes: DataFrame) -> DataFrame:
    """One row of counts; labels_modificados counts modified files below labels/."""
    of = lambda kind: F.count_if(F.col("change") == kind)
    return changes.agg(
        of("adicionado").alias("adicionados"), of("removido").alias("removidos"), of("modificado").alias("modificados"),
        F.count_if((F.col("change") == "modificado") & F.col("rel_path").startswith("labels/")).alias("labels_modificados"),
    )


def counts(manifest: DataFrame) -> DataFrame:
    """Files below images/ and below labels/."""
    below = lambda prefix: F.count_if(F.col("rel_path").startswith(prefix))
    return manifest.agg(below("images/").alias("count_images"), below("labels/").alias("count_labels"), F.sum("size").alias("bytes"))


def next_version(versions: DataFrame, name: Column | str) -> DataFrame:
    """The number after the largest `v<number>`; 1 where there is none."""
    number = F.regexp_extract(col(name), r"^v([0-9]+)$", 1).try_cast("int")
    return versions.agg((F.coalesce(F.max(number), F.lit(0)) + 1).alias("next_version"))


def latest(manifests: DataFrame) -> DataFrame:
    """Of manifests (version int, ...), the files of the largest version."""
    top = manifests.agg(F.max("version").alias("top"))
    return manifests.join(F.broadcast(top), F.col("version") == F.col("top"), "left_semi")  # one row
