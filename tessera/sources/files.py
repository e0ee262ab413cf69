"""Readers of images, labels, polygons, manifests, reports and histories."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import IMAGE_TYPES, extension, file_stem


@dataclass(frozen=True)
class Config:
    """Settings of a cycle, with class names in the order of their ids."""

    values: dict
    root: Path
    class_names: list[str] = field(default_factory=list)

    @property
    def classes(self) -> int:
        return len(self.class_names)

    def path(self, name: str) -> str:
        found = Path(self.values["paths"][name])
        return str(found if found.is_absolute() else self.root / found)


def load_config(path: str | Path) -> Config:
    import yaml

    path = Path(path).resolve()
    values = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
    names = values.get("project", {}).get("classes", {})
    return Config(values, path.parent, [names[k] for k in sorted(names, key=int)])


def _named(files: DataFrame) -> DataFrame:
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    return files.withColumn("file_name", name).withColumn("stem", file_stem("path")).withColumn("ext", extension("path"))


def read_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """path, content, length, modificationTime, file_name, stem, ext of all files below a folder; empty where it is missing.

    Columns that a query does not use, content above all, are not read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return _named(spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary"))
    return _named((reader.option("pathGlobFilter", glob) if glob else reader).load(folder))


def images_of(found: DataFrame, types: list[str] = IMAGE_TYPES) -> DataFrame:
    """The images among files, by their extension in any case."""
    return found.where(F.col("ext").isin(types))


def labels_of(found: DataFrame) -> DataFrame:
    """The label files among files (content as binary), with their whole text as raw; readable tells whether it is UTF-8."""
    text = F.col("content").cast("string")
    return found.where("ext = 'txt'").withColumn("readable", F.is_valid_utf8(text)).withColumn("raw", F.when(F.col("readable"), text))


def named(found: DataFrame) -> DataFrame:
    """Adds file_name, stem and ext to files (path, ...)."""
    return _named(found)


def read_images(spark: SparkSession, folder: str, types: list[str] = IMAGE_TYPES) -> DataFrame:
    return images_of(read_files(spark, folder), types)


def read_labels(spark: SparkSession, folder: str) -> DataFrame:
    return labels_of(read_files(spark, folder, "*.txt"))


def tile_path(images: DataFrame, stem: str, types: list[str] = ("jpg", "jpeg", "png")) -> str:
    """The path of a tile by its stem, by the first of the types it has; an error where there is none."""
    place = F.array_position(F.array(*map(F.lit, types)), F.col("ext"))
    found = images.where((F.col("stem") == stem) & F.col("ext").isin(list(types))).agg(F.min_by("path", F.struct(place, "path")).alias("path")).first()["path"]
    if found is None:
        raise FileNotFoundError(f"no tile {stem}")
    return found


def git_commit(folder: str | Path) -> str | None:
    """The commit of a folder, or None where it has none."""
    import subprocess

    try:
        found = subprocess.run(["git", "-C", str(folder), "rev-parse", "HEAD"], capture_output=True, text=True, timeout=10, check=True)
    except (OSError, subprocess.SubprocessError):
        return None
    return found.stdout.strip() or None


def relative(path: Column, folder: str) -> Column:
    """The part of a path below a folder."""
    return F.regexp_replace(path, rf"^.*?\Q{folder.rstrip('/')}\E/", "")


def polygon_numbers(labels: DataFrame, strict: bool = True) -> DataFrame:
    """file_name, stem, idx, class_id, coords of label lines that can be read as polygons, unchecked otherwise.

    strict leaves out lines with an odd number of coordinates; otherwise the last one is dropped.
    """
    from tessera.operators.qa import lines, parse

    out = lines(labels, "raw", ["file_name", "stem"]).withColumn("p", parse("line", 2**31 - 1)).where("p.issue is null or p.issue <> 'linha_malformada'")
    tokens = F.split(F.trim(F.regexp_replace("line", r"\s+", " ")), " ")
    coords = F.transform(F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0))), lambda t: F.replace(t, F.lit("_"), F.lit("")).cast("double"))
    out = out.select("file_name", "stem", F.col("line_no").alias("idx"), F.replace(F.get(tokens, F.lit(0)), F.lit("_"), F.lit("")).try_cast("int").alias("class_id"), coords.alias("coords"))
    if strict:
        return out.where("size(coords) >= 6 and size(coords) % 2 = 0")
    return out.withColumn("coords", F.slice("coords", 1, F.size("coords") - F.size("coords") % 2)).where("size(coords) >= 6")


def read_background(spark: SparkSession, path: str) -> DataFrame:
    """stem: the stems of a background manifest; none where it is missing or no JSON."""
    folder, _, name = path.rpartition("/")
    parsed = F.from_json(F.col("content").cast("string"), "stems array<string>")
    return read_files(spark, folder, name).select(F.explode(parsed["stems"]).alias("stem"))


def read_geojson(spark: SparkSession, folder: str, glob: str = "*.geojson") -> DataFrame:
    """path, crs, idx, type, coordinates (text), properties (text) of all features of all files of a kind.

    The coordinates stay text, since their depth differs by type; a collection has its geometries as text there. Without a named CRS it is CRS84.
    """
    schema = "crs struct<properties:struct<name:string>>, features array<struct<geometry:struct<type:string,coordinates:string,geometries:string>,properties:string>>"
    files = read_files(spark, folder, glob).select("path", F.from_json(F.col("content").cast("string"), schema).alias("g"))
    crs = F.coalesce("g.crs.properties.name", F.lit("urn:ogc:def:crs:OGC:1.3:CRS84"))
    rows = files.select("path", crs.alias("crs"), F.posexplode("g.features").alias("idx", "f"))
    return rows.select("path", "crs", "idx", F.col("f.geometry.type").alias("type"), F.coalesce("f.geometry.coordinates", "f.geometry.geometries").alias("coordinates"), F.col("f.properties").alias("properties"))


HISTORY = """run_id string, version string, arch string, seed long, imgsz long, epochs long, tag string, created_at string,
    metrics map<string,double>, weights string, promoted boolean, verdict string, ciclo long"""


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Runs of a JSON array with their sequence number; none where the file is missing or broken."""
    folder, _, name = path.rpartition("/")
    parsed = F.from_json(F.col("content").cast("string"), f"array<struct<{','.join(' '.join(f.split()).replace(' ', ':', 1) for f in _fields(HISTORY))}>>")
    return read_files(spark, folder, name).select(F.posexplode(parsed).alias("seq", "run")).select(F.col("seq").cast("long"), "run.*")


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of a history kept as a folder of Parquet; none where it is missing."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "seq long, " + HISTORY)
    return spark.read.parquet(folder)


def _fields(ddl: str) -> list[str]:
    import re

    return re.split(r",(?![^<]*>)", ddl)


def read_findings(spark: SparkSession, path: str) -> DataFrame:
    """Findings of a report with their place: file, block of the file, and order within the block."""
    found = spark.read.csv(path, header=True, schema="image string, issue string, severity string, detail string", escape='"')
    block = [F.col(f"_metadata.{k}").alias(k) for k in ("file_path", "file_block_start")]
    return found.select("*", F.struct(*block, F.monotonically_increasing_id().alias("nth")).alias("place"))


def fields(*sets: DataFrame) -> DataFrame:
    """field: the fields of the tiles of all sets (stem), in order; live and golden tiles are two such sets."""
    from functools import reduce

    from tessera.functions.text import group_key

    every = reduce(DataFrame.unionByName, [s.select(group_key("stem").alias("field")) for s in sets])
    return every.distinct().orderBy("field")


def read_states(path: str | Path) -> dict:
    """States and labels of a seed file."""
    import yaml

    found = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    return {"states": found.get("states", []), "labels": found.get("labels", [])}
