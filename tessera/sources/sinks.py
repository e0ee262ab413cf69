"""Writers: reports as CSV, JSON and Markdown, versions and histories as tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import fixed
from tessera.operators.crops import SUSPECT
from tessera.operators.qa import FINDING
from tessera.operators.review import COLUMNS as QUEUE

# fixed values: the columns of the score report; the keys of the manifest and of the changelog below are fixed too
SCORES = ["image", "score", "mean_iou", "gt_perdidos_ratio", "ghost_conf", "n_gt", "n_pred"]


def _csv(rows: DataFrame, path: str, one: bool = False) -> None:
    """Files with a header, in the order of rows; one file where a report is bounded by what people review."""
    (rows.coalesce(1) if one else rows).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_findings(findings: DataFrame, path: str) -> None:
    """All findings, in the order of their places."""
    ordered = findings.orderBy("place") if "place" in findings.columns else findings
    _csv(ordered.select(*FINDING), path)


def score_lines(scores: DataFrame) -> DataFrame:
    """Scores as text with four decimals, the exact value rounded half to even."""
    return scores.select("image", *(fixed(F.col(c)).alias(c) for c in SCORES[1:5]), "n_gt", "n_pred")


def write_scores(scores: DataFrame, path: str) -> None:
    """All scores, the worst first; ranges of the order are written side by side."""
    _csv(score_lines(scores.orderBy(F.desc("score"), "image")), path)


def queue_lines(queue: DataFrame) -> DataFrame:
    """Queue rows as text: `inf` for the sentinel, empty for nulls, issues joined by a bar."""
    number = lambda c: F.when(F.col(c) == float("inf"), "inf").otherwise(F.col(c).cast("string"))
    return queue.select("image", "reason", *(number(c).alias(c) for c in QUEUE[2:6]), "n_gt", "n_pred", F.array_join("issues", " | ").alias("issues"))


def write_queue(queue: DataFrame, folder: str, cycle: int) -> str:
    path = f"{folder.rstrip('/')}/lote_ciclo_{cycle}.csv"
    _csv(queue_lines(queue), path, one=True)
    return path


def write_suspects(suspects: DataFrame, path: str) -> None:
    _csv(suspects.select(*SUSPECT), path)


def manifest_lines(manifest: DataFrame, version: Column, note: Column, created: Column, commit: Column) -> DataFrame:
    """A version as lines of JSON (value): its header with counts, then a line a file, for manifests of any size."""
    below = lambda prefix: F.count_if(F.col("rel_path").startswith(prefix))
    head = manifest.agg(below("images/").alias("count_images"), below("labels/").alias("count_labels"))
    head = head.select(F.to_json(F.struct(version.alias("version"), created.alias("created_at"), note.alias("note"), commit.alias("git_commit"), "count_images", "count_labels"), {"ignoreNullFields": "false"}).alias("value"))
    return head.unionByName(manifest.select(F.to_json(F.struct("rel_path", "sha256", "size")).alias("value")))


def manifest_json(manifest: DataFrame, version: Column, note: Column, created: Column, commit: Column) -> DataFrame:
    """One JSON text of a version: its header, counts and the map of files. For small exports; manifest_lines has no bound."""
    files = F.map_from_entries(F.array_sort(F.collect_list(F.struct("rel_path", F.struct("sha256", "size")))))
    below = lambda prefix: F.count_if(F.col("rel_path").startswith(prefix))
    rows = manifest.agg(below("images/").alias("count_images"), below("labels/").alias("count_labels"), files.alias("files"))
    body = F.struct(version.alias("version"), created.alias("created_at"), note.alias("note"), commit.alias("git_commit"), "count_images", "count_labels", "files")
    return rows.select(F.to_json(body, {"ignoreNullFields": "false", "pretty": "true"}).alias("json"))


def changelog_json(changes: DataFrame, old: Column, new: Column) -> DataFrame:
    """One JSON text: the paths added, removed and modified, and their counts."""
    of = lambda kind: F.array_sort(F.collect_list(F.when(F.col("change") == kind, F.col("rel_path"))))
    rows = changes.agg(of("adicionado").alias("adicionados"), of("removido").alias("removidos"), of("modificado").alias("modificados"))
    labels = F.size(F.filter("modificados", lambda p: p.startswith("labels/")))
    resumo = F.struct(F.size("adicionados").alias("adicionados"), F.size("removidos").alias("removidos"), F.size("modificados").alias("modificados"), labels.alias("labels_modificados"))
    body = F.struct(old.alias("de"), new.alias("para"), "adicionados", "removidos", "modificados", resumo.alias("resumo"))
    return rows.select(F.to_json(body, {"ignoreNullFields": "false", "pretty": "true"}).alias("json"))


def write_version(files: DataFrame, folder: str, version: int) -> str:
    """A version as a table of its own that is never overwritten, so that pruning by version reads one folder."""
    path = f"{folder.rstrip('/')}/version={version}"
    files.write.mode("errorifexists").parquet(path)
    return path


def append_history(run: DataFrame, path: str) -> None:
    run.write.mode("append").parquet(path)


def background_json(stems: DataFrame) -> DataFrame:
    return stems.agg(F.to_json(F.struct(F.array_sort(F.collect_set("stem")).alias("stems"))).alias("json"))


def feature_text() -> Column:
    """A feature (type, coordinates, properties as text) as GeoJSON."""
    member = F.when(F.col("type") == "GeometryCollection", '","geometries":').otherwise('","coordinates":')
    return F.concat(F.lit('{"type":"Feature","properties":'), F.coalesce("properties", F.lit("{}")), F.lit(',"geometry":{"type":"'), F.col("type"), member, F.col("coordinates"), F.lit("}}"))


def collections(features: DataFrame) -> DataFrame:
    """file, value: the features of each file (file, idx, type, coordinates, properties) as one FeatureCollection.

    A file is one text, as it was read as one; the files are spread over tasks.
    """
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", feature_text().alias("f")))), lambda s: s["f"]), ",")
    return features.groupBy("file").agg(body.alias("body")).select("file", F.concat(F.lit('{"type":"FeatureCollection","features":['), F.col("body"), F.lit("]}")).alias("value"))


def write_geojson(kept: DataFrame, removed: int, path: str) -> str | None:
    """Features of one file beside the original, only if some were removed."""
    if not removed:
        return None
    target = path.removesuffix(".geojson") + ".dedup.geojson"
    collections(kept.withColumn("file", F.lit(path))).select("value").coalesce(1).write.mode("overwrite").text(target)
    return target


def write_deduplicated(features: DataFrame, kept: DataFrame, folder: str) -> None:
    """The files that lost features, all by one job: below folder, one folder `file=<name>.dedup.geojson` each."""
    name = F.concat(F.regexp_replace(F.regexp_extract("file", r"([^/]*)$", 1), r"\.geojson$", ""), F.lit(".dedup.geojson"))
    sizes = lambda rows, n: rows.groupBy(F.col("file").alias(f"of_{n}")).agg(F.count(F.lit(1)).alias(n))
    less = sizes(features, "before").join(sizes(kept, "after"), F.col("of_before") == F.col("of_after")).where("after < before").select(F.col("of_before").alias("changed"))
    out = collections(kept.join(less, F.col("file") == F.col("changed"), "left_semi")).withColumn("file", name)
    out.repartition("file").write.mode("overwrite").partitionBy("file").text(folder)


def archive_files(found: DataFrame, path: str) -> str:
    """The files of a cycle (path, content) as a table that a second call leaves as it is."""
    found.select("path", "content").write.mode("ignore").parquet(path)
    return path


def extract(version: DataFrame, folder: str) -> DataFrame:
    """Write the files of a version (rel_path, content) below a folder, as tools outside Spark need them; returns their paths.

    Files that are there with the same size stay, so a second call writes nothing. Each file appears under its name only
    when whole.
    """
    import posixpath
    import uuid

    import pyarrow as pa

    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            written = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                target = posixpath.normpath(f"{root}/{name}")
                if not target.startswith(root.rstrip("/") + "/"):
                    raise ValueError(f"{name} lies outside the folder")
                known = store.get_file_info(target)
                written.append(known.type != fs.FileType.File or known.size != len(content))
                if written[-1]:
                    store.create_dir(posixpath.dirname(target), recursive=True)
                    own = f"{target}.{uuid.uuid4().hex}.part"
                    with store.open_output_stream(own, compression=None) as file:
                        file.write(content)
                    store.move(own, target)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(written, pa.bool_())], names=["rel_path", "written"])

    return version.select("rel_path", "content").mapInArrow(run, "rel_path string, written boolean")


def training_config(train: str, golden: str, names: list[str]) -> str:
    """The data file of a training tool: where the training and the golden tiles are, and the class names."""
    import yaml

    if not golden:
        raise ValueError("the golden set is missing")
    return yaml.safe_dump({"train": train, "val": golden, "nc": len(names), "names": dict(enumerate(names))}, allow_unicode=True, sort_keys=False)


def dumps(rows: DataFrame) -> str:
    """The JSON text of a one-row result of this module."""
    return json.dumps(json.loads(rows.first()["json"]), ensure_ascii=False, indent=2)
