"""More registered queries: label checks over whole files, readers and writers as round trips, reports, and single functions.

Orders stand for label files: their lines become label lines of every kind, beside images that are sound, broken, missing
or doubled. What a writer has written goes back through its reader, so that a row covers both.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions import geometry as G
from tessera.functions import learning, png, text
from tessera.operators import board, crops, dedup, folds, history, pixels, qa, review, scoring, tiling, tracker, versions
from tessera.plans import cycle, head
from tessera.plans.queries import _SQL_BOXES, _SQL_CROPS, _SQL_RUNS, _SQL_SCORES, _crops, _history, _r, _rings, _scores, _sql_lines, _sql_utm, _table, query
from tessera.sources import files, sinks
from tessera.sources.staging import fresh_path as _folder


def _as_files(rows: DataFrame, value: str, folder: str, by: str = "part") -> None:
    """One text file a row, each in a folder of its own; rows are few."""
    rows.select(F.col(by).alias("part"), F.col(value).alias("value")).repartition("part").write.partitionBy("part").text(folder)


# --- label checks over whole files

_SQL_FILES = """
source as (
  select l_orderkey as key, l_linenumber as n, case when l_returnflag = 'R' and l_linenumber = 3 then 'x' else (l_linenumber % 4)::varchar end as class,
    case when l_partkey % 11 = 0 then 0.2 else l_quantity / 40 end as far, case when l_linestatus = 'O' then ' 0.5' else '' end || case when l_suppkey % 3 = 0 then '' else ' 0.25' end as rest,
    l_discount + 0.2 as d, l_tax as t
  from lineitem),
written as (
  select key, n, ' ' || (round(d, 2)) || ' ' || t || ' ' || round(far, 4) || ' ' || t || ' ' || round(d, 2) || rest as body, class from source),
twice as (select key, n, class || body || case when n = 1 and key % 5 = 0 then chr(10) || (key % 2)::varchar || body else '' end as line from written),
orders_all as (select distinct l_orderkey as key from lineitem),
labels_all as (
  select '/labels/' || key || '.txt' as path, key, key || '.txt' as file_name, case when key % 13 = 0 then '' else string_agg(line, chr(10) order by n, line) end as raw, key % 17 <> 0 as readable
  from twice where key % 6 <> 0 group by key),
images_all as (
  select key, case when key % 2 = 0 then key || '.png' else key || '.PNG' end as file_name, case when key % 10 = 0 then '/images/old/' else '/images/' end || case when key % 2 = 0 then key || '.png' else key || '.PNG' end as path,
    case when key % 10 = 0 then key % 20 = 0 else key % 19 = 0 end as broken from orders_all where key % 7 <> 0),
good as (select * from labels_all where readable and key in (select key from images_all)),
lined as (select key, path, file_name, unnest(string_split(raw, chr(10))) as line, generate_subscripts(string_split(raw, chr(10)), 1) as line_no from good where raw <> ''),"""
_SQL_CHECK = f"""{_SQL_FILES}
{_sql_lines("select key, line_no, line from lined", 3)},
numbers as (
  select key, line_no, issue, t, list_transform(list_filter(t[2:], lambda x: issue <> 'linha_malformada'), lambda x: try_cast(x as double)) as c from judged join parsed using (key, line_no)),
shaped as (
  select key, line_no, issue, t, c, list_filter(range(0, len(c) // 2), lambda i: not (c[2 * i + 1] between 0 and 1 and c[2 * i + 2] between 0 and 1)) as out,
    abs(list_sum([c[2 * i + 1] * c[(2 * i + 3) % len(c) + 1] - c[(2 * i + 2) % len(c) + 1] * c[2 * i + 2] for i in range(0, len(c) // 2)])) / 2 as area
  from numbers),
sound as (
  select key, line_no, t[1]::integer as class_id, area, list_min([c[2 * i + 1] for i in range(0, len(c) // 2)]) as x0, list_min([c[2 * i + 2] for i in range(0, len(c) // 2)]) as y0,
    list_max([c[2 * i + 1] for i in range(0, len(c) // 2)]) as x1, list_max([c[2 * i + 2] for i in range(0, len(c) // 2)]) as y1 from shaped where issue = 'ok'),
placed as (select *, row_number() over (partition by key order by line_no) as nth from sound where area >= 1e-5),
pairs as (
  select a.key, a.nth as i, b.nth as j, a.class_id as ci, b.class_id as cj,
    greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0) as common,
    (a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - common as whole, case when whole > 0 then common / whole else 0 end as iou
  from placed a join placed b on a.key = b.key and a.nth < b.nth),
findings as (
  select file_name as image, 'imagem_corrompida' as issue, 'alta' as severity, 'formato de imagem não identificado' as detail, 0 as part, path, 0 as step, 0 as i, 0 as j from images_all where broken
  union all select file_name, 'imagem_sem_label', 'alta', 'declarar como fundo se intencional', 0, path, 1, 0, 0 from images_all where key not in (select key from labels_all)
  union all select file_name, 'label_orfao', 'alta', 'sem imagem correspondente', 1, path, 0, 0, 0 from labels_all where key not in (select key from images_all)
  union all select file_name, 'linha_malformada', 'alta', 'leitura falhou: o texto não é UTF-8', 1, path, 0, 0, 0 from labels_all where not readable and key in (select key from images_all)
  union all select key || '.txt', issue, 'alta', 'L' || line_no || ': ' || issue || ': ' || case issue when 'linha_malformada' then 'invalid literal for int() with base 10: ''' || t[1] || ''''
    when 'classe_invalida' then 'class_id=' || t[1] || ' (nc=3)' when 'poligono_degenerado' then len(t) - 1 || ' coordenadas'
    else '(' || format('{{:.4f}}', c[2 * out[1] + 1]) || ', ' || format('{{:.4f}}', c[2 * out[1] + 2]) || ')' end, 1, '/labels/' || key || '.txt', 0, line_no, 0 from shaped where issue <> 'ok'
  union all select key || '.txt', 'instancia_minuscula', 'media', 'L' || line_no || ': área=' || format('{{:.2e}}', area), 1, '/labels/' || key || '.txt', 0, line_no, 0 from sound where area < 1e-5
  union all select key || '.txt', case when ci = cj then 'instancia_duplicada' else 'conflito_de_classe' end, case when ci = cj then 'media' else 'alta' end,
    case when ci = cj then 'L' || i || ' e L' || j else 'L' || i || '(cls=' || ci || ') x L' || j || '(cls=' || cj || ')' end || ': bbox-IoU=' || format('{{:.2f}}', iou), 1, '/labels/' || key || '.txt', 2, i, j from pairs where iou >= 0.85
  union all select file_name, 'label_vazio', 'media', 'arquivo sem instâncias', 1, path, 1, 0, 0 from good where raw = '' and key % 26 <> 0)"""


def _label_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Images and labels as files, and the stems of the background."""
    rows = _table(spark, sf_dir, "lineitem")
    key, n = F.col("l_orderkey"), F.col("l_linenumber")
    words = lambda c: c.cast("string")
    d, far = F.round(F.col("l_discount") + 0.2, 2), F.round(F.when(F.col("l_partkey") % 11 == 0, 0.2).otherwise(F.col("l_quantity") / 40), 4)
    tail = F.concat(F.when(F.col("l_linestatus") == "O", " 0.5").otherwise(""), F.when(F.col("l_suppkey") % 3 == 0, "").otherwise(" 0.25"))
    body = F.concat(F.lit(" "), F.concat_ws(" ", words(d), words(F.col("l_tax")), words(far), words(F.col("l_tax")), words(d)), tail)
    first = F.when((F.col("l_returnflag") == "R") & (n == 3), "x").otherwise(words(n % 4))
    again = F.when((n == 1) & (key % 5 == 0), F.concat(F.lit("\n"), words(key % 2), body)).otherwise("")
    lines = rows.select(key.alias("key"), n.alias("n"), F.concat(first, body, again).alias("line"))
    raw = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda s: s["line"]), "\n")
    whole = lines.groupBy("key").agg(raw.alias("raw"))
    content = F.when(F.col("key") % 17 == 0, F.unhex(F.lit("FFFE30"))).otherwise(F.when(F.col("key") % 13 == 0, "").otherwise(F.col("raw")).cast("binary"))
    labels = whole.where("key % 6 <> 0").select(F.concat(F.lit("/labels/"), F.col("key"), F.lit(".txt")).alias("path"), content.alias("content"))
    name = F.concat(F.col("key").cast("string"), F.when(F.col("key") % 2 == 0, ".png").otherwise(".PNG"))
    sound, bad = F.lit(png.encode(np.zeros((1, 1, 3), np.uint8))), F.lit(b"text")
    every = whole.select("key", name.alias("name"))
    kept = every.where("key % 7 <> 0")
    new = kept.select(F.concat(F.lit("/images/"), "name").alias("path"), F.when(F.col("key") % 19 == 0, bad).otherwise(sound).alias("content"))
    old = kept.where("key % 10 = 0").select(F.concat(F.lit("/images/old/"), "name").alias("path"), F.when(F.col("key") % 20 == 0, bad).otherwise(sound).alias("content"))
    notes = every.where("key % 7 = 0").select(F.concat(F.lit("/images/"), F.col("key"), F.lit(".md")).alias("path"), bad.alias("content"))
    images = files.images_of(files.named(new.unionByName(old).unionByName(notes)))
    background = every.where("key % 26 = 0").select(F.col("key").cast("string").alias("stem"))
    return images, files.labels_of(files.named(labels)), background


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    images, labels, background = _label_files(spark, sf_dir)
    return qa.check(images, labels, 3, background)


@query(f"with {_SQL_CHECK} select image, issue, severity, detail from findings")
def qa_check(spark, sf_dir):
    """All findings of images and label files: parsing, tiny and like instances, empty, unreadable and broken files, orphans."""
    return _checked(spark, sf_dir).select(*qa.FINDING)


@query(f"with {_SQL_CHECK} select image, issue, severity, detail from findings")
def qa_report(spark, sf_dir):
    """The findings through the report: written and read back."""
    folder = _folder(spark, "findings")
    sinks.write_findings(_checked(spark, sf_dir), folder)
    return files.read_findings(spark, folder).drop("place")


@query(f"""with {_SQL_CHECK}
select image, string_agg(issue || ': ' || detail, ' | ' order by part, path, step, i, j) as issues, row_number() over (order by min((part, path, step, i, j))) as place from findings where severity = 'alta' group by image""")
def severe_issues(spark, sf_dir):
    """Severe issues of each image in the order of the report, read back from it, and the images in that order."""
    folder = _folder(spark, "severe")
    sinks.write_findings(_checked(spark, sf_dir), folder)
    found = review.severe(files.read_findings(spark, folder))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("place"))  # to show the order; the plans sort instead
    return found.select("image", F.array_join("issues", " | ").alias("issues"), place.cast("long").alias("place"))


@query(f"""with {_SQL_FILES[: _SQL_FILES.index("good as")].rstrip().rstrip(",")}
select key::varchar as stem, path from images_all""")
def stem_index(spark, sf_dir):
    """The path that counts for each stem of an image."""
    return qa.stem_index(_label_files(spark, sf_dir)[0])


@query(f"""with {_SQL_FILES}
{_sql_lines("select key, line_no, line from lined", 2**31 - 1)}
select key::varchar as stem, line_no::integer as idx, t[1]::integer as class_id, list_transform(t[2:], lambda x: x::double) as coords from parsed
where regexp_matches(t[1], '^[0-9]+$') and n >= 6 and n % 2 = 0""")
def polygon_numbers(spark, sf_dir):
    """Label lines as polygons for scoring, unchecked."""
    images, labels, _ = _label_files(spark, sf_dir)
    matched = labels.where("readable").join(images.select(F.col("stem").alias("of_stem")).distinct(), F.col("stem") == F.col("of_stem"), "left_semi")
    return files.polygon_numbers(matched).select("stem", "idx", "class_id", "coords")


@query(f"""with {_SQL_FILES}
{_sql_lines("select key, line_no, line from lined", 2**31 - 1)}
select key::varchar as stem, line_no::integer as idx, (len(t) - 1) // 2 * 2 as n from parsed where regexp_matches(t[1], '^[0-9]+$') and n >= 6""")
def preview_polygons(spark, sf_dir):
    """Label lines as polygons for previews: a last odd coordinate is dropped."""
    images, labels, _ = _label_files(spark, sf_dir)
    matched = labels.where("readable").join(images.select(F.col("stem").alias("of_stem")).distinct(), F.col("stem") == F.col("of_stem"), "left_semi")
    return files.polygon_numbers(matched, strict=False).select("stem", "idx", F.size("coords").cast("long").alias("n"))


# --- polygons, manifests, histories and lists as files

_SQL_FEATURES = f"""{_SQL_BOXES},
features as (select vec_id, label, (row_number() over (partition by label order by vec_id) - 1)::integer as idx, round(x0, 6) as x0, round(y0, 6) as y0, round(x1, 6) as x1, round(y1, 6) as y1 from boxes)"""


def _features(spark: SparkSession, sf_dir: str, folder: str, doubled: bool = False) -> DataFrame:
    """Boxes of rings as GeoJSON, a file a class: polygons, collections and points by id, read back."""
    box = G.bbox("ring")
    rows = _rings(spark, sf_dir).select("vec_id", "class_id", *(F.round(box[k], 6).alias(k) for k in G.BOX))
    rows = rows.withColumn("idx", F.row_number().over(Window.partitionBy("class_id").orderBy("vec_id")) - 1)
    ring = F.array(*(F.array(F.col(x), F.col(y)) for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0"))))
    polygon, point = F.to_json(F.array(ring)), F.to_json(F.array("x0", "y0"))
    many = F.to_json(F.array(F.array(ring), F.array(ring)))
    member = F.concat(F.lit('[{"type":"Point","coordinates":'), point, F.lit('},{"type":"Polygon","coordinates":'), polygon, F.lit("}]"))
    kind = F.when(F.col("vec_id") % 4 == 0, "MultiPolygon").when(F.col("vec_id") % 4 == 1, "GeometryCollection").when(F.col("vec_id") % 8 == 2, "Point").otherwise("Polygon")
    coordinates = F.when(kind == "MultiPolygon", many).when(kind == "GeometryCollection", member).when(kind == "Point", point).otherwise(polygon)
    rows = rows.select(F.col("class_id").cast("string").alias("file"), "idx", kind.alias("type"), coordinates.alias("coordinates"), F.to_json(F.struct("vec_id")).alias("properties"))
    if doubled:
        rows = rows.unionByName(rows.where("idx % 3 = 0").withColumn("idx", F.col("idx") + 1_000_000))
    _as_files(sinks.collections(rows), "value", folder, "file")
    found = files.read_geojson(spark, folder, "*.txt")
    return found.withColumn("vec_id", F.get_json_object("properties", "$.vec_id").cast("long")).withColumn("file", F.regexp_extract("path", "part=([^/]*)/", 1))


@query(f"""with {_SQL_FEATURES}, parts as (select *, unnest(case vec_id % 4 when 0 then [0, 1] when 1 then [0] else case when vec_id % 8 = 2 then []::integer[] else [0] end end) as part from features)
select vec_id, label::varchar as file, idx, part, [x0, y0, x1, y0, x1, y1, x0, y1] as coords from parts""")
def geojson_polygons(spark, sf_dir):
    """Exterior rings of polygons, multipolygons and collections, read from GeoJSON."""
    found = _features(spark, sf_dir, _folder(spark, "geojson")).withColumn("geometry", F.struct("type", "coordinates"))
    out = tiling.polygons(found)
    return out.select("vec_id", "file", "idx", "part", F.flatten(F.transform("ring", lambda p: F.array(p["x"], p["y"]))).alias("coords"))


@query(f"""with {_SQL_FEATURES},
kept as (select * from features where vec_id % 8 <> 2),
corners as (select vec_id, k, case when k in (1, 4) then x0 else x1 end as x, case when k in (1, 2) then y0 else y1 end as y from kept, range(1, 5) r(k)),
points as (select vec_id * 10 + k as vec_id, x - 33 as lon, y - 8 as lat from corners), {_sql_utm("lon", "lat", 25)}
select vec_id // 10 as vec_id, (vec_id % 10)::integer as corner, round(easting, 3) + 0.0 as easting, round(northing, 3) + 0.0 as northing from metres""")
def vector_load(spark, sf_dir):
    """Polygons read from GeoJSON in degrees, reprojected to metres and repaired, by the index of their feature."""
    box = G.bbox("ring")
    rows = _rings(spark, sf_dir).select("vec_id", "class_id", *(F.round(box[k], 6).alias(k) for k in G.BOX)).where("vec_id % 8 <> 2")
    shift = {"x0": -33, "x1": -33, "y0": -8, "y1": -8}
    ring = F.array(*(F.array(F.col(x) + shift[x], F.col(y) + shift[y]) for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0"))))
    rows = rows.select(F.col("class_id").cast("string").alias("file"), F.col("vec_id").alias("idx"), F.lit("Polygon").alias("type"), F.to_json(F.array(ring)).alias("coordinates"), F.to_json(F.struct("vec_id")).alias("properties"))
    folder = _folder(spark, "vectors")
    _as_files(sinks.collections(rows), "value", folder, "file")
    out = tiling.load_polygons(files.read_geojson(spark, folder, "*.txt"), 25)
    out = out.select(F.get_json_object("properties", "$.vec_id").cast("long").alias("vec_id"), F.posexplode("ring").alias("corner", "p"))
    return out.select("vec_id", (F.col("corner") + 1).alias("corner"), _r("p.x", 3).alias("easting"), _r("p.y", 3).alias("northing"))


@query(f"""with {_SQL_FEATURES}
select label::varchar as file, idx, vec_id from features where label in (select label from features where idx % 3 = 0)""")
def geojson_dedup(spark, sf_dir):
    """Files whose features repeat, without the repeats: written and read back."""
    found = _features(spark, sf_dir, _folder(spark, "doubled"), doubled=True)
    target = _folder(spark, "dedup")
    rows = found.select(F.concat(F.col("file"), F.lit(".geojson")).alias("file"), "idx", "type", "coordinates", "properties")
    sinks.write_deduplicated(rows, dedup.geojson(rows), target)
    back = files.read_geojson(spark, target, "*.txt")
    name = F.regexp_extract("path", r"file=(.*)\.dedup\.geojson/", 1)
    return back.select(name.alias("file"), "idx", F.get_json_object("properties", "$.vec_id").cast("long").alias("vec_id"))


@query(f"with {_SQL_RUNS} select (row_number() over (order by seq) - 1)::bigint as seq, run_id, m, recall, m > 0.2 as promoted from numbered")
def history_file(spark, sf_dir):
    """Runs written as one JSON array and read back in file order."""
    folder = _folder(spark, "history")
    runs = _history(spark, sf_dir).select("seq", F.to_json(F.struct("run_id", "version", "metrics", "promoted")).alias("run"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "run"))), lambda s: s["run"]), ",")
    body = runs.agg(F.lit("runs").alias("part"), F.concat(F.lit("["), listed, F.lit("]")).alias("value"))
    _as_files(body, "value", folder)
    found = files.read_history(spark, f"{folder}/*.txt")
    metric = lambda k: F.try_element_at("metrics", F.lit(k))
    return found.select("seq", "run_id", metric(history.METRIC).alias("m"), metric("seg_recall").alias("recall"), "promoted")


@query(f"with {_SQL_RUNS} select run_id, seq, 2::bigint as n from numbered where seq % 2 = 0 union all select run_id, seq, 1 from numbered where seq % 2 <> 0")
def history_append(spark, sf_dir):
    """Runs appended twice to a history table; odd months once."""
    folder, rows = _folder(spark, "runs"), _history(spark, sf_dir)
    sinks.append_history(rows, folder)
    sinks.append_history(rows.where("seq % 2 = 0"), folder)
    return files.read_runs(spark, folder).groupBy("run_id", "seq").agg(F.count(F.lit(1)).alias("n"))


@query("select distinct source as stem from documents where source is not null")
def background_stems(spark, sf_dir):
    """A background manifest written and read back."""
    folder = _folder(spark, "background")
    _as_files(sinks.background_json(_table(spark, sf_dir, "documents").select(F.col("source").alias("stem"))).withColumn("part", F.lit("bg")), "json", folder)
    return files.read_background(spark, f"{folder}/*.txt")


_SQL_PATHS = "select 'labels/' || source || '/' || doc_id || '.txt' as rel_path, sha256(coalesce(text, '')) as sha256, octet_length(encode(coalesce(text, ''))) as size from documents"


def _files_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    path = F.concat(F.lit("labels/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return docs.select(path.alias("rel_path"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))


@query(f"select rel_path, sha256, size from ({_SQL_PATHS})")
def version_table(spark, sf_dir):
    """A version written with its contents by one pass; its manifest read back without them."""
    rows = _files_of(spark, sf_dir)
    path = sinks.write_version(rows.select(*versions.scan_columns(), "content"), _folder(spark, "versions"), 1)
    return spark.read.parquet(path).drop("content")


@query(f"with f as ({_SQL_PATHS}) select 'v1' as version, 0::bigint as count_images, count(*) as count_labels, null::varchar as rel_path, null::varchar as sha256, null::bigint as size from f union all select null, null, null, rel_path, sha256, size from f")
def manifest_lines(spark, sf_dir):
    """A manifest as lines of JSON, read back."""
    folder, none = _folder(spark, "manifest"), F.lit(None).cast("string")
    sinks.manifest_lines(versions.scan(_files_of(spark, sf_dir)), F.lit("v1"), none, F.lit("now"), none).write.text(folder)
    return spark.read.schema("version string, count_images long, count_labels long, rel_path string, sha256 string, size long").json(folder)


@query(f"""with f as ({_SQL_PATHS}), ab as (select unnest(['adicionados', 'removidos', 'modificados']) as kind)
select kind, rel_path from ab join f on kind = 'adicionados'""")
def changelog(spark, sf_dir):
    """The changelog of a first version, as JSON: paths by kind."""
    rows = versions.scan(_files_of(spark, sf_dir))
    body = sinks.changelog_json(versions.diff(rows.limit(0), rows), F.lit(None).cast("string"), F.lit("v1"))
    parsed = F.from_json("json", "adicionados array<string>, removidos array<string>, modificados array<string>")
    told = body.select(parsed.alias("j"))
    kinds = ("adicionados", "removidos", "modificados")
    return told.select(F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"j.{k}").alias("paths")) for k in kinds))).alias("s")).select("s.kind", F.explode("s.paths").alias("rel_path"))


@query(f"with f as ({_SQL_PATHS}) select rel_path, size from f")
def version_extract(spark, sf_dir):
    """The files of a version written below a folder, as tools outside Spark read them, and listed."""
    target = _folder(spark, "extract")
    sinks.extract(_files_of(spark, sf_dir), target).write.format("noop").mode("overwrite").save()
    found = files.read_files(spark, target, "*.txt")
    return found.select(files.relative(F.col("path"), target.removeprefix("file://")).alias("rel_path"), F.col("length").alias("size"))


@query("select page_id, octet_length(encode(html)) as n from pages")
def archive_once(spark, sf_dir):
    """The files of a cycle archived; a second call changes nothing."""
    rows = _table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("path"), F.col("html").cast("binary").alias("content"))
    folder = _folder(spark, "archive")
    sinks.archive_files(rows, folder)
    sinks.archive_files(rows.limit(0), folder)
    return spark.read.parquet(folder).select(F.col("path").cast("long").alias("page_id"), F.octet_length("content").cast("long").alias("n"))


# --- reports

@query("select vec_id::varchar as image, format('{:.4f}', label / 8.0::double) as score, format('{:.4f}', (vec_id % 1000) / 1000.0::double) as mean_iou, label::integer as n_gt from embeddings")
def scores_report(spark, sf_dir):
    """Scores written with four decimals and read back as text."""
    number = lambda c: c.cast("double")
    rows = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("image"), number(F.col("label") / 8).alias("score"), number((F.col("vec_id") % 1000) / 1000).alias("mean_iou"), F.lit(0.5).alias("gt_perdidos_ratio"),
        F.lit(0.25).alias("ghost_conf"), F.col("label").alias("n_gt"), F.lit(1).alias("n_pred"))
    folder = _folder(spark, "scores")
    sinks.write_scores(rows, folder)
    return spark.read.csv(folder, header=True, schema="image string, score string, mean_iou string, gt_perdidos_ratio string, ghost_conf string, n_gt int, n_pred int").select("image", "score", "mean_iou", "n_gt")


@query(f"""with recursive {_SQL_BOXES}, {_SQL_SCORES}
select image from scores where mean_iou < 0.55 or gt_perdidos_ratio > 0.34 or ghost_conf > 0.7""")
def suspicious_images(spark, sf_dir):
    return scoring.suspicious(_scores(spark, sf_dir)).select("image")


@query(f"""with {_SQL_BOXES},
folds as (select distinct image, (image % 3)::integer as fold from boxes),
seen as (select f.k as fold, label, avg(x0) as x0, avg(y0) as y0, avg(x1) as x1, avg(y1) as y1, count(*) as n from boxes join folds using (image), range(3) f(k) where folds.fold <> f.k group by f.k, label)
select image::varchar as image, label as idx, round(n / sum(n) over (partition by image), 9) as conf, round(x0, 9) + 0.0 as x0, round(y1, 9) + 0.0 as y1 from folds join seen using (fold)""")
def out_of_fold(spark, sf_dir):
    """Predictions for each image by a model that never saw its fold: the mean box of every class."""
    rows = _rings(spark, sf_dir).select(F.col("image").cast("string").alias("image"), "class_id", G.bbox("ring").alias("box"), (F.col("image") % 3).alias("group"))
    parts = list(cycle.out_of_fold(rows, cycle.Prototypes, 3, "group"))
    found = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return found.select("image", "idx", _r("conf").alias("conf"), _r("box.x0").alias("x0"), _r("box.y1").alias("y1"))


@query(f"""with {_SQL_CHECK},
first as (select image, string_agg(issue || ': ' || detail, ' | ' order by part, path, step, i, j) as issues, min((part, path, step, i, j)) as place from findings where severity = 'alta' group by image)
select image, 'qa_alta' as reason, 'inf' as score, issues from first order by place limit 40""")
def batch_report(spark, sf_dir):
    """The batch of a cycle, severe findings in the order of the report, written and read back."""
    none = spark.createDataFrame([], "image string, mean_iou double, gt_perdidos_ratio double, ghost_conf double, score double, n_gt int, n_pred int")
    path = sinks.write_queue(review.queue(_checked(spark, sf_dir), none), _folder(spark, "batch"), 3)
    return spark.read.csv(path, header=True, escape='"').select("image", "reason", "score", "issues")


@query("""select doc_id, case when n_chars % 3 > 0 or n_chars % 7 > 3 or (n_chars % 5 < 4 and n_chars % 2 = 1) then
  concat_ws(chr(10), case when n_chars % 3 > 0 then '- **' || (n_chars % 3 * 25) || '%** das anotações não foram detectadas' end,
    case when n_chars % 7 > 3 then '- predição fantasma com conf **' || format('{:.2f}', (n_chars % 7) / 6.0::double) || '** onde não há rótulo' end,
    case when n_chars % 5 < 4 and n_chars % 2 = 1 then '- IoU médio entre GT e predição **' || format('{:.2f}', (n_chars % 5) / 4.0::double) || '** (baixo)' end) else '- (motivo genérico)' end as reasons from documents where n_chars is not null""")
def suspicion_reasons(spark, sf_dir):
    """Why an image is suspect, as the cards say it."""
    n = F.col("n_chars")
    told = text.suspicion_reasons((n % 3) * 0.25, (n % 7) / 6, (n % 5) / 4, n % 2)
    return _table(spark, sf_dir, "documents").where("n_chars is not null").select("doc_id", told.alias("reasons"))


@query(f"""with {_SQL_RUNS}
select run_id, 'v' || seq || ' · run · seg_mAP50-95=' || format('{{:.4f}}', round(m, 3)) as title, '| métrica | valor |' || chr(10) || '|---|---|' || chr(10) || '| seg_mAP50-95 | ' || format('{{:.4f}}', round(m, 3)) || ' |' || chr(10) ||
  '| seg_recall | ' || format('{{:.4f}}', round(recall, 3)) || ' |' as body, case when m > 0.2 then 'Aprovado' else 'Avaliado' end as state from numbered""")
def run_cards(spark, sf_dir):
    """Titles, metric tables and states of the cards of runs."""
    short = F.transform_values("metrics", lambda _, v: F.round(v, 3))
    return _history(spark, sf_dir).select("run_id", text.run_title(F.col("version"), F.col("tag"), short).alias("title"), text.metrics_table(short).alias("body"), text.run_state("promoted").alias("state"))


@query("select vec_id, '**imagem:** `' || vec_id || '`' || chr(10) || '**motivo:** xval' || chr(10) || 'score: ' || format('{:.4f}', label / 8.0::double) || chr(10) || 'mean_iou: 0.5000' || chr(10) || 'gt_perdidos_ratio: 0.2500' || chr(10) || 'ghost_conf: 0.7500' || chr(10) || 'n_gt: ' || label || ' · n_pred: 3' || case when label % 2 = 0 then chr(10) || '**achados QA:**' || chr(10) || '- x: 1' else '' end as body from embeddings")
def review_cards(spark, sf_dir):
    """The bodies of review cards."""
    label = F.col("label")
    signals = {"score": (label / 8).cast("double"), "mean_iou": F.lit(0.5), "gt_perdidos_ratio": F.lit(0.25), "ghost_conf": F.lit(0.75), "n_gt": label, "n_pred": F.lit(3)}
    issues = F.when(label % 2 == 0, F.array(F.lit("x: 1"))).otherwise(F.array().cast("array<string>"))
    return _table(spark, sf_dir, "embeddings").select("vec_id", text.review_body(F.col("vec_id").cast("string"), F.lit("xval"), signals, issues).alias("body"))


@query(f"""with {_SQL_CROPS}, one as (select quality as t, pred as p from crops),
c as (select 1 as label, count(*) filter (t = 1 and p = 1) as tp, count(*) filter (t = 0 and p = 1) as fp, count(*) filter (t = 1 and p = 0) as fn from one
  union all select 0, count(*) filter (t = 0 and p = 0), count(*) filter (t = 1 and p = 0), count(*) filter (t = 0 and p = 1) from one)
select case label when 1 then 'daninha' else 'cultivo' end as label, round(coalesce(tp / (tp + fp), 0), 9) as precision, round(coalesce(tp / (tp + fn), 0), 9) as recall, round(coalesce(2 * tp / (2 * tp + fp + fn), 0), 9) as f1, tp + fn as support from c""")
def class_report(spark, sf_dir):
    rows = crops.class_report(_crops(spark, sf_dir), "label", "pred")
    return rows.select("label", *(_r(c).alias(c) for c in ("precision", "recall", "f1")), "support")


_SQL_SUSPECTS = f"""{_SQL_CROPS}, suspects as (select doc_id, source, case when prob <= 0.5 then 'misclass' else 'low_conf' end as kind, prob from crops where quality = 1 and prob < 0.6)"""


@query(f"with {_SQL_SUSPECTS} select count(*) as n, count(*) filter (kind = 'misclass') as n_misclass, count(*) filter (kind = 'low_conf') as n_low_conf from suspects")
def suspect_counts(spark, sf_dir):
    return crops.suspect_counts(crops.suspects(_crops(spark, sf_dir)))


@query(f"with {_SQL_SUSPECTS} select doc_id as polygon_id, row_number() over (order by case kind when 'misclass' then 0 else 1 end, prob, source, doc_id) as place from suspects")
def suspect_order(spark, sf_dir):
    """The order of the crop report, as the rows come back from it."""
    folder = _folder(spark, "suspects")
    sinks.write_suspects(crops.suspect_order(crops.suspects(_crops(spark, sf_dir))), folder)
    back = spark.read.csv(folder, header=True).select(F.col("polygon_id").cast("long").alias("polygon_id"), F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()).alias("at"))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("at"))  # to show the order
    return back.select("polygon_id", place.cast("long").alias("place"))


# --- folds, trackers, single functions


@query("select distinct regexp_replace(source || '_r1_c2', '_r[0-9]+_c[0-9]+$', '') as field from documents union select distinct r_name from region")
def field_names(spark, sf_dir):
    """The fields of live and golden tiles."""
    live = _table(spark, sf_dir, "documents").select(F.concat(F.col("source"), F.lit("_r1_c2")).alias("stem"))
    return files.fields(live, _table(spark, sf_dir, "region").select(F.col("r_name").alias("stem")))


@query("""select held_out, doc_id, case when source = held_out then 'val' else 'train' end as role from documents, (values ('src1'), ('src2')) h(held_out)""")
def hold_out_roles(spark, sf_dir):
    """Every item with its role for each of two held-out fields."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return folds.leave_one_out_roles(docs, "source", ["src1", "src2"]).select("held_out", "doc_id", "role")


@query("select distinct source as held_out from documents where source is not null and source not in ('src1', 'src4')")
def pending_folds(spark, sf_dir):
    """Held-out fields that lack a run."""
    past = spark.createDataFrame([("loo_src1",), ("loo_src4",), ("other",)], "tag string")
    loo = folds.leave_one_out(_table(spark, sf_dir, "documents").where("source is not null"), "source")
    return folds.pending(loo.select("held_out").distinct(), past)


@query("""select distinct stem, case when regexp_replace(stem, '_r[0-9]+_c[0-9]+$', '') in ('src3', 'src7') then 'golden' else 'live' end as split
from (select source || '_r' || doc_id % 3 || '_c1' as stem from documents union all select source || '_r' || doc_id % 5 || '_c1' from documents)""")
def background_split(spark, sf_dir):
    """The union of two background manifests, dealt to golden and live."""
    docs = _table(spark, sf_dir, "documents")
    stems = lambda k: docs.select(F.concat(F.col("source"), F.lit("_r"), (F.col("doc_id") % k).cast("string"), F.lit("_c1")).alias("stem"))
    return folds.split_stems(stems(3).unionByName(stems(5)), text.group_key("stem"), ["src3", "src7"])


@query(f"with {_SQL_RUNS} select 'loo_' || run_id as tag, run_id as held_out, m as map50_95, 0.0::double as map50, 0.0::double as precision, recall from numbered where seq % 2 = 0")
def fold_table(spark, sf_dir):
    """One row a leave-one-out run."""
    rows = _history(spark, sf_dir).withColumn("tag", F.when(F.col("seq") % 2 == 0, F.concat(F.lit("loo_"), "run_id")).otherwise("other"))
    return history.fold_table(rows).select(F.concat(F.lit("loo_"), "held_out").alias("tag"), "held_out", "map50_95", "map50", "precision", "recall")


@query("select greatest(count(*) filter (event_type = 'purchase'), 1) as n from events")
def cycle_number(spark, sf_dir):
    """The number of issues with a label, as the number of a cycle."""
    rows = _table(spark, sf_dir, "events").select(F.array(F.col("event_type")).alias("labels"))
    return tracker.labelled(rows, "purchase", 1)


@query("select 'click' as state, count(*) as n from events where event_type = 'click' having count(*) >= 5")
def ready_alert(spark, sf_dir):
    """The alert for a state with enough issues."""
    counts = tracker.state_counts(_table(spark, sf_dir, "events"), "event_type", ["click", "purchase"])
    return tracker.ready(counts, "click", 5).select("state", "n")


@query("""with e as (select user_id, arg_max(event_type, event_id) as state from events group by user_id)
select user_id::varchar as id, state from e""")
def board_states(spark, sf_dir):
    """Issues of a board as they stand: the last of their events."""
    events = _table(spark, sf_dir, "events")
    first = events.groupBy("user_id").agg(F.min("event_id").alias("first"))
    rows = events.join(first.select(F.col("user_id").alias("of_user"), "first"), F.col("user_id") == F.col("of_user"))
    none = lambda kind: F.lit(None).cast(kind)
    rows = rows.select(
        F.col("event_id").alias("at"), F.when(F.col("event_id") == F.col("first"), "issue").otherwise("move").alias("kind"), F.col("user_id").cast("string").alias("issue"), F.lit("t").alias("title"), none("string").alias("body"),
        F.col("event_type").alias("state"), none("array<string>").alias("labels"), none("string").alias("parent"), none("string").alias("name"))
    folder = _folder(spark, "board")
    rows.write.parquet(f"{folder}/events")
    return board.TableTracker(spark, folder).issue_table().select("id", "state")


@query("select l_linenumber as place, count(*) as n from lineitem where l_discount >= 0.05 group by l_linenumber")
def confident_predictions(spark, sf_dir):
    """Predictions of enough confidence."""
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("place"), F.col("l_discount").alias("conf"))
    return scoring.confident(rows, 0.05).groupBy("place").agg(F.count(F.lit(1)).alias("n"))


@query("""select s_suppkey, substr(sha256('cfg|' || s_name || ':' || s_nationkey || ':1|b:2:3'), 1, 16) as signature from supplier""")
def site_signature(spark, sf_dir):
    entry = lambda name, size, mtime: F.struct(name.alias("basename"), size.alias("size"), mtime.alias("mtime"))
    found = F.array(entry(F.col("s_name"), F.col("s_nationkey"), F.lit(1)), entry(F.lit("b"), F.lit(2), F.lit(3)))
    return _table(spark, sf_dir, "supplier").select("s_suppkey", crops.site_signature(F.lit("cfg"), found).alias("signature"))


@query("""select p_partkey, replace(replace(p_type, ' ', '-'), '/', '-') as tag, case p_partkey % 4 when 0 then 'image/png' when 1 then 'image/jpeg' when 2 then 'image/jpeg' else 'application/octet-stream' end as mime,
  ['png', 'jpg', 'jpeg', 'tif'][p_partkey % 4 + 1] as ext, 'x.' || p_partkey as stem, format('{:.2e}', sqrt(p_retailprice) / 1000) as scientific from part""")
def names_and_types(spark, sf_dir):
    """Cleaned tags, upload types, extensions and stems of paths, numbers with an exponent."""
    ext = F.element_at(F.array(*map(F.lit, (".png", ".JPG", ".jpeg", ".tif"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    path = F.concat(F.lit("a.b/x."), F.col("p_partkey").cast("string"), ext)
    return _table(spark, sf_dir, "part").select("p_partkey", text.clean_tag("p_type").alias("tag"), text.mime_type(path).alias("mime"), text.extension(path).alias("ext"), text.file_stem(path).alias("stem"), qa.scientific(F.sqrt("p_retailprice") / 1000).alias("scientific"))


@query("select source as site, sum(greatest(n_chars - 500, 0))::bigint as n_polygons from documents where doc_id % 3 <> 0 group by source")
def polygon_totals(spark, sf_dir):
    rows = _table(spark, sf_dir, "documents").select(F.col("source").alias("site"), (F.col("doc_id") % 3 != 0).alias("exists"), (F.col("n_chars") - 500).alias("n_polygons"))
    return crops.polygon_total(rows)


@query("select o_orderkey, coalesce(case when o_orderkey % 2 = 0 then o_totalprice end, case when o_orderkey % 3 = 0 then -1.0 end, 0.0)::double as value from orders")
def metric_fallback(spark, sf_dir):
    """The mask metric, else the box metric, else 0."""
    entry = lambda k, v, when: F.when(when, F.create_map(F.lit(k), v)).otherwise(F.create_map().cast("map<string,double>"))
    metrics = F.map_concat(entry("mask", F.col("o_totalprice"), F.col("o_orderkey") % 2 == 0), entry("box", F.lit(-1.0), F.col("o_orderkey") % 3 == 0))
    return _table(spark, sf_dir, "orders").select("o_orderkey", learning.metric(metrics, "mask", "box").alias("value"))


@query(f"""with {_SQL_BOXES}, wide as (select vec_id, x0 * 3000 as x0, y0 * 3000 as y0, x1 * 3000 as x1, y1 * 3000 as y1 from boxes)
select vec_id, round((x0 + x1) / 2, 4) + 0.0 as x, round((y0 + y1) / 2, 4) + 0.0 as y from wide
where (x0 + x1) / 2 >= 0 and (x0 + x1) / 2 < 1500 and (y0 + y1) / 2 >= 0 and (y0 + y1) / 2 < 1600 and (x1 - x0) * (y1 - y0) >= 1e6""")
def usable_polygons(spark, sf_dir):
    """Polygons whose centroid lies in the raster and whose box is large enough, with their centroids."""
    ring = lambda b: F.array(*(F.struct((b[x] * 3000).alias("x"), (b[y] * 3000).alias("y")) for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"))))
    rows = _rings(spark, sf_dir).select("vec_id", G.bbox("ring").alias("b"))
    rows = rows.select("vec_id", ring(F.col("b")).alias("ring"), F.lit(1500).alias("width"), F.lit(1600).alias("height"))
    return crops.usable(rows, 1e6).select("vec_id", _r("centroid.x", 4).alias("x"), _r("centroid.y", 4).alias("y"))


@query("""with f as (select n_nationkey as k, 't' || n_nationkey as talhao from nation)
select talhao, case when k % 5 <> 4 then case when k % 3 = 0 then talhao || '/imagem/a.tif' else talhao || '/z.TIF' end end as tif_path,
  case when k % 4 <> 3 then [case when k % 2 = 0 then talhao || '/daninhas/FolhaLarga.geojson' else talhao || '/folha.geojson' end] else []::varchar[] end as geojsons, k % 5 <> 4 and k % 4 <> 3 as is_complete
from f where k % 5 <> 4 or k % 4 <> 3""")
def field_pairs(spark, sf_dir):
    """Rasters and polygon files found for each field, nested folders before flat ones, and whether both are there."""
    k = F.col("n_nationkey")
    name = F.concat(F.lit("t"), k.cast("string"))
    at = lambda suffix: F.concat(name, F.lit(suffix))
    paths = F.concat(
        F.when(k % 5 != 4, F.when(k % 3 == 0, F.array(at("/imagem/a.tif"), at("/a0.tif"))).otherwise(F.array(at("/z.TIF")))).otherwise(F.array().cast("array<string>")),
        F.when(k % 4 != 3, F.when(k % 2 == 0, F.array(at("/daninhas/FolhaLarga.geojson"), at("/folha.geojson"))).otherwise(F.array(at("/folha.geojson")))).otherwise(F.array().cast("array<string>")),
        F.array(at("/unknown.geojson")),
    )
    found = tiling.pairs(_table(spark, sf_dir, "nation").select(F.explode(paths).alias("path")), {"Folha": 0, "FolhaLarga": 1})
    found = found.where("tif_path is not null or size(geojsons) > 0")
    return found.select("talhao", "tif_path", F.transform("geojsons", lambda g: g["path"]).alias("geojsons"), "is_complete")


@query("""with t as (select p_partkey as k, p_size as s from part)
select k::varchar as stem, case when s % 2 = 0 then k || '.jpg' else k || '.png' end as path from t where s % 3 <> 0 order by k limit 1""")
def tile_by_stem(spark, sf_dir):
    """The path of a tile by its stem, by the first of its types: of the first part that has one."""
    rows = _table(spark, sf_dir, "part").where("p_size % 3 <> 0")
    kinds = F.when(F.col("p_size") % 2 == 0, F.array(F.lit("png"), F.lit("jpg"), F.lit("tif"))).otherwise(F.array(F.lit("png"), F.lit("tif")))
    images = files.named(rows.select(F.explode(F.transform(kinds, lambda e: F.concat(F.col("p_partkey").cast("string"), F.lit("."), e))).alias("path")))
    stem = str(rows.agg(F.min("p_partkey").alias("k")).first()["k"])
    return spark.createDataFrame([(stem, files.tile_path(images, stem))], "stem string, path string")


@query("""with t as (select s_suppkey as k, s_suppkey % 50 as x, s_suppkey % 37 as y from supplier)
select k as crop, 40 * 30 as n, (greatest(0, least(x + 8, 40) - greatest(x - 8, 0)) * greatest(0, least(y + 8, 30) - greatest(y - 8, 0)))::bigint as inside from t""")
def centred_crops(spark, sf_dir):
    """Squares around points of a raster, zero beyond it: how many pixels show the raster, whose pixels all are 9."""
    raster = np.full((30, 40, 1), 9, np.uint8)
    rasters = spark.createDataFrame([("r", bytearray(png.encode(raster)))], "path string, content binary")
    points = _table(spark, sf_dir, "supplier").select(F.lit("r").alias("path"), F.col("s_suppkey").alias("crop"), (F.col("s_suppkey") % 50).cast("double").alias("column"), (F.col("s_suppkey") % 37).cast("double").alias("row"))
    count = F.udf(lambda content: int((png.decode(bytes(content)) == 9).sum()), "long")
    return pixels.crop_pixels(rasters, points, 16).select("crop", F.lit(raster.size).alias("n"), count("image").alias("inside"))


@query("""with t as (select p_partkey as k, (p_partkey % 7) * 8 as x_off, (p_partkey % 5) * 6 as y_off from part)
select k::varchar as stem, round(least(greatest(36 - x_off, 0), least(16, 64 - x_off)) / least(16, 64 - x_off)::double, 9) as valid_ratio from t""")
def tile_pixels(spark, sf_dir):
    """Tiles cut from a raster, with the share that its alpha band shows: the left 36 of 64 columns."""
    raster = np.full((48, 64, 4), 255, np.uint8)
    raster[:, 36:, 3] = 0
    rasters = spark.createDataFrame([("r", bytearray(png.encode(raster)))], "path string, content binary")
    k = F.col("p_partkey")
    tiles = _table(spark, sf_dir, "part").select(F.lit("r").alias("path"), k.cast("string").alias("stem"), ((k % 7) * 8).cast("int").alias("x_off"), ((k % 5) * 6).cast("int").alias("y_off"), F.lit(16).alias("size"))
    return pixels.tile_pixels(rasters, tiles).select("stem", _r("valid_ratio").alias("valid_ratio"))


@query(f"""with {_SQL_BOXES}, wide as (select vec_id, x0 * 3000 as x0, y0 * 3000 as y0, x1 * 3000 as x1, y1 * 3000 as y1 from boxes),
starts as (select unnest([0, 896, 1792, 1976]) as s, unnest([0, 1, 2, 3]) as k),
tiles as (
  select vec_id, vec_id || '_r' || lpad(y.k::varchar, 3, '0') || '_c' || lpad(x.k::varchar, 3, '0') as stem, (vec_id + x.k + y.k) % 5 / 4.0::double as valid,
    greatest(least(x1, x.s + 1024) - greatest(x0, x.s), 0) * greatest(least(y1, y.s + 1024) - greatest(y0, y.s), 0) as area from wide, starts x, starts y)
select vec_id::varchar as talhao, stem, case when area >= 1e-4 * 1024 * 1024 then 1 else 0 end as n, area < 1e-4 * 1024 * 1024 as background from tiles
where valid >= 0.5 and (area >= 1e-4 * 1024 * 1024 or ('0x' || substr(sha256('42:' || stem), 1, 8))::bigint / 4294967296.0::double <= 0.05)""")
def tile_labels(spark, sf_dir):
    """The label files of tiles: enough valid pixels, polygons or a place among the background."""
    box = G.bbox("ring")
    corner = lambda x, y: F.struct((box[x] * 3000).alias("x"), (box[y] * 3000).alias("y"))
    rings = _rings(spark, sf_dir).select(F.col("vec_id").cast("string").alias("talhao"), "class_id", F.lit(3000).alias("width"), F.lit(3000).alias("height"), F.array(*(corner(x, y) for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1")))).alias("ring"))
    tiles = tiling.windows(rings.select("talhao", "width", "height"))
    tiles = tiles.withColumn("valid_ratio", (F.col("talhao").cast("long") + F.col("row") + F.col("col")) % 5 / 4)
    found = tiling.label_files(tiles, tiling.tile_polygons(rings))
    return found.select("talhao", "stem", F.size("lines").alias("n"), "background")


@query("select s_suppkey, round((s_suppkey % 256) / 255.0::double, 4) as mean, 0.0::double as spread from supplier")
def crop_features(spark, sf_dir):
    """Features of crops of one colour by the backbone: their mean, and no spread."""
    drawn = F.udf(lambda v: png.encode(np.full((28, 28, 3), v, np.uint8)), "binary")
    crops_ = _table(spark, sf_dir, "supplier").select("s_suppkey", drawn((F.col("s_suppkey") % 256).cast("int")).alias("image"))
    at = lambda k: F.col("features")[k].cast("double")
    return head.with_features(crops_).select("s_suppkey", _r(at(0), 4).alias("mean"), _r(at(3), 4).alias("spread"))


class _Fixed:
    """A trainer that always reports the same metrics."""

    def train(self, version: DataFrame, golden: DataFrame) -> tuple[dict[str, float], str]:
        return {"seg_mAP50-95": 0.9, "seg_recall": 1.0}, "w.pt"


@query("""with runs as (select strftime(o_orderdate, '%Y%m')::bigint as seq, round(avg(o_totalprice) / 1000000, 4) as m from orders group by 1)
select max(seq) + 1 as seq, 'v7' as version, 'a-b' as tag, true as promoted, 'ganho real de +' || format('{:.4f}', 0.9 - max(m)) || ' em seg_mAP50-95' as verdict from runs""")
def train_run(spark, sf_dir):
    """A run trained, judged against all before, and its history row."""
    docs = _table(spark, sf_dir, "documents")
    past = _history(spark, sf_dir, 4)
    return cycle.train(spark, _Fixed(), 7, docs, docs, past, {"arch": "a"}, "a b").select("seq", "version", "tag", "promoted", "verdict")


@query(f"""with recursive {_SQL_BOXES}, {_SQL_SCORES}, flagged as (select image, 1 - mean_iou + gt_perdidos_ratio + ghost_conf as score from scores),
queued as (select image from flagged order by round(score, 9) desc, image limit 40)
select 'Revisar ' || image as title, 'Selecionadas' as state, true as below from queued union all select 'Lote ciclo 3', 'Selecionadas', false""")
def review_board(spark, sf_dir):
    """The cards that a batch makes on a board, as the board shows them."""
    none = spark.createDataFrame([], "image string, issue string, severity string, detail string")
    scores = _scores(spark, sf_dir).withColumn("score", F.round("score", 9))
    own = board.TableTracker(spark, _folder(spark, "cards"))
    everything = scoring.Thresholds(mean_iou_below=1.1)  # few of these images are suspect
    cycle.create_cards(review.queue(none, scoring.suspicious(scores, everything)), own, 3)
    return own.issue_table().select("title", "state", F.col("parent").isNotNull().alias("below"))


@query("""with e as (select event_id as epoch, round((event_id * 7919 % 1000) / 1000.0::double, 3) as f1 from events where event_id < 500),
g as (select *, f1 > coalesce(max(f1) over (order by epoch rows between unbounded preceding and 1 preceding), -1) as gain from e),
a as (select *, max(case when gain then epoch end) over (order by epoch) as gained from g),
s as (select min(epoch) filter (epoch - gained >= 7) as stopped, max(epoch) as latest from a)
select max(gained) as best_epoch, max(coalesce(stopped, latest)) as stop_epoch from a, s where stopped is null or epoch <= stopped""")
def early_stop(spark, sf_dir):
    """Where training stops after seven epochs without a gain."""
    rows = _table(spark, sf_dir, "events").where("event_id < 500").select(F.col("event_id").alias("epoch"), F.round((F.col("event_id") * 7919 % 1000) / 1000, 3).alias("f1"))
    return history.early_stop(rows)


@query("select event_type as state, count(*) as n from events group by event_type")
def state_stream(spark, sf_dir):
    """Issues by state, counted by a stream over the event file."""
    from tessera.streaming import watch

    base = _folder(spark, "states")
    issues = watch.issue_stream(spark, sf_dir, _table(spark, sf_dir, "events").schema, "events.parquet").select(F.col("event_type").alias("state"))
    watch.collect_counts(issues, "state", f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema("state string, n long").parquet(f"{base}/out")


def iso(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssXXX")


@query("select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') as at from events")
def iso_times(spark, sf_dir):
    """Times to the second, as manifests and runs bear them."""
    return _table(spark, sf_dir, "events").select("event_id", F.substring(iso(F.col("ts").cast("timestamp")), 1, 19).alias("at"))
