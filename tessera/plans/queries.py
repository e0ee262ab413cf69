"""The registered queries of the engine and their DuckDB SQL.

The given tables hold no images, so each operator runs on a stand-in, whole: a 64-float embedding is a ring of 32 points
(x the odd, y the even components, plus one half), an image holds the vectors of forty ids, documents stand for files and
customers for crops. Floating results are rounded to nine decimals before they leave.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import geometry as G
from tessera.functions import learning, text
from tessera.operators import crops, dedup, folds, history, qa, review, scoring, tiling, tracker, versions
from tessera.sources.staging import fresh_path
from tessera.streaming import watch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _r(c: Column | str, places: int = 9) -> Column:
    """Rounded, and no negative zero."""
    return F.round(G.col(c), places) + F.lit(0.0)


_SQL_RING = "list_transform(range(0, 32), lambda i: {'x': embedding[2 * i + 1]::double + 0.5, 'y': embedding[2 * i + 2]::double + 0.5})"
_SQL_BOXES = f"""
rings as (select vec_id, label, {_SQL_RING} as ring from embeddings),
boxes as (
  select vec_id, label, vec_id // 40 as image, list_min([p.x for p in ring]) as x0, list_min([p.y for p in ring]) as y0,
    list_max([p.x for p in ring]) as x1, list_max([p.y for p in ring]) as y1,
    abs(list_sum([ring[i].x * ring[i % 32 + 1].y - ring[i % 32 + 1].x * ring[i].y for i in range(1, 33)])) / 2 as area
  from rings)"""
_SQL_IOU = """
  greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0) as common,
  (a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - common as whole,
  case when whole > 0 then common / whole else 0 end as iou"""


def _rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("class_id"), F.transform(F.col("embedding").cast("array<double>"), lambda v: v + 0.5).alias("c"))
    return rows.select("vec_id", "class_id", F.floor(F.col("vec_id") / 40).alias("image"), G.points("c").alias("ring"))


# --- label checks

_NUMBER = r"(?i)^[+-]?(([0-9]+(_[0-9]+)*)(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)(e[+-]?[0-9]+(_[0-9]+)*)?$|^[+-]?(inf|infinity|nan)$"


def _sql_lines(source: str, classes: int) -> str:
    return f"""
tokens as (select key, line_no, string_split_regex(trim(regexp_replace(line, '\\s+', ' ', 'g')), ' ') as t from ({source}) where regexp_matches(line, '\\S')),
parsed as (
  select key, line_no, t, len(t) - 1 as n,
    regexp_matches(t[1], '^[+-]?[0-9]+(_[0-9]+)*$') and len(list_filter(t[2:], lambda x: not regexp_matches(x, '{_NUMBER}'))) = 0 as whole from tokens),
judged as (
  select key, line_no, case when not whole then 'linha_malformada'
    when coalesce(try_cast(replace(t[1], '_', '') as bigint), -1) not between 0 and {classes - 1} then 'classe_invalida'
    when n < 6 or n % 2 <> 0 then 'poligono_degenerado'
    when len(list_filter(t[2:], lambda x: not coalesce(try_cast(replace(x, '_', '') as double), -1) between 0 and 1)) > 0 then 'coord_fora_do_range' else 'ok' end as issue
  from parsed)"""


@query(f"""with {_sql_lines("select doc_id as key, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as line_no from documents", 3)}
select key as doc_id, issue, count(*) as n, min(line_no)::integer as first_line from judged group by key, issue""")
def qa_parse_lines(spark, sf_dir):
    """Lines of documents as label lines, by document and issue."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("raw"))
    judged = qa.lines(docs).select("doc_id", "line_no", F.coalesce(qa.parse("line", 3)["issue"], F.lit("ok")).alias("issue"))
    return judged.groupBy("doc_id", "issue").agg(F.count(F.lit(1)).alias("n"), F.min("line_no").alias("first_line"))


_LINE = "case when l_returnflag = 'R' then 'x' else (l_linenumber - 1)::varchar end || ' ' || l_discount || ' ' || l_tax || ' ' || (l_quantity / 40) || ' ' || l_tax || ' ' || l_discount || case when l_linestatus = 'O' then ' 0.5' else '' end || case when l_suppkey % 3 = 0 then '' else ' 0.25' end"


@query(f"""with {_sql_lines(f"select l_linenumber as key, 1 as line_no, {_LINE} as line from lineitem", 3)}
select key as line_number, issue, count(*) as n from judged group by key, issue""")
def qa_label_lines(spark, sf_dir):
    """Label lines made of order lines: every kind of issue, by line number."""
    rows = _table(spark, sf_dir, "lineitem")
    class_id = F.when(F.col("l_returnflag") == "R", "x").otherwise((F.col("l_linenumber") - 1).cast("string"))
    tail = [F.when(F.col("l_linestatus") == "O", " 0.5").otherwise(""), F.when(F.col("l_suppkey") % 3 == 0, "").otherwise(" 0.25")]
    body = F.concat_ws(" ", class_id, "l_discount", "l_tax", F.col("l_quantity") / 40, "l_tax", "l_discount")
    judged = rows.select(F.col("l_linenumber").alias("line_number"), F.coalesce(qa.parse(F.concat(body, *tail), 3)["issue"], F.lit("ok")).alias("issue"))
    return judged.groupBy("line_number", "issue").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {_SQL_BOXES}
select vec_id, round(area, 9) + 0.0 as area, round(x0, 9) + 0.0 as x0, round(y0, 9) + 0.0 as y0, round(x1, 9) + 0.0 as x1, round(y1, 9) + 0.0 as y1, area < 1e-5 as tiny from boxes""")
def qa_area_bbox(spark, sf_dir):
    rows = _rings(spark, sf_dir).withColumn("box", G.bbox("ring")).withColumn("raw", G.area("ring"))
    return rows.select("vec_id", _r("raw").alias("area"), *(_r(f"box.{k}").alias(k) for k in G.BOX), (F.col("raw") < qa.TINY).alias("tiny"))


@query("""with scaled as (select vec_id, list_transform(embedding, lambda v: 2 * v::double + 0.5) as c from embeddings)
select vec_id, list_position(list_transform(range(0, 32), lambda i: not (c[2 * i + 1] between 0 and 1 and c[2 * i + 2] between 0 and 1)), true)::bigint - 1 as first_outside
from scaled where list_contains(list_transform(range(0, 32), lambda i: not (c[2 * i + 1] between 0 and 1 and c[2 * i + 2] between 0 and 1)), true)""")
def qa_out_of_range(spark, sf_dir):
    """The first point outside the unit square, of rings stretched twofold."""
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", G.points(F.transform(F.col("embedding").cast("array<double>"), lambda v: 2 * v + 0.5)).alias("ring"))
    outside = F.transform("ring", lambda p: ~(p["x"].between(0, 1) & p["y"].between(0, 1)))
    return rows.select("vec_id", (F.array_position(outside, True) - 1).cast("long").alias("first_outside")).where("first_outside >= 0")


def _findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiny instances and like pairs among the rings of images."""
    rings = _rings(spark, sf_dir)
    found = qa.overlapping(qa.instances(rings, "image", "vec_id"))
    tiny = rings.where(G.area("ring") < qa.TINY)
    pairs = found.select(F.col("image").cast("string").alias("image"), "issue", "severity", F.format_string("L%d e L%d", "i", "j").alias("detail"))
    small = tiny.select(F.col("image").cast("string").alias("image"), F.lit("instancia_minuscula").alias("issue"), F.lit(qa.MEDIUM).alias("severity"), F.col("vec_id").cast("string").alias("detail"))
    return pairs.unionByName(small)


_SQL_PAIRS = f"""
placed as (select *, row_number() over (partition by image order by vec_id) as nth from boxes where area >= 1e-5),
pairs as (
  select a.image, a.nth as i, b.nth as j, a.label as class_i, b.label as class_j, {_SQL_IOU}
  from placed a join placed b on a.image = b.image and a.nth < b.nth)"""


@query(f"""with {_SQL_BOXES}, {_SQL_PAIRS}
select image, i::integer as i, j::integer as j, class_i, class_j, round(iou, 9) + 0.0 as iou, case when class_i = class_j then 'instancia_duplicada' else 'conflito_de_classe' end as issue,
  case when class_i = class_j then 'media' else 'alta' end as severity from pairs where iou >= 0.85""")
def qa_pairs(spark, sf_dir):
    return qa.overlapping(qa.instances(_rings(spark, sf_dir), "image", "vec_id")).withColumn("iou", _r("iou"))


_SQL_FINDINGS = """
findings as (
  select image::varchar as image, case when class_i = class_j then 'instancia_duplicada' else 'conflito_de_classe' end as issue,
    case when class_i = class_j then 'media' else 'alta' end as severity, 'L' || i || ' e L' || j as detail from pairs where iou >= 0.85
  union all select image::varchar, 'instancia_minuscula', 'media', vec_id::varchar from boxes where area < 1e-5)"""


@query(f"""with {_SQL_BOXES}, {_SQL_PAIRS}, {_SQL_FINDINGS}
select issue, count(*) as n, count(*) filter (severity = 'alta') as n_alta from findings group by issue""")
def qa_summary(spark, sf_dir):
    return qa.summary(_findings(spark, sf_dir))


@query("""select 'imagem_sem_label' as issue, doc_id as key from documents where doc_id not in (select doc_id from labels)
union all select 'label_orfao', doc_id + 5 from labels where doc_id + 5 not in (select doc_id from documents)""")
def qa_orphans(spark, sf_dir):
    """Documents without a label, and labels, moved by five, without a document."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels").select((F.col("doc_id") + 5).alias("key"), "doc_id")
    bare = qa.unmatched(docs, labels, "doc_id", "doc_id").select(F.lit("imagem_sem_label").alias("issue"), F.col("doc_id").alias("key"))
    return bare.unionByName(qa.unmatched(labels, docs, "key", "doc_id").select(F.lit("label_orfao").alias("issue"), "key"))


# --- versions

_SQL_V1 = "select 'labels/' || source || '/' || doc_id || '.txt' as rel_path, sha256(coalesce(text, '')) as sha256, octet_length(encode(coalesce(text, ''))) as size, doc_id from documents"
_SQL_CHANGED = f"""
v1 as ({_SQL_V1}),
v2 as (
  select case when doc_id % 11 = 0 then 'images/' || doc_id else 'labels/' || source || '/' || doc_id || '.txt' end as rel_path,
    sha256(case when doc_id % 7 = 0 then coalesce(text, '') || '!' else coalesce(text, '') end) as sha256 from documents where doc_id % 13 <> 0),
changes as (
  select coalesce(v2.rel_path, v1.rel_path) as rel_path, case when v1.rel_path is null then 'adicionado' when v2.rel_path is null then 'removido' else 'modificado' end as change
  from v1 full outer join v2 on v1.rel_path = v2.rel_path where v1.sha256 is distinct from v2.sha256)"""


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents as files, and a changed copy: some paths moved, some contents altered, some files gone."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", F.coalesce("text", F.lit("")).alias("content"))
    path = F.concat(F.lit("labels/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    old = docs.withColumn("rel_path", path)
    new = docs.where(F.col("doc_id") % 13 != 0).withColumn("content", F.when(F.col("doc_id") % 7 == 0, F.concat("content", F.lit("!"))).otherwise(F.col("content")))
    new = new.withColumn("rel_path", F.when(F.col("doc_id") % 11 == 0, F.concat(F.lit("images/"), F.col("doc_id").cast("string"))).otherwise(path))
    return versions.scan(old), versions.scan(new)


@query(f"select rel_path, sha256, size from ({_SQL_V1})")
def manifest_scan(spark, sf_dir):
    return _versions(spark, sf_dir)[0]


@query(f"with {_SQL_CHANGED} select rel_path, change from changes")
def manifest_diff(spark, sf_dir):
    return versions.diff(*_versions(spark, sf_dir))


@query(f"""with {_SQL_CHANGED} select count(*) filter (change = 'adicionado') as adicionados, count(*) filter (change = 'removido') as removidos,
  count(*) filter (change = 'modificado') as modificados, count(*) filter (change = 'modificado' and rel_path like 'labels/%') as labels_modificados from changes""")
def change_summary(spark, sf_dir):
    return versions.change_summary(versions.diff(*_versions(spark, sf_dir)))


@query(f"""with {_SQL_CHANGED}, sized as (select v2.*, 1 as one from v2) select count(*) filter (rel_path like 'images/%') as count_images,
  count(*) filter (rel_path like 'labels/%') as count_labels from sized""")
def manifest_counts(spark, sf_dir):
    return versions.counts(_versions(spark, sf_dir)[1]).drop("bytes")


@query("select coalesce(max(try_cast(regexp_extract('v' || s_suppkey, '^v([0-9]+)$', 1) as integer)), 0) + 1 as next_version from supplier")
def next_version(spark, sf_dir):
    names = _table(spark, sf_dir, "supplier").select(F.concat(F.lit("v"), F.col("s_suppkey").cast("string")).alias("name"))
    return versions.next_version(names, "name")


# --- folds and splits


@query("""select doc_id, regexp_replace(source || '_r' || (doc_id % 7) || '_c' || (doc_id % 5), '_r[0-9]+_c[0-9]+$', '') as field,
  ((dense_rank() over (order by source) - 1) % 4)::integer as fold from documents""")
def folds_roundrobin(spark, sf_dir):
    number = lambda k: (F.col("doc_id") % k).cast("string")
    stem = F.concat(F.col("source"), F.lit("_r"), number(7), F.lit("_c"), number(5))
    return folds.round_robin(_table(spark, sf_dir, "documents").select("doc_id", text.group_key(stem).alias("field")), "field", 4)


@query("select source, case when source in ('src3', 'src7') then 'golden' else 'live' end as split, count(*) as n from documents group by all")
def holdout(spark, sf_dir):
    rows = folds.holdout(_table(spark, sf_dir, "documents").select("source"), "source", ["src3", "src7"])
    return rows.groupBy("source", "split").agg(F.count(F.lit(1)).alias("n"))


@query("""with g as (select source, count(*) as n from documents group by source)
select a.source as held_out, role, sum(case when (b.source = a.source) = (role = 'val') then b.n else 0 end)::bigint as n_items
from g a, g b, (values ('val'), ('train')) r(role) group by all""")
def leave_one_out(spark, sf_dir):
    return folds.leave_one_out(_table(spark, sf_dir, "documents"), "source")


@query("select source, count(*) as n, round(100 * count(*) / sum(count(*)) over (), 9) as percent from documents group by source")
def field_shares(spark, sf_dir):
    return folds.shares(_table(spark, sf_dir, "documents"), "source").withColumn("percent", _r("percent"))


@query("""with n as (
  select *, row_number() over (partition by c_nationkey order by c_acctbal) as nth, count(*) over (partition by c_nationkey) as total,
    round_even(count(*) over (partition by c_nationkey) * 0.2::double, 0)::integer as target from customer),
s as (select *, max(case when nth = total - target + 1 then c_acctbal end) over (partition by c_nationkey) as start from n)
select c_custkey, c_nationkey, c_acctbal, case when target = 0 then 'train' when c_acctbal >= start then 'val' when c_acctbal < start - 224 then 'train' else 'gap' end as split from s""")
def gap_split(spark, sf_dir):
    rows = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return folds.gap_split(rows, "c_nationkey", "c_acctbal", 0.2, float(crops.CROP))


# --- tiles and classes

_CLASS_MAP = {"M": 0, "MED": 1, "medium": 2, "ECO": 3, "promo": 4, "ANOD": 5}


@query("""with k(key, class_id, place) as (values ('M', 0, 0), ('MED', 1, 1), ('medium', 2, 2), ('ECO', 3, 3), ('promo', 4, 4), ('ANOD', 5, 5))
select p_partkey, p_type, (select class_id from k where contains(lower(p_type), lower(key)) order by length(key) desc, place limit 1)::integer as class_id from part""")
def class_match(spark, sf_dir):
    return tiling.match_class(_table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_type", _CLASS_MAP)


_SQL_STARTS = """
rasters as (select p_partkey, p_size * 100 as width, (51 - p_size) * 60 as height from part),
xs as (select p_partkey, unnest(case when width <= 1024 then [0] else list_sort(list_distinct(list_append(range(0, width - 1023, 896), width - 1024))) end) as x_off from rasters),
ys as (select p_partkey, unnest(case when height <= 1024 then [0] else list_sort(list_distinct(list_append(range(0, height - 1023, 896), height - 1024))) end) as y_off from rasters),
tiles as (
  select p_partkey, x_off, y_off, dense_rank() over (partition by p_partkey order by y_off) - 1 as r, dense_rank() over (partition by p_partkey order by x_off) - 1 as c
  from xs join ys using (p_partkey))"""


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "part").select("p_partkey", F.col("p_partkey").cast("string").alias("talhao"), (F.col("p_size") * 100).alias("width"), ((51 - F.col("p_size")) * 60).alias("height"))
    return tiling.windows(rows)


@query(f"with {_SQL_STARTS} select p_partkey, x_off::integer as x_off, y_off::integer as y_off, p_partkey || '_r' || lpad(r::varchar, 3, '0') || '_c' || lpad(c::varchar, 3, '0') as stem from tiles")
def tile_windows(spark, sf_dir):
    return _tiles(spark, sf_dir).select("p_partkey", "x_off", "y_off", "stem")


@query(f"""with {_SQL_BOXES}
select vec_id, list_transform(ring, lambda p: round(greatest(0, least(1, (p.x - 0.4) / 0.3)), 6) + 0.0) as xs, list_transform(ring, lambda p: round(greatest(0, least(1, (p.y - 0.45) / 0.3)), 6) + 0.0) as ys from rings""")
def normalise_label(spark, sf_dir):
    rows = _rings(spark, sf_dir).select("vec_id", G.normalise("ring", F.lit(0.4), F.lit(0.45), F.lit(0.3)).alias("n"))
    axis = lambda k: F.transform("n", lambda p: _r(p[k], 6))
    return rows.select("vec_id", axis("x").alias("xs"), axis("y").alias("ys"))


@query(f"""with {_SQL_BOXES}, wide as (select vec_id, x0 * 3000 as x0, y0 * 3000 as y0, x1 * 3000 as x1, y1 * 3000 as y1 from boxes),
starts as (select unnest([0, 896, 1792, 1976]) as s)
select vec_id, x.s::integer as x_off, y.s::integer as y_off from wide, starts x, starts y where x.s <= x1 and x.s + 1024 >= x0 and y.s <= y1 and y.s + 1024 >= y0""")
def tile_cover(spark, sf_dir):
    """The tiles of a 3000-pixel raster that each polygon's box touches."""
    rows = _rings(spark, sf_dir).select("vec_id", G.bbox(F.transform("ring", lambda p: F.struct((p["x"] * 3000).alias("x"), (p["y"] * 3000).alias("y")))).alias("box"))
    xs, ys = tiling.cells(F.col("box"), F.lit(3000), F.lit(3000), tiling.TILE, tiling.STRIDE)
    return rows.select("vec_id", "box", F.explode(xs).alias("x_off")).select("vec_id", "x_off", F.explode(ys).alias("y_off"), "box").drop("box")


@query(f"""with {_SQL_STARTS} select t.p_partkey, t.x_off::integer as x_off, t.y_off::integer as y_off from tiles t
where ('0x' || substr(sha256('42:' || p_partkey || '_r' || lpad(r::varchar, 3, '0') || '_c' || lpad(c::varchar, 3, '0')), 1, 8))::bigint / 4294967296.0 <= 0.05""")
def background_sample(spark, sf_dir):
    """The empty tiles that stay as background."""
    tiles = _tiles(spark, sf_dir)
    return tiles.where(tiling.hash_share("stem", 42) <= tiling.KEEP_EMPTY).select("p_partkey", "x_off", "y_off")


def _corners(box: Column) -> Column:
    """A box as a ring."""
    return F.array(*(F.struct(box[x].alias("x"), box[y].alias("y")) for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"))))


@query(f"""with {_SQL_BOXES}, wide as (select vec_id, label, x0 * 3000 as x0, y0 * 3000 as y0, x1 * 3000 as x1, y1 * 3000 as y1 from boxes),
starts as (select unnest([0, 896, 1792, 1976]) as s),
cut as (select vec_id, label, x.s as x_off, y.s as y_off, least(x1, x.s + 1024) - greatest(x0, x.s) as w, least(y1, y.s + 1024) - greatest(y0, y.s) as h from wide, starts x, starts y)
select vec_id::varchar as talhao, label as class_id, x_off::integer as x_off, y_off::integer as y_off, 0 as piece, round(w * h, 3) + 0.0 as area from cut where w > 0 and h > 0 and w * h >= 1e-4 * 1024 * 1024""")
def polygon_tiles(spark, sf_dir):
    """Boxes of rings clipped to the tiles of a 3000-pixel raster: area within each tile. Other shapes are tested against exact areas."""
    wide = F.transform(_corners(F.col("box")), lambda p: F.struct((p["x"] * 3000).alias("x"), (p["y"] * 3000).alias("y")))
    rings = _rings(spark, sf_dir).withColumn("box", G.bbox("ring")).select(
        F.col("vec_id").cast("string").alias("talhao"), "class_id", F.lit(3000).alias("width"), F.lit(3000).alias("height"), wide.alias("ring"))
    return tiling.tile_polygons(rings).select("talhao", "class_id", "x_off", "y_off", "piece", _r("area", 3).alias("area"))


@query("select min(doc_id) as doc_id, coalesce(text, '') as key from documents group by coalesce(text, '')")
def dedup_first(spark, sf_dir):
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("key"))
    return dedup.first_of(rows, F.sha2(F.col("key").cast("binary"), 256), ["doc_id"])


# --- scoring and the queue

_SQL_SCORES = f"""
gt as (select image, row_number() over (partition by image order by vec_id) as g, x0, y0, x1, y1 from boxes where vec_id % 2 = 0),
pred as (select image, row_number() over (partition by image order by vec_id) as p, label / 10.0 as conf, x0, y0, x1, y1 from boxes where vec_id % 2 = 1),
cells as (select a.image, a.g, b.p, {_SQL_IOU} from gt a join pred b on a.image = b.image),
matrix as (select image, g, list(iou order by p) as ious from cells group by image, g),
sizes as (select image, (select count(*) from gt where gt.image = i.image) as n_gt, (select count(*) from pred where pred.image = i.image) as n_pred from (select distinct image from boxes) i),
fold as (
  select image, 0::bigint as g, []::bigint[] as used, []::double[] as ious from sizes
  union all
  select image, g, case when best >= 0.1 then list_append(used, place) else used end, list_append(ious, case when best >= 0.1 then best else 0 end) from (
    select image, g, used, ious, coalesce(list_max(free), 0) as best, list_position(free, list_max(free)) as place from (
      select f.image, f.g + 1 as g, f.used, f.ious, [case when list_contains(f.used, j) then -1 else m.ious[j] end for j in range(1, len(m.ious) + 1)] as free
      from fold f join sizes s on f.image = s.image and f.g < s.n_gt left join matrix m on m.image = f.image and m.g = f.g + 1))),
done as (select f.image, used, ious, n_gt, n_pred from fold f join sizes s on f.image = s.image and f.g = s.n_gt),
scores as (
  select image::varchar as image, case when n_gt > 0 then list_sum(ious) / n_gt else 1 end as mean_iou, case when n_gt > 0 then len(list_filter(ious, lambda v: v = 0)) / n_gt::double else 0 end as gt_perdidos_ratio,
    coalesce((select max(conf) from pred where pred.image = done.image and not list_contains(used, p)), 0) as ghost_conf, n_gt, n_pred from done)"""


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even vectors annotate, odd ones predict, with a confidence by label."""
    rows = _rings(spark, sf_dir).select(F.col("image").cast("string").alias("image"), F.col("vec_id").alias("idx"), G.bbox("ring").alias("box"), (F.col("class_id") / 10).alias("conf"))
    odd = F.col("idx") % 2 == 1
    return scoring.score_images(rows.select("image").distinct(), rows.where(~odd).drop("conf"), rows.where(odd))


@query(f"""with recursive {_SQL_BOXES}, {_SQL_SCORES}
select image, round(mean_iou, 9) + 0.0 as mean_iou, round(gt_perdidos_ratio, 9) + 0.0 as gt_perdidos_ratio, round(ghost_conf, 9) + 0.0 as ghost_conf,
  round(1 - mean_iou + gt_perdidos_ratio + ghost_conf, 9) + 0.0 as score, n_gt::integer as n_gt, n_pred::integer as n_pred from scores""")
def suspicion_score(spark, sf_dir):
    rows = _scores(spark, sf_dir)
    return rows.select("image", *(_r(c).alias(c) for c in ("mean_iou", "gt_perdidos_ratio", "ghost_conf", "score")), "n_gt", "n_pred")


@query(f"""with recursive {_SQL_BOXES}, {_SQL_PAIRS}, {_SQL_FINDINGS}, {_SQL_SCORES},
severe as (select image, list_sort(list(issue || ': ' || detail)) as issues from findings where severity = 'alta' group by image),
flagged as (
  select image, round(1 - mean_iou + gt_perdidos_ratio + ghost_conf, 9) + 0.0 as score from scores
  where (mean_iou < 0.55 or gt_perdidos_ratio > 0.34 or ghost_conf > 0.7) and image not in (select image from severe)),
everything as (select 0 as priority, image, 'qa_alta' as reason, 'inf'::double as score, len(issues) as n_issues from severe union all select 1, image, 'xval', score, 0 from flagged)
select image, reason, score, n_issues::integer as n_issues from everything order by priority, score desc, image limit 40""")
def review_queue(spark, sf_dir):
    scores = suspicion_score(spark, sf_dir)
    queue = review.queue(_findings(spark, sf_dir), scoring.suspicious(scores))
    return queue.select("image", "reason", "score", F.size("issues").alias("n_issues"))


# --- history

_SQL_RUNS = """
months as (
  select strftime(o_orderdate, '%Y%m')::bigint as seq, round(avg(o_totalprice) / 1000000, 6) as m, round(count(*) filter (o_orderstatus = 'F') / count(*)::double, 6) as recall from orders group by 1),
numbered as (select *, 'run' || seq as run_id from months)"""


def _history(spark: SparkSession, sf_dir: str, places: int = 6) -> DataFrame:
    """Months of orders as runs."""
    rows = _table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyyMM").cast("long").alias("seq")).agg(
        F.round(F.avg("o_totalprice") / 1000000, places).alias("m"), F.round(F.count_if(F.col("o_orderstatus") == "F") / F.count(F.lit(1)), 6).alias("recall")
    )
    metrics = F.create_map(F.lit(history.METRIC), "m", F.lit("seg_recall"), "recall")
    seq = F.col("seq").cast("string")
    return rows.select("seq", F.concat(F.lit("run"), seq).alias("run_id"), F.concat(F.lit("v"), seq).alias("version"), F.lit(None).cast("string").alias("tag"), metrics.alias("metrics"), (F.col("m") > 0.2).alias("promoted"), F.lit(None).cast("long").alias("ciclo"))


@query(f"""with {_SQL_RUNS},
best as (
  select n.*, (select run_id from numbered p where p.seq < n.seq order by p.m desc, p.seq limit 1) as prev_best from numbered n),
joined as (select b.*, b.m - p.m as delta, b.recall - p.recall as fall from best b left join numbered p on b.prev_best = p.run_id)
select seq, run_id, prev_best, round(delta, 9) + 0.0 as delta, case when prev_best is null then true when delta < 0.01 then false when fall < -0.02 then false else true end as promoted_now from joined""")
def promotion(spark, sf_dir):
    return history.promotion(_history(spark, sf_dir)).select("seq", "run_id", "prev_best", _r("delta").alias("delta"), "promoted_now")


@query(f"""with {_SQL_RUNS}
select seq, run_id, m as value, round(m - lag(m) over (order by seq), 9) + 0.0 as delta, max(m) over (order by seq) as best_so_far,
  round(m - first_value(m) over (order by seq), 9) + 0.0 as since_first from numbered""")
def cycle_progress(spark, sf_dir):
    rows = history.progress(history.of_cycle(_history(spark, sf_dir), 3))
    return rows.select("seq", "run_id", "value", _r("delta").alias("delta"), "best_so_far", _r("since_first").alias("since_first"))


_SQL_SIGNED = "case when {0} < -0.00005 then format('{{:.4f}}', {0}) else '+' || format('{{:.4f}}', abs({0})) end"
_SQL_REPORT = f"""
with runs as (select strftime(o_orderdate, '%Y%m')::bigint as seq, round(avg(o_totalprice) / 1000000, 4) as m from orders group by 1),
told as (
  select seq, 'run' || seq as run_id, m, '| `v' || seq || '` | `-` | ' || format('{{:.4f}}', m) || ' | ' ||
    coalesce({_SQL_SIGNED.format("(m - lag(m) over (order by seq))")}, '—') || ' | ' || case when m > 0.2 then '✓' else '✗' end || ' |' as line from runs),
ends as (select count(*) as n, string_agg(line, chr(10) order by seq) as lines, max(m) as top, arg_min(m, seq) as first, arg_max(m, seq) as last from told),
best as (select run_id from told order by m desc, seq limit 1)
select 'Ciclo 3 — resumo · ' || n || ' run(s)' as title, '**Runs incluídos**: ' || n || chr(10) || '**Métrica principal**: `seg_mAP50-95`' || chr(10) || chr(10) ||
  '| versão | tag | seg_mAP50-95 | Δ | promoted |' || chr(10) || '|---|---|---|---|---|' || chr(10) || lines || chr(10) || chr(10) ||
  '**Melhor run**: `' || run_id || '` — seg_mAP50-95=' || format('{{:.4f}}', top) || chr(10) ||
  '**Progressão do ciclo**: ' || format('{{:.4f}}', first) || ' → ' || format('{{:.4f}}', last) || '  (' || {_SQL_SIGNED.format("(last - first)")} || ')' as body
from ends, best"""


@query(_SQL_REPORT)
def cycle_report(spark, sf_dir):
    """The markdown report of the months."""
    return history.report(_history(spark, sf_dir, 4), 3)


@query(f"with {_SQL_RUNS} select run_id, version, state from (select run_id, 'v' || seq as version, case when m > 0.2 then 'Aprovado' else 'Avaliado' end as state, seq from numbered) order by seq desc limit 1")
def last_run(spark, sf_dir):
    return history.select_run(_history(spark, sf_dir)).select("run_id", "version", text.run_state("promoted").alias("state"))


# --- trackers

_EVENT_STATES = ["click", "purchase", "error", "absent"]


@query("""select place, state, count(event_id) as n from (values (0, 'click'), (1, 'purchase'), (2, 'error'), (3, 'absent')) s(place, state) left join events on event_type = state group by place, state""")
def state_counts(spark, sf_dir):
    return tracker.state_counts(_table(spark, sf_dir, "events"), "event_type", _EVENT_STATES)


@query("""select doc_id, lang as label, n_nationkey as label_id from documents join nation on n_nationkey = case lang when 'en' then 1 when 'de' then 2 when 'fr' then 3 end""")
def label_match(spark, sf_dir):
    """Known labels get their ids, others are dropped."""
    name = F.when(F.col("n_nationkey") == 1, "en").when(F.col("n_nationkey") == 2, "de").when(F.col("n_nationkey") == 3, "fr")
    labels = _table(spark, sf_dir, "nation").select(name.alias("name"), F.col("n_nationkey").alias("id")).where("name is not null")
    return tracker.resolve_labels(_table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label")), labels)


@query("""select state from (values ('click'), ('purchase'), ('error'), ('absent')) s(state) where state not in (select event_type from events)""")
def seed_missing(spark, sf_dir):
    seed = spark.createDataFrame([(s,) for s in _EVENT_STATES], "state string")
    return tracker.missing_states(seed, _table(spark, sf_dir, "events").select(F.col("event_type").alias("state")))


@query("select user_id as id, min(event_id) >= 0 as seen from events where event_type = 'purchase' group by user_id")
def watch_stream(spark, sf_dir):
    """Users that purchase, each handled once, by a stream over the event file."""
    schema = _table(spark, sf_dir, "events").schema
    base = fresh_path(spark, "watch")
    issues = watch.issue_stream(spark, sf_dir, schema, "events.parquet").select(F.col("user_id").alias("id"), F.col("event_type").alias("state"))
    watch.collect_ready(watch.ready_once(issues, "purchase"), f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema("id long, state string").parquet(f"{base}/out").select("id", F.lit(True).alias("seen"))


# --- crops

_SQL_CROPS = """crops as (select d.doc_id, source, quality, case when n_chars % 3 = 0 then 0 else 1 end as pred, (n_chars % 100) / 100.0::double as prob from documents d join labels using (doc_id))"""


def _crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("of_doc"), F.col("quality").alias("label"))
    rows = _table(spark, sf_dir, "documents").join(labels, F.col("doc_id") == F.col("of_doc"))
    pred = F.when(F.col("n_chars") % 3 == 0, 0).otherwise(1)
    kind = F.when(F.col("label") == 1, "positive").otherwise("negative")
    return rows.select(
        kind.alias("kind"), F.col("source").alias("site"), F.lit("a.geojson").alias("geojson_source"), F.col("doc_id").alias("polygon_id"), "label", pred.alias("pred"),
        ((F.col("n_chars") % 100) / 100).alias("prob_daninha"), *(F.lit(0.0).alias(f"centroid_{k}") for k in ("col", "row", "lon", "lat")),
    )


@query(f"""with {_SQL_CROPS}, c as (select count(*) filter (quality = 0 and pred = 0) as tn, count(*) filter (quality = 0 and pred = 1) as fp, count(*) filter (quality = 1 and pred = 0) as fn, count(*) filter (quality = 1 and pred = 1) as tp from crops)
select tn, fp, fn, tp, round((tp + tn) / (tp + fp + fn + tn), 9) as accuracy, round(tp / (tp + fp), 9) as precision, round(tp / (tp + fn), 9) as recall, round(2 * tp / (2 * tp + fp + fn), 9) as f1 from c""")
def confusion_f1(spark, sf_dir):
    rows = crops.confusion(_crops(spark, sf_dir), "label", "pred")
    return rows.select("tn", "fp", "fn", "tp", *(_r(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")))


@query("""select l.label::integer as label, count(e.vec_id) as n, round(least(greatest((select count(*) from embeddings) / (12 * greatest(count(e.vec_id), 1))::double, 0.1), 20), 9) as weight
from range(12) l(label) left join embeddings e on e.label = l.label group by l.label""")
def class_weights(spark, sf_dir):
    rows = crops.class_weights(_table(spark, sf_dir, "embeddings").select("label"), "label", 12)
    return rows.withColumn("weight", _r("weight"))


@query(f"""with {_SQL_CROPS} select case when prob <= 0.5 then 'misclass' else 'low_conf' end as kind, source as site, doc_id as polygon_id, case when prob <= 0.5 then 'cultivo' else 'daninha' end as pred_class,
  round(prob, 9) as prob_daninha, round(1 - prob, 9) as prob_cultivo from crops where quality = 1 and prob < 0.6""")
def crop_suspects(spark, sf_dir):
    rows = crops.suspect_order(crops.suspects(_crops(spark, sf_dir)))
    return rows.select("kind", "site", "polygon_id", "pred_class", _r("prob_daninha").alias("prob_daninha"), _r("prob_cultivo").alias("prob_cultivo"))


@query("""with now as (select source as site, doc_id::varchar as basename, doc_id % 5 <> 0 as here, sha256(text) as sha, n_chars as n from documents),
was as (select source as site, doc_id::varchar as basename, doc_id % 3 <> 0 as here, sha256(case when doc_id % 7 = 0 then text || 'x' else text end) as sha, n_chars - 1 as n from documents where doc_id % 4 <> 0)
select now.site, now.basename, case when not coalesce(was.here, false) and now.here then 'novo' when was.here and not now.here then 'removido' else 'modificado' end as change,
  case when coalesce(was.here, false) = now.here then now.n - was.n end as delta
from now left join was on now.site = was.site and now.basename = was.basename where coalesce(was.here, false) <> now.here or was.sha <> now.sha""")
def site_changes(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    manifest = lambda rows, there, sha, n: rows.select(F.col("source").alias("site"), F.col("doc_id").cast("string").alias("basename"), there.alias("exists"), F.sha2(sha.cast("binary"), 256).alias("sha256"), n.alias("n_polygons"))
    now = manifest(docs, F.col("doc_id") % 5 != 0, F.col("text"), F.col("n_chars"))
    altered = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    return crops.site_changes(now, manifest(docs.where(F.col("doc_id") % 4 != 0), F.col("doc_id") % 3 != 0, altered, F.col("n_chars") - 1))


@query("""select event_id, round(case when event_id % 60 < 5 then (event_id % 60 + 1) / 5.0 else 0.5 * (1 + cos(pi() * least(greatest((event_id % 60 - 5) / 45.0, 0), 1))) end, 9) + 0.0 as rate from events""")
def learning_rate(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").select("event_id", learning.learning_rate((F.col("event_id") % 60).cast("double"), 5, 50).alias("rate"))
    return rows.withColumn("rate", _r("rate"))


@query("""select vec_id, list_transform(embedding, lambda v: round(exp(v::double - list_max(embedding)) / list_sum(list_transform(embedding, lambda w: exp(w::double - list_max(embedding)))), 9) + 0.0) as p,
  (list_position(embedding, list_max(embedding)) - 1)::integer as best from embeddings""")
def softmax(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    return rows.select("vec_id", F.transform(learning.softmax("e"), lambda v: _r(v)).alias("p"), learning.argmax("e").alias("best"))


@query("""with t as (select vec_id, embedding[1]::double * 100 as x, embedding[2]::double * 100 as y from embeddings)
select vec_id, round((0.05 * 0 - 0 + (-0.05) * (x - 200) ) / (0.05 * -0.05), 6) + 0.0 as col, round((0.05 * (y - 900)) / (0.05 * -0.05), 6) + 0.0 as row from t""")
def map_to_pixel(spark, sf_dir):
    """A point of each ring from map to pixel coordinates."""
    e = F.col("embedding").cast("array<double>")
    ring = F.array(F.struct((F.get(e, F.lit(0)) * 100).alias("x"), (F.get(e, F.lit(1)) * 100).alias("y")))
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", F.get(G.to_pixel(ring, F.array(*(F.lit(v) for v in (0.05, 0.0, 200.0, 0.0, -0.05, 900.0)))), F.lit(0)).alias("p"))
    return rows.select("vec_id", _r("p.x", 6).alias("col"), _r("p.y", 6).alias("row"))


def _sql_utm(lon: str, lat: str, zone: int) -> str:
    """The series of geometry.utm, south, over a table `points` of (vec_id, lon, lat)."""
    import math

    n = G.FLATTENING / (2 - G.FLATTENING)
    scale, alpha, e = G.utm_constants()
    x, y = ("".join(f" + {a!r} * {f}({2 * j} * xi) * {g}({2 * j} * eta)" for j, a in enumerate(alpha, 1)) for f, g in (("cos", "sinh"), ("sin", "cosh")))
    assert math.isclose(e, 2 * math.sqrt(n) / (1 + n))
    return f"""
    angles as (select vec_id, radians({lat}) as phi, radians({lon} - {6 * zone - 183}) as lam from points),
    steps as (select vec_id, lam, sinh(atanh(sin(phi)) - {e!r} * atanh({e!r} * sin(phi))) as t from angles),
    plane as (select vec_id, atan2(t, cos(lam)) as xi, atanh(sin(lam) / sqrt(1 + t * t)) as eta from steps),
    metres as (select vec_id, 500000 + {scale!r} * (eta{x}) as easting, 10000000 + {scale!r} * (xi{y}) as northing from plane)"""


@query(f"""with points as (select vec_id, embedding[1]::double - 33 as lon, embedding[2]::double - 8 as lat from embeddings), {_sql_utm("lon", "lat", 25)}
select vec_id, round(easting, 4) + 0.0 as easting, round(northing, 4) + 0.0 as northing from metres""")
def utm_positions(spark, sf_dir):
    """Points in degrees to metres of UTM zone 25 south. Known positions are tested beside."""
    e = F.col("embedding").cast("array<double>")
    at = G.utm(F.get(e, F.lit(0)) - 33, F.get(e, F.lit(1)) - 8, 25, True)
    return _table(spark, sf_dir, "embeddings").select("vec_id", at.alias("p")).select("vec_id", _r("p.x", 4).alias("easting"), _r("p.y", 4).alias("northing"))


_SQL_PIXELS = "pixels as (select vec_id, label, image, greatest(trunc(x0 * 256), 0) as x0, greatest(trunc(y0 * 256), 0) as y0, least(trunc(x1 * 256), 255) + 1 as x1, least(trunc(y1 * 256), 255) + 1 as y1 from boxes)"


@query(f"""with recursive {_SQL_BOXES}, {_SQL_PIXELS}, {_SQL_SCORES.replace("from boxes", "from pixels")}
select image, round(mean_iou, 6) + 0.0 as mean_iou, round(gt_perdidos_ratio, 6) + 0.0 as gt_perdidos_ratio, round(ghost_conf, 6) + 0.0 as ghost_conf,
  round(1 - mean_iou + gt_perdidos_ratio + ghost_conf, 6) + 0.0 as score, n_gt::integer as n_gt, n_pred::integer as n_pred from scores""")
def mask_scores(spark, sf_dir):
    """Suspicion by masks: the masks of boxes, which SQL can count. Masks of other shapes are tested against ones drawn by hand."""
    from tessera.functions.raster import mask_iou_matrix

    flat = F.flatten(F.transform(_corners(G.bbox("ring")), lambda p: F.array(p["x"], p["y"])))
    rows = _rings(spark, sf_dir).select(F.col("image").cast("string").alias("image"), F.col("vec_id").alias("idx"), flat.alias("coords"), (F.col("class_id") / 10).alias("conf"))
    odd = F.col("idx") % 2 == 1
    scores = scoring.score_images(rows.select("image").distinct(), rows.where(~odd).drop("conf"), rows.where(odd), "coords", mask_iou_matrix)
    return scores.select("image", *(_r(c, 6).alias(c) for c in ("mean_iou", "gt_perdidos_ratio", "ghost_conf", "score")), "n_gt", "n_pred")


def _sql_share(seed: int) -> str:
    return f"('0x' || substr(sha256('{seed}:' || site || ':' || nth), 1, 8))::bigint / 4294967296.0::double"


@query(f"""with {_SQL_BOXES},
weeds as (select label::varchar as site, list_transform(ring, lambda p: {{'x': p.x * 3000, 'y': p.y * 3000}}) as ring from rings),
tries as (select site, nth, 3000 * ({_sql_share(42)}) as x, 3000 * ({_sql_share(43)}) as y from (select distinct site from weeds), range(150) r(nth)),
fit as (select * from tries where x between 112 and 2888 and y between 112 and 2888),
free as (
  select * from fit where not exists (select 1 from weeds w where w.site = fit.site and len(list_filter(range(1, 33), lambda i:
    (w.ring[i].y > fit.y) <> (w.ring[i % 32 + 1].y > fit.y) and
    fit.x < (w.ring[i % 32 + 1].x - w.ring[i].x) * (fit.y - w.ring[i].y) / (w.ring[i % 32 + 1].y - w.ring[i].y) + w.ring[i].x)) % 2 = 1))
select site, nth::integer as nth, round(x, 6) + 0.0 as x, round(y, 6) + 0.0 as y from (select *, row_number() over (partition by site order by nth) as place from free) where place <= 10""")
def negative_samples(spark, sf_dir):
    """Ten points a class on a 3000-pixel plantation that fall on no ring. Tested by the predicates themselves."""
    big = F.transform("ring", lambda p: F.struct((p["x"] * 3000).alias("x"), (p["y"] * 3000).alias("y")))
    weeds = _rings(spark, sf_dir).select(F.col("class_id").cast("string").alias("site"), big.alias("ring"))
    corner = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    field = weeds.select("site").distinct().withColumn("ring", F.array(corner(0, 0), corner(3000, 0), corner(3000, 3000), corner(0, 3000)))
    sites = field.select("site", F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(3000.0).alias("x1"), F.lit(3000.0).alias("y1"), F.lit(10).alias("n_target"))
    return crops.negatives(crops.candidates(sites), field, weeds, 3000.0, 3000.0).select("site", "nth", _r("x", 6).alias("x"), _r("y", 6).alias("y"))
