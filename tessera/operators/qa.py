"""Structural checks of label files and images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions import geometry as G
from tessera.functions.raster import image_problem
from tessera.functions.text import fixed

HIGH, MEDIUM = "alta", "media"
TINY, SAME_BOX = 1e-5, 0.85
FINDING = ["image", "issue", "severity", "detail"]
# fixed values: details that do not depend on the file
NO_LABEL, NO_IMAGE, NO_INSTANCE = "declarar como fundo se intencional", "sem imagem correspondente", "arquivo sem instâncias"
UNREADABLE = "leitura falhou: o texto não é UTF-8"

# numbers as the label format's first readers took them: digits may be grouped by single underscores
_INT = r"^[+-]?[0-9]+(_[0-9]+)*$"
_PLAIN = r"^\s*+-?[0-9]++(?:\s++-?[0-9]++(?:\.[0-9]++)?)*+\s*$"
_FLOAT = r"(?i)^[+-]?(([0-9]+(_[0-9]+)*)(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)(e[+-]?[0-9]+(_[0-9]+)*)?$|^[+-]?(inf|infinity|nan)$"


def lines(labels: DataFrame, text: str = "raw", keep: list[str] | None = None) -> DataFrame:
    """Non-blank lines of label files with their numbers from 1: the kept columns, line_no and line."""
    keep = keep or [c for c in labels.columns if c != text]
    parts = F.split(F.coalesce(F.col(text), F.lit("")), "\r\n|[\n\r]")
    out = labels.select(*keep, F.posexplode(parts).alias("line_no", "line"))
    return out.withColumn("line_no", F.col("line_no") + 1).where(F.col("line").rlike(r"\S"))


def parse(line: Column | str, classes: int) -> Column:
    """A label line as a struct (issue, class_id, ring, detail); the first failing check names the issue.

    A class id too large for a long is out of range like any other unknown class.
    """
    bare = lambda t: F.replace(t, F.lit("_"), F.lit(""))
    outside = lambda p: ~(p["x"].between(0, 1) & p["y"].between(0, 1))
    # fixed values: what the label format's first reader said of a token
    quoted = lambda t: F.when(F.contains(t, F.lit("'")) & ~F.contains(t, F.lit('"')), F.concat(F.lit('"'), t, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(t, F.lit("'"), F.lit("\\'")), F.lit("'")))
    no_class = lambda t: F.concat(F.lit("invalid literal for int() with base 10: "), quoted(t))
    no_number = lambda t: F.concat(F.lit("could not convert string to float: "), quoted(t))

    def broken(first: Column, rest: Column) -> Column:
        detail = F.when(~first.rlike(_INT), no_class(first)).otherwise(no_number(F.get(F.filter(rest, lambda t: ~t.rlike(_FLOAT)), F.lit(0))))
        nothing = F.lit(None).cast("array<struct<x:double,y:double>>")
        return F.struct(F.lit("linha_malformada").alias("issue"), F.lit(None).cast("int").alias("class_id"), nothing.alias("ring"), detail.alias("detail"))

    def judged(first: Column, number: Column, ring: Column, n: Column) -> Column:
        unknown, odd = number.isNull() | (number < 0) | (number >= classes), (n < 6) | (n % 2 != 0)
        bad = F.filter(ring, outside)
        issue = F.when(unknown, "classe_invalida").when(odd, "poligono_degenerado").when(F.size(bad) > 0, "coord_fora_do_range")
        point = F.get(bad, F.lit(0))
        detail = (
            F.when(unknown, F.concat(F.lit("class_id="), first, F.lit(f" (nc={classes})"))).when(odd, F.concat(n.cast("string"), F.lit(" coordenadas")))
            .when(F.size(bad) > 0, F.format_string("(%.4f, %.4f)", point["x"], point["y"]))
        )
        return F.struct(issue.alias("issue"), number.cast("int").alias("class_id"), ring.alias("ring"), detail.alias("detail"))

    def read(tokens: Column) -> Column:
        first, rest = F.get(tokens, F.lit(0)), F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0)))

        def told(number: Column, values: Column) -> Column:
            number = F.when(number.between(-(2**31), 2**31 - 1), number)
            return G.let(values, lambda v: G.let(G.points(v), lambda r: judged(first, number, r, F.size(rest))))

        # one pattern tells plain decimals, whose casts need no further look; other tokens are judged one by one
        plain = told(first.try_cast("bigint"), F.transform(rest, lambda t: t.try_cast("double")))
        whole = first.rlike(_INT) & F.forall(rest, lambda t: t.rlike(_FLOAT))
        other = told(bare(first).try_cast("bigint"), F.transform(rest, lambda t: bare(t).try_cast("double")))
        return F.when(G.col(line).rlike(_PLAIN), plain).when(whole, other).otherwise(broken(first, rest))

    # every value is bound once: Catalyst does not share subexpressions within lambdas and branches
    return G.let(F.split(F.btrim(G.col(line), F.lit(" \t\n\x0b\f\r")), r"\s+"), read)


def instances(rings: DataFrame, image: str = "image", order: str = "line_no") -> DataFrame:
    """Adds area, box and nth: the number, from 1, among an image's instances that are not tiny.

    An image's label file is one text that a task has read whole, so its lines are numbered by one task too.
    """
    out = rings.withColumn("area", G.area("ring")).where(F.col("area") >= TINY).withColumn("box", G.bbox("ring"))
    return out.withColumn("nth", F.row_number().over(Window.partitionBy(image).orderBy(order)))


def overlapping(found: DataFrame, image: str = "image", least: float = SAME_BOX) -> DataFrame:
    """Pairs (i, j) of instances of an image, i before j, with box IoU of at least `least`.

    Boxes that alike have sides and areas within that ratio, so the join meets equal logarithmic size classes beside
    the image; an image of many instances costs by those of like size. Overlap bounds are join conditions.
    """
    import math

    step = -math.log(least)
    sizes = found.select(F.col(image).alias("image"), "nth", F.col("class_id"), "box")
    side = lambda low, high: F.floor(F.log(F.greatest(F.col(f"box.{high}") - F.col(f"box.{low}"), F.lit(1e-12))) / step).cast("int")
    sizes = sizes.withColumn("w", side("x0", "x1")).withColumn("h", side("y0", "y1"))
    near = lambda c: F.explode(F.array(c - 1, c, c + 1))
    left = sizes.select("image", F.col("nth").alias("i"), F.col("class_id").alias("class_i"), F.col("box").alias("box_i"), near(F.col("w")).alias("w"), "h")
    left = left.select("image", "i", "class_i", "box_i", "w", near(F.col("h")).alias("h"))
    right = sizes.select(F.col("image").alias("image_j"), F.col("nth").alias("j"), F.col("class_id").alias("class_j"), F.col("box").alias("box_j"), F.col("w").alias("w_j"), F.col("h").alias("h_j"))
    meet = (F.col("image") == F.col("image_j")) & (F.col("w") == F.col("w_j")) & (F.col("h") == F.col("h_j")) & (F.col("i") < F.col("j")) & G.boxes_touch("box_i", "box_j")
    pairs = left.join(right, meet).withColumn("iou", G.box_iou("box_i", "box_j")).where(F.col("iou") >= least)
    issue = F.when(F.col("class_i") == F.col("class_j"), "instancia_duplicada").otherwise("conflito_de_classe")
    severity = F.when(F.col("class_i") == F.col("class_j"), MEDIUM).otherwise(HIGH)
    return pairs.select("image", "i", "j", "class_i", "class_j", "iou", issue.alias("issue"), severity.alias("severity"))


def _finding(image: Column | str, issue: Column, severity: str | Column, detail: Column, place: Column) -> list[Column]:
    severity = F.lit(severity) if isinstance(severity, str) else severity
    return [G.col(image).alias("image"), issue.alias("issue"), severity.alias("severity"), detail.alias("detail"), place.alias("place")]


def place(part: int, path: Column | str, step: int, i: Column | int = 0, j: Column | int = 0) -> Column:
    """Where a finding stands in a report: images before labels, by path, and within a file as it is read."""
    number = lambda x: (F.lit(x) if isinstance(x, int) else x).cast("int")
    return F.struct(F.lit(part).alias("part"), G.col(path).alias("path"), F.lit(step).alias("step"), number(i).alias("i"), number(j).alias("j"))


def label_findings(labels: DataFrame, classes: int, background: DataFrame | None = None) -> DataFrame:
    """Findings of label files (file_name, stem, raw, and path and readable where they are known), with their place.

    Stems of the background are allowed to be empty. A file that is not readable has that one finding.
    """
    labels = labels if "path" in labels.columns else labels.withColumn("path", F.col("file_name"))
    if "readable" in labels.columns:
        bad = labels.where("not readable").select(*_finding("file_name", F.lit("linha_malformada"), HIGH, F.lit(UNREADABLE), place(1, "path", 0)))
        labels = labels.where("readable")
    else:
        bad = None
    parsed = lines(labels, "raw", ["path", "file_name"]).withColumn("p", parse("line", classes))
    parsed = parsed.select("path", "file_name", "line_no", "p.*").withColumn("area", F.when(F.col("issue").isNull(), G.area("ring")))
    at, here, small = F.concat(F.lit("L"), F.col("line_no").cast("string"), F.lit(": ")), place(1, "path", 0, F.col("line_no")), F.col("area") < TINY
    issue, severity = F.when(small, "instancia_minuscula").otherwise(F.col("issue")), F.when(small, MEDIUM).otherwise(HIGH)
    told = F.concat(at, F.when(small, F.concat(F.lit("área="), scientific(F.col("area")))).otherwise(F.concat("issue", F.lit(": "), "detail")))
    single = parsed.where(F.col("issue").isNotNull() | small).select(*_finding("file_name", issue, severity, told, here))
    sound = parsed.where("issue is null").select("path", "line_no", "class_id", "ring")
    pairs = overlapping(instances(sound, "path"), "path")
    same = F.format_string("L%d e L%d: bbox-IoU=%s", "i", "j", fixed(F.col("iou"), 2))
    other = F.format_string("L%d(cls=%d) x L%d(cls=%d): bbox-IoU=%s", "i", "class_i", "j", "class_j", fixed(F.col("iou"), 2))
    detail = F.when(F.col("class_i") == F.col("class_j"), same).otherwise(other)
    pairs = pairs.select(*_finding(F.regexp_extract("image", r"([^/]*)$", 1), F.col("issue"), F.col("severity"), detail, place(1, "image", 2, F.col("i"), F.col("j"))))
    empty = labels.where(~F.coalesce("raw", F.lit("")).rlike(r"\S"))
    if background is not None:
        empty = empty.join(background.select(F.col("stem").alias("of_stem")), F.col("stem") == F.col("of_stem"), "left_anti")
    empty = empty.select(*_finding("file_name", F.lit("label_vazio"), MEDIUM, F.lit(NO_INSTANCE), place(1, "path", 1)))
    found = single.unionByName(pairs).unionByName(empty)
    return found if bad is None else found.unionByName(bad)


def scientific(x: Column) -> Column:
    """A number that is not negative, with two decimals and an exponent of two digits at least."""
    return F.regexp_replace(F.format_string("%.2e", x), r"e([+-])([0-9])$", "e$10$2")


def stem_index(files: DataFrame, stem: str = "stem", path: str = "path") -> DataFrame:
    """One path a stem, the last in order."""
    return files.groupBy(stem).agg(F.max(path).alias(path))


def unmatched(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of left without a partner."""
    return left.join(right.select(F.col(right_key).alias("of_key")).distinct(), F.col(left_key) == F.col("of_key"), "left_anti")


def check(images: DataFrame, labels: DataFrame, classes: int, background: DataFrame | None = None) -> DataFrame:
    """All findings of images (path, stem, file_name, content) and labels (path, stem, file_name, raw), with their place.

    Of files with equal stems the last path counts. Images are judged where they are read, so their content meets no
    shuffle; images and labels meet once.
    """
    last = lambda rows, name, more: rows.groupBy(F.col("stem").alias(f"{name}_stem")).agg(F.max_by(F.struct("path", "file_name", *more), "path").alias(name))
    images = last(images.select("path", "stem", "file_name", image_problem("content").alias("problem")), "image", ["problem"])
    labels = last(labels, "label", [c for c in ("raw", "readable") if c in labels.columns])
    both = images.join(labels, F.col("image_stem") == F.col("label_stem"), "full_outer")
    finding = lambda when, side, issue, detail, at: F.when(when, F.struct(*_finding(f"{side}.file_name", F.lit(issue), HIGH, detail, at)))
    bare, orphan = F.col("label").isNull(), F.col("image").isNull()
    found = F.array_compact(F.array(
        finding(F.col("image.problem").isNotNull(), "image", "imagem_corrompida", F.col("image.problem"), place(0, "image.path", 0)),
        finding(bare, "image", "imagem_sem_label", F.lit(NO_LABEL), place(0, "image.path", 1)),
        finding(orphan, "label", "label_orfao", F.lit(NO_IMAGE), place(1, "label.path", 0)),
    ))
    matched = both.where(~bare & ~orphan).select(F.col("label_stem").alias("stem"), "label.*")
    return both.select(F.inline(found)).unionByName(label_findings(matched, classes, background))


def summary(findings: DataFrame) -> DataFrame:
    """Findings by issue, and how many of them are severe."""
    return findings.groupBy("issue").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("severity") == HIGH).alias("n_alta")).orderBy(F.desc("n"), "issue")
