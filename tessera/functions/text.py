"""Names, labels and report lines, as column expressions. Output words are a data contract and stay as they are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.geometry import col, let

# fixed values: workflow states in board order
STATES = ["Selecionadas", "Em anotação", "Em revisão (QA)", "Pronto para treino", "Em treinamento", "Avaliado", "Aprovado"]
# fixed values: the metrics that a run records
METRICS = ["seg_mAP50-95", "seg_mAP50", "seg_precision", "seg_recall"]
# fixed values: upload types by extension
MIME = {".png": "image/png", ".jpg": "image/jpeg", ".jpeg": "image/jpeg"}
IMAGE_TYPES = ["bmp", "jpeg", "jpg", "png", "tif", "tiff", "webp"]


def group_key(stem: Column | str) -> Column:
    """The field of a tile: its stem without one trailing row and column suffix."""
    return F.regexp_replace(col(stem), r"_r[0-9]+_c[0-9]+$", "")


def tile_stem(field: Column, row: Column, column: Column) -> Column:
    return F.format_string("%s_r%03d_c%03d", field, row, column)


def file_stem(path: Column | str) -> Column:
    """The last part of a path without its last extension."""
    return F.regexp_replace(F.regexp_extract(col(path), r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def extension(path: Column | str) -> Column:
    return F.lower(F.regexp_extract(col(path), r"\.([^./]+)$", 1))


def clean_tag(tag: Column | str) -> Column:
    return F.regexp_replace(col(tag), "[ /]", "-")


def run_state(promoted: Column | str) -> Column:
    return F.when(F.coalesce(col(promoted), F.lit(False)), "Aprovado").otherwise("Avaliado")


def run_id(version: Column, tag: Column) -> Column:
    """version, tag and six random hexadecimal digits; differs on every evaluation."""
    return F.concat_ws("_", version, F.coalesce(F.nullif(tag, F.lit("")), F.lit("run")), F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 6))


def mime_type(path: Column | str) -> Column:
    suffix = F.lower(F.regexp_extract(col(path), r"(\.[^./]+)$", 1))
    known = F.create_map(*(F.lit(x) for pair in MIME.items() for x in pair))
    return F.coalesce(F.try_element_at(known, suffix), F.lit("application/octet-stream"))


def fixed(x: Column, places: int = 4) -> Column:
    """Decimal text of a number's exact value, rounded half to even, as the reports expect; null for null.

    The number is scaled so that ties are odd whole numbers. Where the scaled number is one, the error of the product, by
    Dekker's splitting, tells on which side of the tie the exact value lies.
    """
    scale = 2.0 * 10**places

    def halves(v: Column) -> tuple[Column, Column]:
        big = v * 134217729.0
        high = big - (big - v)
        return high, v - high

    def rounded(v: Column) -> Column:
        p = v * scale
        (a, b), (c, d) = halves(v), halves(F.lit(scale))
        error = ((a * c - p) + a * d + b * c) + b * d
        low = F.floor(p / 2)
        up = F.when(p % 2 != 1, p - 2 * low >= 1).when(error != 0, error > 0).otherwise(low % 2 == 1)
        return low + up.cast("long")

    def told(v: Column) -> Column:
        n = rounded(F.abs(v))
        sign = F.when(v < 0, "-").otherwise("")
        whole = F.concat(sign, F.floor(n / 10**places).cast("string"), F.lit("."), F.lpad((n % 10**places).cast("string"), places, "0"))
        return F.when(F.abs(v) < 1e9, whole).otherwise(F.format_string(f"%.{places}f", v))

    if places == 0:
        return F.when(x.isNotNull(), F.format_string("%.0f", F.rint(x.cast("double"))))
    return F.when(x.isNotNull(), let(x.cast("double"), told))


def signed(x: Column, places: int = 4) -> Column:
    text = fixed(x, places)
    return F.when(text.startswith("-"), text).otherwise(F.concat(F.lit("+"), text))


def run_title(version: Column, tag: Column, metrics: Column) -> Column:
    tag = F.coalesce(F.nullif(tag, F.lit("")), F.lit("run"))
    return F.concat(version, F.lit(" · "), tag, F.lit(" · seg_mAP50-95="), fixed(F.coalesce(F.try_element_at(metrics, F.lit("seg_mAP50-95")), F.lit(0.0))))


def metrics_table(metrics: Column) -> Column:
    """A markdown table of the known metrics that are present, in their order."""
    rows = F.array(*(F.concat(F.lit(f"| {m} | "), fixed(F.try_element_at(metrics, F.lit(m))), F.lit(" |")) for m in METRICS))
    return F.array_join(F.concat(F.array(F.lit("| métrica | valor |"), F.lit("|---|---|")), F.array_compact(rows)), "\n")


# fixed values: the words of the cards below and of the reports
def review_title(image: Column) -> Column:
    return F.concat(F.lit("Revisar "), image)


def review_body(image: Column, reason: Column, signals: dict[str, Column], issues: Column) -> Column:
    """The body of a review card: its signals where the score is finite, then its findings."""
    number = lambda k: F.concat(F.lit(f"{k}: "), fixed(signals[k]))
    counts = F.concat(F.lit("n_gt: "), signals["n_gt"].cast("string"), F.lit(" · n_pred: "), signals["n_pred"].cast("string"))
    finite = signals["score"] != float("inf")
    told = F.array(*(number(k) for k in ("score", "mean_iou", "gt_perdidos_ratio", "ghost_conf")), counts)
    found = F.concat(F.array(F.lit("**achados QA:**")), F.transform(issues, lambda i: F.concat(F.lit("- "), i)))
    none = F.array().cast("array<string>")
    head = F.array(F.concat(F.lit("**imagem:** `"), image, F.lit("`")), F.concat(F.lit("**motivo:** "), reason))
    return F.array_join(F.concat(head, F.when(finite, told).otherwise(none), F.when(F.size(issues) > 0, found).otherwise(none)), "\n")


def snapshot_comment(version: str, changelog: str) -> str:
    return f"**snapshot criado:** `{version}`\n\n```json\n{changelog}\n```"


def run_comment(run_id: Column, version: Column, metrics: Column, promoted: Column, verdict: Column) -> Column:
    """What a card is told of a run."""
    listed = F.array_join(F.transform(F.map_entries(metrics), lambda e: F.concat(F.lit("- **"), e["key"], F.lit(":** "), fixed(e["value"]))), "\n")
    judged = F.when(promoted, "✔ promovido").otherwise("✘ não promovido")
    return F.concat(F.lit("**run:** `"), run_id, F.lit("`\n**versão:** `"), version, F.lit("`\n\n"), listed, F.lit("\n\n**veredito:** "), judged, F.lit(" — "), verdict)


def run_description(run: dict[str, Column], extra: Column | None = None) -> Column:
    """The markdown body of a version card; extra is a map of further fields."""
    line = lambda label, value, tick="`": F.concat(F.lit(f"**{label}**: {tick}"), F.coalesce(value.cast("string"), F.lit("-")), F.lit(tick))
    blank = F.lit("")
    lines = [
        line("run_id", run["run_id"]), line("versão do dataset", run["version"]), line("tag", F.nullif(run["tag"], blank)), line("arquitetura", run["arch"]),
        F.concat(line("imgsz", run["imgsz"], ""), F.lit("  ·  "), line("seed", run["seed"], ""), F.lit("  ·  "), line("epochs", run["epochs"], "")),
        line("criado em", run["created_at"], ""), blank, F.lit("## Métricas no golden set"), metrics_table(run["metrics"]), blank,
        line("Veredito de promoção", run["verdict"], ""), F.concat(F.lit("**Promoted**: "), F.when(run["promoted"], "sim").otherwise("não")), blank,
        line("Pesos", run["weights"]),
    ]
    body = F.array(*lines)
    if extra is not None:
        entries = F.transform(F.map_entries(extra), lambda e: F.concat(F.lit("- **"), e["key"], F.lit("**: "), e["value"]))
        body = F.concat(body, F.array(blank, F.lit("## Contexto adicional")), entries)
    return F.array_join(body, "\n")


def suspicion_reasons(missed: Column, ghost: Column, mean_iou: Column, n_gt: Column) -> Column:
    """Why an image is suspect, as markdown list lines."""
    percent = F.concat(fixed(missed * 100, 0), F.lit("%"))
    reasons = F.array_compact(F.array(
        F.when(missed > 0, F.concat(F.lit("- **"), percent, F.lit("** das anotações não foram detectadas"))),
        F.when(ghost > 0.5, F.concat(F.lit("- predição fantasma com conf **"), fixed(ghost, 2), F.lit("** onde não há rótulo"))),
        F.when((mean_iou < 0.9) & (n_gt > 0), F.concat(F.lit("- IoU médio entre GT e predição **"), fixed(mean_iou, 2), F.lit("** (baixo)"))),
    ))
    return F.when(F.size(reasons) > 0, F.array_join(reasons, "\n")).otherwise("- (motivo genérico)")


def suspicion_body(image: Column, score: Column, n_gt: Column, n_pred: Column, reasons: Column, model: str, preview: Column | None = None) -> Column:
    """The markdown body of a review card."""
    lines = [
        F.concat(F.lit("**Tile**: `"), image, F.lit("`")), F.concat(F.lit("**Score de suspeita**: "), fixed(score, 3)),
        F.concat(F.lit("**Instâncias GT**: "), n_gt.cast("string"), F.lit("  ·  **Predições**: "), n_pred.cast("string")),
        F.concat(F.lit("\n![preview]("), preview, F.lit(")\n")) if preview is not None else F.lit(""), F.lit("### Motivos"), reasons, F.lit(""),
        F.lit("### Legenda do preview"), F.lit("- **Verde**: anotação atual (GT)"), F.lit("- **Vermelho**: predição do modelo"), F.lit(""), F.lit("### Ação"),
        F.concat(F.lit("1. Abrir `"), image, F.lit("` no anotador")), F.lit("2. Comparar rótulo atual com a predição do modelo"),
        F.lit("3. Corrigir se rótulo estiver errado; mover card para **Em anotação**"), F.lit("4. Depois de revisado, mover para **Em revisão (QA)**"), F.lit(""),
        F.lit(f"**Modelo avaliador**: `{model}`"),
    ]
    return F.array_join(F.array(*lines), "\n")
