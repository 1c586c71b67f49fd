"""Annotation tasks: nested task documents from pages, and records back from their exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.geometry import from_percent, to_percent
from pagemill.functions.hashing import SplitRule
from pagemill.functions.text import quote_path, strip
from pagemill.schemas import ITEM


def image_value(path: Column, base_url: str | None = None, document_root: bool = False) -> Column:
    """The image reference of a task: the path, a file under a base URL, or a quoted local path."""
    if base_url and document_root:
        raise ValueError("give a base URL or a document root, not both")
    if base_url:
        return F.concat(F.lit(base_url.rstrip("/") + "/"), F.substring_index(path, "/", -1))
    if document_root:
        outside = F.concat(F.lit("path outside the document root: "), path)
        return F.when(path.startswith("..") | path.contains("/../"), F.raise_error(outside)).otherwise(F.concat(F.lit("/data/local-files/?d="), quote_path(path)))
    return path


def items(lines: Column, width: Column, height: Column) -> Column:
    """Four result items per line: region, text, language and direction, as an array of structs."""
    size = lambda c: F.when(c != 0, c).otherwise(1)

    def item(id_: Column, parent: Column, name: str, kind: str, w: Column, h: Column, **value: Column) -> Column:
        arrays = {"points": "array<array<double>>", "polygonlabels": "array<string>", "text": "array<string>", "choices": "array<string>"}
        v = F.struct(*[value.get(k, F.lit(None)).cast(t).alias(k) for k, t in arrays.items()])
        return F.struct(id_.alias("id"), parent.alias("parentID"), F.lit(name).alias("from_name"), F.lit("image").alias("to_name"), F.lit(kind).alias("type"), w.cast("int").alias("original_width"), h.cast("int").alias("original_height"), v.alias("value")).cast(ITEM)

    none = F.lit(None).cast("string")

    def four(line: Column, i: Column) -> Column:
        r = F.concat(F.lit("pred-"), i.cast("string"))
        sub = lambda s: F.concat(r, F.lit(s))
        return F.array(
            item(r, none, "text_region", "polygonlabels", size(width), size(height), points=to_percent(line["polygon"], width, height), polygonlabels=F.array(line["text_type"])),
            item(sub("-text"), r, "transcript", "textarea", F.lit(None), F.lit(None), text=F.array(line["transcript"])),
            item(sub("-language"), r, "language", "choices", F.lit(None), F.lit(None), choices=F.array(line["lang"])),
            item(sub("-direction"), r, "direction", "choices", F.lit(None), F.lit(None), choices=F.array(line["direction"])),
        )

    return F.flatten(F.transform(lines, four))


def tasks(pages: DataFrame, lines: DataFrame, extra: tuple[str, ...] = (), base_url: str | None = None, document_root: bool = False) -> DataFrame:
    """(asset_id, data, predictions): one task per page, with the fields ``extra`` of the page in its
    data. Pages without lines have null predictions, which JSON then leaves out."""
    w, h = F.col("width"), F.col("height")
    data = F.struct(image_value(F.col("image_path"), base_url, document_root).alias("image"), "image_path", "asset_id", "series_id", "chapter_id", "page_index", "domain", "width", "height", *extra)
    result = F.array(F.struct(F.lit("teacher-bootstrap").alias("model_version"), F.lit(0.0).alias("score"), items(F.col("lines"), w, h).alias("result")))
    return pages.join(lines, "asset_id", "left").select("asset_id", data.alias("data"), F.when(F.size("lines") > 0, result).alias("predictions"))


def as_json(task_rows: DataFrame) -> DataFrame:
    """Tasks as JSON documents; absent keys are left out."""
    return task_rows.select("asset_id", F.to_json(F.struct("data", "predictions"), {"ignoreNullFields": "true"}).alias("task"))


def _first_text(group: Column, kind: str, name: str | None, field: str) -> Column:
    of = lambda x: (x["type"] == kind) & (F.size(x["value"][field]) > 0) & (F.lit(True) if name is None else x["from_name"] == name)
    return F.get(F.get(F.filter(group, of), F.lit(0))["value"][field], F.lit(0))


def records(export: DataFrame, rule: SplitRule | None = None) -> DataFrame:
    """Manifest records of an export (task_ord, data, annotations, predictions).

    Annotations win over predictions; the items of a region share its id or name it as parent; a
    region needs a polygon and a text. All annotations of a task are read. The regions of one task
    are grouped inside its own row, so nothing is shuffled."""
    rule = rule or SplitRule()
    human = F.coalesce(F.size("annotations"), F.lit(0)) > 0
    picked = export.select("task_ord", "data", human.alias("human"), F.posexplode(F.when(human, F.col("annotations")).otherwise(F.col("predictions"))).alias("item_ord", "source_item"))
    key = lambda x: F.coalesce(F.nullif(x["parentID"], F.lit("")), F.nullif(x["id"], F.lit("")), F.lit("orphan"))
    result = F.coalesce(F.col("source_item.result"), F.array().cast(f"array<{ITEM}>"))
    keyed = picked.withColumn("result", result).withColumn("keys", F.array_distinct(F.transform("result", key)))
    regions = keyed.select("task_ord", "data", "human", "item_ord", F.col("source_item.score").alias("score"), "result", F.posexplode("keys").alias("region_ord", "region"))
    group = F.filter("result", lambda x: key(x) == F.col("region"))
    polygon = F.get(F.filter("group", lambda x: x["type"] == "polygonlabels"), F.lit(0))
    nz = lambda c: F.nullif(c, F.lit(0))
    g = regions.withColumn("group", group).withColumn("p", polygon).where("p is not null")
    out = g.select(
        "task_ord", "item_ord", "region_ord", F.coalesce("data.image_path", F.lit("")).alias("image_path"), F.coalesce("data.series_id", F.lit("")).alias("series_id"),
        F.coalesce("data.domain", F.lit("manga")).alias("domain"), F.col("data.tile_id").alias("tile_id"),
        from_percent(F.col("p.value.points"), F.coalesce(nz(F.col("p.original_width")), F.col("data.width")), F.coalesce(nz(F.col("p.original_height")), F.col("data.height"))).alias("polygon"),
        strip(_first_text(F.col("group"), "textarea", None, "text")).alias("transcript"),
        F.coalesce(_first_text(F.col("group"), "choices", "language", "choices"), F.lit("mixed")).alias("lang"),
        F.coalesce(_first_text(F.col("group"), "choices", "direction", "choices"), F.lit("horizontal")).alias("direction"),
        F.coalesce(F.get("p.value.polygonlabels", F.lit(0)), F.lit("unknown")).alias("text_type"),
        F.col("score").alias("confidence"), F.when(F.col("human"), "human").otherwise("teacher").alias("source"),
    ).where("transcript != ''")
    return out.withColumn("split", rule.assign(F.col("series_id")))
