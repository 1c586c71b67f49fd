"""Detector output: decoding, un-letterboxing, non-maximum suppression, crops onto the page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.geometry import box, centre_to_corners, crop_to_page, height, iou, rectangle, unletterbox
from pagemill.functions.text import non_blank


def decode(rows: DataFrame, input_size: int = 1280, min_score: float = 0.15, min_size: float = 4.0, box_format: str = "xyxy", labels: dict[int, str] | None = None) -> DataFrame:
    """Detector rows (x1, y1, x2, y2, score, class; original_width, original_height) as page boxes.

    The letterbox is that of a centred square around the page. Rows under the score or with a
    degenerate box are left out; a class without a label is named by its number."""
    if box_format not in ("xyxy", "xywh"):
        raise ValueError("box_format must be xyxy or xywh")
    w, h = F.col("original_width"), F.col("original_height")
    square = F.greatest(w, h)
    left, top = F.floor((square - w) / 2), F.floor((square - h) / 2)
    c = [F.col(x).cast("double") for x in ("x1", "y1", "x2", "y2")]
    raw = box(*c) if box_format == "xyxy" else centre_to_corners(*c)
    cls = F.coalesce(F.col("class").cast("int"), F.lit(0))
    names = F.create_map(*[x for k, v in (labels or {-1: ""}).items() for x in (F.lit(k), F.lit(v))])
    out = rows.where(F.col("score") >= min_score).withColumn("box", unletterbox(raw, w, h, square, left, top, input_size, min_size)).where("box is not null")
    return out.withColumn("class_id", cls).withColumn("label", F.coalesce(F.element_at(names, F.col("class_id")), F.col("class_id").cast("string"))).withColumn("polygon", rectangle(F.col("box")))


def suppress(boxes: DataFrame, page: str, threshold: float = 0.30, limit: int | None = None, score: str = "score") -> DataFrame:
    """Non-maximum suppression over all classes: best score first (ties in input order), dropping
    what overlaps a kept box at or above the threshold; then at most ``limit`` boxes a page.

    One row per page holds its boxes; a detector gives a page a bounded number of them."""
    lists = boxes.groupBy(page).agg(F.array_sort(F.collect_list(F.struct((-F.col(score)).alias("n"), "ord", "box"))).alias("a"))
    kept = F.aggregate("a", F.slice("a", 1, 0), lambda acc, d: F.when(F.exists(acc, lambda e: iou(e["box"], d["box"]) >= threshold), acc).otherwise(F.array_append(acc, d)))
    if limit is not None:
        kept = F.slice(kept, 1, max(limit, 0))
    return lists.select(page, F.posexplode(kept).alias("rank", "d")).select(page, "rank", "d.ord", (-F.col("d.n")).alias("score"), "d.box")


def project(crops: DataFrame, default_type: str = "dialogue") -> DataFrame:
    """Lines read on crops as page lines.

    Needs polygon, transcript, recognition_confidence, script_confidence, lang, text_type; left, top,
    right, bottom, rotated of the crop; detection_confidence, detection_height, direction of the
    detection. Lines without text or points are left out."""
    drawn = F.size("polygon") > 0
    rec = F.coalesce("recognition_confidence", F.lit(0.0))
    script = F.coalesce("script_confidence", rec)
    page: Column = crop_to_page(F.col("polygon"), F.col("left"), F.col("top"), F.col("bottom") - F.col("top"), F.col("rotated"))
    out = crops.where(non_blank(F.col("transcript")).isNotNull() & drawn).withColumn("page_polygon", page)
    return out.select(
        "ord", non_blank(F.col("transcript")).alias("transcript"), F.col("page_polygon").alias("polygon"), F.coalesce("lang", F.lit("mixed")).alias("lang"), "direction",
        F.coalesce("text_type", F.lit(default_type)).alias("text_type"), "detection_confidence", rec.alias("recognition_confidence"), script.alias("script_confidence"),
        F.least("detection_confidence", rec, script).alias("teacher_agreement"), F.greatest(height(F.col("page_polygon")), F.col("detection_height")).alias("min_text_height"),
    )
