"""Teacher predictions: normalisation, threshold decisions, silver labels, review queues."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.hashing import SplitRule
from pagemill.functions.text import non_blank, strip

CONFIDENCES = ("detection_confidence", "recognition_confidence", "script_confidence", "teacher_agreement")


@dataclass(frozen=True)
class Thresholds:
    detection: float = 0.85
    recognition: float = 0.82
    script: float = 0.80
    agreement: float = 0.75
    text_height: float = 12.0

    def override(self, **given: float | None) -> Thresholds:
        """A copy with the values that are not None."""
        return Thresholds(**{**self.__dict__, **{k: v for k, v in given.items() if v is not None}})


def confidence() -> Column:
    """The mean of the four confidences, summed from left to right."""
    d, r, s, a = (F.col(c) for c in CONFIDENCES)
    return (d + r + s + a) / 4.0


def small_text(t: Thresholds) -> Column:
    return F.coalesce(F.col("min_text_height") < t.text_height, F.lit(False))


def reasons(t: Thresholds) -> Column:
    """Why a line fails, in fixed order; a value equal to its threshold passes, as does no height."""
    checks = [
        (F.col("detection_confidence") < t.detection, "low_detection_confidence"),
        (F.col("recognition_confidence") < t.recognition, "low_recognition_confidence"),
        (F.col("script_confidence") < t.script, "low_script_confidence"),
        (F.col("teacher_agreement") < t.agreement, "teacher_disagreement"),
        (small_text(t), "small_text"),
    ]
    return F.array_compact(F.array(*[F.when(c, name) for c, name in checks]))


def decide(preds: DataFrame, t: Thresholds | None = None) -> DataFrame:
    """Each prediction with confidence, reasons, accepted and review_score. Map-only."""
    t = t or Thresholds()
    add = lambda c, x: F.when(c, x).otherwise(0.0)
    score = 1.0 - F.col("confidence") + add(F.col("domain") == "webtoon", 0.25) + add(F.col("direction") == "vertical", 0.20)
    score = score + add(F.col("text_type") == "sfx", 0.30) + add(small_text(t), 0.20) + F.lit(0.15) * F.size("reasons").cast("double")
    return preds.withColumn("confidence", confidence()).withColumn("reasons", reasons(t)).withColumn("accepted", F.size("reasons") == 0).withColumn("review_score", score)


def normalize_predictions(raw: DataFrame, assets: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(predictions, rejected) of raw records, of which any column but asset_id, transcript and
    polygon may be missing.

    The asset wins for the domain; the record wins for series and image path; missing confidences
    fall back to ``confidence``, else to 0. Records without asset, text or polygon go to
    ``rejected`` with a problem each, instead of failing the file."""
    have = set(raw.columns)
    c = lambda name, kind="string": F.col(f"r.{name}") if name in have else F.lit(None).cast(kind)
    joined = raw.alias("r")
    if assets is not None:
        known = F.struct(*[F.col(k).alias(f"a_{k}") for k in ("series_id", "image_path", "domain")])
        last = F.max_by(known, "ord") if "ord" in assets.columns else F.max(known)  # of an asset's rows the last delivered
        one = assets.groupBy("asset_id").agg(last.alias("k")).select("asset_id", "k.*")
        joined = joined.join(one.withColumnRenamed("asset_id", "a_id").alias("a"), c("asset_id") == F.col("a_id"), "left")
    else:
        joined = joined.select("*", *[F.lit(None).cast("string").alias(f"a_{k}") for k in ("series_id", "image_path", "domain")])
    fallback = F.coalesce(c("confidence", "double"), F.lit(0.0))
    problem = (
        F.when(non_blank(c("asset_id")).isNull(), "no asset_id")
        .when(non_blank(c("transcript")).isNull(), "no transcript")
        .when(F.coalesce(F.size(c("polygon", "array<struct<x:double,y:double>>")), F.lit(0)) == 0, "no polygon")
        .when(F.coalesce(non_blank(c("series_id")), F.col("a_series_id")).isNull(), "no series_id")
        .when(F.coalesce(non_blank(c("image_path")), F.col("a_image_path")).isNull(), "no image_path")
    )
    out = joined.select(
        strip(c("asset_id")).alias("asset_id"),
        F.coalesce(non_blank(c("series_id")), F.col("a_series_id")).alias("series_id"),
        F.coalesce(non_blank(c("image_path")), F.col("a_image_path")).alias("image_path"),
        F.coalesce(F.col("a_domain"), non_blank(c("domain")), F.lit("manga")).alias("domain"),
        c("polygon", "array<struct<x:double,y:double>>").alias("polygon"),
        strip(c("transcript")).alias("transcript"),
        F.coalesce(non_blank(c("lang")), F.lit("mixed")).alias("lang"),
        F.coalesce(non_blank(c("direction")), F.lit("horizontal")).alias("direction"),
        F.coalesce(non_blank(c("text_type")), F.lit("unknown")).alias("text_type"),
        *[F.coalesce(c(k, "double"), fallback).cast("double").alias(k) for k in CONFIDENCES],
        c("min_text_height", "double").cast("double").alias("min_text_height"),
        c("ord", "bigint").alias("ord"),
        problem.alias("problem"),
    )
    return out.where("problem is null").drop("problem"), out.where("problem is not null")


def enrich(preds: DataFrame, assets: DataFrame) -> DataFrame:
    """Predictions with chapter, page and size of their asset; of several rows of an asset the
    last one by ord counts. Predictions without an asset are kept."""
    last = assets.groupBy("asset_id").agg(F.max_by(F.struct("chapter_id", "page_index", "width", "height"), "ord").alias("a"))
    return preds.join(last, "asset_id", "left").select(preds["*"], "a.chapter_id", "a.page_index", "a.width", "a.height")


def silver_manifest(preds: DataFrame, rule: SplitRule | None = None, t: Thresholds | None = None) -> DataFrame:
    """Accepted predictions as manifest records with a split by series."""
    rule = rule or SplitRule()
    return decide(preds, t).where("accepted").select(
        "ord", "image_path", "series_id", "domain", F.lit(None).cast("string").alias("tile_id"), "polygon", "transcript", "lang", "direction", "text_type",
        rule.assign(F.col("series_id")).alias("split"), "confidence", F.lit("teacher").alias("source"),
    )


def rejected(preds: DataFrame, t: Thresholds | None = None) -> DataFrame:
    return decide(preds, t).where("not accepted")


def summary(preds: DataFrame, t: Thresholds | None = None) -> DataFrame:
    d = decide(preds, t)
    return d.agg(F.count("*").alias("input_predictions"), F.count_if("accepted").alias("accepted_silver"), F.count_if(~F.col("accepted")).alias("review_candidates"))


def reason_counts(preds: DataFrame, t: Thresholds | None = None) -> DataFrame:
    return rejected(preds, t).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("lines"))


def by_asset(preds: DataFrame) -> DataFrame:
    """The ordered lines of each page. A page's lines are one row: for pages, not for hot keys."""
    return preds.groupBy("asset_id").agg(F.array_sort(F.collect_list(F.struct("ord", "transcript", "lang", "direction", "text_type", "polygon"))).alias("lines"))


def review_queue(preds: DataFrame, limit: int = 100, t: Thresholds | None = None) -> DataFrame:
    """The ``limit`` lines most in need of review; ties in input order. A negative limit drops that
    many from the end, as a slice does."""
    d = decide(preds, t)
    if limit < 0:
        limit = max(0, d.count() + limit)
    return d.orderBy(F.desc("review_score"), "ord").limit(limit)


def review_pages(preds: DataFrame, assets: DataFrame, page_limit: int = 100, t: Thresholds | None = None) -> tuple[DataFrame, DataFrame]:
    """(pages, lines): the pages of the hardest lines among known assets, at least one page however
    small the limit, with their rank; and all decisions of these pages."""
    d = decide(preds, t)
    best = d.groupBy("asset_id").agg(F.max(F.struct("review_score", (-F.col("ord")).alias("o"))).alias("b"))
    known = best.join(assets.select("asset_id").distinct(), "asset_id", "left_semi")
    top = known.orderBy(F.desc("b.review_score"), F.desc("b.o")).limit(max(page_limit, 1))
    rank = F.row_number().over(Window.orderBy(F.desc("b.review_score"), F.desc("b.o")))  # over page_limit rows
    pages = top.select("asset_id", F.col("b.review_score").alias("review_score"), rank.alias("rank"))
    return pages, d.join(F.broadcast(pages.select("asset_id")), "asset_id", "left_semi")
