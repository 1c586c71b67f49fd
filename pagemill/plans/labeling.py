"""Queries over predictions, review routing and gold batches, with the SQL they must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.hashing import SplitRule, unit_score
from pagemill.operators import predictions as P
from pagemill.operators import review as R
from pagemill.session import table

_PREDS = "teacher_predictions"
GOLD_PAGES = 500


def _t(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, d, "page_assets"), table(spark, d, _PREDS)


def silver_manifest(spark: SparkSession, d: str) -> DataFrame:
    return P.silver_manifest(_t(spark, d)[1]).drop("polygon", "tile_id")


def rejected_reasons(spark: SparkSession, d: str) -> DataFrame:
    return P.reason_counts(_t(spark, d)[1])


def prediction_summary(spark: SparkSession, d: str) -> DataFrame:
    return P.summary(_t(spark, d)[1])


def prediction_decisions(spark: SparkSession, d: str) -> DataFrame:
    return P.decide(_t(spark, d)[1]).select("ord", "confidence", "accepted", "review_score", F.array_join("reasons", ",").alias("reasons"))


def review_topk_lines(spark: SparkSession, d: str) -> DataFrame:
    return P.review_queue(_t(spark, d)[1], 100).select("ord", "asset_id", "review_score")


def review_topk_pages(spark: SparkSession, d: str) -> DataFrame:
    assets, preds = _t(spark, d)
    return P.review_pages(preds, assets, 100)[0]


def review_topk_page_lines(spark: SparkSession, d: str) -> DataFrame:
    assets, preds = _t(spark, d)
    return P.review_pages(preds, assets, 100)[1].select("ord", "asset_id", "accepted", "review_score")


def page_rollup(spark: SparkSession, d: str) -> DataFrame:
    return R.page_rollup(_t(spark, d)[1]).withColumn("reasons", F.array_join("reasons", ","))


def lines_by_asset(spark: SparkSession, d: str) -> DataFrame:
    return P.by_asset(_t(spark, d)[1]).select("asset_id", F.size("lines").cast("bigint").alias("lines"), F.array_join(F.transform("lines", lambda x: x["ord"].cast("string")), ",").alias("ords"))


def prediction_enrich(spark: SparkSession, d: str) -> DataFrame:
    assets, preds = _t(spark, d)
    return P.enrich(preds, assets).select("ord", "asset_id", "chapter_id", "page_index", "width", "height")


def prediction_normalize(spark: SparkSession, d: str) -> DataFrame:
    assets, preds = _t(spark, d)
    return P.normalize_predictions(preds, assets)[0].select("ord", "asset_id", "domain", "transcript", "lang", "direction", "text_type", "teacher_agreement")


def exception_routing(spark: SparkSession, d: str) -> DataFrame:
    return R.route_pages(*_t(spark, d)).select("asset_id", "route", "review_score", F.array_join("reasons", ",").alias("reasons"), "accepted_predictions", "rejected_predictions", "preannotated_lines", "sample_score")


def audit_sample(spark: SparkSession, d: str) -> DataFrame:
    return R.route_pages(*_t(spark, d)).where("route = 'audit'").select("asset_id", "sample_score")


def exception_summary(spark: SparkSession, d: str) -> DataFrame:
    return R.route_summary(R.route_pages(*_t(spark, d)))


def exception_reasons(spark: SparkSession, d: str) -> DataFrame:
    return R.route_reasons(R.route_pages(*_t(spark, d)))


def series_split(spark: SparkSession, d: str) -> DataFrame:
    series = table(spark, d, "page_assets").select("series_id").distinct()
    rule = SplitRule()
    return series.select("series_id", unit_score(rule.salt, F.col("series_id")).alias("score"), rule.assign(F.col("series_id")).alias("split"))


def split_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_assets").groupBy(SplitRule().assign(F.col("series_id")).alias("split")).agg(F.count("*").alias("pages"), F.count_distinct("series_id").alias("series"))


def gold_batch(spark: SparkSession, d: str) -> DataFrame:
    return R.gold_batch(*_t(spark, d), page_limit=GOLD_PAGES).select("asset_id", "split", "review_mode", "review_priority", "preannotated_lines", F.array_join("priority_reasons", ",").alias("priority_reasons"), "gold_batch_rank")


def gold_batch_summary(spark: SparkSession, d: str) -> DataFrame:
    return R.gold_summary(R.gold_batch(*_t(spark, d), page_limit=GOLD_PAGES))


QUERIES = {
    f.__name__: f
    for f in (
        silver_manifest, rejected_reasons, prediction_summary, prediction_decisions, review_topk_lines, review_topk_pages, review_topk_page_lines, page_rollup, lines_by_asset,
        prediction_enrich, prediction_normalize, exception_routing, audit_sample, exception_summary, exception_reasons, series_split, split_counts, gold_batch, gold_batch_summary,
    )
}

_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip_sql(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_SPACE}+', ''), '{_SPACE}+$', '')"


def score_sql(salt: str, c: str) -> str:
    return f"(('0x' || substr(sha256('{salt}:' || {c}), 1, 16))::UBIGINT)::DOUBLE / 18446744073709551616::DOUBLE"


def split_sql(c: str, salt: str = "series-split-v1") -> str:
    s = score_sql(salt, c)
    return f"CASE WHEN {s} < 0.8e0 THEN 'train' WHEN {s} < 0.8e0 + 0.1e0 THEN 'val' ELSE 'test' END"


#: e: every prediction with its decision
DECIDED = """
    d AS (SELECT *, (detection_confidence + recognition_confidence + script_confidence + teacher_agreement) / 4e0 AS confidence,
            coalesce(min_text_height < 12e0, false) AS small,
            list_filter([CASE WHEN detection_confidence < 0.85e0 THEN 'low_detection_confidence' END,
                         CASE WHEN recognition_confidence < 0.82e0 THEN 'low_recognition_confidence' END,
                         CASE WHEN script_confidence < 0.8e0 THEN 'low_script_confidence' END,
                         CASE WHEN teacher_agreement < 0.75e0 THEN 'teacher_disagreement' END,
                         CASE WHEN coalesce(min_text_height < 12e0, false) THEN 'small_text' END], lambda r: r IS NOT NULL) AS reasons
          FROM teacher_predictions),
    e AS (SELECT *, len(reasons) = 0 AS accepted,
            1e0 - confidence + CASE WHEN domain = 'webtoon' THEN 0.25e0 ELSE 0e0 END + CASE WHEN direction = 'vertical' THEN 0.2e0 ELSE 0e0 END
            + CASE WHEN text_type = 'sfx' THEN 0.3e0 ELSE 0e0 END + CASE WHEN small THEN 0.2e0 ELSE 0e0 END + 0.15e0 * len(reasons)::DOUBLE AS review_score
          FROM d)"""
#: last: the catalog, one row per asset
CATALOG = "last AS (SELECT * FROM page_assets QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY ord DESC) = 1)"
_ROLLUP = """
    r AS (SELECT asset_id, count(*) AS lines, count(*) FILTER (accepted) AS accepted, count(*) FILTER (NOT accepted) AS rejected, max(review_score) AS review_score,
            array_to_string(list_sort(list_distinct(flatten(list(reasons)))), ',') AS reasons FROM e GROUP BY asset_id)"""
_ROUTED = f"""
    {DECIDED}, {CATALOG}, {_ROLLUP},
    q AS (SELECT last.asset_id, r.lines IS NULL AS no_lines, CASE WHEN r.lines IS NULL OR rejected > 0 THEN 'review' ELSE 'auto_accept' END AS route,
            coalesce(r.review_score, 2e0) AS review_score, coalesce(r.reasons, 'no_teacher_predictions') AS reasons,
            coalesce(accepted, 0) AS accepted_predictions, coalesce(rejected, 0) AS rejected_predictions, coalesce(lines, 0) AS preannotated_lines,
            {score_sql("page-audit-v1", "last.asset_id")} AS h
          FROM last LEFT JOIN r USING (asset_id)),
    n AS (SELECT least(greatest(ceil(count(*) * 0.02e0), 10), count(*)) AS k FROM q WHERE route = 'auto_accept'),
    s AS (SELECT asset_id FROM q WHERE route = 'auto_accept' QUALIFY row_number() OVER (ORDER BY h, asset_id) <= (SELECT k FROM n)),
    routed AS (SELECT q.asset_id, CASE WHEN s.asset_id IS NULL THEN route ELSE 'audit' END AS route, review_score,
            CASE WHEN s.asset_id IS NULL THEN reasons ELSE 'audit_sample' END AS reasons, accepted_predictions, rejected_predictions, preannotated_lines,
            CASE WHEN s.asset_id IS NOT NULL THEN h END AS sample_score
          FROM q LEFT JOIN s USING (asset_id))"""
_TOP = f"""
    {DECIDED},
    b AS (SELECT asset_id, max(review_score) AS review_score FROM e WHERE asset_id IN (SELECT asset_id FROM page_assets) GROUP BY asset_id),
    o AS (SELECT b.asset_id, b.review_score, min(e.ord) AS o FROM b JOIN e ON e.asset_id = b.asset_id AND e.review_score = b.review_score GROUP BY ALL),
    top AS (SELECT asset_id, review_score, row_number() OVER (ORDER BY review_score DESC, o) AS rank FROM o QUALIFY rank <= 100)"""
_GOLD = f"""
    {DECIDED}, {CATALOG}, {_ROLLUP},
    p AS (SELECT last.*, {split_sql("series_id")} AS split, coalesce(r.review_score, 0e0) AS review_priority, coalesce(r.reasons, '') AS priority_reasons, coalesce(r.lines, 0) AS preannotated_lines
          FROM last LEFT JOIN r USING (asset_id)),
    k AS (SELECT *, CASE WHEN split = 'test' THEN 'double_review' ELSE 'single_review' END AS review_mode,
            row_number() OVER (PARTITION BY split ORDER BY review_priority DESC, series_id, chapter_id, page_index, asset_id) AS i FROM p),
    gold AS (SELECT asset_id, split, review_mode, review_priority, preannotated_lines, priority_reasons,
            row_number() OVER (ORDER BY review_priority DESC, series_id, chapter_id, page_index, asset_id) AS gold_batch_rank
          FROM k WHERE i <= CASE split WHEN 'train' THEN {GOLD_PAGES * 8 // 10} ELSE {GOLD_PAGES // 10} END)"""

SQL = {
    "silver_manifest": f"WITH {DECIDED} SELECT ord, image_path, series_id, domain, transcript, lang, direction, text_type, {split_sql('series_id')} AS split, confidence, 'teacher' AS source FROM e WHERE accepted",
    "rejected_reasons": f"WITH {DECIDED} SELECT reason, count(*) AS lines FROM (SELECT unnest(reasons) AS reason FROM e) GROUP BY reason",
    "prediction_summary": f"WITH {DECIDED} SELECT count(*) AS input_predictions, count(*) FILTER (accepted) AS accepted_silver, count(*) FILTER (NOT accepted) AS review_candidates FROM e",
    "prediction_decisions": f"WITH {DECIDED} SELECT ord, confidence, accepted, review_score, array_to_string(reasons, ',') AS reasons FROM e",
    "review_topk_lines": f"WITH {DECIDED} SELECT ord, asset_id, review_score FROM e ORDER BY review_score DESC, ord LIMIT 100",
    "review_topk_pages": f"WITH {_TOP} SELECT asset_id, review_score, rank FROM top",
    "review_topk_page_lines": f"WITH {_TOP} SELECT ord, asset_id, accepted, review_score FROM e WHERE asset_id IN (SELECT asset_id FROM top)",
    "page_rollup": f"WITH {DECIDED}, {_ROLLUP} SELECT * FROM r",
    "lines_by_asset": "SELECT asset_id, count(*) AS lines, string_agg(ord::VARCHAR, ',' ORDER BY ord) AS ords FROM teacher_predictions GROUP BY asset_id",
    "prediction_enrich": f"WITH {CATALOG} SELECT p.ord, p.asset_id, last.chapter_id, last.page_index, last.width, last.height FROM teacher_predictions p LEFT JOIN last USING (asset_id)",
    "prediction_normalize": f"""
        WITH c AS (SELECT p.*, {strip_sql("p.transcript")} AS t, a.domain AS ad FROM teacher_predictions p LEFT JOIN (SELECT asset_id, min(domain) AS domain FROM page_assets GROUP BY asset_id) a USING (asset_id))
        SELECT ord, {strip_sql("asset_id")} AS asset_id, coalesce(ad, domain) AS domain, t AS transcript, coalesce(nullif({strip_sql("lang")}, ''), 'mixed') AS lang, direction, text_type, teacher_agreement
        FROM c WHERE t <> '' AND len(polygon) > 0""",
    "exception_routing": f"WITH {_ROUTED} SELECT * FROM routed",
    "audit_sample": f"WITH {_ROUTED} SELECT asset_id, sample_score FROM routed WHERE route = 'audit'",
    "exception_summary": f"""WITH {_ROUTED} SELECT count(*) AS pages_considered, count(*) FILTER (route = 'auto_accept') AS auto_accept_pages, count(*) FILTER (route = 'review') AS review_pages,
        count(*) FILTER (route = 'audit') AS audit_pages, count(*) FILTER (route <> 'auto_accept') AS selected_review_tasks, sum(accepted_predictions)::BIGINT AS accepted_predictions,
        sum(rejected_predictions)::BIGINT AS rejected_predictions, sum(preannotated_lines)::BIGINT AS preannotated_lines,
        count(*) FILTER (route = 'audit')::DOUBLE / count(*) FILTER (route <> 'review')::DOUBLE AS effective_audit_rate FROM routed""",
    "exception_reasons": f"WITH {_ROUTED} SELECT reason, count(*) AS pages FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM routed WHERE route = 'review') GROUP BY reason",
    "series_split": f"SELECT series_id, {score_sql('series-split-v1', 'series_id')} AS score, {split_sql('series_id')} AS split FROM (SELECT DISTINCT series_id FROM page_assets)",
    "split_counts": f"SELECT {split_sql('series_id')} AS split, count(*) AS pages, count(DISTINCT series_id) AS series FROM page_assets GROUP BY 1",
    "gold_batch": f"WITH {_GOLD} SELECT * FROM gold",
    "gold_batch_summary": f"WITH {_GOLD} SELECT split, review_mode, count(*) AS pages, count(*) FILTER (preannotated_lines > 0) AS preannotated_pages FROM gold GROUP BY ALL",
}


def gold_sql() -> str:
    """The beginning of a statement about the table ``gold``, the batch."""
    return f"WITH {_GOLD}"


def routed_sql() -> str:
    """The beginning of a statement about the table ``routed``, the pages with their route."""
    return f"WITH {_ROUTED}"
