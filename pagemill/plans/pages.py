"""Queries over the catalog, annotation tasks, detection, words, images and feeds, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.geometry import bounding_box, crop_bounds, direction
from pagemill.functions.text import infer_lang, lenient_int, script_confidence
from pagemill.operators import annotation, catalog, detection, lines, predictions, review
from pagemill.operators.predictor import failures_of, predictions_of, run_predictor
from pagemill.plans.cycle import label_cycle
from pagemill.plans.evaluation import box_sql
from pagemill.plans.labeling import CATALOG, GOLD_PAGES, gold_sql, routed_sql, split_sql, strip_sql
from pagemill.session import shared_dir, table
from pagemill.sources import feeds, images
from pagemill.streaming.ingest import CatalogSink, ingest_available, page_stream


def _a(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_assets")


def _p(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "teacher_predictions")


def catalog_scan(spark: SparkSession, d: str) -> DataFrame:
    return catalog.scan(_a(spark, d)).select("source_id", "series_id", "chapter_id", "page_index", "asset_id", "ord")


def catalog_point(spark: SparkSession, d: str) -> DataFrame:
    a = _a(spark, d)
    return catalog.find(a, a.agg(F.min("asset_id")).collect()[0][0] or "").select("asset_id", "ord", "sha256")


def catalog_lookup_sha(spark: SparkSession, d: str) -> DataFrame:
    return catalog.first_by_sha(_a(spark, d))


def catalog_lookup_ids(spark: SparkSession, d: str) -> DataFrame:
    return catalog.find_many(_a(spark, d), _p(spark, d).select("asset_id", "ord")).select("asset_id", "ord", "position")


def catalog_decode(spark: SparkSession, d: str) -> DataFrame:
    return catalog.decoded(_a(spark, d)).select("ord", "canonical_asset_id", F.element_at("metadata", "page_no").alias("page_no"), F.element_at("metadata", "chapter_no").alias("chapter_no"))


def catalog_upsert(spark: SparkSession, d: str) -> DataFrame:
    a = _a(spark, d)
    return catalog.upsert(a.where("batch_id = 0"), a.where("batch_id > 0")).select("asset_id", "ord", "sha256", "is_duplicate")


def asset_ids(spark: SparkSession, d: str) -> DataFrame:
    return _a(spark, d).select("ord", catalog.asset_id(F.col("source_id"), F.col("series_id"), F.col("chapter_id"), F.col("page_index")).alias("made_id"))


def content_dedup(spark: SparkSession, d: str) -> DataFrame:
    return catalog.content_dedup(_a(spark, d)).select("ord", "canonical_ord", "canonical", "duplicate", "stored_path")


def asset_filter(spark: SparkSession, d: str) -> DataFrame:
    return catalog.select_assets(_a(spark, d), source_id="inkferry").select("asset_id", "ord", "series_id")


def chapter_status(spark: SparkSession, d: str) -> DataFrame:
    return catalog.chapter_status(_a(spark, d))


def ingest_summary(spark: SparkSession, d: str) -> DataFrame:
    return catalog.ingest_summary(catalog.chapter_status(_a(spark, d)))


def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """The catalog after a stream took in the whole feed."""
    import uuid

    a = _a(spark, d)
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = ", ".join(f"{c} {t}" for c, t in a.dtypes)
    got = ingest_available(page_stream(spark, f"{d}/page_assets.parquet", schema), CatalogSink(spark, f"{root}/catalog"), f"{root}/checkpoint")
    return got.select("asset_id", "ord", "sha256", "is_duplicate", "canonical_ord", "canonical", "duplicate")


def chapter_report(spark: SparkSession, d: str) -> DataFrame:
    """The report on deliveries of pages, those without a width taken as failed downloads."""
    return feeds.chapter_report(_a(spark, d).select("chapter_id", "page_index", F.when(F.col("width").isNull(), "no image").alias("error")))


def repeated_ord(spark: SparkSession, d: str) -> DataFrame:
    """Content marks of rows that share their ord in pairs: every duplicate has its canonical asset."""
    a = _a(spark, d).withColumn("ord", F.floor(F.col("ord") / 2))
    marks = catalog.content_dedup(a)
    return marks.agg(F.count("*").alias("n"), F.count_if(F.col("duplicate") & F.col("canonical").isNull()).alias("without"), F.count_if("duplicate").alias("duplicates"))


def _tasks(spark: SparkSession, d: str) -> DataFrame:
    return annotation.tasks(review.catalog(_a(spark, d)), predictions.by_asset(_p(spark, d)))


def ls_task_points(spark: SparkSession, d: str) -> DataFrame:
    """The first point of every region of every task."""
    item = _tasks(spark, d).select("asset_id", F.explode(F.get("predictions", F.lit(0))["result"]).alias("i")).where("i.type = 'polygonlabels'")
    first = F.get("i.value.points", F.lit(0))
    return item.select("asset_id", F.col("i.id").alias("region"), F.get(first, F.lit(0)).alias("px"), F.get(first, F.lit(1)).alias("py"), "i.original_width", "i.original_height")


def ls_task_items(spark: SparkSession, d: str) -> DataFrame:
    """Items per task and kind."""
    item = _tasks(spark, d).select("asset_id", F.explode(F.get("predictions", F.lit(0))["result"]).alias("i"))
    return item.groupBy("asset_id", F.col("i.from_name").alias("from_name")).agg(F.count("*").alias("items"))


def ls_task_json(spark: SparkSession, d: str) -> DataFrame:
    return annotation.as_json(_tasks(spark, d))


def gold_tasks(spark: SparkSession, d: str) -> DataFrame:
    """Tasks of a gold batch with their rank and mode."""
    batch = review.gold_batch(_a(spark, d), _p(spark, d), page_limit=500).join(review.catalog(_a(spark, d)).select("asset_id", "width", "height"), "asset_id").withColumnRenamed("split", "target_split")
    extra = ("target_split", "review_mode", "review_priority", "priority_reasons", "preannotated_lines", "gold_batch_rank")
    return annotation.as_json(annotation.tasks(batch, predictions.by_asset(_p(spark, d)), extra))


def exception_tasks(spark: SparkSession, d: str) -> DataFrame:
    """Tasks of the pages that review by exception sends to a person."""
    routed = review.route_pages(_a(spark, d), _p(spark, d)).where("route in ('review', 'audit')")
    extra = ("route", "review_score", "reasons", "accepted_predictions", "rejected_predictions", "preannotated_lines", "sample_score")
    return annotation.as_json(annotation.tasks(routed, predictions.by_asset(_p(spark, d)), extra))


def _field(name: str, kind: str) -> Column:
    return F.get_json_object("task", f"$.data.{name}").cast(kind).alias(name)


def gold_task_fields(spark: SparkSession, d: str) -> DataFrame:
    """What the documents of a gold batch say, read from their JSON again."""
    batch = review.gold_batch(_a(spark, d), _p(spark, d), page_limit=GOLD_PAGES).join(review.catalog(_a(spark, d)).select("asset_id", "width", "height"), "asset_id").withColumnRenamed("split", "target_split")
    docs = annotation.as_json(annotation.tasks(batch, predictions.by_asset(_p(spark, d)), ("target_split", "review_mode", "preannotated_lines", "gold_batch_rank")))
    return docs.select(_field("asset_id", "string"), _field("target_split", "string"), _field("review_mode", "string"), _field("preannotated_lines", "bigint"), _field("gold_batch_rank", "int"))


def exception_task_fields(spark: SparkSession, d: str) -> DataFrame:
    """What the documents of review by exception say, read from their JSON again."""
    return exception_tasks(spark, d).select(_field("asset_id", "string"), _field("route", "string"), _field("accepted_predictions", "bigint"), _field("rejected_predictions", "bigint"))


def ls_task_fields(spark: SparkSession, d: str) -> DataFrame:
    """What the documents of all pages say, read from their JSON again."""
    items = F.size(F.from_json(F.get_json_object("task", "$.predictions[0].result"), "array<string>"))
    return ls_task_json(spark, d).select(_field("asset_id", "string"), _field("series_id", "string"), _field("domain", "string"), F.greatest(F.lit(0), F.coalesce(items, F.lit(0))).alias("items"))


def image_keys(spark: SparkSession, d: str) -> DataFrame:
    """All images that predictions or gold lines name."""
    return _p(spark, d).select("image_path").union(table(spark, d, "gold_lines").select("image_path")).distinct()


def ls_export_regions(spark: SparkSession, d: str) -> DataFrame:
    """Tasks turned to records again: text, labels and the first point come back."""
    t = _tasks(spark, d)
    export = t.select(
        F.xxhash64("asset_id").alias("task_ord"),
        F.struct("data.image_path", "data.series_id", "data.domain", F.lit(None).cast("string").alias("tile_id"), "data.width", "data.height").alias("data"),
        F.lit(None).cast("array<struct<score:double,result:array<string>>>").alias("none"),
        F.transform("predictions", lambda p: F.struct(p["score"].alias("score"), p["result"].alias("result"))).alias("predictions"),
    ).withColumn("annotations", F.slice("predictions", 1, 0)).drop("none")
    first = F.get("polygon", F.lit(0))
    return annotation.records(export).select("image_path", "series_id", "transcript", "lang", "direction", "text_type", "split", "source", "confidence", (F.floor(first["x"] * 1000.0 + 0.5) / 1000.0).alias("x"), (F.floor(first["y"] * 1000.0 + 0.5) / 1000.0).alias("y"))


def ls_image_url(spark: SparkSession, d: str) -> DataFrame:
    spaced = F.replace("image_path", F.lit("/raw/"), F.lit("/raw & new/"))
    return _a(spark, d).select("ord", annotation.image_value(F.col("image_path"), base_url="https://images.example/").alias("url"), annotation.image_value(spaced, document_root=True).alias("local"))


def _words(spark: SparkSession, d: str) -> DataFrame:
    b = bounding_box(F.col("polygon"))
    p = _p(spark, d).withColumn("b", b).where("b is not null")
    w = p.select("image_path", F.col("ord").alias("line"), "recognition_confidence", "b", F.posexplode(F.split("transcript", " ")).alias("i", "text"))
    text = lambda c: c.cast("string")
    left = F.floor(F.col("b.x1")) + F.col("i") * 10
    return w.select(
        F.col("image_path").alias("page_key"), (F.col("line") * 1000 + F.col("i")).alias("ord"), F.lit("1").alias("page_num"), F.lit(" 1.0 ").alias("block_num"), F.lit("x").alias("par_num"), text(F.col("line")).alias("line_num"),
        text(left).alias("left"), text(F.floor(F.col("b.y1"))).alias("top"), F.lit("8").alias("width"), text(F.floor(F.col("b.y2") - F.col("b.y1"))).alias("height"), text(F.col("recognition_confidence") * 100).alias("conf"), "text",
    )


def words_to_lines(spark: SparkSession, d: str) -> DataFrame:
    got = lines.words_to_lines(lines.parse_words(_words(spark, d)))
    first, last = F.get("polygon", F.lit(0)), F.get("polygon", F.lit(2))
    return got.select("page_key", "line_num", "transcript", "confidence", "lang", "script_confidence", "text_height", first["x"].alias("x1"), first["y"].alias("y1"), last["x"].alias("x2"))


def lang_infer(spark: SparkSession, d: str) -> DataFrame:
    return _p(spark, d).select("ord", infer_lang(F.col("transcript")).alias("found"), script_confidence(F.col("transcript")).alias("script"))


def lenient_parse(spark: SparkSession, d: str) -> DataFrame:
    return _a(spark, d).select("ord", lenient_int(F.split_part("asset_id", F.lit(":"), F.lit(4))).alias("page"), lenient_int(F.col("chapter_id"), -1).alias("chapter"))


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    a = review.catalog(_a(spark, d)).select("asset_id", F.col("width").alias("original_width"), F.col("height").alias("original_height")).where("original_width is not null and original_height is not null")
    p = _p(spark, d).withColumn("b", bounding_box(F.col("polygon")))
    return p.join(a, "asset_id").select("asset_id", "ord", "b.x1", "b.y1", "b.x2", "b.y2", F.col("detection_confidence").alias("score"), F.pmod("ord", F.lit(3)).cast("double").alias("class"), "original_width", "original_height")


def _flat(b: Column) -> list[Column]:
    return [b[c].alias(c) for c in ("x1", "y1", "x2", "y2")]


def box_decode(spark: SparkSession, d: str) -> DataFrame:
    out = detection.decode(_boxes(spark, d), labels={0: "text", 1: "sfx"})
    return out.select("asset_id", "ord", "label", *[F.col("box")[c].alias(f"{c}_page") for c in ("x1", "y1", "x2", "y2")])


def nms(spark: SparkSession, d: str) -> DataFrame:
    return detection.suppress(detection.decode(_boxes(spark, d)), "asset_id").select("asset_id", "rank", "ord", "score")


def crop_windows(spark: SparkSession, d: str) -> DataFrame:
    b = F.struct("x1", "y1", "x2", "y2")
    rows = _boxes(spark, d)
    return rows.select("ord", crop_bounds(b, F.col("original_width"), F.col("original_height")).alias("c"), direction(b).alias("direction")).select("ord", "c.left", "c.top", "c.right", "c.bottom", "direction")


def project_polygons(spark: SparkSession, d: str) -> DataFrame:
    """Lines of crops (here: a box inside each crop, every other crop rotated) on their pages."""
    c = crop_windows(spark, d).where("left is not null")
    p = _p(spark, d).select("ord", "transcript", "recognition_confidence", "script_confidence", "lang", "text_type", "detection_confidence", F.col("min_text_height").alias("detection_height"))
    pt = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))
    crops = p.join(c, "ord").withColumn("polygon", F.array(pt(1.0, 2.0), pt(5.0, 2.0), pt(5.0, 7.0), pt(1.0, 7.0))).withColumn("rotated", F.pmod("ord", F.lit(2)) == 1)
    out = detection.project(crops)
    first, third = F.get("polygon", F.lit(0)), F.get("polygon", F.lit(2))
    return out.select("ord", "transcript", "teacher_agreement", "min_text_height", first["x"].alias("ax"), first["y"].alias("ay"), third["x"].alias("bx"), third["y"].alias("by"))


def _bytes(spark: SparkSession, d: str) -> DataFrame:
    """Image headers made from the catalog: PNG with its size, else the signature of its kind."""
    ext = F.lower(F.substring_index("image_path", ".", -1))
    png = F.concat(F.lit(images.PNG + "0000000D49484452"), F.lpad(F.hex(F.col("width").cast("bigint")), 8, "0"), F.lpad(F.hex(F.col("height").cast("bigint")), 8, "0"))
    head = F.when(ext == "png", png).when(ext == "jpg", F.lit("FFD8FFE000104A46494600")).otherwise(F.lit("52494646000000005745425056503820"))
    return _a(spark, d).where("width is not null and height is not null").select("ord", F.unhex(head).alias("content"))


def magic_extension(spark: SparkSession, d: str) -> DataFrame:
    return _bytes(spark, d).select("ord", images.extension(F.col("content")).alias("kind"))


def png_size(spark: SparkSession, d: str) -> DataFrame:
    w, h = images.png_size(F.col("content"))
    return _bytes(spark, d).select("ord", w.alias("w"), h.alias("h")).where("w is not null")


def store_paths(spark: SparkSession, d: str) -> DataFrame:
    return _a(spark, d).select("ord", images.store_path(F.lower("sha256"), F.lower(F.substring_index("image_path", ".", -1))).alias("path"))


def chapter_pages(spark: SparkSession, d: str) -> DataFrame:
    """Page payloads of a feed, built per chapter of the catalog and read again."""
    a = _a(spark, d).groupBy("series_id", "chapter_id").agg(F.collect_list(F.struct(F.col("page_index").alias("page"), F.col("image_path").alias("img"))).alias("pages"))
    feed = a.select(F.concat_ws("/", "series_id", "chapter_id").alias("chapter_id"), F.to_json(F.struct("pages")).alias("payload"))
    return feeds.read_pages(feed).select("series_id", "chapter_id", "page_index", "image_ref")


def teacher_run(spark: SparkSession, d: str) -> DataFrame:
    run = run_predictor(review.catalog(_a(spark, d)), "pagemill.operators.predictor:SizePredictor")
    return predictions_of(run).select("asset_id", "transcript", "teacher_agreement", "min_text_height")


def teacher_failures(spark: SparkSession, d: str) -> DataFrame:
    return failures_of(run_predictor(review.catalog(_a(spark, d)), "pagemill.operators.predictor:SizePredictor"))


def cycle_summary(spark: SparkSession, d: str) -> DataFrame:
    return label_cycle(_a(spark, d), "pagemill.operators.predictor:SizePredictor").summary()


QUERIES = {
    f.__name__: f
    for f in (
        catalog_scan, catalog_point, catalog_lookup_sha, catalog_lookup_ids, catalog_decode, catalog_upsert, asset_ids, content_dedup, repeated_ord, asset_filter, chapter_status, chapter_report, ingest_summary, stream_ingest,
        ls_task_points, ls_task_items, ls_task_json, ls_task_fields, gold_tasks, gold_task_fields, exception_tasks, exception_task_fields, image_keys, ls_export_regions, ls_image_url, words_to_lines, lang_infer, lenient_parse, box_decode, nms, crop_windows, project_polygons, magic_extension, png_size,
        store_paths, chapter_pages, teacher_run, teacher_failures, cycle_summary,
    )
}

_UPSERTED = f"WITH {CATALOG} SELECT asset_id, ord, sha256, is_duplicate FROM last"
_STATUS = """
    b AS (SELECT *, width IS NULL OR height IS NULL AS bad FROM page_assets),
    s AS (SELECT source_id, series_id, chapter_id, count(*) AS pages, count(*) FILTER (bad) AS page_errors, arg_min(asset_id, page_index::BIGINT * 100000000000 + ord) AS first_asset_id,
            CASE WHEN count(*) FILTER (bad) = 0 THEN 'ok' WHEN count(*) FILTER (bad) < count(*) THEN 'partial' ELSE 'failed' END AS status FROM b GROUP BY ALL)"""
_LINES = f"""
    {CATALOG},
    n AS (SELECT p.*, row_number() OVER (PARTITION BY asset_id ORDER BY ord) - 1 AS i FROM teacher_predictions p),
    j AS (SELECT n.*, coalesce(nullif(last.width, 0), 1) AS w, coalesce(nullif(last.height, 0), 1) AS h, last.width AS lw, last.height AS lh, last.image_path AS page_path, last.series_id AS page_series FROM n JOIN last USING (asset_id))"""
_PX = "round_even((polygon[1].x / w::DOUBLE) * 100, 4)"
_PY = "round_even((polygon[1].y / h::DOUBLE) * 100, 4)"
_BOXED = f"""
    {CATALOG},
    bx AS (SELECT ord, {box_sql("teacher_predictions")} FROM teacher_predictions),
    k AS (SELECT p.asset_id, p.ord, x1, y1, x2, y2, detection_confidence AS score, p.ord % 3 AS cls, last.width AS ow, last.height AS oh
          FROM teacher_predictions p JOIN bx USING (ord) JOIN last USING (asset_id) WHERE last.width IS NOT NULL AND last.height IS NOT NULL)"""
_SQ = "greatest(ow, oh)"
_DECODED = f"""
    {_BOXED},
    v AS (SELECT *, greatest(0e0, least(ow::DOUBLE, x1 * ({_SQ}::DOUBLE / 1280e0) - floor(({_SQ} - ow) / 2))) AS px1, greatest(0e0, least(oh::DOUBLE, y1 * ({_SQ}::DOUBLE / 1280e0) - floor(({_SQ} - oh) / 2))) AS py1,
            greatest(0e0, least(ow::DOUBLE, x2 * ({_SQ}::DOUBLE / 1280e0) - floor(({_SQ} - ow) / 2))) AS px2, greatest(0e0, least(oh::DOUBLE, y2 * ({_SQ}::DOUBLE / 1280e0) - floor(({_SQ} - oh) / 2))) AS py2
          FROM k WHERE score >= 0.15e0),
    decoded AS (SELECT * FROM v WHERE px2 - px1 > 0 AND py2 - py1 > 0 AND px2 - px1 >= 4e0 AND py2 - py1 >= 4e0)"""
_NW = "greatest(0e0, least(y.b2, x[1].b2) - greatest(y.a2, x[1].a2))"
_NH = "greatest(0e0, least(y.b3, x[1].b3) - greatest(y.a3, x[1].a3))"
_NA = "((y.b2 - y.a2) * (y.b3 - y.a3)) + ((x[1].b2 - x[1].a2) * (x[1].b3 - x[1].a3))"
_CROPS = f"""
    {_BOXED},
    r AS (SELECT *, greatest(0, round_even(x1, 0)::INT - 8) AS l, greatest(0, round_even(y1, 0)::INT - 8) AS t, least(ow, round_even(x2, 0)::INT + 8) AS rr, least(oh, round_even(y2, 0)::INT + 8) AS bb FROM k),
    crops AS (SELECT ord, CASE WHEN ok THEN l END AS left, CASE WHEN ok THEN t END AS top, CASE WHEN ok THEN rr END AS right, CASE WHEN ok THEN bb END AS bottom,
            CASE WHEN greatest(1e0, y2 - y1) / greatest(1e0, x2 - x1) >= 1.35e0 THEN 'vertical' ELSE 'horizontal' END AS direction
          FROM (SELECT *, ow > 0 AND oh > 0 AND rr - l >= 8 AND bb - t >= 8 AS ok FROM r))"""
_LANG = """CASE WHEN regexp_matches({c}, '[\\x{{3040}}-\\x{{30FF}}]') THEN 'ja' WHEN regexp_matches({c}, '[\\x{{AC00}}-\\x{{D7AF}}]') THEN 'ko'
    WHEN regexp_matches({c}, '[\\x{{4E00}}-\\x{{9FFF}}]') THEN 'ja' WHEN regexp_matches({c}, '[A-Za-z]') THEN 'latin' ELSE 'mixed' END"""


def _script(c: str) -> str:
    return f"CASE WHEN {strip_sql(c)} = '' THEN 0e0 WHEN ({_LANG.format(c=c)}) = 'mixed' THEN 0.85e0 ELSE 0.95e0 END"


SQL = {
    "catalog_scan": "SELECT source_id, series_id, chapter_id, page_index, asset_id, ord FROM page_assets",
    "catalog_point": "SELECT asset_id, ord, sha256 FROM page_assets WHERE asset_id = (SELECT min(asset_id) FROM page_assets)",
    "catalog_lookup_sha": "SELECT lower(sha256) AS sha256, asset_id, ord, is_duplicate FROM page_assets QUALIFY row_number() OVER (PARTITION BY lower(sha256) ORDER BY is_duplicate, asset_id, ord) = 1",
    "catalog_lookup_ids": "SELECT a.asset_id, a.ord, w.position FROM page_assets a JOIN (SELECT asset_id, min(ord) AS position FROM teacher_predictions GROUP BY asset_id) w USING (asset_id)",
    "catalog_decode": f"SELECT ord, nullif({strip_sql('canonical_asset_id')}, '') AS canonical_asset_id, metadata_json::JSON ->> 'page_no' AS page_no, metadata_json::JSON ->> 'chapter_no' AS chapter_no FROM page_assets",
    "catalog_upsert": _UPSERTED,
    "stream_ingest": f"""WITH u AS ({_UPSERTED}), f AS (SELECT lower(sha256) AS sha, ord AS f_ord, asset_id AS f_asset FROM page_assets QUALIFY row_number() OVER (PARTITION BY lower(sha256) ORDER BY ord) = 1)
        SELECT asset_id, ord, sha256, is_duplicate, f_ord AS canonical_ord, CASE WHEN f_ord < ord THEN f_asset END AS canonical, f_asset <> asset_id AS duplicate FROM u JOIN f ON lower(sha256) = sha""",
    "chapter_report": """SELECT chapter_id, count(width) AS pages, count(*) - count(width) AS page_errors, min(page_index) FILTER (width IS NOT NULL) AS first_page,
        CASE WHEN count(*) = count(width) THEN 'ok' WHEN count(width) > 0 THEN 'partial' ELSE 'failed' END AS status FROM page_assets GROUP BY chapter_id""",
    "repeated_ord": """WITH f AS (SELECT lower(sha256) AS sha, asset_id AS f_asset FROM page_assets QUALIFY row_number() OVER (PARTITION BY lower(sha256) ORDER BY ord // 2, asset_id) = 1)
        SELECT count(*) AS n, 0 AS without, count(*) FILTER (f_asset <> asset_id) AS duplicates FROM page_assets JOIN f ON lower(sha256) = sha""",
    "asset_ids": "SELECT ord, printf('%s:%s:%s:%04d', source_id, series_id, chapter_id, page_index) AS made_id FROM page_assets",
    "content_dedup": """WITH f AS (SELECT lower(sha256) AS sha, ord AS f_ord, asset_id AS f_asset, image_path AS f_path FROM page_assets QUALIFY row_number() OVER (PARTITION BY lower(sha256) ORDER BY ord) = 1)
        SELECT ord, f_ord AS canonical_ord, CASE WHEN f_ord < ord THEN f_asset END AS canonical, f_asset <> asset_id AS duplicate, f_path AS stored_path FROM page_assets JOIN f ON lower(sha256) = sha""",
    "asset_filter": "SELECT asset_id, ord, series_id FROM page_assets WHERE NOT is_duplicate AND source_id = 'inkferry'",
    "chapter_status": f"WITH {_STATUS} SELECT * FROM s",
    "ingest_summary": f"""WITH {_STATUS} SELECT count(*) FILTER (status = 'ok') AS succeeded_chapters, count(*) FILTER (status = 'partial') AS partial_chapters, count(*) FILTER (status = 'failed') AS failed_chapters,
        sum(pages - page_errors)::BIGINT AS ingested_pages, sum(page_errors)::BIGINT AS page_errors FROM s""",
    "ls_task_points": f"WITH {_LINES} SELECT asset_id, 'pred-' || i AS region, {_PX} AS px, {_PY} AS py, w AS original_width, h AS original_height FROM j",
    "ls_task_fields": f"WITH {_LINES} SELECT asset_id, series_id, domain, coalesce(4 * n, 0) AS items FROM last LEFT JOIN (SELECT asset_id, count(*) AS n FROM j GROUP BY asset_id) USING (asset_id)",
    "gold_task_fields": f"{gold_sql()} SELECT asset_id, split AS target_split, review_mode, preannotated_lines, gold_batch_rank FROM gold",
    "exception_task_fields": f"{routed_sql()} SELECT asset_id, route, accepted_predictions, rejected_predictions FROM routed WHERE route <> 'auto_accept'",
    "ls_task_items": f"WITH {_LINES} SELECT asset_id, from_name, count(*) AS items FROM (SELECT asset_id, unnest(['text_region', 'transcript', 'language', 'direction']) AS from_name FROM j) GROUP BY ALL",
    "ls_export_regions": f"""WITH {_LINES}, z AS (SELECT *, {strip_sql("transcript")} AS t FROM j)
        SELECT page_path AS image_path, page_series AS series_id, t AS transcript, coalesce(lang, 'mixed') AS lang, direction, text_type, {split_sql("page_series")} AS split, 'teacher' AS source, 0e0 AS confidence,
            floor((({_PX} / 100e0) * w) * 1000e0 + 0.5e0) / 1000e0 AS x, floor((({_PY} / 100e0) * h) * 1000e0 + 0.5e0) / 1000e0 AS y FROM z WHERE t <> ''""",
    "image_keys": "SELECT image_path FROM teacher_predictions UNION SELECT image_path FROM gold_lines",
    "ls_image_url": """SELECT ord, 'https://images.example/' || regexp_extract(image_path, '[^/]*$') AS url,
        '/data/local-files/?d=' || replace(url_encode(replace(image_path, '/raw/', '/raw & new/')), '%2F', '/') AS local FROM page_assets""",
    "words_to_lines": f"""WITH bx AS (SELECT ord, {box_sql("teacher_predictions")} FROM teacher_predictions),
        w AS (SELECT image_path AS page_key, p.ord AS line_num, recognition_confidence * 100 AS conf, floor(x1) AS l, floor(y1) AS t, floor(y2 - y1) AS h, unnest(string_split(transcript, ' ')) AS text,
                unnest(range(0, len(string_split(transcript, ' ')))) AS i FROM teacher_predictions p JOIN bx USING (ord)),
        k AS (SELECT *, {strip_sql("text")} AS s FROM w WHERE conf >= 35 AND h > 0),
        g AS (SELECT page_key, line_num::INT AS line_num, string_agg(s, ' ' ORDER BY i) AS transcript, greatest(0e0, least(1e0, round(avg(conf) / 100, 12))) AS confidence,
                min(l + i * 10) AS x1, min(t) AS y1, max(l + i * 10 + 8) AS x2, max(t + h) AS y2 FROM k WHERE s <> '' GROUP BY ALL)
        SELECT page_key, line_num, transcript, confidence, {_LANG.format(c="transcript")} AS lang, {_script("transcript")} AS script_confidence, y2 - y1 AS text_height, x1, y1, x2 FROM g WHERE confidence >= 0.45e0 AND y2 - y1 >= 8""",
    "lang_infer": f"SELECT ord, {_LANG.format(c='transcript')} AS found, {_script('transcript')} AS script FROM teacher_predictions",
    "lenient_parse": "SELECT ord, coalesce(try_cast(try_cast(string_split(asset_id, ':')[4] AS DOUBLE) AS INT), 0) AS page, coalesce(try_cast(try_cast(chapter_id AS DOUBLE) AS INT), -1) AS chapter FROM page_assets",
    "box_decode": f"WITH {_DECODED} SELECT asset_id, ord, CASE cls WHEN 0 THEN 'text' WHEN 1 THEN 'sfx' ELSE cls::VARCHAR END AS label, px1 AS x1_page, py1 AS y1_page, px2 AS x2_page, py2 AS y2_page FROM decoded",
    "nms": f"""WITH {_DECODED},
        l AS (SELECT asset_id, list([{{'o': ord, 's': score, 'a2': px1, 'a3': py1, 'b2': px2, 'b3': py2}}] ORDER BY score DESC, ord) AS a FROM decoded GROUP BY asset_id),
        z AS (SELECT asset_id, list_reduce(a, lambda acc, x: CASE WHEN len(list_filter(acc, lambda y: {_NW} * {_NH} / ({_NA} - {_NW} * {_NH}) >= 0.3e0)) > 0 THEN acc ELSE list_concat(acc, x) END) AS kept FROM l)
        SELECT asset_id, unnest(range(0, len(kept)))::INT AS rank, unnest(list_transform(kept, lambda q: q.o)) AS ord, unnest(list_transform(kept, lambda q: q.s)) AS score FROM z""",
    "crop_windows": f"WITH {_CROPS} SELECT * FROM crops",
    "project_polygons": f"""WITH {_CROPS}, q AS (SELECT p.ord, {strip_sql("transcript")} AS transcript, least(detection_confidence, recognition_confidence, script_confidence) AS teacher_agreement, min_text_height AS h,
            c.left::DOUBLE AS l, c.top::DOUBLE AS t, (c.bottom - c.top)::DOUBLE AS ch, p.ord % 2 = 1 AS rot FROM teacher_predictions p JOIN crops c USING (ord) WHERE c.left IS NOT NULL)
        SELECT ord, transcript, teacher_agreement, greatest(CASE WHEN rot THEN 4e0 ELSE 5e0 END, coalesce(h, 0e0)) AS min_text_height, l + CASE WHEN rot THEN 2e0 ELSE 1e0 END AS ax, t + CASE WHEN rot THEN ch - 1e0 ELSE 2e0 END AS ay,
            l + CASE WHEN rot THEN 7e0 ELSE 5e0 END AS bx, t + CASE WHEN rot THEN ch - 5e0 ELSE 7e0 END AS by FROM q WHERE transcript <> ''""",
    "magic_extension": "SELECT ord, lower(regexp_extract(image_path, '[^.]*$')) AS kind FROM page_assets WHERE width IS NOT NULL AND height IS NOT NULL",
    "png_size": "SELECT ord, width::BIGINT AS w, height::BIGINT AS h FROM page_assets WHERE width IS NOT NULL AND height IS NOT NULL AND lower(regexp_extract(image_path, '[^.]*$')) = 'png'",
    "store_paths": "SELECT ord, 'raw/' || substr(lower(sha256), 1, 2) || '/' || lower(sha256) || '.' || lower(regexp_extract(image_path, '[^.]*$')) AS path FROM page_assets",
    "chapter_pages": "SELECT series_id, series_id || '/' || chapter_id AS chapter_id, page_index, image_path AS image_ref FROM page_assets",
    "teacher_run": f"WITH {CATALOG} SELECT asset_id, 'page ' || page_index AS transcript, 0.9e0 AS teacher_agreement, height / 10e0 AS min_text_height FROM last WHERE width > 0 AND height > 0",
    "teacher_failures": f"WITH {CATALOG} SELECT asset_id, image_path, 'page without a size' AS error FROM last WHERE NOT (coalesce(width, 0) > 0 AND coalesce(height, 0) > 0)",
}
