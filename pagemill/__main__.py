"""Command line: ``python -m pagemill COMMAND``. Tables are parquet folders, documents JSON or JSONL."""

from __future__ import annotations

import argparse
import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.functions.hashing import SplitRule
from pagemill.operators import annotation, catalog, evaluate, predictions, review
from pagemill.operators.predictor import failures_of, predictions_of, run_predictor
from pagemill.plans.cycle import dataset_bundle, label_cycle, load_config, training_plan
from pagemill.plans.workspace import Workspace, figures, input_path
from pagemill.schemas import PAGE_ASSET
from pagemill.session import cut_lineage, get_session, release_cuts
from pagemill.sources import feeds, files, images


def _preds(spark: SparkSession, path: str) -> DataFrame:
    """Predictions in any of the JSON layouts, numbered by position."""
    return numbered(files.read_predictions(spark, path))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``ord``, unique and ascending within each file also where rows are equal; written
    once, so that it is the same whatever reads it."""
    return cut_lineage(rows.withColumn("ord", F.monotonically_increasing_id()), "numbered")


def _assets(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    all_ = spark.read.schema(PAGE_ASSET).parquet(a.catalog)
    return catalog.select_assets(all_, a.source, a.series, a.chapter, a.limit, a.duplicates)


def _policy(a: argparse.Namespace) -> review.AuditPolicy:
    return review.AuditPolicy(a.audit_rate, a.min_audit, a.max_audit, a.seed, not a.skip_empty)


def _thresholds(a: argparse.Namespace) -> predictions.Thresholds:
    return predictions.Thresholds().override(detection=a.min_detection, recognition=a.min_recognition, script=a.min_script, agreement=a.min_agreement, text_height=a.min_height)


def init(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    spark.createDataFrame([], PAGE_ASSET).write.mode("ignore").parquet(a.catalog)
    return {"catalog": a.catalog}


def ingest(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    """Chapters through an adapter into the catalog and the content-addressed store: the given ones,
    those of series, or those of the latest feed."""
    a.chapters = a.chapters or feeds.chosen_chapters(feeds.load_adapter(a.adapter, json.loads(a.kwargs)), a.series, a.pages, a.most)
    if not a.chapters:
        return {"chapters": []}
    spark.dataSource.register(feeds.ChapterSource)
    rows = spark.read.format("chapters").options(adapter=a.adapter, kwargs=a.kwargs, chapters=json.dumps(a.chapters), failfast=str(a.fail_fast)).load()
    rows = cut_lineage(rows, "pages")  # every page is fetched once
    found = images.fingerprint(rows.where("error is null"))
    images.store(found, a.store)
    place = images.store_path(F.col("sha256"), F.col("extension"))
    old = spark.read.schema(PAGE_ASSET).parquet(a.catalog)
    base = (old.agg(F.max("ord")).collect()[0][0] or 0) + 1
    # numbers go on over the chapters as they were asked for; within one by page
    sizes = {r["chapter_id"]: r["n"] for r in found.groupBy("chapter_id").agg(F.count("*").alias("n")).collect()}
    before, offsets = base, []
    for c in dict.fromkeys(a.chapters):
        offsets.append((c, before))
        before += sizes.get(c, 0)
    found = found.join(spark.createDataFrame(offsets, "chapter_id string, before long"), "chapter_id")
    number = F.col("before") + F.row_number().over(Window.partitionBy("chapter_id").orderBy("page_index", "sha256")) - 1
    new = found.select(
        catalog.asset_id(F.col("source_id"), F.col("series_id"), F.col("chapter_id"), F.col("page_index")).alias("asset_id"), "source_id", "series_id", "chapter_id", "page_index",
        F.concat(F.lit(a.store.rstrip("/") + "/"), place).alias("image_path"), "sha256", "phash", F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("fetched_at"), "domain", F.lit("{}").alias("metadata_json"), F.lit(None).cast("string").alias("canonical_asset_id"), F.lit(False).alias("is_duplicate"), number.cast("bigint").alias("ord"),
    )
    both = catalog.upsert(old, new)
    marks = catalog.content_dedup(both).select("ord", "asset_id", "canonical", "duplicate")
    out = cut_lineage(both.join(marks, ["ord", "asset_id"]).select(*[c for c in both.columns if c not in ("canonical_asset_id", "is_duplicate")], F.col("canonical").alias("canonical_asset_id"), F.col("duplicate").alias("is_duplicate")).select(*both.columns), "catalog")
    out.write.mode("overwrite").parquet(a.catalog)
    return {"chapters": [r.asDict() for r in feeds.chapter_report(rows).collect()]}


def bundle(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    """A workspace from a feed: its chapters into the catalog, one label cycle (unless there is no
    predictor), manifests, review queue, summary and archive."""
    w = Workspace(spark, a.workspace).create()
    a.catalog, a.store = w.at("catalog"), w.at("store")
    if not w.exists("catalog"):
        init(spark, a)
    chapters = ingest(spark, a)["chapters"]
    out: dict[str, Any] = {"chapters": chapters, **figures(chapters)}
    assets = catalog.select_assets(spark.read.schema(PAGE_ASSET).parquet(a.catalog))
    if a.predictor:
        c = label_cycle(assets, a.predictor, json.loads(a.predictor_kwargs), _policy(a), None, _thresholds(a))
        out["review_tasks"] = files.write_tasks(annotation.as_json(c.tasks), w.at("review_queue"))
        out |= dataset_bundle(assets, c, a.workspace, w.at("archive") if a.archive else None)
    else:
        files.write_jsonl(assets, w.at("page_assets"))
    return out | {"places": {r["name"]: r["bytes"] for r in w.summary().collect() if r["present"]}}


def export(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    files.write_jsonl(catalog.scan(_assets(spark, a)), a.out)
    return {"out": a.out}


def tasks(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    lines = predictions.by_asset(_preds(spark, a.predictions)) if a.predictions else spark.createDataFrame([], "asset_id string, lines array<struct<polygon:array<struct<x:double,y:double>>,text_type:string,transcript:string,lang:string,direction:string>>")
    t = annotation.tasks(_assets(spark, a), lines, base_url=a.base_url, document_root=a.local_files)
    return {"tasks": files.write_tasks(annotation.as_json(t), a.out)}


def convert(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    files.write_jsonl(annotation.records(files.read_export(spark, a.export)).drop("task_ord", "item_ord", "region_ord"), a.out)
    return {"out": a.out}


def gold(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    p = _preds(spark, a.predictions)
    assets = _assets(spark, a)
    batch = review.gold_batch(assets, p, a.pages, SplitRule(), _thresholds(a))
    pages = batch.join(review.catalog(assets).select("asset_id", "width", "height"), "asset_id").withColumnRenamed("split", "target_split")
    t = annotation.tasks(pages, predictions.by_asset(p), ("target_split", "review_mode", "review_priority", "priority_reasons", "preannotated_lines", "gold_batch_rank"))
    n = files.write_tasks(annotation.as_json(t.orderBy("data.gold_batch_rank")), a.out)
    return {"tasks": n, "summary": [r.asDict() for r in review.gold_summary(batch).collect()]}


def teacher(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    run = cut_lineage(run_predictor(_assets(spark, a), a.predictor, json.loads(a.kwargs), a.fail_fast), "run")
    files.write_jsonl(predictions_of(run).drop("line"), a.out)
    return {"out": a.out, "failures": failures_of(run).count()}


def cycle(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    assets = _assets(spark, a)
    return dataset_bundle(assets, label_cycle(assets, a.predictor, json.loads(a.kwargs), _policy(a), None, _thresholds(a)), a.out, a.archive)


def silver(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    p, t = _preds(spark, a.predictions), _thresholds(a)
    files.write_jsonl(predictions.silver_manifest(p, None, t).drop("ord"), a.out)
    return predictions.summary(p, t).collect()[0].asDict() | {"reasons": {r["reason"]: r["lines"] for r in predictions.reason_counts(p, t).collect()}}


def queue(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    p, assets, t = _preds(spark, a.predictions), _assets(spark, a), _thresholds(a)
    if a.strategy == "topk":
        pages = predictions.review_pages(p, assets, a.pages, t)[0].select("asset_id", "rank").join(review.catalog(assets), "asset_id")
        out = annotation.tasks(pages, predictions.by_asset(p), ("rank",)).orderBy("data.rank")
        return {"tasks": files.write_tasks(annotation.as_json(out), a.out)}
    routed = review.route_pages(assets, p, _policy(a), t)
    out = annotation.tasks(review.review_tasks(routed), predictions.by_asset(p), ("route", "review_score", "reasons", "accepted_predictions", "rejected_predictions", "preannotated_lines", "sample_score"))
    return {"tasks": files.write_tasks(annotation.as_json(out), a.out)} | review.route_summary(routed).collect()[0].asDict()


def score(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    g = numbered(files.read_gold(spark, a.gold))
    p = _preds(spark, a.predictions)
    report = evaluate.overall(g, p, a.iou).collect()[0].asDict()
    return {"overall": report, "slices": [r.asDict() for r in evaluate.slices(g, p, a.iou).collect()]}


def plan(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    c = load_config(input_path(a.config))
    return {"stages": [r.asDict() for r in training_plan(spark, c).collect()], "benchmarks": c["benchmarks"]}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pagemill", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def command(f, *groups: str, **options: dict[str, Any]):
        p = sub.add_parser(f.__name__, help=f.__doc__)
        p.set_defaults(run=f)
        if "catalog" in groups:
            p.add_argument("--catalog", required=True)
        if "assets" in groups:
            p.add_argument("--catalog", required=True)
            for n in ("source", "series", "chapter"):
                p.add_argument(f"--{n}")
            p.add_argument("--limit", type=int)
            p.add_argument("--duplicates", action="store_true")
        if "thresholds" in groups:
            for n in ("detection", "recognition", "script", "agreement", "height"):
                p.add_argument(f"--min-{n}", type=float)
        if "audit" in groups:
            p.add_argument("--audit-rate", type=float, default=0.02)
            p.add_argument("--min-audit", type=int, default=10)
            p.add_argument("--max-audit", type=int)
            p.add_argument("--seed", default="page-audit-v1")
            p.add_argument("--skip-empty", action="store_true")
        for n, kw in options.items():
            p.add_argument("--" + n.replace("_", "-"), **kw)

    need, flag, kwargs = {"required": True}, {"action": "store_true"}, {"default": "{}"}
    command(init, "catalog")
    command(ingest, "catalog", adapter=need, kwargs=kwargs, chapters={"nargs": "+"}, series={"nargs": "+"}, pages={"type": int, "default": 1, "help": "pages of the latest feed"}, most={"type": int, "help": "chapters at most"}, store=need, fail_fast=flag)
    command(bundle, "thresholds", "audit", workspace=need, adapter=need, kwargs=kwargs, chapters={"nargs": "+"}, series={"nargs": "+"}, pages={"type": int, "default": 1}, most={"type": int}, fail_fast=flag, predictor={}, predictor_kwargs=kwargs, archive=flag)
    command(export, "assets", out=need)
    command(tasks, "assets", out=need, predictions={}, base_url={}, local_files=flag)
    command(convert, export=need, out=need)
    command(gold, "assets", "thresholds", predictions=need, out=need, pages={"type": int, "default": 2500})
    command(teacher, "assets", predictor=need, kwargs=kwargs, out=need, fail_fast=flag)
    command(cycle, "assets", "thresholds", "audit", predictor=need, kwargs=kwargs, out=need, archive={})
    command(silver, "thresholds", predictions=need, out=need)
    command(queue, "assets", "thresholds", "audit", predictions=need, out=need, strategy={"choices": ["topk", "exception"], "default": "topk"}, pages={"type": int, "default": 100})
    command(score, gold=need, predictions=need, iou={"type": float, "default": 0.5})
    command(plan, config=need)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, Any]:
    a = parser().parse_args(argv)
    session = spark or get_session()
    try:
        out = a.run(session, a)
    finally:
        release_cuts(session)
    print(json.dumps(out, ensure_ascii=False, indent=2, default=str))
    return out


if __name__ == "__main__":
    main()
