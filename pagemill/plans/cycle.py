"""Flows over the operators: the label cycle, the dataset bundle, the training plan."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.hashing import SplitRule
from pagemill.operators import annotation, predictions, review
from pagemill.operators.predictor import failures_of, predictions_of, run_predictor
from pagemill.session import cut_lineage
from pagemill.sources.files import write_archive, write_jsonl, write_report

# The sections a training configuration must have.
SECTIONS = ("data", "teachers", "synthetic", "pseudo_label", "annotation", "detector", "router", "recognizers", "distillation", "quantization", "benchmarks")

# The stages of a training run, what each needs (``$`` marks a setting) and its product.
STAGES = (
    ("synthetic-pretrain", ("synthetic generator spec", "$teachers.detector.checkpoint"), "checkpoints/students/synthetic_pretrain.pt"),
    ("silver-gold-finetune", ("$data.dataset_manifest", "manifests/silver_manifest.jsonl"), "checkpoints/students/finetuned.pt"),
    ("teacher-distillation", ("checkpoints/students/finetuned.pt", "$teachers.recognizer_jp.checkpoint", "$teachers.recognizer_kr.checkpoint"), "checkpoints/students/distilled.pt"),
    ("prune-and-qat", ("checkpoints/students/distilled.pt",), "artifacts/mobile/student_bundle_int8.onnx"),
)


@dataclass
class Cycle:
    """All that one labelling cycle yields; nothing is computed twice, the lines are written once."""

    lines: DataFrame
    failures: DataFrame
    silver: DataFrame
    rejected: DataFrame
    routed: DataFrame
    tasks: DataFrame

    def summary(self) -> DataFrame:
        """One row: pages failed, lines, accepted, rejected, and the routing figures."""
        routes = review.route_summary(self.routed)
        names = routes.columns
        facts = [
            self.failures.agg(F.count("*").alias("n")).select(F.lit("failed_pages").alias("k"), F.col("n").cast("double").alias("v")),
            self.lines.agg(F.count("*").alias("n")).select(F.lit("predictions").alias("k"), F.col("n").cast("double").alias("v")),
            self.silver.agg(F.count("*").alias("n")).select(F.lit("silver").alias("k"), F.col("n").cast("double").alias("v")),
            self.rejected.agg(F.count("*").alias("n")).select(F.lit("rejected").alias("k"), F.col("n").cast("double").alias("v")),
            routes.select(F.inline(F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v")) for c in names]))),
        ]
        rows = facts[0]
        for f in facts[1:]:
            rows = rows.unionByName(f)
        return rows.groupBy().pivot("k", ["failed_pages", "predictions", "silver", "rejected", *names]).agg(F.first("v"))


def label_cycle(assets: DataFrame, predictor: str, config: dict[str, Any] | None = None, policy: review.AuditPolicy | None = None, rule: SplitRule | None = None, thresholds: predictions.Thresholds | None = None) -> Cycle:
    """Predict, filter, route, and build review tasks for the pages of a catalog."""
    run = cut_lineage(run_predictor(assets, predictor, config), "predictions")  # the model runs once
    lines = predictions_of(run).withColumn("ord", F.xxhash64("asset_id", "line"))
    decided = predictions.decide(lines, thresholds)
    routed = review.route_pages(assets, lines, policy, thresholds)
    work = routed.where("route in ('review', 'audit')")
    tasks = annotation.tasks(work, predictions.by_asset(lines), extra=("route", "review_score", "reasons", "accepted_predictions", "rejected_predictions", "preannotated_lines", "sample_score"))
    return Cycle(lines, failures_of(run), predictions.silver_manifest(lines, rule, thresholds), decided.where("not accepted"), routed, tasks)


def dataset_bundle(assets: DataFrame, cycle: Cycle, root: str, archive: str | None = None) -> dict[str, Any]:
    """Write the manifests of a cycle under a workspace folder, a summary, and a ZIP of it all."""
    base = Path(root)
    parts = {"page_assets": assets, "silver": cycle.silver, "rejected": cycle.rejected, "failures": cycle.failures, "routes": cycle.routed, "tasks": annotation.as_json(cycle.tasks)}
    for name, df in parts.items():
        write_jsonl(df, str(base / "manifests" / name))
    report = write_report(cycle.summary(), str(base / "summary.json"))
    if archive:
        write_archive(root, [str(base / "manifests"), str(base / "summary.json")], archive)
    return report


def load_config(path: str) -> dict[str, Any]:
    """A YAML or JSON training configuration; missing sections are an error that names them."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml

        payload = yaml.safe_load(text) or {}
    except ImportError:
        payload = json.loads(text)
    missing = sorted(set(SECTIONS) - set(payload))
    if missing:
        raise ValueError(f"missing sections: {missing}")
    return payload


def setting(config: dict[str, Any], name: str) -> str:
    """The value at a dotted path of the configuration for a name that begins with ``$``, else the name."""
    if not name.startswith("$"):
        return name
    value: Any = config
    for key in name[1:].split("."):
        value = value[key]
    return str(value)


def training_plan(spark: SparkSession, config: dict[str, Any]) -> DataFrame:
    """The stages of a training run as rows, in order, with what each needs and yields."""
    rows = [(k, name, [setting(config, n) for n in needs], [product]) for k, (name, needs, product) in enumerate(STAGES, 1)]
    return spark.createDataFrame(rows, "stage int, name string, inputs array<string>, outputs array<string>")
