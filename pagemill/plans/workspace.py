"""A workspace: one folder on any file system that Spark reaches, with a place for everything."""

from __future__ import annotations

from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Where things are in a workspace; those with a suffix are files, the others folders.
PLACES = {
    "store": "data/raw",
    "catalog": "data/catalog",
    "page_assets": "manifests/page_assets",
    "teacher_predictions": "manifests/teacher_predictions",
    "silver": "manifests/silver",
    "rejected": "manifests/rejected",
    "failures": "manifests/failures",
    "routes": "manifests/routes",
    "review_queue": "annotation/tasks/review_queue.json",
    "summary": "artifacts/summary.json",
    "archive": "artifacts/bundle.zip",
    "configs": "configs",
}


class Workspace:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def at(self, name: str) -> str:
        return f"{self.root}/{PLACES[name]}"

    def _path(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def create(self) -> Workspace:
        """Make the folders that files go into; tables make their own."""
        for name, place in PLACES.items():
            folder = self.at(name) if name in ("store", "configs") else self.at(name).rsplit("/", 1)[0]
            p, fs = self._path(folder)
            fs.mkdirs(p)
        return self

    def exists(self, name: str) -> bool:
        p, fs = self._path(self.at(name))
        return fs.exists(p)

    def summary(self) -> DataFrame:
        """(name, path, present, bytes) of every place."""
        rows: list[tuple[str, str, bool, int]] = []
        for name in PLACES:
            p, fs = self._path(self.at(name))
            there = fs.exists(p)
            rows.append((name, self.at(name), there, fs.getContentSummary(p).getLength() if there else 0))
        return self.spark.createDataFrame(rows, "name string, path string, present boolean, bytes long")


def input_path(path: str, roots: tuple[str, ...] = (), must_exist: bool = True) -> str:
    """A local input by its own path or, if that is relative and not there, under one of ``roots`` (the
    folder of this package last). What is nowhere is an error that names all places, or stays as it is."""
    places = [Path(path)]
    if not places[0].is_absolute():
        places += [Path(r, path) for r in (*roots, str(Path(__file__).resolve().parents[2]))]
    found = next((p for p in places if p.exists()), None)
    if found is None and must_exist:
        raise FileNotFoundError(f"{path} is in none of: {', '.join(str(p.absolute()) for p in places)}")
    return str(found or path)


def figures(chapters: list[dict[str, Any]]) -> dict[str, int]:
    """Counts of a list of chapter reports."""
    return {f"{status}_chapters": sum(c["status"] == status for c in chapters) for status in ("ok", "partial", "failed")} | {k: sum(c[k] for c in chapters) for k in ("pages", "page_errors")}
