"""Running a page predictor over the catalog, with failures kept apart per page."""

from __future__ import annotations

import json
import re
import subprocess
from collections.abc import Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.schemas import PREDICTION
from pagemill.sources.feeds import load_class

_FIELDS = [c.strip().split(" ", 1)[0] for c in PREDICTION.replace("array<struct<x:double,y:double>>", "p").split(",")]


class Predictor(Protocol):
    """One page in, any number of lines out: dictionaries with some of the prediction's fields."""

    def predict_page(self, asset: dict[str, Any]) -> list[dict[str, Any]]: ...


def load_predictor(path: str, config: dict[str, Any] | None = None) -> Predictor:
    p = load_class(path)(**(config or {}))
    if not callable(getattr(p, "predict_page", None)):
        raise TypeError(f"{path} has no predict_page")
    return p


def _line(raw: dict[str, Any], asset: dict[str, Any]) -> dict[str, Any]:
    """A raw line with what it leaves out taken from its page."""
    base = {"asset_id": asset["asset_id"], "series_id": asset["series_id"], "image_path": asset["image_path"], "lang": "mixed", "direction": "horizontal", "text_type": "unknown"}
    out = {**base, **raw, "domain": asset["domain"]}
    text = str(out.get("transcript") or "").strip()
    if not text or not out.get("polygon"):
        raise ValueError("a line needs a transcript and a polygon")
    fallback = float(out.get("confidence", 0.0))
    for c in ("detection_confidence", "recognition_confidence", "script_confidence", "teacher_agreement"):
        out[c] = float(out.get(c, fallback))
    points = [(q["x"], q["y"]) if isinstance(q, dict) else (q[0], q[1]) for q in out["polygon"]]
    out |= {"transcript": text, "polygon": [{"x": float(x), "y": float(y)} for x, y in points]}
    return {k: out.get(k) for k in _FIELDS}


def run_predictor(assets: DataFrame, path: str, config: dict[str, Any] | None = None, fail_fast: bool = False) -> DataFrame:
    """(asset_id, image_path, lines, error): one row per page, ``lines`` or ``error`` being null.

    The predictor is built once per task. One bad line fails its page and no other, unless
    ``fail_fast`` lets the error through."""
    columns = ("asset_id", "series_id", "chapter_id", "page_index", "image_path", "domain", "width", "height")
    schema = "asset_id string, image_path string, lines array<struct<" + PREDICTION.replace(", ", ",").replace(" ", ":") + ">>, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = load_predictor(path, config)
        for pdf in batches:
            rows = []
            for a in pdf.astype(object).where(pdf.notna(), None).to_dict("records"):
                try:
                    rows.append((a["asset_id"], a["image_path"], [_line(dict(x), a) for x in p.predict_page(a)], None))
                except Exception as e:
                    if fail_fast:
                        raise
                    rows.append((a["asset_id"], a["image_path"], None, str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["asset_id", "image_path", "lines", "error"])

    return assets.select(*columns).mapInPandas(run, schema)


def predictions_of(run: DataFrame) -> DataFrame:
    """The lines of the pages that worked, numbered per page."""
    return run.where("error is null").select(F.posexplode("lines").alias("line", "l")).select("line", "l.*")


def failures_of(run: DataFrame) -> DataFrame:
    return run.where("error is not null").select("asset_id", "image_path", "error")


_SCRIPTS = {"ja": re.compile("[\u3040-\u30ff]"), "ko": re.compile("[\uac00-\ud7af]"), "han": re.compile("[\u4e00-\u9fff]"), "latin": re.compile("[A-Za-z]")}


def language_of(text: str) -> str:
    """ja, ko, latin or mixed, as ``infer_lang`` has it for columns: the first script that occurs."""
    first = next((name for name, letters in _SCRIPTS.items() if letters.search(text)), "mixed")
    return "ja" if first == "han" else first


class CommandPredictor:
    """A predictor around a program that prints word boxes as tab-separated text for an image."""

    def __init__(self, executable: str = "tesseract", languages: str = "jpn+kor+eng", psm: int = 11, oem: int = 1, timeout: float = 120.0, extra: tuple[str, ...] = (), min_word: float = 35.0, min_line: float = 0.45, min_height: float = 8.0, min_length: int = 1, default_lang: str = "mixed"):
        self.command = lambda image: [executable, image, "stdout", "-l", languages, "--oem", str(oem), "--psm", str(psm), *extra, "tsv"]
        self.timeout, self.min_word, self.min_line, self.min_height, self.min_length = timeout, min_word, min_line, min_height, min_length
        self.default_lang = default_lang

    def predict_page(self, asset: dict[str, Any]) -> list[dict[str, Any]]:
        r = subprocess.run(self.command(asset["image_path"]), capture_output=True, text=True, encoding="utf-8", errors="replace", timeout=self.timeout, check=False)
        if r.returncode:
            said = [x.strip() for x in (r.stderr, r.stdout) if x and x.strip()]
            raise RuntimeError(said[0] if said else f"{self.command(asset['image_path'])[0]} ended with code {r.returncode}")
        return self.lines(r.stdout)

    def lines(self, table: str) -> list[dict[str, Any]]:
        import io

        words = pd.read_csv(io.StringIO(table), sep="\t", dtype=str, keep_default_na=False) if table.strip() else pd.DataFrame(columns=["text"])
        if not len(words):
            return []
        n = lambda c: pd.to_numeric(words[c].str.strip(), errors="coerce")
        words = words.assign(conf=n("conf").fillna(-1.0), text=words["text"].str.strip(), **{c: n(c).fillna(0).astype(int) for c in ("left", "top", "width", "height", "page_num", "block_num", "par_num", "line_num")})
        words = words[(words.conf >= self.min_word) & (words.width > 0) & (words.height > 0) & (words.text != "")]
        out = []
        for _, g in words.groupby(["page_num", "block_num", "par_num", "line_num"], sort=False):
            x1, y1, x2, y2 = g.left.min(), g.top.min(), (g.left + g.width).max(), (g.top + g.height).max()
            conf = min(1.0, max(0.0, g.conf.mean() / 100.0))
            text = " ".join(g.text)
            if conf >= self.min_line and y2 - y1 >= self.min_height and len(text) >= self.min_length:
                lang = self.default_lang if self.default_lang != "mixed" else language_of(text)
                out.append({"transcript": text, "lang": lang, "script_confidence": 0.85 if lang == "mixed" else 0.95, "polygon": [(x1, y1), (x2, y1), (x2, y2), (x1, y2)], "confidence": conf, "min_text_height": float(y2 - y1), "text_type": "dialogue"})
        return out


class SizePredictor:
    """A stand-in model for tests and demonstrations: one line across each page of known size."""

    def __init__(self, text: str = "page"):
        self.text = text

    def predict_page(self, asset: dict[str, Any]) -> list[dict[str, Any]]:
        if not asset["width"] or not asset["height"]:
            raise ValueError("page without a size")
        w, h = float(asset["width"]), float(asset["height"])
        return [{"transcript": f"{self.text} {int(asset['page_index'])}", "polygon": [(0, 0), (w, 0), (w, h / 10), (0, h / 10)], "confidence": 0.9, "min_text_height": h / 10}]


def config_of(text: str | None) -> dict[str, Any]:
    return json.loads(text) if text else {}
