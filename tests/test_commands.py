import json

import numpy as np
import pytest

from pagemill.__main__ import main
from pagemill.operators import detector
from tests.test_operators import pred
from tests.test_sources import JPG, PNG

from pagemill.sources import feeds


class Shelf(feeds.ChapterAdapter):
    def list_chapters(self, cursor=None):
        return [], None

    def chapter_pages(self, chapter_id):
        return [feeds.Page("src", "s", chapter_id, i, f"p{i}") for i in (1, 2, 3)]

    def download(self, page):
        if page.page_index == 3:
            raise TimeoutError("slow")
        return PNG if page.page_index == 1 or page.chapter_id == "d" else JPG


def test_commands_end_to_end(spark, tmp_path):
    cat, run = ["--catalog", str(tmp_path / "catalog")], lambda *a: main(list(a), spark)
    run("init", *cat)
    got = run("ingest", *cat, "--adapter", "tests.test_commands:Shelf", "--chapters", "c", "d", "--store", str(tmp_path / "store"))
    assert sorted((r["chapter_id"], r["status"], r["pages"]) for r in got["chapters"]) == [("c", "partial", 2), ("d", "partial", 2)]
    rows = spark.read.parquet(cat[1]).collect()
    assert len(rows) == 4 and sum(r["is_duplicate"] for r in rows) == 2 and len(list((tmp_path / "store").rglob("*.png"))) == 1
    assert len({r["ord"] for r in rows}) == 4 and all(r["canonical_asset_id"] for r in rows if r["is_duplicate"])
    run("ingest", *cat, "--adapter", "tests.test_commands:Shelf", "--chapters", "c", "--store", str(tmp_path / "store"))
    assert spark.read.parquet(cat[1]).count() == 4  # again: an upsert
    run("export", *cat, "--out", str(tmp_path / "assets"))
    assert run("teacher", *cat, "--predictor", "pagemill.operators.predictor:SizePredictor", "--out", str(tmp_path / "preds"))["failures"] == 0
    p = ["--predictions", str(tmp_path / "preds/part-*")]
    s = run("silver", *p, "--out", str(tmp_path / "silver"))
    assert s["input_predictions"] == s["accepted_silver"] + s["review_candidates"] > 0
    assert run("silver", *p, "--out", str(tmp_path / "silver2"), "--min-height", "0")["review_candidates"] == 0
    assert run("tasks", *cat, "--duplicates", "--out", str(tmp_path / "t.json"))["tasks"] == 4
    assert run("queue", *cat, *p, "--duplicates", "--out", str(tmp_path / "q.json"), "--pages", "2")["tasks"] == 2
    assert run("queue", *cat, *p, "--duplicates", "--out", str(tmp_path / "x.json"), "--strategy", "exception")["pages_considered"] == 4
    assert run("gold", *cat, *p, "--duplicates", "--out", str(tmp_path / "g.json"), "--pages", "3")["tasks"] == 3
    assert run("convert", "--export", str(tmp_path / "g.json"), "--out", str(tmp_path / "records"))
    assert spark.read.json(str(tmp_path / "records")).count() == 2  # two of the pages have a line
    c = run("cycle", *cat, "--predictor", "pagemill.operators.predictor:SizePredictor", "--out", str(tmp_path / "bundle"), "--archive", str(tmp_path / "b.zip"))
    assert c["pages_considered"] == 2 and (tmp_path / "b.zip").exists()
    line = pred(text="hello")
    (tmp_path / "gold.jsonl").write_text(json.dumps({k: line[k] for k in ("image_path", "series_id", "polygon", "transcript")}))
    (tmp_path / "one.json").write_text(json.dumps({"predictions": [{**line, "polygon": [[p["x"], p["y"]] for p in line["polygon"]], "ord": None}]}))
    assert run("score", "--gold", str(tmp_path / "gold.jsonl"), "--predictions", str(tmp_path / "one.json"))["overall"]["matched_cer"] == 0.0
    # equal lines stay lines of their own: two of gold, one predicted
    (tmp_path / "gold.jsonl").write_text("\n".join([json.dumps({k: line[k] for k in ("image_path", "series_id", "polygon", "transcript")})] * 2))
    twice = run("score", "--gold", str(tmp_path / "gold.jsonl"), "--predictions", str(tmp_path / "one.json"))["overall"]
    assert (twice["matched_lines"], twice["gold_lines"], twice["prediction_lines"], twice["detection_precision"], twice["detection_recall"]) == (1, 2, 1, 1.0, 0.5)


class Model:
    def get_inputs(self):
        return [type("I", (), {"name": "images"})()]

    def run(self, _, feed):
        assert feed["images"].shape == (1, 3, 100, 100) and feed["images"].max() <= 1.0
        return [np.array([[[10, 30, 60, 50, 0.9, 0], [11, 30, 61, 50, 0.8, 0], [0, 0, 1, 1, 0.9, 0], [70, 40, 80, 60, 0.1, 0]]])]


class Reader:
    def read(self, image):
        return f" {image.shape[1]}x{image.shape[0]} ", 0.7


def test_detector_predictor():
    page = np.zeros((100, 200, 3), np.uint8)
    p = detector.DetectorPredictor(size=100, padding=0, session=Model(), reader=Reader(), loader=lambda path: page)
    got = p.predict_page({"image_path": "x"})
    assert [(g["transcript"], g["polygon"][0], g["teacher_agreement"], g["direction"]) for g in got] == [("100x40", (20.0, 10.0), 0.7, "horizontal")]
    tensor, box = detector.letterbox(page + 255, 50)
    assert tensor.shape == (1, 3, 50, 50) and (box.left, box.top, box.square) == (0, 50, 200) and tensor[0, 0, 0, 0] == pytest.approx(127 / 255) and tensor[0, 0, 25, 25] == 1.0
    assert detector.output_rows(np.zeros((1, 4, 6))).shape == (4, 6)
    assert detector.output_rows(np.zeros((9, 5))).shape == (5, 9)  # fewer than six columns: turned
    with pytest.raises(ValueError):
        detector.output_rows(np.zeros(3))
    with pytest.raises(RuntimeError, match="no_such_module"):
        detector.require("no_such_module")
    assert len(detector.page_boxes(np.zeros((0, 6)), box, 50)) == 0


def test_bundle_from_a_feed(spark, tmp_path):
    w = str(tmp_path / "work")
    got = main(["bundle", "--workspace", w, "--adapter", "tests.test_commands:Shelf", "--chapters", "c", "d"], spark)
    assert (got["partial_chapters"], got["pages"], got["page_errors"]) == (2, 4, 2) and got["places"]["catalog"] > 0 and "review_queue" not in got["places"]
    got = main(["bundle", "--workspace", w, "--adapter", "tests.test_commands:Shelf", "--chapters", "c", "--predictor", "pagemill.operators.predictor:SizePredictor", "--archive"], spark)
    assert got["pages_considered"] == 2 and {"review_queue", "archive", "store"} <= set(got["places"])
    assert main(["ingest", "--catalog", w, "--adapter", "tests.test_commands:Shelf", "--store", w], spark) == {"chapters": []}  # an empty feed


def test_input_paths(tmp_path):
    from pagemill.plans.workspace import input_path

    (tmp_path / "c.json").write_text("{}")
    assert input_path("c.json", (str(tmp_path),)) == str(tmp_path / "c.json") and input_path("pagemill/schemas.py").endswith("pagemill/schemas.py")
    assert input_path("gone.json", must_exist=False) == "gone.json"
    with pytest.raises(FileNotFoundError, match="gone.json"):
        input_path("gone.json", (str(tmp_path),))


class Site(feeds.RequestAdapter):
    def ask_chapters(self, cursor):
        return feeds.Request("u/list", {"page": cursor})

    def read_chapters(self, answer):
        return answer["rows"], answer["next"]

    def ask_pages(self, chapter_id):
        return feeds.Request(f"u/{chapter_id}")

    def read_pages(self, chapter_id, answer):
        return [feeds.Page("s", "t", chapter_id, k, x) for k, x in enumerate(answer)]

    def ask_image(self, page):
        return feeds.Request(page.image_ref, None, {"Referer": "r"})


def test_template_of_an_adapter():
    asked = []

    def answer(url, headers, timeout):
        asked.append((url, headers))
        body = {"u/list?page=2": {"rows": [{"chapter_id": "a"}], "next": "3"}, "u/a": ["i1", "i2"]}.get(url)
        return feeds.Response(200, b"image" if body is None else json.dumps(body).encode())

    site = Site(feeds.HttpSession(transport=answer))
    assert site.list_chapters("2") == ([{"chapter_id": "a"}], "3") and [p.image_ref for p in site.chapter_pages("a")] == ["i1", "i2"]
    assert site.download(site.chapter_pages("a")[1]) == b"image" and asked[-1] == ("i2", {"Referer": "r"})
    with pytest.raises(TypeError):
        feeds.load_adapter("builtins:dict", {})


def test_tall_regions_are_turned():
    page = np.arange(200 * 100 * 3, dtype=np.uint8).reshape(200, 100, 3)
    tall = type("M", (Model,), {"run": lambda self, _, feed: [np.array([[[10, 10, 40, 90, 0.9, 0]]])]})()
    for turn, want in ((False, "30x160"), (True, "160x30")):
        p = detector.DetectorPredictor(size=100, padding=0, session=tall, reader=Reader(), loader=lambda path: page, rotate_tall=turn)
        assert [g["transcript"] for g in p.predict_page({"image_path": "x"})] == [want]
