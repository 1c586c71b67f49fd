"""Small literal cases: the behaviour that the operators promise."""

import pytest
from pyspark.sql import functions as F

from pagemill.operators import annotation, catalog, detection, evaluate, lines, predictions, review
from pagemill.operators.predictor import CommandPredictor, failures_of, predictions_of, run_predictor
from pagemill.plans.cycle import label_cycle, load_config, training_plan
from pagemill.schemas import EXPORT, PAGE_ASSET, PREDICTION

BOX = lambda x1, y1, x2, y2: [(x1, y1), (x2, y1), (x2, y2), (x1, y2)]


def boxes(*c):
    return [{"x": float(x), "y": float(y)} for x, y in BOX(*c)]


def pred(asset="a", text="good", ord_=1, conf=(0.95, 0.94, 0.93, 0.92), **kw):
    row = {"asset_id": asset, "series_id": "s", "image_path": f"{asset}.png", "domain": "manga", "polygon": boxes(0, 0, 10, 10), "transcript": text, "lang": "latin", "direction": "horizontal", "text_type": "dialogue",
           "detection_confidence": conf[0], "recognition_confidence": conf[1], "script_confidence": conf[2], "teacher_agreement": conf[3], "min_text_height": 20.0, "ord": ord_}
    return {**row, **kw}


def preds(spark, *rows):
    return spark.createDataFrame(list(rows), PREDICTION + ", ord bigint")


def asset(id_, page=1, ord_=1, **kw):
    row = {"asset_id": id_, "source_id": "src", "series_id": "s", "chapter_id": "c", "page_index": page, "image_path": f"{id_}.png", "sha256": f"sha-{id_}", "phash": "0123456789abcdef", "width": 100, "height": 200,
           "fetched_at": "2024-01-01T00:00:00Z", "domain": "manga", "metadata_json": "{}", "canonical_asset_id": None, "is_duplicate": False, "ord": ord_}
    return {**row, **kw}


def assets(spark, *rows):
    return spark.createDataFrame(list(rows), PAGE_ASSET)


def test_thresholds_are_strict_and_null_height_passes(spark):
    edge = (0.85, 0.82, 0.80, 0.75)
    d = predictions.decide(preds(spark, pred(conf=edge, min_text_height=12.0), pred(conf=edge, min_text_height=None, ord_=2), pred(conf=(0.4, 0.45, 0.42, 0.30), min_text_height=6.0, ord_=3))).orderBy("ord").collect()
    assert [r["accepted"] for r in d] == [True, True, False]
    assert d[2]["reasons"] == ["low_detection_confidence", "low_recognition_confidence", "low_script_confidence", "teacher_disagreement", "small_text"]


def test_review_score_adds_up(spark):
    r = predictions.decide(preds(spark, pred(conf=(1.0, 1.0, 1.0, 1.0), domain="webtoon", direction="vertical", text_type="sfx", min_text_height=1.0))).collect()[0]
    assert r["review_score"] == 1.0 - 1.0 + 0.25 + 0.20 + 0.30 + 0.20 + 0.15 * 1


def test_silver_manifest(spark):
    p = preds(spark, pred(), pred(text="bad", ord_=2, conf=(0.40, 0.94, 0.93, 0.92)))
    from pagemill.functions.hashing import SplitRule

    s = predictions.silver_manifest(p, SplitRule(1.0, 0.0, 0.0)).collect()
    assert [(r["transcript"], r["split"], r["tile_id"], r["source"]) for r in s] == [("good", "train", None, "teacher")]
    assert [r["reasons"] for r in predictions.rejected(p).collect()] == [["low_detection_confidence"]]
    assert predictions.summary(p).collect()[0].asDict() == {"input_predictions": 2, "accepted_silver": 1, "review_candidates": 1}


def test_queue_limits(spark):
    p = preds(spark, *[pred(ord_=i, text=str(i)) for i in range(1, 6)])
    assert [r["ord"] for r in predictions.review_queue(p, 3).collect()] == [1, 2, 3]  # ties in input order
    assert predictions.review_queue(p, 0).count() == 0
    assert predictions.review_queue(p, -2).count() == 3
    pages, decisions = predictions.review_pages(p, assets(spark, asset("a")), 0)
    assert pages.count() == 1 and decisions.count() == 5
    assert predictions.review_pages(p, assets(spark, asset("z")), 5)[0].count() == 0


def test_records_are_normalized_or_quarantined(spark):
    raw = spark.createDataFrame(
        [("a", " text ", boxes(0, 0, 1, 1), 0.9, "webtoon", None), ("a", "  ", boxes(0, 0, 1, 1), 0.9, None, None), ("a", "t", [], 0.9, None, None), ("z", "t", boxes(0, 0, 1, 1), None, None, 0.5), (None, "t", boxes(0, 0, 1, 1), None, None, None)],
        "asset_id string, transcript string, polygon array<struct<x:double,y:double>>, confidence double, domain string, teacher_agreement double",
    )
    good, bad = predictions.normalize_predictions(raw, assets(spark, asset("a"), asset("a", ord_=2)))
    assert [(r["transcript"], r["domain"], r["series_id"], r["image_path"], r["teacher_agreement"], r["lang"]) for r in good.collect()] == [("text", "manga", "s", "a.png", 0.9, "mixed")]
    assert sorted(r["problem"] for r in bad.collect()) == ["no asset_id", "no polygon", "no series_id", "no transcript"]


def test_routing(spark):
    a = assets(spark, *[asset(x, i) for i, x in enumerate("abcd")])
    p = preds(spark, pred("a"), pred("b", ord_=2), pred("c", ord_=3, conf=(0.4, 0.45, 0.42, 0.30), min_text_height=6.0))
    routed = review.route_pages(a, p, review.AuditPolicy(0.5, 1, None, "fixed-seed"))
    assert sorted(r["route"] for r in routed.collect()) == ["audit", "auto_accept", "review", "review"]
    s = review.route_summary(routed).collect()[0]
    assert (s["pages_considered"], s["review_pages"], s["audit_pages"], s["effective_audit_rate"]) == (4, 2, 1, 0.5)
    assert {r["reason"]: r["pages"] for r in review.route_reasons(routed).collect()}["no_teacher_predictions"] == 1
    assert [r["asset_id"] for r in review.review_tasks(routed).collect()][:2] == ["d", "c"]
    assert review.route_pages(a, p, review.AuditPolicy(0.5, 1, 0, "x", review_empty=False)).count() == 3
    with pytest.raises(ValueError):
        review.AuditPolicy(1.5)


def test_audit_size():
    p = review.AuditPolicy(0.02, 10)
    assert [p.pages(n) for n in (0, 4, 10, 100, 1000)] == [0, 4, 10, 10, 20]
    assert review.AuditPolicy(0.5, 0, 3).pages(100) == 3


def test_quotas():
    from pagemill.functions.hashing import SplitRule

    r = SplitRule()
    assert review.quotas(10, {"train": 50, "val": 50, "test": 50}, r) == {"train": 8, "val": 1, "test": 1}
    assert review.quotas(3, {"train": 1, "val": 1, "test": 1}, r) == {"train": 1, "val": 1, "test": 1}
    assert review.quotas(2, {"train": 5, "val": 5, "test": 5}, r) == {"train": 2, "val": 0, "test": 0}
    assert review.quotas(4, {"train": 0, "val": 9, "test": 9}, r) == {"train": 0, "val": 1, "test": 1}
    assert sum(review.ideal_counts(7, SplitRule(0.34, 0.33, 0.33)).values()) == 7
    for limit in range(0, 40):
        for have in ({"train": 3, "val": 100, "test": 1}, {"train": 100, "val": 0, "test": 100}, {}):
            got = review.quotas(limit, have, SplitRule(0.2, 0.5, 0.3))
            held = [s for s in got if have.get(s)]
            assert sum(got.values()) <= limit and all(got[s] <= have.get(s, 0) for s in got) and (limit < len(held) or all(got[s] for s in held))


def test_numbers_of_equal_lines_and_rows_of_one_ord(spark):
    df = spark.createDataFrame([("a", 5, "X", "p1"), ("b", 5, "x", "p2"), ("c", 5, None, "p3"), ("a", 6, "x", "p4")], "asset_id string, ord long, sha256 string, image_path string").selectExpr("*", "null as phash", "null as width", "null as height")
    got = sorted((r["asset_id"], r["ord"], r["canonical"], r["duplicate"]) for r in catalog.content_dedup(df).collect())
    assert got == [("a", 5, None, False), ("a", 6, "a", False), ("b", 5, "a", True), ("c", 5, None, False)]


def test_gold_batch_fills_up(spark):
    a = assets(spark, *[asset(f"p{i}", i, series_id=f"s{i % 3}") for i in range(9)])
    p = preds(spark, pred("p4", conf=(0.1, 0.1, 0.1, 0.1)))
    b = review.gold_batch(a, p, 5).orderBy("gold_batch_rank").collect()
    assert len(b) == 5 and b[0]["asset_id"] == "p4" and [r["gold_batch_rank"] for r in b] == [1, 2, 3, 4, 5]
    assert review.gold_batch(a, p, 0).count() == 0
    assert review.gold_batch(a.limit(0), p, 5).count() == 0


GOLD = "image_path string, series_id string, domain string, polygon array<struct<x:double,y:double>>, transcript string, lang string, direction string, text_type string, split string, ord bigint"


def gold(spark, *rows):
    return spark.createDataFrame([(r[0], "s", r[3], boxes(*r[1]), r[2], "latin", r[4], "dialogue", r[5], i) for i, r in enumerate(rows)], GOLD)


def test_evaluation(spark):
    g = gold(spark, ("img-1", (0, 0, 10, 10), "hello world", "manga", "horizontal", "train"), ("img-2", (0, 0, 12, 12), "bonjour", "webtoon", "vertical", "test"))
    p = preds(spark, pred(image_path="img-1", text="hello worlt"), pred(image_path="img-1", text="ghost", polygon=boxes(50, 50, 60, 60), ord_=2))
    o = evaluate.overall(g, p).collect()[0]
    assert (o["matched_lines"], o["unmatched_gold_lines"], o["unmatched_prediction_lines"], o["detection_recall"], o["detection_precision"]) == (1, 1, 1, 0.5, 0.5)
    assert (o["matched_cer"], o["end_to_end_cer"]) == (1 / 11, 8 / 18)
    s = {(r["slice"], r["value"]): r["end_to_end_cer"] for r in evaluate.slices(g, p).collect()}
    assert s["domain", "webtoon"] == 1.0
    assert evaluate.unmatched_gold(g, p).count() == 1 and evaluate.unmatched_predictions(g, p).count() == 1
    assert evaluate.overall(g.limit(0), p.limit(0)).collect()[0]["matched_cer"] == 0.0


def test_matching_in_rounds_equals_the_fold(spark):
    import random

    rng = random.Random(4)
    spot = lambda: (lambda x, y: (x, y, x + 40, y + 40))(rng.randint(0, 60), rng.randint(240, 300))
    g = gold(spark, *[(f"i{k % 3}", spot(), "t", "manga", "horizontal", "train") for k in range(60)])
    p = preds(spark, *[pred(image_path=f"i{k % 3}", polygon=boxes(*spot()), ord_=k) for k in range(60)])
    rows = lambda df: sorted(tuple(r) for r in df.select("image_path", "gold_ord", "pred_ord", "iou").collect())
    fold = rows(evaluate.matches(g, p, 0.3))
    assert fold == rows(evaluate.matches(g, p, 0.3, fold_pairs=0))
    # against a plain greedy loop
    pairs = sorted(((-r["iou"], r["image_path"], r["gold_ord"], r["pred_ord"]) for r in evaluate.candidates(g, p, 0.3).collect()), key=lambda x: (x[0], x[2], x[3]))
    used, want = set(), []
    for n, i, a, b in pairs:
        if ("g", a) not in used and ("p", b) not in used:
            used |= {("g", a), ("p", b)}
            want.append((i, a, b, -n))
    assert fold == sorted(want)
    assert len(pairs) == len({x[2:] for x in pairs})  # the grid gives each pair once


def test_threshold_zero_matches_disjoint_lines(spark):
    g = gold(spark, ("i", (0, 0, 1, 1), "t", "manga", "horizontal", "train"))
    p = preds(spark, pred(image_path="i", polygon=boxes(900, 900, 901, 901)))
    assert evaluate.matches(g, p, 0.0).count() == 1 and evaluate.matches(g, p, 0.1).count() == 0


def test_catalog(spark):
    a = assets(spark, asset("b", 2, 1, sha256="X"), asset("a", 1, 2, sha256="x"), asset("b", 2, 3, sha256="x", width=7), asset(None, 9, 4, sha256=None))
    d = {r["ord"]: r for r in catalog.content_dedup(a).collect()}
    assert (d[2]["canonical"], d[2]["duplicate"]) == ("b", True)
    assert (d[3]["canonical"], d[3]["duplicate"]) == ("b", False)  # a redelivery is no duplicate
    assert (d[1]["canonical"], d[4]["canonical"], d[4]["duplicate"]) == (None, None, False)
    up = catalog.upsert(a.where("ord < 3"), a.where("ord >= 3"))
    assert sorted((r["asset_id"] or "", r["ord"]) for r in up.collect()) == [("", 4), ("a", 2), ("b", 3)]
    ids = spark.createDataFrame([("b", 1), (" ", 2), ("a", 3), ("b", 4), (None, 5)], "asset_id string, ord bigint")
    assert [r["ord"] for r in catalog.find_many(a, ids).collect()] == [1, 3, 2]
    assert catalog.select_assets(a, limit=0).count() == 1
    assert catalog.select_assets(a, series_id="none").count() == 0
    assert catalog.first_by_sha(a).collect()[0]["asset_id"] == "a"
    big = spark.range(1).select(catalog.asset_id(F.lit("s"), F.lit("r"), F.lit("c"), F.lit(123456)).alias("i")).collect()[0]["i"]
    assert big == "s:r:c:123456"


def test_chapters(spark):
    a = assets(spark, asset("a", 2, 1), asset("b", 1, 2, height=None), asset("c", 1, 3, chapter_id="d", width=None), asset("e", 1, 4, chapter_id="f"))
    c = {r["chapter_id"]: r for r in catalog.chapter_status(a).collect()}
    assert [(c[k]["status"], c[k]["first_asset_id"]) for k in "cdf"] == [("partial", "b"), ("failed", "c"), ("ok", "e")]
    s = catalog.ingest_summary(catalog.chapter_status(a)).collect()[0]
    assert tuple(s) == (1, 1, 1, 2, 2)


def test_tasks_and_their_way_back(spark):
    a = review.catalog(assets(spark, asset("a"), asset("b", 2)))
    p = preds(spark, pred("a", "Bonjour", polygon=boxes(10, 40, 20, 60), text_type="caption"))
    t = {r["asset_id"]: r for r in annotation.tasks(a, predictions.by_asset(p)).collect()}
    result = t["a"]["predictions"][0]["result"]
    assert len(result) == 4 and result[0]["id"] == "pred-0" and result[0]["value"]["points"][0] == [10.0, 20.0]
    assert t["b"]["predictions"] is None
    js = {r["asset_id"]: r["task"] for r in annotation.as_json(annotation.tasks(a, predictions.by_asset(p))).collect()}
    assert "predictions" not in js["b"] and '"pred-0-text"' in js["a"]


def test_export_records(spark):
    item = lambda id_, parent, name, kind, **v: (id_, parent, name, "image", kind, 100 if kind == "polygonlabels" else None, 200 if kind == "polygonlabels" else None, {"points": None, "polygonlabels": None, "text": None, "choices": None, **v})
    region = item("r1", None, "text_region", "polygonlabels", points=[[10.0, 10.0], [20.0, 10.0], [20.0, 20.0]], polygonlabels=["caption"])
    items = [region, item("t", "r1", "transcript", "textarea", text=[" Bonjour "]), item("r2", None, "text_region", "polygonlabels", points=[[1.0, 1.0]], polygonlabels=["sfx"])]
    data = {"image_path": "i.png", "series_id": "s", "domain": "webtoon", "tile_id": None, "width": None, "height": None}
    export = spark.createDataFrame([(1, data, [(0.5, items), (None, items)], None), (2, data, [], [(0.0, items)]), (3, data, None, None)], "task_ord bigint, " + EXPORT.replace("data struct", "data struct"))
    got = annotation.records(export).collect()
    assert [(r["task_ord"], r["source"], r["confidence"]) for r in sorted(got, key=lambda r: (r["task_ord"], r["item_ord"]))] == [(1, "human", 0.5), (1, "human", None), (2, "teacher", 0.0)]
    r = got[0]
    assert (r["transcript"], r["lang"], r["direction"], r["text_type"], tuple(r["polygon"][0])) == ("Bonjour", "mixed", "horizontal", "caption", (10.0, 20.0))


def test_image_values(spark):
    df = spark.createDataFrame([("data/raw/abc 1.png",)], "p string")
    v = df.select(annotation.image_value(F.col("p")), annotation.image_value(F.col("p"), "http://x/"), annotation.image_value(F.col("p"), document_root=True)).collect()[0]
    assert tuple(v) == ("data/raw/abc 1.png", "http://x/abc 1.png", "/data/local-files/?d=data/raw/abc%201.png")
    with pytest.raises(ValueError):
        annotation.image_value(F.col("p"), "http://x", True)


WORDS = "page_key string, ord bigint, page_num string, block_num string, par_num string, line_num string, left string, top string, width string, height string, conf string, text string"


def test_words_to_lines(spark):
    w = spark.createDataFrame([("p", 1, "1", "1", "1", "1", "10", "10", "40", "20", "96", "Hello"), ("p", 2, "1", "1", "1", "1", "60", "10", "40", "20", "93", "world"), ("p", 3, "1", "1", "1", "2", "10", "50", "90", "20", "88", "こんにちは"),
                               ("p", 4, "1", "1", "1", "3", "10", "90", "90", "20", "-1", ""), ("p", 5, "1", "1", "1", "4", "1", "1", "0", "9", "99", "x"), ("p", 6, "x", None, "", "9", "1", "1", "9", "9", "40", "low")], WORDS)
    got = lines.words_to_lines(lines.parse_words(w)).orderBy("ord").collect()
    assert [(r["transcript"], r["lang"], r["confidence"]) for r in got] == [("Hello world", "latin", 0.945), ("こんにちは", "ja", 0.88)]
    assert lines.words_to_lines(lines.parse_words(w), min_confidence=0.9).count() == 1


def test_detector(spark):
    rows = spark.createDataFrame([("p", 1, 0.0, 0.0, 0.0, 0.0, 0.9, 0.0), ("p", 2, 80.0, 148.0, 240.0, 276.0, 0.95, 0.0), ("p", 3, 82.0, 150.0, 242.0, 278.0, 0.9, 1.0), ("p", 4, 80.0, 148.0, 240.0, 276.0, 0.1, 0.0)],
                                 "page string, ord bigint, x1 double, y1 double, x2 double, y2 double, score double, class double").withColumn("original_width", F.lit(800)).withColumn("original_height", F.lit(600))
    d = detection.decode(rows, input_size=1000, min_score=0.5, min_size=10)
    kept = detection.suppress(d, "page", 0.5).collect()
    assert [(r["ord"], r["rank"]) for r in kept] == [(2, 0)]
    assert [round(v, 6) for v in kept[0]["box"]] == [64.0, 18.4, 192.0, 120.8]
    assert detection.suppress(d, "page", 0.5, limit=0).count() == 0
    centre = detection.decode(rows.limit(1).withColumn("x1", F.lit(500.0)).withColumn("y1", F.lit(500.0)).withColumn("x2", F.lit(200.0)).withColumn("y2", F.lit(100.0)).withColumn("original_width", F.lit(1000)).withColumn("original_height", F.lit(1000)), 1000, box_format="xywh").collect()[0]
    assert tuple(centre["box"]) == (400.0, 450.0, 600.0, 550.0)


def test_crop_projection(spark):
    poly = "array<struct<x:double,y:double>>"
    c = spark.createDataFrame([(1, boxes(0, 0, 40, 20), "text", 0.88, 0.93, None, None, 0.97, 10.0, 90, 40, 170, 130, False, "horizontal"), (2, boxes(0, 0, 40, 20), "x", 0.88, None, "ja", "sfx", 0.97, 10.0, 90, 40, 170, 130, True, "vertical"), (3, [], "x", 0.9, 0.9, None, None, 0.9, 1.0, 0, 0, 9, 9, False, "vertical")],
                              f"ord bigint, polygon {poly}, transcript string, recognition_confidence double, script_confidence double, lang string, text_type string, detection_confidence double, detection_height double, left int, top int, right int, bottom int, rotated boolean, direction string")
    got = detection.project(c).orderBy("ord").collect()
    assert len(got) == 2 and [tuple(p) for p in got[0]["polygon"]] == [(90.0, 40.0), (130.0, 40.0), (130.0, 60.0), (90.0, 60.0)]
    assert (got[0]["teacher_agreement"], got[0]["min_text_height"], got[0]["lang"]) == (0.88, 20.0, "mixed")
    assert tuple(got[1]["polygon"][1]) == (90.0, 90.0)  # (40, 0) turned back: x = 0, y = 90 - 40


class Fussy:
    def predict_page(self, a):
        if a["asset_id"] == "bad":
            raise RuntimeError("boom")
        return [] if a["asset_id"] == "empty" else [{"transcript": " hi ", "polygon": [(0, 0), (5, 0), (5, 5)], "confidence": 0.9}]


def test_predictor_failures_stay_apart(spark):
    a = review.catalog(assets(spark, asset("ok"), asset("bad", 2), asset("empty", 3, width=None)))
    run = run_predictor(a, "tests.test_operators:Fussy")
    assert [(r["asset_id"], r["transcript"], r["teacher_agreement"]) for r in predictions_of(run).collect()] == [("ok", "hi", 0.9)]
    assert [(r["asset_id"], r["error"]) for r in failures_of(run).collect()] == [("bad", "boom")]
    with pytest.raises(Exception, match="boom"):
        run_predictor(a, "tests.test_operators:Fussy", fail_fast=True).collect()


def test_label_cycle(spark):
    a = assets(spark, asset("ok"), asset("b", 2, height=50), asset("none", 3, width=None))
    s = label_cycle(a, "pagemill.operators.predictor:SizePredictor").summary().collect()[0]
    assert (s["failed_pages"], s["predictions"], s["silver"], s["rejected"], s["pages_considered"]) == (1, 2, 1, 1, 3)


def test_command_output():
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n"
    p = CommandPredictor()
    got = p.lines(head + "5\t1\t1\t1\t1\t1\t10\t10\t40\t20\t96\tHello\n5\t1\t1\t1\t1\t2\t60\t10\t40\t20\t93\tworld\n5\t1\t1\t1\t2\t1\t1\t1\t5\t5\t40\tlow\n")
    assert [(x["transcript"], round(x["confidence"], 6)) for x in got] == [("Hello world", 0.945)]
    assert (got[0]["lang"], got[0]["script_confidence"]) == ("latin", 0.95) and CommandPredictor(default_lang="ko").lines(head + "5\t1\t1\t1\t1\t1\t10\t10\t40\t20\t96\tHello\n")[0]["lang"] == "ko"
    assert CommandPredictor(min_length=6).lines(head + "5\t1\t1\t1\t1\t1\t10\t10\t40\t20\t96\tHello\n") == []
    assert p.lines("") == [] and p.lines(head) == []


def test_training_plan(spark, tmp_path):
    import json

    from pagemill.plans.cycle import SECTIONS

    full = {s: {} for s in SECTIONS} | {"data": {"dataset_manifest": "m.jsonl"}, "teachers": {k: {"checkpoint": k} for k in ("detector", "recognizer_jp", "recognizer_kr")}}
    f = tmp_path / "c.yaml"
    f.write_text(json.dumps(full))
    assert training_plan(spark, load_config(str(f))).count() == 4
    f.write_text(json.dumps({"data": {}}))
    with pytest.raises(ValueError, match="missing sections"):
        load_config(str(f))
