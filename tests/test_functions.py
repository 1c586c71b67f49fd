import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pagemill.functions import geometry as G
from pagemill.functions import text as T
from pagemill.functions.hashing import SplitRule, unit_score


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_white_space(spark):
    rows = [(f"{c}a{c}{c}b{c}",) for c in T.WHITE_SPACE] + [("",), (None,), ("   ",)]
    got = values(spark, rows, "t string", T.normalize(F.col("t")), T.strip(F.col("t")), T.word_count(F.col("t")))
    assert all(g[0] == "a b" and g[2] == 2 for g in got[:-3])
    assert all(g[1] == r[0].strip() for g, r in zip(got[:-3], rows))
    assert got[-3:] == [("", "", 0), (None, None, got[-2][2]), ("", "", 0)]
    assert len(T.WHITE_SPACE) == 29


def test_edit_distances(spark):
    rng = random.Random(1)
    words = ["a", "bb", "東京", "😀", "été", "x1"]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 8))), " ".join(rng.choices(words, k=rng.randint(0, 8)))) for _ in range(200)]
    got = values(spark, rows, "a string, b string", T.char_edits(F.col("a"), F.col("b")), T.word_edits(F.col("a"), F.col("b")))
    assert got == [(distance(a, b), distance(a.split(), b.split())) for a, b in rows]


def test_languages_by_script(spark):
    rows = [("こんにちは",), ("漢字",), ("한국어",), ("한국かな",), ("한국漢",), ("hello",), ("123",), ("",), (None,)]
    got = values(spark, rows, "t string", T.infer_lang(F.col("t")), T.script_confidence(F.col("t")))
    assert [g[0] for g in got] == ["ja", "ja", "ko", "ja", "ko", "latin", "mixed", "mixed", None]
    assert [g[1] for g in got][:8] == [0.95] * 6 + [0.85, 0.0]
    assert values(spark, rows[:2] + [(None,)], "t string", T.infer_lang(F.col("t"), "ko"), T.script_confidence(F.col("t"), "ko")) == [("ko", 0.95), ("ko", 0.95), (None, 0.95)]
    from pagemill.operators.predictor import language_of

    assert [language_of(t) for (t,) in rows[:8]] == ["ja", "ja", "ko", "ja", "ko", "latin", "mixed", "mixed"]


def test_lenient_numbers(spark):
    rows = [(" 12.9 ",), ("x",), ("",), (None,), ("-3",), ("1e400",)]
    got = values(spark, rows, "t string", T.lenient_int(F.col("t"), 7), T.lenient_double(F.col("t"), -1.0))
    assert [g[0] for g in got][:5] == [12, 7, 7, 7, -3]
    assert [g[1] for g in got][:5] == [12.9, -1.0, -1.0, -1.0, -3.0]


def test_tokens_and_paths(spark):
    rows = [([" a ", "", "b　"], "data/raw/abc 1~*+é.png")]
    got = values(spark, rows, "t array<string>, p string", T.join_tokens(F.col("t")), T.join_tokens(F.col("t"), False), T.quote_path(F.col("p")))
    from urllib.parse import quote

    assert got == [("a b", "ab", quote(rows[0][1], safe="/"))]


def test_ratio_by_zero(spark):
    assert values(spark, [(1, 0), (1, 4), (0, 0)], "a int, b int", T.ratio(F.col("a"), F.col("b"))) == [(0.0,), (0.25,), (0.0,)]


def test_hash_scores_and_splits(spark):
    ids = [f"series-{i}" for i in range(200)]
    rule = SplitRule(0.34, 0.33, 0.33, "coverage")
    got = values(spark, [(i,) for i in ids], "s string", unit_score("coverage", F.col("s")), rule.assign(F.col("s")))
    for i, (score, split) in zip(ids, got):
        want = int.from_bytes(hashlib.sha256(f"coverage:{i}".encode()).digest()[:8], "big") / float(2**64 - 1)
        assert score == want
        assert split == ("train" if want < 0.34 else "val" if want < 0.34 + 0.33 else "test")
    assert {g[1] for g in got} == {"train", "val", "test"}
    with pytest.raises(ValueError):
        SplitRule(0.5, 0.1, 0.1)


def test_boxes(spark):
    square = "named_struct('x1', 0D, 'y1', 0D, 'x2', 10D, 'y2', 10D)"
    half = "named_struct('x1', 0D, 'y1', 5D, 'x2', 10D, 'y2', 15D)"
    flat = "named_struct('x1', 0D, 'y1', 0D, 'x2', 0D, 'y2', 0D)"
    r = spark.range(1).select(G.iou(F.expr(square), F.expr(half)).alias("a"), G.iou(F.expr(flat), F.expr(flat)).alias("b"), G.bounding_box(F.expr("cast(array() as array<struct<x:double,y:double>>)")).alias("c")).collect()[0]
    assert (round(r["a"], 6), r["b"], r["c"]) == (0.333333, 0.0, None)


def test_direction_and_crops(spark):
    tall = F.struct(*[F.lit(float(v)).alias(k) for k, v in (("x1", 10), ("y1", 10), ("x2", 40), ("y2", 100))])
    tiny = F.struct(*[F.lit(float(v)).alias(k) for k, v in (("x1", 0), ("y1", 0), ("x2", 0.5), ("y2", 2.5))])
    r = spark.range(1).select(G.direction(tall, 1.5).alias("d"), G.crop_bounds(tall, F.lit(100), F.lit(105), 8).alias("c"), G.crop_bounds(tiny, F.lit(100), F.lit(100), 0).alias("t"), G.crop_bounds(tall, F.lit(0), F.lit(9)).alias("n")).collect()[0]
    assert r["d"] == "vertical" and tuple(r["c"]) == (2, 2, 48, 105) and r["t"] is None and r["n"] is None
