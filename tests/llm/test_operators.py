"""Edge cases: nulls in any column, empty and very long texts, ties, repeated rows, empty tables,
extra columns whose names clash with those inside the operators."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import batch_dedup, canonical_text, graph, hamming, keep_together, lang_id, leakage, mixture, nsw, split_overlap, survivor, truncation

POLY = "array<struct<x:double,y:double>>"
ASSET = "asset_id string, source_id string, image_path string, sha256 string, phash string, width int, height int, fetched_at string, domain string, canonical_asset_id string, batch_id int, ord bigint"
#: names that the operators use inside
CLASH = ("code", "sha", "path", "key", "u", "v", "node", "root", "rank", "row", "unit", "shard", "tokens", "k", "t", "s", "carry", "canonical", "look", "x1", "h", "d", "uses", "group_ord")


def clash(df):
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH if c not in df.columns])


def asset(ord_, phash="0123456789abcdef", sha=None, **kw):
    base = {"asset_id": f"a{ord_}", "source_id": "src", "image_path": f"p{ord_}.png", "sha256": sha or f"sha{ord_}", "phash": phash, "width": 10, "height": 10, "fetched_at": "2024-01-01T00:00:00Z", "domain": "manga", "canonical_asset_id": None, "batch_id": 0, "ord": ord_}
    return {**base, **kw}


def assets(spark, *rows):
    return clash(spark.createDataFrame(list(rows), ASSET))


NULLS = dict.fromkeys(("asset_id", "source_id", "image_path", "sha256", "phash", "width", "height", "fetched_at", "domain", "canonical_asset_id", "batch_id", "ord"))


# the Hamming join and the graphs


def signed(code):
    return code - (1 << 64) if code >> 63 else code


def flip(code, n, rng):
    for b in rng.sample(range(64), n):
        code ^= 1 << b
    return code


@pytest.mark.parametrize("ell", [1, 2, 3, 4])
def test_hamming_join_is_exact(spark, monkeypatch, ell):
    rng = random.Random(ell)
    monkeypatch.setattr(hamming, "choose_ell", lambda n, r: ell)
    base = [rng.getrandbits(64) for _ in range(60)]
    codes = {flip(c, n, rng) for c in base for n in (0, 1, 5, 6, 7, 8)} | {0, 2**64 - 1, 3, 5, 0xFF, 0xFFFF}
    signed = [c - 2**64 if c >= 2**63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "code bigint")
    want = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= 6}
    assert {tuple(r) for r in hamming.hamming_pairs(df).collect()} == want
    left, right = df.where("code % 2 = 0"), df.where("code % 3 = 0")
    both = {(a, b) for a in signed for b in signed if a % 2 == 0 and b % 3 == 0 and ((a ^ b) & (2**64 - 1)).bit_count() <= 6}
    assert {tuple(r) for r in hamming.hamming_pairs(left, right).collect()} == both
    assert hamming.hamming_pairs(df.limit(0)).count() == 0


def test_codes(spark):
    df = spark.createDataFrame([("FFFFFFFFFFFFFFFF",), ("0000000000000000",), (" 00000000000000aB ",), ("8000000000000000",), ("12",), ("",), (None,), ("zz",)], "p string")
    assert [r[0] for r in df.select(hamming.informative(F.col("p"))).collect()] == [None, None, 0xAB, -(2**63), None, None, None, None]


def test_longer_keys_for_larger_indexes():
    assert [hamming.choose_ell(n, 6) for n in (10, 10**6, 10**7, 10**9)] == sorted(hamming.choose_ell(n, 6) for n in (10, 10**6, 10**7, 10**9))
    assert hamming.choose_ell(10, 6) == 1 and hamming.choose_ell(10**10, 6) > 5


def test_graph_search_against_exhaustive():
    rng = np.random.default_rng(2)
    codes = np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    rng.shuffle(codes)
    g = nsw.build(codes)
    beam, recall = nsw.tune(g, 6)
    assert recall >= 0.995
    q = nsw.probes(codes, 6, 500, seed=77)
    got = set(zip(*[x.tolist() for x in nsw.neighbours(g, q, 6, beam)]))
    want = set(zip(*[x.tolist() for x in np.nonzero(np.bitwise_count(q[:, None] ^ codes[None, :]) <= 6)]))
    assert got <= want and len(got) >= 0.99 * len(want)
    c, e = g.to_bytes()
    again = nsw.Graph.from_bytes(c, e, beam)
    assert set(zip(*[x.tolist() for x in nsw.neighbours(again, q, 6)])) == got
    assert len(nsw.neighbours(nsw.build(codes[:0]), q, 6)[0]) == 0 and nsw.tune(nsw.build(codes[:0]), 6) == (32, 1.0)
    one = nsw.build(codes[:1])
    assert nsw.neighbours(one, codes[:1], 6)[1].tolist() == [0]


def test_graphs_measure_few_codes(monkeypatch):
    rng = np.random.default_rng(3)
    codes = rng.permutation(np.unique(rng.integers(0, 2**64, 20_000, dtype=np.uint64)))
    q, measured, count = nsw.probes(codes, 6, 512, seed=9), [0], np.bitwise_count

    def counted(x):
        measured[0] += x.size
        return count(x)

    monkeypatch.setattr(np, "bitwise_count", counted)
    g = nsw.build(codes)
    assert measured[0] <= 100 * len(codes)
    measured[0] = 0
    r, p = nsw.neighbours(g, q, 6, 12)
    assert measured[0] <= 2_000 * len(q)
    monkeypatch.undo()
    assert len(r) >= 0.995 * len(nsw.exhaustive(codes, q, 6)[0]) and (count(q[r] ^ codes[p]) <= 6).all()


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)] + [(5, 5), (None, 7), (1, 2), (2, 1)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    want = {(x, find(x)) for x in list(parent)}
    got = [tuple(r) for r in graph.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()]
    assert set(got) == want and len(got) == len(want)
    assert graph.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# problem 1

MANIFEST = f"image_path string, series_id string, split string, transcript string, polygon {POLY}, ord bigint"


def manifest(spark, *rows):
    return clash(spark.createDataFrame([(p, s, sp, "t", None, i) for i, (p, s, sp) in enumerate(rows)], MANIFEST))


def test_overlaps(spark):
    a = assets(spark, asset(1, image_path="a.png", sha="X"), asset(2, image_path="b.png", sha="x", phash=None), asset(3, image_path="c\\d.png", phash="0123456789abcd0f"), asset(4, image_path="e.png", phash="0000000000000000"),
               asset(5, image_path="f.png", phash="0000000000000000"), asset(6, image_path="both.png", phash=None), asset(6, image_path="both.png", phash=None), {**NULLS})
    m = manifest(spark, ("a.png", "s", " TRAIN "), ("b.png", "s", "Val"), ("c/d.png", "s", "test"), ("e.png", "s", "train"), ("f.png", "s", "test"), ("both.png", "s", "train"), ("both.png", "s", "val"), ("both.png", "s", "val"),
                 ("a.png", "s", None), (None, "s", "train"), ("g.png", None, "test"), ("h.png", "s", "dev"))
    got = sorted(tuple(r) for r in split_overlap.split_overlaps(m, a).collect())
    # equal sha; 3 bits apart; a path on both sides; the uninformative e and f do not meet
    assert got == [("a.png", "b.png"), ("a.png", "c/d.png"), ("both.png", "both.png")]
    r = {(x["split"], x["source_id"]): tuple(x)[2:] for x in split_overlap.overlap_report(m, a).collect()}
    assert r == {("val", "src"): (2, 2), ("test", "src"): (2, 1)}
    assert split_overlap.split_overlaps(m.limit(0), a).count() == 0 and split_overlap.split_overlaps(m, a.limit(0)).count() == 0


# problem 2


def test_one_form():
    c = canonical_text.canonical
    same = [("ＡＢＣ", "ABC"), ("ﾗｻﾄﾞ", "ラサド"), ("café", "café"), ("a​b﻿", "ab"), ("a　b", "a b"), ("СREAΚ", "CREAK"), ("Who imitatеѕ", "Who imitates"), ("二ュ一ス", "ニュース"), ("夕方", "タ方"), ("へべぺ", "ヘベペ"), ("가", "가"), ("ﬁn", "fin"), ("～", "〜"), ("́", "́"), ("е́", "é"), ("⼈", "人")]
    for a, b in same:
        assert c(a) == c(b), (a, b)
    for a, b in [("ソ", "ン"), ("a", "A"), ("e", "é"), ("l", "I"), ("0", "O"), ("ab", "a b"), ("シ", "ツ"), ("か", "が"), ("り", "リ")]:
        assert c(a) != c(b), (a, b)
    assert c("Привет") == "Привет" and c("Ελλάδα") == "Ελλάδα"  # words of one other script stay
    assert c(None) is None and c("") == "" and c("​") == ""
    for t in ("カード", "一つ", "二人", "Привет мир", "ｅх", "ー" * 50, "東京タワー"):
        assert c(c(t)) == c(t)
    assert len(c("ー力" * 20000)) == 40000


def test_form_depends_on_looks_only():
    rng = random.Random(5)
    pool = [m for m in canonical_text._MEMBERS if len(m) > 1]
    for _ in range(300):
        word = [rng.choice(pool) if rng.random() < 0.6 else [rng.choice("あアツ漢bDんЖ한")] for _ in range(rng.randint(1, 8))]
        assert len({canonical_text.canonical("".join(rng.choice(m) for m in word)) for _ in range(4)}) == 1, word


def test_scripts():
    assert canonical_text.resolve("аbc") == (frozenset(), True)
    assert canonical_text.resolve("abc") == (frozenset({"Latin"}), False)
    assert "Jpan" in canonical_text.resolve("漢字かな")[0] and canonical_text.resolve("123") == (frozenset(), False)


LINES = f"image_path string, ord bigint, polygon {POLY}, transcript string"


def test_more_look_alikes_and_whole_scripts():
    assert {canonical_text.canonical(t) for t in ("google", "gᴏᴏgle", "gⲟⲟgle", "ցօօgle", "ɡооɡlе")} == {"google"} and canonical_text.canonical("ꓖOOGLE") == "GOOGLE"
    assert canonical_text.whole_script("соре") and not canonical_text.whole_script("сорeв") and not canonical_text.whole_script("мир") and not canonical_text.whole_script("")


def test_lines_that_look_alike(spark):
    b = lambda x: [{"x": float(a), "y": float(c)} for a, c in ((x, 0), (x + 10, 0), (x + 10, 10), (x, 10))]
    g = clash(spark.createDataFrame([("i", 1, b(0), "СREAK"), ("i", 2, b(100), "CREAK"), ("j", 3, b(0), None), (None, 4, b(0), "x"), ("i", 5, [], "CREAK"), ("i", 6, None, "CREAK")], LINES))
    p = clash(spark.createDataFrame([("i", 1, b(1), "CREAK"), ("i", 1, b(1), "CREAK"), ("i", 2, b(50), "CREAK"), ("i", 3, b(0), "CREAKS"), ("i", 4, b(100), "CREAK"), ("j", 5, b(0), "ＣＲＥＡＫ"), ("i", 6, b(101), "ＣＲＥＡＫ"), (None, 7, None, None)], LINES))
    assert sorted(tuple(r) for r in canonical_text.same_look_lines(p, g).collect()) == [(1, 1), (1, 1), (6, 2)]
    assert canonical_text.same_look_lines(p.limit(0), g).count() == 0 and canonical_text.same_look_lines(p, g.limit(0)).count() == 0


# problem 3

JA, KO, LA = ["この章で古い傘を助けた", "待ってくれ", "静かにして", "カメラを測った"], ["오래된 거울을 찾았다", "약속했잖아", "정말 고마워"], ["Panel after panel", "forgive the mirror", "¿Quién traiciona?", "jamais"]


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    rows = [(rng.choice(x) + rng.choice(["", "!", " 12"]), k) for _ in range(300) for x, k in ((JA, "ja"), (KO, "ko"), (LA, "latin"))]
    return lang_id.train([t for t, _ in rows], [k for _, k in rows])


def test_model(model):
    assert model.accuracy > 0.98 and 0 < model.threshold <= 1
    s = model.segments(["古い傘 the mirror", "", "123", "오래된"])
    assert [(int(r), model.labels[k]) for r, k in zip(s["row"], s["label"])] == [(0, "ja"), (0, "latin"), (3, "ko")]
    assert s["start"][1] == 4 and s["end"][1] == 14 and (s["confidence"] > 0.5).all()
    assert not len(model.segments([])["row"]) and not len(model.segments(["", "!?"])["row"])
    # letters never seen in training are placed by their block
    assert [model.labels[k] for k in model.segments(["龘靐齉"])["label"]] == ["ja"]


TEXTS = "ord bigint, transcript string, lang string"


def test_wrong_labels(spark, model):
    rows = [(1, "古い傘を助けた", "ja"), (2, "古い傘を助けた", "JP"), (3, "古い傘を助けた", " ja-JP "), (4, "古い傘を助けた", None), (5, "古い傘を助けた", "ko"), (6, "古い傘を助けた the mirror", "Mixed"), (7, "古い傘を助けた the mirror", "ja"),
            (8, "待 a", "latin"), (9, "", "ja"), (10, "123!", None), (11, None, None), (12, "forgive the mirror", "unknown"), (13, "fоrgive", "LATIN"), (14, "待つ ab", "mixed"), (None, "古い", None), (15, "the mirror " * 20000, "und")]
    df = clash(spark.createDataFrame(rows, TEXTS))
    got = sorted(tuple(r) for r in lang_id.wrong_labels(df, model).collect())
    assert got == [(4, "ja"), (5, "ja"), (7, "ja"), (7, "latin"), (8, "ja"), (8, "latin"), (12, "latin"), (15, "latin")]
    ids = {r["ord"]: r for r in lang_id.identify(df, model, "ord", "transcript").collect()}
    assert len(ids) == 15 and (ids[6]["lang"], ids[9]["lang"], ids[11]["lang"], ids[11]["segments"]) == ("mixed", "und", "und", [])
    assert [s["lang"] for s in ids[6]["segments"]] == ["ja", "latin"] and ids[6]["segments"][1]["text"] == "the mirror"
    assert lang_id.wrong_labels(df.limit(0), model).count() == 0


def test_features_do_not_reach_into_other_texts():
    alone = lang_id.features(lang_id.flatten(["the old mirror"])[0], (2, 3, 4, 5, 6), 16)[0]
    for others in (["x", "ß鏡"], ["", "zz"]):
        cps, row_of, _ = lang_id.flatten([others[0], "the old mirror", others[1]])
        f, pos = lang_id.features(cps, (2, 3, 4, 5, 6), 16)
        assert np.array_equal(f[row_of[pos] == 1], alone)


def test_training_on_few_rows(spark):
    none = lang_id.fit(spark.createDataFrame([(1, "x", None), (2, None, "ja")], TEXTS), "ord")
    assert none.labels == ["und"]
    one = lang_id.fit(spark.createDataFrame([(1, "x", "latin")], TEXTS), "ord")
    assert one.labels == ["latin"]
    assert lang_id.fit(spark.createDataFrame([], TEXTS), "ord").labels == ["und"]


def test_rare_labels_are_drawn_and_missing_ones_counted_by_script(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice(JA) + str(k), "ja") for k in range(3000)] + [(3000 + k, rng.choice(LA), "latin") for k in range(40)]
    rare = spark.createDataFrame([*rows, (4000, KO[0], "ko"), (4001, KO[1], "kr")], TEXTS)
    assert lang_id.fit(rare, "ord", sample_rows=150).labels == ["ja", "ko", "latin"]
    asked = spark.createDataFrame([(1, KO[0], "ja"), (2, KO[0], "ko"), (3, KO[0] + " " + LA[0], "ko"), (4, JA[0], "ko")], TEXTS)
    never = lang_id.fit(spark.createDataFrame(rows, TEXTS), "ord", sample_rows=150)
    assert never.labels == ["ja", "latin"]
    assert sorted(tuple(r) for r in lang_id.wrong_labels(asked, never).collect()) == [(1, "ko"), (3, "ko"), (3, "latin"), (4, "ja")]


# problem 4


def test_repeats(spark):
    a = assets(spark, asset(1, "0123456789abcdef", "X"), asset(2, "ff00ff00ff00ff00"), asset(3, None, "x", batch_id=1), asset(4, "0123456789abcd0f", batch_id=1), asset(5, "fedcba9876543210", batch_id=1), asset(6, "fedcba9876543211", batch_id=1),
               asset(7, "fedcba9876543210", batch_id=2), asset(8, "0000000000000000", batch_id=2), asset(9, "0000000000000000", batch_id=2), asset(10, None, batch_id=3), asset(11, "aaaa5555aaaa5555", batch_id=3, sha256=None), {**NULLS})
    for fanout in (1, 2, 5):
        got = {r["ord"]: (r["kind"], r["match_ord"]) for r in batch_dedup.repeats(a, fanout=fanout, shard_codes=2).collect()}
        assert got == {3: ("sha256", 1), 4: ("near", 1), 5: ("new", None), 6: ("near", 5), 7: ("phash", 5), 8: ("new", None), 9: ("new", None), 10: ("new", None), 11: ("new", None)}
    assert sorted(r["ord"] for r in batch_dedup.repeated(a).collect()) == [3, 4, 6, 7]
    assert batch_dedup.repeats(a.limit(0)).count() == 0
    assert batch_dedup.repeats(a.where("batch_id = 0")).count() == 0


@pytest.mark.parametrize("parts", [8, 600, 70_000])
def test_routed_codes_meet_in_a_graph(spark, parts):
    ell, bits = batch_dedup.route(parts, 6)
    rng = random.Random(parts)
    rows = [(k, c, ell, bits) for k in range(60) for base in [rng.getrandbits(64)] for c in (signed(base), signed(flip(base, 6, rng)))]
    got = batch_dedup.with_keys(spark.createDataFrame(rows, "k int, code long, ell int, bits int"), {(ell, bits)}, 6)
    met = got.groupBy("k", "key").agg(F.count("*").alias("n")).groupBy("k").agg(F.max("n").alias("n"))
    assert [r["n"] for r in met.collect()] == [2] * 60


def test_shards_cover_everything_before_a_batch():
    sizes = {0: 100, **{b: 10 for b in range(1, 24)}}
    for fanout in (1, 3, 5):
        plan = batch_dedup.shard_plan(sizes, fanout, 30)
        of = {n: range(lo, hi + 1) for n, lo, hi, _ in plan}
        for b in range(1, 24):
            seen = sorted(x for n in batch_dedup.visits(plan, b, fanout) for x in of[n])
            assert seen == list(range(0, b + 1))
    assert batch_dedup.shard_plan({}, 5, 30) == []


def test_routes_visit_the_fewest_graphs():
    assert [batch_dedup.route(n, 6) for n in (7, 8, 512, 1200, 2000, 4000)] == [(0, 0), (1, 3), (1, 9), (1, 9), (1, 9), (2, 12)]


def test_routed_repeats_against_all_pairs(spark, monkeypatch):
    rng = random.Random(46)
    base, codes = [rng.getrandbits(64) for _ in range(40)], []
    while len(codes) < 400:
        c = flip(rng.choice(base), rng.randint(0, 6), rng) if rng.random() < 0.5 else rng.getrandbits(64)
        codes += [c] if c not in codes else []
    batch = [0 if i < 200 else 1 + (i - 200) // 25 for i in range(400)]
    monkeypatch.setattr(batch_dedup, "build_index", None)  # a query over the tables stores no graphs
    monkeypatch.setattr(batch_dedup, "QUERY_BLOCK", 10)
    got = batch_dedup.repeats(assets(spark, *[asset(i, f"{c:016x}", batch_id=b) for i, (c, b) in enumerate(zip(codes, batch))]), fanout=3, shard_codes=20)
    want = {i: min((j for j in range(i) if (codes[i] ^ codes[j]).bit_count() <= 6), default=None) for i in range(200, 400)}
    assert {r["ord"]: r["match_ord"] for r in got.collect()} == want and sum(v is not None for v in want.values()) > 50


def test_stored_index_gives_the_same_batch_by_batch(spark, tmp_path):
    rng = random.Random(44)
    base = [rng.getrandbits(64) for _ in range(60)]
    rows = []
    for i in range(300):
        batch = 0 if i < 120 else 1 + (i - 120) // 15
        c = rng.choice(base) if rng.random() < 0.4 else rng.getrandbits(64)
        rows.append(asset(i, f"{flip(c, rng.choice([0, 0, 2, 6]), rng):016x}" if rng.random() < 0.9 else None, f"sha{rng.randint(0, 250)}", batch_id=batch))
    a = assets(spark, *rows)
    want = {r["ord"]: (r["match_ord"] is not None) for r in batch_dedup.repeats(a).collect()}
    index, got = batch_dedup.StoredIndex(spark, str(tmp_path / "index"), fanout=3, shard_codes=40), {}
    for b in range(13):
        out = index.accept(a.where(F.col("batch_id") == b), b)
        got |= {r["ord"]: r["match_ord"] is not None for r in out.collect() if b}
        if b == 4:
            again = {r["ord"]: r["match_ord"] is not None for r in index.accept(a.where("batch_id = 4"), 4).collect()}
            assert all(got[k] == v for k, v in again.items())  # a repeated delivery of the batch itself
    assert got == want
    names = [s[0] for s in index.plan()]
    assert "h" in names and "c1-9" in names and "c10-12" in names and not any(n.startswith("b") for n in names)


@pytest.mark.parametrize("case", ["closing batch again", "failure amid the drops", "gap", "late batch"])
def test_stored_index_keeps_every_batch(spark, tmp_path, monkeypatch, case):
    rng = random.Random(45)
    codes = [rng.getrandbits(64) for _ in range(4)]
    index = batch_dedup.StoredIndex(spark, str(tmp_path / "index"), fanout=3)

    def give(batch, *of):
        """Kinds of a batch with one near form of each of ``codes[of]``; three bits of its own flipped."""
        rows = [asset(100 * batch + k, f"{codes[k] ^ (7 << 3 * batch):016x}", f"{batch}-{k}", batch_id=batch) for k in of]
        return [r["kind"] for r in index.accept(assets(spark, *rows), batch).orderBy("ord").collect()]

    give(0, 0)
    assert give(1, 1) == ["new"] and give(2, 2) == ["new"]
    if case == "closing batch again":
        assert give(3, 3) == ["new"] and [s[0] for s in index.plan()] == ["c1-3", "h"]
        assert give(3, 1, 2, 3) == ["near", "near", "new"]
    elif case == "failure amid the drops":
        drop, left = index._drop, [1]

        def failing(name):
            if name.startswith("shards/b") and not left.pop():
                raise OSError("stopped")
            drop(name)
            left.append(0)

        with monkeypatch.context() as m:
            m.setattr(index, "_drop", failing)
            with pytest.raises(OSError):
                give(3, 3)
        assert give(3, 1, 2, 3) == ["near", "near", "new"]
    elif case == "late batch":
        assert give(4, 1, 2) == ["near", "near"]
        assert give(3, 1, 3) == ["near", "new"]
    assert give(4, 1, 2) == ["near", "near"] and give(7, 0, 1, 2) == ["near"] * 3
    if case != "gap":
        assert give(8, 3) == ["near"]
    runs = [s[1:3] for s in index.plan()]
    assert sorted(runs) == sorted(set(runs)) and (1, 3) in runs and not any(s[0][0] == "b" and s[2] <= 6 for s in index.plan())


# problem 5


def test_survivors(spark):
    a = assets(spark, asset(1, sha="A", width=5, fetched_at="2024-01-01T00:00:00+02:00"), asset(2, sha="a", fetched_at="2024-01-02T00:00:00Z", width=20), asset(3, None, asset_id="z"), asset(4, None, asset_id="z", sha="q"), asset(5, None, asset_id="c1", canonical_asset_id="c2"),
               asset(6, None, asset_id="c2", canonical_asset_id="c1", width=99, fetched_at="2025-01-01T00:00:00"), asset(7, None, canonical_asset_id=" "), asset(8, None, canonical_asset_id="gone"), {**NULLS})
    got = {r["group_ord"]: r for r in survivor.survivors(a).collect()}
    assert {k: (r["rows"], r["best_ord"]) for k, r in got.items()} == {1: (2, 2), 3: (2, None), 5: (2, 6)}  # 3 and 4 tie
    assert (got[1]["width"], got[5]["fetched_at"]) == (20, "2025-01-01T00:00:00")
    assert sorted(tuple(r) for r in survivor.best_rows(a).collect()) == [(1, 2), (5, 6)]
    assert survivor.best_rows(a.limit(0)).count() == 0


def test_currency_places_rows_without_a_time(spark):
    # png follows jpg wherever both have times, so an undated png is later than a dated jpg
    rows = [r for g in range(5) for r in (asset(100 * g + 1, None, f"g{g}", image_path=f"{g}.jpg"), asset(100 * g + 2, None, f"g{g}", image_path=f"{g}.png", fetched_at="2024-02-01T00:00:00Z"))]
    rows += [asset(901, None, "u", image_path="u.png", fetched_at=None), asset(902, None, "u", image_path="u.jpg", fetched_at="2024-03-01T00:00:00Z"), asset(903, None, "w", image_path="w.jpg", fetched_at="no time"), asset(904, None, "w", image_path="w.png", fetched_at="2024-03-01T00:00:00Z")]
    a = assets(spark, *rows)
    order = survivor.learn_precedence(survivor.grouped(a))
    assert "png" in order["kind"]["jpg"] and "jpg" not in order["kind"]["png"]
    got = {r["group_ord"]: r for r in survivor.survivors(a).collect()}
    assert (got[901]["image_path"], got[903]["image_path"]) == ("u.png", "w.png")
    assert got[901]["best_ord"] is None or got[901]["best_ord"] == 902


def test_surviving_row_by_learned_precedence(spark, monkeypatch):
    t = "2024-0{}-01T00:00:00Z".format
    # png follows jpg wherever both have times
    rows = [r for g in range(5) for r in (asset(100 * g + 1, None, f"g{g}", image_path=f"{g}.jpg"), asset(100 * g + 2, None, f"g{g}", image_path=f"{g}.png", fetched_at=t(2)))]
    rows += [asset(801, None, "i", image_path="i.jpg"), asset(802, None, "i", image_path="i.png"), asset(803, None, "i", image_path="i.gif", width=4)]  # one instant: 801 and 802 tie
    rows += [asset(811, None, "j", image_path="j.png", width=50, fetched_at=None), asset(812, None, "j", image_path="j.jpg", fetched_at=t(3))]  # neither is best in everything
    rows += [asset(821, None, "k", image_path="k.jpg", fetched_at=t(3)), asset(822, None, "k", image_path="k.png", fetched_at=None)]  # png follows, but has no time
    rows += [asset(831, None, "l", image_path="l.jpg", fetched_at=t(5)), asset(832, None, "l", image_path="l.jpg", width=11, fetched_at=t(4))]  # 832 is larger and of the profile of 831
    rows += [asset(841, None, "m", image_path="m.jpg", fetched_at=None), asset(842, None, "m", image_path="m.png", fetched_at=None)]
    a, learned = assets(spark, *rows), []
    g = survivor.grouped(a)
    got = {r["group_ord"]: (r["best_ord"], r["exact"]) for r in survivor.surviving_rows(g, survivor.learn_precedence(g)).collect()}
    assert {k: v for k, v in got.items() if k > 800} == {801: (802, False), 811: (811, False), 821: (821, True), 831: (831, False), 841: (842, False)}
    learn = survivor.learn_precedence
    monkeypatch.setattr(survivor, "learn_precedence", lambda r: learned.append(learn(r)) or learned[0])
    assert sorted(tuple(r) for r in survivor.best_rows(a).collect()) == [*((100 * g + 1, 100 * g + 2) for g in range(5)), (821, 821)]
    assert "png" in learned[0]["kind"]["jpg"]


def test_instants(spark):
    df = spark.createDataFrame([("2024-01-01T02:00:00+02:00",), ("2024-01-01T00:00:00Z",), ("2024-01-01T00:00:00",), ("x",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(survivor.instant(F.col("t")).cast("double")).collect()]
    assert got[0] == got[1] == got[2] and got[3:] == [None] * 3


# problem 6


def test_keep_together(spark):
    rng = random.Random(6)
    rows = [(f"p{i}.png", f"s_{rng.randint(0, 300)}", "train") for i in range(4000)] + [(f"h{i}.png", "hot", rng.choice(["train", "val"])) for i in range(2000)]
    rows += [("x.png", " S_1 ", "val"), ("y.png", "s-1", "TEST"), ("n.png", None, "val"), ("n.png", "", "train"), (None, None, None), ("p\\7.png", "other", "test"), ("p/7.png", "third", None), ("x.png", None, "val")]
    m = manifest(spark, *rows)
    got = keep_together.keep_together(m, shard_units=50).collect()
    assert sum(r["records"] for r in got) == len(rows) and len({r["unit_key"] for r in got}) == len(got)
    assert len({r["unit"] for r in got if r["series_id"] in ("other", "third")}) == 1 and len({r["unit"] for r in got if r["unit_key"] in ("series s-1", "page x.png")}) == 1
    assert all(len({r["split"] for r in got if r["unit"] == u}) == 1 for u in {r["unit"] for r in got})
    total = {s: sum(r["records"] for r in got if r["split"] == s) / len(rows) for s in ("train", "val", "test")}
    assert all(abs(total[s] - t) < 0.02 for s, t in keep_together.TARGETS.items()), total
    assert {r["series_id"] for r in keep_together.divided(m).collect()} == {"hot", "s-1"}
    assert all(r["splits"] == 1 for r in keep_together.assigned_pages(m).collect())
    assert keep_together.keep_together(m.limit(0)).count() == 0


def test_one_image_under_two_paths_keeps_series_together(spark):
    m = manifest(spark, ("a.png", "one", "train"), ("b.png", "two", "val"), ("c.png", "three", "val"))
    catalog = clash(spark.createDataFrame([("a.png", "AB"), ("b.png", "ab "), ("c.png", None), (None, "ab"), ("z.png", "ab")], "image_path string, sha256 string"))
    got = {r["series_id"]: r["unit"] for r in keep_together.keep_together(m, catalog).collect()}
    assert got["one"] == got["two"] != got["three"]


def test_differencing():
    rng = np.random.default_rng(1)
    w = rng.integers(1, 100, 400).astype(float)
    sums, where = keep_together.singletons(w, 10)
    assert np.allclose(np.bincount(where, weights=w, minlength=10), sums) and sums.max() - sums.min() <= 2
    a, b = keep_together.difference([np.array([5.0, 1.0]), np.array([4.0, 0.0])])
    assert sorted(a) == [5.0, 5.0] and len(b) == 2
    assert keep_together.bins_to_splits(np.array([1.0] * 10), keep_together.TARGETS).count("train") == 8


# problem 7


def test_leaks(spark):
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzあいうえお漢字") for _ in range(n))
    a, b = text(200), text(300)
    edited = a[:50] + "Q" + a[51:90] + a[91:130]
    docs = [(1, text(500) + " " + a[20:80] + text(50)), (2, text(77) + a[20:79] + text(50)), (3, ", ".join(a[100:170]).upper()), (4, a), (4, a), (5, edited), (6, ""), (7, None), (8, b[:60] + a[-60:]), (None, a), (9, text(200_000) + b)]
    d = clash(spark.createDataFrame(docs, "doc_id bigint, text string"))
    i = clash(spark.createDataFrame([(10, a, "en", "val"), (11, b, "en", "test"), (12, None, "en", "test"), (13, "", None, None), (14, "short", None, None)], "item_id bigint, text string, lang string, split string"))
    assert sorted(tuple(r) for r in leakage.leaked(d, i).collect()) == [(1, 10), (3, 10), (4, 10), (8, 10), (8, 11), (9, 11)]
    found = sorted(tuple(r) for r in leakage.leaks(d, i).collect())
    assert found == sorted(tuple(r) for r in leakage.leaks(d, i, block_letters=250).collect())  # more items than one index holds
    near = {r[:2]: {"longest_run": r[2], "covered": r[3]} for r in found}
    assert near[5, 10]["longest_run"] < 60 and near[5, 10]["covered"] >= 60
    assert leakage.leaked(d.limit(0), i).count() == 0 and leakage.leaked(d, i.limit(0)).count() == 0
    rep = {r["item_id"]: r["docs"] for r in leakage.leak_report(d, i).collect()}
    assert rep[10] >= 5 and rep[12] == 0


def test_embedding_and_edits():
    rng = np.random.default_rng(0)
    emb = leakage.Embedding(31, 12, 8)
    base = rng.integers(97, 123, (200, 33)).astype(np.uint32)
    same, hits = 0, 0
    for row in base:
        other = row.copy()
        other[15] = 64
        k1, k2 = emb.keys(row, np.array([0])), emb.keys(other, np.array([0]))
        hits += bool((k1 == k2).any())
        same += bool((k1 == emb.keys(row.copy(), np.array([0]))).all())
    assert same == 200 and hits > 100  # equal windows always meet, windows with an edit often
    assert leakage.edit_within("kitten", "sitting", 3) and not leakage.edit_within("kitten", "sitting", 2) and leakage.edit_within("", "ab", 2) and not leakage.edit_within("", "abc", 2)


def nearest_stretch(w, item):
    """Edit distance of a window to the nearest stretch of an item, by the whole table."""
    row = [0] * (len(item) + 1)
    for i, c in enumerate(w, 1):
        new = [i]
        for j, x in enumerate(item, 1):
            new.append(min(row[j - 1] + (c != x), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("search", [leakage.CLOSE, leakage.PASSAGES])
@pytest.mark.parametrize("kind", ["del", "mix"])
def test_near_search_reaches_its_recall(kind, search):
    rng = np.random.default_rng(29)
    letters = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    repetitions, reached = leakage.tune(search)
    most, w = leakage.most_edits(search), search.window
    assert reached >= search.recall
    count = 100
    passages = rng.integers(97, 123, (count, search.passage), dtype=np.uint32)
    edited = ["".join(map(chr, e)) for e in leakage.spread_edits(passages, search.spacing, kind, rng)]
    items = [letters(int(rng.integers(0, 40))) + "".join(map(chr, x)) + letters(20) for x in passages]
    docs = [letters(int(rng.integers(0, 60))) + e + letters(30) for e in edited]
    index = leakage.ItemIndex([*range(count)], items, leakage.Embedding(w, search.samples, repetitions))
    got = {(d, k): covered for d, k, _, covered in leakage.match_texts(docs, index, search.stride, most)}
    want = {k for k in range(count) if any(nearest_stretch(docs[k][p : p + w], items[k]) <= most for p in range(len(docs[k]) - w + 1))}
    assert len(want) == count and {k for k, _ in got} <= want and all(d == k for d, k in got)
    assert len(got) >= (search.recall - 0.05) * count  # the draw of the test has its own error
    assert np.mean([c >= search.passage - 3 for c in got.values()]) > 0.95  # neighbours of what met are covered too


def test_near_search_finds_every_short_identical_run(spark):
    rng = random.Random(31)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    items = [(k, text(120)) for k in range(60)]
    docs = [(k, text(rng.randint(0, 90)) + "7" + t[40 : 71 + k % 29] + "8" + text(20)) for k, t in items] + [(100, "z" * 5000)]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([*items, (100, "y" + "z" * 300)], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): (r["longest_run"], r["covered"]) for r in leakage.leaks(d, i).collect()}
    assert all(got[k, k][0] >= 31 + k % 29 for k in range(60)) and got[100, 100][0] == 300 and got[100, 100][1] >= 300


# problem 8

DOCS = "doc_id bigint, text string, source string"
TARGETS = "source string, target_share double, max_repeats int"


def test_mixture(spark):
    rng = random.Random(8)
    docs = [(i, "word " * rng.randint(5, 60), s) for i, s in enumerate(["big"] * 600 + ["mid"] * 200 + ["small"] * 50 + ["other"] * 20)] + [(9001, None, "big"), (9002, "", "big"), (9003, "x", None), (None, "word word", "mid")]
    d = clash(spark.createDataFrame(docs, DOCS))
    t = clash(spark.createDataFrame([("big", 0.5, 1), ("mid", 0.25, 3), ("small", 0.25, 4), ("gone", 0.1, 2), ("zero", None, 2), (None, 0.1, 1)], TARGETS))
    for shard_docs in (50_000, 40):
        used = mixture.mixture(d, t, shard_docs=shard_docs).collect()
        cap = {"big": 1, "mid": 3, "small": 4}
        assert all(1 <= r["uses"] <= cap[r["source"]] for r in used) and len({r["doc_id"] for r in used}) == len(used)
        total = sum(r["tokens"] * r["uses"] for r in used)
        for s, share in (("big", 0.5), ("mid", 0.25), ("small", 0.25)):
            assert abs(sum(r["tokens"] * r["uses"] for r in used if r["source"] == s) / total - share) < 0.03
    rep = {r["source"]: r for r in mixture.mixture_shares(d, t).collect()}
    assert rep["other"]["used_tokens"] == 0 and rep["gone"]["docs"] == 0 and abs(sum(r["share"] for r in rep.values()) - 1) < 1e-9
    assert mixture.mixture(d.limit(0), t).count() == 0 and mixture.mixture(d, t.limit(0)).count() == 0
    again = sorted((r["doc_id"] or -1, r["uses"]) for r in mixture.mixture(d, t).collect())
    assert again == sorted((r["doc_id"] or -1, r["uses"]) for r in mixture.mixture(d.repartition(7), t).collect())


def test_sainte_lague():
    assert mixture.sainte_lague([53, 24, 23], 7, [9, 9, 9]) == [3, 2, 2]
    assert mixture.sainte_lague([0.5, 0.5], 10, [2, 100]) == [2, 8] and mixture.sainte_lague([1.0], 5, [3]) == [3]
    assert mixture.sainte_lague([], 5, []) == [] and mixture.sainte_lague([0.0, 1.0], 2, [5, 5]) == [0, 2]


def test_tokens_follow_the_vocabulary(spark):
    texts = ["Hello world", "日本語のテキスト", "", None, "<|endoftext|>", "x" * 50_000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(mixture.token_count("text")).collect()]
    enc = mixture.encoding(mixture.TOKENIZER)
    assert got == [len(enc.encode_ordinary(t or "")) for t in texts]
    assert all(enc.decode(enc.encode_ordinary(t)) == t for t in texts if t)


# problem 9


def sentence(rng):
    n = ["river", "castle", "mirror", "captain", "garden", "violin"]
    return f"The {rng.choice(['old', 'tired', 'golden'])} {rng.choice(n)} {rng.choice(['follows', 'forgets', 'repairs'])} the {rng.choice(n)} behind the {rng.choice(['old', 'silent'])} {rng.choice(n)}"


def test_truncation(spark):
    rng = random.Random(9)
    body = lambda: ". ".join(sentence(rng) for _ in range(rng.randint(2, 5)))
    docs, truth = [], set()
    for i in range(900):
        t = body() + "."
        if i % 9 == 0:
            t = t[: -rng.choice([5, 7, 19, 23])].rstrip()
            t += rng.choice(["", "…", "..."])
            truth.add(i)
        elif i % 9 == 1:
            t = t[:-1] + rng.choice(["", "…", " ^^"])
        elif i % 9 == 2:
            t += rng.choice(["\n- Anna", " (edited)", "\nTL/Bob"])
        docs.append((i, t, "s"))
    docs += [(10_000, None, "s"), (10_001, "", "s"), (10_002, "   ", None), (None, "x", "s"), (10_003, (body() + ". ") * 3000, "s")]
    d = clash(spark.createDataFrame(docs, DOCS))
    m, st = truncation.fit(d)
    assert m.held_out["cut_found"] > 0.9 and m.held_out["intact_flagged"] < 0.05
    got = {r["doc_id"] for r in truncation.truncated(d).collect()}
    assert len(got & truth) >= 0.9 * len(truth) and len(got - truth) <= 0.02 * len(docs) and not got & {10_000, 10_001, 10_002, 10_003}
    r = {x["source"]: x for x in truncation.rates(d).collect()}
    assert r["s"]["docs"] == 903 and r["s"]["truncated"] == len(got)
    none = d.where("doc_id >= 10000 and doc_id < 10003")
    assert truncation.truncated(none).count() == 0 and truncation.truncated(d.limit(0)).count() == 0


def test_limits(spark):
    rng = random.Random(10)
    rows = [(i, "a" * rng.randint(20, 400), "s") for i in range(400)] + [(i, "b" * 240, "s") for i in range(1000, 1030)] + [(i, "é" * 100, "t") for i in range(2000, 2030)] + [(i, "c" * rng.randint(20, 400), "t") for i in range(3000, 3300)]
    got = truncation.limits(spark.createDataFrame(rows, DOCS), "text", "source")
    assert ("chars", 240) in got["s"] and ("bytes", 200) in got["t"]


def test_endings():
    assert truncation.peel("It ended. ^^") == ("It ended.", False) and truncation.peel("It ended.\n- Anna") == ("It ended.", False)
    assert truncation.peel("It en…") == ("It en", True) and truncation.peel("") == ("", False)
    assert truncation.last_sentence("One. Two three") == ("Two three", False) and truncation.last_sentence("「はい」と言う。次は")[0] == "次は"
    assert truncation.last_sentence("One. Anna: Two three.") == ("Two three", True)


def test_truncation_reads_whole_texts():
    long = "word " * 400
    assert truncation.last_sentence(f"One. {long}end") == (f"{long}end", False) and truncation.last_sentence(f"One. {long}end.") == (f"{long}end", True)
    for opening, closing in ("“”", "「」"):
        assert truncation.quotation_open(opening + long) and not truncation.quotation_open(opening + long + closing)
        assert truncation.quotation_open(closing + opening + long)
    assert not truncation.quotation_open("“One.\n\n“Two.”") and truncation.quotation_open("「a「b」" + long)
    st = truncation.Statistics(np.zeros(1 << truncation.WORD_BITS, int), np.zeros(1 << truncation.WORD_BITS, int), {})
    assert truncation.hashed(f"“{long}end.", None, st) != truncation.hashed(f"{long}end.", None, st)
    assert truncation.peel("It ended." + " ^^" * 9) == ("It ended.", False)


def test_mixture_keeps_targets_when_shards_are_small(spark):
    rows = [(i, "a", 100 if i % 2 else 900) for i in range(8_000)] + [(i, "b", 1_000) for i in range(8_000, 16_000)] + [(20_000, "c", 40)]
    counted = spark.createDataFrame(rows, "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 2), ("z", 0.1, 3)], "source string, target_share double, max_repeats int")
    for shard_docs in (100, 3_000):
        used = mixture._mix(counted, targets, "doc_id", None, 20, shard_docs, 42).groupBy("source").agg(F.sum(F.col("tokens") * F.col("uses")).alias("n"), F.max("uses").alias("most")).collect()
        total = sum(r["n"] for r in used)
        assert {r["source"] for r in used} == {"a", "b"} and all(abs(r["n"] / total - 0.5) <= 0.005 and r["most"] <= 2 for r in used)
        assert abs(total - 16_000_000) <= 0.005 * 16_000_000  # source a is used up to its cap


def test_sainte_lague_gives_the_seats_of_highest_quotients():
    rng = np.random.default_rng(1)
    for _ in range(40):
        n, seats = int(rng.integers(1, 9)), int(rng.integers(0, 60))
        weights, caps = rng.integers(0, 9, n).astype(float).tolist(), rng.integers(0, 15, n).tolist()
        want, quotients = [0] * n, sorted((-w / (2 * k + 1), i, k) for i, w in enumerate(weights) for k in range(caps[i]) if w > 0)
        for _, i, _ in quotients[:seats]:
            want[i] += 1
        assert mixture.sainte_lague(weights, seats, caps) == want
    assert sum(mixture.sainte_lague([0.2, 0.3, 0.5], 10**12, [10**12] * 3)) == 10**12
