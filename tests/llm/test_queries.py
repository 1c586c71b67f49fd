"""The registered queries: against SQL, and against brute force where SQL cannot say it."""

import collections
import unicodedata

import numpy as np
import pandas as pd
import pytest

from pagemill.llm import canonical_text, lang_id, leakage, queries
from pagemill.session import table
from tests.conftest import SMALL, same_as_sql


#: in the smallest data one document is more of the mixture than the tolerance
OTHER_SIZE = {"p8_targets": "/root/testdata/sf0.01"}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, name):
    same_as_sql(spark, queries.QUERIES[name], queries.SQL[name], OTHER_SIZE.get(name, SMALL))


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    assert df.columns and df.count() >= (0 if name.endswith("_found") else 1)


def rows(df):
    return set(map(tuple, df.collect()))


def box(poly):
    return min(p["x"] for p in poly), min(p["y"] for p in poly), max(p["x"] for p in poly), max(p["y"] for p in poly)


def overlap(a, b):
    w, h = max(0, min(a[2], b[2]) - max(a[0], b[0])), max(0, min(a[3], b[3]) - max(a[1], b[1]))
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
    return w * h / union if union > 0 else 0.0


def test_p2_found(spark):
    p, g = (table(spark, SMALL, t).select("image_path", "ord", "polygon", "transcript").collect() for t in ("teacher_predictions", "gold_lines"))
    by = collections.defaultdict(list)
    for r in g:
        by[r["image_path"]].append(r)
    want = set()
    for a in p:
        for b in by[a["image_path"]]:
            if a["transcript"] != b["transcript"] and canonical_text.canonical(a["transcript"]) == canonical_text.canonical(b["transcript"]) and overlap(box(a["polygon"]), box(b["polygon"])) >= 0.5:
                want.add((a["ord"], b["ord"]))
    assert rows(queries.p2_found(spark, SMALL)) == want


def test_p3_found(spark):
    t, names, want = lang_id.script_table(), list(lang_id.SCRIPT_RANGES), set()
    for r in table(spark, SMALL, "teacher_predictions").select("ord", "transcript", "lang").collect():
        n = collections.Counter(names[k - 1] for ch in canonical_text.canonical(r["transcript"]) if (k := int(t[ord(ch)])))
        if n:
            langs = {k for k, c in n.items() if c >= 4} or {k for k, c in n.items() if c == max(n.values())}
            label = (r["lang"] or "").strip().lower()
            label = {"jp": "ja", "ja-jp": "ja", "kr": "ko", "ko-kr": "ko"}.get(label, label)
            if label != (next(iter(langs)) if len(langs) == 1 else "mixed"):
                want |= {(r["ord"], x) for x in langs}
    assert rows(queries.p3_found(spark, SMALL)) == want


def test_p5_found(spark):
    d = table(spark, SMALL, "page_assets").toPandas()
    parent = list(range(len(d)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def link(i, j):
        parent[find(i)] = find(j)

    first = {}
    for i, r in d.iterrows():
        for key in (("s", r.sha256.lower()), ("a", r.asset_id)):
            link(i, first.setdefault(key, i))
    for i, c in enumerate(d.canonical_asset_id):
        if c and ("a", c.strip()) in first:
            link(i, first["a", c.strip()])
    code = [int(x, 16) if x else 0 for x in d.phash]
    for i, a in enumerate(code):
        for j in range(i):
            if a not in (0, 2**64 - 1) and code[j] not in (0, 2**64 - 1) and (a ^ code[j]).bit_count() <= 6:
                link(i, j)
    groups, want = collections.defaultdict(list), set()
    for i in range(len(d)):
        groups[find(i)].append(i)
    at = pd.to_datetime(d.fetched_at, utc=True, format="ISO8601")
    for m in groups.values():
        value = {i: (sum(pd.notna(x) for x in (d.phash[i], d.width[i], d.height[i])), d.width[i] * d.height[i] if pd.notna(d.width[i] * d.height[i]) else 0, at[i]) for i in m}
        best = [i for i in m if all(value[i][k] == max(v[k] for v in value.values()) for k in range(3))]
        if len(m) > 1 and len(best) == 1:
            want.add((int(min(d.ord[i] for i in m)), int(d.ord[best[0]])))
    assert rows(queries.p5_found(spark, SMALL)) == want


def test_p7_found(spark):
    grams = collections.defaultdict(set)
    for r in table(spark, SMALL, "eval_items").collect():
        x = leakage.letters_only(r["text"])
        for j in range(len(x) - 59):
            grams[x[j : j + 60]].add(r["item_id"])
    want = set()
    for r in table(spark, SMALL, "documents").collect():
        x = leakage.letters_only(r["text"])
        want |= {(r["doc_id"], k) for j in range(len(x) - 59) for k in grams.get(x[j : j + 60], ())}
    assert rows(queries.p7_found(spark, SMALL)) == want


def test_letters_only_ignores_what_the_definition_ignores():
    for a, b in (("Ｃａｆé!", "café"), ("ＡＢ-1", "ab1"), ("ﾊﾟﾝ", "パン"), ("STRASSE", "straße"), ("한", unicodedata.normalize("NFD", "한")), ("a​b", "ab")):
        assert leakage.letters_only(a) == leakage.letters_only(b)
    assert leakage.letters_only("é") != leakage.letters_only("e") and leakage.letters_only(None) == ""
    assert np.array_equal(lang_id.flatten(["ab", ""])[1], [0] * (lang_id.GAP + 2 + lang_id.GAP) + [1] * lang_id.GAP)
