"""Queries of the evaluation, with the SQL they must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagemill.operators import evaluate as E
from pagemill.session import table


def _t(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, d, "gold_lines"), table(spark, d, "teacher_predictions")


def eval_candidates(spark: SparkSession, d: str) -> DataFrame:
    return E.candidates(*_t(spark, d))


def eval_matches(spark: SparkSession, d: str) -> DataFrame:
    return E.matches(*_t(spark, d))


def eval_unmatched_gold(spark: SparkSession, d: str) -> DataFrame:
    return E.unmatched_gold(*_t(spark, d)).select("ord", "image_path")


def eval_unmatched_predictions(spark: SparkSession, d: str) -> DataFrame:
    return E.unmatched_predictions(*_t(spark, d)).select("ord", "image_path")


def eval_overall(spark: SparkSession, d: str) -> DataFrame:
    return E.overall(*_t(spark, d))


def eval_slices(spark: SparkSession, d: str) -> DataFrame:
    return E.slices(*_t(spark, d))


def cer_pairs(spark: SparkSession, d: str) -> DataFrame:
    return E.scored_gold(*_t(spark, d)).where("pred_ord is not null").select("ord", "pred_ord", "gold_chars", "char_edits")


def wer_pairs(spark: SparkSession, d: str) -> DataFrame:
    return E.scored_gold(*_t(spark, d)).where("pred_ord is not null").select("ord", "pred_ord", "gold_words", "word_edits")


QUERIES = {f.__name__: f for f in (eval_candidates, eval_matches, eval_unmatched_gold, eval_unmatched_predictions, eval_overall, eval_slices, cer_pairs, wer_pairs)}

_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def norm_sql(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_SPACE}', ' ', 'g'))"


def edits_sql(a: str, b: str) -> str:
    """Levenshtein distance of two lists: one row of the table after the other. Elements are wrapped
    in lists, so that accumulator and element have one type."""
    cell = f"list_append(r, least(r[len(r)] + 1, p[x[1] + 1] + 1, p[x[1]] + CASE WHEN ({a})[i[1]] = ({b})[x[1]] THEN 0 ELSE 1 END))"
    row = f"list_reduce(list_transform(range(1, len({b}) + 1), lambda k: [k]), lambda r, x: {cell}, [p[1] + 1])"
    return f"list_reduce(list_transform(range(1, len({a}) + 1), lambda k: [k]), lambda p, i: {row}, range(0, len({b}) + 1))[len({b}) + 1]"


def box_sql(t: str) -> str:
    pts = lambda f, c: f"list_{f}(list_transform({t}.polygon, lambda q: q.{c}))"
    return f"{pts('min', 'x')} AS x1, {pts('min', 'y')} AS y1, {pts('max', 'x')} AS x2, {pts('max', 'y')} AS y2"


_W = "greatest(0e0, least(g.x2, p.x2) - greatest(g.x1, p.x1))"
_H = "greatest(0e0, least(g.y2, p.y2) - greatest(g.y1, p.y1))"
_AREA = "(greatest(0e0, {t}.x2 - {t}.x1) * greatest(0e0, {t}.y2 - {t}.y1))"
CANDIDATES = f"""
    g AS (SELECT image_path, ord, {box_sql("gold_lines")} FROM gold_lines WHERE len(polygon) > 0),
    p AS (SELECT image_path, ord, {box_sql("teacher_predictions")} FROM teacher_predictions WHERE len(polygon) > 0),
    u AS (SELECT g.image_path, g.ord AS gold_ord, p.ord AS pred_ord, {_W} * {_H} AS i, {_AREA.format(t="g")} + {_AREA.format(t="p")} - {_W} * {_H} AS n FROM g JOIN p USING (image_path)),
    c AS (SELECT image_path, gold_ord, pred_ord, CASE WHEN n > 0 THEN i / n ELSE 0e0 END AS iou FROM u WHERE CASE WHEN n > 0 THEN i / n ELSE 0e0 END >= 0.5e0)"""
MATCHES = f"""
    {CANDIDATES},
    l AS (SELECT image_path, list([{{'g': gold_ord, 'p': pred_ord, 'iou': iou}}] ORDER BY iou DESC, gold_ord, pred_ord) AS a FROM c GROUP BY image_path),
    m AS (SELECT image_path, unnest(list_reduce(a, lambda acc, x: CASE WHEN len(list_filter(acc, lambda y: y.g = x[1].g OR y.p = x[1].p)) > 0 THEN acc ELSE list_concat(acc, x) END)) AS z FROM l),
    matches AS (SELECT image_path, z.g AS gold_ord, z.p AS pred_ord, z.iou AS iou FROM m)"""
_WORDS = "list_filter(string_split({t}, ' '), lambda w: w <> '')"
SCORED = f"""
    {MATCHES},
    t AS (SELECT gl.ord, gl.domain, gl.direction, gl.text_type, gl.split, k.pred_ord, {norm_sql("coalesce(gl.transcript, '')")} AS a, {norm_sql("coalesce(tp.transcript, '')")} AS b
          FROM gold_lines gl LEFT JOIN matches k ON k.gold_ord = gl.ord LEFT JOIN teacher_predictions tp ON tp.ord = k.pred_ord),
    w AS (SELECT *, string_split(a, '') AS ac, string_split(b, '') AS bc, {_WORDS.format(t="a")} AS aw, {_WORDS.format(t="b")} AS bw FROM t),
    scored AS (SELECT ord, domain, direction, text_type, split, pred_ord, length(a) AS gold_chars, len(aw) AS gold_words,
            CASE WHEN pred_ord IS NOT NULL THEN {edits_sql("CASE WHEN a = '' THEN [] ELSE ac END", "CASE WHEN b = '' THEN [] ELSE bc END")} END AS char_edits,
            CASE WHEN pred_ord IS NOT NULL THEN {edits_sql("aw", "bw")} END AS word_edits FROM w)"""
_RATE = "CASE WHEN {b} = 0 THEN 0e0 ELSE ({a})::DOUBLE / ({b})::DOUBLE END"
_FACTS = """count(*) AS gold_lines, count(pred_ord) AS matched_lines, coalesce(sum(gold_chars), 0)::BIGINT AS gc, coalesce(sum(gold_chars) FILTER (pred_ord IS NOT NULL), 0)::BIGINT AS mc,
    coalesce(sum(char_edits), 0)::BIGINT AS ce, coalesce(sum(gold_words), 0)::BIGINT AS gw, coalesce(sum(gold_words) FILTER (pred_ord IS NOT NULL), 0)::BIGINT AS mw, coalesce(sum(word_edits), 0)::BIGINT AS we"""
_RATES = ", ".join(
    f"{_RATE.format(a=a, b=b)} AS {n}"
    for n, a, b in (("detection_recall", "matched_lines", "gold_lines"), ("matched_cer", "ce", "mc"), ("end_to_end_cer", "ce + gc - mc", "gc"), ("matched_wer", "we", "mw"), ("end_to_end_wer", "we + gw - mw", "gw"))
)

SQL = {
    "eval_candidates": f"WITH {CANDIDATES} SELECT * FROM c",
    "eval_matches": f"WITH {MATCHES} SELECT * FROM matches",
    "eval_unmatched_gold": f"WITH {MATCHES} SELECT ord, image_path FROM gold_lines WHERE ord NOT IN (SELECT gold_ord FROM matches)",
    "eval_unmatched_predictions": f"WITH {MATCHES} SELECT ord, image_path FROM teacher_predictions WHERE ord NOT IN (SELECT pred_ord FROM matches)",
    "cer_pairs": f"WITH {SCORED} SELECT ord, pred_ord, gold_chars, char_edits FROM scored WHERE pred_ord IS NOT NULL",
    "wer_pairs": f"WITH {SCORED} SELECT ord, pred_ord, gold_words, word_edits FROM scored WHERE pred_ord IS NOT NULL",
    "eval_overall": f"""WITH {SCORED}, f AS (SELECT {_FACTS}, (SELECT count(*) FROM teacher_predictions) AS prediction_lines FROM scored)
        SELECT gold_lines, prediction_lines, matched_lines, gold_lines - matched_lines AS unmatched_gold_lines, prediction_lines - matched_lines AS unmatched_prediction_lines,
            {_RATE.format(a="matched_lines", b="prediction_lines")} AS detection_precision, {_RATES} FROM f""",
    "eval_slices": f"""WITH {SCORED},
        x AS (SELECT *, unnest([{{'slice': 'domain', 'value': domain}}, {{'slice': 'direction', 'value': direction}}, {{'slice': 'text_type', 'value': text_type}}, {{'slice': 'split', 'value': split}}]) AS s FROM scored),
        f AS (SELECT s.slice AS slice, s.value AS value, {_FACTS} FROM x GROUP BY ALL)
        SELECT slice, value, gold_lines, matched_lines, gold_lines - matched_lines AS unmatched_gold_lines, {_RATES} FROM f""",
}
