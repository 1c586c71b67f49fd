"""Evaluation of predictions against gold lines: matching by overlap, error rates, slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions.geometry import bounding_box, iou
from pagemill.functions.text import char_count, char_edits, ratio, word_count, word_edits
from pagemill.session import cut_lineage, drop_cut

#: Side of the grid cells that candidates must share, in pixels.
CELL = 256.0
#: Pages with more candidate pairs than this are matched in rounds over all pairs at once.
FOLD_PAIRS = 5_000


def candidates(gold: DataFrame, preds: DataFrame, min_iou: float = 0.5) -> DataFrame:
    """(image_path, gold_ord, pred_ord, iou) of line pairs on one page that overlap enough.

    Both sides are laid on a grid, so a page with very many lines joins only lines that lie near
    each other; a pair counts in the cell of the top left corner of its overlap, thus once. With a
    threshold of 0 disjoint lines match too and the whole page is the cell. Lines without a box
    match nothing."""

    def side(df: DataFrame, name: str) -> DataFrame:
        rows = df.where("image_path is not null").select("image_path", F.col("ord").alias(f"{name}_ord"), bounding_box(F.col("polygon")).alias(f"{name}_box")).where(f"{name}_box is not null")
        if min_iou <= 0:
            return rows.withColumn("cx", F.lit(0)).withColumn("cy", F.lit(0))
        b = F.col(f"{name}_box")
        cells = lambda lo, hi: F.explode(F.sequence(F.floor(b[lo] / CELL), F.floor(b[hi] / CELL)))
        return rows.withColumn("cx", cells("x1", "x2")).withColumn("cy", cells("y1", "y2"))

    a, b = F.col("gold_box"), F.col("pred_box")
    pairs = side(gold, "gold").join(side(preds, "pred"), ["image_path", "cx", "cy"])
    if min_iou > 0:
        corner = (F.floor(F.greatest(a["x1"], b["x1"]) / CELL) == F.col("cx")) & (F.floor(F.greatest(a["y1"], b["y1"]) / CELL) == F.col("cy"))
        pairs = pairs.where(corner)
    return pairs.select("image_path", "gold_ord", "pred_ord", iou(a, b).alias("iou")).where(F.col("iou") >= min_iou)


def _fold(pairs: DataFrame) -> DataFrame:
    """Greedy matching page by page: best overlap first, ties by gold then prediction."""
    lists = pairs.groupBy("image_path").agg(F.array_sort(F.collect_list(F.struct((-F.col("iou")).alias("n"), "gold_ord", "pred_ord"))).alias("a"))
    taken = F.aggregate(
        "a", F.slice("a", 1, 0),
        lambda acc, x: F.when(F.exists(acc, lambda m: (m["gold_ord"] == x["gold_ord"]) | (m["pred_ord"] == x["pred_ord"])), acc).otherwise(F.array_append(acc, x)),
    )
    return lists.select("image_path", F.explode(taken).alias("m")).select("image_path", "m.gold_ord", "m.pred_ord", (-F.col("m.n")).alias("iou"))


def _rounds(pairs: DataFrame) -> DataFrame:
    """The same matching without holding a page in one task: a pair that is the best of both its
    lines is taken, its lines leave, and so on. Equal to the greedy order since that is total."""
    order = F.struct((-F.col("iou")).alias("n"), "gold_ord", "pred_ord")
    left, done = cut_lineage(pairs, "pairs"), None
    while left.limit(1).count():
        g = left.groupBy("gold_ord").agg(F.min(order).alias("best")).select("best")
        p = left.groupBy("pred_ord").agg(F.min(order).alias("best")).select("best")
        new = cut_lineage(g.intersect(p).select(F.col("best.gold_ord").alias("gold_ord"), F.col("best.pred_ord").alias("pred_ord")).join(left, ["gold_ord", "pred_ord"]).select("image_path", "gold_ord", "pred_ord", "iou"), "matches")
        done = new if done is None else done.unionByName(new)
        rest = left.join(new.select("gold_ord"), "gold_ord", "left_anti").join(new.select("pred_ord"), "pred_ord", "left_anti")
        old, left = left, cut_lineage(rest, "pairs")
        drop_cut(old)
    return done if done is not None else pairs.limit(0)


def matches(gold: DataFrame, preds: DataFrame, min_iou: float = 0.5, fold_pairs: int = FOLD_PAIRS) -> DataFrame:
    """(image_path, gold_ord, pred_ord, iou): greedy one-to-one assignment, each line at most once."""
    pairs = cut_lineage(candidates(gold, preds, min_iou), "pairs")
    hot = pairs.groupBy("image_path").agg(F.count("*").alias("n")).where(F.col("n") > fold_pairs).select("image_path")
    if not hot.limit(1).count():
        return _fold(pairs)
    return _fold(pairs.join(hot, "image_path", "left_anti")).unionByName(_rounds(pairs.join(hot, "image_path", "left_semi")))


def scored_gold(gold: DataFrame, preds: DataFrame, min_iou: float = 0.5) -> DataFrame:
    """Each gold line with its match, if any, and the edit distances to the predicted text."""
    m = matches(gold, preds, min_iou)
    text = preds.select(F.col("ord").alias("pred_ord"), F.coalesce("transcript", F.lit("")).alias("pred_text"))
    m = m.join(text, "pred_ord").select(F.col("gold_ord").alias("ord"), "pred_ord", "iou", "pred_text")
    g = F.coalesce("transcript", F.lit(""))
    return gold.join(m, "ord", "left").select(
        gold["*"], "pred_ord", "iou", char_count(g).alias("gold_chars"), word_count(g).alias("gold_words"),
        F.when(F.col("pred_ord").isNotNull(), char_edits(g, F.col("pred_text"))).alias("char_edits"),
        F.when(F.col("pred_ord").isNotNull(), word_edits(g, F.col("pred_text"))).alias("word_edits"),
    )


def unmatched_gold(gold: DataFrame, preds: DataFrame, min_iou: float = 0.5) -> DataFrame:
    return gold.join(matches(gold, preds, min_iou).select(F.col("gold_ord").alias("ord")), "ord", "left_anti")


def unmatched_predictions(gold: DataFrame, preds: DataFrame, min_iou: float = 0.5) -> DataFrame:
    return preds.join(matches(gold, preds, min_iou).select(F.col("pred_ord").alias("ord")), "ord", "left_anti")


_SUMS = ("gold_lines", "matched_lines", "gold_chars", "matched_chars", "char_edits", "gold_words", "matched_words", "word_edits")


def _facts(scored: DataFrame, *keys: str) -> DataFrame:
    hit = F.col("pred_ord").isNotNull()
    return scored.select(
        *keys, F.lit(1).alias("gold_lines"), hit.cast("int").alias("matched_lines"), "gold_chars", F.when(hit, F.col("gold_chars")).otherwise(0).alias("matched_chars"),
        F.coalesce("char_edits", F.lit(0)).alias("char_edits"), "gold_words", F.when(hit, F.col("gold_words")).otherwise(0).alias("matched_words"), F.coalesce("word_edits", F.lit(0)).alias("word_edits"),
    )


def _rates() -> list:
    c = F.col
    return [
        ratio(c("matched_lines"), c("gold_lines")).alias("detection_recall"),
        ratio(c("char_edits"), c("matched_chars")).alias("matched_cer"),
        ratio(c("char_edits") + c("gold_chars") - c("matched_chars"), c("gold_chars")).alias("end_to_end_cer"),
        ratio(c("word_edits"), c("matched_words")).alias("matched_wer"),
        ratio(c("word_edits") + c("gold_words") - c("matched_words"), c("gold_words")).alias("end_to_end_wer"),
    ]


def overall(gold: DataFrame, preds: DataFrame, min_iou: float = 0.5) -> DataFrame:
    """One row: counts, recall, precision, matched and end-to-end error rates; 0.0 for 0 / 0."""
    zero = lambda n: F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n)
    facts = _facts(scored_gold(gold, preds, min_iou)).agg(*[zero(n) for n in _SUMS]).withColumn("prediction_lines", F.lit(0).cast("bigint"))
    lines = preds.agg(F.count("*").alias("prediction_lines")).select(*[F.lit(0).cast("bigint").alias(n) for n in _SUMS], "prediction_lines")
    one = facts.unionByName(lines).agg(*[zero(n) for n in (*_SUMS, "prediction_lines")])
    return one.select(
        "gold_lines", "prediction_lines", "matched_lines", (F.col("gold_lines") - F.col("matched_lines")).alias("unmatched_gold_lines"),
        (F.col("prediction_lines") - F.col("matched_lines")).alias("unmatched_prediction_lines"), ratio(F.col("matched_lines"), F.col("prediction_lines")).alias("detection_precision"), *_rates(),
    )


def slices(gold: DataFrame, preds: DataFrame, min_iou: float = 0.5) -> DataFrame:
    """(slice, value) for domain, direction, text_type and split: the figures of ``overall`` that
    have a meaning per gold line. One pass, one shuffle of the four groupings together."""
    kinds = ("domain", "direction", "text_type", "split")
    pairs = F.inline(F.array(*[F.struct(F.lit(k).alias("slice"), F.col(k).cast("string").alias("value")) for k in kinds]))
    rows = _facts(scored_gold(gold, preds, min_iou), *kinds).select(*_SUMS, pairs)
    sums = rows.groupBy("slice", "value").agg(*[F.sum(n).alias(n) for n in _SUMS])
    return sums.select("slice", "value", "gold_lines", "matched_lines", (F.col("gold_lines") - F.col("matched_lines")).alias("unmatched_gold_lines"), *_rates())
