"""Text lines from the word boxes of an OCR engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions.geometry import box, rectangle
from pagemill.functions.text import infer_lang, join_tokens, lenient_double, lenient_int, script_confidence, strip

LINE = ("page_num", "block_num", "par_num", "line_num")


def parse_words(raw: DataFrame, page: str = "page_key", min_confidence: float = 35.0) -> DataFrame:
    """Typed words of text columns; unreadable numbers are 0, an unreadable confidence is -1. Words
    without text or size or under the confidence are left out."""
    numbers = [lenient_int(F.col(c)).alias(c) for c in (*LINE, "left", "top", "width", "height")]
    typed = raw.select(page, "ord", *numbers, lenient_double(F.col("conf"), -1.0).alias("conf"), strip(F.coalesce("text", F.lit(""))).alias("text"))
    return typed.where((F.col("conf") >= min_confidence) & (F.col("width") > 0) & (F.col("height") > 0) & (F.col("text") != ""))


def words_to_lines(words: DataFrame, page: str = "page_key", spaces: bool = True, min_confidence: float = 0.45, min_height: float = 8.0, min_length: int = 1) -> DataFrame:
    """One row per line: text in word order, mean confidence within 0 and 1, box, language.

    A line's words are one row; a line is short by nature."""
    low, high = lambda c: F.min(c), lambda c: F.max(c)
    lines = words.groupBy(page, *LINE).agg(
        join_tokens(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), spaces).alias("transcript"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(F.avg("conf") / 100.0, 12))).alias("confidence"),
        low("left").alias("x1"), low("top").alias("y1"), high(F.col("left") + F.col("width")).alias("x2"), high(F.col("top") + F.col("height")).alias("y2"), F.min("ord").alias("ord"),
    )
    corner = [F.col(c).cast("double") for c in ("x1", "y1", "x2", "y2")]
    kept = lines.where((F.char_length("transcript") >= min_length) & (F.col("confidence") >= min_confidence) & (F.col("y2") - F.col("y1") >= min_height))
    return kept.select(
        page, *LINE, "ord", "transcript", "confidence", rectangle(box(*corner)).alias("polygon"), infer_lang(F.col("transcript")).alias("lang"),
        script_confidence(F.col("transcript")).alias("script_confidence"), (corner[3] - corner[1]).alias("text_height"),
    )
