"""Problem 1: same or near-same pages across train and evaluation splits.

Method: exact prefix-filter bipartite join on rare shingles. The codes of evaluation pages are
indexed by their rare prefixes, those of training pages probe it, a length filter and an exact
check of the distance follow; a page's sha256 is a shingle of its own that is always rare enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.text import strip
from pagemill.llm.hamming import hamming_pairs, informative
from pagemill.session import cut_lineage


def slash_path(c: Column) -> Column:
    return F.regexp_replace(c, r"\\", "/")


def clean_split(c: Column) -> Column:
    """train, val or test; case and outer white space ignored, everything else null."""
    s = F.lower(strip(c))
    return F.when(s.isin("train", "val", "test"), s)


def page_keys(manifest: DataFrame, assets: DataFrame) -> DataFrame:
    """(path, in_train, in_val, in_test, sha, code), distinct: the images known under each path."""
    split = clean_split(F.col("split"))
    paths = (
        manifest.select(slash_path(F.col("image_path")).alias("path"), split.alias("split"))
        .where("path is not null and split is not null")
        .groupBy("path")
        .agg(*[F.max(F.col("split") == s).alias(f"in_{s}") for s in ("train", "val", "test")])
    )
    images = assets.select(
        slash_path(F.col("image_path")).alias("path"),
        F.unhex(F.lower(F.trim("sha256"))).alias("sha_hex"),
        F.lower(F.trim("sha256")).alias("sha_text"),
        informative(F.col("phash")).alias("code"),
    ).select("path", F.coalesce(F.col("sha_hex"), F.encode("sha_text", "UTF-8")).alias("sha"), "code")
    return paths.join(images, "path").distinct()


def path_overlaps(keys: DataFrame, radius: int = 6) -> DataFrame:
    """(train_path, eval_path), distinct: paths that hold the same image on the two sides.

    Nulls: rows without path or split count nowhere, a missing sha256 or uninformative phash
    matches nothing. Empty tables give no rows. Repeated rows change nothing.
    """
    train = keys.where("in_train").select("path", "sha", "code")
    held = keys.where("in_val or in_test").select("path", "sha", "code")

    def side(df: DataFrame, key: str, name: str, as_key: str | None = None) -> DataFrame:
        return df.where(F.col(key).isNotNull()).select(F.col(key).alias(as_key or key), F.col("path").alias(name)).distinct()

    same = side(held, "sha", "eval_path").join(side(train, "sha", "train_path"), "sha").select("train_path", "eval_path")
    index = held.select("code").where("code is not null").distinct()
    probe = train.select("code").where("code is not null").distinct()
    near = (
        hamming_pairs(index, probe, radius)
        .join(side(held, "code", "eval_path", "code_a"), "code_a")
        .join(side(train, "code", "train_path", "code_b"), "code_b")
        .select("train_path", "eval_path")
    )
    return same.unionByName(near).distinct()


def split_overlaps(manifest: DataFrame, assets: DataFrame, radius: int = 6) -> DataFrame:
    """(image_path_a, image_path_b), a <= b by code point: the overlaps between train and val/test."""
    keys = cut_lineage(page_keys(manifest, assets), "p1-keys")
    p = path_overlaps(keys, radius)
    return p.select(F.least("train_path", "eval_path").alias("image_path_a"), F.greatest("train_path", "eval_path").alias("image_path_b")).distinct()


def overlap_report(manifest: DataFrame, assets: DataFrame, radius: int = 6) -> DataFrame:
    """Per evaluation split and source: pages, and those of them that stand in train too.

    A page counts under every source that delivered it; a page in val and test counts in both. Pages
    are found by their keys, without a row for each pair: an image that very many pages of both
    sides hold costs a row a page.
    """
    keys = cut_lineage(page_keys(manifest, assets), "p1-keys")
    train, held = keys.where("in_train"), keys.where("in_val or in_test")
    shas = train.select("sha").where("sha is not null").distinct()
    codes = hamming_pairs(held.select("code").where("code is not null").distinct(), train.select("code").where("code is not null").distinct(), radius).select(F.col("code_a").alias("code")).distinct()
    leaked = held.join(shas, "sha", "left_semi").select("path").unionByName(held.join(codes, "code", "left_semi").select("path")).distinct().withColumn("leaked", F.lit(True))
    sources = assets.select(slash_path(F.col("image_path")).alias("path"), "source_id").distinct()
    splits = held.select("path", F.explode(F.array_compact(F.array(F.when(F.col("in_val"), F.lit("val")), F.when(F.col("in_test"), F.lit("test"))))).alias("split")).distinct()
    pages = splits.join(sources, "path").join(leaked, "path", "left").groupBy("split", "source_id")
    return pages.agg(F.count("*").alias("eval_pages"), F.count("leaked").alias("leaked_pages"))
