"""The page catalog: scans, lookups, upserts, content deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.text import non_blank


def asset_id(source: Column, series: Column, chapter: Column, page: Column) -> Column:
    """``source:series:chapter:0007``; page numbers above 9999 keep all their digits."""
    return F.format_string("%s:%s:%s:%04d", source, series, chapter, page)


def decoded(assets: DataFrame) -> DataFrame:
    """Stored rows as records: a blank canonical id is none, metadata parsed as a string map."""
    return assets.withColumn("canonical_asset_id", non_blank(F.col("canonical_asset_id"))).withColumn("metadata", F.from_json("metadata_json", "map<string,string>"))


def scan(assets: DataFrame) -> DataFrame:
    """All rows in catalog order; the order of delivery decides between equal places."""
    return assets.orderBy("source_id", "series_id", "chapter_id", "page_index", "ord")


def find(assets: DataFrame, wanted: str) -> DataFrame:
    """The rows of one asset_id; the filter reaches the scan."""
    return assets.where(F.col("asset_id") == wanted)


def first_by_sha(assets: DataFrame) -> DataFrame:
    """Per sha256 the row to refer to: an original before a duplicate, then by asset_id, then ord.
    An aggregate, so hot images combine on the map side."""
    best = F.min(F.struct("is_duplicate", "asset_id", "ord"))
    return assets.where("sha256 is not null").groupBy(F.lower("sha256").alias("sha256")).agg(best.alias("b")).select("sha256", "b.asset_id", "b.ord", "b.is_duplicate")


def find_many(assets: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the wanted ids (asset_id, ord), blanks dropped, in order of first mention."""
    wanted = ids.select(non_blank(F.col("asset_id")).alias("asset_id"), "ord").where("asset_id is not null").groupBy("asset_id").agg(F.min("ord").alias("position"))
    return assets.join(wanted, "asset_id").orderBy("position", "ord")


def upsert(catalog: DataFrame, rows: DataFrame) -> DataFrame:
    """The catalog after ``rows``: per asset_id the last write by ord wins.

    Null ids are kept as they are. ``max_by`` combines on the map side, so a key that is written a
    million times sends one row per task."""
    columns = catalog.columns
    both = catalog.select(*columns).unionByName(rows.select(*columns))
    last = both.where("asset_id is not null").groupBy("asset_id").agg(F.max_by(F.struct(*columns), "ord").alias("r")).select("r.*")
    return last.unionByName(both.where("asset_id is null"))


def content_dedup(assets: DataFrame) -> DataFrame:
    """Each row with the first row of its content: canonical_ord, canonical, duplicate.

    The first asset to deliver an image is its canonical one; later assets with the same bytes are
    duplicates; a redelivery of the asset itself is not. Rows of one ord are in order of asset_id, so
    every duplicate has its canonical asset."""
    first = assets.where("sha256 is not null").groupBy(F.lower("sha256").alias("sha")).agg(F.min(F.struct("ord", "asset_id", "image_path", "phash", "width", "height")).alias("f"))
    j = assets.join(first, F.lower("sha256") == F.col("sha"), "left")
    known = F.coalesce("f.ord", F.col("ord"))
    return j.select(
        "ord", "asset_id", known.alias("canonical_ord"), F.when((F.col("f.ord") < F.col("ord")) | ((F.col("f.ord") == F.col("ord")) & (F.col("f.asset_id") != F.col("asset_id"))), F.col("f.asset_id")).alias("canonical"),
        F.coalesce(F.col("f.asset_id") != F.col("asset_id"), F.lit(False)).alias("duplicate"),
        F.coalesce("f.image_path", F.col("image_path")).alias("stored_path"), F.coalesce("f.phash", F.col("phash")).alias("known_phash"),
        F.coalesce("f.width", F.col("width")).alias("known_width"), F.coalesce("f.height", F.col("height")).alias("known_height"),
    )


def select_assets(assets: DataFrame, source_id: str | None = None, series_id: str | None = None, chapter_id: str | None = None, limit: int | None = None, include_duplicates: bool = False) -> DataFrame:
    """Assets by equality (an empty value filters nothing), duplicates left out unless asked for, in
    catalog order; a limit gives at least one row."""
    out = assets
    if not include_duplicates:
        out = out.where(~F.coalesce("is_duplicate", F.lit(False)))
    for c, v in (("source_id", source_id), ("series_id", series_id), ("chapter_id", chapter_id)):
        if v:
            out = out.where(F.col(c) == v)
    return out if limit is None else scan(out).limit(max(limit, 1))


def chapter_status(assets: DataFrame) -> DataFrame:
    """Per chapter of a catalog: pages, pages without a size (no readable image), status, first asset."""
    bad = F.col("width").isNull() | F.col("height").isNull()
    return assets.groupBy("source_id", "series_id", "chapter_id").agg(
        F.count("*").alias("pages"), F.count_if(bad).alias("page_errors"),
        F.min_by("asset_id", F.struct("page_index", "ord")).alias("first_asset_id"),
    ).withColumn("status", F.when(F.col("page_errors") == 0, "ok").when(F.col("page_errors") < F.col("pages"), "partial").otherwise("failed"))


def ingest_summary(chapters: DataFrame) -> DataFrame:
    n = lambda s: F.count_if(F.col("status") == s)
    return chapters.agg(
        n("ok").alias("succeeded_chapters"), n("partial").alias("partial_chapters"), n("failed").alias("failed_chapters"),
        F.coalesce(F.sum(F.col("pages") - F.col("page_errors")), F.lit(0)).alias("ingested_pages"), F.coalesce(F.sum("page_errors"), F.lit(0)).alias("page_errors"),
    )
