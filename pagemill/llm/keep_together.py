"""Problem 6: splits near given proportions in which no series is divided.

Method: largest differencing. Records that share a series (under any spelling), a page (its path)
or, with the catalog, an image (sha256) are connected, also through other records; every component
is a weight. The two heaviest partial partitions are merged again and again, the fullest bin of one
with the emptiest of the other, into many near-equal bins; whole bins then go to the splits. The
differencing runs per shard of components in parallel and, being a merge of partial partitions,
once more over the shards' results on the driver: ``bins`` numbers per ``shard_units`` components.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.text import strip
from pagemill.llm.graph import components
from pagemill.llm.split_overlap import clean_split, slash_path
from pagemill.session import cut_lineage

TARGETS = {"train": 0.80, "val": 0.10, "test": 0.10}


def clean_series(c: Column) -> Column:
    """One spelling: lower case, trimmed, ``-`` for ``_``; null for a blank one."""
    s = F.translate(F.lower(strip(c)), "_", "-")
    return F.when(s != "", s)


def difference(parts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Merge partial partitions (arrays of bin sums of one length) by largest differencing.

    Returns the final sums and, for each input, the final bin of each of its bins. Ties are broken
    by position, so equal inputs give equal results.
    """
    n = len(parts)
    bins = len(parts[0])
    # node: sums in descending order; perm[i][j] = position in the parent of the j-th bin of node i
    nodes = []
    perm: list[np.ndarray | None] = [None] * (2 * n - 1)
    parent = [-1] * (2 * n - 1)
    first_order = []
    for p in parts:
        order = np.argsort(-p, kind="stable")
        first_order.append(order)
        nodes.append(p[order])
    heap = [(-(s[0] - s[-1]), i) for i, s in enumerate(nodes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        sums = nodes[a] + nodes[b][::-1]
        order = np.argsort(-sums, kind="stable")
        place = np.empty(bins, dtype=np.int32)
        place[order] = np.arange(bins)
        new = len(nodes)
        nodes.append(sums[order])
        parent[a] = parent[b] = new
        perm[a], perm[b] = place, place[::-1].copy()
        heapq.heappush(heap, (-(nodes[new][0] - nodes[new][-1]), new))
        nodes[a] = nodes[b] = None  # type: ignore[call-overload]
    top = heap[0][1]
    to_top: list[np.ndarray | None] = [None] * len(nodes)
    to_top[top] = np.arange(bins, dtype=np.int32)
    for i in range(top - 1, -1, -1):  # parents come after their children
        to_top[i] = to_top[parent[i]][perm[i]]
    final = []
    for i, order in enumerate(first_order):
        m = np.empty(bins, dtype=np.int32)
        m[order] = to_top[i]
        final.append(m)
    return nodes[top], final


def singletons(weights: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest differencing of single weights: bin sums, and the bin of each weight."""
    parts = np.zeros((len(weights), bins))
    parts[:, 0] = weights
    sums, maps = difference(list(parts))
    return sums, np.array([m[0] for m in maps], dtype=np.int32)


def bins_to_splits(sums: np.ndarray, targets: dict[str, float]) -> list[str]:
    """Whole bins, heaviest first, each to the split that is furthest below its target."""
    total = float(sums.sum())
    left = {s: t * total for s, t in targets.items()}
    out = [""] * len(sums)
    for i in sorted(range(len(sums)), key=lambda i: (-sums[i], i)):
        s = max(left, key=lambda s: left[s])
        out[i] = s
        left[s] -= float(sums[i])
    return out


def records(manifest: DataFrame) -> DataFrame:
    """(unit_key, series_id, path, old): what ties each record. The key is its series, else its page."""
    series, path = clean_series(F.col("series_id")), slash_path(F.col("image_path"))
    rows = manifest.select(series.alias("series_id"), path.alias("path"), clean_split(F.col("split")).alias("old"))
    return rows.select(F.coalesce(F.concat(F.lit("series "), "series_id"), F.concat(F.lit("page "), "path"), F.lit("none")).alias("unit_key"), "series_id", "path", "old")


def ties(rows: DataFrame, assets: DataFrame | None) -> DataFrame:
    """(u, v): hashes of the keys that stand together in a record, of a page and of an image of it.

    Only what can tie keys: an image under several pages, a page with several such partners (its
    being a key itself counts as one)."""
    page = F.xxhash64(F.concat(F.lit("page "), "path")).alias("u")
    paths = rows.where("path is not null")
    out = paths.select(page, F.xxhash64("unit_key").alias("v")).distinct()  # a page without series is its own partner
    if assets is not None:
        images = assets.select(slash_path(F.col("image_path")).alias("path"), F.lower(F.trim("sha256")).alias("sha")).where("sha is not null").distinct().join(paths.select("path").distinct(), "path", "left_semi")
        images = cut_lineage(images.select(page, F.xxhash64(F.concat(F.lit("image "), "sha")).alias("v")), "p6-images")
        shared = images.groupBy("v").agg(F.count("*").alias("n")).where("n > 1").select("v")
        out = out.unionByName(images.join(shared, "v", "left_semi"))
    out = cut_lineage(out, "p6-ties")
    several = out.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    return out.join(several, "u", "left_semi")


def keep_together(manifest: DataFrame, assets: DataFrame | None = None, targets: dict[str, float] | None = None, bins: int = 100, shard_units: int = 20_000) -> DataFrame:
    """(unit, unit_key, series_id, records, old, bin, split): a row per series and per page without
    one; old is a map of the splits its records stand in now, with their number.

    Rows of one component have one ``unit`` and one split. ``assets`` is the catalog that knows the
    sha256 of a path; without it pages are tied by path alone. Records without series (null or
    blank) and path are one component. An empty table gives no rows. A component heavier than a
    split's target goes whole to the split furthest below its target.
    """
    targets = targets or TARGETS
    rows = records(manifest)
    counts = rows.groupBy("unit_key", "series_id", "old").agg(F.count("*").alias("n"))
    splits = F.map_from_entries(F.filter(F.collect_list(F.struct("old", "n")), lambda x: x["old"].isNotNull()))  # three entries at most
    keys = cut_lineage(counts.groupBy("unit_key", "series_id").agg(F.sum("n").alias("records"), splits.alias("old")), "p6-keys")
    roots = components(ties(rows, assets))
    node = F.xxhash64("unit_key")
    keys = cut_lineage(keys.withColumn("node", node).join(roots, "node", "left").select(F.coalesce("root", "node").alias("unit"), "unit_key", "series_id", "records", "old"), "p6-units")
    units = cut_lineage(keys.groupBy("unit").agg(F.sum("records").alias("records")), "p6-weights")
    shards = max(1, -(-units.count() // shard_units))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["records", "unit"], ascending=[False, True])
        _, where = singletons(pdf["records"].to_numpy(float), bins)
        return pd.DataFrame({"unit": pdf["unit"], "records": pdf["records"], "shard": pdf["shard"], "part": where})

    sharded = units.select("unit", "records", F.pmod(F.xxhash64("unit"), F.lit(shards)).cast("int").alias("shard"))
    placed = cut_lineage(sharded.groupBy("shard").applyInPandas(one, "unit long, records long, shard int, part int"), "p6-parts")
    sums = np.zeros((shards, bins))
    per = placed.groupBy("shard", "part").agg(F.sum("records").alias("n")).toPandas()
    sums[per["shard"].to_numpy(int), per["part"].to_numpy(int)] = per["n"]
    total, maps = difference(list(sums))
    split = np.array(bins_to_splits(total, targets), dtype=object)
    of = np.stack(maps).ravel()
    plan = pd.DataFrame({"shard": np.repeat(np.arange(shards), bins), "part": np.tile(np.arange(bins), shards), "bin": of, "split": split[of]})
    bound = placed.sparkSession.createDataFrame(plan, "shard int, part int, bin int, split string")
    return keys.join(placed.join(bound, ["shard", "part"]).select("unit", "bin", "split"), "unit").select("unit", "unit_key", "series_id", "records", "old", "bin", "split")


def divided(manifest: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """(series_id): series that stand in several splits now, so that the assignment brings records of
    them together: from two other splits, or from one other to records that stay."""
    others = F.size(F.filter(F.map_keys("old"), lambda s: s != F.col("split")))
    stays = F.map_contains_key("old", F.col("split"))
    return keep_together(manifest, assets).where(F.col("series_id").isNotNull() & ((others >= 2) | ((others >= 1) & stays))).select("series_id")


def shares(manifest: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """Per split: records and share that the assignment really gives, and the target."""
    per = keep_together(manifest, assets).groupBy("split").agg(F.sum("records").alias("records"), F.countDistinct("unit").alias("components"))
    total = F.sum("records").over(Window.partitionBy())  # over the three rows of per
    goal = F.element_at(F.create_map(*[x for s, t in TARGETS.items() for x in (F.lit(s), F.lit(t))]), F.col("split"))
    return per.select("split", "records", "components", (F.col("records") / total).alias("share"), goal.alias("target"))


def assigned_pages(manifest: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """(image_path, records, splits): per page its records and the number of splits they are assigned to."""
    placed = keep_together(manifest, assets).select("unit_key", "split")
    return records(manifest).where("path is not null").join(placed, "unit_key").groupBy(F.col("path").alias("image_path")).agg(F.count("*").alias("records"), F.countDistinct("split").alias("splits"))
