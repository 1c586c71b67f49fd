"""Problem 4: every new batch against all that arrived before, at a cost that follows the batch.

Method: graph index shards. The distinct codes of the history, and of each new batch, form
navigable small-world graphs of at most some ``shard_codes`` codes each; a graph's beam is widened
until it finds what an exhaustive search of stated test queries finds, and a graph for which no
beam does is searched exhaustively. A batch searches the shards before it and its own; all visited
codes are ranked by their exact distance. Every ``fanout`` batches the shards of single batches are
compacted into one, every ``fanout`` of these into one again, and so on. Rows with a known sha256 or
an equal code need no search: they are found by their key. In a stored index graphs are rows of a
table (codes, links, beam, recall), which serves any number of later batches. A query over the tables
alone (``repeats``) has all batches at once, so they are one run, compacted once: a query visits the graphs
of the history and of this run, in which only rows before it match. Each graph is built in the task that
searches it.

A shard of few graphs is searched in all of them. A larger one is routed: its codes are put, once
for each choice of ``ell`` of ``ell + radius`` blocks of bits, into the graph of the value of these
blocks. Codes within the radius agree in one choice at least, so a query visits one graph a choice.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import nsw
from pagemill.llm.hamming import BITS, _blocks, informative
from pagemill.session import cut_lineage

#: Codes that one graph holds, about.
SHARD_CODES = 65_000
#: Up to so many graphs of a shard all are searched; it is the number of choices with one block.
ALL_PARTS = 7
QUERY_BLOCK = 100_000
#: Most tasks of a search.
SEARCH_TASKS = 2_000
INDEX = "shard string, key string, sub int, low_batch int, high_batch int, size int, codes binary, links binary, ords binary, beam int, recall double"
Shard = tuple[str, int, int, int]


def page_rows(assets: DataFrame) -> DataFrame:
    """(ord, batch, sha, code); a null batch is history, rows without ord are left out."""
    return assets.where("ord is not null").select("ord", F.coalesce("batch_id", F.lit(0)).alias("batch"), F.lower(F.trim("sha256")).alias("sha"), informative(F.col("phash")).alias("code"))


def first_codes(rows: DataFrame) -> DataFrame:
    """(code, ord, batch) of the first row of each informative code."""
    return rows.where("code is not null").groupBy("code").agg(F.min(F.struct("ord", "batch")).alias("f")).select("code", "f.ord", "f.batch")


def lengths(last: int, fanout: int) -> list[int]:
    """Batches in a compacted shard of each level, up to ``last``."""
    out = [fanout] if fanout <= last else []
    while out and fanout > 1 and out[-1] * fanout <= last:
        out.append(out[-1] * fanout)
    return out


def shard_plan(sizes: dict[int, int], fanout: int, shard_codes: int) -> list[Shard]:
    """(name, low, high, parts) of every shard: history, single batches, compacted runs of batches.

    Batch 0 is the history. A run of a level exists once all of its batches have come. Parts are
    the graphs it takes, if each code is in one."""
    parts = lambda n: max(1, -(-n // shard_codes))
    last = max(sizes, default=0)
    out = [("h", 0, 0, parts(sizes.get(0, 0)))] if sizes.get(0) else []
    out += [(f"b{b}", b, b, parts(n)) for b, n in sorted(sizes.items()) if b > 0]
    for length in lengths(last, fanout):
        for low in range(1, last - length + 2, length):
            n = sum(sizes.get(b, 0) for b in range(low, low + length))
            if n:
                out.append((f"c{low}-{low + length - 1}", low, low + length - 1, parts(n)))
    return out


def visits(plan: list[Shard], batch: int, fanout: int) -> list[str]:
    """The shards that stand for everything up to and with ``batch``: history, the longest compacted
    runs of batches before it, then single batches up to itself."""
    names = {n for n, *_ in plan}
    out, at = ["h"], 1
    while at <= batch:
        whole = [n for n in lengths(batch - 1, fanout) if (at - 1) % n == 0 and at + n - 1 < batch]
        out.append(f"c{at}-{at + whole[-1] - 1}" if whole else f"b{at}")
        at += whole[-1] if whole else 1
    return [n for n in out if n in names]


def route(parts: int, radius: int) -> tuple[int, int]:
    """(ell, bits) of a shard: blocks that make a key and the bits of it that are used; 0, 0 if all
    graphs of the shard are searched."""
    if parts <= ALL_PARTS:
        return 0, 0
    bits = {ell: min((parts - 1).bit_length(), ell * (BITS // (ell + radius))) for ell in (1, 2, 3)}
    ell = min(bits, key=lambda e: comb(e + radius, e) * -(-parts // (1 << bits[e])))  # the fewest graphs to visit
    return ell, bits[ell]


def with_keys(df: DataFrame, routes: set[tuple[int, int]], radius: int) -> DataFrame:
    """``df`` (with code, ell, bits) once for each key of its code under its own route."""
    keys = F.array(F.lit("all"))
    for ell, bits in sorted(routes):
        if ell:
            blocks = _blocks(F.col("code"), ell + radius)
            each = []
            for k, choice in enumerate(combinations(range(ell + radius), ell)):
                value = F.lit(0).cast("bigint")
                for i in choice:  # the low bits of every block, in turn
                    value = F.shiftleft(value, -(-bits // ell)) + blocks[i].bitwiseAND(F.lit((1 << -(-bits // ell)) - 1))
                each.append(F.concat(F.lit(f"{k}-"), value.cast("string")))
            keys = F.when((F.col("ell") == ell) & (F.col("bits") == bits), F.array(*each)).otherwise(keys)
    return df.withColumn("key", F.explode(keys)).drop("ell", "bits")


def members(codes: DataFrame, plan: list[Shard], radius: int) -> DataFrame:
    """(shard, low, high, key, code, ord): the codes (code, ord, batch) once for each key of each of their shards."""
    of_batch = [(b, n, lo, hi, *route(p, radius)) for n, lo, hi, p in plan for b in range(lo, hi + 1)]  # a row per batch and level
    where = codes.sparkSession.createDataFrame(of_batch, "batch int, shard string, low int, high int, ell int, bits int")
    return with_keys(codes.join(F.broadcast(where), "batch").select("shard", "low", "high", "code", "ord", "ell", "bits"), {route(p, radius) for *_, p in plan}, radius)


def visitors(queries: DataFrame, pairs: list[tuple[int, str, int]], radius: int) -> DataFrame:
    """(shard, key, code, ord): the queries (code, ord, batch) once for each key under the route of each
    shard that is to meet their batch, by (batch, shard, parts)."""
    to = queries.sparkSession.createDataFrame([(b, n, *route(p, radius)) for b, n, p in pairs], "batch int, shard string, ell int, bits int")
    return with_keys(queries.join(F.broadcast(to), "batch").select("code", "ord", "shard", "ell", "bits"), {route(p, radius) for *_, p in pairs}, radius)


def built(pdf: pd.DataFrame, radius: int) -> tuple[nsw.Graph, np.ndarray, float]:
    """The tuned graph of (code, ord), the ord of each of its points, and its recall."""
    pdf = pdf.sort_values("ord")
    g = nsw.build(pdf["code"].to_numpy(np.int64).view(np.uint64).copy())
    g.beam, recall = nsw.tune(g, radius)
    return g, pdf["ord"].to_numpy(np.int64), recall


def build_index(codes: DataFrame, plan: list[Shard], radius: int = 6, shard_codes: int = SHARD_CODES) -> DataFrame:
    """The shard table of ``codes`` (code, ord, batch) under a plan, one task per graph. A key that
    more codes have than a graph should hold gets several graphs."""
    member = members(codes, plan, radius)
    subs = member.groupBy("shard", "key").agg(F.ceil(F.count("*") / shard_codes).cast("int").alias("subs"))
    member = member.join(subs, ["shard", "key"]).withColumn("sub", F.pmod(F.xxhash64("code"), F.col("subs")).cast("int")).drop("subs")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        g, ords, recall = built(pdf, radius)
        c, e = g.to_bytes()
        first = {k: pdf[k].iloc[:1] for k in ("shard", "key", "sub")}
        return pd.DataFrame({**first, "low_batch": pdf["low"].iloc[:1], "high_batch": pdf["high"].iloc[:1], "size": len(pdf), "codes": [c], "links": [e], "ords": [ords.tobytes()], "beam": g.beam, "recall": recall})

    return member.groupBy("shard", "key", "sub").applyInPandas(one, INDEX)


def earliest(g: nsw.Graph, ords: np.ndarray, qs: pd.DataFrame, radius: int) -> pd.DataFrame:
    """(ord, match_ord) of the queries of a graph for which it holds a row before them, the first of these."""
    mine = qs["ord"].to_numpy(np.int64)
    r, p = nsw.neighbours(g, qs["code"].to_numpy(np.int64).view(np.uint64), radius)
    ok = ords[p] < mine[r]
    return pd.DataFrame({"ord": mine[r[ok]], "match_ord": ords[p[ok]]}).groupby("ord", as_index=False)["match_ord"].min()


def search_all(codes: DataFrame, queries: DataFrame, plan: list[Shard], fanout: int, radius: int = 6, shard_codes: int = SHARD_CODES) -> DataFrame:
    """(ord, match_ord): for each query (code, ord, batch) that has one, the earliest row before it
    whose code is within the radius, as far as the graphs find it.

    The shards are those that stand after the last batch of the plan; a batch meets those that begin
    at or before it. Codes and queries go to the task of their graph, which builds, tunes and
    searches it, so graphs are neither stored nor sent. A graph is built once for each block of
    QUERY_BLOCK queries that visit it, and not at all without one."""
    standing = set(visits(plan, max((hi for _, _, hi, _ in plan), default=0) + 1, fanout))
    plan = [s for s in plan if s[0] in standing]
    batches = sorted({b for _, lo, hi, _ in plan for b in range(max(lo, 1), hi + 1)})
    member, q = members(codes, plan, radius), visitors(queries, [(b, n, p) for b in batches for n, lo, _, p in plan if lo <= b], radius)
    key = ["shard", "key"]
    graphs = member.groupBy(key).agg(F.ceil(F.count("*") / shard_codes).cast("int").alias("subs"))
    asked = q.groupBy(key).agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))
    graphs = cut_lineage(graphs.join(asked, key), "p4-graphs")  # a row per SHARD_CODES codes, about
    number = graphs.agg(F.sum(F.col("subs") * F.col("blocks"))).first()[0] or 0
    tasks = max(1, min(SEARCH_TASKS, 3 * number))

    def sent(df: DataFrame, sub, block) -> DataFrame:
        each = df.join(F.broadcast(graphs), key).withColumn("sub", sub).withColumn("block", block)
        # two graphs of one number would be one graph of more codes, which finds the same
        return each.select(F.xxhash64(*key, "sub", "block").alias("graph"), "code", "ord").repartition(tasks, "graph")

    count = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    member = sent(member, F.pmod(F.xxhash64("code"), F.col("subs")).cast("int"), count("blocks"))
    q = sent(q, count("subs"), F.pmod(F.xxhash64("code", F.lit(1)), F.col("blocks")).cast("int"))

    def one(qs: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
        if not len(qs) or not len(pdf):
            return pd.DataFrame({"ord": np.zeros(0, np.int64), "match_ord": np.zeros(0, np.int64)})
        g, ords = built(pdf, radius)[:2]
        return earliest(g, ords, qs, radius)

    found = q.groupBy("graph").cogroup(member.groupBy("graph")).applyInPandas(one, "ord long, match_ord long")
    return found.groupBy("ord").agg(F.min("match_ord").alias("match_ord"))


def search_pairs(index: DataFrame, queries: DataFrame, pairs: list[tuple[int, str, int]], radius: int) -> DataFrame:
    """``search_all`` in the graphs of a stored index, for the (batch, shard, parts) that are to meet. A
    graph goes to as many tasks as there are blocks of QUERY_BLOCK queries that visit it."""
    graphs = index.select("shard", "key", "sub")
    q = cut_lineage(visitors(queries, pairs, radius).join(graphs, ["shard", "key"]), "p4-visits")
    graph = ["shard", "key", "sub"]
    blocks = q.groupBy(graph).agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))
    q = q.join(blocks, graph).withColumn("block", F.pmod(F.xxhash64("code", F.lit(1)), F.col("blocks")).cast("int")).drop("blocks")
    ix = index.join(blocks, graph).select(*graph, "codes", "links", "ords", "beam", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def one(qs: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(qs) or not len(shard):
            return pd.DataFrame({"ord": np.zeros(0, np.int64), "match_ord": np.zeros(0, np.int64)})
        s = shard.iloc[0]
        return earliest(nsw.Graph.from_bytes(s["codes"], s["links"], int(s["beam"])), np.frombuffer(s["ords"], np.int64), qs, radius)

    found = q.groupBy(*graph, "block").cogroup(ix.groupBy(*graph, "block")).applyInPandas(one, "ord long, match_ord long")
    return found.groupBy("ord").agg(F.min("match_ord").alias("match_ord"))


def repeats(assets: DataFrame, radius: int = 6, fanout: int = 5, shard_codes: int = SHARD_CODES) -> DataFrame:
    """(ord, batch, match_ord, kind) for every row of batch 1 and later.

    kind is ``sha256``, ``phash`` (equal code), ``near`` or ``new``; match_ord is an earlier row of
    the same image, null for a new one. Null or uninformative phash and null sha256 match nothing;
    repeated rows are repeats of the first; an empty table gives no rows. The result is the same for
    every ``fanout``, which is that of a stored index.
    """
    rows = cut_lineage(page_rows(assets), "p4-rows")
    codes = cut_lineage(first_codes(rows), "p4-codes")
    sizes = {r["batch"]: r["n"] for r in codes.groupBy("batch").agg(F.count("*").alias("n")).collect()}  # one row per batch
    run = max([1, *sizes])  # all batches are there, so their compacted run is
    plan = shard_plan(sizes, run, shard_codes)
    shas = rows.where("sha is not null").groupBy("sha").agg(F.min("ord").alias("sha_ord"))
    new = cut_lineage(
        rows.where("batch >= 1")
        .join(shas, "sha", "left")
        .join(codes.select("code", F.col("ord").alias("code_ord")), "code", "left")
        .select("ord", "batch", "code", F.when(F.col("sha_ord") < F.col("ord"), F.col("sha_ord")).alias("sha_ord"), F.when(F.col("code_ord") < F.col("ord"), F.col("code_ord")).alias("code_ord")),
        "p4-new",
    )
    open_ = new.where("code is not null and sha_ord is null and code_ord is null").select("code", "ord", "batch")
    near = search_all(codes, open_, plan, run, radius, shard_codes)
    kind = F.when(F.col("sha_ord").isNotNull(), "sha256").when(F.col("code_ord").isNotNull(), "phash").when(F.col("match_ord").isNotNull(), "near").otherwise("new")
    return new.join(near, "ord", "left").select("ord", "batch", F.coalesce("sha_ord", "code_ord", "match_ord").alias("match_ord"), kind.alias("kind"))


def repeated(assets: DataFrame) -> DataFrame:
    """(ord): rows of batch 1 and later for which an earlier row is the same image."""
    return repeats(assets).where("kind != 'new'").select("ord")


def index_report(assets: DataFrame, radius: int = 6, fanout: int = 5, shard_codes: int = SHARD_CODES) -> DataFrame:
    """Per graph: shard, batches, size, beam (0: exhaustive) and its recall against exhaustive search."""
    codes = cut_lineage(first_codes(page_rows(assets)), "p4-codes")
    sizes = {r["batch"]: r["n"] for r in codes.groupBy("batch").agg(F.count("*").alias("n")).collect()}
    return build_index(codes, shard_plan(sizes, fanout, shard_codes), radius, shard_codes).select("shard", "key", "sub", "low_batch", "high_batch", "size", "beam", "recall")


class StoredIndex:
    """The index as tables under a folder that all executors share, fed batch by batch.

    ``keys``: (sha, code, ord) of what was accepted, a folder per batch; ``shards``: the graphs, a
    folder per shard. ``accept`` adds the batch's own shard and searches every stored shard that
    begins at or before the batch. A run of ``fanout`` batches is compacted into one shard once its
    last batch or a later one has come; a batch of the run that comes or comes again after that is
    merged into it. History is read only as graphs, and as the two key columns for exact repeats; its
    graphs are never built again. A batch that is given again (after a failure) is written again.

    A shard is built aside and renamed, and what it stands for is removed only after that, so a
    failure at any point leaves every code of the accepted batches in some shard. Two shards that
    hold the same codes do no harm and become one at the next ``accept``.
    """

    def __init__(self, spark: SparkSession, path: str, radius: int = 6, fanout: int = 5, shard_codes: int = SHARD_CODES):
        self.spark, self.path, self.radius, self.fanout, self.shard_codes = spark, path.rstrip("/"), radius, fanout, shard_codes

    def _list(self, kind: str) -> list[str]:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []

    def _drop(self, name: str) -> None:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def plan(self) -> list[tuple[str, int, int, int]]:
        """The stored shards: name, first and last batch, parts."""
        out = []
        for name in self._list("shards"):
            shard, low, high, parts = name.rsplit("_", 3)
            out.append((shard, int(low), int(high), int(parts)))
        return out

    def _folder(self, shard: tuple[str, int, int, int]) -> str:
        return f"{self.path}/shards/{'_'.join(map(str, shard))}"

    def _keys(self, before: int) -> DataFrame:
        names = [n for n in self._list("keys") if int(n.split("=")[1]) < before]
        schema = "sha string, code bigint, ord bigint"
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/keys/{n}" for n in names]) if names else self.spark.createDataFrame([], schema)

    def _move(self, name: str, to: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        a, b = path(f"{self.path}/{name}"), path(f"{self.path}/{to}")
        fs = a.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(b.getParent())
        if not fs.rename(a, b):
            raise OSError(f"{a} could not be renamed to {b}")

    def _add(self, codes: DataFrame, shard: str, low: int, high: int) -> None:
        n = codes.count()
        if n:
            one = (shard, low, high, max(1, -(-n // self.shard_codes)))
            name = "_".join(map(str, one))
            build_index(codes, [one], self.radius, self.shard_codes).write.mode("overwrite").parquet(f"{self.path}/building/{name}")
            for s in self.plan():
                if s[0] == shard:  # of an earlier delivery of the batch
                    self._drop(f"shards/{'_'.join(map(str, s))}")
            self._move(f"building/{name}", f"shards/{name}")

    def accept(self, assets: DataFrame, batch: int) -> DataFrame:
        """(ord, batch, match_ord, kind) of the rows of one batch, which then belong to the index.
        Batch 0 is the history: it is indexed, and all of it comes out as ``history``."""
        rows = cut_lineage(page_rows(assets).withColumn("batch", F.lit(batch)), "p4-batch")
        old = self._keys(batch)
        own = first_codes(rows)
        # only keys that the batch has are kept of the history before anything is grouped
        old_codes = old.select("code", "ord").join(own.select("code"), "code", "left_semi")
        fresh = cut_lineage(own.join(old_codes, "code", "left_anti"), "p4-fresh")  # codes that no graph holds yet
        self._add(fresh, "h" if batch == 0 else f"b{batch}", batch, batch)
        # after the graph: codes under the keys of a batch are taken to be in one
        rows.select("sha", "code", "ord").write.mode("overwrite").parquet(f"{self.path}/keys/batch={batch}")
        if batch == 0:
            return rows.select("ord", "batch", F.lit(None).cast("bigint").alias("match_ord"), F.lit("history").alias("kind"))
        named = rows.where("sha is not null").select("sha", "ord")
        shas = old.select("sha", "ord").join(named.select("sha").distinct(), "sha", "left_semi").unionByName(named).groupBy("sha").agg(F.min("ord").alias("sha_ord"))
        codes = old_codes.unionByName(own.select("code", "ord")).groupBy("code").agg(F.min("ord").alias("code_ord"))
        before = lambda c: F.when(F.col(c) < F.col("ord"), F.col(c)).alias(c)
        new = cut_lineage(rows.join(shas, "sha", "left").join(codes, "code", "left").select("ord", "batch", "code", before("sha_ord"), before("code_ord")), "p4-new")
        near = self._search(new.where("code is not null and sha_ord is null and code_ord is null").select("code", "ord", "batch"), batch)
        kind = F.when(F.col("sha_ord").isNotNull(), "sha256").when(F.col("code_ord").isNotNull(), "phash").when(F.col("match_ord").isNotNull(), "near").otherwise("new")
        out = cut_lineage(new.join(near, "ord", "left").select("ord", "batch", F.coalesce("sha_ord", "code_ord", "match_ord").alias("match_ord"), kind.alias("kind")), "p4-out")
        newest = max(int(n.split("=")[1]) for n in self._list("keys"))
        for length in lengths(newest, self.fanout):
            for run in sorted({(s[1] - 1) // length for s in self.plan() if s[0][0] != "h" and s[2] <= (s[1] - 1) // length * length + length}):
                if (run + 1) * length <= newest:
                    self.compact(run * length + 1, (run + 1) * length)
        return out

    def _search(self, queries: DataFrame, batch: int) -> DataFrame:
        """A shard of a whole run may hold later batches too: only rows before the asking one match."""
        held = [s for s in self.plan() if s[1] <= batch]
        if not held:
            return self.spark.createDataFrame([], "ord long, match_ord long")
        index = self.spark.read.schema(INDEX).parquet(*[self._folder(s) for s in held])
        return search_pairs(index, queries, [(batch, name, parts) for name, _, _, parts in held], self.radius)

    def compact(self, low: int, high: int) -> None:
        """One shard for a run of batches, from the codes that their graphs hold: those of single
        batches and those of a shard of the run that is there already."""
        held = [s for s in self.plan() if s[0][0] != "h" and low <= s[1] and s[2] <= high]
        if not held or (len(held) == 1 and held[0][0][0] == "c"):
            return
        names, version = {s[0] for s in held}, 1
        while (name := f"c{low}-{high}" + (f"v{version}" if version > 1 else "")) in names:
            version += 1

        def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for c, o, b in zip(pdf["codes"], pdf["ords"], pdf["low_batch"]):
                    yield pd.DataFrame({"code": np.frombuffer(c, np.int64), "ord": np.frombuffer(o, np.int64), "batch": b})

        stored = self.spark.read.schema(INDEX).parquet(*[self._folder(s) for s in held])  # a routed shard holds a code several times
        codes = first_codes(stored.select("codes", "ords", "low_batch").mapInPandas(unpack, "code bigint, ord bigint, batch int"))
        self._add(cut_lineage(codes, "p4-compact"), name, low, high)
        for s in held:
            self._drop(f"shards/{'_'.join(map(str, s))}")
