"""Incremental ingestion: a stream of page rows kept as an idempotent catalog.

An extension beside the batch operators: every micro-batch is upserted by asset_id (the last ord
wins), and each of its rows is marked with the first row of its content among all that came before
or with it. Content must be remembered for ever, so it is kept as a table of first rows and not as
streaming state. Both tables are divided into buckets by their key; a batch rewrites the buckets
that it touches and no others.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.catalog import upsert
from pagemill.session import cut_lineage, drop_cut, shared_dir

CONTENTS = "sha string, first struct<ord:bigint,asset_id:string>"
MARKS = "canonical_ord bigint, canonical string, duplicate boolean"


def page_stream(spark: SparkSession, path: str, schema: str, max_files: int = 64) -> DataFrame:
    """A file stream over parquet; ``path`` may be a folder or one file."""
    folder, _, name = path.rpartition("/")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return reader.parquet(path) if os.path.isdir(path) else reader.option("pathGlobFilter", name).parquet(folder)


class CatalogSink:
    """A catalog under a shared folder. The state after a batch, ``versions/<batch>``, names for each
    table and bucket the batch that wrote it. It is renamed into place once all parts are there; a
    batch that is replayed starts from the state before it and writes the same again, so a restart
    after a failure changes nothing. What only states before the last one name is deleted."""

    def __init__(self, spark: SparkSession, root: str | None = None, schema: str | None = None, buckets: int = 64):
        self.spark, self.root, self.schema, self.buckets = spark, root or f"{shared_dir(spark)}/catalog", schema, buckets

    def _path(self, name: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        p, fs = self._path("versions")
        names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n) for n in names if n.isdigit())

    def _state(self, version: int) -> dict[str, dict[str, int]]:
        return json.loads(self.spark.read.text(f"{self.root}/versions/{version}").collect()[0][0])

    def _commit(self, version: int, state: dict[str, dict[str, int]]) -> None:
        self.spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.root}/writing-{version}")
        (to, fs), (made, _), (folder, _) = self._path(f"versions/{version}"), self._path(f"writing-{version}"), self._path("versions")
        fs.mkdirs(folder)
        fs.delete(to, True)
        if not fs.rename(made, to):
            raise OSError(f"{made} could not be renamed to {to}")

    def _read(self, table: str, state: dict[str, int], schema: str, only: list[int] | None = None) -> DataFrame:
        paths = [f"{self.root}/{table}/batch={b}/bucket={k}" for k, b in state.items() if only is None or int(k) in only]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, table: str, rows: DataFrame, batch_id: int) -> None:
        rows.write.partitionBy("bucket").mode("overwrite").parquet(f"{self.root}/{table}/batch={batch_id}")

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int").alias("bucket")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        before = [v for v in self.versions() if v < batch_id]
        state = self._state(before[-1]) if before else {"catalog": {}, "contents": {}}
        plain = ", ".join(f"`{c}` {t}" for c, t in batch.dtypes)
        rows = cut_lineage(batch.withColumn("sha", F.lower("sha256")), "stream")  # read several times
        parts = {"contents": self._bucket(F.col("sha")), "catalog": self._bucket(F.col("asset_id"))}
        touched = {t: [r[0] for r in rows.where("sha is not null" if t == "contents" else "true").select(b).distinct().collect()] for t, b in parts.items()}  # the buckets at most
        known = self._read("contents", state["contents"], CONTENTS, touched["contents"]).withColumn("old", F.lit(True))
        own = rows.where("sha is not null").groupBy("sha").agg(F.min(F.struct("ord", "asset_id")).alias("first")).withColumn("old", F.lit(False))
        # what came first stays the first, also if a row of smaller ord comes late
        firsts = cut_lineage(known.unionByName(own).groupBy("sha").agg(F.max_by("first", "old").alias("first")), "stream-contents")
        self._write("contents", firsts.withColumn("bucket", parts["contents"]), batch_id)
        f, later = F.col("first"), (F.col("first.ord") != F.col("ord")) | (F.col("first.asset_id") != F.col("asset_id"))
        marked = rows.join(firsts, "sha", "left").select(
            *batch.columns, F.coalesce(f["ord"], F.col("ord")).alias("canonical_ord"), F.when(later, f["asset_id"]).alias("canonical"), F.coalesce(f["asset_id"] != F.col("asset_id"), F.lit(False)).alias("duplicate")
        )
        old = self._read("catalog", state["catalog"], f"{plain}, {MARKS}", touched["catalog"])
        self._write("catalog", upsert(old, marked).withColumn("bucket", parts["catalog"]), batch_id)
        new = {t: {**state[t], **{str(k): batch_id for k in touched[t]}} for t in parts}
        self._commit(batch_id, new)
        drop_cut(rows)
        drop_cut(firsts)
        self._forget(before[:-1], state)

    def _forget(self, versions: list[int], kept: dict[str, dict[str, int]]) -> None:
        """Delete earlier states, and the parts that the kept one does not name."""
        for v in versions:
            for t, of in self._state(v).items():
                for k, b in of.items():
                    if kept[t].get(k) != b:
                        p, fs = self._path(f"{t}/batch={b}/bucket={k}")
                        fs.delete(p, True)
            p, fs = self._path(f"versions/{v}")
            fs.delete(p, True)

    def latest(self) -> DataFrame:
        """The catalog after the last batch, with canonical_ord, canonical and duplicate."""
        versions = self.versions()
        if not versions:
            raise FileNotFoundError(self.root)
        state = self._state(versions[-1])["catalog"]
        schema = self.schema and f"{self.schema}, {MARKS}"
        paths = [f"{self.root}/catalog/batch={b}/bucket={k}" for k, b in state.items()]
        return self.spark.read.schema(schema).parquet(*paths) if schema else self.spark.read.parquet(*paths)


def ingest_available(stream: DataFrame, sink: CatalogSink, checkpoint: str) -> DataFrame:
    """Take in all that is there, then stop; the catalog after it."""
    q = stream.writeStream.foreachBatch(sink.write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return sink.latest()
