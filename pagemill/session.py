"""Session construction and shared-folder lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_OWN_DIR = "spark.pagemill.ownCheckpointDir"


def get_session(app: str = "pagemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every plan here assumes: UTC, AQE, Arrow."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in {**defaults, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: their path need not hold it."""
    sc = spark.sparkContext
    if getattr(sc, "_pagemill_shipped", False):
        return
    root = Path(__file__).parent
    to = Path(tempfile.mkdtemp(prefix="pagemill-code-"), "pagemill.zip")
    with zipfile.ZipFile(to, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent).as_posix())
    sc.addPyFile(str(to))  # served by the driver, fetched by every executor
    sc._pagemill_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only where the session names none (tests, a laptop) a folder of our own is made; on a
    cluster the setting has to be there, a machine-local folder would not survive an executor.
    """
    for key in ("spark.checkpoint.dir", _OWN_DIR):
        at = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
        if at:
            return at.rstrip("/")
    if not (spark.sparkContext.master or "").startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set: it has to name a folder that all executors share")
    at = "file://" + tempfile.mkdtemp(prefix="pagemill-")
    spark.conf.set(_OWN_DIR, at)
    return at


def _cuts(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/pagemill/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release_cuts(spark: SparkSession) -> None:
    """Delete all tables that :func:`cut_lineage` wrote for this application; frames that still
    start from them can't be read afterwards."""
    _delete(spark, _cuts(spark))


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The plan after the cut starts at files that outlive any executor, is computed once however
    often it is used, and has known sizes, so the planner can choose its joins from facts.
    """
    spark = df.sparkSession
    path = f"{_cuts(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._pagemill_path = path
    return out


def drop_cut(df: DataFrame) -> None:
    """Delete the files behind a frame from :func:`cut_lineage`; others are left alone."""
    path = getattr(df, "_pagemill_path", None)
    if path:
        _delete(df.sparkSession, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table of a data folder."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
