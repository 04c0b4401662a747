"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN_FOLDER: dict[str, str] = {}
# Folders written since each ``scratch`` block began, the innermost block last.
_SCRATCH: list[list[str]] = []


def build_session(master: str | None = None, cores: int = 8, app_name: str = "storelens",
                  settings: dict[str, str] | None = None) -> SparkSession:
    """A session for local work; on a cluster use the session the cluster hands out."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in (settings or {}).items():
        builder = builder.config(name, value)
    if master:
        builder = (
            builder.master(master)
            .config("spark.sql.shuffle.partitions", str(cores))
            .config("spark.driver.memory", "8g")
            .config("spark.driver.bindAddress", "127.0.0.1")
            .config("spark.driver.host", "127.0.0.1")
        )
    return (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # A join whose partitions all prove small at run time hashes them instead of sorting both sides.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        # Recording a Python call site for every column operation doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may do without it: there every task shares the driver's disk, so a folder
    of our own is as good. Anywhere else a missing setting is an error, since a machine-local
    folder would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if "path" not in _OWN_FOLDER:
        _OWN_FOLDER["path"] = tempfile.mkdtemp(prefix="storelens-")
        atexit.register(shutil.rmtree, _OWN_FOLDER["path"], ignore_errors=True)
    return _OWN_FOLDER["path"]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Owns what ``write_once`` writes inside the block, and removes it at its end.

    A result that still reads such a folder must be written or collected before the block ends.
    """
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a reader over it.

    For a result that several later jobs must see unchanged: the lineage ends at the files, so a
    lost executor costs a re-read and no recomputation, and filters still reach the scan. Inside a
    ``scratch`` block the folder goes when the block ends; else it stays for the caller to remove.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
