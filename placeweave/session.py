"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast by hint only when it was counted and holds at most this many rows.
BROADCAST_ROWS = 100_000

# Settings a cluster session should carry: adaptive execution splits hot join
# partitions and sizes broadcasts from measured, not guessed, row counts.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A single-JVM session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("placeweave")
    settings = {
        **SCALE_SETTINGS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new path below the cluster's shared checkpoint folder.

    Only where ``spark.checkpoint.dir`` is unset and the master is local (tests) does a local
    temporary folder stand in: on a cluster other machines could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors reach (master: {master})")
        base = _local_folder()
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _in_use.append(path)
    return path


# Scratch folders handed out and not yet deleted.
_in_use: list[str] = []


@contextlib.contextmanager
def scratch_released(spark: SparkSession) -> Iterator[None]:
    """Delete at the end every scratch folder that was handed out inside; results must be written by then."""
    before = len(_in_use)
    try:
        yield
    finally:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for name in _in_use[before:]:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
        del _in_use[before:]


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="placeweave-")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder and read again: a columnar table, of which later uses read what they need.

    Cuts the lineage, and its source is read once.
    """
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pinned(df: DataFrame) -> DataFrame:
    """Checkpoint ``df``, so that every later use sees the same rows.

    Meant for small tables whose recomputation may differ in detail (sketches).
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def few_rows(stored: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a pinned frame holds at most ``rows`` rows."""
    return stored.limit(rows + 1).count() <= rows


def counted_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` pinned, and marked for broadcast if it proves to hold at most ``rows`` rows.

    For per-group statistics that a large table is joined with: a handful of groups then costs no
    shuffle of the large table; any number of groups still works, by a shuffled join.
    """
    stored = pinned(df)
    return F.broadcast(stored) if few_rows(stored, rows) else stored
