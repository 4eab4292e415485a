"""Shared storage for intermediate tables.

Intermediate tables go to the folder that the cluster names in ``spark.checkpoint.dir`` (or to
the warehouse, for bucketed tables), so that they outlive a lost executor. A folder of our own
is made only where that setting is absent and master and executors are one machine, as in tests; on a
cluster, its absence is an error.
"""

from __future__ import annotations

import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


#: What the running stage of a pipeline has kept for itself; each thread of the driver has its own.
_SCOPE: ContextVar[list[str] | None] = ContextVar("adsieve_scope", default=None)
_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    application = spark.conf.get("spark.app.id", "")
    if application not in _OWN:
        _OWN[application] = f"file://{tempfile.mkdtemp(prefix='adsieve-')}"
    return _OWN[application]


def keep(df: DataFrame, what: str, scoped: bool = True) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage and fixes its rows."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _note(spark, scoped, path)
    return spark.read.schema(df.schema).parquet(path)


def keep_bucketed(df: DataFrame, what: str, column: str, buckets: int) -> DataFrame:
    """The same in the warehouse, bucketed by ``column``: later joins on it don't shuffle this side."""
    spark = df.sparkSession
    name = f"adsieve_{what}_{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").bucketBy(buckets, column).format("parquet").saveAsTable(name)
    _note(spark, True, name)
    return spark.table(name)


def _note(spark: SparkSession, scoped: bool, kept: str) -> None:
    own = _SCOPE.get()
    if scoped and own is not None:
        own.append(kept)


def new_scope(spark: SparkSession) -> None:
    """Begin a stage: tables that the stage before kept for itself go, since its result is written by now."""
    for kept in _SCOPE.get() or ():
        if "/" in kept:
            path = spark._jvm.org.apache.hadoop.fs.Path(kept)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        else:
            spark.sql(f"DROP TABLE IF EXISTS {kept}")
    _SCOPE.set([])


def end_scope(spark: SparkSession) -> None:
    """Tables kept from now on belong to no stage."""
    _SCOPE.set(None)
