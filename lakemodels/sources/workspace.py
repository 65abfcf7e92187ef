"""Where staged data goes: a folder that every executor can reach.

The cluster names that folder in ``spark.checkpoint.dir``. Only a local-mode
session (tests) falls back to a temporary folder of its own.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """Root folder for staged tables and checkpoints of this session."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="lakemodels-")
    return _local_roots[context.applicationId]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def scratch_schema(spark: SparkSession, label: str = "scratch") -> str:
    """Create a new schema located in the shared folder and return its name."""
    name = f"lm_{label}_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{shared_dir(spark)}/{name}'")
    return name


def freeze(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder.

    The rows are fixed from here on, also when an executor is lost and a plan
    with a seeded or sampled step would otherwise be evaluated again.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(fresh_dir(spark, "checkpoint"))
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Store an intermediate table in the shared folder; its rows are fixed and survive lost executors."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder written by this library, on whatever store it lives."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="lakemodels-"), "lakemodels"),
        "zip",
        root_dir=os.path.dirname(package),
        base_dir=os.path.basename(package),
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
