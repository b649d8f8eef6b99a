"""Reading the test tables and cutting lineage in a place every executor shares."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Make this package known to the workers, once for each context.

    Where PYTHONPATH names the package's folder the workers find it themselves; else the driver serves it to them.
    """
    context = spark.sparkContext
    if getattr(context, "_folianth_shipped", False):
        return
    context._folianth_shipped = True
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="folianth-"), "folianth.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, root))
    context.addPyFile(target)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a scale directory."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Only on one machine (a local master) a temporary folder is set where the session names none. On a cluster every executor would
    write to a disk of its own, so there a missing folder is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext.getCheckpointDir()
        if not context and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = context or os.path.join(tempfile.gettempdir(), f"folianth-{uuid.uuid4().hex[:8]}")
        spark.conf.set("spark.checkpoint.dir", found)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found


_made: list[str] = []


def clear_written(spark: SparkSession) -> int:
    """Delete the tables that operators of this process wrote to the shared folder; the number deleted. DataFrames that read them end here."""
    system = spark.sparkContext._jvm.org.apache.hadoop.fs
    done = 0
    while _made:
        path = system.Path(_made.pop())
        done += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return done


def written(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write as Parquet into the shared folder and read it again: columns can be pruned afterwards."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    _made.append(path)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
