"""Reading tables and cutting lineage in a way that holds on a cluster."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` of a data directory; columns are pruned at the scan by the query that uses it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str | None:
    """The folder of spark.checkpoint.dir, one of its own on a single machine, None on a cluster that names no folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            return None
        sc.setCheckpointDir(named or _own_folder())
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read from there, so that it is computed once.

    A cluster without such a folder computes df again instead of trusting one that its executors may not share.
    """
    return df if shared_folder(df.sparkSession) is None else df.checkpoint(eager=True)


def _own_folder() -> str:
    """A folder of this process on its own machine, gone when the process ends."""
    made = tempfile.mkdtemp(prefix="leafquarry-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    return made
