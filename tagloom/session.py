"""Session helpers shared by every operator: table access and lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """Make sure that reliable checkpoints have a folder and return it.

    The folder named by ``spark.checkpoint.dir`` is used whenever it is set. Only a local
    session without that setting (tests) gets a temporary one; on a cluster a machine-local
    folder would not survive the loss of an executor, so that case is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
    elif sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` on all cores where its files give fewer partitions than that; unchanged otherwise.

    For scans whose work per row is large. A big table has more splits than cores and no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def extended(df: DataFrame, columns: str) -> StructType:
    """The schema of ``df`` with more columns in DDL behind it."""
    return StructType([*df.schema.fields, *StructType.fromDDL(columns).fields])


def with_totals(df: DataFrame, keys: list[str], **totals: Column) -> DataFrame:
    """``df`` with aggregates of the rows of each key, keys not null.

    The aggregate combines before its shuffle and has one row for each key, so no task holds all rows
    of a key as a window over it would; a hot key is left to the adaptive skew join.
    """
    return df.join(df.groupBy(*keys).agg(*[c.alias(name) for name, c in totals.items()]), keys)
