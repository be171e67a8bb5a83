"""Tables written once in the cluster's shared folder and read again; joins whose hot keys can be split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recunify.session import scratch_path


def stage(df: DataFrame, name: str = "llm") -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """``left.join(right, on, how)`` where ``right`` comes from an aggregation by ``on``.

    Such a side arrives partitioned by the key, gets no exchange of its own,
    and adaptive execution then cannot split a hot key of ``left``.  Joining on
    a struct of the key makes Spark exchange both sides for the join.
    """
    a, b = left.withColumn("__key", F.struct(on)), right.withColumn("__key", F.struct(on)).drop(on)
    return a.join(b, "__key", how).drop("__key")
