"""A session with the settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def build(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC time zone and adaptive execution; everything else as the cluster sets it."""
    b = SparkSession.builder.appName("chatloom").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def spread(df: DataFrame) -> DataFrame:
    """The frame, dealt out anew if it has fewer partitions than the cluster has cores.

    For steps that compute much from few rows, such as the shingles of a table of one file; a large table
    has partitions enough and isn't moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
