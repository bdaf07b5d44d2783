"""Shared helpers: the cluster's shared folder, written tables, checked broadcasts."""

from __future__ import annotations

import atexit
import gc
import os
import re
import shutil
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of a word: anything but space and \\t \\n \\v \\f \\r.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of a batch that goes to a Python worker, about; a longer row comes alone.
BATCH_BYTES = 8 << 20
#: Paths of written tables that are still there.
_LEFT: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where that is unset, a folder of this process under /tmp serves a local
    master. On a cluster it can't, since every machine would write to its own disk,
    so that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (found or f"/tmp/chatloom-shared-{os.getpid()}").rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/chatloom/{name}-{uuid.uuid4().hex}"
    _LEFT.add(path)
    return path


def delete(path: str) -> None:
    """Delete a folder that ``new_path`` named."""
    _LEFT.discard(path)
    if path.startswith(("/", "file:")):
        shutil.rmtree("/" + re.sub(r"^file:/*", "", path).lstrip("/"), ignore_errors=True)
    elif SparkContext._jvm is not None:
        p = SparkContext._jvm.org.apache.hadoop.fs.Path(path)
        active = SparkContext._active_spark_context
        conf = active._jsc.hadoopConfiguration() if active else SparkContext._jvm.org.apache.hadoop.conf.Configuration()
        p.getFileSystem(conf).delete(p, True)


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The frame, written to the shared folder and read again: lineage ends there,
    so a lost executor costs a reread and not a recomputation. What isn't discarded
    is deleted when the driver's process ends."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._chatloom_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what ``written`` wrote, once nothing will read it any more: no frame still to be run, and no shuffle
    that a lost executor may make Spark repeat."""
    for df in frames:
        path = getattr(df, "_chatloom_path", None)
        if path:
            delete(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing refers to any more,
    now and not when the driver next happens to collect its garbage.

    A small query goes first, as the threads of the last one still refer to its plan until they run another.
    """
    spark.range(64).repartition(16).write.format("noop").mode("overwrite").save()
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark the frame for broadcast only if it is counted to have ``max_rows`` at most."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def in_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` over batches of bounded bytes. The bound is a setting of the session, which is only ever lowered."""
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(-?\d+)b?", spark.conf.get(key))
    if not now or not 0 < int(now[1]) <= BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")
    return df.mapInArrow(run, schema)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def position(df: DataFrame, name: str) -> int:
    """Where the column stands. A column of exactly that name counts before one that differs in case, and the first of several before the others;
    ValueError if there is none."""
    names = df.columns
    if name in names:
        return names.index(name)
    same = [i for i, c in enumerate(names) if c.lower() == name.lower()]
    if not same:
        raise ValueError(f"no column {name!r} among {names}")
    return same[0]


def numbered(df: DataFrame) -> DataFrame:
    """The frame with columns c0, c1, ..., which no name can clash with."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def with_columns_of(df: DataFrame, needed: dict[str, str]) -> DataFrame:
    """The needed columns alone, cast. Other columns may have any names; ValueError if a needed one is missing."""
    at = {c: position(df, c) for c in needed}
    plain = numbered(df)
    return plain.select(*[F.col(f"c{at[c]}").cast(t).alias(c) for c, t in needed.items()])


def remainder(col: str, n: int):
    """crc32 of the id as text, mod n; null for a null id."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def _clean() -> None:
    for path in list(_LEFT):
        try:
            delete(path)
        except Exception:  # noqa: BLE001  the gateway may be gone
            _LEFT.discard(path)
    shutil.rmtree(f"/tmp/chatloom-shared-{os.getpid()}", ignore_errors=True)


atexit.register(_clean)

__all__ = ["WORD", "T", "delete", "discard", "free_shuffles", "in_batches", "new_path", "numbered", "position", "remainder", "shared_dir", "small", "text_or_empty", "with_columns_of", "written"]
