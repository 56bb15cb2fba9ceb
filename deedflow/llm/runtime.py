"""Shared plumbing: shipping Python code to executors and cutting lineage durably."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def ship(module: str) -> None:
    """Pickle the functions of ``module`` by value, so executors need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, which driver and executors share.

    Only a session that has none, on a local master, gets a temporary one; on a cluster a missing setting is
    an error.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if shared is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        shared = tempfile.mkdtemp(prefix="checkpoints-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared)
    return shared


def durable(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in the shared folder, its lineage cut.  Spark's cleaner removes the files."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch() -> Iterator[list[str]]:
    """Gathers the paths of the tables that are ``written`` inside, in order."""
    paths: list[str] = []
    _SCRATCH.append(paths)
    try:
        yield paths
    finally:
        _SCRATCH.remove(paths)


def dropped(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a compressed Parquet table in the shared folder, for large rows that are read more than once.

    The table lies beside the checkpoints and goes when that folder is cleared, or its path, that ``scratch`` gathers, is ``dropped``.
    """
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    for paths in _SCRATCH:
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def swept(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffles and checkpoints that nothing refers to any more.

    It learns of them when the driver collects garbage, which may be long after a large shuffle was read for the last time.
    """
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trim() -> None:
    """Give freed memory of a Python worker back to the system, as workers live on between tasks."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not glibc


def crc32_mod(column: str, modulus: int):
    """``crc32(column as text) mod modulus``; a null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Column names that ``df`` does not have, one for each stem."""
    taken, out = {c.lower() for c in df.columns}, []
    for stem in stems:
        name = f"__{stem}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


ship(__name__)
