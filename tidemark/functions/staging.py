"""Stage tables: results written once to shared storage and read back.

A stage table cuts the lineage (a lost executor re-reads files instead of
re-running the upstream joins), gives later reads column pruning and filter
pushdown, and is never kept on a single machine of a cluster.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


@contextlib.contextmanager
def _set(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Session settings for a while."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: A table is written once, so that the files of its shuffles go with the write and not when the driver collects garbage.
_ONCE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def stage(
    df: DataFrame,
    name: str = "stage",
    options: Mapping[str, str] | None = None,
    settings: Mapping[str, str] | None = None,
) -> DataFrame:
    """Write ``df`` as Parquet in the work folder and return a scan of it.

    ``options`` are those of the writer, ``settings`` those of the session while it writes.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with _set(spark, {**_ONCE, **(settings or {})}):
        df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
