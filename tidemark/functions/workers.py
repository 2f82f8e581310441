"""This package for Python workers that don't find it on their own path."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


@functools.cache
def _ship(application: str, spark: SparkSession) -> None:
    package = Path(__file__).resolve().parents[1]
    # Spark serves the file to the executors; nothing else reads this folder.
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, str(f.relative_to(package.parent)))
    spark.sparkContext.addPyFile(path)


def ship(spark: SparkSession) -> None:
    _ship(spark.sparkContext.applicationId, spark)
