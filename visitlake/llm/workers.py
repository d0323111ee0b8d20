"""Making this package known to Spark's Python workers."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent.parent)


def importable(spark: SparkSession) -> SparkSession:
    """Put the library's folder on the path of workers started from now on.

    On a cluster the library is installed on the executors or shipped with the job, and
    a folder that they do not have is passed over.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark
