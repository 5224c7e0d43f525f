"""Makes the package importable in Python workers started from a checkout."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

import tidemark


def ensure(spark: SparkSession) -> None:
    """Put the checkout on the workers' path.

    On a cluster the package is installed or given with ``--py-files``; this
    covers sessions that only extended ``sys.path`` in the driver.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(tidemark.__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
