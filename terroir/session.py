"""Settings that the session needs for this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies, whatever folder the driver was started in.

    On a cluster whose machines don't share that folder, ship the package with ``--py-files``.
    """
    held = spark.sparkContext.environment
    paths = [p for p in held.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        held["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
