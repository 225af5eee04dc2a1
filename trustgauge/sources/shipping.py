"""The package itself on the Python workers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the workers, as spark-submit --py-files would.

    Done once per session, before an operator that runs Python in tasks.
    """
    context = spark.sparkContext
    if any(PACKAGE.name in Path(name).name for name in context.listFiles):
        return
    target = str(Path(tempfile.mkdtemp(prefix="ship-")) / PACKAGE.name)
    context.addPyFile(shutil.make_archive(target, "zip", PACKAGE.parent, PACKAGE.name))
