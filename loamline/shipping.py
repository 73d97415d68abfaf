"""Makes this package importable on executors that were started without it."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's sources to the session's workers once, through Spark's own file server."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = Path(__file__).resolve().parent
    if str(root.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    folder = tempfile.mkdtemp(prefix="loamline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/loamline", "zip", root.parent, root.name))
