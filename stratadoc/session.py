"""What a session needs so that executors can import this package."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors, unless their Python path has it already; once for each Spark context."""
    root = os.path.realpath(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    context = spark.sparkContext
    if root in {os.path.realpath(p) for p in known if p} or getattr(context, "_stratadoc_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="stratadoc-zip-")  # the driver serves this file itself
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(os.path.join(folder, "stratadoc"), "zip", root, "stratadoc"))
    context._stratadoc_shipped = True
