"""Make this package importable where Python tasks run."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once a session.

    Not where driver and executors are one process that finds it by PYTHONPATH or working folder."""
    root, name = os.path.split(PACKAGE)
    app, master = spark.sparkContext.applicationId, spark.sparkContext.master
    if app in _shipped:
        return
    _shipped.add(app)
    if master.startswith("local") and not master.startswith("local-cluster"):
        paths = [os.path.realpath(x) for x in os.environ.get("PYTHONPATH", "").split(os.pathsep) if x]
        if root in paths or os.path.isdir(os.path.join(os.getcwd(), name)):
            return
    base = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="ship-")), name)
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", root, name))
