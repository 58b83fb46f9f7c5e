"""Make the package importable by the Python workers of any session."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import riskweave

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the session's Python files, once an application.

    The same as ``--py-files`` with a zip: Spark hands the driver's copy to
    every executor.
    """
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    root = os.path.dirname(os.path.abspath(riskweave.__file__))
    handle, path = tempfile.mkstemp(prefix="riskweave-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("riskweave", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _sent.add(sc.applicationId)
