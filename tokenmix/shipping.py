"""Makes this package importable in Python workers, wherever the driver has it from."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession | None = None) -> None:
    """Adds the package's sources to the context once."""
    spark = spark or SparkSession.getActiveSession()
    sc = spark.sparkContext
    if getattr(sc, "_tokenmix_shipped", None):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tokenmix-"), "tokenmix_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._tokenmix_shipped = path
