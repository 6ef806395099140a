"""Making this package importable in Python workers that do not have it installed."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source to the workers of this application, once; Spark serves the archive itself."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    folder = Path(tempfile.mkdtemp(prefix="tamarack-source-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    shutil.copytree(root, folder / "stage" / root.name, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(str(folder / f"{root.name}-source"), "zip", folder / "stage"))
    _shipped.add(context.applicationId)
