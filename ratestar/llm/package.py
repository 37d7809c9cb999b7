"""Makes this package known to Python tasks."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> None:
    """Send the package's sources to all executors, once for each Spark context.

    Functions that run in Python tasks are looked up by module name there. Where
    the package isn't installed on the executors, this stands for --py-files.
    """
    context = spark.sparkContext
    if getattr(context, "_shipped_package", None) == str(_ROOT):
        return
    folder = tempfile.mkdtemp(prefix="package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/{_ROOT.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(_ROOT.rglob("*.py")):
            archive.write(source, source.relative_to(_ROOT.parent))
    context.addPyFile(path)
    context._shipped_package = str(_ROOT)
