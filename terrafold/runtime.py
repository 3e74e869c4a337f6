"""What every run needs from the session."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Gives executors this package (once for each session), so that Python operators can run on
    machines where it isn't installed."""
    context = spark.sparkContext
    if getattr(context, "_terrafold_shipped", False):
        return
    top = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="terrafold-"), "terrafold.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    context.addPyFile(path)
    context._terrafold_shipped = True
