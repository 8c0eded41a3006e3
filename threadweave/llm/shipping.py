"""The package's own code on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> None:
    """Give the session's executors the package, once: Python functions in a
    plan are found there by name, wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_threadweave_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="threadweave-code-")) / "threadweave.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(PACKAGE.rglob("*.py")):
            z.write(path, Path(PACKAGE.name) / path.relative_to(PACKAGE))
    context.addPyFile(str(archive))
    context._threadweave_shipped = True
