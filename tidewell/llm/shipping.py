"""Makes the package importable for the Python workers of a session that was started elsewhere."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Hands the package's source to the session once; Spark brings it to each executor."""
    context = spark.sparkContext
    if getattr(context, "_tidewell_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tidewell-code-")) / "tidewell.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tidewell_shipped = True
