"""Python workers need this package: it is sent to them once for each Spark context."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send the package's source, zipped, to all executors, now and later ones."""
    context = spark.sparkContext
    if getattr(context, "_has_tessera", False):
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="tessera-")) / "tessera.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as held:
        for source in sorted(root.rglob("*.py")):
            held.write(source, Path("tessera") / source.relative_to(root))
    context.addPyFile(str(path))
    context._has_tessera = True
