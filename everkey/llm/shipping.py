"""Makes this package importable in Python workers, which may run on machines that do not have it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Hands the package's own source to the executors, once per application."""
    context = spark.sparkContext
    if getattr(context, "_everkey_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="everkey-source-")) / "everkey_source.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, Path(root.name) / file.relative_to(root))
    context.addPyFile(str(path))
    context._everkey_shipped = True
