"""Makes this package importable in Python workers that don't have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application: the package's sources as a file that Spark gives to each executor."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="creatorlens-")) / f"{_PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as made:
        for file in sorted(_PACKAGE.rglob("*.py")):
            made.write(file, file.relative_to(_PACKAGE.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)
