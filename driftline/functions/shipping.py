"""Code that Python tasks need, sent along with the application."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package, so that tasks find it wherever the driver was started.

    Sent once per application. A cluster that has the package installed runs the same code.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="spark-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)
