"""Sends the package to the executors, whose workers import it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package's source as a zip to the application, once; workers on any machine can
    then import it, wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    _SENT.add(app)
    home = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="genomill-ship-")) / "genomill.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(home.rglob("*.py")):
            z.write(p, f"{home.name}/{p.relative_to(home)}")
    spark.sparkContext.addPyFile(str(target))
