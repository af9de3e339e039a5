"""Python on the executors: the package reaches them, batches stay small."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

BATCH_ROWS = 2048
_SENT: set[str] = set()


def send(spark: SparkSession) -> None:
    """Send the package to the executors, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SENT:
        return
    top = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="corpuswash-code-")) / f"{top.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for source in sorted(top.rglob("*.py")):
            z.write(source, source.relative_to(top.parent))
    sc.addPyFile(str(target))
    _SENT.add(sc.applicationId)


def prepare(spark: SparkSession) -> None:
    """Send the package, and bound Arrow batches (texts may be long)."""
    send(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
