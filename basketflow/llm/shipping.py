"""Make this package importable in Python workers, as ``--py-files`` does."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


# Rows of an Arrow batch. Texts are long, and a worker holds a batch several times over.
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per application, and keep batches small.

    The archive is made on the driver and served by it; executors fetch it like any other file
    a job brings along.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="basketflow-src-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
