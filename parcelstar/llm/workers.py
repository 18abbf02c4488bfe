"""What the Python workers of a session need: the package's code, and batches of bounded size."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Bytes of rows sent to a worker at a time; the default is four times as much.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "16m")

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Send the package to the executors, once per application, and bound the batches."""
    context = spark.sparkContext
    spark.conf.set(*BATCH)
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
