"""The package itself, sent to the executors."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from .cut import app_dir

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package wherever they and the driver run: once per application, its modules are
    put as a zip into the shared folder and added to the session's Python files."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    package, held = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{app_dir(spark)}/{package.name}.zip")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    out.write(held.getvalue())
    out.close()
    sc.addPyFile(path.toString())
    _sent.add(sc.applicationId)
