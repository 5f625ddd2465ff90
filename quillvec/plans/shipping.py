"""Makes the package importable in Python workers."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import quillvec
from quillvec.storage import new_dir, write_once

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give executors a copy of this package, once per application, by way of the shared folder."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    home = Path(quillvec.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for source in sorted(home.rglob("*.py")):
            z.write(source, source.relative_to(home.parent))
    path = f"{new_dir(spark, 'package')}/{home.name}.zip"
    write_once(spark, path, packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
