"""Sending this package to the Python workers of a cluster whose machines do not hold it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

NAME = "changeledger_code.zip"


def ship(spark: SparkSession) -> None:
    """Adds the package to the session's Python files, once."""
    sc = spark.sparkContext
    if any(p.endswith(NAME) for p in sc._python_includes):
        return
    root, path = Path(__file__).resolve().parent, f"{tempfile.mkdtemp(prefix='changeledger-')}/{NAME}"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for p in sorted(root.rglob("*.py")):
            out.write(p, f"{root.name}/{p.relative_to(root)}")
    sc.addPyFile(path)
