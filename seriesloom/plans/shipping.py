"""Makes the package importable in Python workers wherever they run."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_done: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _done:
        return
    root = Path(__file__).resolve().parents[2]
    folder = Path(tempfile.mkdtemp(prefix="seriesloom-ship-"))
    tree = folder / "tree"
    shutil.copytree(root / "seriesloom", tree / "seriesloom", ignore=shutil.ignore_patterns("__pycache__"))
    archive = shutil.make_archive(str(folder / f"seriesloom_{app.replace('-', '_')}"), "zip", tree)
    spark.sparkContext.addPyFile(archive)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # executors that start late fetch it late
    _done.add(app)
