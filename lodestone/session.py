"""Sessions, and this package on the executors."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lodestone")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Put this package on the path of the application's Python workers, once, wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="lodestone-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    packed = os.path.join(folder, f"{root.name}.zip")
    with zipfile.ZipFile(packed, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(packed)
    _SHIPPED.add(app)


def shipped(query):
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str):
        ship(spark)
        return query(spark, sf_dir)

    return run
