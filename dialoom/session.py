"""Session helpers: table access, the shared checkpoint folder and size-checked broadcast data."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Rows a table may have to be turned into driver-side broadcast data (checked by ``bounded_rows``).
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: the cluster's ``spark.checkpoint.dir``; an own one where that is unset, in local mode alone.

    On a cluster a folder of one machine would lose what other executors write, so that an unset folder is an error.
    """
    sc = spark.sparkContext
    known = sc._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    path = spark.conf.get("spark.checkpoint.dir", "")
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="dialoom-checkpoints-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, so that later jobs neither recompute it nor depend on an executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_rows(df: DataFrame, bound: int = BROADCAST_ROWS) -> list | None:
    """All rows of ``df`` if there are at most ``bound``, else None; never more than ``bound + 1`` rows reach the driver."""
    rows = df.limit(bound + 1).collect()
    return rows if len(rows) <= bound else None


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Makes this package importable on the executors, once per application; Spark's file server hands it out."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    aside = tempfile.mkdtemp()
    atexit.register(shutil.rmtree, aside, ignore_errors=True)
    copy = Path(aside, "package", package.name)
    shutil.copytree(package, copy, ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(shutil.make_archive(f"{aside}/{package.name}", "zip", copy.parent))
    _SHIPPED.add(app)
