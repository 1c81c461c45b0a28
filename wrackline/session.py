"""Session helpers: table loading, staged intermediates and code shipping."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_STAGED: list[tuple[SparkSession, str]] = []
_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data directory (one Parquet file or folder each)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    It is only set here where the session has none and everything runs on one
    machine (tests, local runs); on a cluster a missing setting is an error, as
    executors could not read each other's machine-local folders.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="wrackline-stage-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        found = f"file://{path}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; it is dropped at exit."""
    path = f"{shared_dir(spark)}/wrackline/{label}-{uuid.uuid4().hex}"
    _STAGED.append((spark, path))
    return path


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    It cuts the lineage, so that a lost executor costs a re-read instead of a
    recomputation, and makes an intermediate that is used twice run once.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _drop_staged() -> None:
    for spark, path in _STAGED:
        try:
            hadoop = spark._jvm.org.apache.hadoop.fs
            target = hadoop.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001 - the JVM may be gone at exit
            pass
    _STAGED.clear()


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="wrackline-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = os.path.join(folder, "wrackline.zip")
    with zipfile.ZipFile(target, "w") as out:
        for at, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    out.write(full, os.path.join("wrackline", os.path.relpath(full, root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
