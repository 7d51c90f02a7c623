"""Session helpers: table loading, checkpoints in the shared folder, shipping code to executors."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; fall back to a local folder only in local mode.

    Raises on a cluster without the setting: a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = os.path.join(tempfile.gettempdir(), "lexispark-checkpoints")
    sc.setCheckpointDir(configured)
    return configured


_WRITTEN: list[tuple[object, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the shared place, removed when the program ends or ``release`` is called."""
    path = f"{ensure_checkpoint_dir(spark)}/lexispark-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a compressed table in the shared folder and read it back.

    The plan is cut, later stages read columns they need, and the rows survive lost executors. Tables are removed when
    the program ends, or earlier by ``release``.
    """
    path = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def intermediates() -> Iterator[None]:
    """Tables written inside the block are removed at its end: results must have been read or written by then."""
    mark = len(_WRITTEN)
    try:
        yield
    finally:
        release(mark)


def release(mark: int = 0) -> None:
    """Remove the tables written since ``mark`` tables were there."""
    while len(_WRITTEN) > mark:
        spark, path = _WRITTEN.pop()
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session is gone; the folder is the cluster's to clean
            return


atexit.register(release)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file through Hadoop: a path of any file system the cluster knows."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Read one small file through Hadoop; None where there is none."""
    if not path_exists(spark, path):
        return None
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark._jvm.org.apache.commons.io.IOUtils.toString(target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target), "UTF-8")


def ship_package(spark: SparkSession) -> None:
    """Make this package's modules travel by value inside Python functions sent to executors.

    Executors need not have the package installed or share the driver's file system.
    """
    from pyspark import cloudpickle

    import lexispark

    cloudpickle.register_pickle_by_value(lexispark)
