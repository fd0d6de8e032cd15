"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_SPARK_DEFAULT, _JIT_LIMIT = "65535", "8000"


def tune(spark: SparkSession) -> SparkSession:
    """Adapt a running session to the wide parse projection.

    HotSpot does not compile a method of more than 8,000 bytes of bytecode. The parse and its
    metrics make longer ones, which would run interpreted; with the limit at 8,000 Spark falls
    back to code it splits into smaller methods. A value of the user's own is left alone.
    """
    if spark.conf.get(_METHOD_LIMIT) == _SPARK_DEFAULT:
        spark.conf.set(_METHOD_LIMIT, _JIT_LIMIT)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor reaches")
    root = tempfile.mkdtemp(prefix="logtally-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path under the shared root; nothing is created yet. It goes when the driver's JVM ends."""
    folder = f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
    remove_later(spark, folder)
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def remove_later(spark: SparkSession, folder: str) -> None:
    """Remove a folder when the driver's JVM ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
