"""Session helpers: where to keep written intermediate results, how queries fail."""

from __future__ import annotations

import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# How Spark reports a query that failed while running, translated or not.
FAILURES = (PySparkException, Py4JJavaError)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    That folder is shared by all executors. Only in local mode, where the driver is the one
    executor, a new temporary folder stands in for a missing setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="stratalake-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch_dir`` gave, once nothing reads it any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
