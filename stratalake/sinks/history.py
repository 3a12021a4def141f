"""A versioned home for a Type-2 dimension on plain files.

Plain files know no MERGE, and a table cannot be overwritten while it is read. So each commit
writes its rows to a folder of its own, ``epochs/store_epoch=N/<is_current>=true|false``, and then
adds ``N`` to ``commits``. Readers take the current rows of the newest committed epoch and the
closed rows of all committed epochs: closed rows are written once and never copied, a commit
costs the current rows only, and a write that dies before its commit is invisible and is
overwritten when repeated. One writer at a time.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.scd2 import Scd2Spec
from stratalake.sinks.tables import counted
from stratalake.spec import quoted


EPOCH = "store_epoch"
COMMITS = "epoch bigint, stream string, batch bigint"


class HistoryStore:
    def __init__(self, spark: SparkSession, path: str, spec: dict[str, Any] | Scd2Spec):
        self.spark = spark
        self.spec = Scd2Spec.of(spec)
        self.epochs = path.rstrip("/") + "/epochs"
        self.commits = path.rstrip("/") + "/commits"
        self.batches = path.rstrip("/") + "/batches"
        self.late = path.rstrip("/") + "/late"
        none = spark.createDataFrame([], COMMITS)
        none.write.mode("ignore").parquet(self.commits)

    def folder(self, epoch: int) -> str:
        return f"{self.epochs}/{EPOCH}={epoch}"

    def latest(self) -> int | None:
        """The newest committed epoch, a single number; None for a store without commits."""
        commits = self.spark.read.schema(COMMITS).parquet(self.commits)
        return commits.agg(F.max("epoch")).first()[0]

    def applied(self, stream: str) -> int | None:
        """The newest batch of one stream that a commit holds."""
        commits = self.spark.read.schema(COMMITS).parquet(self.commits)
        return commits.filter(F.col("stream") == stream).agg(F.max("batch")).first()[0]

    def read(self) -> DataFrame:
        """The whole dimension as of the newest commit."""
        epoch = self.latest()
        if epoch is None:
            raise ValueError(f"nothing committed below {self.epochs}")
        flag = quoted(self.spec.is_current).cast("boolean")
        stored = self.spark.read.parquet(self.epochs)
        newest = flag & (F.col(EPOCH) == epoch)
        closed = ~flag & (F.col(EPOCH) <= epoch)
        columns = [c for c in stored.columns if c not in (EPOCH, self.spec.is_current)]
        return stored.filter(newest | closed).select(
            *[quoted(c) for c in columns], flag.alias(self.spec.is_current)
        )

    def current(self) -> DataFrame:
        """Current rows: reads their folder of the newest epoch and no other."""
        return self.read().filter(quoted(self.spec.is_current))

    def commit(
        self, rows: DataFrame, epoch: int, stream: str | None = None, batch: int | None = None
    ) -> int:
        """Store the new current rows and the newly closed ones as one epoch.

        An epoch already committed is left alone. ``stream`` and ``batch`` say which batch of
        which stream it holds, so that a repeated batch is known by its own number.
        """
        newest = self.latest()
        if newest is not None and epoch <= newest:
            return 0
        flag = self.spec.is_current
        laid_out, seen = counted(rows, [flag])
        laid_out.write.mode("overwrite").partitionBy(flag).parquet(self.folder(epoch))
        marker = self.spark.createDataFrame([(epoch, stream, batch)], COMMITS)
        marker.coalesce(1).write.mode("append").parquet(self.commits)
        return seen.get["records"]
