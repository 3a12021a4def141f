"""Asking, for many fingerprints at once, which of them occur elsewhere in a corpus.

Documents are stored in batches of about two megabytes, each a row of a table that is bucketed by
batch, so later passes meet their batch without moving a text. What a pass finds out about its batch
is kept in the same way and forgotten as soon as no later pass reads it. A pass sends the distinct
fingerprints of a batch, sorted and packed by bucket of the hash, to where that bucket is counted;
back come flags in the same order. A fingerprint counts once per batch however often the batch has
it, so a passage in a third of all documents loads no bucket more than any other. The number of
buckets follows the size of the corpus.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from stratalake.functions.shipping import by_value
from stratalake.llm.common import stage
from stratalake.llm.text_bytes import bytes_of, pieces
from stratalake.session import discard, scratch_dir

#: Text bytes whose fingerprints meet in one bucket.
BYTES_PER_BUCKET = 8_000_000
SENT = "bucket int, batch long, packed binary"


class Batches:
    """Documents as ``batch, bytes, ids, texts``, in the cluster's shared folder."""

    def __init__(self, docs: DataFrame, id_column: str, text_column: str):
        self.spark: SparkSession = docs.sparkSession
        rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
        self.id_type = rows.schema["id"].dataType
        schema = StructType(
            [
                StructField("batch", LongType()),
                StructField("bytes", LongType()),
                StructField("ids", ArrayType(self.id_type)),
                StructField("texts", ArrayType(StringType())),
            ]
        )
        self.partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.kept: dict[str, tuple[str, str]] = {}
        self.texts = self.keep(rows.mapInArrow(by_value(in_batches), schema), "text-batches")
        total = self.texts.agg(F.sum("bytes")).first()[0] or 0
        wanted = max(total // BYTES_PER_BUCKET, self.partitions)
        #: Leading bits of a hash that name its bucket.
        self.bits = int(wanted).bit_length()

    def keep(self, rows: DataFrame, label: str) -> DataFrame:
        """Write rows by ``batch`` in the batches' own buckets: no join by batch moves them."""
        name, path = f"{label.replace('-', '_')}_{uuid.uuid4().hex}", scratch_dir(self.spark, label)
        rows.write.bucketBy(self.partitions, "batch").option("path", path).saveAsTable(name)
        self.kept[label] = name, path
        return self.spark.table(name)

    def forget(self, label: str) -> None:
        """Free the disk of rows that were kept and that nothing reads any more."""
        name, path = self.kept.pop(label)
        self.spark.sql(f"DROP TABLE {name}")
        discard(self.spark, path)

    def run(self, function: Callable, schema, *replies: DataFrame) -> DataFrame:
        """``function`` over the batches, each beside its row of every reply."""
        rows = self.texts
        for reply in replies:
            rows = rows.join(reply, "batch", "left")
        return rows.mapInArrow(by_value(function), schema)


def in_batches(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for got in arrived:
        _, bounds = bytes_of(got["text"])
        for first, last in pieces(bounds):
            some = got.slice(first, last - first)
            ends = pa.array([0, last - first], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([int(bounds[last] - bounds[first])], pa.int64()),
                    pa.ListArray.from_arrays(ends, some["id"]),
                    pa.ListArray.from_arrays(ends, some["text"]),
                ],
                ["batch", "bytes", "ids", "texts"],
            )
            number += 1


class Distinct:
    """The distinct fingerprints among ``keys`` (one or more arrays of 64 bits), in order."""

    def __init__(self, *keys: np.ndarray):
        order = np.lexsort(keys[::-1])
        self.sorted = [k[order] for k in keys]
        new = np.ones(len(order), bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in self.sorted], axis=0)
        starts = np.flatnonzero(new)
        self.keys = [k[new] for k in self.sorted]
        self.counts = np.diff(np.append(starts, len(order)))
        #: For each of the given fingerprints, its place among the distinct ones.
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.cumsum(new) - 1
        #: For each distinct fingerprint, the place of one that was given.
        self.given = order[starts]

    def packed(self, bits: int, batch: int, schema: pa.Schema) -> pa.RecordBatch:
        """A row per bucket that has any."""
        buckets = (self.keys[0] >> np.uint64(64 - bits)).astype(np.int64)
        names, starts = np.unique(buckets, return_index=True)
        ends = np.append(starts, len(buckets))[1:]  # none without fingerprints
        rows = [
            b"".join(k[s:e].tobytes() for k in self.keys) for s, e in zip(starts, ends, strict=True)
        ]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.int32()),
                pa.array(np.full(len(names), batch), pa.int64()),
                pa.array(rows, pa.binary()),
            ],
            schema=schema,
        )


def answers(flags, n: int) -> np.ndarray:
    """Flags of a batch's distinct fingerprints, from its reply (null where it sent none)."""
    if flags is None:
        return np.zeros(n, np.uint8)
    rows = sorted(flags, key=lambda r: r["bucket"])
    return np.concatenate([np.frombuffer(r["flags"], np.uint8) for r in rows])


def elsewhere(width: int, hot: int = 0):
    """Flags of a bucket's fingerprints of ``width`` numbers: 0 in one batch only, else 1.

    The first batch that has a repeated one gets 2. With ``hot``, those in more batches get 3.
    """

    def counted(bucket: pa.Table) -> pa.Table:
        rows = [np.frombuffer(r, np.uint64) for r in bucket["packed"].to_pylist()]
        sizes = np.array([len(r) // width for r in rows])
        keys = [
            np.concatenate([r[i * n : (i + 1) * n] for r, n in zip(rows, sizes, strict=True)])
            for i in range(width)
        ]
        owner = np.repeat(bucket["batch"].to_numpy(), sizes)
        order = np.lexsort((owner, *keys[::-1]))
        new = np.ones(len(order), bool)
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
        group = np.cumsum(new) - 1
        held = np.bincount(group)[group]
        found = (held > 1).astype(np.uint8)
        found[new & (held > 1)] = 2
        if hot:
            found[held > hot] = 3
        flags = np.empty(len(order), np.uint8)
        flags[order] = found
        cuts = np.append(0, np.cumsum(sizes))
        return pa.table(
            {
                "bucket": bucket["bucket"],
                "batch": bucket["batch"],
                "flags": pa.array(
                    [flags[s:e].tobytes() for s, e in zip(cuts[:-1], cuts[1:], strict=True)],
                    pa.binary(),
                ),
            }
        )

    return counted


def reply(sent: DataFrame, counted: Callable, name: str) -> DataFrame:
    """``batch`` and, as ``name``, all that its buckets answer."""
    back = sent.groupBy("bucket").applyInArrow(
        by_value(counted), "bucket int, batch long, flags binary"
    )
    back = back.groupBy("batch").agg(F.collect_list(F.struct("bucket", "flags")).alias(name))
    return stage(back, name)


SENT_SCHEMA = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("packed", pa.binary())])
BINARY = BinaryType()
