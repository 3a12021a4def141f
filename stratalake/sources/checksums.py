"""Checksums of files as a tree of SHA-256 digests, read in ranges by many tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.shipping import by_value
from stratalake.sources.files import file_system

RANGE_BYTES = 64 << 20
FANOUT = 256
READ_BYTES = 1 << 20


def file_checksums(
    spark: SparkSession, files: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT
) -> DataFrame:
    """``(file_path, checksum)`` of files listed by ``discover_files``.

    A file of one range has its SHA-256, as any tool prints it. A longer one is cut into ranges of
    ``range_bytes``; ``fanout`` consecutive digests, written as hex, are hashed to one of the next
    level, twice, and then all that are left. So no task reads more than a range of a long file, and
    none holds more than ``fanout`` digests but the last, which holds one per 4 TiB read.
    Short files are read and hashed by Spark itself. Ranges are read through the file system that
    the path's scheme names; where tasks cannot open it the query fails.
    """
    long, empty = F.col("length") > range_bytes, F.col("length") == 0
    # The paths of any file scan lie on the driver.
    short = [r.path for r in files.filter(~long & ~empty).select("path").collect()]
    ranges = files.filter(long).select(
        "file_path",
        "path",
        "length",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / range_bytes))).alias("slot"),
    )

    def digests(batches: Iterator) -> Iterator:
        for listed in batches:
            found = [
                range_digest(path, slot * range_bytes, min(range_bytes, length - slot * range_bytes))
                for path, slot, length in zip(listed["path"], listed["slot"], listed["length"])
            ]
            yield listed[["file_path", "slot"]].assign(digest=found)

    nodes = ranges.repartition("file_path", "slot").mapInPandas(
        by_value(digests), "file_path string, slot long, digest string"
    )
    for _ in range(2):
        nodes = nodes.groupBy("file_path", F.floor(F.col("slot") / fanout).alias("slot")).agg(
            joined_digest().alias("digest")
        )
    trees = nodes.groupBy("file_path").agg(joined_digest().alias("checksum"))
    # A scan skips files without a byte.
    nothing = F.sha2(F.lit("").cast("binary"), 256).alias("checksum")
    trees = trees.unionByName(files.filter(empty).select("file_path", nothing))
    if not short:
        return trees
    whole = spark.read.format("binaryFile").load(short)
    return trees.unionByName(
        whole.select(
            F.col("_metadata.file_path").alias("file_path"), F.sha2("content", 256).alias("checksum")
        )
    )


def joined_digest() -> Column:
    """The digest of a group's digests in the order of their slots; a lone one stays as it is."""
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct("slot", "digest"))), lambda s: s["digest"]
    )
    return F.when(F.size(ordered) == 1, ordered[0]).otherwise(F.sha2(F.array_join(ordered, ""), 256))


def range_digest(path: str, start: int, length: int) -> str:
    """SHA-256 of a range, read a piece at a time; a file that has become shorter is an error."""
    system, inner = file_system(path)
    digest, left = hashlib.sha256(), int(length)
    with system.open_input_file(inner) as data:
        data.seek(int(start))
        while left:
            piece = data.read(min(READ_BYTES, left))
            if not piece:
                raise OSError(f"{path} is shorter than when it was listed")
            digest.update(piece)
            left -= len(piece)
    return digest.hexdigest()
