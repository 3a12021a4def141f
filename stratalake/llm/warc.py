"""Web archives (WARC 1.0): writing pages as records, and reading records back.

Writing is a table of finished records as text, with the record's end as line separator; equal
payloads are stored once, by a record that the others revisit. A file holds a bounded number of
records, and Spark's own writer commits whole files, whichever executors are lost.

Reading cannot trust the words that begin a record, for a payload may hold them. Each task lists,
for every place where a record might begin, the offset at which its successor would. Records are
those places that the chain from the file's start reaches. Pointer jumping finds them: in every
round the known places also reach over their pointers, and each pointer is replaced by the one that
stands where it points, so a round doubles the chain, in files of any length. A chain that does not
end at the file's end means a damaged file and is an error.
"""

from __future__ import annotations

import hashlib
import zlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.shipping import by_value
from stratalake.llm.common import stage
from stratalake.session import scratch_dir

# Fixed values of the format.
MAGIC = b"WARC/1.0\r\n"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """40 hexadecimal digits as four numbers of 40 bits, each as 8 letters of 5 bits."""
    digits = F.sha1(payload)
    letters = []
    for quarter in range(4):
        number = F.conv(F.substring(digits, 10 * quarter + 1, 10), 16, 10).cast("long")
        for shift in range(35, -1, -5):
            letter = F.shiftright(number, shift).bitwiseAND(F.lit(31)).cast("int")
            letters.append(F.substring(F.lit(BASE32), letter + 1, F.lit(1)))
    return F.concat(*letters)


def write_warc(
    pages: DataFrame,
    path: str,
    min_revisit_bytes: int = 0,
    records_per_file: int = 2000,
    date: str = "2024-01-01T00:00:00Z",
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
) -> None:
    """A record per page below ``path``, in gzipped files of at most ``records_per_file``.

    Of the pages with one payload of at least ``min_revisit_bytes`` bytes, the one with the
    smallest identifier is a response and the others revisit it; with smaller payloads all are
    responses. Null payloads count as empty. Rows with one identifier and payload become equal
    records, all responses where it is the smallest; a page without identifier is never referred
    to unless all pages of its payload lack one, and then all of them are responses. Line breaks
    in a URL are taken out. Other columns are left out; an empty table gives an empty folder.
    """
    payload = F.coalesce(F.col(payload_column), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_column).cast("string").alias("page"),
        F.col(id_column).alias("id"),
        F.regexp_replace(F.coalesce(F.col(url_column), F.lit("")), r"[\r\n]", "").alias("url"),
        payload.alias("payload"),
    )
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    firsts = (
        rows.withColumn("bytes", F.octet_length("payload"))
        .filter(F.col("bytes") >= min_revisit_bytes)
        .groupBy("digest", "bytes")
        .agg(F.min("id").alias("first"))
    )
    # Written first, so that a join with a payload that very many pages share can be split.
    firsts = stage(firsts, "first-pages")
    revisits = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    body = F.when(revisits, F.lit("").cast("binary")).otherwise(F.col("payload"))
    lines = [
        F.lit("WARC/1.0"),
        F.concat(F.lit("WARC-Type: "), F.when(revisits, F.lit("revisit")).otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce("page", F.lit("")), F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("X-Payload-Length: "), F.octet_length("payload").cast("string")),
        F.when(
            revisits,
            F.concat(
                F.lit("WARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">")
            ),
        ),
        F.when(revisits, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    ]
    record = F.concat(
        F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), F.when(revisits, F.lit("")).otherwise(F.col("payload").cast("string"))
    )
    (
        rows.withColumn("bytes", F.octet_length("payload"))
        .join(firsts, ["digest", "bytes"], "left")
        .select(record.alias("value"))
        .write.option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def unzipped(content: bytes) -> tuple[bytes, bool]:
    """All members of a gzipped file one after another, and whether the last is whole.

    Other content is given back as it is.
    """
    if content[:2] != b"\x1f\x8b":
        return content, True
    out, whole = [], True
    while content and whole:
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        content, whole = member.unused_data, member.eof
    return b"".join(out), whole


def headers_before(data: bytes, at: int, end: int) -> tuple[int, dict[str, tuple[int, str]]]:
    """What the lines from ``at`` to a header's ``end`` say, whichever place the header begins at.

    The place after the last line that is no field, where a header may begin at the earliest, and
    by lower-cased name the last line's place and value.
    """
    fields: dict[str, tuple[int, str]] = {}
    place = end
    for line in reversed(data[at:end].split(b"\r\n")):
        name, colon, value = line.partition(b":")
        if not colon:
            return place + 2, fields
        place -= len(line)
        found = (place, value.decode("utf-8", "replace").strip())
        fields.setdefault(name.decode("latin-1").strip().lower(), found)
        place -= 2
    return at, fields


def candidates_in(data: bytes) -> Iterator[dict]:
    """Every place in a file where a record might begin, with the offset of its successor.

    A header may have any length. All places before one header's end share that end and the lines
    before it, which are read once.
    """
    at, last = data.find(MAGIC), -1
    while at >= 0:
        lines = at + len(MAGIC)
        if last < lines - 2:
            last = data.find(b"\r\n\r\n", lines - 2)
            if last < 0:
                return
            earliest, known = headers_before(data, lines, last)
        # Of a name that stands in several lines the last counts, so none before this place does.
        fields = {n: v for n, (place, v) in known.items() if lines >= earliest and place >= lines}
        length = fields.get("content-length", "")
        if length.isascii() and length.isdigit():
            begin = last + 4
            end = begin + int(length)
            if data[end : end + 4] == b"\r\n\r\n":
                payload = data[begin:end]
                stated = fields.get("x-payload-length", "")
                stated = int(stated) if stated.isascii() and stated.isdigit() else None
                if stated is not None and stated >= 2**63:
                    stated = -1
                # Only a revisit leaves out its payload; any other record's length is measured.
                measured = fields.get("warc-type") != "revisit" or stated is None
                yield {
                    "at": at,
                    "next": end + 4,
                    "record_type": fields.get("warc-type"),
                    "record_id": fields.get("warc-record-id"),
                    "uri": fields.get("warc-target-uri"),
                    "refers_to": fields.get("warc-refers-to"),
                    "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:"),
                    "payload_bytes": len(payload) if measured else stated,
                    "stated_bytes": stated,
                    "block_digest": b32encode(hashlib.sha1(payload).digest()).decode(),
                    "payload": payload,
                }
        at = data.find(MAGIC, at + 1)


CANDIDATE = (
    "file string, size long, at long, next long, record_type string, record_id string, "
    "uri string, refers_to string, payload_digest string, payload_bytes long, "
    "stated_bytes long, block_digest string, payload binary"
)


def reached_places(pointers: DataFrame) -> DataFrame:
    """``file, at`` of all places on the chain from offset 0, by pointer jumping.

    ``pointers`` has ``file, at, next``; a file may end its chain anywhere.
    """
    jumps = stage(pointers.select("file", "at", "next"), "pointers")
    reached = stage(
        pointers.filter("at = 0").select("file", "at").distinct(), "reached"
    )
    known = reached.count()
    while True:
        over = reached.join(jumps, ["file", "at"]).select("file", F.col("next").alias("at"))
        wider = reached.unionAll(over).distinct()
        reached = stage(wider, "reached")
        total = reached.count()
        if total == known:
            return reached
        known = total
        onward = jumps.select("file", F.col("at").alias("next"), F.col("next").alias("beyond"))
        jumps = stage(
            jumps.join(onward, ["file", "next"], "left").select(
                "file", "at", F.coalesce("beyond", "next").alias("next")
            ),
            "pointers",
        )


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the archives below ``path``, without what only looks like one.

    ``file, at, record_type, record_id, uri, refers_to, payload_digest, payload_bytes``, and the
    stored ``payload`` if asked for: a revisit has none. A file whose chain of records breaks off
    before its end, a gzipped file that is cut, or a response whose payload is not what its digest
    or its stated length says, is an error.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in CANDIDATE.split(", ")]
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in CANDIDATE.split(", ")])
        for got in batches:
            for name, content in zip(got["path"], got["content"], strict=True):
                data, whole = unzipped(content.as_py())
                # A row for the file itself, also where no record can begin.
                size = len(data) if whole else None
                some = [{**dict.fromkeys(names), "file": name.as_py(), "size": size, "at": -1}]
                for found in candidates_in(data):
                    found = {"file": name.as_py(), "size": size, **found}
                    if not payloads:
                        found["payload"] = None
                    some.append({n: found[n] for n in names})
                    if len(some) == 500:
                        yield pa.RecordBatch.from_pylist(some, schema)
                        some = []
                yield pa.RecordBatch.from_pylist(some, schema)

    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("path", "content")
    found = stage(files.mapInArrow(by_value(listed), CANDIDATE), "warc-candidates")
    sizes = found.filter("at < 0").select("file", "size")  # without a size where a file is cut
    found = found.filter("at >= 0")
    reached = reached_places(found)
    # The places reached are records, and one beyond the last of each file.
    ends = reached.groupBy("file").agg(F.max("at").alias("at"))
    broken = sizes.join(ends, "file", "left").filter("size is null or coalesce(at, 0) <> size")
    bad = [r["file"] for r in broken.limit(5).collect()]
    if bad:
        raise ValueError(f"damaged archives, among them {bad}")
    records = found.join(reached, ["file", "at"], "left_semi")
    sound = (F.col("record_type") != "response") | (
        (F.col("payload_digest") == F.col("block_digest"))
        & F.coalesce(F.col("stated_bytes") == F.col("payload_bytes"), F.lit(True))
    )
    records = records.withColumn(
        "payload_digest",
        F.when(sound, F.col("payload_digest")).otherwise(
            F.raise_error(F.concat(F.lit("payload differs from its digest or length: "), "record_id"))
        ),
    ).drop("next", "size", "block_digest", "stated_bytes")
    return records if payloads else records.drop("payload")


def round_trip(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write pages to archives in the cluster's shared folder and read them back."""
    path = scratch_dir(pages.sparkSession, "archives")
    write_warc(pages, path, min_revisit_bytes)
    return read_warc(pages.sparkSession, path, payloads=False)
