"""Repeated strings of bytes, found by sorting suffixes and merging sorted runs.

Sorting every suffix of a corpus would move each byte hundreds of times, so the suffixes that cannot
matter are left out first, none of which could have been removed:

1. Each window of ``length`` bytes holds an anchor, the least gram of a quarter of its length.
   Equal windows have equal anchors at equal places. Consecutive windows of one anchor are a block;
   blocks whose gram occurs once in the corpus have no repeated window.
2. Blocks of equal content (by 128 bits) repeat in all their windows. One of them goes on as a
   partner of the others, together with the blocks that are like no other.
3. A block is cut into slices of ``SLICE`` windows. All windows of a slice share a core; slices whose
   core occurs once have no repeated window.

The suffixes that begin at the cores of the remaining slices are sorted in their batch and sent as
front-coded runs, each suffix as the length of the prefix it shares with its predecessor and the rest.
Where runs meet, a loser tree merges them. It knows how far each suffix agrees with the last one that
left the tree, decides by that alone where these lengths differ, and otherwise compares from there on,
so no known prefix is looked at again. The merge yields the common prefix of every two neighbours, from
which follow, for every depth, the suffixes that agree to it; windows that agree to the right of the
start of their core and, byte by byte, to the left of it are repeated.

A core that very many batches have does not meet in one task: its slices are taken apart into
windows, whose fingerprints of 128 bits count once per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from stratalake.functions.shipping import by_value
from stratalake.llm.exchange import (
    SENT,
    SENT_SCHEMA,
    Batches,
    Distinct,
    answers,
    elsewhere,
    reply,
)
from stratalake.llm.text_bytes import Hasher, bytes_of, mixed

LENGTH = 400
#: Windows in a slice; the lengths of what surrounds a core fit a byte.
SLICE = 32
#: A core in more batches than this is hot.
HOT = 16
PLACE_BITS = np.uint64(30)


def per_row(function: Callable) -> Callable:
    """A function of one batch's row as a task over many."""

    def run(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in arrived:
            for i in range(got.num_rows):
                yield from function(got.slice(i, 1))

    return by_value(run)


def numbers(row: pa.RecordBatch, name: str, kind=np.int32) -> np.ndarray:
    return np.frombuffer(row[name][0].as_py() or b"", kind)


def state(row: pa.RecordBatch, **arrays: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([a.tobytes()], pa.binary()) for a in arrays.values()]
    return pa.RecordBatch.from_arrays([row["batch"], *columns], ["batch", *arrays])


def columns_of(*names: str) -> str:
    return ", ".join(["batch long", *[f"{n} binary" for n in names]])


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each start to its end, both included, and whose each is."""
    sizes = (ends - starts + 1).astype(np.int64)
    owner = np.repeat(np.arange(len(starts)), sizes)
    first = np.cumsum(sizes) - sizes
    return starts[owner] + np.arange(sizes.sum()) - first[owner], owner


def anchored_blocks(
    data: np.ndarray, bounds: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last window start, and gram hash of every block of a batch."""
    gram = max(1, length // 4)
    span = length - gram + 1
    none = np.empty(0, np.int32)
    if len(data) < length:
        return none, none, none, np.empty(0, np.uint64)
    hasher = Hasher(41)
    grams = hasher.windows(hasher.of_bytes(data), gram)
    places = np.arange(len(grams), dtype=np.uint64)
    least = ((grams >> PLACE_BITS) << PLACE_BITS) | places
    size = 1
    while size * 2 <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if span > size:
        least = np.minimum(least[: len(least) - (span - size)], least[span - size :])
    anchor = (least & np.uint64(2**30 - 1)).astype(np.int64)
    text_end = np.repeat(bounds[1:], np.diff(bounds))[: len(anchor)]
    valid = np.flatnonzero(np.arange(len(anchor)) + length <= text_end)
    if not len(valid):
        return none, none, none, np.empty(0, np.uint64)
    anchor = anchor[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(valid)) - 1
    a = anchor[first]
    return (
        a.astype(np.int32),
        valid[first].astype(np.int32),
        valid[last].astype(np.int32),
        grams[a],
    )


def fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: np.ndarray) -> list:
    """Two hashes of each stretch of bytes, with a number that must agree, too."""
    out = []
    for seed in (42, 43):
        hasher = Hasher(seed)
        found = hasher.between(hasher.of_bytes(data), starts, ends)
        out.append(mixed(found + salt.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return out


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """How far two strings agree, given that they do up to ``known``."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class LoserTree:
    """Merges sorted runs of ``(prefix shared with the predecessor, string)``.

    Every loser keeps how far it agrees with the string that beat it. The next string of a run
    climbs towards the root: with the longer agreement it is the smaller one without a look at the
    strings, and with an equal one they are compared from there on.
    """

    def __init__(self, runs: list[Iterator[tuple[int, bytes]]]):
        self.runs = runs
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.heads: list[bytes | None] = [None] * self.size
        self.losers: list[tuple[int, int]] = [(-1, 0)] * self.size
        for run in range(len(runs)):
            self._next(run)
        self.winner = self._build(1)

    def _next(self, run: int) -> int:
        shared, head = next(self.runs[run], (0, None))
        self.heads[run] = head
        return shared

    def _build(self, node: int) -> tuple[int, int]:
        if node >= self.size:
            return node - self.size, 0
        left, right = self._build(2 * node), self._build(2 * node + 1)
        winner, self.losers[node] = self._match(left, right)
        return winner

    def _match(self, one: tuple[int, int], two: tuple[int, int]):
        """Winner and loser of runs with what their heads share with the last string out."""
        a, b = self.heads[one[0]], self.heads[two[0]]
        if a is None:
            return two, one
        if b is None:
            return one, two
        if one[1] > two[1]:
            return one, two
        if two[1] > one[1]:
            return two, one
        shared = common_prefix(a, b, one[1])
        if a[shared : shared + 1] <= b[shared : shared + 1]:
            return one, (two[0], shared)
        return two, (one[0], shared)

    def merged(self) -> Iterator[tuple[int, int, bytes]]:
        """Run, prefix shared with the last string out, and string, in order."""
        while True:
            run, shared = self.winner
            head = self.heads[run]
            if head is None:
                return
            yield run, shared, head
            contender = (run, self._next(run))
            node = (run + self.size) // 2
            while node:
                contender, self.losers[node] = self._match(contender, self.losers[node])
                node //= 2
            self.winner = contender


def coded_run(suffixes: list[bytes], lefts: list[bytes], low, high, cut) -> bytes:
    """A sorted run, front-coded."""
    shared = [0]
    for a, b in zip(suffixes, suffixes[1:], strict=False):
        shared.append(common_prefix(a, b, 0))
    tails = [s[n:] for s, n in zip(suffixes, shared, strict=True)]
    return b"".join(
        [
            np.array([len(suffixes)], np.int32).tobytes(),
            np.array(shared, np.uint16).tobytes(),
            np.array([len(t) for t in tails], np.uint16).tobytes(),
            np.asarray(low, np.uint8).tobytes(),
            np.asarray(high, np.uint8).tobytes(),
            np.asarray(cut, np.uint8).tobytes(),
            b"".join(tails),
            b"".join(x.rjust(SLICE - 1, b"\0") for x in lefts),
        ]
    )


def decoded_run(coded: bytes):
    """What ``coded_run`` was given; the suffixes as they come, with their shared prefixes."""
    n = int(np.frombuffer(coded, np.int32, 1)[0])
    at = 4
    parts = []
    for kind in (np.uint16, np.uint16, np.uint8, np.uint8, np.uint8):
        parts.append(np.frombuffer(coded, kind, n, at))
        at += n * np.dtype(kind).itemsize
    shared, sizes, low, high, cut = parts
    begin = at
    at += int(sizes.sum())
    lefts = np.frombuffer(coded, np.uint8, n * (SLICE - 1), at).reshape(n, SLICE - 1)

    def suffixes() -> Iterator[tuple[int, bytes]]:
        place, last = begin, b""
        for s, size in zip(shared.tolist(), sizes.tolist(), strict=True):
            last = last[:s] + coded[place : place + size]
            place += size
            yield s, last

    return suffixes(), lefts, low, high, cut


def merge_bucket(core: int) -> Callable:
    """Masks of the repeated windows of each slice in a bucket, in the order of the runs."""

    def merge(bucket: pa.Table) -> pa.Table:
        runs = [decoded_run(r) for r in bucket["packed"].to_pylist()]
        sizes = np.array([len(r[2]) for r in runs])
        offsets = np.cumsum(sizes) - sizes
        seen = np.zeros(len(runs), np.int64)
        order, shared = [], []
        for run, agreed, _ in LoserTree([r[0] for r in runs]).merged():
            order.append(offsets[run] + seen[run])
            seen[run] += 1
            shared.append(agreed)
        order, shared = np.array(order), np.array(shared)
        lefts = np.concatenate([r[1] for r in runs])[order]
        low, high, cut = (
            np.concatenate([r[k] for r in runs])[order].astype(np.int64) for k in (2, 3, 4)
        )
        masks = np.zeros(len(order), np.uint32)
        # Neighbours that agree over the core; alone in it, a slice has no partner.
        joined = shared >= core
        company = joined.copy()
        company[:-1] |= joined[1:]
        left_class = cut.copy()
        for i in range(SLICE):
            if i:  # one more byte to the left
                _, left_class = np.unique(
                    left_class * 256 + lefts[:, SLICE - 1 - i], return_inverse=True
                )
            right_class = np.cumsum(shared < core + SLICE - 1 - i)
            use = np.flatnonzero(company & (low <= i) & (high >= i))
            pairs = right_class[use] * (len(order) + 256) + left_class[use]
            _, place, count = np.unique(pairs, return_inverse=True, return_counts=True)
            masks[use[count[place] > 1]] |= np.uint32(1 << i)
        back = np.empty(len(order), np.uint32)
        back[order] = masks
        return pa.table(
            {
                "bucket": bucket["bucket"],
                "batch": bucket["batch"],
                "flags": pa.array(
                    [back[s : s + n].tobytes() for s, n in zip(offsets, sizes, strict=True)],
                    pa.binary(),
                ),
            }
        )

    return merge


def slice_suffixes(row: pa.RecordBatch, length: int, bits: int):
    """The cold slices of a batch in the order in which they are sent: bucket, then suffix."""
    data = bytes_of(row["texts"].flatten())[0].tobytes()
    core = length - SLICE + 1
    start, low, high, cut = (
        numbers(row, n, k)
        for n, k in (("start", np.int32), ("low", np.uint8), ("high", np.uint8), ("cut", np.uint8))
    )
    bucket = (numbers(row, "name", np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
    suffixes = [
        data[s : s + core + SLICE - 1 - n]
        for s, n in zip(start.tolist(), low.tolist(), strict=True)
    ]
    order = sorted(range(len(start)), key=lambda i: (bucket[i], suffixes[i]))
    return data, start, low, high, cut, bucket, suffixes, order


def remove_repeated_bytes(
    docs: DataFrame,
    length: int = LENGTH,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept`` (binary) of every document.

    Texts count as UTF-8 bytes. A byte is removed where any string of ``length`` bytes that covers
    it starts a second time anywhere, in the same document included; strings do not cross documents
    and are judged on the input, and overlapping ones count. ``n_spans`` are the maximal removed
    runs; ``kept`` is what remains, one after another. Null and empty texts have no bytes; each of
    several equal rows is a place of its own. Other columns are not read. ``length`` is at least
    twice ``SLICE``.
    """
    if not 2 * SLICE <= length < 2**16 - SLICE:
        raise ValueError(f"length {length}")
    batches = Batches(docs, id_column, text_column)
    bits, core = batches.bits, length - SLICE + 1

    def blocks_of(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, bounds = bytes_of(row["texts"].flatten())
        a, first, last, gram = anchored_blocks(data, bounds, length)
        yield state(row, a=a, first=first, last=last, gram=gram)

    blocks = batches.keep(
        batches.run(per_row(blocks_of), columns_of("a", "first", "last", "gram")), "blocks"
    )

    def send_grams(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        grams = Distinct(numbers(row, "gram", np.uint64))
        yield grams.packed(bits, row["batch"][0].as_py(), SENT_SCHEMA)

    sent = blocks.select("batch", "gram").mapInArrow(per_row(send_grams), SENT)
    gram_reply = reply(sent, elsewhere(1), "gram_reply")

    def live_blocks(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        grams = Distinct(numbers(row, "gram", np.uint64))
        flags = answers(row["gram_reply"][0].as_py(), len(grams.counts))
        live = ((grams.counts > 1) | (flags > 0))[grams.place]
        if live.any():
            yield state(row, **{n: numbers(row, n)[live] for n in ("a", "first", "last")})

    live = batches.keep(
        blocks.join(gram_reply, "batch").mapInArrow(
            per_row(live_blocks), columns_of("a", "first", "last")
        ),
        "live-blocks",
    )
    batches.forget("blocks")

    def contents_of(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        a, first, last = (numbers(row, n) for n in ("a", "first", "last"))
        if len(a):
            data, _ = bytes_of(row["texts"].flatten())
            one, two = fingerprints(data, first, last + length, a - first)
            yield state(row, a=a, first=first, last=last, one=one, two=two)

    names = ("a", "first", "last", "one", "two")
    contents = batches.keep(batches.run(per_row(contents_of), columns_of(*names), live), "contents")
    batches.forget("live-blocks")

    def send_contents(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        distinct = Distinct(numbers(row, "one", np.uint64), numbers(row, "two", np.uint64))
        yield distinct.packed(bits, row["batch"][0].as_py(), SENT_SCHEMA)

    sent = contents.select("batch", "one", "two").mapInArrow(per_row(send_contents), SENT)
    content_reply = reply(sent, elsewhere(2), "content_reply")

    def settle(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        distinct = Distinct(numbers(row, "one", np.uint64), numbers(row, "two", np.uint64))
        flags = answers(row["content_reply"][0].as_py(), len(distinct.counts))
        settled = ((distinct.counts > 1) | (flags > 0))[distinct.place]
        a, first, last = (numbers(row, n) for n in ("a", "first", "last"))
        onward = distinct.given[flags != 1]
        yield state(
            row,
            done_first=first[settled],
            done_last=last[settled],
            a=a[onward],
            first=first[onward],
            last=last[onward],
        )

    names = ("done_first", "done_last", "a", "first", "last")
    settled = batches.keep(
        contents.join(content_reply, "batch").mapInArrow(per_row(settle), columns_of(*names)),
        "settled-blocks",
    )
    batches.forget("contents")

    def slices_of(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        a, first, last = (numbers(row, n).astype(np.int64) for n in ("a", "first", "last"))
        if not len(a):
            return
        data, _ = bytes_of(row["texts"].flatten())
        nearest, farthest = a - last, a - first
        cut, owner = ranges(nearest // SLICE, farthest // SLICE)
        start = a[owner] - SLICE * cut
        low = np.maximum(nearest[owner] - SLICE * cut, 0)
        high = np.minimum(farthest[owner] - SLICE * cut, SLICE - 1)
        one, two = fingerprints(data, start, start + core, cut)
        yield state(
            row,
            start=start.astype(np.int32),
            low=low.astype(np.uint8),
            high=high.astype(np.uint8),
            cut=(cut % 256).astype(np.uint8),
            one=one,
            two=two,
        )

    to_cut = settled.select("batch", "a", "first", "last")
    names = ("start", "low", "high", "cut", "one", "two")
    slices = batches.keep(batches.run(per_row(slices_of), columns_of(*names), to_cut), "slices")
    sent = slices.select("batch", "one", "two").mapInArrow(per_row(send_contents), SENT)
    slice_reply = reply(sent, elsewhere(2, HOT), "slice_reply")

    def live_slices(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        distinct = Distinct(numbers(row, "one", np.uint64), numbers(row, "two", np.uint64))
        flags = answers(row["slice_reply"][0].as_py(), len(distinct.counts))
        hot = (flags == 3)[distinct.place]
        cold = ((distinct.counts > 1) | (flags > 0))[distinct.place] & ~hot
        start, low, high = numbers(row, "start"), numbers(row, "low", np.uint8), numbers(row, "high", np.uint8)
        yield state(
            row,
            start=start[cold],
            low=low[cold],
            high=high[cold],
            cut=numbers(row, "cut", np.uint8)[cold],
            name=numbers(row, "one", np.uint64)[cold],
            hot_first=(start[hot] - high[hot]).astype(np.int32),
            hot_last=(start[hot] - low[hot]).astype(np.int32),
        )

    names = ("start", "low", "high", "cut", "name", "hot_first", "hot_last")
    slices = batches.keep(
        slices.join(slice_reply, "batch").mapInArrow(per_row(live_slices), columns_of(*names)),
        "live-slices",
    )
    batches.forget("slices")

    def send_runs(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not len(numbers(row, "start")):
            return
        data, start, low, high, cut, bucket, suffixes, order = slice_suffixes(row, length, bits)
        at = 0
        while at < len(order):
            end = at
            while end < len(order) and bucket[order[end]] == bucket[order[at]]:
                end += 1
            some = order[at:end]
            lefts = [data[start[i] - high[i] : start[i]] for i in some]
            run = coded_run([suffixes[i] for i in some], lefts, low[some], high[some], cut[some])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(bucket[order[at]])], pa.int32()),
                    pa.array([row["batch"][0].as_py()], pa.int64()),
                    pa.array([run], pa.binary()),
                ],
                schema=SENT_SCHEMA,
            )
            at = end

    run_reply = reply(batches.run(per_row(send_runs), SENT, slices), merge_bucket(core), "run_reply")

    def hot_windows(row: pa.RecordBatch, data: np.ndarray) -> tuple[np.ndarray, Distinct]:
        places, _ = ranges(
            numbers(row, "hot_first").astype(np.int64), numbers(row, "hot_last").astype(np.int64)
        )
        salt = np.zeros(len(places), np.int64)
        return places, Distinct(*fingerprints(data, places, places + length, salt))

    def send_hot(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if len(numbers(row, "hot_first")):
            data, _ = bytes_of(row["texts"].flatten())
            _, distinct = hot_windows(row, data)
            yield distinct.packed(bits, row["batch"][0].as_py(), SENT_SCHEMA)

    hot_reply = reply(batches.run(per_row(send_hot), SENT, slices), elsewhere(2), "hot_reply")

    def remove(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, bounds = bytes_of(row["texts"].flatten())
        cover = np.zeros(len(data) + 1, np.int64)
        first, last = numbers(row, "done_first"), numbers(row, "done_last")
        np.add.at(cover, first, 1)
        np.add.at(cover, last.astype(np.int64) + length, -1)
        if len(numbers(row, "start")):
            _, start, _, _, _, _, _, order = slice_suffixes(row, length, bits)
            sent = sorted(row["run_reply"][0].as_py(), key=lambda r: r["bucket"])
            masks = np.concatenate([np.frombuffer(r["flags"], np.uint32) for r in sent])
            for i in range(SLICE):
                places = start[order][(masks >> np.uint32(i)) & np.uint32(1) > 0].astype(np.int64) - i
                np.add.at(cover, places, 1)
                np.add.at(cover, places + length, -1)
        if len(numbers(row, "hot_first")):
            places, distinct = hot_windows(row, data)
            flags = answers(row["hot_reply"][0].as_py(), len(distinct.counts))
            places = places[((distinct.counts > 1) | (flags > 0))[distinct.place]]
            np.add.at(cover, places, 1)
            np.add.at(cover, places + length, -1)
        gone = np.cumsum(cover)[:-1] > 0
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        starts = bounds[:-1][bounds[:-1] < len(data)]
        begins[starts] |= gone[starts]
        removed, spans = (np.append(0, np.cumsum(x))[bounds] for x in (gone, begins))
        kept = data[~gone].tobytes()
        cuts = bounds - removed
        yield pa.RecordBatch.from_arrays(
            [
                row["ids"].flatten(),
                pa.array(np.diff(bounds), pa.int64()),
                pa.array(np.diff(removed), pa.int64()),
                pa.array(np.diff(spans), pa.int64()),
                pa.array([kept[s:e] for s, e in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
            ],
            ["id", "n_bytes", "n_removed", "n_spans", "kept"],
        )

    schema = StructType(
        [
            StructField("id", batches.id_type),
            *[StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")],
            StructField("kept", BinaryType()),
        ]
    )
    done = settled.select("batch", "done_first", "done_last")
    return batches.run(per_row(remove), schema, done, slices, run_reply, hot_reply)
