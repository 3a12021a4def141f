"""Near-duplicates by BagMinHash: texts whose bags of word shingles overlap by 0.8 or more.

A shingle that occurs w times covers weight from 0 to w. Points rain on that weight in time, and
each falls on one of the components of the signature; a component's value is its first point.
Two bags share a component's value with the probability of their weighted Jaccard similarity. The
weight is cut into dyadic shells [0, 1), [1, 2), [2, 4), ...: a shell's points come at the rate of
its width, from a process seeded by shingle and shell, and those beyond w are left out. So a shingle
of weight w costs as many points as are needed, not w of them, and no points after the time at
which a whole signature is sure to be full are ever made.

Texts of equal words form one node. Nodes that agree in a band of the signature meet in a bucket.
First each node is compared, shingle by shingle, with the one of all its mates that has most company;
that connects nearly all of a group of copies. What is left are nodes that their bucket's largest
component has not taken in. Buckets are cut into blocks of some 512 nodes, and each such node is
compared with its whole bucket, two blocks at a time by a product of matrices. So no link between
different texts of a bucket is lost, and no pair that is not similar becomes a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    LongType,
    StructField,
    StructType,
)

from stratalake.functions.shipping import by_value
from stratalake.llm.common import document_keys, perhaps_among, same_document, stage
from stratalake.llm.components import connected
from stratalake.llm.text_bytes import (
    LETTERS,
    LOWER,
    NOT_BLANK,
    Hasher,
    bytes_of,
    mixed,
    pieces,
    words_in,
)

WORDS = 5
THRESHOLD = 0.8
#: 30 bands of 5: a pair at 0.8 meets in a bucket but for 1 in 150,000, one at 0.2 seldom.
BANDS, ROWS = 30, 5
#: Bits of a shingle's hash beside a text's number within a batch.
BITS = 44
#: Bytes of text that a task works on at a time: some 60 MB of arrays, whatever the batch holds.
PIECE = 1_000_000
#: Nodes, and shingles, that a block holds on average; blocks of a bucket that a task reads together.
BLOCK_NODES, BLOCK_SHINGLES, SLICE_BLOCKS = 512, 2**19, 4
MATRIX_COLUMNS = 8192


def bags(
    hasher: Hasher, word_hashes: np.ndarray, first_word: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of every distinct shingle; a text below ``WORDS`` words is one."""
    counts = np.diff(first_word)
    prefix = hasher.prefix(word_hashes)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(word_hashes))
    left = counts[text] - (at - first_word[:-1][text])
    starts = at[(left >= WORDS) | (left == counts[text])]
    owner = text[starts]
    length = np.minimum(counts[owner], WORDS)
    hashes = hasher.between(prefix, starts, starts + length)
    keys = (owner.astype(np.uint64) << np.uint64(BITS)) | (hashes >> np.uint64(64 - BITS))
    keys, weights = np.unique(keys, return_counts=True)
    return (
        (keys >> np.uint64(BITS)).astype(np.int64),
        keys & np.uint64(2**BITS - 1),
        weights,
    )


def signatures(
    text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int, size: int
) -> np.ndarray:
    """``texts`` rows of ``size`` first times; rows of texts without shingles are infinite."""
    first = np.full(texts * size, np.inf)
    total = np.bincount(text, weight, texts)
    open_texts = total > 0
    patience = 8.0
    while open_texts.any():
        use = open_texts[text]
        until = np.zeros(texts)
        until[open_texts] = (np.log(size) + patience) / total[open_texts]
        low, shell = 0, 0
        while True:
            inside = np.flatnonzero(use & (weight > low))
            if not len(inside):
                break
            width = max(1, low)
            rain(first, text[inside], shingle[inside], weight[inside], until, low, width, shell, size)
            low, shell = low + width, shell + 1
        full = np.isfinite(first.reshape(texts, size)).all(axis=1)
        open_texts &= ~full
        patience *= 2
    return first.reshape(texts, size)


def rain(
    first: np.ndarray,
    text: np.ndarray,
    shingle: np.ndarray,
    weight: np.ndarray,
    until: np.ndarray,
    low: int,
    width: int,
    shell: int,
    size: int,
) -> None:
    """Points of one shell of every shingle, in order of time, up to each text's ``until``."""
    seeds = mixed(shingle + np.uint64((shell + 1) * 0x9E3779B97F4A7C15 % 2**64))
    time = np.zeros(len(text))
    end = until[text]
    steps = 0
    while len(text):
        steps = (steps + 0xD1B54A32D192ED03) % 2**64
        drawn = mixed(seeds + np.uint64(steps))
        time = time - np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53) / (
            size * width
        )
        live = time <= end
        if not live.all():
            text, seeds, time, end, weight, drawn = (
                x[live] for x in (text, seeds, time, end, weight, drawn)
            )
        again = mixed(drawn ^ np.uint64(0x94D049BB133111EB))
        component = (again % np.uint64(size)).astype(np.int64)
        if width > 1:  # the point lies anywhere in the shell; it counts below the weight only
            place = low + width * ((mixed(again) >> np.uint64(11)).astype(np.float64) / 2**53)
            under = place < weight
            np.minimum.at(first, text[under] * size + component[under], time[under])
        else:
            np.minimum.at(first, text * size + component, time)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signature), BANDS)).copy()
    for row in range(ROWS):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, row])
    return out.view(np.int64)


def first_bytes(signature: np.ndarray) -> list[bytes]:
    """A byte of every component, to estimate similarities with."""
    bits = np.ascontiguousarray(signature).view(np.uint64)
    return [row.tobytes() for row in (mixed(bits) & np.uint64(255)).astype(np.uint8)]


def least_agreement(threshold: float) -> float:
    """Components in which two signatures of similar texts agree at least.

    At the threshold the number that agrees is binomial; six deviations below its mean is once in
    10 ** 8 or less.
    """
    size = BANDS * ROWS
    return size * threshold - 6 * np.sqrt(size * threshold * (1 - threshold))


def promising(threshold: float):
    """Keeps pairs but those whose signatures agree in far too few components."""
    size, least = BANDS * ROWS, least_agreement(threshold)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            a, b = (
                np.frombuffer(b"".join(got[c].to_pylist()), np.uint8).reshape(-1, size)
                for c in ("sketch_a", "sketch_b")
            )
            yield got.select(["a", "b"]).filter(pa.array((a == b).sum(axis=1) >= least))

    return kept


NODES = "array<struct<node: binary, root: binary>>"
CELL = f"cell binary, left {NODES}, right {NODES}"


def promising_cells(threshold: float):
    """Nodes of two blocks that may be similar across components, in cells that share no pair.

    A cell is a connected part of the pairs whose sizes and signatures allow the threshold, so each
    node is in one cell a side and pairs never become rows. Equal cells have equal names.
    """
    least = least_agreement(threshold)

    def maybe(nodes_a: list[dict], nodes_b: list[dict]) -> np.ndarray:
        marks_a, marks_b = (
            np.frombuffer(b"".join(n["sketch"] for n in side), np.uint8).reshape(len(side), -1)
            for side in (nodes_a, nodes_b)
        )
        sizes_a, sizes_b = (np.array([n["size"] for n in side]) for side in (nodes_a, nodes_b))
        _, roots = np.unique([n["root"].hex() for n in nodes_a + nodes_b], return_inverse=True)
        roots_a, roots_b = roots[: len(nodes_a)], roots[len(nodes_a) :]
        found = np.minimum.outer(sizes_a, sizes_b) >= threshold * np.maximum.outer(sizes_a, sizes_b)
        found &= roots_a[:, None] != roots_b
        for i in np.flatnonzero(found.any(axis=1)):
            found[i] &= (marks_b == marks_a[i]).sum(axis=1) >= least
        # A block meets itself: each pair once.
        return np.triu(found) if nodes_a == nodes_b else found

    def parted(nodes_a: list[dict], nodes_b: list[dict]) -> Iterator[tuple[list, list]]:
        found = maybe(nodes_a, nodes_b)
        rows = set(np.flatnonzero(found.any(axis=1)).tolist())
        while rows:
            here, there = {rows.pop()}, set()
            wave = set(here)
            while wave:
                reached = set(np.flatnonzero(found[list(wave)].any(axis=0)).tolist()) - there
                there |= reached
                wave = set(np.flatnonzero(found[:, list(reached)].any(axis=1)).tolist()) - here
                here |= wave
            rows -= here
            sides = [
                [{k: side[i][k] for k in ("node", "root")} for i in sorted(part)]
                for side, part in ((nodes_a, here), (nodes_b, there))
            ]
            yield tuple(sorted(sides, key=lambda side: [n["node"] for n in side]))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("node", pa.binary()), ("root", pa.binary())]))
        schema = pa.schema([("cell", pa.binary()), ("left", kind), ("right", kind)])
        for got in batches:
            found = []
            for a, b in zip(got["nodes_a"], got["nodes_b"], strict=True):
                for left, right in parted(a.as_py(), b.as_py()):
                    name = b"|".join(b"".join(n["node"] for n in side) for side in (left, right))
                    name = hashlib.blake2b(name, digest_size=16).digest()
                    found.append({"cell": name, "left": left, "right": right})
            yield pa.RecordBatch.from_pylist(found, schema)

    return cells


def tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of letters and digits; texts without any, words of whatever is not blank."""
    starts, ends, first = words_in(data, at, LETTERS)
    bare = np.diff(first) == 0
    if bare.any():
        other_starts, other_ends, other = words_in(data, at, NOT_BLANK)
        wanted = np.repeat(bare, np.diff(other))
        starts = np.concatenate([starts, other_starts[wanted]])
        ends = np.concatenate([ends, other_ends[wanted]])
        order = np.argsort(starts)
        starts, ends = starts[order], ends[order]
        first = np.searchsorted(starts, at)
    return starts, ends, first


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its node (a hash of its words; null without any), size and band hashes."""
    one, two = Hasher(51), Hasher(52)
    for got in batches:
        data, bounds = bytes_of(got["text"])
        for begin, end in pieces(bounds, PIECE):
            at = bounds[begin : end + 1] - bounds[begin]
            text = LOWER[data[bounds[begin] : bounds[end]]]
            starts, ends, first = tokens(text, at)
            hashes = one.between(one.of_bytes(text), starts, ends)
            names = np.stack(
                [
                    h.between(h.prefix(hashes), first[:-1], first[1:]) + np.uint64(i)
                    for i, h in enumerate((one, two))
                ],
                axis=1,
            )
            owner, shingle, weight = bags(two, hashes, first)
            size = np.bincount(owner, weight, end - begin).astype(np.int64)
            found = np.full((end - begin, BANDS * ROWS), np.inf)
            full = np.flatnonzero(size)
            place = np.cumsum(size > 0) - 1
            found[full] = signatures(place[owner], shingle, weight, len(full), BANDS * ROWS)
            bands = band_hashes(found)
            nodes = [n.tobytes() if s else None for n, s in zip(names, size, strict=True)]
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, bands.size + 1, BANDS), pa.int32()), pa.array(bands.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [
                    got["__id"].slice(begin, end - begin),
                    got["__text"].slice(begin, end - begin),
                    pa.array(nodes, pa.binary()),
                    pa.array(size),
                    lists,
                    pa.array(first_bytes(found), pa.binary()),
                ],
                ["__id", "__text", "node", "size", "bands", "sketch"],
            )


def expanded_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per node its bag as a set: a shingle that occurs w times gives w different hashes."""
    one, two = Hasher(51), Hasher(52)
    for got in batches:
        data, bounds = bytes_of(got["text"])
        for begin, end in pieces(bounds, PIECE):
            at = bounds[begin : end + 1] - bounds[begin]
            text = LOWER[data[bounds[begin] : bounds[end]]]
            starts, ends, first = tokens(text, at)
            hashes = one.between(one.of_bytes(text), starts, ends)
            owner, shingle, weight = bags(two, hashes, first)
            turn = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
            turn = turn.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            found = mixed(np.repeat(shingle, weight) + turn)
            cuts = np.cumsum(np.bincount(owner, weight, end - begin).astype(np.int64))[:-1]
            sets = [part.tobytes() for part in np.split(found, cuts)]
            yield pa.RecordBatch.from_arrays(
                [got["node"].slice(begin, end - begin), pa.array(sets, pa.binary())],
                ["node", "bag"],
            )


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set on the left has in common with each on the right."""
    every = [np.concatenate(side) for side in (left, right)]
    common = np.intersect1d(*every)
    shared = np.zeros((len(left), len(right)))
    if not len(common):
        return shared
    placed = []
    for side, joined in zip((left, right), every, strict=True):
        owner = np.repeat(np.arange(len(side)), [len(x) for x in side])
        place = np.minimum(np.searchsorted(common, joined), len(common) - 1)
        known = common[place] == joined
        placed.append((owner[known], place[known]))
    for low in range(0, len(common), MATRIX_COLUMNS):
        width = min(MATRIX_COLUMNS, len(common) - low)
        halves = []
        for side, (owner, place) in zip((left, right), placed, strict=True):
            here = (place >= low) & (place < low + width)
            matrix = np.zeros((len(side), width), np.float32)
            matrix[owner[here], place[here] - low] = 1
            halves.append(matrix)
        shared += halves[0] @ halves[1].T
    return shared


def similar_blocks(threshold: float):
    """Links between the components of two blocks of nodes; no more than connect them."""

    def linked(nodes_a: list[dict], nodes_b: list[dict]) -> list[tuple[bytes, bytes]]:
        left, right = (
            [np.frombuffer(n["bag"], np.uint64) for n in side] for side in (nodes_a, nodes_b)
        )
        shared = overlaps(left, right)
        sizes = np.add.outer([len(x) for x in left], [len(x) for x in right])
        parent: dict[bytes, bytes] = {}

        def top(root: bytes) -> bytes:
            while root in parent:
                root = parent[root]
            return root

        found = []
        for i, j in zip(*np.nonzero(shared >= threshold * (sizes - shared)), strict=True):
            a, b = nodes_a[i]["root"], nodes_b[j]["root"]
            top_a, top_b = top(a), top(b)
            if top_a != top_b:
                parent[top_a] = top_b
                found.append((a, b))
        return found

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            found = [
                link
                for a, b in zip(got["nodes_a"], got["nodes_b"], strict=True)
                for link in linked(a.as_py(), b.as_py())
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([link[k] for link in found], pa.binary()) for k in (0, 1)], ["a", "b"]
            )

    return links


def similar(threshold: float):
    """Keeps the pairs whose texts' bags overlap enough."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = Hasher(51), Hasher(52)
        for got in batches:
            sides = [bytes_of(got[c]) for c in ("text_a", "text_b")]
            joint = sides[0][1] + sides[1][1]
            for begin, end in pieces(joint, PIECE):
                found = []
                for data, bounds in sides:
                    at = bounds[begin : end + 1] - bounds[begin]
                    text = LOWER[data[bounds[begin] : bounds[end]]]
                    starts, ends, first = tokens(text, at)
                    hashes = one.between(one.of_bytes(text), starts, ends)
                    owner, shingle, weight = bags(two, hashes, first)
                    keys = (owner.astype(np.uint64) << np.uint64(BITS)) | shingle
                    found.append((owner, keys, weight))
                (own_a, keys_a, w_a), (own_b, keys_b, w_b) = found
                _, in_a, in_b = np.intersect1d(keys_a, keys_b, True, True)
                n = end - begin
                shared = np.bincount(own_a[in_a], np.minimum(w_a[in_a], w_b[in_b]), n)
                every = np.bincount(own_a, w_a, n) + np.bincount(own_b, w_b, n) - shared
                linked = shared >= threshold * every
                yield pa.RecordBatch.from_arrays(
                    [
                        got["a"].slice(begin, n),
                        got["b"].slice(begin, n),
                        pa.array(linked),
                    ],
                    ["a", "b", "linked"],
                )

    return kept


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every document with ``class_id``, the least identifier of its group, and ``keep``.

    A group is a connected component of texts whose bags of five-word shingles have a weighted
    Jaccard similarity of at least ``threshold``; words are runs of letters and digits, A-Z
    lower-cased, or of anything not blank where a text has none, and a text of fewer than five
    words is one shingle. Blank and null texts have no shingles and are groups of their own.
    Exactly one row of a group, of the least identifier, has ``keep``; rows without identifier
    come last, and a group of only such rows keeps one and has no ``class_id``. Columns named like
    a result are replaced. An empty table gives an empty one.
    """
    keyed = docs.select(
        *document_keys(F.col(id_column), F.col(text_column)), F.col(text_column).alias("text")
    )
    kinds = {f.name: f.dataType for f in keyed.schema.fields}
    schema = StructType(
        [
            StructField("__id", kinds["__id"]),
            StructField("__text", LongType()),
            StructField("node", BinaryType()),
            StructField("size", LongType()),
            StructField("bands", ArrayType(LongType())),
            StructField("sketch", BinaryType()),
        ]
    )
    sketches = stage(keyed.mapInArrow(by_value(sketch), schema), "sketches")
    with_words = sketches.filter("node is not null")
    nodes = stage(
        with_words.groupBy("node").agg(
            F.min("size").alias("size"),
            F.min("bands").alias("bands"),
            F.min("sketch").alias("sketch"),
            F.min(F.struct(F.col("__id").isNull(), "__id", "__text")).alias("row"),
        ),
        "nodes",
    )
    links = linked_nodes(nodes, keyed, threshold)
    roots = connected(links).select("node", "root")
    grouped = sketches.select("__id", "__text", "node").join(roots, "node", "left")
    # A document without words is a group of its own, known by what tells it apart.
    alone = F.struct(F.col("__id").alias("i"), F.col("__text").alias("t"))
    grouped = grouped.select(
        "__id",
        "__text",
        F.coalesce("root", "node").alias("group"),
        F.when(F.col("node").isNull(), alone).alias("alone"),
    )
    first = F.struct(F.col("__id").isNull().alias("missing"), F.col("__id").alias("i"), F.col("__text").alias("t"))
    chosen = stage(grouped.groupBy("group", "alone").agg(F.min(first).alias("first")), "groups")
    members = grouped.distinct()
    marked = members.join(
        chosen,
        members["group"].eqNullSafe(chosen["group"]) & members["alone"].eqNullSafe(chosen["alone"]),
    ).select(
        "__id",
        "__text",
        F.col("first.i").alias("class_id"),
        (
            F.col("__id").eqNullSafe(F.col("first.i")) & (F.col("__text") == F.col("first.t"))
        ).alias("keep"),
    )
    out = docs.drop("class_id", "keep").select(
        "*", *document_keys(F.col(id_column), F.col(text_column))
    )
    return (
        out.join(marked, same_document(out, marked))
        .drop(marked["__id"], marked["__text"])
        .drop("__id", "__text")
    )


def linked_nodes(nodes: DataFrame, keyed: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: links that connect all nodes which any chain of similar bucket mates connects."""
    met = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    shared = met.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    shared = stage(shared, "shared-buckets")
    met = stage(met.join(shared, "bucket"), "bucket-members")
    # Nodes with most company come first; among equals the greatest hash.
    company = met.groupBy("node").agg(F.sum("n").alias("company"))
    met = stage(met.join(company, "node"), "bucket-members")
    links = verified(best_mates(met, threshold), nodes, keyed, threshold)
    # A link to the root says all that the links so far say.
    roots = connected(links)
    links = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    rooted = met.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    members = stage(open_members(rooted), "open-members")
    if not members.limit(1).count():
        return links
    return links.unionAll(stage(block_links(members, nodes, keyed, threshold), "links-of-blocks"))


def open_members(rooted: DataFrame) -> DataFrame:
    """The nodes of buckets of more than one component, dealt into blocks.

    ``main`` tells the nodes of the bucket's largest component, which need no comparison with one
    another. Buckets of the very same nodes are one.
    """
    parts = rooted.groupBy("bucket", "root").agg(
        F.count("*").alias("n"),
        F.sum("size").alias("shingles"),
        F.bit_xor(F.xxhash64("node")).alias("one"),
        F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("two"),
    )
    largest = F.max(F.struct("n", "root", "shingles")).alias("largest")
    buckets = parts.groupBy("bucket").agg(
        largest,
        F.sum("n").alias("n"),
        F.sum("shingles").alias("shingles"),
        F.bit_xor("one").alias("one"),
        F.bit_xor("two").alias("two"),
    )
    buckets = buckets.filter(F.col("n") > F.col("largest.n")).dropDuplicates(["n", "one", "two"])

    def blocks(n, shingles):
        return F.ceil(F.greatest(n / BLOCK_NODES, shingles / BLOCK_SHINGLES))

    sized = buckets.select(
        "bucket",
        F.col("largest.root").alias("main_root"),
        blocks(F.col("largest.n"), F.col("largest.shingles")).alias("main_blocks"),
        blocks(
            F.col("n") - F.col("largest.n"), F.col("shingles") - F.col("largest.shingles")
        ).alias("other_blocks"),
    )
    main = F.col("root") == F.col("main_root")
    block = F.pmod(F.xxhash64(F.lit(2), "node"), F.when(main, F.col("main_blocks")).otherwise(F.col("other_blocks")))
    return rooted.join(sized, "bucket").select(
        "bucket", "node", "root", main.alias("main"), block.alias("block"), "other_blocks"
    )


def block_links(
    members: DataFrame, nodes: DataFrame, keyed: DataFrame, threshold: float
) -> DataFrame:
    """``a, b``: links between components, from all pairs of blocks but two of the main one.

    Signatures go through the buckets, and rule out what is far from similar. A bucket's blocks meet
    in slices of 4 blocks at most against all, so no bucket owns a task. What is left of two blocks
    falls into cells of nodes that may be similar; most cells come from many buckets and are kept
    once. Only for their nodes are bags made, once, and bags decide.
    """
    sketched = members.join(nodes.select("node", "size", "sketch"), "node")
    blocks = sketched.groupBy("bucket", "main", "block", "other_blocks").agg(
        F.sort_array(F.collect_list(F.struct("node", "root", "size", "sketch"))).alias("nodes")
    )
    blocks = stage(blocks, "blocks")
    some = blocks.filter("not main").select(
        "bucket",
        F.floor(F.col("block") / SLICE_BLOCKS).alias("slice"),
        F.col("block").alias("here"),
        F.col("nodes").alias("nodes_a"),
    )
    slices = F.sequence(F.lit(0), F.floor((F.col("other_blocks") - 1) / SLICE_BLOCKS))
    every = blocks.select(
        "bucket",
        F.explode(slices).alias("slice"),
        "main",
        F.col("block").alias("there"),
        F.col("nodes").alias("nodes_b"),
    )
    pairs = some.join(every, ["bucket", "slice"]).filter("main or there >= here")
    cells = pairs.select("nodes_a", "nodes_b").mapInArrow(by_value(promising_cells(threshold)), CELL)
    cells = stage(cells.dropDuplicates(["cell"]), "cells")
    sides = [
        cells.select("cell", F.lit(side).alias("side"), F.inline(side)) for side in ("left", "right")
    ]
    sides = sides[0].unionAll(sides[1])
    texts = node_texts(nodes, sides.select("node").distinct(), keyed)
    bags_of = stage(texts.mapInArrow(by_value(expanded_bags), "node binary, bag binary"), "bags")
    held = F.struct("root", "bag")
    met = sides.join(bags_of, "node").groupBy("cell").agg(
        F.collect_list(F.when(F.col("side") == "left", held)).alias("nodes_a"),
        F.collect_list(F.when(F.col("side") == "right", held)).alias("nodes_b"),
    )
    return met.select("nodes_a", "nodes_b").mapInArrow(
        by_value(similar_blocks(threshold)), "a binary, b binary"
    )


def best_mates(met: DataFrame, threshold: float) -> DataFrame:
    """Each node with the one of its bucket mates that has most company: one pair a node."""
    mate = F.struct("company", "node", "size")
    best = met.groupBy("bucket").agg(F.max(mate).alias("mate"))
    best = stage(best, "best-mates")
    rank = F.struct(F.col("mate.company"), F.col("mate.node"), F.col("mate.size"))
    near = F.least("size", "mate.size") >= threshold * F.greatest("size", "mate.size")
    return (
        met.join(best, "bucket")
        .filter((F.col("mate.node") != F.col("node")) & near)
        .groupBy("node")
        .agg(F.max(rank).alias("mate"))
        .select(
            F.least("node", "mate.node").alias("a"), F.greatest("node", "mate.node").alias("b")
        )
        .distinct()
    )


def node_texts(nodes: DataFrame, wanted: DataFrame, keyed: DataFrame) -> DataFrame:
    """``node, text``: one text of each wanted node; few other texts move."""
    rows = nodes.join(wanted, "node", "left_semi").select(
        "node", F.col("row.__id").alias("__id"), F.col("row.__text").alias("__text")
    )
    rows = stage(rows, "rows-of-nodes")
    near = perhaps_among(keyed, rows, "__id", "__text")
    # Repeated rows have one text; a node needs it once.
    found = near.join(rows, same_document(near, rows)).select("node", "text")
    return stage(found.dropDuplicates(["node"]), "texts-of-nodes")


def verified(pairs: DataFrame, nodes: DataFrame, keyed: DataFrame, threshold: float) -> DataFrame:
    """The similar among the pairs; signatures rule out what is far from it before texts move."""
    left = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))
    pairs = pairs.join(left, "a").join(right, "b")
    pairs = stage(pairs.mapInArrow(by_value(promising(threshold)), "a binary, b binary"), "promising-pairs")
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node")))
    texts = node_texts(nodes, ends.distinct(), keyed)
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    schema = StructType(
        [
            StructField("a", BinaryType()),
            StructField("b", BinaryType()),
            StructField("linked", BooleanType()),
        ]
    )
    judged = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    judged = judged.mapInArrow(by_value(similar(threshold)), schema)
    return stage(judged.filter("linked").select("a", "b"), "similar-pairs")
