"""How sources of a language differ in the terms they use, from counts that are exact.

Documents are laid out by language and source, cut at white space into chunks and counted: a chunk's
occurrences and documents per group, and which documents, as long as they are few. Counts meet by
chunk, so each distinct chunk of the corpus is split into terms once, and its terms take over its
counts. A document may hold a term in several chunks ("word," and "word"), so documents of chunks
only bound those of terms: at least the greatest, at most the sum. Where the threshold lies
between, the documents themselves are counted, and no chunk involved has more than a few then.

Sources are compared in cells of some hundred sources by some thousand terms, as matrices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.shipping import by_value
from stratalake.llm.common import broadcast_below, stage

#: A term is a run of ASCII letters and characters beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Shares are whole numbers of billionths.
SCALE = 1000**3
#: Bytes of text counted at a time, and sources and terms of a cell.
PIECE, SOURCES, TERMS = 16_000_000, 128, 2048
#: Groups that may be sent to all executors.
BROADCAST_ROWS = 100_000

CHUNKS = pa.schema([
    ("chunk", pa.string()), ("lang", pa.string()), ("source", pa.string()),
    ("occurrences", pa.int64()), ("documents", pa.int64()), ("members", pa.list_(pa.int64())),
])


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of some ``PIECE`` bytes of text each; one text is never divided."""
    for got in batches:
        ends = np.cumsum(pc.binary_length(got["text"]).to_numpy())
        start = 0
        while start < got.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + PIECE, "right")))
            yield got.slice(start, end - start)
            start = end


def count_chunks(few: int):
    """Counts of chunks per group of a piece of text; which documents, if fewer than ``few``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            # Both functions know ASCII only: six kinds of space, and A-Z.
            chunks = pc.ascii_split_whitespace(pc.ascii_lower(piece["text"]))
            words = chunks.flatten().dictionary_encode()
            if not len(words):
                continue
            parent = pc.list_parent_indices(chunks).to_numpy().astype(np.int64)
            langs, sources = piece["lang"].dictionary_encode(), piece["source"].dictionary_encode()
            group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary)
            group = group + sources.indices.to_numpy()
            groups, group = np.unique(group, return_inverse=True)
            # Chunk, group and document of every word in one number, sorted: equal ones are neighbours.
            rows = piece.num_rows
            key = words.indices.to_numpy().astype(np.int64) * len(groups) + group[parent]
            key = np.sort(key * rows + parent)
            firsts = np.flatnonzero(np.diff(key, prepend=-1))
            pair, member = np.divmod(key[firsts], rows)
            starts = np.flatnonzero(np.diff(pair, prepend=-1))
            documents = np.diff(np.append(starts, len(pair)))
            occurrences = np.diff(np.append(firsts[starts], len(key)))
            rare = documents < few
            members = piece["row"].to_numpy()[member[np.repeat(rare, documents)]]
            ends = np.append(0, np.cumsum(np.where(rare, documents, 0)))
            chunk, place = np.divmod(pair[starts], len(groups))
            lang, source = np.divmod(groups[place], len(sources.dictionary))
            found = pa.RecordBatch.from_arrays([
                words.dictionary.take(pa.array(chunk)),
                langs.dictionary.take(pa.array(lang)),
                sources.dictionary.take(pa.array(source)),
                pa.array(occurrences),
                pa.array(documents),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(members)),
            ], schema=CHUNKS)
            # Text that begins or ends with a space has an empty chunk there.
            yield found.filter(pc.not_equal(found["chunk"], ""))

    return counted


def chunk_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """``term, lang, documents, members, sources`` for each term of each chunk and language.

    ``sources`` holds occurrences per source, ``documents`` the chunk's documents in the language, null
    but at the first place of a term that its chunk repeats; ``members`` are these documents, if
    fewer than ``min_docs``.
    """
    rows = docs.select("lang", "source", "text", F.monotonically_increasing_id().alias("row"))
    # Texts of a group side by side have far fewer distinct chunks to send; ranges split large groups.
    rows = rows.repartitionByRange("lang", "source", F.xxhash64("row"))
    columns = "chunk string, lang string, source string, occurrences long, documents long, members array<long>"
    counts = rows.mapInArrow(by_value(count_chunks(min_docs)), columns).repartition("chunk")
    total = F.sum("documents")
    few = F.flatten(F.collect_list("members"))
    by_source = counts.groupBy("chunk", "lang", "source").agg(
        F.sum("occurrences").alias("occurrences"), total.alias("documents"), few.alias("members")
    )
    by_lang = by_source.groupBy("chunk", "lang").agg(
        total.alias("documents"),
        F.when(total < min_docs, few).alias("members"),
        F.collect_list(F.struct("source", "occurrences")).alias("sources"),
    )
    by_chunk = by_lang.groupBy("chunk").agg(
        F.collect_list(F.struct("lang", "documents", "members", "sources")).alias("langs")
    )
    terms = by_chunk.withColumn("terms", F.regexp_extract_all("chunk", F.lit(TERM), F.lit(0)))
    placed = terms.select("terms", "langs", F.posexplode("terms").alias("place", "term"))
    first = F.array_position("terms", F.col("term")) == F.col("place") + 1
    return placed.select("term", first.alias("first"), F.explode("langs").alias("l")).select(
        "term", "l.lang",
        F.when(F.col("first"), F.col("l.documents")).alias("documents"),
        F.when(F.col("first"), F.col("l.members")).alias("members"),
        "l.sources",
    )


def kept_terms(terms: DataFrame, min_docs: int) -> DataFrame:
    """``lang, term`` of the terms that at least ``min_docs`` documents of the language hold."""
    bounds = terms.groupBy("lang", "term").agg(
        F.max("documents").alias("least"), F.sum("documents").alias("most")
    )
    bounds = stage(bounds.filter(F.col("most") >= min_docs), "term-bounds")
    sure = bounds.filter(F.col("least") >= min_docs).select("lang", "term")
    open_ones = bounds.filter(F.col("least") < min_docs).select("lang", "term")
    held = terms.join(open_ones, ["lang", "term"]).select("lang", "term", F.explode("members").alias("row"))
    counted = held.distinct().groupBy("lang", "term").count().filter(F.col("count") >= min_docs)
    return stage(sure.unionAll(counted.select("lang", "term")), "kept-terms")


def share(count: Column, total: Column, vocabulary: Column) -> Column:
    """``1 + floor(SCALE * (count + 2) / (total + 2 * vocabulary))`` without rounding.

    A long division of three digits at a time: no product leaves 64 bits.
    """
    rest, p, totals = count + 2, F.lit(0).cast("long"), total + 2 * vocabulary
    for _ in range(3):
        p = p * 1000 + F.call_function("div", rest * 1000, totals)
        rest = rest * 1000 % totals
    return p + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares_of(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """As ``share``."""
    rest, p = counts + 2, np.zeros_like(counts)
    for _ in range(3):
        p = p * 1000 + rest * 1000 // totals
        rest = rest * 1000 % totals
    return p + 1


def compare_sources(cell: pa.Table) -> pa.Table:
    """Divergences of one block of sources from another, over the terms of one block."""
    lang = cell["lang"][0].as_py()
    low, high = cell["i"][0].as_py(), cell["j"][0].as_py()
    terms = cell["terms"][0].as_py()
    is_group = np.asarray(cell["term"].is_null())
    groups = cell.filter(pa.array(is_group)).sort_by("source")
    counts = cell.filter(pa.array(~is_group))
    names = groups["source"].to_pylist()
    blocks = groups["block"].to_numpy()
    totals = groups["total"].to_numpy()[:, None]
    columns = counts["term"].combine_chunks().dictionary_encode()
    row_of = {name: i for i, name in enumerate(names)}
    rows = np.fromiter((row_of[s] for s in counts["source"].to_pylist()), np.int64, len(counts))
    # One column more stands for the terms that none of these sources has.
    width = len(columns.dictionary) + 1
    matrix = np.zeros((len(names), width), np.int64)
    matrix[rows, columns.indices.to_numpy()] = counts["count"].to_numpy()
    p = shares_of(matrix, totals) if terms else np.ones_like(matrix)
    weights = np.ones(width, np.int64)
    weights[-1] = terms - (width - 1)
    ours, theirs = np.flatnonzero(blocks == low), np.flatnonzero(blocks == high)
    found = []
    for a in ours:
        gap = p[theirs] - p[a]
        values = ((gap * gap) // (p[theirs] + p[a]) * weights).sum(axis=1)
        for b, value in zip(theirs, values.tolist(), strict=True):
            if a != b:
                found.append((lang, names[a], names[b], value))
                if low != high:
                    found.append((lang, names[b], names[a], value))
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
    lists = list(zip(*found, strict=True)) or [[], [], [], []]
    return pa.table([pa.array(x, t) for x, t in zip(lists, kinds, strict=True)],
                    names=["lang", "source", "item", "value"])


def source_pairs(counts: DataFrame, groups: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every ordered pair of sources of a language."""
    sizes = groups.groupBy("lang").agg(F.max("vocabulary").alias("v"), F.count("*").alias("s"))
    sizes = sizes.select(
        "lang",
        F.greatest(F.lit(1), F.ceil(F.col("v") / TERMS)).alias("term_blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("s") / SOURCES)).alias("source_blocks"),
    )

    def in_blocks(df: DataFrame) -> DataFrame:
        """Each row in all cells that its source's block and its term's block take part in."""
        ids = F.sequence(F.lit(0).cast("long"), F.col("source_blocks") - 1)
        return (
            df.withColumn("block", F.pmod(F.xxhash64("source"), "source_blocks"))
            .withColumn("other", F.explode(ids))
            .withColumn("i", F.least("block", "other"))
            .withColumn("j", F.greatest("block", "other"))
            .drop("other", "source_blocks")
        )

    def term_block(df: DataFrame) -> DataFrame:
        return df.join(sizes, "lang").withColumn("t", F.pmod(F.xxhash64("term"), "term_blocks"))

    columns = ["lang", "t", "i", "j", "block", "source", "term", "count", "total", "terms"]
    entries = in_blocks(term_block(counts)).withColumns({
        "total": F.lit(None).cast("long"), "terms": F.lit(None).cast("long")
    })
    in_cell = term_block(kept).groupBy("lang", "t").agg(F.count("*").alias("terms"))
    all_blocks = F.sequence(F.lit(0).cast("long"), F.col("term_blocks") - 1)
    members = groups.select(
        "lang", "source", (F.col("total") + 2 * F.col("vocabulary")).alias("total")
    ).join(sizes, "lang").withColumn("t", F.explode(all_blocks))
    members = members.join(in_cell, ["lang", "t"], "left").withColumns({
        "terms": F.coalesce("terms", F.lit(0).cast("long")),
        "term": F.lit(None).cast("string"), "count": F.lit(None).cast("long"),
    })
    cells = in_blocks(members).select(columns).unionByName(entries.select(columns))

    def compared(cell: pa.Table) -> pa.Table:
        # The number of terms stands in the rows of groups only.
        return compare_sources(cell.sort_by([("terms", "ascending")]))

    return (
        cells.groupBy("lang", "t", "i", "j")
        .applyInArrow(by_value(compared), "lang string, source string, item string, value long")
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )


def audit_sources(docs: DataFrame, min_docs: int = 10, top_terms: int = 10) -> DataFrame:
    """``lang, source, part, item, value, rank``: what sets the sources of a language apart.

    Terms are runs of letters, A-Z lower-cased; a language keeps those in at least ``min_docs`` of its
    documents, V of them. A group of ``lang`` and ``source`` gives a kept term that it has c times
    ``p = 1 + floor(SCALE * (c + 2) / (N + 2 * V))``, N counting all its kept terms; so does a
    language as a whole. Part ``pair``: item is another source of the language, ``value`` the sum of
    ``floor((p - q)^2 / (p + q))`` over the kept terms. Part ``term``: items are the ``top_terms``
    terms that the group has and favours over its language, by that value. Ranks count from 1 by
    value, greatest first, then by the item's bytes.

    Every row is a document of its own, whatever its identifier, also a repeated one. Null text, ``lang``
    and ``source`` are empty. A group without terms takes part; a language that keeps no term
    gives its pairs the value 0; a source alone in its language has no pairs. Texts of any length count
    as a whole. Other columns are not read. An empty table gives an empty result.
    """
    empty = F.lit("")
    docs = docs.select(*[
        F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("text", "lang", "source")
    ])
    terms = stage(chunk_terms(docs, min_docs), "chunk-terms")
    kept = kept_terms(terms, min_docs)
    counts = (
        terms.join(kept, ["lang", "term"])
        .select("lang", "term", F.explode("sources").alias("s"))
        .groupBy("lang", "s.source", "term")
        .agg(F.sum("s.occurrences").alias("count"))
    )
    counts = stage(counts, "term-counts")
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("vocabulary"))
    zero = F.lit(0).cast("long")
    groups = (
        docs.select("lang", "source").distinct()
        .join(counts.groupBy("lang", "source").agg(F.sum("count").alias("total")), ["lang", "source"], "left")
        .join(vocabulary, "lang", "left")
        .select("lang", "source", F.coalesce("total", zero).alias("total"),
                F.coalesce("vocabulary", zero).alias("vocabulary"))
    )
    groups = stage(groups, "source-groups")
    pairs = source_pairs(counts, groups, kept)

    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    overall = counts.groupBy("lang", "term").agg(F.sum("count").alias("lang_count"))
    favoured = (
        counts.join(overall, ["lang", "term"])
        .join(broadcast_below(groups.join(langs, "lang"), BROADCAST_ROWS), ["lang", "source"])
        .select(
            "lang", "source", F.col("term").alias("item"),
            share(F.col("count"), F.col("total"), F.col("vocabulary")).alias("p"),
            share(F.col("lang_count"), F.col("lang_total"), F.col("vocabulary")).alias("q"),
        )
        .filter("p > q")
        .select("lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))
    )
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pair_rows = pairs.withColumn("part", F.lit("pair")).withColumn("rank", rank)
    term_rows = favoured.withColumn("part", F.lit("term")).withColumn("rank", rank)
    return pair_rows.select(columns).unionByName(
        term_rows.filter(F.col("rank") <= top_terms).select(columns)
    )
