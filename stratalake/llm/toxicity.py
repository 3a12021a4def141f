"""Toxicity scores by a factorization machine over hashed terms.

A document's features are its distinct words, lower-cased, and the beginnings of longer words,
hashed. Besides a weight, each feature has a short vector; the products of vectors say what two
terms mean together, such as an insult next to the mention of a group, which weights that only add
up cannot say. The machine is trained on a bounded sample of labelled rows and travels to the
tasks that score; its size is fixed by ``DIMENSIONS``. No document moves for scoring.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from stratalake.functions.shipping import by_value
from stratalake.llm.text_bytes import LETTERS, LOWER, Hasher, bytes_of, pieces, words_in

DIMENSIONS = 2**18
FACTORS = 4
#: Bytes of text worked on at once: each takes some hundred bytes of arrays per word.
PIECE = 500_000
#: Bytes of the beginnings of words that are features, too.
BEGINNINGS = (4, 5, 6)


@dataclass(frozen=True)
class Machine:
    """``1 / (1 + exp(-(bias + weights + products of vectors)))`` over a document's features."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def scores(self, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(margins(self, features, bounds), -500, 500)))


def summed(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the stretches between ``bounds``, along the first axis."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]))
    filled = np.flatnonzero(np.diff(bounds))
    if len(filled):
        out[filled] = np.add.reduceat(values, bounds[filled], axis=0, dtype=np.float64)
    return out


def margins(m: Machine, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    vectors = m.vectors[features]
    sums = summed(vectors, bounds)
    pairs = 0.5 * (sums**2 - summed(vectors**2, bounds)).sum(axis=1)
    return m.bias + summed(m.weights[features], bounds) + pairs


def features_of(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct features of each text, piece by piece, and their bounds."""
    hasher = Hasher(9)
    data, bounds = bytes_of(column)
    for first, last in pieces(bounds, PIECE):
        text = LOWER[data[bounds[first] : bounds[last]]]
        at = bounds[first : last + 1] - bounds[first]
        starts, ends, first_word = words_in(text, at, LETTERS)
        document = np.repeat(np.arange(last - first), np.diff(first_word))
        prefix = hasher.of_bytes(text)
        hashes, owners = [hasher.between(prefix, starts, ends)], [document]
        for n in BEGINNINGS:
            longer = ends - starts > n
            begin = starts[longer]
            hashes.append(hasher.between(prefix, begin, begin + n) + np.uint64(n))
            owners.append(document[longer])
        keys = np.concatenate(owners).astype(np.int64) * DIMENSIONS + (
            np.concatenate(hashes) % np.uint64(DIMENSIONS)
        ).astype(np.int64)
        keys = np.unique(keys)
        yield (
            keys % DIMENSIONS,
            np.searchsorted(keys, np.arange(last - first + 1) * DIMENSIONS),
        )


def fit(
    features: np.ndarray,
    bounds: np.ndarray,
    labels: np.ndarray,
    base_rate: float,
    epochs: int = 8,
    batch: int = 256,
    rate: float = 0.3,
    decay: float = 1e-3,
    sparsity: float = 1e-3,
    start: float = 1e-2,
    min_rows: int = 10,
) -> Machine:
    """AdaGrad over batches in a fixed order; terms in fewer than ``min_rows`` rows stay zero.

    Weights shrink by ``sparsity`` towards zero, so that terms that only tell single documents of
    the sample apart keep none.

    The sample may hold another share of ones than ``base_rate``; the bias is set right for it.
    """
    common = np.bincount(features, minlength=DIMENSIONS) >= min_rows
    kept = common[features]
    owner = np.repeat(np.arange(len(labels), dtype=np.int32), np.diff(bounds))[kept]
    names = np.flatnonzero(common)
    number = np.zeros(DIMENSIONS, np.int32)
    number[names] = np.arange(len(names), dtype=np.int32)
    features = number[features[kept]]
    bounds = np.searchsorted(owner, np.arange(len(labels) + 1))
    numbers = np.random.default_rng(9)
    n = len(names)
    share = labels.mean()
    model = Machine(float(np.log(share / (1 - share))), np.zeros(n), numbers.normal(0, 1e-3, (n, FACTORS)))
    bias, seen_bias = model.bias, start
    seen_w, seen_v = np.full(n, start), np.full((n, FACTORS), start)
    for _ in range(epochs):
        order = numbers.permutation(len(labels))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            lengths = bounds[rows + 1] - bounds[rows]
            cut = np.concatenate([[0], np.cumsum(lengths)])
            local = np.repeat(bounds[rows] - cut[:-1], lengths) + np.arange(cut[-1])
            x = features[local]
            current = Machine(bias, model.weights, model.vectors)
            error = current.scores(x, cut) - labels[rows]
            each = np.repeat(error, lengths)
            vectors = model.vectors[x]
            sums = np.repeat(summed(vectors, cut), lengths, axis=0)
            slope = np.bincount(x, each, n) / len(rows)
            seen_w += slope**2
            moved = model.weights - rate * slope / np.sqrt(seen_w)
            model.weights[:] = np.sign(moved) * np.maximum(
                np.abs(moved) - rate * sparsity / np.sqrt(seen_w), 0
            )
            for f in range(FACTORS):
                slope = np.bincount(x, each * (sums[:, f] - vectors[:, f]), n) / len(rows)
                slope += decay * model.vectors[:, f]
                seen_v[:, f] += slope**2
                model.vectors[:, f] -= 0.1 * rate * slope / np.sqrt(seen_v[:, f])
            slope = error.mean()
            seen_bias += slope**2
            bias -= rate * slope / np.sqrt(seen_bias)
    bias += np.log(base_rate / (1 - base_rate)) - np.log(share / (1 - share))
    weights, vectors = np.zeros(DIMENSIONS, np.float32), np.zeros((DIMENSIONS, FACTORS), np.float32)
    weights[names], vectors[names] = model.weights, model.vectors
    return Machine(float(bias), weights, vectors)


def held_out(identifier: Column) -> Column:
    text = F.coalesce(identifier.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = 12_000,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> Machine:
    """Fit on at most ``max_rows`` labelled documents that are not held out, by least hash.

    A third of them at most are of label 1. An identifier's label is the largest of its rows, its
    text the greatest of its documents'. Without both labels the machine always gives the share
    of label 1, and 0 without any.
    """
    truth = (
        labels.filter(F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
        .filter(~held_out(F.col(id_column)))
        .groupBy(id_column)
        .agg(F.max(label_column).cast("int").alias("label"))
        .join(docs.select(id_column).distinct(), id_column, "left_semi")
    )
    counts = {r["label"]: r["count"] for r in truth.groupBy("label").count().collect()}
    ones, rows = counts.get(1, 0), sum(counts.values())
    if not ones or ones == rows:
        flat = np.zeros(DIMENSIONS, np.float32), np.zeros((DIMENSIONS, FACTORS), np.float32)
        rate = min(max(ones / (rows + 1), 1e-9), 1 - 1e-9)
        return Machine(float(np.log(rate / (1 - rate))), *flat)
    chosen = None
    for label, limit in ((1, max_rows // 3), (0, max_rows - max_rows // 3)):
        part = truth.filter(F.col("label") == label)
        part = part.orderBy(F.xxhash64(id_column), id_column).limit(limit)
        chosen = part if chosen is None else chosen.unionAll(part)
    # At most max_rows identifiers and labels: their bound is in the limits above.
    sample = (
        docs.select(id_column, F.coalesce(F.col(text_column), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), id_column)
        .groupBy(id_column, "label")
        .agg(F.max("text").alias("text"))
        .orderBy(F.xxhash64(id_column), id_column)
        .select("text", "label")
    )

    def to_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            at = 0
            for features, bounds in features_of(got["text"]):
                n = len(bounds) - 1
                lists = pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()), pa.array(features, pa.int32())
                )
                yield pa.RecordBatch.from_arrays(
                    [lists, got["label"].slice(at, n)], ["features", "label"]
                )
                at += n

    schema = StructType(
        [StructField("features", ArrayType(IntegerType())), StructField("label", IntegerType())]
    )
    got = sample.mapInArrow(by_value(to_features), schema).toArrow()
    lists = got["features"].combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks)
    return fit(
        lists.flatten().to_numpy(),
        np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]),
        got["label"].to_numpy().astype(np.float64),
        ones / rows,
    )


def score(docs: DataFrame, machine: Machine, text_column: str = "text") -> DataFrame:
    """Every row with ``score``; null and empty texts have no features and get the bias alone.

    A column of that name is replaced; all others pass through.
    """
    docs = docs.drop("score")
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])
    machine_bias, weights, vectors = machine.bias, machine.weights, machine.vectors

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Machine(machine_bias, weights, vectors)
        for got in batches:
            parts = [model.scores(f, b) for f, b in features_of(got[text_column])]
            column = np.concatenate(parts) if parts else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [*got.columns, pa.array(column, pa.float64())], [*got.schema.names, "score"]
            )

    return docs.mapInArrow(by_value(scored), schema)
