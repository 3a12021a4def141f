"""Documents that repeat benchmark items, found by winnowing.

Every window of ``window`` words holds ``window - gram + 1`` grams; its fingerprint is the least
of their hashes. Two equal windows have equal fingerprints wherever they stand, so a join of the
distinct fingerprints of documents and items misses no shared window. A document keeps about one
in three of its grams. Where fingerprints meet, the windows themselves are compared as words, and
each hit extends over all windows that follow it in the same way. Items shorter than a window are
one window of their own length.

The benchmark is counted, and broadcast only while its fingerprints are few; beyond that the same
joins shuffle, and adaptive execution splits a window that very many documents share. Documents'
texts move only once, to meet their own fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import (
    broadcast_below,
    document_keys,
    same_document,
    stage,
    words_of,
)

#: A benchmark of at most so many fingerprints or windows is broadcast: below 200 MB.
BROADCAST_ROWS = 1_000_000


def spans(words: Column, length: int) -> Column:
    """Starts of all runs of ``length`` words."""
    return F.when(
        F.size(words) >= length, F.sequence(F.lit(1), F.size(words) - length + 1)
    ).otherwise(F.array().cast("array<int>"))


def gram_hashes(words: Column, gram: int) -> Column:
    return F.transform(spans(words, gram), lambda i: F.xxhash64(F.slice(words, i, gram)))


def with_fingerprints(df: DataFrame, gram: int, grams: int) -> DataFrame:
    """Per window of ``words`` the least of its grams' hashes, as ``prints``.

    The hashes are a column of their own: inside the lambda they would be made again per window.
    """
    hashes = F.col("hashes")
    return (
        df.withColumn("hashes", gram_hashes(F.col("words"), gram))
        .withColumn(
            "prints",
            F.transform(spans(hashes, grams), lambda i: F.array_min(F.slice(hashes, i, grams))),
        )
        .drop("hashes")
    )


def whole_prints(words: Column, n: int) -> Column:
    """Fingerprints of runs of ``n`` words, for items of just that length."""
    return F.transform(spans(words, n), lambda i: F.xxhash64(F.lit(n), F.slice(words, i, n)))


def whole_places(words: Column, n: int) -> Column:
    return F.transform(
        spans(words, n),
        lambda i: F.struct(
            (i - 1).alias("at"),
            F.lit(n).alias("n"),
            F.xxhash64(F.lit(n), F.slice(words, i, n)).alias("print"),
        ),
    )


def item_windows(items: DataFrame, window: int, id_column: str, text_column: str) -> DataFrame:
    """``item, n, window`` for every window of every item with a word; ``item`` may be null."""
    words = F.col("words")
    n = F.least(F.size(words), F.lit(window))
    starts = F.sequence(F.lit(1), F.size(words) - n + 1)
    return (
        items.select(
            F.col(id_column).cast("string").alias("item"),
            words_of(F.col(text_column)).alias("words"),
        )
        .filter(F.size("words") > 0)
        .select(
            "item",
            n.alias("n"),
            F.explode(F.transform(starts, lambda i: F.slice(words, i, n))).alias("window"),
        )
        .distinct()
    )


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    gram: int = 6,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """Every document with ``n_words``, ``n_hit``, ``items`` (sorted) and ``contaminated``.

    A word is hit where it lies in an occurrence of a window of ``window`` consecutive words of an
    item, or of the whole of a shorter item. Null and empty texts have no words; items without
    words take no part, and items without identifier hit words, but are not among ``items``;
    repeated rows get equal results, and repeated items count once by identifier. Other columns pass through, and those named like a result are
    replaced.
    """
    grams = window - gram + 1
    windows = stage(item_windows(items, window, item_id_column, item_text_column), "item-windows")
    print_of = F.when(
        F.col("n") == window, F.array_min(gram_hashes(F.col("window"), gram))
    ).otherwise(F.xxhash64("n", "window"))
    prints = broadcast_below(windows.select(print_of.alias("print")).distinct(), BROADCAST_ROWS)
    # Lengths of items that are shorter than a window; at most window - 1 numbers.
    short = [r["n"] for r in windows.filter(F.col("n") < window).select("n").distinct().collect()]

    text = F.col(text_column)
    words = F.col("words")
    keyed = docs.select(*document_keys(F.col(id_column), text), words_of(text).alias("words"))
    hashed = with_fingerprints(keyed, gram, grams)
    for n in short:
        hashed = hashed.withColumn(f"short_{n}", whole_prints(words, n))
    every = F.concat("prints", *[F.col(f"short_{n}") for n in short]) if short else F.col("prints")
    met = (
        hashed.select("__id", "__text", F.explode(F.array_distinct(every)).alias("print"))
        .join(prints, "print")
        .groupBy("__id", "__text")
        .agg(F.collect_set("print").alias("met"))
    )
    met = stage(met, "met-fingerprints")

    text_rows = docs.select(*document_keys(F.col(id_column), text), text.alias("text"))
    suspects = text_rows.join(met, same_document(text_rows, met)).select(
        text_rows["__id"], text_rows["__text"], words_of(F.col("text")).alias("words"), "met"
    )
    suspects = with_fingerprints(suspects, gram, grams)
    places = F.transform(
        "prints",
        lambda p, i: F.struct(i.alias("at"), F.lit(window).alias("n"), p.alias("print")),
    )
    for n in short:
        places = F.concat(places, whole_places(words, n))
    candidates = suspects.select(
        "__id",
        "__text",
        F.explode(
            F.transform(
                F.filter(places, lambda p: F.array_contains("met", p["print"])),
                lambda p: F.struct(
                    p["at"].alias("at"),
                    p["n"].alias("n"),
                    F.slice(words, p["at"] + 1, p["n"]).alias("window"),
                ),
            )
        ).alias("place"),
    ).select("__id", "__text", "place.*")
    by_window = windows.groupBy("n", "window").agg(F.collect_set("item").alias("items"))
    hits = (
        candidates.join(broadcast_below(stage(by_window, "windows"), BROADCAST_ROWS), ["n", "window"])
        .groupBy("__id", "__text")
        .agg(
            F.collect_set(F.struct("at", "n")).alias("places"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("__items"),
        )
        .select(
            "__id",
            "__text",
            F.size(
                F.array_distinct(
                    F.flatten(
                        F.transform(
                            "places", lambda p: F.sequence(p["at"], p["at"] + p["n"] - 1)
                        )
                    )
                )
            ).alias("__hit"),
            "__items",
        )
    )
    out = docs.select(
        "*", *document_keys(F.col(id_column), text), F.size(words_of(text)).alias("__words")
    )
    return (
        out.join(hits, same_document(out, hits), "left")
        .drop(hits["__id"], hits["__text"])
        .withColumns(
            {
                "n_words": F.col("__words").cast("long"),
                "n_hit": F.coalesce("__hit", F.lit(0)).cast("long"),
                "items": F.array_sort(
                    F.coalesce("__items", F.array().cast("array<string>"))
                ),
                "contaminated": F.coalesce(F.col("__hit") > 0, F.lit(False)),
            }
        )
        .drop("__id", "__text", "__words", "__hit", "__items")
    )
