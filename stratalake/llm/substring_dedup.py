"""Repeated runs of words, found by difference-cover anchors.

A difference cover modulo 21 is a set of five residues in which every difference modulo 21 occurs.
Take two equal windows of 35 words that start at any places of their documents: within the first
21 words there is an offset at which both stand on cover positions. So it suffices to fingerprint
the 15 words from every cover position, less than a quarter of all positions: equal windows share
an aligned anchor. Windows that hold a repeated anchor are then extended to all their words and
compared by 128 bits; all others cannot repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

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
from stratalake.llm.text_bytes import NOT_BLANK, Hasher, bytes_of, words_in

WINDOW = 35
#: A perfect difference set: every difference modulo PERIOD occurs.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)


class Words:
    """The words of a batch of texts, and hashes of all runs of a length."""

    def __init__(self, texts: pa.Array, window: int):
        self.window = window
        self.data, bounds = bytes_of(texts)
        self.starts, self.ends, self.first = words_in(self.data, bounds, NOT_BLANK)
        self.counts = np.diff(self.first)
        n = len(self.starts)
        self.text = np.repeat(np.arange(len(self.counts)), self.counts)
        self.at = np.arange(n) - self.first[:-1][self.text]
        self.left = self.counts[self.text] - self.at
        spelled = Hasher(10)
        self.hashes = spelled.between(spelled.of_bytes(self.data), self.starts, self.ends)

    def runs(self, length: int, places: np.ndarray, seed: int) -> np.ndarray:
        hasher = Hasher(seed)
        prefix = hasher.prefix(self.hashes)
        return hasher.between(prefix, places, places + length)

    def anchors(self) -> np.ndarray:
        """Cover positions of texts that have a window, with words enough behind them."""
        cover = np.zeros(PERIOD, bool)
        cover[list(COVER)] = True
        short = self.window - PERIOD + 1
        long_enough = (self.counts >= self.window)[self.text]
        return np.flatnonzero(cover[self.at % PERIOD] & long_enough & (self.left >= short))

    def anchor_hashes(self) -> Distinct:
        return Distinct(self.runs(self.window - PERIOD + 1, self.anchors(), 11))

    def candidates(self, flags) -> np.ndarray:
        """Starts of windows that hold an anchor found twice."""
        distinct = self.anchor_hashes()
        twice = (distinct.counts > 1) | (answers(flags, len(distinct.counts)) > 0)
        seen = np.zeros(len(self.starts) + PERIOD + 1, np.int64)
        seen[self.anchors() + 1] = twice[distinct.place]
        seen = np.cumsum(seen)
        places = np.flatnonzero(self.left >= self.window)
        return places[seen[places + PERIOD] > seen[places]]

    def window_hashes(self, places: np.ndarray) -> Distinct:
        return Distinct(*(self.runs(self.window, places, seed) for seed in (12, 13)))


def spelled_out(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of bytes one after another, each followed by a blank; where each begins."""
    lengths = ends - starts + 1
    at = np.append(0, np.cumsum(lengths))
    out = np.full(at[-1], 0x20, np.uint8)
    source = np.repeat(starts - at[:-1], lengths) + np.arange(at[-1])
    inside = np.ones(at[-1], bool)
    inside[at[1:] - 1] = False
    out[inside] = data[source[inside]]
    return out, at


def remove_repeated_words(
    docs: DataFrame,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``id, n_words, n_removed, kept_text`` of every document.

    Words are runs of anything but blanks, unchanged. A word is removed where any window of
    ``window`` consecutive words that covers it starts a second time anywhere, in the same
    document included; windows do not cross documents, and all are judged on the input. The kept
    words are joined by one blank. Null and empty texts have no words and an empty ``kept_text``;
    each of several equal rows is a place of its own. Other columns are not read. ``window`` is
    more than ``PERIOD``.
    """
    if window <= PERIOD:
        raise ValueError(f"windows of {PERIOD} words or fewer are not covered")
    batches = Batches(docs, id_column, text_column)
    bits = batches.bits

    def send_anchors(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in arrived:
            for i, batch in enumerate(got["batch"].to_pylist()):
                words = Words(got["texts"].slice(i, 1).flatten(), window)
                yield words.anchor_hashes().packed(bits, batch, SENT_SCHEMA)

    anchors = reply(batches.run(send_anchors, SENT), elsewhere(1), "anchor_reply")

    def send_windows(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in arrived:
            for i, batch in enumerate(got["batch"].to_pylist()):
                words = Words(got["texts"].slice(i, 1).flatten(), window)
                places = words.candidates(got["anchor_reply"][i].as_py())
                yield words.window_hashes(places).packed(bits, batch, SENT_SCHEMA)

    windows = reply(batches.run(send_windows, SENT, anchors), elsewhere(2), "window_reply")

    def remove(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in arrived:
            for i in range(got.num_rows):
                words = Words(got["texts"].slice(i, 1).flatten(), window)
                places = words.candidates(got["anchor_reply"][i].as_py())
                distinct = words.window_hashes(places)
                flags = answers(got["window_reply"][i].as_py(), len(distinct.counts))
                repeated = places[((distinct.counts > 1) | (flags > 0))[distinct.place]]
                cover = np.zeros(len(words.starts) + 1, np.int64)
                cover[repeated] += 1
                cover[repeated + window] -= 1
                gone = np.cumsum(cover)[:-1] > 0
                kept = np.flatnonzero(~gone)
                text, at = spelled_out(words.data, words.starts[kept], words.ends[kept])
                per_text = np.bincount(words.text[kept], minlength=len(words.counts))
                cuts = np.append(0, np.cumsum(per_text))
                begin, end = at[cuts[:-1]], at[cuts[1:]]
                raw = text.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        got["ids"].slice(i, 1).flatten(),
                        pa.array(words.counts, pa.int64()),
                        pa.array(words.counts - per_text, pa.int64()),
                        # The blank after a document's last word is no part of it.
                        pa.array(
                            [raw[s : e - 1] if e > s else b"" for s, e in zip(begin, end, strict=True)],
                            pa.binary(),
                        ).cast(pa.string()),
                    ],
                    ["id", "n_words", "n_removed", "kept_text"],
                )

    schema = StructType(
        [
            StructField("id", batches.id_type),
            StructField("n_words", LongType()),
            StructField("n_removed", LongType()),
            StructField("kept_text", StringType()),
        ]
    )
    return batches.run(by_value(remove), schema, anchors, windows)
