"""Words, and what finding them costs."""

import re
import time

from pyspark.sql import functions as F

from stratalake.llm.common import ascii_lower, words_of


def test_words_are_runs_between_ascii_marks(spark):
    texts = [
        None, "", " ", "a", "A-b_c", "--a--", "é Éa b", "x\x7fy\x00z", "0:9@Z[`{", "日本 語", "𝒳y Z\n\t1",
        "\x0b\x1c", "aB" * 50,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})
    for i, words in df.select("i", words_of(F.col("t"))).collect():
        expected = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (texts[i] or "").translate(lower))
        assert words == expected, texts[i]


def test_finding_words_costs_less_than_extracting_matches(spark):
    df = spark.createDataFrame([(i, "word " * 20_000) for i in range(16)], "i int, t string").cache()
    df.count()

    def seconds(words):
        found = []
        for _ in range(3):
            began = time.time()
            assert df.agg(F.sum(F.size(words))).first()[0] == 320_000
            found.append(time.time() - began)
        return min(found)

    pattern = F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    extracted = F.regexp_extract_all(ascii_lower(F.col("t")), pattern, F.lit(0))
    assert seconds(words_of(F.col("t"))) < 0.6 * seconds(extracted)
