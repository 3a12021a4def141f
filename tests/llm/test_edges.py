"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import (
    decontamination,
    line_dedup,
    minhash,
    mixing,
    stages,
    substring_dedup,
    suffix_dedup,
    topk_search,
    toxicity,
    url_filter,
    warc,
)

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars int"
CLASHES = (
    "n_lines n_dropped kept_text copy shuffle_key n_words n_hit items contaminated class_id "
    "keep score node root batch id ids texts words prints h1 position first"
).split()


def prose(seed, words):
    numbers = random.Random(seed)
    return " ".join(f"w{numbers.randrange(5000)}" for _ in range(words))


@pytest.fixture(scope="module")
def docs(spark):
    shared = prose(1, 120)
    rows = [
        (1, None, "en", "a", None),
        (2, "", None, None, 0),
        (3, " \t\n\n ", "en", "a", 5),
        (4, shared, "en", "b", 9),
        (4, shared, "en", "b", 9),
        (None, shared, "en", "b", 9),
        (None, None, None, None, None),
        (5, prose(2, 30) + " " + shared + "\n" + prose(3, 20), "en", "a", 9),
        (6, shared.replace("w1", "W1", 1), "en", "c", 9),
        (7, "idiot", "en", "a", 5),
        (8, "naïve naïve 漢字 é", "fr", "c", 18),
        (9, prose(4, 20000), "en", "a", 90000),
        (10, "!!! ???", "en", "a", 7),
        (11, "!!! ???", "en", "a", 7),
        (12, "same " * 200, "en", "a", 1000),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def run_all(spark, docs):
    labels = spark.createDataFrame(
        [(i, i % 2, int(i == 7)) for i in range(1, 13)], "doc_id long, quality int, toxic int"
    )
    items = spark.createDataFrame([(1, prose(1, 14)), (2, None), (None, "a b")], "item_id long, text string")
    machine = toxicity.train(docs, labels)
    return {
        "lines": line_dedup.drop_frequent_lines(docs, min_docs=2),
        "mixed": mixing.mix_sources(docs, {"a": 1.0, "b": 2.0}, other_weight=1.0, amount=3.0),
        "hits": decontamination.find_contamination(docs, items),
        "near": minhash.near_duplicates(docs),
        "scored": toxicity.score(docs, machine),
        "words": substring_dedup.remove_repeated_words(docs),
        "bytes": suffix_dedup.remove_repeated_bytes(docs),
    }


@pytest.mark.parametrize("clash", [False, True])
def test_every_operator_takes_every_row(spark, docs, clash):
    given = docs.withColumns({c: F.lit(7) for c in CLASHES}) if clash else docs
    found = {name: df.collect() for name, df in run_all(spark, given).items()}
    for name, rows in found.items():
        if name != "mixed":
            assert len(rows) == docs.count(), name
    by_id = {r.doc_id: r for r in found["lines"]}
    assert (by_id[1].n_lines, by_id[1].kept_text) == (1, "")
    assert (by_id[3].n_lines, by_id[3].n_dropped) == (3, 0)
    assert (by_id[4].n_dropped, by_id[10].n_dropped) == (1, 1)
    near = {(r.doc_id, r.class_id) for r in found["near"]}
    assert {(4, 4), (6, 4), (None, 4), (1, 1), (2, 2), (3, 3), (10, 10), (11, 10)} <= near
    assert sum(r.keep for r in found["near"] if r.class_id == 4) == 2  # one row, given twice
    assert {r.doc_id for r in found["hits"] if r.contaminated} == {4, None, 5, 6}
    assert all(0 <= r.score <= 1 for r in found["scored"])
    words = {r.id: r for r in found["words"]}
    assert (words[4].n_words, words[4].n_removed, words[4].kept_text) == (120, 120, "")
    assert (words[12].n_words, words[12].n_removed) == (200, 200)
    assert (words[9].n_removed, words[1].n_words) == (0, 0)
    sizes = {r.id: (r.n_bytes, r.n_removed, r.n_spans) for r in found["bytes"]}
    assert sizes[1] == sizes[2] == (0, 0, 0)
    assert sizes[12] == (1000, 1000, 1)


def test_empty_tables(spark, docs):
    for name, df in run_all(spark, docs.limit(0)).items():
        assert df.count() == 0, name
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.judge_urls(none, []).count() == 0
    assert warc.round_trip(none).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk_search.nearest(vectors, vectors).count() == 0


def test_stages_return_documents(spark, docs, tmp_path):
    spark.createDataFrame([(7, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    spark.createDataFrame([(1, prose(1, 14))], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    for stage in (
        stages.drop_toxic,
        stages.drop_shared_lines,
        stages.keep_one_of_each_group,
        stages.drop_contaminated,
    ):
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    kept = stages.keep_one_of_each_group(spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in kept if r.doc_id)[:4] == [
        (False, 1), (False, 2), (False, 3), (False, 4),
    ]


def test_removed_bytes_equal_brute_force(spark):
    numbers = random.Random(5)
    passage = prose(6, 40)
    texts = [prose(i, numbers.randrange(1, 60)) for i in range(60)]
    for i in range(0, 60, 3):
        cut = numbers.randrange(len(passage) - 70)
        texts[i] += passage[cut : cut + numbers.randrange(60, 120)] + texts[i][:20]
    texts += [texts[0], "aé" * 300, "b" + "é" * 200]
    length = 64
    raw = [t.encode() for t in texts]
    counts = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.id: r for r in suffix_dedup.remove_repeated_bytes(df, length).collect()}
    for i, b in enumerate(raw):
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if counts[b[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((gone & ~np.append(False, gone[:-1])).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        assert (found[i].n_removed, found[i].n_spans, bytes(found[i].kept)) == (
            gone.sum(), spans, kept,
        )


def test_planted_passages_go_from_400_bytes_on(spark):
    def passage(first: int, size: int) -> str:
        return " ".join(f"{i:06}" for i in range(first, first + 70))[:size]

    planted = [passage(0, 399), passage(100, 400), passage(200, 480)]
    assert all(len(p.split()) > 50 for p in planted)
    rows = [(2 * i + k, f"{k}{p}{k}") for i, p in enumerate(planted) for k in (0, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.id: (r.n_removed, bytes(r.kept)) for r in suffix_dedup.remove_repeated_bytes(df).collect()}
    for i, p in enumerate(planted):
        for k in (0, 1):
            whole, mark = f"{k}{p}{k}".encode(), str(k).encode()
            assert found[2 * i + k] == ((0, whole) if len(p) < 400 else (len(p), mark * 2))


def test_loser_tree_merges_runs_with_common_prefixes():
    numbers = random.Random(8)
    strings = [bytes(numbers.choice(b"ab") for _ in range(numbers.randrange(12))) for _ in range(300)]
    runs = [sorted(strings[i::7]) for i in range(7)]

    def coded(run):
        last = b""
        for s in run:
            yield suffix_dedup.common_prefix(last, s, 0), s
            last = s

    merged = list(suffix_dedup.LoserTree([coded(r) for r in runs]).merged())
    assert [s for _, _, s in merged] == sorted(strings)
    for (_, _, a), (_, shared, b) in zip(merged, merged[1:], strict=False):
        assert shared == suffix_dedup.common_prefix(a, b, 0)


def test_near_duplicates_equal_brute_force(spark):
    numbers = random.Random(9)
    texts = []
    for group in range(40):
        base = prose(group, numbers.randrange(3, 200)).split()
        for _ in range(numbers.randrange(1, 6)):
            copy = list(base)
            for _ in range(numbers.randrange(0, 1 + len(copy) // 30)):
                copy[numbers.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
    bags = []
    for t in texts:
        w = re.findall(r"\w+", t)
        bags.append(Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))))
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(bags):
        for j, b in enumerate(bags[:i]):
            shared = sum((a & b).values())
            if shared >= 0.8 * (a.total() + b.total() - shared):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in minhash.near_duplicates(df).collect()}
    assert found == {i: find(i) for i in range(len(texts))}


def test_signatures_estimate_weighted_similarity():
    text = np.array([0] * 40 + [1] * 40)
    shingle = np.concatenate([np.arange(40), np.arange(20, 60)]).astype(np.uint64)
    weight = np.array([3] * 40 + [5] * 40)
    a, b = minhash.signatures(text, shingle, weight, 2, 4000)
    truth = 20 * 3 / (40 * 3 + 40 * 5 - 20 * 3)
    assert abs((a == b).mean() - truth) < 0.03


def test_archives_reject_magic_inside_payloads(spark):
    fake = (
        "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\n"
        "Content-Length: 3\r\n\r\nabc\r\n\r\n"
    )
    rows = [
        (1, "http://a/\r\nX: y", "x" + fake + "y"),
        (2, None, fake),
        (3, "u", fake),
        (4, "u", None),
        (5, "u", ""),
        (6, "u", "é" * 1000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    from stratalake.session import scratch_dir

    path = scratch_dir(spark, "archives")
    warc.write_warc(pages, path, records_per_file=3)
    found = {r.record_id: r for r in warc.read_warc(spark, path).collect()}
    assert set(found) == {f"<urn:page:{i}>" for i in range(1, 7)}
    assert found["<urn:page:3>"].refers_to == "<urn:page:2>"
    assert found["<urn:page:5>"].record_type == "revisit"
    assert bytes(found["<urn:page:1>"].payload).decode() == rows[0][2]
    assert found["<urn:page:6>"].payload_bytes == 2000


def test_search_with_ties_nulls_and_few_candidates(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None),
        (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]), (7, [-1.0, 0.5]),
        (8, [1e6, 1e6]), (None, [1.0, 1.0]),
    ]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk_search.nearest(v, v.filter("vec_id = 0"), k=3).orderBy("rank").collect()
    assert [(r.rank, r.vec_id) for r in found] == [(1, 8), (2, 1), (3, 2)]
    every = topk_search.nearest(v, v.filter("vec_id = 0"), k=50)
    assert every.count() == 5


def test_urls_by_rules_and_by_what_rules_teach(spark):
    rules = [url_filter.rule("block", "net/"), url_filter.rule("allow", "good.net/en/"),
             url_filter.rule("allow", "org/")]
    numbers = random.Random(3)

    def word():
        return "".join(numbers.choice("abcdefgh") for _ in range(6))

    rows = [(i, f"http://{word()}.{numbers.choice(['net', 'org'])}/{word()}") for i in range(400)]
    rows += [(900, None), (901, "no scheme"), (902, "x://A.GOOD.net/en/1?q#f"),
             (903, "x://good.net"), (904, "x://good.net/enx"), (905, "x://notnet/")]
    rows += [(1000 + i, f"http://{word()}.{t}?{word()}") for i in range(50) for t in ("net", "org")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit(1))
    found = {}
    for r in url_filter.judge_urls(pages, rules).collect():
        found.setdefault(r.page_id, []).append(r)
    assert (found[900][0].host, found[901][0].path, found[900][0].rule) == ("", "", None)
    r = found[902][0]
    assert (r.host, r.path, r.rule, r.verdict) == ("a.good.net", "/en/1", "good.net/en/", "allow")
    assert (found[903][0].rule, found[904][0].rule, found[905][0].rule) == (None, "net/", None)
    # Without a path no rule fits; the model knows the hosts' endings.
    unseen = [r for i in range(1000, 1050) for r in found[i]]
    right = sum((r.verdict == "block") == r.host.endswith(".net") for r in unseen)
    assert right >= 0.9 * len(unseen)


def test_toxicity_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.train(docs, labels))
    rows = (
        scored.filter(toxicity.held_out(F.col("doc_id"))).join(labels, "doc_id").collect()
    )
    right = sum((r.score >= 0.5) == (r.toxic == 1) for r in rows)
    assert right >= 0.95 * len(rows)  # of some 250 toxic rows to learn from


def test_copies_have_the_poisson_mean_and_one_order(spark):
    docs = spark.range(3000).selectExpr("id doc_id", "'abcd' text", "if(id < 1000, 'a', 'b') source")
    rows = mixing.mix_sources(docs, {"a": 1.0, "b": 1.0}).collect()
    share = Counter(r.source for r in rows)
    assert abs(share["a"] - 1500) < 200 and abs(share["b"] - 1500) < 200
    assert [r.shuffle_key for r in rows] == sorted(r.shuffle_key for r in rows)
    assert hashlib.md5(f"mix|order|{rows[0].doc_id}|{rows[0].copy}".encode()).hexdigest() == rows[0].shuffle_key


def test_blocks_count_what_sets_share():
    numbers = np.random.default_rng(4)
    base = numbers.integers(0, 2**63, 20000, dtype=np.uint64)
    sets = []
    for size in (300, 20000):  # the second takes several matrices
        for _ in range(12):
            own = numbers.integers(0, 2**63, size // 9, dtype=np.uint64)
            gone = int(numbers.integers(0, size // 5))
            sets.append(np.unique(np.concatenate([base[gone:size], own[: gone // 2]])))
    sets.append(np.empty(0, np.uint64))
    shared = minhash.overlaps(sets, sets)
    truth = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert (shared == np.array(truth)).all()
