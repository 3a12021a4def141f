"""Near-duplicates against all pairs counted one by one."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from stratalake.llm import minhash
from stratalake.llm.common import perhaps_among, table


def bag(text: str | None) -> Counter:
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text) or re.findall(r"[^\x20\x09-\x0D]+", text)
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)) if words)


def classes(texts: dict[int, str | None], threshold: float = 0.8) -> dict[int, int]:
    """The least identifier of every document's component, by an inverted index of shingles."""
    bags = {i: bag(t) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, one in bags.items():
        for shingle in one:
            holders[shingle].append(i)
    top = {i: i for i in texts}

    def root(i: int) -> int:
        while top[i] != i:
            i = top[i]
        return i

    for i, one in bags.items():
        shared = Counter()
        for shingle, n in one.items():
            for j in holders[shingle]:
                if j > i:
                    shared[j] += min(n, bags[j][shingle])
        for j, n in shared.items():
            if n >= threshold * (one.total() + bags[j].total() - n):
                a, b = sorted((root(i), root(j)))
                top[b] = a
    return {i: root(i) for i in texts}


def found_classes(docs) -> dict[int, int]:
    return {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).select("doc_id", "class_id").collect()}


def test_whole_table_as_all_pairs_have_it(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    assert found_classes(docs) == classes({r.doc_id: r.text for r in docs.collect()})


def test_small_blocks_lose_no_link(spark, monkeypatch):
    # Chains of edits: neighbours are similar, ends are not, and buckets hold several components.
    monkeypatch.setattr(minhash, "BLOCK_NODES", 3)
    monkeypatch.setattr(minhash, "SLICE_BLOCKS", 2)
    texts = {}
    for chain in range(4):
        words = [f"w{k}" for k in range(120)]
        for step in range(40):
            place = (step * 7 + chain * 31) % 120
            words[place] = f"c{chain}s{step}"
            texts[100 * chain + step] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert found_classes(docs) == classes(texts)


def test_cells_hold_all_similar_pairs_and_no_pair_twice(spark):
    import numpy as np
    import pyarrow as pa

    draw = np.random.default_rng(5)
    base = draw.integers(0, 256, (4, 150), np.uint8)

    def nodes(n):
        out = []
        for k in range(n):
            marks = base[k % 4].copy()
            marks[draw.random(150) < 0.1 * (k % 3)] ^= 1
            name = bytes(draw.integers(0, 256, 16, np.uint8))
            out.append({"node": name, "root": name, "size": 100 + k, "sketch": marks.tobytes()})
        return out

    a, b = nodes(9), nodes(12)
    kind = pa.list_(pa.struct([("node", pa.binary()), ("root", pa.binary()), ("size", pa.int64()), ("sketch", pa.binary())]))
    batch = pa.RecordBatch.from_arrays([pa.array([a, a], kind), pa.array([b, a], kind)], ["nodes_a", "nodes_b"])
    rows = [r for out in minhash.promising_cells(0.8)([batch]) for r in out.to_pylist()]
    held = [{(x["node"], y["node"]) for x in r["left"] for y in r["right"]} for r in rows]
    least = minhash.least_agreement(0.8)

    def near(x, y):
        same = sum(p == q for p, q in zip(x["sketch"], y["sketch"], strict=True))
        return same >= least and min(x["size"], y["size"]) >= 0.8 * max(x["size"], y["size"])

    for x, y in [*((x, y) for x in a for y in b), *((x, y) for i, x in enumerate(a) for y in a[i + 1 :])]:
        if near(x, y):
            pair = (x["node"], y["node"])
            assert sum(pair in h or pair[::-1] in h for h in held) == 1


def test_filter_by_hash_passes_every_key_and_few_others(spark):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 1000 > 0, F.col("id")).alias("k"), (F.col("id") % 3).alias("t"), "id"
    )
    keys = rows.filter("id % 20 = 0").select("k", "t").distinct()
    passed = perhaps_among(rows, keys, "k", "t")
    assert passed.columns == rows.columns
    ids = {r.id for r in passed.collect()}
    assert set(range(0, 40_000, 20)) <= ids and len(ids) < 3500
    assert perhaps_among(rows, keys.limit(0), "k", "t").count() == 0
