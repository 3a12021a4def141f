"""Merkle manifests against plain hashing."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from stratalake.llm import merkle

DOCS = "doc_id long, text string, lang string, n_chars int"
COLUMNS = ["doc_id", "lang", "n_chars", "text"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    doc_id, text, lang, n_chars = row
    values = [doc_id, lang, n_chars, text]
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(hashes, fanout):
    """The root, and per leaf the runs' other hashes on the way up."""
    paths, at, level = [""] * len(hashes), list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        runs = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        for i, place in enumerate(at):
            run = list(runs[place // fanout])
            del run[place % fanout]
            paths[i] += "".join(run)
            at[i] = place // fanout
        level = [digest("".join(run)) for run in runs]
    return level[0], paths


def plain(rows, fanout):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        mine = [(r[0] is not None, r[0] or 0, leaf_of(r), r) for r in rows if r[2] == lang]
        mine.sort(key=lambda x: x[:3])
        trees[lang] = (mine, *tree([m[2] for m in mine], fanout))
    root, over = tree([trees[x][1] for x in langs], fanout)
    return sorted(
        (leaf, subroot, root, digest(path + above))
        for (mine, subroot, paths), above in zip(trees.values(), over, strict=True)
        for (_, _, leaf, _), path in zip(mine, paths, strict=True)
    )


def invented(count, langs, seed=1):
    numbers = random.Random(seed)
    rows = [
        (numbers.choice([i, i, None]), numbers.choice([f"Text {i}", None, "", "É漢" * i]),
         numbers.choice(langs), numbers.choice([i, None]))
        for i in range(count)
    ]
    return rows + rows[: count // 4]


def given(found):
    return sorted(
        map(tuple, found.select(
            merkle.as_text(F.col("leaf")), merkle.as_text(F.col("subroot")),
            merkle.as_text(F.col("root")), merkle.proof_hash(F.col("path")),
        ).collect())
    )


@pytest.mark.parametrize(
    "rows, fanout",
    [
        (invented(90, ["en", "EN", None, "", "é"]), 8),
        (invented(30, ["en", "fr"]), 2),
        (invented(40, [f"l{i}" for i in range(12)]), 3),
        ([(1, "alone", None, 5)], 8),
        ([(None, None, None, None)] * 9, 8),
        ([(7, "same", "en", 4)] * 65, 8),
    ],
)
def test_manifests_are_those_of_plain_hashing(spark, rows, fanout):
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    found = merkle.manifest(docs, COLUMNS, fanout=fanout)
    assert given(found) == plain(rows, fanout)
    root = merkle.as_text(F.col("root"))
    assert found.filter(merkle.folded(F.col("suspect"), F.col("path")) != root).count() == 0


def test_a_changed_row_misses_the_root(spark):
    rows = [(i, f"Text {i}" if i % 4 else f"text {i}", "abc"[i % 3], i) for i in range(50)]
    docs = spark.createDataFrame(rows, DOCS)
    found = merkle.manifest(docs, COLUMNS, suspects={"text": F.lower("text")})
    assert given(found) == plain(rows, 8)  # what was changed changes no hash of the manifest
    kept = found.filter(
        merkle.folded(F.col("suspect"), F.col("path")) == merkle.as_text(F.col("root"))
    )
    assert sorted(r.id for r in kept.collect()) == list(range(0, 50, 4))


def test_long_texts_empty_tables_and_clashing_columns(spark):
    rows = [(1, "x" * 3_000_000, "en", 1), (2, "é" * 100_000, "en", 2), (3, "z", None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    clash = docs.withColumns({c: F.lit(1) for c in ("grp", "id", "h", "idx", "n", "tie", "part", "path", "up")})
    assert given(merkle.manifest(docs, COLUMNS)) == plain(rows, 8)
    assert given(merkle.manifest(clash, COLUMNS)) == plain(rows, 8)
    assert merkle.manifest(docs.limit(0), COLUMNS).count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(docs, COLUMNS, fanout=1)
