"""Benchmark items without identifier."""

from stratalake.llm import decontamination


def test_items_without_identifier_hit_words(spark):
    words = [f"w{i}" for i in range(30)]
    texts = ["x " + " ".join(words[:12]), "y " + " ".join(words[15:30]), "a short one", "clean"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame(
        [(None, " ".join(words[:20])), (None, "short one"), (7, " ".join(words[15:26]))],
        "item_id long, text string",
    )
    found = decontamination.find_contamination(docs, items).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, r["items"], r.contaminated) for r in found] == [
        (13, 12, [], True), (16, 11, ["7"], True), (3, 2, [], True), (1, 0, [], False),
    ]
