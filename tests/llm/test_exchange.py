"""What passes find out about batches stays in their buckets, and only as long as it is read."""

import random
import re
import uuid

from pyspark.sql import functions as F

from stratalake.llm import common, exchange, suffix_dedup


def test_states_are_not_shuffled_nor_left(spark, tmp_path, monkeypatch):
    for module in (common, exchange):
        monkeypatch.setattr(
            module, "scratch_dir", lambda _, label: f"file://{tmp_path}/{label}-{uuid.uuid4().hex}"
        )
    numbers = random.Random(3)
    shared = "".join(numbers.choice("abcdef ") for _ in range(300))
    docs = spark.createDataFrame(
        [(i, f"{i} " * 20 + shared[i : i + 150]) for i in range(40)], "doc_id long, text string"
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = suffix_dedup.remove_repeated_bytes(docs, 100)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.agg(F.sum("n_removed")).first()[0] > 3000
    finally:
        for name in settings:
            spark.conf.unset(name)
    # Only the answers of two passes move; texts and both states lie by batch.
    assert len(re.findall(r"Exchange hashpartitioning\(batch", plan)) == 2
    left = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()}
    assert {"text-batches", "settled-blocks", "live-slices"} <= left
    assert not left & {"blocks", "live-blocks", "contents", "slices"}
