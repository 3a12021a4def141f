"""What exact profiles hold in a task."""

import re

import pytest

from stratalake.operators import quality
from stratalake.operators.quality import profile_columns
from tests.conftest import rows_of


@pytest.mark.parametrize("rows_per_task, dealt", [(10, True), (500_000, False)])
def test_exact_profiles_sort_no_rows(spark, monkeypatch, rows_per_task, dealt):
    monkeypatch.setattr(quality, "ROWS_PER_TASK", rows_per_task, raising=False)
    monkeypatch.setattr(quality, "FEW_VALUES", 20, raising=False)
    df = spark.createDataFrame(
        [(i % 97 if i % 5 else None, f"s{i % 90}", None, [i % 3]) for i in range(200)],
        "a int, `b.c` string, d string, e array<int>",
    ).repartition(3)
    found = profile_columns(df, ["a", "b.c", "d", "e"], exact=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Strings' extremes beside distinct values would group all rows by sorting them, once per column.
    assert not re.search(r"SortAggregate\(key=\[[^\]]", plan)
    assert bool(re.search(r"hashpartitioning\([^\n]*REPARTITION_BY_NUM", plan)) == dealt
    a = {i % 97 for i in range(200) if i % 5}
    got = {r[0]: r[1:4] for r in rows_of(found)}
    assert got == {
        "a": (200, 40, len(a)), "b.c": (200, 0, 90), "d": (200, 200, 0), "e": (200, 0, 3),
    }


def test_exact_profile_of_no_rows(spark):
    df = spark.createDataFrame([], "a int, s string")
    assert rows_of(profile_columns(df, ["a", "s"], exact=True)) == [
        ("a", 0, 0, 0, None, None, None), ("s", 0, 0, 0, None, None, None),
    ]
