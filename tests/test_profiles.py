"""Merged profiles against the profile of the whole and against exact quantiles."""

import math
import random

from stratalake.operators.profiles import ACCURACY, merged_profile, profile_part

FIELDS = "x double, k long, t string"
COLUMNS = ["x", "k", "t"]


def made(n):
    numbers = random.Random(3)
    odd = [(None, None, None), (0.0, 0, ""), (float("nan"), 1, "a"), (float("inf"), -5, "b"), (-0.0, 2, "é")]
    return odd + [
        (numbers.choice([-1, 1]) * math.exp(numbers.uniform(-20, 20)), numbers.randrange(-900, 900),
         f"t{numbers.randrange(700)}")
        for _ in range(n)
    ]


def test_parts_merge_to_the_profile_of_the_whole(spark):
    rows = made(4000)
    whole = spark.createDataFrame(rows, FIELDS)
    parts = [spark.createDataFrame(rows[i::3], FIELDS) for i in range(3)]
    stored = profile_part(parts[0], COLUMNS, "0")
    for i, part in enumerate(parts[1:], 1):
        stored = stored.unionByName(profile_part(part, COLUMNS, str(i)))
    quantiles = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)
    one = merged_profile(profile_part(whole, COLUMNS, "all"), quantiles)
    found = {r.column_name: r for r in merged_profile(stored, quantiles).collect()}
    for r in one.collect():
        merged = found[r.column_name]
        for name in set(one.columns) - {"mean"}:
            assert r[name] == merged[name], (r.column_name, name)
    exact = sorted(x for x, _, _ in rows if x is not None and math.isfinite(x))
    assert (found["x"].row_count, found["x"].null_count) == (len(rows), 1)
    assert (found["x"].min_number, found["x"].max_number) == (exact[0], exact[-1])
    assert math.isclose(found["x"].mean, math.fsum(exact) / len(exact), rel_tol=1e-9)
    for q, value in zip(quantiles, found["x"].quantiles):
        wanted = exact[max(math.ceil(q * len(exact)), 1) - 1]
        assert abs(value - wanted) <= ACCURACY * abs(wanted) * (1 + 1e-9), q
    assert abs(found["t"].distinct_count - len({t for *_, t in rows if t is not None})) <= 40
    assert found["t"].quantiles is None and found["t"].min_text == ""


def test_empty_loads_and_columns_without_values(spark):
    none = profile_part(spark.createDataFrame([], FIELDS), COLUMNS, "none")
    nulls = profile_part(spark.createDataFrame([(None, None, None)] * 2, FIELDS), COLUMNS, "nulls")
    for r in merged_profile(none.unionByName(nulls)).collect():
        assert (r.row_count, r.null_count, r.distinct_count) == (2, 2, 0)
        assert r.quantiles is None and r["mean"] is None
    texts = profile_part(spark.createDataFrame([("a",)], "t string"), ["t"], "texts")
    assert merged_profile(texts).first().max_text == "a"
