"""Judging URLs by host and path: rules first, then logistic regression on hashed n-grams.

The model is trained on a small table of labelled URLs by accelerated gradient descent. A step is
one aggregation over that table: each row's error goes to its n-grams, and the sums per n-gram,
at most one per dimension of the model, come back to the driver. Sums are taken over whole
numbers, so the model does not depend on the order of rows. Scoring is an expression over the
page's own row; no page moves.
"""

from __future__ import annotations

import json
import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import ascii_lower, stage

BLOCK, ALLOW = "block", "allow"
#: Errors are added as whole multiples of this.
STEP = 1e-9


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    """``example.net/en/`` as host and path; A-Z of the host count as a-z."""
    if verdict not in (BLOCK, ALLOW):
        raise ValueError(f"verdict {verdict!r}")
    host, slash, path = text.partition("/")
    lowered = host.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    return Rule(verdict, lowered, slash + path)


def host_of(url: Column) -> Column:
    return ascii_lower(
        F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    )


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fits(r: Rule, host: Column, path: Column) -> Column:
    return ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)


def by_rules(rules: Sequence[Rule], value: str) -> Column:
    """``value`` of the longest rule that fits ``host`` and ``path``; else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        out = F.when(fits(r, F.col("host"), F.col("path")), F.lit(getattr(r, value))).otherwise(out)
    return out


def hashed_grams(letters: Column, name: str, n: int, dimensions: int) -> Column:
    starts = F.when(
        F.size(letters) >= n, F.sequence(F.lit(1), F.size(letters) - n + 1)
    ).otherwise(F.array().cast("array<int>"))

    def hashed(i: Column) -> Column:
        gram = F.array_join(F.slice(letters, i, n), "")
        return F.pmod(F.xxhash64(F.lit(name), gram), F.lit(dimensions)).cast("int")

    return F.transform(starts, hashed)


def with_grams(df: DataFrame, dimensions: int, sizes: Sequence[int] = (3, 4)) -> DataFrame:
    """Adds ``grams``: the distinct hashed n-grams of ``host`` and ``path`` with marked ends."""
    grams = []
    for name in ("host", "path"):
        # Letters as a column of their own, so that they are split once per row.
        framed = F.concat(F.lit("\x02"), F.col(name), F.lit("\x03"))
        df = df.withColumn(f"{name}_letters", F.split(framed, ""))
        letters = F.col(f"{name}_letters")
        for n in sizes:
            grams.append(hashed_grams(letters, name, n, dimensions))
    grams = F.array_sort(F.array_distinct(F.concat(*grams)))
    return df.withColumn("grams", grams).drop("host_letters", "path_letters")


def probability(weights: list[float]) -> Column:
    """Of ``block``, for a row with ``grams``; the last weight is the bias."""
    # One constant of the plan, as long as the model and no longer.
    model = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    added = F.aggregate("grams", F.lit(0.0), lambda total, g: total + F.get(model, g))
    length = F.sqrt(F.greatest(F.size("grams"), F.lit(1)).cast("double"))
    return 1 / (1 + F.exp(-(added / length + F.lit(weights[-1]))))


def train(
    labelled: DataFrame, dimensions: int = 4096, steps: int = 30, decay: float = 1e-4
) -> list[float] | None:
    """Weights for ``grams`` and a bias, from rows of ``grams, label`` (1 for block).

    None where one of the labels is missing.
    """
    rows, ones = labelled.agg(F.count("label"), F.sum("label")).first()
    if not ones or ones == rows:
        return None
    length = F.sqrt(F.greatest(F.size("grams"), F.lit(1)).cast("double"))
    weights = [0.0] * (dimensions + 1)
    ahead, previous = list(weights), list(weights)
    rate = 2.0  # the loss of rows of length 1 with a bias curves by at most 1/2
    for step in range(1, steps + 1):
        errors = labelled.withColumn("p", probability(ahead)).select(
            (F.col("p") - F.col("label")).alias("error"), "grams", length.alias("length")
        )
        scaled = errors.select(
            F.explode(F.concat("grams", F.array(F.lit(dimensions)))).alias("gram"),
            "error",
            "length",
        ).select(
            "gram",
            F.round(
                F.col("error")
                / F.when(F.col("gram") == dimensions, F.lit(1.0)).otherwise(F.col("length"))
                / STEP
            )
            .cast("long")
            .alias("part"),
        )
        sums = scaled.groupBy("gram").agg(F.sum("part").alias("part")).collect()
        gradient = [decay * w for w in ahead]
        for row in sums:  # at most one per dimension
            gradient[row["gram"]] += row["part"] * STEP / rows
        previous, weights = weights, [a - rate * g for a, g in zip(ahead, gradient, strict=True)]
        pull = (step - 1) / (step + 2)
        ahead = [w + pull * (w - p) for w, p in zip(weights, previous, strict=True)]
    return weights


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    labelled: DataFrame | None = None,
    max_labelled: int = 4000,
    dimensions: int = 4096,
    url_column: str = "url",
) -> DataFrame:
    """Every page with ``host``, ``path``, ``rule`` and ``verdict``.

    The host reaches from the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased,
    the path from there to ``?``, ``#`` or the end; both are empty for null and where ``://`` is
    missing. A rule fits its host and all below it where the path starts with the rule's; the
    longest wins, ties go to the first in text order. Pages without a fitting rule are judged by
    the model. ``labelled`` holds ``url`` and ``label`` (1 for block); without it the pages' own
    URLs that a rule decides are the labelled table. Of either, ``max_labelled`` distinct URLs by
    least hash are learnt from. Without both labels there is no model, and the verdict is
    ``allow``. Columns named like a result are replaced; repeated rows are judged alike.
    """
    parts = {"host": host_of(F.col(url_column)), "path": path_of(F.col(url_column))}
    judged = (
        pages.drop("host", "path", "rule", "verdict")
        .withColumns(parts)
        .withColumns({"rule": by_rules(rules, "text"), "__by_rule": by_rules(rules, "verdict")})
    )
    if labelled is None:
        labelled = judged.filter(F.col("__by_rule").isNotNull()).select(
            "host", "path", (F.col("__by_rule") == BLOCK).cast("int").alias("label")
        )
    else:
        labelled = labelled.filter("label is not null").select(
            host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "label"
        )
    small = (
        labelled.distinct().orderBy(F.xxhash64("host", "path"), "host", "path", "label")
    ).limit(max_labelled)
    small = stage(with_grams(small, dimensions).select("grams", "label"), "labelled-urls")
    weights = train(small, dimensions)
    if weights is None:
        verdict = F.coalesce("__by_rule", F.lit(ALLOW))
        return judged.withColumn("verdict", verdict).drop("__by_rule")
    blocked = F.when(probability(weights) >= 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return (
        with_grams(judged, dimensions)
        .withColumn("verdict", F.coalesce("__by_rule", blocked))
        .drop("__by_rule", "grams")
    )
