"""Value standardisation: a list of rules per column becomes one expression."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_values(value: Column, mappings: Iterable[dict[str, Any]]) -> Column:
    """Replace each listed spelling; other values and null pass through unchanged.

    Each mapping is ``{"from": [spellings], "to": replacement}``; the first that lists a
    value decides. A long list becomes a hash set in the generated code, so one row costs
    one lookup per mapping however many spellings there are.
    """
    chosen = None
    for mapping in mappings:
        matches, target = value.isin(list(mapping["from"])), F.lit(mapping["to"])
        chosen = F.when(matches, target) if chosen is None else chosen.when(matches, target)
    return value if chosen is None else chosen.otherwise(value)


def standardize(value: Column, rules: Iterable[dict[str, Any]]) -> Column:
    """Apply rules in listed order.

    A rule is ``{"trim": True}``, ``{"upper_case": True}``, ``{"lower_case": True}``,
    ``{"regex_replace": {"pattern": p, "replacement": r}}`` or a value mapping. Adjacent
    mappings act as one, so the result of one never feeds the next.
    """
    pending: list[dict[str, Any]] = []
    for rule in rules:
        if "from" in rule:
            pending.append(rule)
            continue
        value, pending = map_values(value, pending), []
        for name, setting in rule.items():
            value = _apply(value, name, setting)
    return map_values(value, pending)


def _apply(value: Column, name: str, setting: Any) -> Column:
    if name == "regex_replace":
        return F.regexp_replace(value, setting["pattern"], setting["replacement"])
    actions = {"trim": F.trim, "upper_case": F.upper, "lower_case": F.lower}
    if name not in actions:
        raise ValueError(f"unknown standardisation rule: {name}")
    return actions[name](value) if setting else value
