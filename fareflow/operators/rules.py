"""Data-quality rules: a name and a SQL predicate each.

A predicate is null when its input is missing. Such a row is no proven violation; ``on_null`` says
whether dropping rules keep it.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schema import RULES


def _counts(rules: Mapping[str, str]) -> list[Column]:
    broken = [F.count_if(~F.expr(rule)).alias(f"{name}_violations") for name, rule in rules.items()]
    return [F.count(F.lit(1)).alias("row_count"), *broken]


def count_violations(rows: DataFrame, rules: Mapping[str, str] = RULES) -> DataFrame:
    """One row: how many rows were read, and how many break each rule."""
    return rows.agg(*_counts(rules))


def observe_rules(
    rows: DataFrame,
    observed: Observation | str,
    rules: Mapping[str, str] = RULES,
    more: Mapping[str, str] | None = None,
) -> DataFrame:
    """Warn only: pass all rows on and count violations on the way, in batch or in a stream.

    ``more`` holds conditions that are no rules; rows that meet them are counted too.
    """
    others = [F.count_if(F.expr(condition)).alias(name) for name, condition in (more or {}).items()]
    return rows.observe(observed, *_counts(rules), *others)


def expect_or_drop(
    rows: DataFrame,
    rules: Mapping[str, str] = RULES,
    on_null: str = "keep",
    observed: Observation | str | None = None,
) -> DataFrame:
    """Keep rows that meet all rules; ``on_null`` is "keep" or "drop" for rules without an answer.

    Violations are counted on the way; ``observed`` receives them. Without it the counts have a name of their own that
    nobody reads: Spark does not move a filter below a count of its input, so the columns that the rules
    read are evaluated once and not again in the filter.
    """
    if on_null not in ("keep", "drop"):
        raise ValueError(f"on_null is 'keep' or 'drop', not {on_null!r}")
    rows = observe_rules(rows, f"rules-{uuid.uuid4().hex}" if observed is None else observed, rules)
    for rule in rules.values():
        rows = rows.filter(F.coalesce(F.expr(rule), F.lit(on_null == "keep")))
    return rows
