"""Columns from archive file names by rules; the first rule that fits counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, dict[str, str]]  # pattern of the whole name, column -> template with $1, $2, ...


def _whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


def rule_number(name: Column, rules: Sequence[Rule]) -> Column:
    """The number of the first rule whose pattern is the whole name, null if none."""
    out = None
    for k, (pattern, _) in enumerate(rules):
        out = (F if out is None else out).when(name.rlike(_whole(pattern)), F.lit(k))
    return out if out is not None else F.lit(None).cast("int")


def with_name_fields(df: DataFrame, name: str, rules: Sequence[Rule]) -> DataFrame:
    """``df`` with the columns that the rules' templates create; null where the first fitting rule has no such template."""
    fields = sorted({field for _, templates in rules for field in templates})
    number = rule_number(F.col(name), rules)
    columns = {}
    for field in fields:
        value = None
        for k, (pattern, templates) in enumerate(rules):
            if field in templates:
                value = (F if value is None else value).when(number == k, F.regexp_replace(F.col(name), _whole(pattern), templates[field]))
        columns[field] = value
    return df.withColumns(columns)


def rule_counts(df: DataFrame, name: str, rules: Sequence[Rule]) -> DataFrame:
    """(rule, n, last_example) of first matches; rule -1 holds the names that fit none."""
    number = F.coalesce(rule_number(F.col(name), rules), F.lit(-1))
    return df.groupBy(number.alias("rule")).agg(F.count(F.lit(1)).alias("n"), F.max(name).alias("last_example"))
