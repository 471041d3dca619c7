"""Changelogs of keyed totals: every change of a total as the old row's withdrawal and the new row.

A changelog has the key, the values and ``sign``: -1 withdraws a row that was sent before, 1 sends one. Any
aggregate over signed rows stays exact however often totals change, also one that is no plain sum of the
inputs (how many keys have passed a limit), because each key counts with its current row only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIGN = "sign"


def signed_sum(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(F.col(SIGN) * value)


def signed_count(condition: Column | None = None) -> Column:
    """Rows in force, or those of them that meet a condition."""
    if condition is None:
        return F.sum(SIGN)
    return F.sum(F.when(condition, F.col(SIGN)).otherwise(0))


def current(changelog: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows in force: those sent once more than withdrawn. No order of the changes is needed."""
    values = [c for c in changelog.columns if c != SIGN]
    if not set(key) <= set(values):
        raise ValueError(f"the changelog has no columns {sorted(set(key) - set(values))}")
    return changelog.groupBy(*values).agg(F.sum(SIGN).alias("_n")).where("_n > 0").drop("_n")


def rollup(changelog: DataFrame, by: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Groups of keys over their current rows, with ``rows_ct`` of these.

    A group that has lost all its rows comes out with 0 of them, so that a reader of upserts learns of it.
    """
    named = [m.cast("bigint").alias(name) for name, m in measures.items()]
    return changelog.groupBy(*by).agg(F.sum(SIGN).cast("bigint").alias("rows_ct"), *named)
