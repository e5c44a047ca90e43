"""Columns that are worked out exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def once(df: DataFrame, columns: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """Add costly columns through a one-row ``inline``.

    A plain projection may be copied into every later filter and expression that
    uses it, so a set of regexes or a parsed document would run many times per row.
    """
    made = F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select(*(keep if keep is not None else df.columns), made)
