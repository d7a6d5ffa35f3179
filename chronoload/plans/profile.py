"""Profiling job: the tables behind a first look at a source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from chronoload.operators import profile as P


def profile_source(
    df: DataFrame, time_col: str, numeric: Sequence[str], categorical: Sequence[str], group_cols: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Lazy tables by name: nothing runs until one is used."""
    tables = {
        "describe": P.describe(df, numeric, group_cols),
        "columns": P.column_counts(df),
        "repeated_rows": P.repeated_rows(df),
        "completeness_day": P.completeness(df, time_col, "D", 1, group_cols),
        "completeness_hour": P.completeness(df, time_col, "h", 1, group_cols),
    }
    tables |= {f"values_{c}": P.value_counts(df, c) for c in categorical}
    tables |= {f"summary_{c}": P.scalar_summary(df, c) for c in numeric}
    return tables
