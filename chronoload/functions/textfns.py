"""Column-name and text helpers."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column names that get a common name after standardising.
EVENT_TIME_NAMES = {"start_date": "starttime", "end_date": "endtime"}


def standard_name(name: str) -> str:
    base = name.partition("(")[0].strip().lower()
    return base.translate(str.maketrans({ch: "_" for ch in " -/:"}))


def standardise_columns(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Plain lower-case column names. Two columns that would share a name are an error."""
    renames = EVENT_TIME_NAMES if renames is None else renames
    names = [standard_name(c) for c in df.columns]
    names = [renames.get(n, n) for n in names]
    clash = [n for n, times in Counter(names).items() if times > 1]
    if clash:
        raise ValueError(f"columns collide after standardising: {sorted(clash)}")
    return df.toDF(*names)


def station_group(c: Column | str, prefix_chars: int = 14, stop: str = "#") -> Column:
    """Text after a fixed-width prefix and before the first ``stop``, trimmed.

    Without a ``stop`` the last character is cut instead.
    """
    c = F.col(c) if isinstance(c, str) else c
    at = F.locate(stop, c)
    end = F.when(at > 0, at - 1).otherwise(F.length(c) - 1)
    return F.trim(F.substring(c, F.lit(prefix_chars + 1), F.greatest(end - prefix_chars, F.lit(0))))


def matching(columns: list[str], substrings: list[str]) -> list[str]:
    """Columns whose name contains any of the substrings, in source order."""
    return [c for c in columns if any(s in c for s in substrings)]


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
