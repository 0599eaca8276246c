"""Column names that cannot clash with a caller's."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_prefix(df: DataFrame, prefix: str = "_t") -> str:
    """``prefix``, longer where a column begins with it in any case."""
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = "_" + prefix
    return prefix
