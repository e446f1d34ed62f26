"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pubwatch.session import materialise, new_path

__all__ = ["fresh", "materialise", "new_path"]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the next variant of it that no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
