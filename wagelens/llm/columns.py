"""Names for an operator's own columns beside the caller's."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    return [next(c for k in count() if (c := name + "_" * k).lower() not in taken) for name in names]
