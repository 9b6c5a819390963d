"""Stacking many small results."""
from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(parts: list[DataFrame]) -> DataFrame:
    """``unionByName`` of all parts, combined pairwise: the plan is analysed in O(n log n) steps
    instead of re-analysing an ever longer chain (61 check results in one summary)."""
    parts = list(parts)
    if not parts:
        raise ValueError("nothing to union")
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


def tagged(df: DataFrame, source: str, keys: list[str], *measures) -> DataFrame:
    """Rows of one source ready to be stacked with those of others and grouped once on ``keys`` plus
    ``_apart``: like a full outer join, a key tuple with a NULL part matches no other source's rows, so such
    rows are kept apart by their source's name."""
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return df.select(*keys, F.when(~whole, F.lit(source)).alias("_apart"), *measures)


def stack(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts; columns that a part lacks are NULL there (aggregates skip them)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
