"""Bounded samples of large tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 30


def bounded_sample(df: DataFrame, rows: int, *keys: str | Column) -> DataFrame:
    """At most `rows` rows, those with the least hashes of `keys`; all rows of a smaller table.

    A share of the hash range is cut first, so that tasks send about twice the sample, however many
    they are.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(_RANGE))
    share = min(1.0, 2 * rows / max(1, df.count()))
    return df.where(place < F.lit(int(share * _RANGE))).orderBy(place, *keys).limit(rows)
