"""One row per key.

All of them filter ``row_number() = 1``, which Spark turns into a group limit before the
shuffle: each map task sends at most one row per key, so a key that holds a third of the
table costs no more than any other.

Equal sort keys are settled by a hash of the row, so that a task that is run again picks
the same row. Taken over the source row by ``with_row_hash``, it spares a reader of a few
columns the cleaning of all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

ROW_HASH = "_row_hash"
_RN = "_rn"


def row_hash(df: DataFrame) -> Column:
    return F.expr(f"xxhash64({', '.join(f'`{c}`' for c in sorted(df.columns))})")


def with_row_hash(df: DataFrame) -> DataFrame:
    return df.withColumn(ROW_HASH, row_hash(df))


def first_per_key(
    df: DataFrame, keys: list[str], order: list[Column], keep_hash: bool = False
) -> DataFrame:
    """First row of each key group in the given order. NULL keys form one group."""
    hashed = df if ROW_HASH in df.columns else with_row_hash(df)
    window = Window.partitionBy(*keys).orderBy(*order, F.col(ROW_HASH).asc())
    first = hashed.withColumn(_RN, F.row_number().over(window)).filter(F.col(_RN) == 1)
    return first.drop(_RN) if keep_hash else first.drop(_RN, ROW_HASH)


def keep_latest(df: DataFrame, keys: list[str] | str, by: str) -> DataFrame:
    """Freshest row per key. A NULL timestamp counts as the largest."""
    keys = [keys] if isinstance(keys, str) else keys
    return first_per_key(df, keys, [F.col(by).desc_nulls_first()])


def keep_earliest(df: DataFrame, keys: list[str] | str, *by: str) -> DataFrame:
    """Oldest row per key over several sort columns, NULLs last."""
    keys = [keys] if isinstance(keys, str) else keys
    return first_per_key(df, keys, [F.col(c).asc_nulls_last() for c in by])
