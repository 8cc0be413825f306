"""Join helpers: size-checked broadcast and cardinality guards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when its row count is known and its rows, at the width below, fit this bound.
BROADCAST_MAX_BYTES = 64 << 20
STRING_BYTES = 128


def row_bytes(df: DataFrame) -> int:
    """Bytes of a row in memory: eight for each column and ``STRING_BYTES`` more for text."""
    return 8 + sum(8 + (STRING_BYTES if t in ("string", "binary") else 0) for _, t in df.dtypes)


def small(df: DataFrame, rows: int | None, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only behind a checked size; otherwise leave the choice to AQE."""
    if rows is not None and rows * row_bytes(df) <= max_bytes:
        return F.broadcast(df)
    return df


def duplicate_keys(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Keys that occur more than once (empty for a valid many-to-one right side)."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def assert_unique(df: DataFrame, keys: list[str] | tuple[str, ...], what: str = "join side") -> None:
    """Raise if ``keys`` repeat in ``df`` (pandas ``validate='many_to_one'`` / ``'one_to_one'``)."""
    if duplicate_keys(df, keys).limit(1).count():
        raise ValueError(f"{what}: key {tuple(keys)} is not unique")


def guarded(df: DataFrame, keys: list[str] | tuple[str, ...], what: str = "join side") -> DataFrame:
    """``df`` reduced by ``keys`` with the number of its rows; a key with more than one raises when it is read.

    The guard is part of the query (pandas ``validate='many_to_one'`` / ``'one_to_one'``): no job of its own, and no
    exchange where ``df`` is bucketed by its keys.  It sits in the first column beside the keys."""
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *[F.any_value(c).alias(c) for c in rest])
    message = F.concat(F.lit(f"{what}: key {tuple(keys)} is not unique: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    first = F.when(F.col("_rows") > 1, F.raise_error(message)).otherwise(F.col(rest[0])).cast(df.schema[rest[0]].dataType).alias(rest[0])
    return one.select(*[first if c == rest[0] else F.col(c) for c in df.columns])
