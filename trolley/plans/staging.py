"""Staging layer (views): typed, renamed projections of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("eval_set").cast("string").alias("eval_set"),
        F.col("order_number").cast("int").alias("order_number"),
        F.col("order_dow").cast("int").alias("order_dow"),
        F.col("order_hour_of_day").cast("int").alias("order_hour_of_day"),
        F.col("days_since_prior_order").cast("double").alias("days_since_prior_order"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("product_id").cast("int").alias("product_id"),
        F.col("product_name").cast("string").alias("product_name"),
        F.col("aisle_id").cast("int").alias("aisle_id"),
        F.col("department_id").cast("int").alias("department_id"),
    )


def stg_aisles(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("aisle_id").cast("int").alias("aisle_id"),
        F.col("aisle").cast("string").alias("aisle_name"),
    )


def stg_departments(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("department_id").cast("int").alias("department_id"),
        F.col("department").cast("string").alias("department_name"),
    )


def stg_order_products(raw: DataFrame, source: str) -> DataFrame:
    """Prior or train items with the literal ``source_eval_set`` (assigned once, here)."""
    return raw.select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("product_id").cast("int").alias("product_id"),
        F.col("add_to_cart_order").cast("int").alias("add_to_cart_order"),
        F.col("reordered").cast("int").alias("reordered"),
        F.lit(source).alias("source_eval_set"),
    )


def coerce_lenient(df: DataFrame, column: str, to: str = "double") -> DataFrame:
    """Text -> number; blank, malformed or ``NaN`` text becomes NULL (``try_cast``)."""
    value = F.expr(f"try_cast(trim(`{column}`) as {to})")
    if to in ("double", "float"):
        value = F.when(~F.isnan(value), value)
    return df.withColumn(column, value)


def coerce_strict(df: DataFrame, column: str, to: str = "bigint") -> DataFrame:
    """Text -> number; a non-null value that does not convert fails the job.

    Explicit (``try_cast`` + ``raise_error``) rather than relying on the
    session's ANSI mode, so it is strict under any configuration.
    """
    value = F.expr(f"try_cast(`{column}` as {to})")
    bad = F.col(column).isNotNull() & value.isNull()
    message = F.concat(F.lit(f"coerce_strict: cannot convert {column} value '"),
                       F.col(column).cast("string"), F.lit(f"' to {to}"))
    return df.withColumn(column, F.when(bad, F.raise_error(message)).otherwise(value))
