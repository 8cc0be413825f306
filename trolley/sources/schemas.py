"""Declared schemas of the six raw basket tables and their contracts.

Ids are 64-bit (the driver data keys are int64 and a 32-bit cast would
overflow at warehouse scale); codes and flags are 32-bit.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW_TABLES = ("aisles", "departments", "products", "orders", "order_products_prior", "order_products_train")

RAW_SCHEMAS: dict[str, T.StructType] = {
    "aisles": T.StructType([
        T.StructField("aisle_id", T.IntegerType()),
        T.StructField("aisle", T.StringType()),
    ]),
    "departments": T.StructType([
        T.StructField("department_id", T.IntegerType()),
        T.StructField("department", T.StringType()),
    ]),
    "products": T.StructType([
        T.StructField("product_id", T.IntegerType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("aisle_id", T.IntegerType()),
        T.StructField("department_id", T.IntegerType()),
    ]),
    "orders": T.StructType([
        T.StructField("order_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("eval_set", T.StringType()),
        T.StructField("order_number", T.IntegerType()),
        T.StructField("order_dow", T.IntegerType()),
        T.StructField("order_hour_of_day", T.IntegerType()),
        T.StructField("days_since_prior_order", T.DoubleType()),
    ]),
    "order_products_prior": T.StructType([
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("add_to_cart_order", T.IntegerType()),
        T.StructField("reordered", T.IntegerType()),
    ]),
    "order_products_train": T.StructType([
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("add_to_cart_order", T.IntegerType()),
        T.StructField("reordered", T.IntegerType()),
    ]),
}

# Logical raw table -> file name of the public six-file data set.
SOURCE_FILES: dict[str, str] = {
    "aisles": "aisles.csv",
    "departments": "departments.csv",
    "products": "products.csv",
    "orders": "orders.csv",
    "order_products_prior": "order_products__prior.csv",
    "order_products_train": "order_products__train.csv",
}

# Primary keys of the raw tables (composite for the item tables).
RAW_KEYS: dict[str, tuple[str, ...]] = {
    "aisles": ("aisle_id",),
    "departments": ("department_id",),
    "products": ("product_id",),
    "orders": ("order_id",),
    "order_products_prior": ("order_id", "product_id"),
    "order_products_train": ("order_id", "product_id"),
}


def type_name(dt: T.DataType) -> str:
    """Short SQL-ish type name used in contracts and profiles."""
    return dt.simpleString()
