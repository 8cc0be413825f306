"""Hand-made raw frames for unit and negative tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trolley.plans.warehouse import Warehouse
from trolley.session import work_dir
from trolley.sources.schemas import RAW_SCHEMAS

AISLES = [(1, "fresh fruits"), (2, "yogurt")]
DEPARTMENTS = [(1, "produce"), (2, "dairy eggs")]
PRODUCTS = [(1, "Banana", 1, 1), (2, "Apple", 1, 1), (3, "Yogurt", 2, 2)]
# user 1: prior, prior, train; user 2: prior, test (no basket)
ORDERS = [
    (1, 1, "prior", 1, 0, 8, None),
    (2, 1, "prior", 2, 3, 12, 7.0),
    (3, 1, "train", 3, 3, 18, 10.0),
    (4, 2, "prior", 1, 6, 23, None),
    (5, 2, "test", 2, 1, 0, 3.0),
]
PRIOR = [(1, 1, 1, 0), (1, 2, 2, 0), (2, 1, 1, 1), (2, 3, 2, 0), (4, 3, 1, 0)]
TRAIN = [(3, 1, 1, 1), (3, 2, 2, 1)]


def frames(spark: SparkSession, **over) -> dict[str, DataFrame]:
    data = {"aisles": AISLES, "departments": DEPARTMENTS, "products": PRODUCTS, "orders": ORDERS,
            "order_products_prior": PRIOR, "order_products_train": TRAIN}
    data.update(over)
    return {t: spark.createDataFrame(rows, RAW_SCHEMAS[t]) for t, rows in data.items()}


def warehouse(spark: SparkSession, **over) -> Warehouse:
    import uuid

    root = f"{work_dir(spark)}/tests/{uuid.uuid4().hex[:8]}"
    return Warehouse(spark, "/nonexistent", root=root, raw=frames(spark, **over), guarded=not over)


def clean_raw(spark: SparkSession) -> Warehouse:
    return warehouse(spark)
