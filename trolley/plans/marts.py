"""Intermediate models and dbt-style marts (M1-M7) plus the V1 star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.functions.columns import day_part, safe_ratio, slot_code
from trolley.functions.joins import guarded, small

FACT_ORDER_ITEMS_COLUMNS = (
    "order_id", "user_id", "product_id", "aisle_id", "department_id", "eval_set", "order_number",
    "order_dow", "order_hour_of_day", "days_since_prior_order", "add_to_cart_order", "reordered",
    "source_eval_set",
)


def int_order_products(prior: DataFrame, train: DataFrame) -> DataFrame:
    """Bag union of staged prior and train items (M1)."""
    return prior.unionByName(train)


def int_order_items_enriched(order_products: DataFrame, orders: DataFrame, products: DataFrame,
                             products_rows: int | None = None) -> DataFrame:
    """items LEFT JOIN orders LEFT JOIN products.

    The orders join is fact-to-fact (sort-merge on order_id, AQE may switch it);
    products is a catalogue and is broadcast only under a checked row bound.
    """
    o = orders.select("order_id", "user_id", "eval_set", "order_number", "order_dow",
                      "order_hour_of_day", "days_since_prior_order")
    p = small(products.select("product_id", "aisle_id", "department_id"), products_rows)
    return (
        order_products.join(o, "order_id", "left")
        .join(p, "product_id", "left")
        .select(*FACT_ORDER_ITEMS_COLUMNS)
    )


def fact_order_items(enriched: DataFrame) -> DataFrame:
    return enriched.select(*FACT_ORDER_ITEMS_COLUMNS)


def dim_orders(stg_orders: DataFrame) -> DataFrame:
    return stg_orders.select("order_id", "user_id", "eval_set", "order_number", "order_dow",
                             "order_hour_of_day", "days_since_prior_order")


def dim_products(stg_products: DataFrame) -> DataFrame:
    return stg_products.select("product_id", "product_name", "aisle_id", "department_id")


def dim_aisles(stg_aisles: DataFrame) -> DataFrame:
    return stg_aisles.select("aisle_id", "aisle_name")


def dim_departments(stg_departments: DataFrame) -> DataFrame:
    return stg_departments.select("department_id", "department_name")


def order_baskets(order_products: DataFrame) -> DataFrame:
    """Per-order basket measures from items (prior and train ids are disjoint, M13)."""
    return order_products.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("basket_size"),
        F.sum("reordered").cast("bigint").alias("reordered_item_count"),
    ).withColumn("reorder_rate", safe_ratio("reordered_item_count", "basket_size"))


def dim_users(baskets: DataFrame, orders: DataFrame) -> DataFrame:
    """Per-user observed orders / items / reorders (M7).

    Two-level plan: items were already reduced to one row per order
    (``order_baskets``), so the user-level aggregate is a plain partial +
    final aggregation -- no count-distinct expansion, and a hot user is
    combined map-side.  The LEFT JOIN keeps SQL's NULL user group for
    items whose order is missing, as the item-level model would.
    """
    per_order = baskets.join(orders.select("order_id", "user_id"), "order_id", "left")
    return per_order.groupBy("user_id").agg(
        F.count("order_id").alias("observed_order_count"),
        F.sum("basket_size").cast("bigint").alias("observed_item_count"),
        F.sum("reordered_item_count").cast("bigint").alias("reordered_item_count"),
    ).withColumn("reorder_rate", safe_ratio("reordered_item_count", "observed_item_count"))


def dim_product(products: DataFrame, aisles: DataFrame, departments: DataFrame,
                aisles_rows: int | None = None, departments_rows: int | None = None,
                validate: bool = True) -> DataFrame:
    """Denormalised product: products LEFT JOIN aisles LEFT JOIN departments.

    ``validate`` puts the many-to-one contract into the plan, as the original pandas merges do (validate=...): an
    aisle or department key that repeats fails the query.
    """
    if validate:
        aisles, departments = guarded(aisles, ["aisle_id"], "aisles"), guarded(departments, ["department_id"], "departments")
    return (
        products.join(small(aisles, aisles_rows), "aisle_id", "left")
        .join(small(departments, departments_rows), "department_id", "left")
        .select("product_id", "product_name", "aisle_id", "aisle", "department_id", "department")
    )


def dim_order_slot(orders: DataFrame) -> DataFrame:
    """Distinct (dow, hour) pairs, sorted, with day part and a 1..N surrogate key (M9).

    The distinct set is bounded by the code domains (7 x 24), so the
    un-partitioned ranking window runs over at most a few hundred rows.
    """
    pairs = orders.select("order_dow", "order_hour_of_day").distinct()
    w = Window.orderBy(F.col("order_dow").asc_nulls_last(), F.col("order_hour_of_day").asc_nulls_last())
    return pairs.select(
        F.row_number().over(w).cast("int").alias("slot_key"),
        "order_dow",
        "order_hour_of_day",
        day_part("order_hour_of_day").alias("day_part"),
        slot_code("order_dow", "order_hour_of_day").alias("slot_code"),
    )


def fact_order(orders: DataFrame, slots: DataFrame, baskets: DataFrame, slots_rows: int | None = None) -> DataFrame:
    """Orders LEFT JOIN slots on (dow, hour) LEFT JOIN basket measures.

    Test orders have no items, so their basket measures stay NULL.  The slot
    dimension is 168 rows for valid codes; it is broadcast on its checked
    row count (invalid codes could make it larger).
    """
    s = small(slots.select("slot_key", "order_dow", "order_hour_of_day"), slots_rows)
    return (
        orders.join(s, ["order_dow", "order_hour_of_day"], "left")
        .join(baskets, "order_id", "left")
        .select("order_id", "user_id", "slot_key", "eval_set", "order_number", "days_since_prior_order",
                "basket_size", "reordered_item_count", "reorder_rate")
    )


def fact_order_item(prior: DataFrame, train: DataFrame) -> DataFrame:
    """Narrow four-column item fact."""
    cols = ["order_id", "product_id", "add_to_cart_order", "reordered"]
    return prior.select(*cols).unionByName(train.select(*cols))


def item_cube(fact_items: DataFrame) -> DataFrame:
    """Additive item measures per (product, department, dow): the dashboard's department / product /
    dow questions are exact re-aggregations of it (sums and counts), so they never rescan the item fact.
    At most (#products x 7) rows, built with one map-side-combined aggregate."""
    return fact_items.groupBy("product_id", "department_id", "order_dow").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("reordered").cast("bigint").alias("reorder_count"),
        F.count("reordered").alias("reorder_n"),
        F.sum("add_to_cart_order").cast("bigint").alias("atc_sum"),
        F.count("add_to_cart_order").alias("atc_n"),
        F.sum("days_since_prior_order").alias("gap_sum"),
        F.count("days_since_prior_order").alias("gap_n"),
        F.count_if(F.col("add_to_cart_order") == 1).alias("first_added_count"),
    )
