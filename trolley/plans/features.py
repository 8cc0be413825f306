"""Order, customer and product features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.columns import customer_segment, day_part, safe_ratio
from trolley.functions.joins import guarded, small
from trolley.functions.quantiles import exact_median


def order_features(orders: DataFrame, baskets: DataFrame, validate: bool = True) -> DataFrame:
    """Orders with items, their day part and basket measures (M12, inner one-to-one join).

    ``validate`` puts the one-to-one contract into the plan: an order_id that repeats on either side fails the query.
    """
    if validate:
        orders, baskets = guarded(orders, ["order_id"], "orders"), guarded(baskets, ["order_id"], "order measures")
    return (
        orders.join(baskets, "order_id", "inner")
        .select("order_id", "user_id", "eval_set", "order_number", "order_dow", "order_hour_of_day",
                "days_since_prior_order", day_part("order_hour_of_day").alias("day_part"),
                "basket_size", "reordered_item_count", "reorder_rate")
    )


def source_order_features(items: DataFrame) -> DataFrame:
    """Per-order measures of one item source (``prior_order_features`` / ``train_order_features``)."""
    return items.groupBy("order_id").agg(
        F.count("product_id").alias("basket_size"),
        F.sum("reordered").cast("bigint").alias("reordered_item_count"),
    ).withColumn("reorder_rate", safe_ratio("reordered_item_count", "basket_size"))


def customer_order_features(orders: DataFrame) -> DataFrame:
    """total_orders (distinct orders) and mean gap per user over all orders.

    Pre-aggregated per (user, order) first so a customer with a huge
    history is split across tasks before the per-user combine.
    """
    per_order = orders.groupBy("user_id", "order_id").agg(
        F.sum("days_since_prior_order").alias("gap_sum"),
        F.count("days_since_prior_order").alias("gap_n"),
    )
    return per_order.groupBy("user_id").agg(
        F.count("order_id").alias("total_orders"),
        (F.sum("gap_sum") / F.sum("gap_n")).alias("average_days_between_orders"),
    )


def customer_basket_features(features: DataFrame) -> DataFrame:
    """Basket size, volume and reorder behaviour per user from order features."""
    agg = features.groupBy("user_id").agg(
        F.avg("basket_size").alias("average_basket_size"),
        F.sum("basket_size").cast("bigint").alias("total_items"),
        F.sum("reordered_item_count").cast("bigint").alias("total_reordered_items"),
    )
    rate = safe_ratio("total_reordered_items", "total_items")
    return agg.withColumn("customer_reorder_rate", rate).withColumn(
        "customer_reorder_percentage", F.round(F.col("customer_reorder_rate") * 100.0, 2))


def customer_product_features(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct products per user (M16): distinct (user, product) first, then a count."""
    pairs = items.select("order_id", "product_id").join(orders.select("order_id", "user_id"), "order_id", "left")
    return (
        pairs.select("user_id", "product_id").distinct()
        .groupBy("user_id").agg(F.count("product_id").alias("unique_products_purchased"))
    )


DIM_USER_COLUMNS = (
    "user_id", "total_orders", "average_days_between_orders", "average_basket_size", "total_items",
    "total_reordered_items", "unique_products_purchased", "customer_reorder_rate", "customer_reorder_percentage",
)


def dim_user(order_feats: DataFrame, basket_feats: DataFrame, product_feats: DataFrame) -> DataFrame:
    """All users with an order, left-joined to basket and product features."""
    return (
        order_feats.join(basket_feats, "user_id", "left")
        .join(product_feats, "user_id", "left")
        .select(*DIM_USER_COLUMNS)
    )


def segment_thresholds(users: DataFrame, approx: bool = False, accuracy: int = 100_000) -> DataFrame:
    """One row: median total_orders and median customer_reorder_rate (NULLs skipped).

    Exact by default via ``exact_quantile`` (sketch-bounded selection: no
    task ever holds all distinct rates); ``approx=True`` uses the
    ``percentile_approx`` sketch alone.
    """
    if approx:
        return users.agg(
            F.percentile_approx("total_orders", 0.5, accuracy).cast("double").alias("order_threshold"),
            F.percentile_approx("customer_reorder_rate", 0.5, accuracy).cast("double").alias("reorder_threshold"))
    orders_t, rate_t = threshold_scalars(users)
    return users.sparkSession.range(1).select(orders_t.alias("order_threshold"), rate_t.alias("reorder_threshold"))


def threshold_scalars(users: DataFrame, approx: bool = False, accuracy: int = 100_000):
    """The two median thresholds as scalar-subquery columns (one level each, evaluated once)."""
    if approx:
        return (users.agg(F.percentile_approx("total_orders", 0.5, accuracy).cast("double")).scalar(),
                users.agg(F.percentile_approx("customer_reorder_rate", 0.5, accuracy).cast("double")).scalar())
    return exact_median(users, "total_orders").scalar(), exact_median(users, "customer_reorder_rate").scalar()


def dim_user_segmented(users: DataFrame, approx: bool = False) -> DataFrame:
    """dim_user plus the four-way median-split ``customer_segment``."""
    orders_t, rate_t = threshold_scalars(users, approx)
    return users.withColumn(
        "customer_segment", customer_segment("total_orders", "customer_reorder_rate", orders_t, rate_t))


def product_metrics(items: DataFrame, dim_product_df: DataFrame, dim_product_rows: int | None = None,
                    from_cube: bool = False) -> DataFrame:
    """Purchases, reorders and rate per product id with names.

    ``items`` is the item fact (map-side partial aggregation) or, with
    ``from_cube``, the item cube (a sum of its additive measures).
    """
    if from_cube:
        agg = items.groupBy("product_id").agg(
            F.sum("item_count").cast("bigint").alias("purchase_count"),
            F.coalesce(F.sum("reorder_count"), F.lit(0)).cast("bigint").alias("reordered_count"))
    else:
        agg = items.groupBy("product_id").agg(
            F.count(F.lit(1)).alias("purchase_count"),
            F.coalesce(F.sum("reordered"), F.lit(0)).cast("bigint").alias("reordered_count"))
    agg = agg.withColumn("product_reorder_rate", F.col("reordered_count") / F.col("purchase_count"))
    return agg.join(small(dim_product_df, dim_product_rows), "product_id", "left").select(
        "product_id", "purchase_count", "reordered_count", "product_reorder_rate",
        "product_name", "aisle_id", "aisle", "department_id", "department")


def product_first_added(cube: DataFrame, baskets: DataFrame) -> DataFrame:
    """How often a product is the first one put in the cart (M20), from the item cube.

    ``first_added_rate`` = first adds / purchases (the dictionary's
    definition); ``share_of_orders`` = first adds / all orders with items
    (one row per order in ``order_baskets``).
    """
    per_product = cube.groupBy("product_id").agg(
        F.sum("item_count").cast("bigint").alias("purchase_count"),
        F.sum("first_added_count").cast("bigint").alias("first_added_count"),
    )
    n_orders = baskets.agg(F.count(F.lit(1))).scalar()  # scalar subquery
    return per_product.select(
        "product_id", "purchase_count", "first_added_count",
        (F.col("first_added_count") / F.col("purchase_count")).alias("first_added_rate"),
        (F.col("first_added_count") / n_orders).alias("share_of_orders"),
    )
