"""DuckDB oracle text for the staging views, marts and feature tables."""

from __future__ import annotations

from trolley.oracle.prefix import sql

_SELF = (
    "stg_orders", "stg_products", "stg_aisles", "stg_departments", "stg_order_products_prior",
    "stg_order_products_train", "int_order_products", "int_order_items_enriched", "fact_order_items",
    "dim_orders", "dim_products", "dim_aisles", "dim_departments", "dim_users", "dim_product",
    "dim_order_slot", "fact_order", "order_features", "customer_order_features",
    "customer_basket_features", "customer_product_features", "dim_user", "dim_user_segmented", "product_metrics",
    "order_baskets",
)


def model_sql() -> dict[str, str]:
    q = {k: sql(f"SELECT * FROM {k}") for k in _SELF}
    q["fact_order_item"] = sql("""
        SELECT order_id, product_id, add_to_cart_order, reordered FROM raw_order_products_prior
        UNION ALL SELECT order_id, product_id, add_to_cart_order, reordered FROM raw_order_products_train""")
    for src in ("prior", "train"):
        q[f"{src}_order_features"] = sql(f"""
            SELECT order_id, count(product_id) AS basket_size, CAST(sum(reordered) AS BIGINT) AS reordered_item_count,
                   CAST(sum(reordered) AS DOUBLE) / nullif(count(product_id), 0) AS reorder_rate
            FROM stg_order_products_{src} GROUP BY order_id""")
    q["product_first_added"] = sql("""
        SELECT product_id, count(*) AS purchase_count,
               count(*) FILTER (WHERE add_to_cart_order = 1) AS first_added_count,
               count(*) FILTER (WHERE add_to_cart_order = 1) / count(*) AS first_added_rate,
               count(*) FILTER (WHERE add_to_cart_order = 1) / (SELECT count(DISTINCT order_id) FROM int_order_products)
                   AS share_of_orders
        FROM int_order_products GROUP BY product_id""")
    q["item_cube"] = sql("""
        SELECT product_id, department_id, order_dow, count(*) AS item_count,
               CAST(sum(reordered) AS BIGINT) AS reorder_count, count(reordered) AS reorder_n,
               CAST(sum(add_to_cart_order) AS BIGINT) AS atc_sum,
               count(add_to_cart_order) AS atc_n, sum(days_since_prior_order) AS gap_sum,
               count(days_since_prior_order) AS gap_n,
               count(*) FILTER (WHERE add_to_cart_order = 1) AS first_added_count
        FROM fact_order_items GROUP BY product_id, department_id, order_dow""")
    q["orders_with_time"] = sql("""
        SELECT f.slot_key, f.order_id, f.user_id, f.eval_set, f.order_number, f.days_since_prior_order, f.basket_size,
               f.reordered_item_count, f.reorder_rate, s.order_dow, s.order_hour_of_day, s.day_part, s.slot_code
        FROM fact_order f LEFT JOIN dim_order_slot s ON f.slot_key = s.slot_key""")
    return q
