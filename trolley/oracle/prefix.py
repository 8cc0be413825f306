"""DuckDB CTE prefix: the same raw derivation, staging views and marts as SQL.

``sql(select, extra)`` builds ``WITH <shared CTEs>[, <extra CTEs>] <select>``.
DuckDB ignores CTEs that the final select does not reference.
"""

from __future__ import annotations

# name -> body; order matters (later CTEs reference earlier ones)
CTES: list[tuple[str, str]] = [
    # ---- raw derivation (see trolley.sources.driver) ----
    ("_base", """
        SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS odate
        FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)"""),
    ("_seq", """
        SELECT order_id, user_id, odate,
               CAST(row_number() OVER (PARTITION BY user_id ORDER BY odate, order_id) AS INTEGER) AS order_number,
               lag(odate) OVER (PARTITION BY user_id ORDER BY odate, order_id) AS prev_date,
               count(*) OVER (PARTITION BY user_id) AS n_orders
        FROM _base"""),
    ("raw_orders", """
        SELECT order_id, user_id,
               CASE WHEN order_number = n_orders AND user_id % 3 = 0 THEN 'test'
                    WHEN order_number = n_orders THEN 'train' ELSE 'prior' END AS eval_set,
               order_number,
               CAST(dayofweek(odate) AS INTEGER) AS order_dow,
               CAST((order_id * 7 + user_id) % 24 AS INTEGER) AS order_hour_of_day,
               CAST(date_diff('day', prev_date, odate) % 31 AS DOUBLE) AS days_since_prior_order
        FROM _seq"""),
    ("raw_departments", """
        SELECT CAST(row_number() OVER (ORDER BY p_type) AS INTEGER) AS department_id, p_type AS department
        FROM (SELECT DISTINCT p_type FROM part)"""),
    ("raw_aisles", """
        SELECT CAST(row_number() OVER (ORDER BY p_brand) AS INTEGER) AS aisle_id, p_brand AS aisle
        FROM (SELECT DISTINCT p_brand FROM part)"""),
    ("_prod_keys", """
        SELECT p_brand, p_type, CAST(row_number() OVER (ORDER BY p_brand, p_type) AS INTEGER) AS product_id
        FROM (SELECT DISTINCT p_brand, p_type FROM part)"""),
    ("raw_products", """
        SELECT k.product_id, k.p_brand || ' ' || k.p_type AS product_name, a.aisle_id, d.department_id
        FROM _prod_keys k JOIN raw_aisles a ON a.aisle = k.p_brand JOIN raw_departments d ON d.department = k.p_type"""),
    ("_pairs", """
        SELECT l.l_orderkey AS order_id, k.product_id, min(l.l_linenumber) AS first_line
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
        JOIN _prod_keys k ON k.p_brand = p.p_brand AND k.p_type = p.p_type
        GROUP BY 1, 2"""),
    ("_items", """
        SELECT i.order_id, i.product_id, o.eval_set,
               CAST(row_number() OVER (PARTITION BY i.order_id ORDER BY i.first_line, i.product_id) AS INTEGER)
                   AS add_to_cart_order,
               CAST(o.order_number > min(o.order_number) OVER (PARTITION BY o.user_id, i.product_id) AS INTEGER)
                   AS reordered
        FROM _pairs i JOIN raw_orders o ON o.order_id = i.order_id"""),
    ("raw_order_products_prior", """
        SELECT order_id, product_id, add_to_cart_order, reordered FROM _items WHERE eval_set = 'prior'"""),
    ("raw_order_products_train", """
        SELECT order_id, product_id, add_to_cart_order, reordered FROM _items WHERE eval_set = 'train'"""),
    # ---- staging ----
    ("stg_orders", """
        SELECT CAST(order_id AS BIGINT) AS order_id, CAST(user_id AS BIGINT) AS user_id,
               CAST(eval_set AS VARCHAR) AS eval_set, CAST(order_number AS INTEGER) AS order_number,
               CAST(order_dow AS INTEGER) AS order_dow, CAST(order_hour_of_day AS INTEGER) AS order_hour_of_day,
               CAST(days_since_prior_order AS DOUBLE) AS days_since_prior_order
        FROM raw_orders"""),
    ("stg_products", """
        SELECT CAST(product_id AS INTEGER) AS product_id, CAST(product_name AS VARCHAR) AS product_name,
               CAST(aisle_id AS INTEGER) AS aisle_id, CAST(department_id AS INTEGER) AS department_id
        FROM raw_products"""),
    ("stg_aisles", "SELECT CAST(aisle_id AS INTEGER) AS aisle_id, CAST(aisle AS VARCHAR) AS aisle_name FROM raw_aisles"),
    ("stg_departments", """
        SELECT CAST(department_id AS INTEGER) AS department_id, CAST(department AS VARCHAR) AS department_name
        FROM raw_departments"""),
    ("stg_order_products_prior", """
        SELECT CAST(order_id AS BIGINT) AS order_id, CAST(product_id AS INTEGER) AS product_id,
               CAST(add_to_cart_order AS INTEGER) AS add_to_cart_order, CAST(reordered AS INTEGER) AS reordered,
               'prior' AS source_eval_set
        FROM raw_order_products_prior"""),
    ("stg_order_products_train", """
        SELECT CAST(order_id AS BIGINT) AS order_id, CAST(product_id AS INTEGER) AS product_id,
               CAST(add_to_cart_order AS INTEGER) AS add_to_cart_order, CAST(reordered AS INTEGER) AS reordered,
               'train' AS source_eval_set
        FROM raw_order_products_train"""),
    # ---- intermediate + dbt marts ----
    ("int_order_products", """
        SELECT * FROM stg_order_products_prior UNION ALL SELECT * FROM stg_order_products_train"""),
    # one lookup value per key; fixed values: the model's column names
    ("_order_facts", """
        SELECT order_id AS k, any_value({'user_id': user_id, 'eval_set': eval_set, 'order_number': order_number, 'order_dow': order_dow,
               'order_hour_of_day': order_hour_of_day, 'days_since_prior_order': days_since_prior_order}) AS o FROM stg_orders GROUP BY order_id"""),
    ("_product_facts", """
        SELECT product_id AS k, any_value({'aisle_id': aisle_id, 'department_id': department_id}) AS p FROM stg_products GROUP BY product_id"""),
    ("_items_with_facts", """
        SELECT i.*, (SELECT o FROM _order_facts WHERE k = i.order_id) AS o, (SELECT p FROM _product_facts WHERE k = i.product_id) AS p
        FROM int_order_products i"""),
    ("int_order_items_enriched", """
        SELECT * EXCLUDE (o, p), o.user_id AS user_id, o.eval_set AS eval_set, o.order_number AS order_number, o.order_dow AS order_dow,
               o.order_hour_of_day AS order_hour_of_day, o.days_since_prior_order AS days_since_prior_order,
               p.aisle_id AS aisle_id, p.department_id AS department_id
        FROM _items_with_facts"""),
    ("fact_order_items", "SELECT * FROM int_order_items_enriched"),
    ("dim_orders", "SELECT * FROM stg_orders"),
    ("dim_products", "SELECT * FROM stg_products"),
    ("dim_aisles", "SELECT * FROM stg_aisles"),
    ("dim_departments", "SELECT * FROM stg_departments"),
    ("dim_users", """
        SELECT user_id, count(order_id) AS observed_order_count, CAST(sum(items) AS BIGINT) AS observed_item_count,
               CAST(sum(again) AS BIGINT) AS reordered_item_count,
               CASE WHEN sum(items) > 0 THEN CAST(sum(again) AS DOUBLE) / CAST(sum(items) AS DOUBLE) END AS reorder_rate
        FROM (SELECT order_id, count(*) AS items, sum(reordered) AS again FROM int_order_products GROUP BY order_id)
        LEFT JOIN stg_orders USING (order_id) GROUP BY user_id"""),
    # ---- V1 star schema + features ----
    ("dim_product", """
        SELECT p.product_id, p.product_name, p.aisle_id, a.aisle, p.department_id, d.department
        FROM raw_products p LEFT JOIN raw_aisles a ON p.aisle_id = a.aisle_id
        LEFT JOIN raw_departments d ON p.department_id = d.department_id"""),
    ("dim_order_slot", """
        SELECT CAST(row_number() OVER (ORDER BY order_dow, order_hour_of_day) AS INTEGER) AS slot_key,
               order_dow, order_hour_of_day,
               CASE WHEN order_hour_of_day > -1 AND order_hour_of_day <= 5 THEN 'Night'
                    WHEN order_hour_of_day > 5 AND order_hour_of_day <= 11 THEN 'Morning'
                    WHEN order_hour_of_day > 11 AND order_hour_of_day <= 17 THEN 'Afternoon'
                    WHEN order_hour_of_day > 17 AND order_hour_of_day <= 23 THEN 'Evening' END AS day_part,
               CAST(order_dow AS VARCHAR) || '_' || CAST(order_hour_of_day AS VARCHAR) AS slot_code
        FROM (SELECT DISTINCT order_dow, order_hour_of_day FROM stg_orders)"""),
    ("order_baskets", """
        SELECT order_id, count(*) AS basket_size, CAST(sum(reordered) AS BIGINT) AS reordered_item_count,
               CAST(sum(reordered) AS DOUBLE) / nullif(count(*), 0) AS reorder_rate
        FROM int_order_products GROUP BY order_id"""),
    ("fact_order", """
        SELECT o.order_id, o.user_id, s.slot_key, o.eval_set, o.order_number, o.days_since_prior_order,
               b.basket_size, b.reordered_item_count, b.reorder_rate
        FROM stg_orders o
        LEFT JOIN dim_order_slot s ON o.order_dow = s.order_dow AND o.order_hour_of_day = s.order_hour_of_day
        LEFT JOIN order_baskets b ON o.order_id = b.order_id"""),
    ("order_features", """
        SELECT o.order_id, o.user_id, o.eval_set, o.order_number, o.order_dow, o.order_hour_of_day,
               o.days_since_prior_order,
               CASE WHEN o.order_hour_of_day > -1 AND o.order_hour_of_day <= 5 THEN 'Night'
                    WHEN o.order_hour_of_day > 5 AND o.order_hour_of_day <= 11 THEN 'Morning'
                    WHEN o.order_hour_of_day > 11 AND o.order_hour_of_day <= 17 THEN 'Afternoon'
                    WHEN o.order_hour_of_day > 17 AND o.order_hour_of_day <= 23 THEN 'Evening' END AS day_part,
               b.basket_size, b.reordered_item_count, b.reorder_rate
        FROM stg_orders o JOIN order_baskets b ON o.order_id = b.order_id"""),
    ("customer_order_features", """
        SELECT user_id, count(DISTINCT order_id) AS total_orders,
               avg(days_since_prior_order) AS average_days_between_orders
        FROM stg_orders GROUP BY user_id"""),
    ("customer_basket_features", """
        SELECT user_id, avg(basket_size) AS average_basket_size,
               CAST(sum(basket_size) AS BIGINT) AS total_items,
               CAST(sum(reordered_item_count) AS BIGINT) AS total_reordered_items,
               CAST(sum(reordered_item_count) AS DOUBLE) / nullif(sum(basket_size), 0) AS customer_reorder_rate,
               round(CAST(sum(reordered_item_count) AS DOUBLE) / nullif(sum(basket_size), 0) * 100.0, 2)
                   AS customer_reorder_percentage
        FROM order_features GROUP BY user_id"""),
    ("customer_product_features", """
        SELECT o.user_id, count(DISTINCT i.product_id) AS unique_products_purchased
        FROM int_order_products i LEFT JOIN stg_orders o ON i.order_id = o.order_id
        GROUP BY o.user_id"""),
    ("dim_user", """
        SELECT c.user_id, c.total_orders, c.average_days_between_orders, b.average_basket_size, b.total_items,
               b.total_reordered_items, p.unique_products_purchased, b.customer_reorder_rate,
               b.customer_reorder_percentage
        FROM customer_order_features c
        LEFT JOIN customer_basket_features b ON c.user_id = b.user_id
        LEFT JOIN customer_product_features p ON c.user_id = p.user_id"""),
    ("_thresholds", """
        SELECT median(total_orders) AS order_threshold, median(customer_reorder_rate) AS reorder_threshold
        FROM dim_user"""),
    ("dim_user_segmented", """
        SELECT u.*,
               CASE WHEN u.total_orders >= (SELECT order_threshold FROM _thresholds) AND u.customer_reorder_rate >= (SELECT reorder_threshold FROM _thresholds)
                        THEN 'Frequent Repeat Customers'
                    WHEN u.total_orders >= (SELECT order_threshold FROM _thresholds) AND u.customer_reorder_rate < (SELECT reorder_threshold FROM _thresholds)
                        THEN 'Frequent Variety Customers'
                    WHEN u.total_orders < (SELECT order_threshold FROM _thresholds) AND u.customer_reorder_rate >= (SELECT reorder_threshold FROM _thresholds)
                        THEN 'Occasional Repeat Customers'
                    ELSE 'Occasional Variety Customers' END AS customer_segment
        FROM dim_user u"""),
    ("product_metrics", """
        SELECT a.product_id, a.purchase_count, a.reordered_count,
               CAST(a.reordered_count AS DOUBLE) / a.purchase_count AS product_reorder_rate,
               d.product_name, d.aisle_id, d.aisle, d.department_id, d.department
        FROM (SELECT product_id, count(*) AS purchase_count, CAST(coalesce(sum(reordered), 0) AS BIGINT) AS reordered_count
              FROM int_order_products GROUP BY product_id) a
        LEFT JOIN dim_product d ON a.product_id = d.product_id"""),
]


def sql(select: str, extra: list[tuple[str, str]] | None = None) -> str:
    ctes = CTES + list(extra or [])
    body = ",\n".join(f"{name} AS ({text.strip()})" for name, text in ctes)
    return f"WITH {body}\n{select.strip()}"
