"""DuckDB oracle text for the analytical queries (Q1-Q46)."""

from __future__ import annotations

from trolley.oracle.prefix import sql

PNS = ("pns", """
    SELECT p.product_name, count(*) AS item_count, CAST(sum(f.reordered) AS BIGINT) AS reorder_count,
           avg(f.add_to_cart_order) AS avg_add_to_cart_order, avg(f.days_since_prior_order) AS avg_days_since_prior,
           avg(f.reordered) AS reorder_rate
    FROM fact_order_items f JOIN dim_products p ON f.product_id = p.product_id
    GROUP BY p.product_name""")

DEPT = ("dept", """
    SELECT d.department_name, count(*) AS item_count, CAST(sum(f.reordered) AS BIGINT) AS reorder_count,
           avg(f.add_to_cart_order) AS avg_add_to_cart_order, avg(f.days_since_prior_order) AS avg_days_since_prior
    FROM fact_order_items f JOIN dim_departments d ON f.department_id = d.department_id
    GROUP BY d.department_name""")

OWT = ("owt", """
    SELECT f.order_id, s.order_dow, s.order_hour_of_day, s.day_part
    FROM fact_order f LEFT JOIN dim_order_slot s ON f.slot_key = s.slot_key""")

DEPT_DOW = ("dept_dow", """
    SELECT d.department_name, f.order_dow, count(*) AS item_count
    FROM fact_order_items f JOIN dim_departments d ON f.department_id = d.department_id
    GROUP BY d.department_name, f.order_dow""")

DEPT_PRODUCT = ("dept_product", """
    SELECT d.department_name, p.product_name, count(*) AS item_count, CAST(sum(f.reordered) AS BIGINT) AS reorder_count
    FROM fact_order_items f JOIN dim_products p ON f.product_id = p.product_id
    JOIN dim_departments d ON f.department_id = d.department_id
    GROUP BY d.department_name, p.product_name""")


def _stats(table: str, col: str, rounded: bool = False) -> str:
    mean = f"round(avg({col}), 6)" if rounded else f"avg({col})"
    return sql(f"""
        SELECT count({col}) AS n, CAST({mean} AS DOUBLE) AS mean, CAST(median({col}) AS DOUBLE) AS median,
               CAST(min({col}) AS DOUBLE) AS min, CAST(max({col}) AS DOUBLE) AS max
        FROM {table} WHERE {col} IS NOT NULL""")


def _rank_both(filter_cte: tuple[str, str], n: int) -> str:
    return sql(f"""
        SELECT department_name, 'items' AS ranking, rank, product_name, item_count, reorder_count FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY department_name ORDER BY item_count DESC, product_name) AS INTEGER) AS rank
            FROM dept_product WHERE department_name IN (SELECT department_name FROM chosen)) WHERE rank <= {n}
        UNION ALL
        SELECT department_name, 'reorders' AS ranking, rank, product_name, item_count, reorder_count FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY department_name ORDER BY reorder_count DESC, product_name) AS INTEGER) AS rank
            FROM dept_product WHERE department_name IN (SELECT department_name FROM chosen)) WHERE rank <= {n}""",
               [DEPT, DEPT_PRODUCT, filter_cte])


def _histograms(bins) -> str:
    parts = []
    for measure, n in bins:
        lo = f"(SELECT CAST(min({measure}) AS DOUBLE) FROM dim_user)"
        hi = f"(SELECT CAST(max({measure}) AS DOUBLE) FROM dim_user)"
        parts.append(f"""
        SELECT '{measure}' AS measure, bin, round({lo} + bin * (({hi} - {lo}) / {n}), 9) AS lo,
               round({lo} + (bin + 1) * (({hi} - {lo}) / {n}), 9) AS hi, count(*) AS n
        FROM (SELECT CASE WHEN ({hi} - {lo}) / {n} <= 0 THEN 0
                          ELSE CAST(least(floor((CAST({measure} AS DOUBLE) - {lo}) / (({hi} - {lo}) / {n})), {n - 1})
                                    AS INTEGER) END AS bin
              FROM dim_user WHERE {measure} IS NOT NULL)
        GROUP BY bin""")
    return sql("\nUNION ALL\n".join(parts))


def metric_sql(min_orders: int, hist_bins) -> dict[str, str]:
    q: dict[str, str] = {}
    q["kpis_observed"] = sql("""
        SELECT count(*) AS n_orders, CAST(sum(basket_size) AS BIGINT) AS n_items, avg(basket_size) AS avg_basket_size,
               (SELECT avg(reordered) FROM fact_order_items) AS reorder_rate
        FROM (SELECT order_id, count(*) AS basket_size FROM fact_order_items GROUP BY order_id)""")
    q["kpis_all"] = sql("""
        SELECT (SELECT count(DISTINCT order_id) FROM fact_order) AS total_orders,
               (SELECT count(DISTINCT user_id) FROM dim_user) AS total_customers,
               (SELECT count(DISTINCT product_id) FROM dim_product) AS total_products,
               (SELECT avg(basket_size) FROM fact_order) AS average_basket_size,
               (SELECT round(avg(customer_reorder_rate), 6) FROM dim_user) AS average_customer_reorder_rate,
               (SELECT round(avg(average_days_between_orders), 6) FROM dim_user) AS average_days_between_orders""")
    q["fact_summary"] = sql("""
        SELECT count(*) AS n_rows, count(DISTINCT order_id) AS n_orders, count(DISTINCT product_id) AS n_products,
               avg(reordered) AS reorder_rate
        FROM fact_order_items""")
    q["orders_by_dow_raw"] = sql("SELECT order_dow, count(*) AS order_count FROM raw_orders GROUP BY order_dow")
    q["orders_by_dow_observed"] = sql("""
        SELECT order_dow, count(DISTINCT order_id) AS order_count FROM fact_order_items GROUP BY order_dow""")
    q["orders_by_dow"] = sql("SELECT order_dow, count(order_id) AS order_count FROM owt GROUP BY order_dow", [OWT])
    q["orders_by_hour"] = sql(
        "SELECT order_hour_of_day, count(order_id) AS order_count FROM owt GROUP BY order_hour_of_day", [OWT])
    q["order_time"] = sql("""
        SELECT order_dow, order_hour_of_day, count(order_id) AS order_count FROM owt
        GROUP BY order_dow, order_hour_of_day""", [OWT])
    cells = ", ".join(f"count(order_id) FILTER (WHERE order_hour_of_day = {h}) AS h{h}" for h in range(24))
    q["day_hour_heatmap"] = sql(f"SELECT order_dow, {cells} FROM owt GROUP BY order_dow", [OWT])
    q["peak_day"] = sql("""
        SELECT order_dow, count(order_id) AS order_count FROM owt GROUP BY order_dow
        ORDER BY order_count DESC, order_dow LIMIT 1""", [OWT])
    q["peak_hour"] = sql("""
        SELECT order_hour_of_day, count(order_id) AS order_count FROM owt GROUP BY order_hour_of_day
        ORDER BY order_count DESC, order_hour_of_day LIMIT 1""", [OWT])
    q["peak_slot"] = sql("""
        SELECT order_dow, order_hour_of_day, count(order_id) AS order_count FROM owt
        GROUP BY order_dow, order_hour_of_day ORDER BY order_count DESC, order_dow, order_hour_of_day LIMIT 1""", [OWT])
    q["orders_by_dow_daypart"] = sql("""
        SELECT order_dow, day_part, count(order_id) AS order_count FROM owt GROUP BY order_dow, day_part""", [OWT])
    q["basket_stats"] = sql("""
        SELECT count(basket_size) AS n, avg(basket_size) AS mean, round(stddev_samp(basket_size), 9) AS std,
               CAST(min(basket_size) AS DOUBLE) AS min, CAST(quantile_cont(basket_size, 0.25) AS DOUBLE) AS q25,
               CAST(median(basket_size) AS DOUBLE) AS median, CAST(quantile_cont(basket_size, 0.75) AS DOUBLE) AS q75,
               CAST(max(basket_size) AS DOUBLE) AS max
        FROM fact_order WHERE basket_size IS NOT NULL""")
    q["basket_histogram"] = sql("""
        SELECT bin, count(*) AS order_count FROM (
            SELECT CASE WHEN hi = lo THEN 0 ELSE CAST(least(floor((basket_size - lo) / ((hi - lo) / 50)), 49) AS INTEGER) END AS bin
            FROM fact_order, (SELECT CAST(min(basket_size) AS DOUBLE) AS lo, CAST(max(basket_size) AS DOUBLE) AS hi FROM fact_order)
            WHERE basket_size IS NOT NULL) GROUP BY bin""")
    q["basket_distribution"] = sql("""
        SELECT basket_size, count(*) AS order_count FROM fact_order WHERE basket_size IS NOT NULL GROUP BY basket_size""")
    q["basket_bins"] = sql("""
        SELECT bin, CASE WHEN bin = 9 THEN CAST(bin * 3 + 1 AS VARCHAR) || '-' || CAST(bin * 3 + 3 AS VARCHAR) || '+'
                         ELSE CAST(bin * 3 + 1 AS VARCHAR) || '-' || CAST(bin * 3 + 3 AS VARCHAR) END AS label,
               order_count
        FROM (SELECT CAST(least(floor((basket_size - 1) / 3), 9) AS INTEGER) AS bin, count(*) AS order_count
              FROM fact_order WHERE basket_size IS NOT NULL AND basket_size >= 1 GROUP BY 1)""")
    q["basket_by_dow"] = sql("""
        SELECT order_dow, avg(basket_size) AS avg_basket_size, count(*) AS order_count
        FROM (SELECT order_id, order_dow, count(*) AS basket_size FROM fact_order_items GROUP BY order_id, order_dow)
        GROUP BY order_dow""")
    q["basket_by_hour"] = sql("""
        SELECT order_hour_of_day, avg(basket_size) AS avg_basket_size, count(*) AS order_count
        FROM (SELECT order_id, order_hour_of_day, count(*) AS basket_size FROM fact_order_items
              GROUP BY order_id, order_hour_of_day)
        GROUP BY order_hour_of_day""")
    q["basket_most_common"] = sql("""
        SELECT basket_size, count(*) AS order_count FROM fact_order WHERE basket_size IS NOT NULL
        GROUP BY basket_size ORDER BY order_count DESC, basket_size LIMIT 1""")
    q["department_counts"] = sql("SELECT department_name, item_count, reorder_count FROM dept", [DEPT])
    q["departments_by_reorder"] = sql("SELECT department_name, item_count, reorder_count FROM dept", [DEPT])
    q["department_summary"] = sql("""
        SELECT d.department_name, count(*) AS item_count, avg(f.reordered) AS reorder_rate
        FROM fact_order_items f JOIN dim_departments d ON f.department_id = d.department_id
        GROUP BY d.department_name""")
    q["top_departments"] = sql("""
        SELECT department_name, item_count, reorder_count FROM dept ORDER BY item_count DESC, department_name LIMIT 10""",
                               [DEPT])
    q["department_share"] = sql("""
        SELECT department, purchase_count,
               purchase_count / (SELECT sum(purchase_count) FROM product_metrics) * 100.0 AS purchase_percentage
        FROM (SELECT CASE WHEN grouping(department) = 1 THEN 'All Departments' ELSE department END AS department,
                     CAST(sum(purchase_count) AS BIGINT) AS purchase_count
              FROM product_metrics GROUP BY ROLLUP (department))""")
    q["aisle_demand"] = sql("""
        SELECT aisle_id, aisle, purchase_count, reordered_count,
               CAST(reordered_count AS DOUBLE) / purchase_count AS reorder_rate,
               purchase_count / (SELECT sum(purchase_count) FROM product_metrics) * 100.0 AS purchase_percentage
        FROM (SELECT aisle_id, aisle, CAST(sum(purchase_count) AS BIGINT) AS purchase_count,
                     CAST(sum(reordered_count) AS BIGINT) AS reordered_count
              FROM product_metrics GROUP BY aisle_id, aisle)""")
    q["dept_dow_counts"] = sql("SELECT department_name, order_dow, item_count FROM dept_dow", [DEPT_DOW])
    q["dept_dow_counts_of"] = sql(
        "SELECT department_name, order_dow, item_count FROM dept_dow WHERE department_name IN ('ECONOMY', 'PROMO')", [DEPT_DOW])
    cols = ", ".join(f"coalesce(sum(item_count) FILTER (WHERE order_dow = {d}), 0) AS c{d}" for d in range(7))
    total = " + ".join(f"c{d}" for d in range(7))
    shares = ", ".join(f"c{d} / ({total}) * 100.0 AS d{d}" for d in range(7))
    q["dept_dow_share"] = sql(f"""
        SELECT department_name, {shares}
        FROM (SELECT department_name, {cols} FROM dept_dow GROUP BY department_name)""", [DEPT_DOW])
    q["peak_dow_by_department"] = sql("""
        SELECT department_name, order_dow AS peak_order_dow_code FROM (
            SELECT *, row_number() OVER (PARTITION BY department_name ORDER BY item_count DESC, order_dow) AS r
            FROM dept_dow) WHERE r = 1""", [DEPT_DOW])
    q["dept_cart_position"] = sql("""
        SELECT department_name, avg_add_to_cart_order, item_count,
               CASE WHEN avg_add_to_cart_order <= (SELECT median(avg_add_to_cart_order) FROM dept)
                    THEN 'Added earlier' ELSE 'Added later' END AS "group"
        FROM dept""", [DEPT])
    q["dept_order_gap"] = sql("SELECT department_name, avg_days_since_prior, item_count FROM dept", [DEPT])
    q["product_cart_position_extremes"] = sql("""
        (SELECT product_name, avg_add_to_cart_order, item_count, 'Earliest' AS "group" FROM pns
         ORDER BY avg_add_to_cart_order ASC NULLS LAST, product_name LIMIT 10)
        UNION ALL
        (SELECT product_name, avg_add_to_cart_order, item_count, 'Latest' AS "group" FROM pns
         ORDER BY avg_add_to_cart_order DESC NULLS LAST, product_name LIMIT 10)""", [PNS])
    q["top_products_order_gap"] = sql("""
        SELECT product_name, item_count, avg_days_since_prior FROM pns ORDER BY item_count DESC, product_name LIMIT 20""",
                                      [PNS])
    q["order_gap_extremes"] = sql(f"""
        (SELECT product_name, item_count, avg_days_since_prior, 'Shortest cycle' AS "group" FROM pns
         WHERE item_count >= {min_orders} ORDER BY avg_days_since_prior ASC NULLS LAST, product_name LIMIT 20)
        UNION ALL
        (SELECT product_name, item_count, avg_days_since_prior, 'Longest cycle' AS "group" FROM pns
         WHERE item_count >= {min_orders} ORDER BY avg_days_since_prior DESC NULLS LAST, product_name LIMIT 20)""",
                                  [PNS])
    q["reorder_rate_extremes"] = sql(f"""
        SELECT *, reorder_rate * 100.0 AS reorder_rate_pct FROM (
        (SELECT product_name, item_count AS total_count, reorder_count, reorder_rate, 'Most rebought' AS "group"
         FROM pns WHERE item_count >= {min_orders} ORDER BY reorder_rate DESC, product_name LIMIT 5)
        UNION ALL
        (SELECT product_name, item_count AS total_count, reorder_count, reorder_rate, 'Least rebought' AS "group"
         FROM pns WHERE item_count >= {min_orders} ORDER BY reorder_rate ASC, product_name LIMIT 5))""", [PNS])
    q["top_products_by_name"] = sql("""
        SELECT product_name, item_count, reorder_rate FROM pns ORDER BY item_count DESC, product_name LIMIT 20""", [PNS])
    q["top_products"] = sql("""
        SELECT product_id, product_name, department, purchase_count FROM product_metrics
        ORDER BY purchase_count DESC, product_id LIMIT 10""")
    q["top_reordered_products"] = sql(f"""
        SELECT product_id, product_name, department, purchase_count, reordered_count, product_reorder_rate,
               product_reorder_rate * 100.0 AS reorder_rate_percentage
        FROM product_metrics WHERE purchase_count >= {min_orders}
        ORDER BY product_reorder_rate DESC, product_id LIMIT 10""")
    q["dashboard_product_metrics"] = sql("""
        SELECT product_id, product_name, aisle, department, purchase_count, reordered_count, product_reorder_rate
        FROM product_metrics""")
    q["department_products"] = _rank_both(
        ("chosen", "SELECT department_name FROM dept ORDER BY item_count DESC, department_name LIMIT 1"), 5)
    q["department_products_of"] = _rank_both(("chosen", "SELECT 'ECONOMY' AS department_name"), 5)
    q["top_products_in_top_departments"] = _rank_both(
        ("chosen", "SELECT department_name FROM dept ORDER BY item_count DESC, department_name LIMIT 5"), 5)
    q["customer_orders_stats"] = _stats("dim_user", "total_orders")
    q["customer_gap_stats"] = _stats("dim_user", "average_days_between_orders", rounded=True)
    q["customer_reorder_stats"] = _stats("dim_user", "customer_reorder_rate", rounded=True)
    q["customer_histograms"] = _histograms(hist_bins)
    q["segment_summary"] = sql("""
        SELECT customer_segment, count(user_id) AS customer_count,
               round(avg(total_orders), 6) AS average_orders,
               round(avg(customer_reorder_rate), 6) AS average_reorder_rate,
               round(avg(average_basket_size), 6) AS average_basket_size,
               round(avg(average_days_between_orders), 6) AS average_order_gap,
               round(count(user_id) / sum(count(user_id)) OVER () * 100.0, 6) AS customer_percentage
        FROM dim_user_segmented GROUP BY customer_segment""")
    q["segment_variety"] = sql("""
        SELECT customer_segment, count(user_id) AS customer_count,
               round(avg(unique_products_purchased), 6) AS average_unique_products,
               round(avg(average_basket_size), 6) AS average_basket_size
        FROM dim_user_segmented GROUP BY customer_segment""")
    q["customer_segments"] = sql("""
        SELECT u.user_id, u.total_orders, u.customer_reorder_rate,
               (SELECT order_threshold FROM _thresholds) AS order_threshold,
               (SELECT reorder_threshold FROM _thresholds) AS reorder_threshold, u.customer_segment
        FROM dim_user_segmented u""")

    def nulls(cols):
        return " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols)

    kp_cols = ["total_orders", "total_customers", "total_products", "average_basket_size",
               "average_customer_reorder_rate", "average_days_between_orders"]
    pm_cols = ["product_id", "product_name", "aisle", "department", "purchase_count", "reordered_count",
               "product_reorder_rate"]
    checks = f"""
        SELECT 'kpis_single_row' AS check_name, 'dashboard_kpis' AS table_name, abs(count(*) - 1) AS issue_count FROM kp
        UNION ALL SELECT 'kpis_missing', 'dashboard_kpis', {nulls(kp_cols)} FROM kp
        UNION ALL SELECT 'order_time_total', 'dashboard_order_time',
            abs(sum(order_count) - (SELECT count(*) FROM fact_order)) FROM ot
        UNION ALL SELECT 'order_time_missing', 'dashboard_order_time',
            {nulls(["order_dow", "order_hour_of_day", "order_count"])} FROM ot
        UNION ALL SELECT 'basket_distribution_total', 'dashboard_basket_distribution',
            abs(sum(order_count) - (SELECT count(basket_size) FROM fact_order)) FROM bd
        UNION ALL SELECT 'basket_distribution_missing', 'dashboard_basket_distribution',
            {nulls(["basket_size", "order_count"])} FROM bd
        UNION ALL SELECT 'product_metrics_duplicate_ids', 'dashboard_product_metrics',
            count(*) - count(DISTINCT product_id) FROM pm
        UNION ALL SELECT 'product_metrics_missing', 'dashboard_product_metrics', {nulls(pm_cols)} FROM pm
        UNION ALL SELECT 'product_metrics_rate_range', 'dashboard_product_metrics',
            count(*) FILTER (WHERE NOT (product_reorder_rate BETWEEN 0 AND 1)) FROM pm
        UNION ALL SELECT 'product_metrics_total', 'dashboard_product_metrics',
            abs(sum(purchase_count) - (SELECT sum(basket_size) FROM order_baskets)) FROM pm
        UNION ALL SELECT 'customer_segments_total', 'dashboard_customer_segments',
            abs(sum(customer_count) - (SELECT count(*) FROM dim_user)) FROM seg"""
    q["dashboard_checks"] = sql(f"""
        SELECT check_name, table_name, CAST(issue_count AS BIGINT) AS issue_count,
               CASE WHEN issue_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({checks})""", [
        OWT,
        ("kp", """
            SELECT (SELECT count(DISTINCT order_id) FROM fact_order) AS total_orders,
                   (SELECT count(DISTINCT user_id) FROM dim_user) AS total_customers,
                   (SELECT count(DISTINCT product_id) FROM dim_product) AS total_products,
                   (SELECT avg(basket_size) FROM fact_order) AS average_basket_size,
                   (SELECT avg(customer_reorder_rate) FROM dim_user) AS average_customer_reorder_rate,
                   (SELECT avg(average_days_between_orders) FROM dim_user) AS average_days_between_orders"""),
        ("ot", "SELECT order_dow, order_hour_of_day, count(order_id) AS order_count FROM owt GROUP BY 1, 2"),
        ("bd", "SELECT basket_size, count(*) AS order_count FROM fact_order WHERE basket_size IS NOT NULL GROUP BY 1"),
        ("pm", "SELECT * FROM product_metrics"),
        ("seg", "SELECT customer_segment, count(user_id) AS customer_count FROM dim_user_segmented GROUP BY 1"),
    ])
    q["user_history"] = sql("""
        SELECT * FROM fact_order WHERE user_id = (
            SELECT user_id FROM dim_user ORDER BY total_orders DESC, user_id LIMIT 1)""")
    return q
