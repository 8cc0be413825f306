"""DuckDB oracle text for the affinity queries."""

from __future__ import annotations

from trolley.oracle.prefix import sql


def _top(k: int) -> tuple[str, str]:
    return (f"top{k}", f"""
        SELECT product_id, purchase_count,
               CAST(row_number() OVER (ORDER BY purchase_count DESC, product_id) AS INTEGER) AS rank
        FROM product_metrics ORDER BY purchase_count DESC, product_id LIMIT {k}""")


def _pairs(k: int) -> list[tuple[str, str]]:
    return [
        _top(k),
        (f"rows{k}", f"""
            SELECT DISTINCT order_id, product_id FROM int_order_products
            WHERE product_id IN (SELECT product_id FROM top{k})"""),
        (f"pairs{k}", f"""
            SELECT a.product_id AS product_a_id, b.product_id AS product_b_id, count(*) AS pair_order_count
            FROM rows{k} a JOIN rows{k} b ON a.order_id = b.order_id AND a.product_id < b.product_id
            GROUP BY 1, 2"""),
    ]


def affinity_sql(k: int, n_pairs: int, n_matrix: int, triples_from: int) -> dict[str, str]:
    q: dict[str, str] = {}
    q["top_k_products"] = sql(f"SELECT * FROM top{k}", [_top(k)])
    q["product_pairs"] = sql(f"SELECT * FROM pairs{k}", _pairs(k))
    q["top_product_pairs"] = sql(f"""
        SELECT t.product_a_id, t.product_b_id, a.product_name AS product_a, b.product_name AS product_b,
               t.pair_order_count
        FROM (SELECT * FROM pairs{k} ORDER BY pair_order_count DESC, product_a_id, product_b_id LIMIT {n_pairs}) t
        LEFT JOIN dim_product a ON a.product_id = t.product_a_id
        LEFT JOIN dim_product b ON b.product_id = t.product_b_id""", _pairs(k))
    n = n_matrix
    cells = ", ".join(
        f"coalesce((SELECT pair_order_count FROM pairs{n} x JOIN top{n} c ON c.rank = {j} "
        f"WHERE (x.product_a_id = r.product_id AND x.product_b_id = c.product_id) "
        f"OR (x.product_b_id = r.product_id AND x.product_a_id = c.product_id)), 0) AS p{j}"
        for j in range(1, n + 1))
    matrix = (f"matrix{n}", f"""
        SELECT r.rank AS product_rank, d.product_name, {cells}
        FROM top{n} r LEFT JOIN dim_product d ON d.product_id = r.product_id""")
    q["pair_matrix"] = sql(f"SELECT * FROM matrix{n}", _pairs(n) + [matrix])
    unpiv = " UNION ALL ".join(
        f"SELECT m.product_rank AS row_rank, m.product_name AS row_product, {j} AS col_rank, m.p{j} AS pair_order_count "
        f"FROM matrix{n} m" for j in range(1, n + 1))
    q["pair_matrix_lower"] = sql(f"""
        SELECT l.row_rank, l.row_product, CAST(l.col_rank AS INTEGER) AS col_rank, c.product_name AS col_product,
               l.pair_order_count
        FROM ({unpiv}) l JOIN matrix{n} c ON c.product_rank = l.col_rank
        WHERE l.row_rank > l.col_rank""", _pairs(n) + [matrix])
    q["association_rules"] = sql(f"""
        SELECT p.product_a_id, p.product_b_id, p.pair_order_count,
               CAST(p.pair_order_count AS DOUBLE) / (SELECT count(*) FROM order_baskets) AS support,
               CAST(p.pair_order_count AS DOUBLE) / a.n AS confidence_ab,
               CAST(p.pair_order_count AS DOUBLE) / b.n AS confidence_ba,
               CAST(p.pair_order_count AS DOUBLE) * (SELECT count(*) FROM order_baskets) / (CAST(a.n AS DOUBLE) * b.n)
                   AS lift
        FROM pairs{k} p
        JOIN (SELECT product_id, count(*) AS n FROM rows{k} GROUP BY product_id) a ON a.product_id = p.product_a_id
        JOIN (SELECT product_id, count(*) AS n FROM rows{k} GROUP BY product_id) b ON b.product_id = p.product_b_id""",
               _pairs(k))
    floor = triples_from
    q["itemset_triples"] = sql(f"""
        SELECT t.a AS product_a_id, t.b AS product_b_id, t.c AS product_c_id, t.n AS order_count,
               CAST(t.n AS DOUBLE) / (SELECT count(*) FROM order_baskets) AS support, CAST(t.n AS DOUBLE) / p.n AS confidence,
               CAST(t.n AS DOUBLE) * (SELECT count(*) FROM order_baskets) * (SELECT count(*) FROM order_baskets)
                   / (CAST(x.n AS DOUBLE) * CAST(y.n AS DOUBLE) * CAST(z.n AS DOUBLE)) AS lift
        FROM (SELECT i.product_id AS a, j.product_id AS b, k.product_id AS c, count(*) AS n
              FROM bought i JOIN bought j ON j.order_id = i.order_id AND j.product_id > i.product_id
              JOIN bought k ON k.order_id = i.order_id AND k.product_id > j.product_id GROUP BY 1, 2, 3 HAVING count(*) >= {floor}) t
        JOIN (SELECT i.product_id AS a, j.product_id AS b, count(*) AS n
              FROM bought i JOIN bought j ON j.order_id = i.order_id AND j.product_id > i.product_id GROUP BY 1, 2) p ON p.a = t.a AND p.b = t.b
        JOIN alone x ON x.product_id = t.a JOIN alone y ON y.product_id = t.b JOIN alone z ON z.product_id = t.c""", [
        ("bought", "SELECT DISTINCT order_id, product_id FROM int_order_products"),
        ("alone", "SELECT product_id, count(*) AS n FROM bought GROUP BY product_id")])
    return q
