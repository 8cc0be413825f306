"""DuckDB oracle text for the DQ suite, rendered from the same rule objects."""

from __future__ import annotations

from trolley.operators import quality as Q
from trolley.oracle.prefix import sql


def _row(r: Q.RowRule) -> str:
    return (f"SELECT '{r.name}' AS check_name, '{r.table}' AS table_name, "
            f"count(*) FILTER (WHERE coalesce(({r.predicate}), false)) AS issue_count FROM {r.table}")


def _key(r: Q.KeyRule) -> str:
    keys = ", ".join(r.keys)
    nonnull = " AND ".join(f"{k} IS NOT NULL" for k in r.keys)
    if r.mode == "dup_groups":
        where = f"WHERE {nonnull}" if len(r.keys) == 1 else ""
        body = f"(SELECT count(*) FROM (SELECT {keys} FROM {r.table} {where} GROUP BY {keys} HAVING count(*) > 1))"
    else:
        body = (f"((SELECT count(*) FROM {r.table}) - "
                f"(SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {r.table} WHERE {nonnull})))")
    return f"SELECT '{r.name}' AS check_name, '{r.table}' AS table_name, {body} AS issue_count"


def _ref(r: Q.RefRule) -> str:
    match = " AND ".join(f"p.{p} = c.{c}" for c, p in zip(r.column, r.parent_column))
    skip = " AND ".join(f"c.{c} IS NOT NULL" for c in r.column) if r.skip_null else "true"
    return (f"SELECT '{r.name}' AS check_name, '{r.table}' AS table_name, count(*) AS issue_count "
            f"FROM {r.table} c WHERE {skip} AND NOT EXISTS (SELECT 1 FROM {r.parent} p WHERE {match})")


def _values(r: Q.ValuesRule) -> str:
    vals = Q._lit_values(r.values)
    return (f"SELECT '{r.name}' AS check_name, '{r.table}' AS table_name, count(*) AS issue_count FROM "
            f"(SELECT DISTINCT {r.column} FROM {r.table} WHERE {r.column} IS NOT NULL AND {r.column} NOT IN ({vals}))")


def _render(rule) -> str:
    if isinstance(rule, Q.RowRule):
        return _row(rule)
    if isinstance(rule, Q.KeyRule):
        return _key(rule)
    if isinstance(rule, Q.RefRule):
        return _ref(rule)
    return _values(rule)


SPECIAL_SQL = {
    "dq_product_refs": ["""SELECT 'product_refs' AS check_name, 'raw_products' AS table_name, count(*) AS issue_count
        FROM raw_products p
        WHERE NOT EXISTS (SELECT 1 FROM raw_aisles a WHERE a.aisle_id = p.aisle_id)
           OR NOT EXISTS (SELECT 1 FROM raw_departments d WHERE d.department_id = p.department_id)"""],
    "dq_train_refs": ["""SELECT 'train_refs' AS check_name, 'raw_order_products_train' AS table_name, count(*) AS issue_count
        FROM raw_order_products_train t
        WHERE NOT EXISTS (SELECT 1 FROM raw_orders o WHERE o.order_id = t.order_id)
           OR NOT EXISTS (SELECT 1 FROM raw_products p WHERE p.product_id = t.product_id)"""],
    "dq_partition_consistency": [
        f"""SELECT 'partition_consistency_{s}' AS check_name, 'raw_order_products_{s}' AS table_name,
                   count(*) FILTER (WHERE o.eval_set <> '{s}') AS issue_count
            FROM raw_order_products_{s} i JOIN raw_orders o ON i.order_id = o.order_id""" for s in ("prior", "train")],
    "dq_key_report": [_ref(r) for r in Q.dbt_relationship_rules()] + [_row(
        Q.RowRule("invalid_reordered_fact_order_items", "fact_order_items", "reordered NOT IN (0, 1)"))],
}


# the row rules over ranges, counted column by column
_VALID_ORDER = ("coalesce(order_number BETWEEN 1 AND 2147483647, true) AND coalesce(order_dow IN (0, 1, 2, 3, 4, 5, 6), true) "
                "AND coalesce(order_hour_of_day BETWEEN 0 AND 23, true) AND coalesce(list_contains(['prior', 'train', 'test'], eval_set), true) "
                "AND coalesce(days_since_prior_order BETWEEN 0 AND 30, true) "
                "AND CASE WHEN order_number = 1 THEN days_since_prior_order IS NULL WHEN order_number > 1 THEN days_since_prior_order IS NOT NULL ELSE true END")
_VALID_ITEM = "coalesce(add_to_cart_order >= 1, true) AND coalesce(reordered = 0 OR reordered = 1, true)"
SPECIAL_SQL["dq_order_ranges"] = [
    f"SELECT 'order_ranges' AS check_name, 'raw_orders' AS table_name, (SELECT count(*) FROM raw_orders) - (SELECT count(*) FROM raw_orders WHERE {_VALID_ORDER}) AS issue_count"]
SPECIAL_SQL["dq_item_ranges"] = [
    f"SELECT 'item_ranges_{s}' AS check_name, 'raw_order_products_{s}' AS table_name, (SELECT count(*) FROM raw_order_products_{s}) - (SELECT count(*) FROM raw_order_products_{s} WHERE {_VALID_ITEM}) AS issue_count"
    for s in ("prior", "train")]


def _report(parts: list[str]) -> str:
    body = "\nUNION ALL\n".join(parts)
    return (f"SELECT check_name, table_name, CAST(issue_count AS BIGINT) AS issue_count, "
            f"CASE WHEN issue_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({body})")


def quality_sql() -> dict[str, str]:
    suite = Q.suite()
    q: dict[str, str] = {}
    parts_all: list[str] = []
    for key in Q.GATE_KEYS:
        parts = SPECIAL_SQL[key] if key in SPECIAL_SQL else [_render(r) for r in suite[key]]
        q[key] = sql(_report(parts))
        parts_all += parts
    q["dq_key_report"] = sql(_report(SPECIAL_SQL["dq_key_report"]))
    orphans = ([_ref(r) for r in Q.dbt_relationship_rules()]
               + [_ref(r) for rs in Q.raw_ref_rules().values() for r in rs]
               + SPECIAL_SQL["dq_train_refs"] + SPECIAL_SQL["dq_product_refs"])
    q["dq_orphans"] = sql(_report(orphans))
    q["dq_all_matched"] = sql(_report([_render(r) for r in suite["dq_star_refs"]]))
    q["dq_report"] = sql(_report(parts_all))
    rep = _report(parts_all)
    q["dq_gate"] = sql(f"""
        SELECT * FROM ({rep})
        UNION ALL
        SELECT 'gate', '*', CAST(count(*) FILTER (WHERE status = 'FAIL') AS BIGINT),
               CASE WHEN count(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END FROM ({rep})""")
    q["dq_null_breakdown"] = sql("""
        SELECT 'null_gap_order_number_' || CAST(order_number AS VARCHAR) AS check_name, 'fact_order' AS table_name,
               count(*) AS issue_count, 'INFO' AS status
        FROM fact_order WHERE days_since_prior_order IS NULL GROUP BY order_number
        UNION ALL
        SELECT 'null_basket_eval_set_' || eval_set, 'fact_order', count(*), 'INFO'
        FROM fact_order WHERE basket_size IS NULL GROUP BY eval_set""")
    return q
