"""DuckDB oracle text for the source/sink and incremental keys."""

from __future__ import annotations

from trolley.oracle.prefix import sql
from trolley.sources.schemas import RAW_KEYS, RAW_SCHEMAS, RAW_TABLES


def _counts(where: dict[str, str] | None = None, col: str = "row_count") -> str:
    where = where or {}
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS {col} FROM raw_{t} {where.get(t, '')}" for t in RAW_TABLES)


def sources_sql(models: dict[str, str]) -> dict[str, str]:
    q: dict[str, str] = {}
    q["ingest_typed"] = sql("SELECT * FROM raw_orders")
    q["coerce_lenient"] = sql("SELECT * FROM raw_orders")
    q["coerce_strict"] = sql("SELECT * FROM raw_orders")
    q["ingest_infer"] = sql("""
        SELECT CAST(order_id AS INTEGER) AS order_id, CAST(user_id AS INTEGER) AS user_id, eval_set, order_number,
               order_dow, order_hour_of_day, days_since_prior_order FROM raw_orders""")
    q["ingest_row_counts"] = sql(_counts())
    q["count_reconciliation"] = sql(f"""
        SELECT table_name, row_count AS source_rows, row_count AS loaded_rows, 'PASS' AS status FROM ({_counts()})""")
    q["row_count_contract"] = sql(f"""
        SELECT table_name, row_count AS expected_rows, row_count AS actual_rows, 'PASS' AS status FROM ({_counts()})""")
    q["write_parquet"] = sql("SELECT * FROM dim_product")
    q["write_tables"] = sql("\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST("
        + " + ".join(f"count(*) - count({f.name})" for f in RAW_SCHEMAS[t].fields) + f" AS BIGINT) AS null_count FROM raw_{t}" for t in RAW_TABLES))
    loaded = []
    ledger = []
    for t in RAW_TABLES:
        keys = list(RAW_KEYS[t])
        rest = " || '|' || ".join(f"coalesce(CAST({f.name} AS VARCHAR), '')" for f in RAW_SCHEMAS[t].fields if f.name not in keys)
        second = f"CAST({keys[1]} AS BIGINT)" if len(keys) > 1 else "CAST(NULL AS BIGINT)"
        loaded.append(f"SELECT '{t}' AS table_name, CAST({keys[0]} AS BIGINT) AS key_1, {second} AS key_2, {rest} AS payload FROM raw_{t}")
        # every row once, and those with an even sum of keys a second time
        ledger.append(f"SELECT '{t}' AS table_name, CAST(count(*) + count(*) FILTER (WHERE ({' + '.join(keys)}) % 2 = 0) AS BIGINT) AS rows_read, CAST(min({keys[0]}) AS BIGINT) AS first_key, CAST(max({keys[0]}) AS BIGINT) AS last_key, true AS in_batches, CAST(0 AS BIGINT) AS open_batches FROM raw_{t}")
    q["load_tables"] = sql("\nUNION ALL\n".join(loaded))
    q["load_ledger"] = sql("\nUNION ALL\n".join(ledger))
    q["write_csv"] = sql("SELECT * FROM dim_user")
    q["write_append"] = models["fact_order_item"]
    q["upsert_merge"] = sql("""
        SELECT order_id, product_id, add_to_cart_order,
               CASE WHEN add_to_cart_order = 1 THEN 1 - reordered ELSE reordered END AS reordered
        FROM raw_order_products_prior
        UNION ALL
        SELECT order_id, product_id, add_to_cart_order, reordered FROM raw_order_products_train""")
    sub = "WHERE order_id IN (SELECT order_id FROM raw_orders WHERE user_id <= 100)"
    q["export_user_subset"] = sql(_counts({"orders": "WHERE user_id <= 100", "order_products_prior": sub,
                                           "order_products_train": sub}))
    q["table_copy"] = sql("SELECT * FROM raw_orders")
    q["incremental_load"] = sql("SELECT * FROM raw_orders")
    rows = []
    for t in RAW_TABLES:
        for f in sorted(RAW_SCHEMAS[t].fields, key=lambda f: f.name):
            ty = f.dataType.simpleString()
            rows.append(f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, '{ty}' AS expected_type, "
                        f"'{ty}' AS actual_type, 'PASS' AS status, count({f.name}) AS values FROM raw_{t}")
    q["catalog_listing"] = sql("\nUNION ALL\n".join(
        f"SELECT 'raw_{t}' AS table_name, 'TEMPORARY' AS table_type, true AS is_temporary, {len(RAW_SCHEMAS[t].fields)} AS n_columns, count(*) AS row_count FROM raw_{t}" for t in RAW_TABLES))
    q["dq_tables_exist"] = sql("""
        SELECT 'tables_exist' AS check_name, 'catalog' AS table_name, count(*) AS issue_count, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT unnest(['part', 'orders', 'lineitem']) AS t) WHERE t NOT IN (SELECT table_name FROM information_schema.tables)""")
    q["ingestion_log"] = sql("\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, 'SUCCESS' AS status, count(*) AS actual_rows, count(*) AS expected_rows, true AS has_run_id, true AS completed FROM raw_{t}" for t in RAW_TABLES))
    logged = " UNION ALL ".join(f"SELECT '{t}' AS t, count(*) AS n FROM raw_{t}" for t in RAW_TABLES)
    q["dq_ingestion_log"] = sql(f"""
        SELECT check_name, 'ingestion_log' AS table_name, CAST(issue_count AS BIGINT) AS issue_count, CASE WHEN issue_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
            SELECT 'log_row_count' AS check_name, abs({len(RAW_TABLES)} - count(*)) AS issue_count FROM ({logged})
            UNION ALL SELECT 'log_table_count', abs({len(RAW_TABLES)} - count(DISTINCT t)) FROM ({logged})
            UNION ALL SELECT 'log_failed_tables', count(*) FILTER (WHERE n IS NULL) FROM ({logged})
            UNION ALL SELECT 'log_count_mismatch', count(*) FILTER (WHERE n < 0) FROM ({logged}))""")
    q["schema_contract"] = sql("\nUNION ALL\n".join(rows))
    q["stream_product_counts"] = sql("""
        SELECT product_id, count(*) AS purchase_count, CAST(sum(reordered) AS BIGINT) AS reordered_count
        FROM int_order_products GROUP BY product_id""")
    q["stream_pair_counts"] = models["product_pairs"]
    q["stream_upsert"] = sql("SELECT * FROM stg_orders")
    return q
