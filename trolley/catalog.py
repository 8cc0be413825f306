"""Query registry: key -> callable(spark, sf_dir) with the default parameters bound.

A query takes its parameters by name: ``registry()[key](spark, sf_dir, n=5)`` or
``registry()[key].on(wh, n=5)``; defaults are those of the original analysis (a floor
of 1,000 purchases, users up to 20,000).  Only the calls over the driver's derived
tables (spark, sf_dir) pass ``SMALL`` parameters, because none of their products
reaches 1,000 purchases and none of their users has an id above 20,000.
"""

from __future__ import annotations

from functools import partial
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from trolley.plans.warehouse import Warehouse

FLOOR = 350
SMALL_USER = 100
SMALL_TRIPLES = 3  # orders that make three of the derived products frequent
# departments that the driver's tables hold, for the keys with named departments
DEPARTMENTS = ("ECONOMY", "PROMO")

Query = Callable[[SparkSession, str], DataFrame]


def _wh(fn: Callable[..., DataFrame], small: dict | None = None, **params) -> Query:
    """small: parameters for the driver's derived tables only."""
    def run(spark: SparkSession, sf_dir: str, **own) -> DataFrame:
        return fn(Warehouse.get(spark, sf_dir), **{**params, **(small or {}), **own})
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    run.on = lambda wh, **own: fn(wh, **{**params, **own})  # the same query over any Warehouse (e.g. from_files)
    return run


def _table(name: str) -> Query:
    def on(wh: Warehouse) -> DataFrame:
        return wh.raw(name[4:]) if name.startswith("raw_") else getattr(wh, name)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return on(Warehouse.get(spark, sf_dir))
    run.__name__ = name
    run.on = lambda wh, **_: on(wh)
    return run


MODEL_KEYS = (
    "stg_orders", "stg_products", "stg_aisles", "stg_departments", "stg_order_products_prior",
    "stg_order_products_train", "int_order_products", "int_order_items_enriched", "fact_order_items",
    "dim_orders", "dim_products", "dim_aisles", "dim_departments", "dim_users", "dim_product",
    "dim_order_slot", "fact_order", "fact_order_item", "order_features", "customer_order_features",
    "customer_basket_features", "customer_product_features", "dim_user", "dim_user_segmented", "product_metrics",
    "order_baskets", "item_cube",
)


def registry() -> dict[str, Query]:
    from trolley.operators import metrics as m
    from trolley.plans import features as fe

    q: dict[str, Query] = {k: _table(k) for k in MODEL_KEYS}

    def prior_order_features(wh: Warehouse) -> DataFrame:
        return fe.source_order_features(wh.stg_order_products_prior)

    def train_order_features(wh: Warehouse) -> DataFrame:
        return fe.source_order_features(wh.stg_order_products_train)

    def product_first_added(wh: Warehouse) -> DataFrame:
        return fe.product_first_added(wh.item_cube, wh.order_baskets)

    def orders_with_time(wh: Warehouse) -> DataFrame:
        return m._orders_with_time(wh)

    from trolley.operators import affinity as af
    from trolley.operators import quality as dq

    for key in list(dq.GATE_KEYS) + ["dq_key_report", "dq_null_breakdown", "dq_tables_exist", "dq_orphans",
                                     "dq_all_matched"]:
        q[key] = _wh(partial(dq.run_key, key=key))
        q[key].__name__ = key
    q["dq_report"] = _wh(dq.dq_report)
    q["dq_gate"] = _wh(dq.dq_gate)
    from trolley.operators import profile as pr
    from trolley.sources import files as io
    from trolley.streaming import incremental as inc

    q.update({
        "ingest_infer": _wh(lambda wh: io.load_raw(wh, typed=False)["orders"]),
        "ingest_typed": _wh(lambda wh: io.load_raw(wh)["orders"]),
        "ingest_row_counts": _wh(io.ingest_row_counts),
        "coerce_lenient": _wh(io.coerce_landed),
        "coerce_strict": _wh(partial(io.coerce_landed, strict=True)),
        "count_reconciliation": _wh(io.count_reconciliation),
        "write_parquet": _wh(io.read_back_parquet),
        "write_tables": _wh(io.write_tables),
        "load_tables": _wh(inc.load_tables, small={"files_per_trigger": 2}),
        "load_ledger": _wh(inc.load_summary, small={"files_per_trigger": 2}),
        "write_csv": _wh(io.read_back_csv),
        "write_append": _wh(io.append_items),
        "export_user_subset": _wh(io.export_user_subset, small={"max_user_id": SMALL_USER}),
        "upsert_merge": _wh(io.upsert_merge),
        "table_copy": _wh(io.table_copy),
        "ingestion_log": _wh(io.logged_tables),
        "dq_ingestion_log": _wh(io.logged_checks),
        "catalog_listing": _wh(io.catalog_listing),
        "schema_contract": _wh(io.schema_contract),
        "row_count_contract": _wh(io.row_count_contract),
        "incremental_load": _wh(inc.incremental_load),
        "stream_product_counts": _wh(inc.stream_product_counts, small={"files_per_trigger": 3}),
        "stream_pair_counts": _wh(inc.stream_pair_counts, small={"files_per_trigger": 3}),
        "stream_upsert": _wh(inc.stream_upsert, small={"files_per_trigger": 3}),
        "profile_missing": _wh(pr.profile_missing),
        "profile_describe": _wh(pr.profile_describe),
        "profile_duplicates": _wh(pr.profile_duplicates),
        "iqr_outliers": _wh(pr.iqr_outliers),
        "profile_shape": _wh(pr.profile_shape),
    })
    q.update({
        "top_k_products": _wh(af.top_k_products),
        "product_pairs": _wh(af.product_pairs),
        "top_product_pairs": _wh(af.top_product_pairs),
        "pair_matrix": _wh(af.pair_matrix),
        "pair_matrix_lower": _wh(af.pair_matrix_lower),
        "association_rules": _wh(af.association_rules),
        "itemset_triples": _wh(af.itemset_triples, small={"min_orders": SMALL_TRIPLES}),
    })
    q.update({
        "prior_order_features": _wh(prior_order_features),
        "train_order_features": _wh(train_order_features),
        "product_first_added": _wh(product_first_added),
        "orders_with_time": _wh(orders_with_time),
        "kpis_observed": _wh(m.kpis_observed),
        "kpis_all": _wh(m.kpis_all),
        "fact_summary": _wh(m.fact_summary),
        "orders_by_dow_raw": _wh(m.orders_by_dow_raw),
        "orders_by_dow_observed": _wh(m.orders_by_dow_observed),
        "orders_by_dow": _wh(m.orders_by_dow),
        "orders_by_hour": _wh(m.orders_by_hour),
        "day_hour_heatmap": _wh(m.day_hour_heatmap),
        "order_time": _wh(m.order_time),
        "peak_day": _wh(m.peak_day),
        "peak_hour": _wh(m.peak_hour),
        "peak_slot": _wh(m.peak_slot),
        "orders_by_dow_daypart": _wh(m.orders_by_dow_daypart),
        "basket_stats": _wh(m.basket_stats),
        "basket_histogram": _wh(m.basket_histogram),
        "basket_distribution": _wh(m.basket_distribution),
        "basket_bins": _wh(m.basket_bins),
        "basket_by_dow": _wh(m.basket_by_dow),
        "basket_by_hour": _wh(m.basket_by_hour),
        "basket_most_common": _wh(m.basket_most_common),
        "department_counts": _wh(m.department_counts),
        "departments_by_reorder": _wh(m.departments_by_reorder),
        "department_summary": _wh(m.department_summary),
        "top_departments": _wh(m.top_departments),
        "department_share": _wh(m.department_share),
        "aisle_demand": _wh(m.aisle_demand),
        "dept_dow_counts": _wh(m.dept_dow_counts),
        "dept_dow_share": _wh(m.dept_dow_share),
        "peak_dow_by_department": _wh(m.peak_dow_by_department),
        "dept_cart_position": _wh(m.dept_cart_position),
        "product_cart_position_extremes": _wh(m.product_cart_position_extremes),
        "dept_order_gap": _wh(m.dept_order_gap),
        "top_products_order_gap": _wh(m.top_products_order_gap),
        "order_gap_extremes": _wh(m.order_gap_extremes, small={"min_orders": FLOOR}),
        "reorder_rate_extremes": _wh(m.reorder_rate_extremes, small={"min_orders": FLOOR}),
        "top_products_by_name": _wh(m.top_products_by_name),
        "top_products": _wh(m.top_products),
        "top_reordered_products": _wh(m.top_reordered_products, small={"min_purchases": FLOOR}),
        "department_products": _wh(m.department_products),
        "top_products_in_top_departments": _wh(m.top_products_in_top_departments),
        "customer_orders_stats": _wh(m.customer_orders_stats),
        "customer_gap_stats": _wh(m.customer_gap_stats),
        "customer_reorder_stats": _wh(m.customer_reorder_stats),
        "customer_histograms": _wh(m.customer_histograms),
        "segment_summary": _wh(m.segment_summary),
        "segment_variety": _wh(m.segment_variety),
        "dashboard_product_metrics": _wh(m.dashboard_product_metrics),
        "dashboard_checks": _wh(m.dashboard_checks),
        "customer_segments": _wh(m.customer_segments),
        "user_history": _wh(m.user_history),
        "dept_dow_counts_of": _wh(m.dept_dow_counts, departments=DEPARTMENTS),
        "department_products_of": _wh(m.department_products, department=DEPARTMENTS[0]),
    })
    return q


def oracle() -> dict[str, str]:
    from trolley.oracle.metrics_sql import metric_sql
    from trolley.oracle.models_sql import model_sql
    from trolley.operators.metrics import CUSTOMER_HISTOGRAM_BINS

    from trolley.operators import affinity as af
    from trolley.oracle.affinity_sql import affinity_sql
    from trolley.oracle.quality_sql import quality_sql

    out = dict(model_sql())
    out.update(metric_sql(FLOOR, CUSTOMER_HISTOGRAM_BINS))
    out.update(affinity_sql(af.AFFINITY_PRODUCTS, af.TOP_PAIRS, af.MATRIX_PRODUCTS, SMALL_TRIPLES))
    out.update(quality_sql())
    from trolley.oracle.profile_sql import profile_sql
    from trolley.oracle.sources_sql import sources_sql
    out.update(profile_sql())
    out.update(sources_sql(out))
    return out


__all__ = ["registry", "oracle", "FLOOR", "partial"]
