"""Plan-shape regression tests: the scale properties PLANS.md documents stay true."""

from __future__ import annotations

import re

import pytest

from trolley import catalog
from trolley.plans import marts as mt
from trolley.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hash_exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


@pytest.fixture(scope="module")
def wh(spark):
    w = Warehouse.get(spark, SF)
    w.build_all()
    return w


@pytest.fixture
def no_broadcast(spark):
    """Mimic sides too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_department_queries_read_the_cube(spark, wh):
    reg = catalog.registry()
    for key in ("department_counts", "dept_dow_share", "top_products_in_top_departments"):
        files = reg[key](spark, SF).inputFiles()
        assert any("/item_cube/" in f for f in files), key
        assert not any("/fact_order_items/" in f for f in files), key


def test_order_level_builds_need_no_exchange(wh, no_broadcast):
    assert _hash_exchanges(_plan(mt.order_baskets(wh.int_order_products))) == []
    from trolley.plans.features import order_features
    assert _hash_exchanges(_plan(order_features(wh.stg_orders, wh.order_baskets))) == []
    users = _hash_exchanges(_plan(mt.dim_users(wh.order_baskets, wh.stg_orders)))
    assert len(users) == 1 and users[0].startswith("user_id")


def test_pairs_shuffle_only_pair_counts(spark, wh, no_broadcast):
    from trolley.operators import affinity as af
    ex = _hash_exchanges(_plan(af.product_pairs(wh)))
    assert len(ex) == 1 and ex[0].startswith("product_a_id")


def test_no_cartesian_or_nested_loop_joins(spark, wh):
    reg = catalog.registry()
    skip = {"stream_product_counts", "stream_pair_counts", "stream_upsert", "incremental_load", "ingestion_log",
            "dq_ingestion_log", "table_copy", "write_parquet", "write_csv", "write_append", "export_user_subset",
            "catalog_listing", "dq_tables_exist", "ingest_infer", "ingest_typed", "ingest_row_counts",
            "count_reconciliation", "row_count_contract", "coerce_lenient", "coerce_strict"}
    offenders = []
    for key, fn in reg.items():
        if key in skip:
            continue
        plan = _plan(fn(spark, SF))
        if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
            offenders.append(key)
    assert offenders == []


def test_file_sourced_warehouse_is_bucketed_too(spark, tiny, tmp_path, no_broadcast):
    from trolley.sources import files as io
    from trolley.sources.schemas import SOURCE_FILES
    for t, fname in SOURCE_FILES.items():
        io.write_csv(tiny.raw(t), str(tmp_path / fname))
    fw = Warehouse.from_files(spark, str(tmp_path))
    assert _hash_exchanges(_plan(mt.order_baskets(fw.int_order_products))) == []
    assert sorted(fw.order_baskets.collect()) == sorted(tiny.order_baskets.collect())


def test_row_rules_share_one_scan_per_table(spark, wh):
    from trolley.operators import quality as dq
    rules = [r for r in dq.dbt_not_null_rules() if r.table == "fact_order_items"]
    assert len(rules) == 5
    plan = _plan(dq.eval_row_rules(wh, rules)[0])
    assert plan.count("FileScan") == 1  # five predicates, one aggregate over one scan


@pytest.fixture
def fixed_plans(spark, no_broadcast):
    """Plans as they are before adaptive execution, which shares exchanges only while it runs."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _own_exchanges(plan: str) -> list[str]:
    """Hash exchanges that are run, without the reads of one that is run already."""
    return _hash_exchanges("\n".join(line for line in plan.splitlines() if "ReusedExchange" not in line))


def test_reorder_flags_send_the_items_keys_once(spark, wh, fixed_plans):
    """What the build of the items shuffles: keys once by user and product, reordered ones once by order."""
    from trolley.sources import driver
    placed = wh._placed_items()
    plan = _plan(driver.flag_reorders(placed, wh.buckets))
    ex = _own_exchanges(plan)
    assert [e.split("#")[0] for e in ex] == ["order_id", "user_id"], ex
    assert plan.count("ReusedExchange") == 1 and all(e.endswith(f", {wh.buckets}") for e in ex), ex
    assert not any("lineitem" in f for f in placed.inputFiles())  # the lines are read for a table, which then serves twice


def test_order_sequence_joins_and_sends_the_orders_once(spark, fixed_plans):
    """Ranks and days of the orders share the semi join and its exchange, whose width follows the input."""
    from trolley.sources import driver
    for parts in (3, 300):
        ex = _own_exchanges(_plan(driver.derive_orders(spark, SF, parts)))
        assert sum(e.startswith(("l_orderkey", "o_orderkey")) for e in ex) == 2, ex
        assert any(e.startswith("user_id") and e.endswith(f", {parts}") for e in ex), ex
