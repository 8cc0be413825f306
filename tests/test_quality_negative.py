"""Negative fixtures: one planted violation -> exactly one issue in the targeted check (FIXTURES section 5)."""

from __future__ import annotations

import pytest

from tests.frames import AISLES, ORDERS, PRIOR, PRODUCTS, TRAIN, warehouse
from trolley.operators import quality as dq
from trolley.sources import files as io


def _issues(wh, key):
    return {r.check_name: r.issue_count for r in dq.run_key(wh, key).collect()}


def test_clean_data_passes_every_check(tiny):
    rep = dq.dq_report(tiny).collect()
    failed = [(r.check_name, r.issue_count) for r in rep if r.status != "PASS"]
    assert failed == []
    assert dq.enforce(tiny).count() == len(rep) + 1


CASES = [
    ("dup order_id", {"orders": ORDERS + [ORDERS[0]]}, "dq_pk_unique", "pk_unique_orders"),
    ("dup item pair", {"order_products_prior": PRIOR + [PRIOR[0]]}, "dq_item_pair_unique", "item_pair_unique_prior"),
    ("null product_name", {"products": PRODUCTS[:2] + [(3, None, 2, 2)]}, "dq_required_not_null",
     "required_not_null_products"),
    ("blank aisle", {"aisles": [AISLES[0], (2, "  ")]}, "dq_names_not_blank", "names_not_blank_aisles"),
    ("aisle_id 0", {"aisles": AISLES + [(0, "bulk")]}, "dq_positive_ids", "positive_ids_aisles"),
    ("order_dow 7", {"orders": [ORDERS[0][:4] + (7,) + ORDERS[0][5:]] + ORDERS[1:]}, "dq_order_ranges",
     "order_ranges"),
    ("order_hour 24", {"orders": [ORDERS[0][:5] + (24,) + ORDERS[0][6:]] + ORDERS[1:]}, "dq_order_ranges",
     "order_ranges"),
    ("eval_set x", {"orders": ORDERS[:4] + [ORDERS[4][:2] + ("x",) + ORDERS[4][3:]]}, "dq_order_ranges",
     "order_ranges"),
    ("gap 31", {"orders": ORDERS[:1] + [ORDERS[1][:6] + (31.0,)] + ORDERS[2:]}, "dq_order_ranges", "order_ranges"),
    ("null gap on order 2", {"orders": ORDERS[:1] + [ORDERS[1][:6] + (None,)] + ORDERS[2:]}, "dq_gap_null_iff_first",
     "gap_null_iff_first"),
    ("gap on first order", {"orders": [ORDERS[0][:6] + (4.0,)] + ORDERS[1:]}, "dq_gap_null_iff_first",
     "gap_null_iff_first"),
    ("cart position 0", {"order_products_train": [(3, 1, 0, 1), TRAIN[1]]}, "dq_cart_position",
     "cart_position_is_positive"),
    ("reordered 2", {"order_products_prior": [(1, 1, 1, 2)] + PRIOR[1:]}, "dq_item_ranges", "item_ranges_prior"),
    ("item -> missing order", {"order_products_prior": PRIOR + [(99, 1, 1, 0)]}, "dq_prior_order_refs",
     "prior_order_refs"),
    ("item -> missing product", {"order_products_prior": PRIOR + [(1, 99, 3, 0)]}, "dq_prior_product_refs",
     "prior_product_refs"),
    ("product -> missing aisle", {"products": PRODUCTS + [(4, "Kiwi", 9, 1)]}, "dq_product_refs", "product_refs"),
    ("prior item on train order", {"order_products_prior": PRIOR + [(3, 3, 3, 0)]}, "dq_partition_consistency",
     "partition_consistency_prior"),
    ("train item -> missing product", {"order_products_train": TRAIN + [(3, 77, 3, 0)]}, "dq_train_refs",
     "train_refs"),
    ("test order with a basket", {"order_products_train": TRAIN + [(5, 1, 1, 0)]}, "dq_test_orders_empty",
     "test_orders_empty"),
    ("prior order without a basket", {"order_products_prior": PRIOR[:4]}, "dq_basket_positive", "basket_positive"),
    ("fact -> missing product", {"order_products_prior": PRIOR + [(1, 99, 3, 0)]}, "dq_relationships",
     "relationships_fact_order_items_product_id"),
    ("reordered not accepted", {"order_products_prior": [(1, 1, 1, 2)] + PRIOR[1:]}, "dq_accepted_values",
     "accepted_values_fact_order_items_reordered"),
    ("dim dup key", {"aisles": AISLES + [(2, "yogurt2")]}, "dq_unique", "unique_dim_aisles_aisle_id"),
]


@pytest.mark.parametrize("label,override,key,check", CASES, ids=[c[0] for c in CASES])
def test_planted_violation(spark, label, override, key, check):
    wh = warehouse(spark, **override)
    assert _issues(wh, key)[check] == 1


def test_gate_raises_on_failure(spark):
    wh = warehouse(spark, aisles=AISLES + [(0, "bulk")])
    with pytest.raises(AssertionError, match="positive_ids_aisles"):
        dq.enforce(wh)


def test_missing_table_is_reported(spark, tmp_path):
    with pytest.raises(FileNotFoundError) as err:
        io.require_sources(spark, {"a": str(tmp_path / "nope1"), "b": str(tmp_path / "nope2")})
    assert "nope1" in str(err.value) and "nope2" in str(err.value)


def test_wrong_column_type_in_contract(tiny):
    from pyspark.sql import types as T
    from trolley.sources.schemas import RAW_SCHEMAS
    bad = dict(RAW_SCHEMAS)
    bad["aisles"] = T.StructType([T.StructField("aisle_id", T.LongType()), T.StructField("aisle", T.StringType())])
    rows = io.schema_contract(tiny, bad).filter("status = 'FAIL'").collect()
    assert [(r.table_name, r.column_name) for r in rows] == [("aisles", "aisle_id")]


def test_wrong_row_count_in_contract(tiny):
    rows = io.row_count_contract(tiny, {"aisles": 3, "departments": 2, "products": 3, "orders": 5,
                                        "order_products_prior": 5, "order_products_train": 2}).collect()
    assert {r.table_name for r in rows if r.status == "FAIL"} == {"aisles"}


NONE_WRONG = {"log_row_count": 0, "log_table_count": 0, "log_failed_tables": 0, "log_count_mismatch": 0}


def _log(wh):
    return {r.table_name: (r.status, r.actual_rows, r.expected_rows) for r in io.ingestion_log(wh).collect()}


def _checks(wh):
    return {r.check_name: r.issue_count for r in io.check_ingestion_log(wh).collect()}


def test_check_reads_the_log_of_the_load(tiny):
    with pytest.raises(Exception, match="(?i)path"):
        io.check_ingestion_log(tiny).collect()  # nothing was loaded: the check writes no log of its own
    io.load_run(tiny)
    assert _checks(tiny) == NONE_WRONG
    assert io.ingestion_log(tiny).count() == 6


def test_ingestion_log_with_failed_table(tiny):
    io.load_run(tiny)
    io.load_run(tiny, expected={"aisles": 99})
    assert _checks(tiny) == {**NONE_WRONG, "log_failed_tables": 1, "log_count_mismatch": 1}  # the latest run counts


def _files(tiny, folder):
    from trolley.sources.schemas import SOURCE_FILES
    for t, name in SOURCE_FILES.items():
        io.write_csv(tiny.raw(t), f"{folder}/{name}")


def test_run_that_failed_is_logged_and_raised(spark, tiny, tmp_path):
    from trolley.plans.warehouse import Warehouse
    _files(tiny, tmp_path)
    wh = Warehouse.from_files(spark, str(tmp_path))
    io.load_run(wh)
    assert _checks(wh) == NONE_WRONG
    assert _log(wh)["order_products_prior"] == ("SUCCESS", 5, 5) and wh.source_rows("order_products_train") == 2
    bad = Warehouse.from_files(spark, str(tmp_path))
    spark.createDataFrame([("x", "y")], "aisle_id string, aisle string").write.mode("overwrite").option("header", True).csv(f"{tmp_path}/aisles.csv")
    with pytest.raises(Exception, match="(?i)malformed"):
        io.load_run(bad)
    log = _log(bad)
    assert log["aisles"] == ("FAILED", None, None) and log["orders"] == ("SUCCESS", 5, 5)
    assert _checks(bad) == {**NONE_WRONG, "log_failed_tables": 1}


def test_missing_file_is_counted_and_an_empty_table_is_not(spark, tiny, tmp_path):
    import shutil

    from trolley.plans.warehouse import Warehouse
    _files(tiny, tmp_path)
    wh = Warehouse.from_files(spark, str(tmp_path))
    assert _issues(wh, "dq_tables_exist") == {"tables_exist": 0}
    tiny.raw("departments").limit(0).write.mode("overwrite").option("header", True).csv(f"{tmp_path}/departments.csv")
    assert _issues(wh, "dq_tables_exist") == {"tables_exist": 0}
    shutil.move(f"{tmp_path}/aisles.csv", f"{tmp_path}/elsewhere.csv")
    assert _issues(wh, "dq_tables_exist") == {"tables_exist": 1} and wh.missing() == ["aisles"]
    listed = {r.table_name: (r.table_type, r.n_columns, r.row_count) for r in io.catalog_listing(wh).collect()}
    assert "raw_aisles" not in listed and listed["raw_departments"] == ("TEMPORARY", 2, 0) and listed["raw_orders"] == ("TEMPORARY", 7, 5)
    assert wh._tables == {}  # listing built nothing
    with pytest.raises(FileNotFoundError, match="aisles"):
        wh.raw("orders")
