"""Sources, sinks and incremental jobs on the hand-made frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.frames import ORDERS, warehouse
from trolley.operators import affinity as af
from trolley.sources import files as io
from trolley.streaming import incremental as inc


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_csv_round_trip_keeps_null_not_nan(tiny):
    back = io.read_back_csv(tiny, "dim_user")
    u = {r.user_id: r for r in back.collect()}
    assert u[1].average_days_between_orders == 8.5
    assert back.filter(F.isnan("average_days_between_orders")).count() == 0


def test_typed_ingest_equals_raw(tiny):
    loaded = io.load_raw(tiny)
    for t in ("orders", "order_products_prior", "products"):
        assert sorted(loaded[t].collect()) == sorted(tiny.raw(t).collect())


def test_subset_export_is_closed(tiny):
    counts = {r.table_name: r.row_count for r in io.export_user_subset(tiny, max_user_id=1).collect()}
    # user 1 has orders 1, 2, 3; prior items of orders 1 and 2, train items of order 3
    assert counts == {"aisles": 2, "departments": 2, "products": 3, "orders": 3,
                      "order_products_prior": 4, "order_products_train": 2}


def test_upsert_last_wins(spark):
    existing = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "old", 1), (2, "new", 2), (3, "c", 1)], "k int, v string, seq int")
    got = _rows(io.upsert(existing, batch, ["k"], order_col="seq"), "k", "v")
    assert got == [(1, "a"), (2, "new"), (3, "c")]


def test_stream_pairs_equal_batch_pairs(tiny):
    want = _rows(af.product_pairs(tiny), "product_a_id", "product_b_id", "pair_order_count")
    got = _rows(inc.stream_pair_counts(tiny, files_per_trigger=1), "product_a_id", "product_b_id", "pair_order_count")
    assert got == want


def test_stream_product_counts_equal_metrics(tiny):
    want = _rows(tiny.product_metrics, "product_id", "purchase_count", "reordered_count")
    got = _rows(inc.stream_product_counts(tiny, files_per_trigger=2), "product_id", "purchase_count", "reordered_count")
    assert got == want


def test_stream_upsert_keeps_final_rows(tiny):
    got = inc.stream_upsert(tiny, files_per_trigger=1)
    assert sorted(got.collect()) == sorted(tiny.stg_orders.collect())


def test_incremental_load_resumes(spark):
    wh = warehouse(spark)
    first = inc.incremental_load(wh, files_per_trigger=1)
    assert first.count() == len(ORDERS)
    # a new file lands; a re-run loads only that file
    extra = spark.createDataFrame([(9, 3, "prior", 1, 2, 5, None)], first.schema)
    io.write_csv(extra, f"{io.land_csv(wh)}/orders", mode="append")
    second = inc.incremental_load(wh, files_per_trigger=1)
    assert second.count() == len(ORDERS) + 1
    assert second.filter("order_id = 9").count() == 1


def test_table_copy_appends_in_bounded_files(tiny):
    copied = io.table_copy(tiny, "orders", batch_rows=2)
    assert copied.count() == len(ORDERS)
    assert len(copied.inputFiles()) >= 3


def test_warehouse_from_source_files(spark, tiny, tmp_path):
    from trolley.plans.warehouse import Warehouse
    from trolley.sources.schemas import SOURCE_FILES
    from trolley import catalog
    for t, fname in SOURCE_FILES.items():
        io.write_csv(tiny.raw(t), str(tmp_path / fname))
    wh = Warehouse.from_files(spark, str(tmp_path))
    assert _rows(wh.dim_user, "user_id", "total_orders", "total_items") == \
        _rows(tiny.dim_user, "user_id", "total_orders", "total_items")
    reg = catalog.registry()
    assert _rows(reg["department_counts"].on(wh), "department_name", "item_count") == \
        _rows(reg["department_counts"].on(tiny), "department_name", "item_count")


def test_missing_source_files_all_listed(spark, tmp_path):
    import pytest
    from trolley.plans.warehouse import Warehouse
    wh = Warehouse.from_files(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError) as err:
        wh.raw("orders")
    assert "aisles" in str(err.value) and "order_products_train" in str(err.value)


def test_nan_cells_become_null(spark, tmp_path):
    p = tmp_path / "orders.csv"
    p.write_text("order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n"
                 "1,1,prior,1,0,8,NaN\n2,1,prior,2,3,12,7.0\n3,1,train,3,3,18,\n")
    df = io.ingest_file(spark, str(p), "orders")
    assert [r.days_since_prior_order for r in df.orderBy("order_id").collect()] == [None, 7.0, None]


def test_stream_pairs_multi_batch_on_driver_data(spark):
    from trolley.plans.warehouse import Warehouse
    wh = Warehouse(spark, "/root/testdata/sf0.001")  # fresh checkpoints
    want = _rows(af.product_pairs(wh), "product_a_id", "product_b_id", "pair_order_count")
    got = _rows(inc.stream_pair_counts(wh, files_per_trigger=3), "product_a_id", "product_b_id", "pair_order_count")
    assert got == want


def test_bucketing_does_not_change_results(spark):
    from trolley.plans.warehouse import Warehouse
    sf = "/root/testdata/sf0.001"
    spark.conf.set("spark.trolley.bucketing", "false")
    try:
        plain = Warehouse(spark, sf)
    finally:
        spark.conf.set("spark.trolley.bucketing", "true")
    bucketed = Warehouse(spark, sf)
    assert bucketed.bucketing and not plain.bucketing
    for name in ("fact_order_items", "order_baskets", "dim_users", "dim_user", "fact_order"):
        a, b = getattr(plain, name), getattr(bucketed, name)
        assert sorted(a.collect()) == sorted(b.collect()), name
    def plan(df):
        return df.groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan(bucketed.raw("orders"))  # grouped straight off the buckets
    assert "Exchange hashpartitioning" in plan(plain.raw("orders"))


def test_quoted_product_names(spark, tmp_path):
    p = tmp_path / "products.csv"
    p.write_text('product_id,product_name,aisle_id,department_id\n'
                 '1,"Bag of ""Organic"" Lemons, 2 lb",24,4\n2,Plain Yogurt,120,16\n')
    rows = io.ingest_file(spark, str(p), "products").orderBy("product_id").collect()
    assert rows[0].product_name == 'Bag of "Organic" Lemons, 2 lb' and rows[0].aisle_id == 24
    assert rows[1].product_name == "Plain Yogurt"
