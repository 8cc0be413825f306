"""Answers on dirty, empty and growing inputs, and the caps that must not exist."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.frames import warehouse
from trolley.operators import metrics as m
from trolley.operators import profile as pr
from trolley.plans.warehouse import Warehouse
from trolley.sources import files as io
from trolley.streaming import incremental as inc


def _with_orphans(spark) -> Warehouse:
    base = warehouse(spark)
    raw = {t: base.raw(t) for t in io.RAW_TABLES}
    orphans = spark.createDataFrame([(999, 1, 1, 0), (999, 2, 2, 1)], raw["order_products_prior"].schema)
    raw["order_products_prior"] = raw["order_products_prior"].unionByName(orphans)
    return Warehouse(spark, "frames://orphans", raw=raw)


def test_items_without_an_order_keep_a_null_group(spark):
    wh = _with_orphans(spark)
    for fn, key in ((m.orders_by_dow_observed, "order_dow"), (m.basket_by_dow, "order_dow"), (m.basket_by_hour, "order_hour_of_day")):
        rows = {r[key]: r for r in fn(wh).collect()}
        assert rows[None].order_count == 1
        assert sum(r.order_count for r in rows.values()) == wh.order_baskets.count()
    assert {r.order_dow: r for r in m.basket_by_dow(wh).collect()}[None].avg_basket_size == 2.0


def test_extremes_are_sorted_by_their_measure(tiny):
    for df, key in ((m.top_products_order_gap(tiny), "avg_days_since_prior"), (m.order_gap_extremes(tiny, min_orders=1), "avg_days_since_prior"),
                    (m.reorder_rate_extremes(tiny, min_orders=1), "reorder_rate")):
        got = [r[key] for r in df.collect()]
        known = [x for x in got if x is not None]
        assert known == sorted(known) and got[len(known):] == [None] * (len(got) - len(known))


def test_malformed_cell_fails_the_typed_ingest(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text("order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n1,1,prior,xx,2,8,\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        io.ingest_typed(spark, str(path), "orders").collect()


def test_profiles_of_empty_tables(spark):
    base = warehouse(spark)
    wh = Warehouse(spark, "frames://empty", raw={t: base.raw(t).limit(0) for t in io.RAW_TABLES})
    assert all(r.missing_pct is None for r in pr.profile_missing(wh).collect())
    assert all(r.outlier_pct is None and r.outlier_count == 0 for r in pr.iqr_outliers(wh).collect())


def test_source_that_has_grown_is_reported(spark, tmp_path):
    from trolley.sources.schemas import SOURCE_FILES

    base = warehouse(spark)
    for t in io.RAW_TABLES:
        io.write_csv(base.raw(t), f"{tmp_path}/{SOURCE_FILES[t]}")
    wh = Warehouse.from_files(spark, str(tmp_path))
    assert {r.status for r in io.count_reconciliation(wh).collect()} == {"PASS"}
    extra = spark.createDataFrame([(77, 3, "prior", 1, 2, 5, None)], base.raw("orders").schema)
    io.write_csv(extra, f"{tmp_path}/{SOURCE_FILES['orders']}", mode="append")
    status = {r.table_name: r.status for r in io.count_reconciliation(wh).collect()}
    assert status.pop("orders") == "FAIL" and set(status.values()) == {"PASS"}


def test_bucket_count_follows_the_bytes(spark, tiny, monkeypatch):
    monkeypatch.setattr(Warehouse, "input_bytes", lambda self: 100 * 10 ** 12)
    assert tiny._bucket_count() == -(-100 * 10 ** 12 // (256 << 20)) > 370_000


def test_buckets_stay_small_enough_to_sort_in_memory(spark, tiny, monkeypatch):
    """At six times the larger tables (F5) a bucket still holds 16 MB of input, and the count is not the default parallelism."""
    for total in (800 << 20, 4800 << 20):
        monkeypatch.setattr(Warehouse, "input_bytes", lambda self, n=total: n)
        assert total / Warehouse(spark, "/none", raw={}).buckets <= 16 << 20


def test_failing_build_is_not_written_twice(spark):
    wh, calls = warehouse(spark), []

    def build():
        calls.append(1)
        return spark.range(3).select(F.col("id").alias("order_id"), F.raise_error(F.lit("broken row")).cast("int").alias("x"))

    with pytest.raises(Exception, match="broken row"):
        wh.materialise("broken", build, bucket_by="order_id")
    assert len(calls) == 1


def test_pair_universe_is_fixed_at_the_first_start(spark):
    wh = warehouse(spark)
    first = sorted(inc.stream_pair_counts(wh, k=2, files_per_trigger=2).collect())
    top = wh.spark.read.parquet(wh.path("stream", "pairs_top2"))
    before = sorted(top.collect())
    again = sorted(inc.stream_pair_counts(wh, k=2, files_per_trigger=2).collect())
    assert sorted(wh.spark.read.parquet(wh.path("stream", "pairs_top2")).collect()) == before and again == first


def test_copy_appends_only_new_keys(tiny):
    n = tiny.raw("orders").count()
    assert io.table_copy(tiny, "orders").count() == n
    assert io.table_copy(tiny, "orders").count() == n


def test_parameters_by_name(tiny):
    from trolley import catalog

    reg = catalog.registry()
    assert reg["top_products"].on(tiny, n=1).count() == 1
    assert reg["order_gap_extremes"].on(tiny).count() == 0  # the documented floor of 1,000
    assert reg["order_gap_extremes"].on(tiny, min_orders=1).count() > 0


def test_derived_orders_and_items(spark, tmp_path):
    """Orders without a date count in a user's sequence, those without a user are left out, copies of a line are one item."""
    from trolley.plans.warehouse import Warehouse
    day = lambda d: None if d is None else f"2024-01-{d:02d}"
    orders = [(1, 4, day(1)), (2, 4, day(3)), (3, 4, day(3)), (4, 5, None), (5, 5, day(2)), (6, None, day(2)), (7, 6, day(9)), (8, 7, day(5)), (8, 7, day(5)), (9, 7, day(6))]
    lines = [(1, 10, 1), (1, 11, 2), (2, 10, 2), (2, 12, 1), (2, 10, 2), (3, 11, 1), (3, 12, 2), (4, 10, 1), (5, 10, 1), (6, 10, 1), (8, 10, 1), (9, 10, 1), (9, 11, 2), (None, 10, 1), (1, None, 4)]
    parts = [(10, "A", "X"), (11, "A", "Y"), (12, "B", "X"), (13, None, "X")]  # products 2, 3, 4; a missing brand sorts first
    for name, rows, schema in (("orders", orders, "o_orderkey long, o_custkey long, o_orderdate string"), ("lineitem", lines, "l_orderkey long, l_partkey long, l_linenumber int"),
                               ("part", parts, "p_partkey long, p_brand string, p_type string")):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    wh = Warehouse(spark, str(tmp_path), root=str(tmp_path / "root"))
    got = [(r.order_id, r.user_id, r.eval_set, r.order_number, r.days_since_prior_order) for r in wh.raw("orders").collect()]
    # order 7 has no lines; the undated order 4 is first of user 5; order 8 is there twice
    assert sorted(got) == [(1, 4, "prior", 1, None), (2, 4, "prior", 2, 2.0), (3, 4, "train", 3, 0.0), (5, 5, "train", 2, None),
                           (8, 7, "prior", 1, None), (8, 7, "prior", 2, 0.0), (9, 7, "train", 3, 1.0)]
    for read in (wh.raw, wh.source):
        items = read("order_products_prior").unionByName(read("order_products_train"))
        flags = sorted((r.order_id, r.product_id, r.reordered) for r in items.collect())
        assert flags == [(1, 2, 0), (1, 3, 0), (2, 2, 1), (2, 4, 0), (3, 3, 1), (3, 4, 1), (5, 2, 0), (8, 2, 0), (8, 2, 1), (9, 2, 1), (9, 3, 0)]
    assert sorted((r.order_id, r.product_id, r.add_to_cart_order) for r in wh.raw("order_products_prior").collect() if r.order_id == 2) == [(2, 2, 2), (2, 4, 1)]
    wh.close()
