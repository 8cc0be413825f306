"""Operator semantics on hand-made frames (FIXTURES section 4)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.frames import ORDERS, warehouse
from trolley.functions.columns import day_part
from trolley.operators import affinity as af
from trolley.operators import metrics as m
from trolley.plans import staging as st
from trolley.sources import files as io


def _map(df, key, val):
    return {r[key]: r[val] for r in df.collect()}


def test_day_part_edges(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 23, 24, -1, None]
    df = spark.createDataFrame([(h,) for h in hours], "h int").select("h", day_part("h").alias("p"))
    got = _map(df, "h", "p")
    assert got == {0: "Night", 5: "Night", 6: "Morning", 11: "Morning", 12: "Afternoon", 17: "Afternoon",
                   18: "Evening", 23: "Evening", 24: None, -1: None, None: None}


def test_order_baskets_and_test_orders(tiny):
    fo = {r.order_id: r for r in tiny.fact_order.collect()}
    assert fo[1].basket_size == 2 and fo[1].reordered_item_count == 0
    assert fo[3].basket_size == 2 and fo[3].reorder_rate == 1.0
    assert fo[5].basket_size is None and fo[5].reorder_rate is None  # test order: no basket
    assert sum(r.basket_size or 0 for r in fo.values()) == 7  # = item rows


def test_dim_user_features(tiny):
    u = {r.user_id: r for r in tiny.dim_user.collect()}
    assert u[1].total_orders == 3 and u[1].average_days_between_orders == 8.5
    assert u[1].total_items == 6 and u[1].total_reordered_items == 3 and u[1].unique_products_purchased == 3
    assert u[1].customer_reorder_rate == 0.5 and u[1].customer_reorder_percentage == 50.0
    assert u[2].total_orders == 2 and u[2].average_basket_size == 1.0 and u[2].customer_reorder_rate == 0.0


def test_dim_users_counts_observed_items_only(tiny):
    u = {r.user_id: r for r in tiny.dim_users.collect()}
    assert (u[1].observed_order_count, u[1].observed_item_count, u[1].reordered_item_count) == (3, 6, 3)
    assert (u[2].observed_order_count, u[2].observed_item_count) == (1, 1)


def test_segments_median_split_and_null_rate(spark):
    wh = warehouse(spark, orders=ORDERS + [(6, 3, "test", 1, 2, 5, None)])
    seg = _map(wh.dim_user_segmented, "user_id", "customer_segment")
    # medians: orders [3, 2, 1] -> 2; rates [0.5, 0.0] -> 0.25
    assert seg[1] == "Frequent Repeat Customers"
    assert seg[2] == "Frequent Variety Customers"  # 2 orders >= median 2, rate 0.0 < 0.25
    assert seg[3] == "Occasional Variety Customers"  # NULL rate falls to the default
    assert 3 not in _map(wh.dim_users, "user_id", "observed_order_count")


def test_user_at_both_medians_is_frequent_repeat(spark):
    users = spark.createDataFrame([(1, 2, 0.5), (2, 2, 0.5), (3, 1, 0.1), (4, 3, 0.9)],
                                  "user_id long, total_orders long, customer_reorder_rate double")
    from trolley.plans.features import dim_user_segmented
    seg = _map(dim_user_segmented(users), "user_id", "customer_segment")
    assert seg[1] == seg[2] == "Frequent Repeat Customers"  # medians are 2 and 0.5, '>=' applies


def test_pairs_once_per_order(tiny):
    pairs = {(r.product_a_id, r.product_b_id): r.pair_order_count for r in af.product_pairs(tiny).collect()}
    assert pairs == {(1, 2): 2, (1, 3): 1}


def test_repeated_item_counted_once(spark):
    wh = warehouse(spark, order_products_prior=[(1, 1, 1, 0), (1, 1, 2, 0), (1, 2, 3, 0), (2, 1, 1, 1),
                                                (2, 3, 2, 0), (4, 3, 1, 0)])
    pairs = {(r.product_a_id, r.product_b_id): r.pair_order_count for r in af.product_pairs(wh).collect()}
    assert pairs[(1, 2)] == 2 and pairs[(1, 3)] == 1


def test_association_rules_values(tiny):
    r = {(x.product_a_id, x.product_b_id): x for x in af.association_rules(tiny).collect()}[(1, 2)]
    # 4 orders with items; product 1 in 3 orders, product 2 in 2
    assert r.support == 2 / 4 and r.confidence_ab == 2 / 3 and r.confidence_ba == 1.0
    assert r.lift == pytest.approx(2 * 4 / (3 * 2))


def test_pair_matrix_symmetric_zero_diagonal(tiny):
    rows = af.pair_matrix(tiny, n=3).collect()
    mat = [[r[f"p{j}"] for j in range(1, 4)] for r in rows]
    for i in range(3):
        assert mat[i][i] == 0
        for j in range(3):
            assert mat[i][j] == mat[j][i]


def test_top_k_ties_break_by_id(spark):
    prior = [(1, 1, 1, 0), (1, 2, 2, 0), (2, 3, 1, 0), (4, 1, 1, 0), (4, 2, 2, 0), (4, 3, 3, 0)]
    wh = warehouse(spark, order_products_prior=prior, order_products_train=[])
    top = [r.product_id for r in m.top_products(wh, n=2).collect()]
    assert top == [1, 2]  # all three products have 2 purchases: the smaller ids win


def test_peak_dow_tie_smaller_code(spark):
    orders = [(1, 1, "prior", 1, 4, 8, None), (2, 1, "prior", 2, 2, 9, 1.0), (3, 1, "train", 3, 5, 9, 1.0),
              (4, 2, "prior", 1, 6, 9, None), (5, 2, "test", 2, 1, 0, 3.0)]
    prior = [(1, 1, 1, 0), (2, 1, 1, 1), (4, 3, 1, 0)]
    wh = warehouse(spark, orders=orders, order_products_prior=prior, order_products_train=[(3, 3, 1, 0)])
    peak = _map(m.peak_dow_by_department(wh), "department_name", "peak_order_dow_code")
    assert peak["produce"] == 2  # dow 2 and 4 tie at one item each
    assert peak["dairy eggs"] == 5


def test_dept_dow_share_fills_zero_and_sums_100(tiny):
    for r in m.dept_dow_share(tiny).collect():
        cells = [r[f"d{d}"] for d in range(7)]
        assert sum(cells) == pytest.approx(100.0)
        assert all(c is not None for c in cells)


def test_heatmap_total_equals_orders(tiny):
    rows = m.day_hour_heatmap(tiny).collect()
    assert sum(r[f"h{h}"] for r in rows for h in range(24)) == len(ORDERS)


def test_department_share_has_root(tiny):
    got = _map(m.department_share(tiny), "department", "purchase_percentage")
    assert got["All Departments"] == 100.0
    assert got["produce"] + got["dairy eggs"] == pytest.approx(100.0)


def test_lenient_and_strict_casts(spark):
    df = spark.createDataFrame([("",), ("NaN",), ("abc",), ("3.0",)], "x string")
    vals = [r.x for r in st.coerce_lenient(df, "x").collect()]
    assert vals == [None, None, None, 3.0]
    with pytest.raises(Exception, match="cannot convert"):
        st.coerce_strict(df, "x", "bigint").collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="cannot convert"):
            st.coerce_strict(df, "x", "double").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    ok = spark.createDataFrame([("1",), (None,), ("3",)], "x string")
    assert [r.x for r in st.coerce_strict(ok, "x", "bigint").collect()] == [1, None, 3]


def test_segment_invariant_on_driver_data(spark):
    from trolley.plans.warehouse import Warehouse
    wh = Warehouse.get(spark, "/root/testdata/sf0.001")
    total = sum(r.customer_count for r in m.segment_summary(wh).collect())
    assert total == wh.dim_user.count()
    assert sum(r.order_count for r in m.basket_distribution(wh).collect()) == wh.order_baskets.count()


def test_ntz_dates_are_used(spark):
    wh = warehouse(spark)
    assert wh.stg_orders.filter(F.col("order_dow") > 6).count() == 0


def test_department_products_bound_parameter(tiny):
    rows = m.department_products(tiny, department="dairy eggs", n=5).collect()
    assert {r.department_name for r in rows} == {"dairy eggs"}
    assert m.department_products(tiny, department="it's nowhere").count() == 0  # quote-safe


def test_optional_in_list_filter(tiny):
    assert {r.department_name for r in m.dept_dow_share(tiny, ["produce"]).collect()} == {"produce"}
    assert {r.department_name for r in m.dept_dow_share(tiny).collect()} == {"produce", "dairy eggs"}


def test_join_guards(spark):
    """A repeated key fails the guarded marts themselves; opened unguarded they are built, so that it can be reported."""
    from tests.frames import AISLES
    from trolley.plans.warehouse import Warehouse
    loose = warehouse(spark, aisles=AISLES + [(2, "yogurt2")], orders=ORDERS + [ORDERS[0]])
    raw = {t: loose.raw(t) for t in io.RAW_TABLES}
    strict = Warehouse(spark, "frames://twice", raw=raw)
    with pytest.raises(Exception, match=r"aisles: key \('aisle_id',\) is not unique: 2"):
        strict.dim_product.collect()
    with pytest.raises(Exception, match=r"orders: key \('order_id',\) is not unique: 1"):
        strict.order_features.collect()
    assert loose.dim_product.count() == 4 and loose.order_features.count() == 5
    ok = warehouse(spark)
    assert ok.guarded and ok.order_features.count() == 4 and ok.dim_product.count() == 3


def test_guard_needs_no_exchange_on_buckets(spark):
    from trolley.functions.joins import guarded
    from trolley.plans.warehouse import Warehouse
    wh = Warehouse.get(spark, "/root/testdata/sf0.001")
    plan = guarded(wh.stg_orders, ["order_id"], "orders")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_itemsets_of_three_equal_brute_force(spark):
    import itertools
    import random
    r = random.Random(4)
    prior = [(o, p, i + 1, 0) for o in (1, 2, 4) for i, p in enumerate(r.sample(range(1, 9), 6))] + [(1, 1, 9, 0)]
    more = [(100 + o, 1, "prior", 1, 0, 8, None) for o in range(40)]
    prior += [(100 + o, p, i + 1, 0) for o in range(40) for i, p in enumerate(r.sample(range(1, 9), r.randrange(1, 7)))]
    wh = warehouse(spark, orders=ORDERS + more, order_products_prior=prior, products=[(i, f"p{i}", 1, 1) for i in range(1, 9)])
    baskets = {}
    for o, p, _, _ in prior + [(3, 1, 1, 1), (3, 2, 2, 1)]:
        baskets.setdefault(o, set()).add(p)
    n = len(baskets)
    of = lambda *s: sum(set(s) <= b for b in baskets.values())
    for floor in (1, 5, 9):
        want = {(a, b, c): (of(a, b, c), of(a, b, c) / n, of(a, b, c) / of(a, b), of(a, b, c) * n * n / (of(a) * of(b) * of(c)))
                for a, b, c in itertools.combinations(range(1, 9), 3) if of(a, b, c) >= floor}
        got = {(x.product_a_id, x.product_b_id, x.product_c_id): (x.order_count, x.support, x.confidence, x.lift)
               for x in af.itemset_triples(wh, min_orders=floor).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert af.itemset_triples(wh, min_support=1.0).count() == 0


def test_changed_source_rebuilds_what_depends_on_it(spark, tiny, tmp_path):
    from trolley.plans.warehouse import Warehouse
    from trolley.sources.schemas import SOURCE_FILES
    for t, name in SOURCE_FILES.items():
        io.write_csv(tiny.raw(t), str(tmp_path / name))
    wh = Warehouse.from_files(spark, str(tmp_path))
    wh.build_all(["dim_product", "order_baskets", "fact_order"])
    assert wh.refresh() == []
    before = dict(wh._tables)
    more = spark.createDataFrame([(4, "Kiwi", 1, 1)], tiny.raw("products").schema)
    io.write_csv(more, str(tmp_path / "products.csv"), mode="append")
    assert wh.refresh() == ["dim_product", "products"]  # and nothing that only reads orders or items
    assert wh.dim_product.count() == 4 and wh.rows("dim_product") == 4
    assert all(wh._tables[t] is before[t] for t in ("order_baskets", "fact_order", "orders", "items"))
    assert before["order_baskets"].count() == 4


def test_compressed_subset_export(tiny):
    counts = {r.table_name: r.row_count for r in io.export_user_subset(tiny, max_user_id=2,
                                                                        compression="gzip").collect()}
    assert counts["orders"] == 5


def test_two_products_with_one_name(spark):
    products = [(1, "Banana", 1, 1), (2, "Banana", 1, 1), (3, "Yogurt", 2, 2)]
    wh = warehouse(spark, products=products)
    by_name = _map(m.top_products_by_name(wh, n=10), "product_name", "item_count")
    by_id = _map(m.top_products(wh, n=10), "product_id", "purchase_count")
    assert by_name["Banana"] == by_id[1] + by_id[2]  # name grain merges the two ids
    assert set(by_id) == {1, 2, 3}


def test_segment_thresholds_exact_and_approx(spark):
    from trolley.plans.features import dim_user_segmented, segment_thresholds
    from trolley.plans.warehouse import Warehouse
    wh = Warehouse.get(spark, "/root/testdata/sf0.001")
    exact = segment_thresholds(wh.dim_user).first()
    approx = segment_thresholds(wh.dim_user, approx=True).first()
    assert exact.order_threshold == 10.0  # FIXTURES: median orders per user at sf0.001
    assert abs(exact.reorder_threshold - 0.1606) < 1e-3
    # the approximate sketch returns an actual data value within its rank error
    assert abs(approx.order_threshold - exact.order_threshold) <= 1.0
    seg = dim_user_segmented(wh.dim_user, approx=True)
    assert seg.count() == wh.dim_user.count()
