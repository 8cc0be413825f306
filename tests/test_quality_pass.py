"""The report in few passes equals the report rule by rule, on dirty data too, and scans each large table twice at most."""

from __future__ import annotations

import re

from tests.frames import AISLES, DEPARTMENTS, ORDERS, PRIOR, PRODUCTS, TRAIN, warehouse
from trolley.operators import quality as dq
from trolley.plans.warehouse import Warehouse


def _dirty(spark):
    return warehouse(
        spark,
        aisles=AISLES + [(0, "bulk"), (2, "yogurt2"), (None, " ")],
        departments=DEPARTMENTS + [(2, "dairy eggs"), (9, None)],
        products=PRODUCTS + [(4, "Kiwi", 9, 1), (5, None, 1, 77), (None, "lost", None, 1)],
        orders=ORDERS + [ORDERS[0], (6, None, "x", 0, 7, 24, 31.0), (None, 3, "prior", 1, 1, 1, None), (7, 2, None, 2, 1, 1, None)],
        order_products_prior=PRIOR + [PRIOR[0], (99, 1, 1, 0), (1, 99, 0, 2), (3, 3, 3, 0), (None, 1, 1, 0), (None, 1, 1, 0), (5, None, 1, None)],
        order_products_train=TRAIN + [(3, 77, 3, 0), (5, 1, 1, 5), (98, 78, -1, 1), (98, 78, 2, 1)])


def _report(df):
    return sorted((r.check_name, r.table_name, r.issue_count, r.status) for r in df.collect())


def test_passes_equal_single_rules(spark):
    wh = _dirty(spark)
    got, want = _report(dq.dq_report(wh)), _report(dq.report_by_rule(wh))
    assert got == want
    assert sum(r[3] == "FAIL" for r in got) > 25


def test_empty_tables_pass(spark):
    base = warehouse(spark)
    wh = Warehouse(spark, "frames://none", raw={t: base.raw(t).limit(0) for t in dq._RAW})
    assert _report(dq.dq_report(wh)) == _report(dq.report_by_rule(wh))


def test_two_scans_of_each_large_table(spark):
    wh = Warehouse.get(spark, "/root/testdata/sf0.001")
    df = dq.dq_report(wh)
    plan = df._jdf.queryExecution().optimizedPlan().toString()  # each Relation line is one scan
    scans = re.findall(r"Relation [^\n]*?\[([^\]]*)\]", plan)
    plain = [set(re.sub(r"#\d+L?", "", c).split(",")) for c in scans]
    assert sum({"eval_set", "order_dow"} <= c and "product_id" not in c for c in plain) <= 2
    assert sum({"product_id", "source_eval_set", "user_id"} <= c for c in plain) <= 2
    assert sum({"slot_key", "basket_size"} <= c for c in plain) <= 2
    assert sum({"product_id", "add_to_cart_order"} <= c and "user_id" not in c for c in plain) <= 4  # prior and train are two folders of it
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in physical and "CartesianProduct" not in physical
