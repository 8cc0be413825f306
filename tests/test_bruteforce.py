"""Spark jobs vs brute-force Python on random small baskets (hypothesis)."""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.frames import warehouse
from trolley.operators import affinity as af


@st.composite
def baskets(draw):
    n_orders = draw(st.integers(2, 12))
    orders, prior, train = [], [], []
    for oid in range(1, n_orders + 1):
        user = draw(st.integers(1, 3))
        # every order except the last of a user is prior; keep it simple: alternate by id
        eval_set = "train" if oid % 5 == 0 else "prior"
        num = oid  # distinct per user ordering is irrelevant to the checked measures
        orders.append((oid, user, eval_set, num, oid % 7, oid % 24, None if num == 1 else float(oid % 31)))
        prods = draw(st.lists(st.integers(1, 6), min_size=1, max_size=5))  # repeats allowed
        rows = [(oid, p, pos + 1, draw(st.integers(0, 1))) for pos, p in enumerate(prods)]
        (train if eval_set == "train" else prior).extend(rows)
    return orders, prior, train


PRODUCTS = [(i, f"P{i}", 1 + i % 2, 1 + i % 2) for i in range(1, 7)]


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=baskets(), k=st.sampled_from([2, 3, 6]))
def test_pairs_match_combinations(spark, data, k):
    orders, prior, train = data
    wh = warehouse(spark, orders=orders, order_products_prior=prior, order_products_train=train, products=PRODUCTS)
    items = pd.DataFrame(prior + train, columns=["order_id", "product_id", "pos", "reordered"])
    counts = items.groupby("product_id").size().reset_index(name="n")
    top = set(counts.sort_values(["n", "product_id"], ascending=[False, True]).head(k)["product_id"])
    want = Counter()
    for _, g in items[items.product_id.isin(top)].groupby("order_id"):
        want.update(combinations(sorted(set(g.product_id)), 2))
    got = {(r.product_a_id, r.product_b_id): r.pair_order_count for r in af.product_pairs(wh, k).collect()}
    assert got == dict(want)


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=baskets())
def test_basket_and_customer_measures(spark, data):
    orders, prior, train = data
    wh = warehouse(spark, orders=orders, order_products_prior=prior, order_products_train=train, products=PRODUCTS)
    items = pd.DataFrame(prior + train, columns=["order_id", "product_id", "pos", "reordered"])
    o = pd.DataFrame(orders, columns=["order_id", "user_id", "eval_set", "n", "dow", "hour", "gap"])
    per_order = items.groupby("order_id").agg(basket_size=("product_id", "size"), reord=("reordered", "sum"))
    got = {r.order_id: (r.basket_size, r.reordered_item_count) for r in wh.order_baskets.collect()}
    assert got == {i: (int(r.basket_size), int(r.reord)) for i, r in per_order.iterrows()}
    merged = items.merge(o[["order_id", "user_id"]], on="order_id")
    uniq = merged.groupby("user_id").product_id.nunique().to_dict()
    got_u = {r.user_id: r.unique_products_purchased for r in wh.dim_user.collect()}
    assert {u: v for u, v in got_u.items() if v is not None} == uniq
