"""Analytical query library (Q1-Q46): each function takes a Warehouse and parameters.

Plans reuse the narrowest materialised mart that answers the question:
order-grain questions read ``order_baskets`` / ``order_features`` /
``fact_order`` (one row per order) rather than re-shuffling items, and
item-grain questions aggregate ``fact_order_items`` with map-side partial
aggregation before joining the (size-checked, broadcast) dimensions.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from trolley.functions.columns import equal_width_bin, percent, safe_ratio
from trolley.functions.joins import small
from trolley.functions.quantiles import exact_median, exact_quantile
from trolley.functions.ranking import top_k, top_n_per_group, two_sided
from trolley.plans.warehouse import Warehouse

# --------------------------------------------------------------------------- helpers


def _departments(wh: Warehouse) -> DataFrame:
    return small(wh.dim_departments, wh.rows("dim_departments"))


def _products(wh: Warehouse) -> DataFrame:
    return small(wh.dim_products, wh.rows("dim_products"))


def _slots(wh: Warehouse) -> DataFrame:
    return small(wh.dim_order_slot, wh.rows("dim_order_slot"))  # 7 x 24 rows for valid codes; checked


def _orders_with_time(wh: Warehouse) -> DataFrame:
    """fact_order LEFT JOIN dim_order_slot on slot_key."""
    return wh.fact_order.join(_slots(wh), "slot_key", "left")


def _summary(df: DataFrame, c: str) -> DataFrame:
    """n, mean, median, min, max of one measure (NULLs skipped, as ``dropna``); exact distributed median."""
    x = F.col(c)
    moments = df.filter(x.isNotNull()).agg(
        F.count(x).alias("n"),
        F.avg(x).cast("double").alias("mean"),
        F.min(x).cast("double").alias("min"),
        F.max(x).cast("double").alias("max"),
    )
    return moments.select("n", "mean", exact_median(df, c).scalar().alias("median"), "min", "max")


def _cube_by(wh: Warehouse, *keys: str) -> DataFrame:
    """Re-aggregate the (product, department, dow) item cube to ``keys`` (sums of additive measures)."""
    return wh.item_cube.groupBy(*keys).agg(
        F.sum("item_count").cast("bigint").alias("item_count"),
        F.sum("reorder_count").cast("bigint").alias("reorder_count"),
        F.sum("reorder_n").cast("bigint").alias("reorder_n"),
        F.sum("atc_sum").cast("bigint").alias("atc_sum"),
        F.sum("atc_n").cast("bigint").alias("atc_n"),
        F.sum("gap_sum").alias("gap_sum"),
        F.sum("gap_n").cast("bigint").alias("gap_n"),
    )


def _dept_items(wh: Warehouse) -> DataFrame:
    """Items per department name: re-aggregated from the item cube, then the tiny join."""
    per_dept = _cube_by(wh, "department_id")
    joined = per_dept.join(_departments(wh), "department_id")
    # several department ids may share a name: re-combine by name
    return joined.groupBy("department_name").agg(
        F.sum("item_count").alias("item_count"),
        F.sum("reorder_count").cast("bigint").alias("reorder_count"),
        (F.sum("reorder_count") / F.sum("reorder_n")).alias("reorder_rate"),  # = avg(reordered)
        (F.sum("atc_sum") / F.sum("atc_n")).alias("avg_add_to_cart_order"),
        (F.sum("gap_sum") / F.sum("gap_n")).alias("avg_days_since_prior"),
    )


def product_name_stats(wh: Warehouse) -> DataFrame:
    """Per product *name* aggregate shared by Q29, Q31-Q34 (materialised once)."""
    def build() -> DataFrame:
        per_id = _cube_by(wh, "product_id")
        return per_id.join(_products(wh), "product_id").groupBy("product_name").agg(
            F.sum("item_count").alias("item_count"),
            F.sum("reorder_count").cast("bigint").alias("reorder_count"),
            (F.sum("reorder_count") / F.sum("reorder_n")).alias("reorder_rate"),  # = avg(reordered)
            (F.sum("atc_sum") / F.sum("atc_n")).alias("avg_add_to_cart_order"),
            (F.sum("gap_sum") / F.sum("gap_n")).alias("avg_days_since_prior"),
        )
    return wh.materialise("product_name_stats", build)


# --------------------------------------------------------------------------- KPIs


def kpis_observed(wh: Warehouse) -> DataFrame:
    """Q1: orders with items, items, average basket, item-weighted reorder rate."""
    b = wh.order_baskets
    return b.agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("basket_size").cast("bigint").alias("n_items"),
        F.avg("basket_size").alias("avg_basket_size"),
        safe_ratio(F.sum("reordered_item_count"), F.sum("basket_size")).alias("reorder_rate"),
    )


def kpis_all(wh: Warehouse) -> DataFrame:
    """Q2: published KPI row; the customer-rate average is the mean of customer rates."""
    # fact_order is 1:1 with the orders table (left joins on unique keys), so its distinct order ids are
    # counted on the order_id-bucketed orders: the distinct aggregate needs no exchange there
    orders = wh.fact_order.agg(F.avg("basket_size").alias("average_basket_size")).select(
        wh.dim_orders.agg(F.count_distinct("order_id")).scalar().alias("total_orders"), "average_basket_size")
    users = wh.dim_user.agg(
        F.count_distinct("user_id").alias("total_customers"),
        F.round(F.avg("customer_reorder_rate"), 6).alias("average_customer_reorder_rate"),
        F.round(F.avg("average_days_between_orders"), 6).alias("average_days_between_orders"),
    )
    products = wh.dim_product.agg(F.count_distinct("product_id").alias("total_products"))
    # three one-row aggregates combined as scalar subqueries
    return orders.select(
        "total_orders", users.select("total_customers").scalar().alias("total_customers"),
        products.scalar().alias("total_products"), "average_basket_size",
        users.select("average_customer_reorder_rate").scalar().alias("average_customer_reorder_rate"),
        users.select("average_days_between_orders").scalar().alias("average_days_between_orders"))


def fact_summary(wh: Warehouse) -> DataFrame:
    """Q3: rows, distinct orders, distinct products, reorder rate of fact_order_items.

    Exact re-aggregations of small marts instead of two distinct aggregates (an Expand) over the item
    fact: rows and reorders from the item cube, distinct products from its product keys, distinct orders
    = non-null order keys of ``order_baskets`` (one row per order with items).
    """
    cube = wh.item_cube
    return cube.agg(
        F.sum("item_count").cast("bigint").alias("n_rows"),
        F.count_distinct("product_id").alias("n_products"),
        (F.sum("reorder_count") / F.sum("reorder_n")).alias("reorder_rate"),
    ).select("n_rows", wh.order_baskets.agg(F.count("order_id")).scalar().alias("n_orders"), "n_products",
             "reorder_rate")


# --------------------------------------------------------------------------- order timing


def orders_by_dow_raw(wh: Warehouse) -> DataFrame:
    """Q4: all orders per dow straight from the raw table."""
    return wh.raw("orders").groupBy("order_dow").agg(F.count(F.lit(1)).alias("order_count")).orderBy("order_dow")


def orders_by_dow_observed(wh: Warehouse) -> DataFrame:
    """Q5: distinct orders with items per dow (order grain already: no distinct needed)."""
    return _baskets_with_time(wh).groupBy("order_dow").agg(F.count("order_id").alias("order_count")).orderBy("order_dow")


def _baskets_with_time(wh: Warehouse) -> DataFrame:
    """Orders that have items, with their time; items whose order is missing keep a NULL time."""
    return wh.order_baskets.join(wh.stg_orders.select("order_id", "order_dow", "order_hour_of_day"), "order_id", "left")


def orders_by_dow(wh: Warehouse) -> DataFrame:
    """Q6: orders per dow through the slot dimension."""
    return _orders_with_time(wh).groupBy("order_dow").agg(F.count("order_id").alias("order_count")).orderBy("order_dow")


def orders_by_hour(wh: Warehouse) -> DataFrame:
    """Q7: orders per hour through the slot dimension."""
    return (_orders_with_time(wh).groupBy("order_hour_of_day").agg(F.count("order_id").alias("order_count"))
            .orderBy("order_hour_of_day"))


def order_time(wh: Warehouse) -> DataFrame:
    """Q9: long form (dow, hour, order_count)."""
    return (_orders_with_time(wh).groupBy("order_dow", "order_hour_of_day")
            .agg(F.count("order_id").alias("order_count")).orderBy("order_dow", "order_hour_of_day"))


def day_hour_heatmap(wh: Warehouse) -> DataFrame:
    """Q8: dow x 24 hour columns h0..h23, missing cells 0 (explicit pivot values: no extra pass)."""
    t = _orders_with_time(wh)
    piv = t.groupBy("order_dow").pivot("order_hour_of_day", list(range(24))).agg(F.count("order_id"))
    return piv.select("order_dow", *[F.coalesce(F.col(str(h)), F.lit(0)).cast("bigint").alias(f"h{h}")
                                     for h in range(24)]).orderBy("order_dow")


def peak_day(wh: Warehouse) -> DataFrame:
    """Q10: the dow with most orders (first, i.e. smallest dow, on ties)."""
    return top_k(orders_by_dow(wh), 1, F.col("order_count").desc(), F.col("order_dow").asc())


def peak_hour(wh: Warehouse) -> DataFrame:
    return top_k(orders_by_hour(wh), 1, F.col("order_count").desc(), F.col("order_hour_of_day").asc())


def peak_slot(wh: Warehouse) -> DataFrame:
    """Q11: busiest (dow, hour)."""
    return top_k(order_time(wh), 1, F.col("order_count").desc(), F.col("order_dow").asc(),
                 F.col("order_hour_of_day").asc())


def orders_by_dow_daypart(wh: Warehouse) -> DataFrame:
    """Q12: orders per dow x day part."""
    return (_orders_with_time(wh).groupBy("order_dow", "day_part").agg(F.count("order_id").alias("order_count"))
            .orderBy("order_dow", "day_part"))


# --------------------------------------------------------------------------- baskets


def basket_stats(wh: Warehouse) -> DataFrame:
    """Q13: distribution summary of basket size over orders with items, with deviation and quartiles.

    Basket sizes are few (at most the catalogue's size), so they are grouped first: mean, deviation and
    quantiles come from the counts by size."""
    sizes = wh.fact_order.filter(F.col("basket_size").isNotNull())
    q = [exact_quantile(sizes, "basket_size", p).scalar().alias(a) for p, a in ((0.25, "q25"), (0.5, "median"), (0.75, "q75"))]
    by_size = sizes.groupBy("basket_size").agg(F.count(F.lit(1)).alias("k"))
    n, s1 = F.sum("k"), F.sum(F.col("k") * F.col("basket_size"))
    s2 = F.sum(F.col("k") * F.col("basket_size") * F.col("basket_size"))
    moments = by_size.agg(n.cast("bigint").alias("n"), s1.cast("bigint").alias("s1"), s2.cast("bigint").alias("s2"),
                          F.min("basket_size").cast("double").alias("min"), F.max("basket_size").cast("double").alias("max"))
    d = lambda c: F.col(c).cast("double")
    spread = (F.col("n").cast("decimal(38,0)") * F.col("s2") - F.col("s1").cast("decimal(19,0)") * F.col("s1").cast("decimal(19,0)")).cast("double")
    return moments.select("n", safe_ratio(d("s1"), d("n")).alias("mean"), F.round(F.sqrt(safe_ratio(spread, d("n") * (d("n") - 1))), 9).alias("std"),
                          "min", *q, "max")


def basket_histogram(wh: Warehouse, bins: int = 50) -> DataFrame:
    """Equal-width histogram of basket size over [min, max] (top edge in the last bin); empty bins are left out."""
    f = wh.fact_order.filter(F.col("basket_size").isNotNull())
    x = F.col("basket_size").cast("double")
    lo, hi = f.agg(F.min(x)).scalar(), f.agg(F.max(x)).scalar()
    counts = f.select(equal_width_bin(x, lo, hi, bins).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("order_count"))
    return counts.orderBy("bin")


def basket_distribution(wh: Warehouse) -> DataFrame:
    """Q14: orders per basket size."""
    f = wh.fact_order.filter(F.col("basket_size").isNotNull())
    return f.groupBy("basket_size").agg(F.count(F.lit(1)).alias("order_count")).orderBy("basket_size")


# Basket bins of width 3 with an open last bin (1-3 ... 25-27, 28-30+).
BASKET_BIN_WIDTH = 3
BASKET_BINS = 10


def basket_bins(wh: Warehouse, width: int = BASKET_BIN_WIDTH, bins: int = BASKET_BINS) -> DataFrame:
    """Q15: orders per 3-wide basket bin; the last bin is open-ended."""
    size = F.col("basket_size")
    f = wh.fact_order.filter(size.isNotNull() & (size >= 1))
    counts = f.groupBy(F.least(F.floor((size - 1) / width), F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("order_count"))
    b = F.col("bin")
    span = F.concat((b * width + 1).cast("string"), F.lit("-"), (b * width + width).cast("string"))
    label = F.when(b == bins - 1, F.concat(span, F.lit("+"))).otherwise(span)
    return counts.select("bin", label.alias("label"), "order_count").orderBy("bin")


def basket_by_dow(wh: Warehouse) -> DataFrame:
    """Q16: average basket and orders per dow (order grain mart, no item shuffle)."""
    return (_baskets_with_time(wh).groupBy("order_dow")
            .agg(F.avg("basket_size").alias("avg_basket_size"), F.count(F.lit(1)).alias("order_count"))
            .orderBy("order_dow"))


def basket_by_hour(wh: Warehouse) -> DataFrame:
    """Q17: average basket and orders per hour."""
    return (_baskets_with_time(wh).groupBy("order_hour_of_day")
            .agg(F.avg("basket_size").alias("avg_basket_size"), F.count(F.lit(1)).alias("order_count"))
            .orderBy("order_hour_of_day"))


def basket_most_common(wh: Warehouse) -> DataFrame:
    """Q18: modal basket size (smallest size on ties)."""
    return top_k(basket_distribution(wh), 1, F.col("order_count").desc(), F.col("basket_size").asc())


# --------------------------------------------------------------------------- departments


def department_counts(wh: Warehouse) -> DataFrame:
    """Q19: items and reorders per department, most items first."""
    return (_dept_items(wh).select("department_name", "item_count", "reorder_count")
            .orderBy(F.col("item_count").desc(), "department_name"))


def departments_by_reorder(wh: Warehouse) -> DataFrame:
    """Q20: Q19 ordered by reorders."""
    return (_dept_items(wh).select("department_name", "item_count", "reorder_count")
            .orderBy(F.col("reorder_count").desc(), "department_name"))


def department_summary(wh: Warehouse) -> DataFrame:
    """Q21: items and item-weighted reorder rate per department."""
    return (_dept_items(wh).select("department_name", "item_count", "reorder_rate")
            .orderBy(F.col("item_count").desc(), "department_name"))


def top_departments(wh: Warehouse, n: int = 10) -> DataFrame:
    """Q22: the n departments with most items."""
    return top_k(_dept_items(wh).select("department_name", "item_count", "reorder_count"), n,
                 F.col("item_count").desc(), F.col("department_name").asc())


ROOT_LABEL = "All Departments"


def department_share(wh: Warehouse) -> DataFrame:
    """Q23: purchases and % of all purchases per department, plus the root total row (rollup)."""
    pm = wh.product_metrics
    r = pm.rollup("department").agg(F.sum("purchase_count").alias("purchase_count"),
                                    F.grouping_id().alias("_g"))
    total = F.sum(F.when(F.col("_g") == 1, F.col("purchase_count"))).over(Window.partitionBy())  # <= #depts + 1 rows
    return r.select(
        F.when(F.col("_g") == 1, F.lit(ROOT_LABEL)).otherwise(F.col("department")).alias("department"),
        F.col("purchase_count").cast("bigint").alias("purchase_count"),
        (F.col("purchase_count") / total * 100.0).alias("purchase_percentage"),
    ).orderBy(F.col("purchase_count").desc(), "department")


def aisle_demand(wh: Warehouse) -> DataFrame:
    """Q24: purchases, share of purchases and reorder rate per aisle."""
    pm = wh.product_metrics
    a = pm.groupBy("aisle_id", "aisle").agg(
        F.sum("purchase_count").cast("bigint").alias("purchase_count"),
        F.sum("reordered_count").cast("bigint").alias("reordered_count"),
    )
    total = F.sum("purchase_count").over(Window.partitionBy())  # over the aisle aggregate only
    return a.select(
        "aisle_id", "aisle", "purchase_count", "reordered_count",
        (F.col("reordered_count") / F.col("purchase_count")).alias("reorder_rate"),
        (F.col("purchase_count") / total * 100.0).alias("purchase_percentage"),
    ).orderBy(F.col("purchase_count").desc(), "aisle_id")


def dept_dow_counts(wh: Warehouse, departments: Iterable[str] = ()) -> DataFrame:
    """Q25: items per department x dow; optional department IN-list (empty = all), pushed below the join."""
    per = _cube_by(wh, "department_id", "order_dow").select("department_id", "order_dow", "item_count")
    d = wh.dim_departments
    deps = list(departments)
    if deps:
        d = d.filter(F.col("department_name").isin(deps))
    j = per.join(small(d, wh.rows("dim_departments")), "department_id")
    return j.groupBy("department_name", "order_dow").agg(F.sum("item_count").cast("bigint").alias("item_count"))


def dept_dow_share(wh: Warehouse, departments: Iterable[str] = ()) -> DataFrame:
    """Q26: per department, % of its items on each dow code d0..d6 (row sums 100), biggest first."""
    c = dept_dow_counts(wh, departments)
    piv = c.groupBy("department_name").pivot("order_dow", list(range(7))).agg(F.sum("item_count"))
    cells = [F.coalesce(F.col(str(d)), F.lit(0)) for d in range(7)]
    total = sum(cells[1:], cells[0])
    return piv.select("department_name", *[(safe_ratio(cells[d], total) * 100.0).alias(f"d{d}") for d in range(7)],
                      total.alias("_total")).orderBy(F.col("_total").desc(), "department_name").drop("_total")


def peak_dow_by_department(wh: Warehouse) -> DataFrame:
    """Q27: each department's busiest dow code (smallest code on ties)."""
    c = dept_dow_counts(wh)
    w = Window.partitionBy("department_name").orderBy(F.col("item_count").desc(), F.col("order_dow").asc())
    return (c.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
            .select("department_name", F.col("order_dow").alias("peak_order_dow_code")).orderBy("department_name"))


def dept_cart_position(wh: Warehouse) -> DataFrame:
    """Q28: average cart position per department, labelled against the median of department averages."""
    d = _dept_items(wh).select("department_name", "avg_add_to_cart_order", "item_count")
    med = d.agg(F.median("avg_add_to_cart_order")).scalar()  # over <= #departments rows
    return (d.withColumn("group", F.when(F.col("avg_add_to_cart_order") <= med, F.lit("Added earlier"))
                         .otherwise(F.lit("Added later")))
            .orderBy("avg_add_to_cart_order", "department_name"))


def dept_order_gap(wh: Warehouse) -> DataFrame:
    """Q30: item-weighted average order gap per department, shortest first."""
    return (_dept_items(wh).select("department_name", "avg_days_since_prior", "item_count")
            .orderBy(F.col("avg_days_since_prior").asc_nulls_last(), "department_name"))


# --------------------------------------------------------------------------- products (by name)


def product_cart_position_extremes(wh: Warehouse, n: int = 10) -> DataFrame:
    """Q29: n earliest and n latest product names by average cart position."""
    s = product_name_stats(wh).select("product_name", "avg_add_to_cart_order", "item_count")
    return two_sided(s, n, "avg_add_to_cart_order", "product_name", "Earliest", "Latest").orderBy(
        "avg_add_to_cart_order", "product_name", "group")


def top_products_order_gap(wh: Warehouse, n: int = 20) -> DataFrame:
    """Q31: the n most-ordered names with their average order gap, shortest gap first."""
    s = product_name_stats(wh).select("product_name", "item_count", "avg_days_since_prior")
    return top_k(s, n, F.col("item_count").desc(), F.col("product_name").asc()).orderBy(
        F.col("avg_days_since_prior").asc_nulls_last(), "product_name")


def order_gap_extremes(wh: Warehouse, n: int = 20, min_orders: int = 1000) -> DataFrame:
    """Q32: n shortest and n longest average gaps among names with >= min_orders items."""
    s = (product_name_stats(wh).filter(F.col("item_count") >= min_orders)
         .select("product_name", "item_count", "avg_days_since_prior"))
    return two_sided(s, n, "avg_days_since_prior", "product_name", "Shortest cycle", "Longest cycle").orderBy(
        F.col("avg_days_since_prior").asc_nulls_last(), "product_name", "group")


def reorder_rate_extremes(wh: Warehouse, n: int = 5, min_orders: int = 1000) -> DataFrame:
    """Q33: n most and n least re-bought names with >= min_orders items."""
    s = (product_name_stats(wh).filter(F.col("item_count") >= min_orders)
         .select("product_name", F.col("item_count").alias("total_count"), "reorder_count", "reorder_rate"))
    m = F.col("reorder_rate")
    hi = top_k(s, n, m.desc(), F.col("product_name").asc()).withColumn("group", F.lit("Most rebought"))
    lo = top_k(s, n, m.asc(), F.col("product_name").asc()).withColumn("group", F.lit("Least rebought"))
    return hi.unionByName(lo).withColumn("reorder_rate_pct", percent("reorder_rate")).orderBy(
        F.col("reorder_rate").asc_nulls_last(), "product_name", "group")


def top_products_by_name(wh: Warehouse, n: int = 20) -> DataFrame:
    """Q34: the n most-ordered product names with their reorder rate."""
    s = product_name_stats(wh).select("product_name", "item_count", "reorder_rate")
    return top_k(s, n, F.col("item_count").desc(), F.col("product_name").asc())


# --------------------------------------------------------------------------- products (by id)


def top_products(wh: Warehouse, n: int = 10) -> DataFrame:
    """Q35: the n most purchased product ids with department."""
    pm = wh.product_metrics.select("product_id", "product_name", "department", "purchase_count")
    return top_k(pm, n, F.col("purchase_count").desc(), F.col("product_id").asc())


def top_reordered_products(wh: Warehouse, n: int = 10, min_purchases: int = 1000) -> DataFrame:
    """Q36: highest reorder rates among products with >= min_purchases purchases."""
    pm = wh.product_metrics.filter(F.col("purchase_count") >= min_purchases).select(
        "product_id", "product_name", "department", "purchase_count", "reordered_count", "product_reorder_rate",
        percent("product_reorder_rate").alias("reorder_rate_percentage"))
    return top_k(pm, n, F.col("product_reorder_rate").desc(), F.col("product_id").asc())


def dashboard_product_metrics(wh: Warehouse) -> DataFrame:
    """Q45: the published seven-column product table."""
    return wh.product_metrics.select("product_id", "product_name", "aisle", "department", "purchase_count",
                                     "reordered_count", "product_reorder_rate")


def _dept_product_counts(wh: Warehouse, dept_filter: DataFrame | None) -> DataFrame:
    """(department_name, product_name) -> item/reorder counts; department filter applied as a semi join."""
    per = _cube_by(wh, "department_id", "product_id").select("department_id", "product_id", "item_count",
                                                             "reorder_count")
    d = wh.dim_departments
    if dept_filter is not None:
        d = d.join(F.broadcast(dept_filter), "department_name", "left_semi")  # filter is a top-n list
    j = per.join(small(d, wh.rows("dim_departments")), "department_id").join(_products(wh), "product_id")
    return j.groupBy("department_name", "product_name").agg(
        F.sum("item_count").cast("bigint").alias("item_count"),
        F.sum("reorder_count").cast("bigint").alias("reorder_count"))


def _rank_both(counts: DataFrame, n: int) -> DataFrame:
    by_items = top_n_per_group(counts, "department_name", n, F.col("item_count").desc(),
                               F.col("product_name").asc()).withColumn("ranking", F.lit("items"))
    by_reorders = top_n_per_group(counts, "department_name", n, F.col("reorder_count").desc(),
                                  F.col("product_name").asc()).withColumn("ranking", F.lit("reorders"))
    cols = ["department_name", "ranking", "rank", "product_name", "item_count", "reorder_count"]
    return by_items.select(*cols).unionByName(by_reorders.select(*cols))


def department_products(wh: Warehouse, department: str | None = None, n: int = 5) -> DataFrame:
    """Q37: top n products by items and by reorders in one department (default: the biggest)."""
    if department is None:
        chosen = top_k(_dept_items(wh).select("department_name", "item_count"), 1,
                       F.col("item_count").desc(), F.col("department_name").asc()).select("department_name")
    else:
        # bound named parameter, never string interpolation of the value (names may contain quotes)
        chosen = wh.spark.sql("SELECT department_name FROM {d} WHERE department_name = :dept",
                              args={"dept": department}, d=wh.dim_departments)
    return _rank_both(_dept_product_counts(wh, chosen), n).orderBy("ranking", "rank")


def top_products_in_top_departments(wh: Warehouse, n_departments: int = 5, n: int = 5) -> DataFrame:
    """Q38: top n products (by items and by reorders) in each of the top departments."""
    top = top_k(_dept_items(wh).select("department_name", "item_count"), n_departments,
                F.col("item_count").desc(), F.col("department_name").asc()).select("department_name")
    return _rank_both(_dept_product_counts(wh, top), n).orderBy("department_name", "ranking", "rank")


# --------------------------------------------------------------------------- customers


def customer_orders_stats(wh: Warehouse) -> DataFrame:
    """Q39."""
    return _summary(wh.dim_user, "total_orders")


def customer_gap_stats(wh: Warehouse) -> DataFrame:
    """Q40 (users with a single order have no gap and are dropped)."""
    s = _summary(wh.dim_user, "average_days_between_orders")
    return s.select("n", F.round("mean", 6).alias("mean"), "median", "min", "max")


def customer_reorder_stats(wh: Warehouse) -> DataFrame:
    """Q41."""
    s = _summary(wh.dim_user, "customer_reorder_rate")
    return s.select("n", F.round("mean", 6).alias("mean"), "median", "min", "max")


# Histogram bin counts per customer measure.
CUSTOMER_HISTOGRAM_BINS = (("total_orders", 40), ("average_days_between_orders", 30), ("customer_reorder_rate", 30))


def customer_histograms(wh: Warehouse, bins=CUSTOMER_HISTOGRAM_BINS) -> DataFrame:
    """Q42: fixed-width histograms over [min, max] of three customer measures (top edge in the last bin)."""
    u = wh.dim_user
    parts = []
    for measure, n in bins:
        x = F.col(measure).cast("double")
        lo, hi = u.agg(F.min(x)).scalar(), u.agg(F.max(x)).scalar()  # scalar subqueries
        b = u.filter(x.isNotNull()).select(
            equal_width_bin(x, lo, hi, n).alias("bin"), lo.alias("_lo"), hi.alias("_hi"))
        h = b.groupBy("bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
        width = (F.col("_hi") - F.col("_lo")) / n
        parts.append(h.select(
            F.lit(measure).alias("measure"), "bin",
            F.round(F.col("_lo") + F.col("bin") * width, 9).alias("lo"),
            F.round(F.col("_lo") + (F.col("bin") + 1) * width, 9).alias("hi"),
            "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("measure", "bin")


def segment_summary(wh: Warehouse) -> DataFrame:
    """Q43: customers and average behaviour per segment, with % of customers."""
    s = wh.dim_user_segmented.groupBy("customer_segment").agg(
        F.count("user_id").alias("customer_count"),
        F.round(F.avg("total_orders"), 6).alias("average_orders"),
        F.round(F.avg("customer_reorder_rate"), 6).alias("average_reorder_rate"),
        F.round(F.avg("average_basket_size"), 6).alias("average_basket_size"),
        F.round(F.avg("average_days_between_orders"), 6).alias("average_order_gap"),
    )
    total = F.sum("customer_count").over(Window.partitionBy())  # over <= 4 rows
    return s.withColumn("customer_percentage", F.round(F.col("customer_count") / total * 100.0, 6)) \
        .orderBy("customer_segment")


def segment_variety(wh: Warehouse) -> DataFrame:
    """Q44: average distinct products and basket size per segment."""
    return wh.dim_user_segmented.groupBy("customer_segment").agg(
        F.count("user_id").alias("customer_count"),
        F.round(F.avg("unique_products_purchased"), 6).alias("average_unique_products"),
        F.round(F.avg("average_basket_size"), 6).alias("average_basket_size"),
    ).orderBy("customer_segment")


def user_history(wh: Warehouse, user_id: int | None = None) -> DataFrame:
    """one user's orders with basket measures (default: the user with the most orders, lowest id)."""
    fo = wh.fact_order
    if user_id is None:
        pick = top_k(wh.dim_user.select("user_id", "total_orders"), 1, F.col("total_orders").desc(),
                     F.col("user_id").asc()).select("user_id")
        fo = fo.join(F.broadcast(pick), "user_id", "left_semi")  # top-1: one row
    else:
        fo = fo.filter(F.col("user_id") == user_id)
    return fo.orderBy("order_number")


def customer_segments(wh: Warehouse) -> DataFrame:
    """Each user with the two broadcast median thresholds and the resulting segment."""
    from trolley.functions.columns import customer_segment
    from trolley.plans.features import threshold_scalars

    orders_t, rate_t = threshold_scalars(wh.dim_user)  # scalar subqueries, one level
    return wh.dim_user.select(
        "user_id", "total_orders", "customer_reorder_rate", orders_t.alias("order_threshold"),
        rate_t.alias("reorder_threshold"),
        customer_segment("total_orders", "customer_reorder_rate", orders_t, rate_t).alias("customer_segment"))


def _null_cells(df: DataFrame) -> F.Column:
    counts = [F.count_if(F.col(c).isNull()) for c in df.columns]
    return sum(counts[1:], counts[0]).cast("bigint")


def publish(wh: Warehouse, name: str, df: DataFrame, **measures) -> dict:
    """Write one published table; its rows, its null cells and ``measures`` are observed by the write itself."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), _null_cells(df).alias("nulls"), *[e.alias(m) for m, e in measures.items()]) \
        .write.mode("overwrite").parquet(wh.path("published", name))
    return dict(seen.get)


def dashboard_checks(wh: Warehouse) -> DataFrame:
    """Q46: publishes the dashboard's five tables and checks them -- totals reconcile, no duplicates, no missing values,
    rates in range.

    Each table is computed and written once; its measures come from that write, so no check scans it again (but the one
    for repeated product ids, which groups the written table).  The totals to meet are one aggregate per mart.
    """
    orders = wh.fact_order.agg(F.count(F.lit(1)).alias("n"), F.count("basket_size").alias("baskets")).first()
    users = wh.dim_user.count()
    items = wh.order_baskets.agg(F.coalesce(F.sum("basket_size"), F.lit(0))).first()[0]
    kp = publish(wh, "dashboard_kpis", kpis_all(wh))
    ot = publish(wh, "dashboard_order_time", order_time(wh), total=F.sum("order_count"))
    bd = publish(wh, "dashboard_basket_distribution", basket_distribution(wh), total=F.sum("order_count"))
    pm = publish(wh, "dashboard_product_metrics", dashboard_product_metrics(wh), total=F.sum("purchase_count"),
                 outside=F.count_if(~F.col("product_reorder_rate").between(0, 1)))
    seg = publish(wh, "dashboard_customer_segments", segment_summary(wh), total=F.sum("customer_count"))
    ids = wh.spark.read.parquet(wh.path("published", "dashboard_product_metrics")).groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = ids.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).first()[0]
    off = lambda got, want: abs((got["total"] or 0) - want)
    lines = [
        ("kpis_single_row", "dashboard_kpis", abs(kp["rows"] - 1)),
        ("kpis_missing", "dashboard_kpis", kp["nulls"]),
        ("order_time_total", "dashboard_order_time", off(ot, orders["n"])),
        ("order_time_missing", "dashboard_order_time", ot["nulls"]),
        ("basket_distribution_total", "dashboard_basket_distribution", off(bd, orders["baskets"])),
        ("basket_distribution_missing", "dashboard_basket_distribution", bd["nulls"]),
        ("product_metrics_duplicate_ids", "dashboard_product_metrics", repeated),
        ("product_metrics_missing", "dashboard_product_metrics", pm["nulls"]),
        ("product_metrics_rate_range", "dashboard_product_metrics", pm["outside"]),
        ("product_metrics_total", "dashboard_product_metrics", off(pm, items)),
        ("customer_segments_total", "dashboard_customer_segments", off(seg, users)),
    ]
    rows = [(c, t, int(n), "PASS" if n == 0 else "FAIL") for c, t, n in lines]
    return wh.spark.createDataFrame(rows, "check_name string, table_name string, issue_count bigint, status string")
