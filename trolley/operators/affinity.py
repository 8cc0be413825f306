"""Market-basket affinity (B1-B6): products bought together in one order.

Plan: the k most purchased products (a k-row frame -- its size is the
parameter, so broadcasting it is bounded) semi-join the item fact; the
(order, product) rows are de-duplicated; a self-join on order_id with
``a < b`` emits each unordered pair once per order.  After the semi-join an
order holds at most k rows, so a single order contributes at most
k(k-1)/2 pairs however skewed the data is; the pair aggregate has at most
k(k-1)/2 keys and is combined map-side.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.functions.joins import small
from trolley.functions.ranking import top_k
from trolley.plans.warehouse import Warehouse

# Affinity universe (50 most purchased) and report sizes (10).
AFFINITY_PRODUCTS = 50
TOP_PAIRS = 10
MATRIX_PRODUCTS = 10


def top_k_products(wh: Warehouse, k: int = AFFINITY_PRODUCTS) -> DataFrame:
    """B1: the k most purchased product ids, ranked 1..k (ties by id)."""
    top = top_k(wh.product_metrics.select("product_id", "purchase_count"), k,
                F.col("purchase_count").desc(), F.col("product_id").asc())
    w = Window.orderBy(F.col("purchase_count").desc(), F.col("product_id").asc())  # over k rows only
    return top.withColumn("rank", F.row_number().over(w).cast("int"))


def _basket_rows(wh: Warehouse, k: int) -> DataFrame:
    """Distinct (order, product) rows of top-k products.

    The items are bucketed by order_id, so the de-duplication and both sides
    of the per-order self-join run without an exchange; on unbucketed input
    the planner de-duplicates with map-side partial aggregation (copies
    collapse inside each task) and then shuffles once on order_id for the
    join.  After the semi join an order holds at most k rows.
    """
    top = F.broadcast(top_k_products(wh, k).select("product_id"))  # k rows
    rows = wh.fact_order_item.select("order_id", "product_id").join(top, "product_id", "left_semi")
    return rows.distinct()


def product_pairs(wh: Warehouse, k: int = AFFINITY_PRODUCTS) -> DataFrame:
    """B2: orders containing each unordered pair of top-k products (each pair once per order)."""
    rows = _basket_rows(wh, k)
    a = rows.select("order_id", F.col("product_id").alias("product_a_id"))
    b = rows.select("order_id", F.col("product_id").alias("product_b_id"))
    return (a.join(b, "order_id").filter(F.col("product_a_id") < F.col("product_b_id"))
            .groupBy("product_a_id", "product_b_id").agg(F.count(F.lit(1)).alias("pair_order_count")))


def top_product_pairs(wh: Warehouse, n: int = TOP_PAIRS, k: int = AFFINITY_PRODUCTS) -> DataFrame:
    """The n most frequent pairs with product names."""
    names = small(wh.dim_product.select("product_id", "product_name"), wh.rows("dim_product"))
    top = top_k(product_pairs(wh, k), n, F.col("pair_order_count").desc(), F.col("product_a_id").asc(),
                F.col("product_b_id").asc())
    na = names.select(F.col("product_id").alias("product_a_id"), F.col("product_name").alias("product_a"))
    nb = names.select(F.col("product_id").alias("product_b_id"), F.col("product_name").alias("product_b"))
    return (top.join(na, "product_a_id", "left").join(nb, "product_b_id", "left")
            .select("product_a_id", "product_b_id", "product_a", "product_b", "pair_order_count")
            .orderBy(F.col("pair_order_count").desc(), "product_a_id", "product_b_id"))


def _matrix_products(wh: Warehouse, n: int) -> DataFrame:
    names = wh.dim_product.select("product_id", "product_name")
    return top_k_products(wh, n).join(small(names, wh.rows("dim_product")), "product_id", "left")


def pair_matrix(wh: Warehouse, n: int = MATRIX_PRODUCTS) -> DataFrame:
    """Symmetric n x n matrix of pair counts over the n most purchased products; diagonal 0.

    Rows are the products by rank; column ``p{j}`` holds the count with the
    rank-j product (names are data, so columns are keyed by rank).
    """
    prods = _matrix_products(wh, n)
    ranks = prods.select("product_id", "rank")
    pairs = product_pairs(wh, n)
    ra = ranks.select(F.col("product_id").alias("product_a_id"), F.col("rank").alias("ra"))
    rb = ranks.select(F.col("product_id").alias("product_b_id"), F.col("rank").alias("rb"))
    ranked = pairs.join(F.broadcast(ra), "product_a_id").join(F.broadcast(rb), "product_b_id")  # n rows each
    both = (ranked.select(F.col("ra").alias("rank"), F.col("rb").alias("col"), "pair_order_count")
            .unionByName(ranked.select(F.col("rb").alias("rank"), F.col("ra").alias("col"), "pair_order_count")))
    piv = both.groupBy("rank").pivot("col", list(range(1, n + 1))).agg(F.sum("pair_order_count"))
    out = prods.select("rank", "product_name").join(piv, "rank", "left")
    return out.select(
        F.col("rank").alias("product_rank"), "product_name",
        *[F.coalesce(F.col(str(j)), F.lit(0)).cast("bigint").alias(f"p{j}") for j in range(1, n + 1)],
    ).orderBy("product_rank")


def pair_matrix_lower(wh: Warehouse, n: int = MATRIX_PRODUCTS) -> DataFrame:
    """The strict lower triangle of the matrix in long form (row rank > column rank), zeros kept."""
    prods = _matrix_products(wh, n)  # n rows
    ranks = prods.select("product_id", "rank")
    ra = ranks.select(F.col("product_id").alias("product_a_id"), F.col("rank").alias("ra"))
    rb = ranks.select(F.col("product_id").alias("product_b_id"), F.col("rank").alias("rb"))
    ranked = (product_pairs(wh, n).join(F.broadcast(ra), "product_a_id").join(F.broadcast(rb), "product_b_id")
              .select(F.greatest("ra", "rb").alias("row_rank"), F.least("ra", "rb").alias("col_rank"), "pair_order_count"))
    rows = prods.where("rank > 1").select(F.col("rank").alias("row_rank"), F.col("product_name").alias("row_product"),
                                          F.explode(F.sequence(F.lit(1), F.col("rank") - 1)).alias("col_rank"))
    names = prods.select(F.col("rank").alias("col_rank"), F.col("product_name").alias("col_product"))
    return (rows.join(F.broadcast(names), "col_rank").join(F.broadcast(ranked), ["row_rank", "col_rank"], "left")  # n (n - 1) / 2 rows
            .select("row_rank", "row_product", "col_rank", "col_product", F.coalesce("pair_order_count", F.lit(0)).alias("pair_order_count"))
            .orderBy("row_rank", "col_rank"))


def association_rules(wh: Warehouse, k: int = AFFINITY_PRODUCTS) -> DataFrame:
    """Support, confidence both ways and lift of each top-k pair.

    support = pair orders / all orders with items; confidence_ab = pair
    orders / orders with a; lift = pair orders x all orders / (orders with a
    x orders with b).
    """
    rows = _basket_rows(wh, k)
    per_product = rows.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))  # k rows
    n_orders = wh.order_baskets.agg(F.count(F.lit(1))).scalar()  # scalar subquery
    pa = per_product.select(F.col("product_id").alias("product_a_id"), F.col("n").alias("orders_a"))
    pb = per_product.select(F.col("product_id").alias("product_b_id"), F.col("n").alias("orders_b"))
    pairs = product_pairs(wh, k)
    c = F.col("pair_order_count").cast("double")
    return (pairs.join(F.broadcast(pa), "product_a_id").join(F.broadcast(pb), "product_b_id")  # k rows each
            .select("product_a_id", "product_b_id", "pair_order_count",
                    (c / n_orders).alias("support"),
                    (c / F.col("orders_a")).alias("confidence_ab"),
                    (c / F.col("orders_b")).alias("confidence_ba"),
                    (c * n_orders / (F.col("orders_a").cast("double") * F.col("orders_b"))).alias("lift")))


# Fixed value: an itemset is frequent from this share of the orders with items on.
MIN_SUPPORT = 0.001


def _threshold(wh: Warehouse, min_support: float, min_orders: int | None) -> tuple[int, int]:
    """(orders with items, orders that make an itemset frequent)."""
    n = wh.rows("order_baskets")
    return n, max(1, min_orders if min_orders is not None else math.ceil(min_support * n))


def frequent_items(wh: Warehouse, floor: int) -> DataFrame:
    """Level 1: products in at least ``floor`` orders."""
    return (wh.fact_order_item.select("order_id", "product_id").distinct().groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= floor))


def itemset_triples(wh: Warehouse, min_support: float = MIN_SUPPORT, min_orders: int | None = None) -> DataFrame:
    """B6 beyond pairs: frequent sets of three products, level by level, with support, confidence and lift.

    Level 1 keeps the frequent products' rows, level 2 counts pairs of those and keeps the frequent ones, level 3 only
    forms triples whose three pairs are all frequent (a set can't be in more orders than its subsets).  All per-order
    joins run on order_id, by which the items are bucketed; what crosses the network are counts by itemset, combined in
    each task first.  confidence: of the orders with a and b, the share that has c; lift: against independence.
    """
    n, floor = _threshold(wh, min_support, min_orders)
    scratch = wh.path("reports", f"itemsets-{uuid.uuid4().hex[:8]}")

    def kept(df: DataFrame, level: int) -> DataFrame:  # a level is written once; the next levels read it several times
        df.write.parquet(f"{scratch}/level{level}")
        return wh.spark.read.schema(df.schema).parquet(f"{scratch}/level{level}")

    one = kept(frequent_items(wh, floor), 1)
    rows = wh.fact_order_item.select("order_id", "product_id").distinct().join(small(one.select("product_id"), one.count()), "product_id", "left_semi")
    a, b = (rows.select("order_id", F.col("product_id").alias(x)) for x in ("a", "b"))
    pairs = a.join(b, "order_id").where("a < b")
    two = kept(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_ab")).where(F.col("n_ab") >= floor), 2)
    few = two.count()

    def frequent(x: str, y: str) -> DataFrame:
        return small(two.select(F.col("a").alias(x), F.col("b").alias(y)), few)

    ab = pairs.join(frequent("a", "b"), ["a", "b"], "left_semi")
    ac = ab.withColumnRenamed("b", "c")
    three = (ab.join(ac, ["order_id", "a"]).where("b < c").join(frequent("b", "c"), ["b", "c"], "left_semi")
             .groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("order_count")).where(F.col("order_count") >= floor))
    count = F.col("order_count").cast("double")
    out = three.join(small(two, few), ["a", "b"])
    for x in ("a", "b", "c"):
        out = out.join(small(one.select(F.col("product_id").alias(x), F.col("n").cast("double").alias(f"n_{x}")), one.count()), x)
    return out.select(F.col("a").alias("product_a_id"), F.col("b").alias("product_b_id"), F.col("c").alias("product_c_id"), "order_count",
                      (count / n).alias("support"), (count / F.col("n_ab")).alias("confidence"),
                      (count * n * n / (F.col("n_a") * F.col("n_b") * F.col("n_c"))).alias("lift"))
