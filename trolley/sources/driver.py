"""Derive the six raw basket tables from the driver's TPC-H-ish tables.

The driver ships orders / lineitem / part, not grocery baskets, so the raw
tables of the basket data model are derived here with deterministic rules
(every window has a total order).  The same rules appear as the DuckDB
prefix in ``trolley.oracle.prefix``.

Scale notes
-----------
* Items: (order, product) pairs are de-duplicated with map-side partial
  aggregation (copied lines collapse before the shuffle); the join to
  orders, the cart-position window and the written table share one
  exchange on order_id.
* ``reordered`` compares with ``min(order_number)`` per (user, product),
  an aggregate joined back rather than a window.  Both sides of that join
  read one exchange of the keys alone; only the keys of reordered rows go
  back to their orders.
* ``order_number`` / gap: the per-user sequence is split by (user, day) --
  offsets and previous order days come from a window over a user's
  distinct days (bounded by the calendar), the rank within a day from a
  window per (user, day); so a user holding a third of all orders is
  spread over as many tasks as it has order days.  Ranks and day counts
  come from one exchange.
* ``parts`` is the width of these exchanges: it grows with the input, so
  that a task's share of it does not.
* Product / aisle / department ids are dense ranks over the distinct
  catalogue keys (bounded by catalogue size, not by fact size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


NO_DAY = -(1 << 31)  # the day of orders without a date: before all others


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dense_ids(keys: DataFrame, order_cols: list[str], id_col: str) -> DataFrame:
    """Attach 1..N ids by sorted position of a small distinct key set."""
    w = Window.orderBy(*order_cols)
    return keys.withColumn(id_col, F.row_number().over(w).cast("int"))


def derive_catalogue(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    part = read_driver(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    departments = _dense_ids(part.select("p_type").distinct(), ["p_type"], "department_id").select(
        "department_id", F.col("p_type").alias("department"))
    aisles = _dense_ids(part.select("p_brand").distinct(), ["p_brand"], "aisle_id").select(
        "aisle_id", F.col("p_brand").alias("aisle"))
    prod_keys = _dense_ids(part.select("p_brand", "p_type").distinct(), ["p_brand", "p_type"], "product_id")
    products = (
        # aisles / departments are distinct catalogue attributes (one row per brand / type)
        prod_keys.join(F.broadcast(aisles), prod_keys.p_brand == aisles.aisle)
        .join(F.broadcast(departments), prod_keys.p_type == departments.department)
        .select(
            "product_id",
            F.concat_ws(" ", "p_brand", "p_type").alias("product_name"),
            "aisle_id",
            "department_id",
        )
    )
    part_product = part.join(F.broadcast(prod_keys), ["p_brand", "p_type"]).select("p_partkey", "product_id")
    return {"aisles": aisles, "departments": departments, "products": products, "_part_product": part_product}


def derive_orders(spark: SparkSession, sf_dir: str, parts: int) -> DataFrame:
    orders = read_driver(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # distinct order keys first: partial aggregation shrinks the line side before the semi join's shuffle
    lines = read_driver(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    odate = F.to_date("o_orderdate")
    base = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left_semi").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        odate.alias("odate"),
        F.coalesce(F.unix_date(odate), F.lit(NO_DAY)).alias("day"),
    )
    # A user's sequence is split by day so no window ever holds one user's whole history:
    # per-(user, day) counts -> each day's offset and the previous order day come from a
    # window over the user's *days*; the rank inside a day is a window per (user, day).
    # A day's count is its last rank: both read the same exchange, so the orders are joined and sent once.
    w_in_day = Window.partitionBy("user_id", "day").orderBy("order_id")
    ranked = base.repartition(parts, "user_id", "day").withColumn("_r", F.row_number().over(w_in_day))
    days = ranked.groupBy("user_id", "day").agg(F.max("_r").alias("n_day"), F.max("odate").alias("odate"))
    w_days = Window.partitionBy("user_id").orderBy("day")
    days = days.select(
        "user_id", "day",
        (F.sum("n_day").over(w_days.rowsBetween(Window.unboundedPreceding, -1))).alias("before"),
        F.lag("odate").over(w_days).alias("prev_day"),
        F.sum("n_day").over(Window.partitionBy("user_id")).alias("n_orders"),
    )
    seq = (
        ranked.join(days, ["user_id", "day"])
        .filter(F.col("odate").isNotNull())  # orders without a date count in the sequence but are no rows of it
        .withColumn("order_number", (F.coalesce(F.col("before"), F.lit(0)) + F.col("_r")).cast("int"))
        .withColumn("prev_date", F.when(F.col("_r") > 1, F.col("odate")).otherwise(F.col("prev_day")))
    )
    last = F.col("order_number") == F.col("n_orders")
    eval_set = (
        F.when(last & (F.col("user_id") % 3 == 0), F.lit("test"))
        .when(last, F.lit("train"))
        .otherwise(F.lit("prior"))
    )
    return seq.select(
        "order_id",
        "user_id",
        eval_set.alias("eval_set"),
        "order_number",
        (F.dayofweek("odate") - 1).cast("int").alias("order_dow"),
        ((F.col("order_id") * 7 + F.col("user_id")) % 24).cast("int").alias("order_hour_of_day"),
        (F.datediff("odate", "prev_date") % 31).cast("double").alias("days_since_prior_order"),
    )


def place_items(spark: SparkSession, sf_dir: str, raw_orders: DataFrame, part_product: DataFrame, parts: int) -> DataFrame:
    """All (order, product) rows with cart position and their order's user, number and eval_set."""
    lines = read_driver(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    # part -> product is catalogue-sized; the join strategy is left to AQE
    # (broadcast when the runtime size is under the threshold).
    # (order, product) de-dup with map-side partial aggregation first (copied
    # lines collapse before the shuffle); the join to orders, the cart-position
    # window and the bucketed write then share one exchange on order_id.
    pairs = (
        lines.join(part_product, lines.l_partkey == part_product.p_partkey)
        .groupBy(F.col("l_orderkey").alias("order_id"), "product_id")
        .agg(F.min("l_linenumber").alias("first_line"))
        .repartition(parts, "order_id")
    )
    orders = raw_orders.select("order_id", "user_id", "order_number", "eval_set")
    w_cart = Window.partitionBy("order_id").orderBy("first_line", "product_id")
    placed = pairs.join(orders, "order_id").withColumn("add_to_cart_order", F.row_number().over(w_cart).cast("int"))
    return placed.filter(F.col("user_id").isNotNull()).drop("first_line")  # an item without a user has no first order


def flag_reorders(placed: DataFrame, parts: int) -> DataFrame:
    """Placed items with their reorder flag: bought by the same user in an earlier order."""
    row = ["order_id", "user_id", "product_id", "order_number"]  # a user's order numbers are unique, so these name a row
    # all that the join below needs not null is asked for here: a filter on one side only would part the two exchanges
    known = [F.col(c).isNotNull() for c in row]
    rows = placed.select(*row).filter(known[0] & known[1] & known[2] & known[3]).repartition(parts, "user_id", "product_id")
    # first order of each (user, product): an aggregate joined back.  It takes the order's number with its id, and so
    # all columns of ``rows``: both sides of the join are one exchange.
    first = rows.groupBy("user_id", "product_id").agg(F.min(F.struct("order_number", "order_id")).alias("first"))
    again = (
        rows.join(first, ["user_id", "product_id"]).filter(F.col("order_number") > F.col("first.order_number"))
        .select(*row).repartition(parts, "order_id")
        .groupBy("order_id").agg(F.collect_list(F.struct(*row[1:])).alias("again"))  # an order's items: a catalogue at most
    )
    found = F.array_contains("again", F.struct(*row[1:]))
    return placed.join(again, "order_id", "left").select(
        "order_id", "product_id", "add_to_cart_order", F.coalesce(found, F.lit(False)).cast("int").alias("reordered"), "eval_set")


def derive_items(spark: SparkSession, sf_dir: str, raw_orders: DataFrame, part_product: DataFrame, parts: int) -> DataFrame:
    """All (order, product) rows with cart position and reorder flag, tagged by eval_set."""
    return flag_reorders(place_items(spark, sf_dir, raw_orders, part_product, parts), parts)
