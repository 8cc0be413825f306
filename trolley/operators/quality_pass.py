"""The whole quality report in few passes: each large table is scanned twice at most, whatever the number of rules.

* Row, value and catalogue rules of a large table are counted in one aggregate (grouped by the columns of its value
  rules, a few combinations for clean data); rules over views of one written table share its scan.  Those of the small
  tables become one stream of violations (rule, value), empty for clean data, which one grouping counts.
* Rules on order and user keys meet in one aggregate per key role: each table adds its counts by key (combined in its
  own buckets or tasks first), the sums by key answer uniqueness, references and the match of items and order sets.
* Keys of the small catalogue tables share one grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.joins import small
from trolley.operators import quality as Q
from trolley.plans.warehouse import Warehouse

SCHEMA = "check_name string, table_name string, issue_count bigint"

# logical table -> (written table whose scan serves it, rows of it that belong to the logical one)
_SERVED = {
    "raw_order_products_prior": ("items", "source_eval_set = 'prior'"), "raw_order_products_train": ("items", "source_eval_set = 'train'"),
    "int_order_products": ("items", None), "raw_orders": ("orders", None), "dim_orders": ("orders", None), "raw_products": ("products", None),
    "dim_products": ("products", None), "raw_aisles": ("aisles", None), "dim_aisles": ("aisles", None), "raw_departments": ("departments", None),
    "dim_departments": ("departments", None),
}
ORDER_KEYS = {"pk_unique_orders", "unique_dim_orders_order_id", "star_pk_fact_order", "item_pair_unique_prior", "item_pair_unique_train"}
LARGE = ("items", "orders", "fact_order_items", "dim_user", "dim_users")  # ``fact_order`` is counted with the user keys
USER_KEYS = {"star_pk_dim_user", "unique_dim_users_user_id"}


def _flag(parent: DataFrame, key: str, name: str, rows: int) -> DataFrame:
    """Distinct keys of a catalogue table with a flag column."""
    return small(parent.select(key).distinct().withColumn(name, F.lit(True)), rows)


def _frames(wh: Warehouse) -> dict[str, DataFrame]:
    """Written tables under the names that ``_SERVED`` gives them, with flags for found catalogue rows."""
    product = _flag(wh.raw("products"), "product_id", "_product", wh.rows("dim_products"))
    aisle, dept = _flag(wh.raw("aisles"), "aisle_id", "_aisle", wh.rows("dim_aisles")), _flag(wh.raw("departments"), "department_id", "_department", wh.rows("dim_departments"))
    slot = _flag(wh.dim_order_slot, "slot_key", "_slot", wh.rows("dim_order_slot"))
    return {
        "items": wh.int_order_products.join(product, "product_id", "left"),
        "orders": wh.raw("orders"),
        "products": wh.raw("products").join(aisle, "aisle_id", "left").join(dept, "department_id", "left"),
        "aisles": wh.raw("aisles"), "departments": wh.raw("departments"),
        "fact_order_items": wh.fact_order_items.join(product, "product_id", "left"),
        "fact_order": wh.fact_order.join(slot, "slot_key", "left"),
        **{t: getattr(wh, t) for t in ("dim_users", "dim_user", "dim_product", "product_metrics", "dim_order_slot")},
    }


def _catalogue_references() -> list[Q.RowRule]:
    """Reference rules whose parent is a catalogue table, as rules over the flags of ``_frames``."""
    return [Q.RowRule("relationships_fact_order_items_product_id", "fact_order_items", "product_id IS NOT NULL AND _product IS NULL"),
            Q.RowRule("prior_product_refs", "raw_order_products_prior", "_product IS NULL"),
            Q.RowRule("star_refs_fact_order_slot", "fact_order", "_slot IS NULL"),
            Q.RowRule("product_refs", "raw_products", "_aisle IS NULL OR _department IS NULL")]


def _suite() -> tuple[list[Q.RowRule], list[Q.ValuesRule], list[Q.KeyRule]]:
    rules = [r for key in Q.GATE_KEYS for r in Q.suite()[key]]
    rows = [r for r in rules if isinstance(r, Q.RowRule)] + _catalogue_references()
    return rows, [r for r in rules if isinstance(r, Q.ValuesRule)], [r for r in rules if isinstance(r, Q.KeyRule)]


def _holds(rule: Q.RowRule) -> Column:
    where = _SERVED.get(rule.table, (rule.table, None))[1]
    return F.coalesce(F.expr(f"({where}) AND ({rule.predicate})" if where else rule.predicate), F.lit(False))


def violations(frames: dict[str, DataFrame], rows: list[Q.RowRule], values: list[Q.ValuesRule]) -> DataFrame:
    """(check_name, table_name, issue_count) of row rules (rows) and value rules (distinct values) over all tables."""
    by_frame: dict[str, list[Column]] = {}
    for r in rows:
        by_frame.setdefault(_SERVED.get(r.table, (r.table,))[0], []).append(
            F.when(_holds(r), F.struct(F.lit(r.name).alias("rule"), F.lit(None).cast("string").alias("value"))))
    for r in values:
        bad = F.col(r.column).isNotNull() & ~F.col(r.column).isin(list(r.values))
        by_frame.setdefault(_SERVED.get(r.table, (r.table,))[0], []).append(
            F.when(bad, F.struct(F.lit(r.name).alias("rule"), F.col(r.column).cast("string").alias("value"))))
    found = Q._union([frames[t].select(F.explode(F.array_compact(F.array(*cells))).alias("x")).select("x.*") for t, cells in by_frame.items()])
    counts = found.groupBy("rule", "value").agg(F.count(F.lit(1)).alias("n")).groupBy("rule").agg(F.sum("n").alias("n"), F.count("value").alias("values"))
    spark = found.sparkSession
    names = spark.createDataFrame([(r.name, r.table, isinstance(r, Q.ValuesRule)) for r in [*rows, *values]], "check_name string, table_name string, by_value boolean")
    n = F.when(F.col("by_value"), F.col("values")).otherwise(F.col("n"))
    return (names.join(F.broadcast(counts), names.check_name == counts.rule, "left")  # one row a rule
            .select("check_name", "table_name", F.coalesce(n, F.lit(0)).alias("issue_count")))


def counted(frame: DataFrame, rows: list[Q.RowRule], values: list[Q.ValuesRule]) -> DataFrame:
    """The same for one large table: one aggregate over its rows."""
    columns = sorted({r.column for r in values})
    sums = frame.groupBy(*columns).agg(*[F.count_if(_holds(r)).alias(f"r{i}") for i, r in enumerate(rows)])
    rules = [(r.name, r.table, F.sum(f"r{i}")) for i, r in enumerate(rows)]
    rules += [(r.name, r.table, F.count_distinct(F.when(~F.col(r.column).isin(list(r.values)), F.col(r.column)))) for r in values]
    return _lines(sums, rules)


def _by_key(sources: list[DataFrame], key: str) -> DataFrame:
    """Sums by key over all sources; a measure that a source lacks counts 0."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out.groupBy(key).agg(*[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in out.columns if c != key])


def _lines(one: DataFrame, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """One aggregate over all keys, reshaped to report rows."""
    sums = one.agg(*[F.coalesce(e, F.lit(0)).cast("bigint").alias(f"c{i}") for i, (_, _, e) in enumerate(rules)])
    cells = [F.struct(F.lit(n).alias("check_name"), F.lit(t).alias("table_name"), F.col(f"c{i}").alias("issue_count")) for i, (n, t, _) in enumerate(rules)]
    return sums.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def order_role(wh: Warehouse, frames: dict[str, DataFrame]) -> DataFrame:
    """Every rule on order keys: what each table holds of an order, side by side."""
    orders = frames["orders"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("eval_set") != "prior").alias("not_prior"), F.count_if(F.col("eval_set") != "train").alias("not_train"))
    pairs = frames["items"].groupBy("order_id", "product_id", "source_eval_set").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_product").isNull()).alias("lost"))
    prior, train = F.col("source_eval_set") == "prior", F.col("source_eval_set") == "train"
    items = pairs.groupBy("order_id").agg(
        F.sum(F.when(prior, F.col("n"))).alias("prior"), F.sum(F.when(train, F.col("n"))).alias("train"), F.sum(F.when(train, F.col("lost"))).alias("train_lost"),
        F.count_if(prior & (F.col("n") > 1)).alias("prior_twice"), F.count_if(train & (F.col("n") > 1)).alias("train_twice"))
    facts = wh.fact_order_items.groupBy("order_id").agg(F.count(F.lit(1)).alias("facts"))
    fact_orders = wh.fact_order.groupBy("order_id").agg(F.count(F.lit(1)).alias("fact_orders"))
    known = F.col("order_id").isNotNull()
    found = known & (F.col("orders") > 0)
    return _lines(_by_key([orders, items, facts, fact_orders], "order_id"), [
        ("pk_unique_orders", "raw_orders", F.sum("orders") - F.count_if(found)),
        ("unique_dim_orders_order_id", "dim_orders", F.count_if(known & (F.col("orders") > 1))),
        ("relationships_fact_order_items_order_id", "fact_order_items", F.sum(F.when(known & ~found, F.col("facts")))),
        ("prior_order_refs", "raw_order_products_prior", F.sum(F.when(~found, F.col("prior")))),
        ("train_refs", "raw_order_products_train", F.sum(F.when(found, F.col("train_lost")).otherwise(F.col("train")))),
        ("partition_consistency_prior", "raw_order_products_prior", F.sum(F.when(known, F.col("prior") * F.col("not_prior")))),
        ("partition_consistency_train", "raw_order_products_train", F.sum(F.when(known, F.col("train") * F.col("not_train")))),
        ("item_pair_unique_prior", "raw_order_products_prior", F.sum("prior_twice")),
        ("item_pair_unique_train", "raw_order_products_train", F.sum("train_twice")),
        ("star_pk_fact_order", "fact_order", F.sum("fact_orders") - F.count_if(known & (F.col("fact_orders") > 0)))])


def user_role(wh: Warehouse, frames: dict[str, DataFrame], rows: list[Q.RowRule]) -> DataFrame:
    """Every rule on user keys; the row rules of ``fact_order`` are counted in the same scan."""
    own = [r for r in rows if r.table == "fact_order"]
    orders = frames["fact_order"].groupBy("user_id").agg(F.count(F.lit(1)).alias("orders"), *[F.count_if(_holds(r)).alias(f"r{i}") for i, r in enumerate(own)])
    users = wh.dim_user.groupBy("user_id").agg(F.count(F.lit(1)).alias("users"))
    observed = wh.dim_users.groupBy("user_id").agg(F.count(F.lit(1)).alias("observed"))
    known = F.col("user_id").isNotNull()
    found = known & (F.col("users") > 0)
    return _lines(_by_key([orders, users, observed], "user_id"), [
        ("star_pk_dim_user", "dim_user", F.sum("users") - F.count_if(found)),
        ("unique_dim_users_user_id", "dim_users", F.count_if(known & (F.col("observed") > 1))),
        ("star_refs_fact_order_user", "fact_order", F.sum(F.when(~found, F.col("orders")))),
        *[(r.name, r.table, F.sum(f"r{i}")) for i, r in enumerate(own)]])


def catalogue_keys(frames: dict[str, DataFrame], rules: list[Q.KeyRule]) -> DataFrame:
    """Uniqueness of the small tables' keys in one grouping."""
    by_frame: dict[str, list[Column]] = {}
    for r in rules:
        keys = [F.col(k).cast("string") for k in r.keys]
        by_frame.setdefault(_SERVED.get(r.table, (r.table,))[0], []).append(F.struct(F.lit(r.name).alias("rule"), F.array(*keys).alias("key")))
    found = Q._union([frames[t].select(F.explode(F.array(*cells)).alias("x")).select("x.*") for t, cells in by_frame.items()])
    whole = ~F.exists("key", lambda k: k.isNull())
    per_rule = found.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n")).groupBy("rule").agg(
        (F.sum("n") - F.count_if(whole)).alias("surplus"), F.count_if((F.col("n") > 1) & whole).alias("twice"))
    names = found.sparkSession.createDataFrame([(r.name, r.table, r.mode == "surplus") for r in rules], "check_name string, table_name string, by_surplus boolean")
    n = F.when(F.col("by_surplus"), F.col("surplus")).otherwise(F.col("twice"))
    return (names.join(F.broadcast(per_rule), names.check_name == per_rule.rule, "left")  # one row a rule
            .select("check_name", "table_name", F.coalesce(n, F.lit(0)).alias("issue_count")))


def report(wh: Warehouse) -> DataFrame:
    """(check_name, table_name, issue_count) of the whole suite."""
    rows, values, keys = _suite()
    frames = _frames(wh)
    parts = [order_role(wh, frames), user_role(wh, frames, rows)]
    for t in LARGE:
        mine = [[r for r in rs if _SERVED.get(r.table, (r.table,))[0] == t] for rs in (rows, values)]
        parts.append(counted(frames[t], *mine))
    rest = [[r for r in rs if _SERVED.get(r.table, (r.table,))[0] not in (*LARGE, "fact_order")] for rs in (rows, values)]
    small_keys = [k for k in keys if k.name not in ORDER_KEYS | USER_KEYS]
    return Q._union([*parts, violations(frames, *rest), catalogue_keys(frames, small_keys)])
