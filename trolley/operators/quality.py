"""Declarative data-quality suite.

Every check yields one report row ``(check_name, table_name, issue_count,
status)``; 0 issues = PASS.  Checks come in a few shapes:

* row rules -- a SQL predicate per offending row.  All row rules of one
  table are folded into a single aggregate (``count_if`` per rule), so a
  table is scanned once however many rules it has;
* key rules -- duplicate keys / distinct counts (a partial + final aggregate);
* reference rules -- orphan child rows (``left_anti`` join);
* catalogue and log rules.

The same predicate strings are used by the DuckDB oracle.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.joins import small
from trolley.plans.warehouse import Warehouse

@dataclass(frozen=True)
class RowRule:
    name: str
    table: str
    predicate: str  # SQL; a row matching it is an issue


@dataclass(frozen=True)
class KeyRule:
    name: str
    table: str
    keys: tuple[str, ...]
    mode: str  # 'dup_groups' (dbt unique / pair unique) | 'surplus' (count - count distinct)


@dataclass(frozen=True)
class RefRule:
    name: str
    table: str
    column: tuple[str, ...]
    parent: str
    parent_column: tuple[str, ...]
    skip_null: bool = True  # dbt relationships ignore NULL child keys


@dataclass(frozen=True)
class ValuesRule:
    name: str
    table: str
    column: str
    values: tuple


def _status(c) -> F.Column:
    return F.when(c == 0, F.lit("PASS")).otherwise(F.lit("FAIL"))


def _rows(df: DataFrame) -> DataFrame:
    return df.select("check_name", "table_name", F.col("issue_count").cast("bigint").alias("issue_count"),
                     _status(F.col("issue_count")).alias("status"))


def _lit_values(values: tuple) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


# --------------------------------------------------------------------------- rule catalogue

_RAW = ("aisles", "departments", "products", "orders", "order_products_prior", "order_products_train")

# Required (non-null) columns per raw table.
_REQUIRED = {
    "aisles": ("aisle_id", "aisle"),
    "departments": ("department_id", "department"),
    "products": ("product_id", "product_name", "aisle_id", "department_id"),
    "orders": ("order_id", "user_id", "eval_set", "order_number", "order_dow", "order_hour_of_day"),
    "order_products_prior": ("order_id", "product_id", "add_to_cart_order", "reordered"),
    "order_products_train": ("order_id", "product_id", "add_to_cart_order", "reordered"),
}

# Identifier columns that must be >= 1.
_IDS = {
    "aisles": ("aisle_id",),
    "departments": ("department_id",),
    "products": ("product_id", "aisle_id", "department_id"),
    "orders": ("order_id", "user_id"),
    "order_products_prior": ("order_id", "product_id"),
    "order_products_train": ("order_id", "product_id"),
}

_NAMES = {"aisles": "aisle", "departments": "department", "products": "product_name"}

# Allowed ranges (None: open) and values of the raw order and item columns.
_RANGES = {
    "orders": {"order_number": (1, None), "order_dow": (0, 6), "order_hour_of_day": (0, 23), "days_since_prior_order": (0, 30)},
    "order_products_prior": {"add_to_cart_order": (1, None)},
    "order_products_train": {"add_to_cart_order": (1, None)},
}
_DOMAINS = {
    "orders": {"eval_set": ("prior", "train", "test")},
    "order_products_prior": {"reordered": (0, 1)},
    "order_products_train": {"reordered": (0, 1)},
}
# a user's first order, and only that one, has no gap before it
_FIRST_ORDER_GAP = "(order_number = 1) <> (days_since_prior_order IS NULL)"


def range_predicate(table: str) -> str:
    """Rows of a raw table with a value outside its column's range or values; orders also need the right gap."""
    outside = [f"{c} {op} {bound}" for c, ends in _RANGES[table].items() for op, bound in zip("<>", ends) if bound is not None]
    outside += [f"{c} NOT IN ({_lit_values(values)})" for c, values in _DOMAINS[table].items()]
    return " OR ".join(outside + [_FIRST_ORDER_GAP] * (table == "orders"))


def dbt_not_null_rules() -> list[RowRule]:
    """The 17 ``not_null`` tests of the dbt project."""
    spec = {
        "int_order_products": ("order_id", "product_id", "add_to_cart_order", "reordered", "source_eval_set"),
        "dim_orders": ("order_id", "user_id"),
        "dim_products": ("product_id",),
        "dim_aisles": ("aisle_id",),
        "dim_departments": ("department_id",),
        "dim_users": ("user_id", "reorder_rate"),
        "fact_order_items": ("order_id", "product_id", "user_id", "reordered", "source_eval_set"),
    }
    return [RowRule(f"not_null_{t}_{c}", t, f"{c} IS NULL") for t, cols in spec.items() for c in cols]


def dbt_unique_rules() -> list[KeyRule]:
    """The five ``unique`` tests."""
    spec = [("dim_orders", "order_id"), ("dim_products", "product_id"), ("dim_aisles", "aisle_id"),
            ("dim_departments", "department_id"), ("dim_users", "user_id")]
    return [KeyRule(f"unique_{t}_{c}", t, (c,), "dup_groups") for t, c in spec]


def dbt_accepted_values_rules() -> list[ValuesRule]:
    """D3: the four ``accepted_values`` tests."""
    out = []
    for t in ("int_order_products", "fact_order_items"):
        out.append(ValuesRule(f"accepted_values_{t}_reordered", t, "reordered", (0, 1)))
        out.append(ValuesRule(f"accepted_values_{t}_source_eval_set", t, "source_eval_set", ("prior", "train")))
    return out


def dbt_relationship_rules() -> list[RefRule]:
    """The two ``relationships`` tests."""
    return [
        RefRule("relationships_fact_order_items_order_id", "fact_order_items", ("order_id",), "dim_orders", ("order_id",)),
        RefRule("relationships_fact_order_items_product_id", "fact_order_items", ("product_id",), "dim_products",
                ("product_id",)),
    ]


def dbt_singular_rules() -> dict[str, RowRule]:
    """The four singular tests over fact_order_items."""
    return {
        "dq_cart_position": RowRule("cart_position_is_positive", "fact_order_items", "add_to_cart_order < 1"),
        "dq_source_valid": RowRule("fact_source_is_valid", "fact_order_items",
                                   "source_eval_set NOT IN ('prior', 'train')"),
        "dq_dow_valid": RowRule("order_dow_is_valid", "fact_order_items", "order_dow < 0 OR order_dow > 6"),
        "dq_hour_valid": RowRule("order_hour_is_valid", "fact_order_items",
                                 "order_hour_of_day < 0 OR order_hour_of_day > 23"),
    }


def raw_required_rules() -> list[RowRule]:
    """Any required column NULL (one rule per raw table)."""
    return [RowRule(f"required_not_null_{t}", f"raw_{t}", " OR ".join(f"{c} IS NULL" for c in cols))
            for t, cols in _REQUIRED.items()]


def raw_positive_id_rules() -> list[RowRule]:
    """Identifiers below 1."""
    return [RowRule(f"positive_ids_{t}", f"raw_{t}", " OR ".join(f"{c} < 1" for c in cols)) for t, cols in _IDS.items()]


def raw_blank_name_rules() -> list[RowRule]:
    """Names that are blank after trimming (plus eval_set, as the warehouse variant checks)."""
    rules = [RowRule(f"names_not_blank_{t}", f"raw_{t}", f"trim({c}) = ''") for t, c in _NAMES.items()]
    rules.append(RowRule("names_not_blank_orders", "raw_orders", "trim(eval_set) = ''"))
    return rules


def raw_range_rules() -> dict[str, list[RowRule]]:
    """D19 (orders) and D20 (items) range rules."""
    return {
        "dq_order_ranges": [RowRule("order_ranges", "raw_orders", range_predicate("orders"))],
        "dq_item_ranges": [RowRule("item_ranges_prior", "raw_order_products_prior", range_predicate("order_products_prior")),
                           RowRule("item_ranges_train", "raw_order_products_train", range_predicate("order_products_train"))],
    }


def raw_key_rules() -> dict[str, list[KeyRule]]:
    """D10 (surplus primary keys) and D11 (duplicate item pairs)."""
    return {
        "dq_pk_unique": [KeyRule(f"pk_unique_{t}", f"raw_{t}", (k,), "surplus") for t, k in
                         (("aisles", "aisle_id"), ("departments", "department_id"), ("products", "product_id"),
                          ("orders", "order_id"))],
        "dq_item_pair_unique": [KeyRule(f"item_pair_unique_{s}", f"raw_order_products_{s}", ("order_id", "product_id"),
                                        "dup_groups") for s in ("prior", "train")],
    }


def raw_ref_rules() -> dict[str, list[RefRule]]:
    """Raw referential integrity."""
    return {
        "dq_prior_order_refs": [RefRule("prior_order_refs", "raw_order_products_prior", ("order_id",), "raw_orders",
                                        ("order_id",), skip_null=False)],
        "dq_prior_product_refs": [RefRule("prior_product_refs", "raw_order_products_prior", ("product_id",),
                                          "raw_products", ("product_id",), skip_null=False)],
    }


def star_rules() -> dict[str, list]:
    """Checks on the V1 star schema and its features."""
    return {
        "dq_star_pk": [KeyRule(f"star_pk_{t}", t, (k,), "surplus") for t, k in
                       (("dim_user", "user_id"), ("dim_product", "product_id"), ("dim_order_slot", "slot_key"),
                        ("fact_order", "order_id"))],
        "dq_star_refs": [RefRule("star_refs_fact_order_user", "fact_order", ("user_id",), "dim_user", ("user_id",),
                                 skip_null=False),
                         RefRule("star_refs_fact_order_slot", "fact_order", ("slot_key",), "dim_order_slot",
                                 ("slot_key",), skip_null=False)],
        "dq_rate_bounds": [RowRule("rate_bounds_fact_order", "fact_order",
                                   "reorder_rate IS NOT NULL AND reorder_rate NOT BETWEEN 0 AND 1"),
                           RowRule("rate_bounds_dim_user", "dim_user",
                                   "customer_reorder_rate IS NOT NULL AND customer_reorder_rate NOT BETWEEN 0 AND 1"),
                           RowRule("rate_bounds_product_metrics", "product_metrics",
                                   "product_reorder_rate IS NOT NULL AND product_reorder_rate NOT BETWEEN 0 AND 1")],
        "dq_basket_positive": [RowRule("basket_positive", "fact_order",
                                       "eval_set IN ('prior', 'train') AND NOT coalesce(basket_size > 0, false)")],
        "dq_gap_null_iff_first": [RowRule("gap_null_iff_first", "fact_order",
                                          "(days_since_prior_order IS NULL) <> coalesce(order_number = 1, false)")],
        "dq_test_orders_empty": [RowRule("test_orders_empty", "fact_order",
                                         "eval_set = 'test' AND (basket_size IS NOT NULL OR "
                                         "reordered_item_count IS NOT NULL OR reorder_rate IS NOT NULL)")],
        "dq_slot_complete": [RowRule("slot_not_null", "dim_order_slot",
                                     "slot_key IS NULL OR order_dow IS NULL OR order_hour_of_day IS NULL "
                                     "OR day_part IS NULL"),
                             KeyRule("slot_pair_unique", "dim_order_slot", ("order_dow", "order_hour_of_day"),
                                     "surplus")],
    }


def suite() -> dict[str, list]:
    """Every DQ key and its rules (D9, D21-D23, D30, D33 are special-cased in ``run_key``)."""
    s: dict[str, list] = {
        "dq_not_null": dbt_not_null_rules(),
        "dq_unique": dbt_unique_rules(),
        "dq_accepted_values": dbt_accepted_values_rules(),
        "dq_relationships": dbt_relationship_rules(),
        "dq_required_not_null": raw_required_rules(),
        "dq_positive_ids": raw_positive_id_rules(),
        "dq_names_not_blank": raw_blank_name_rules(),
        "dq_product_refs": [],
        "dq_train_refs": [],
        "dq_partition_consistency": [],
    }
    s.update({k: [r] for k, r in dbt_singular_rules().items()})
    s.update(raw_range_rules())
    s.update(raw_key_rules())
    s.update(raw_ref_rules())
    s.update(star_rules())
    return s


# --------------------------------------------------------------------------- evaluation


def table(wh: Warehouse, name: str) -> DataFrame:
    return wh.raw(name[4:]) if name.startswith("raw_") else getattr(wh, name)


def eval_row_rules(wh: Warehouse, rules: Iterable[RowRule]) -> list[DataFrame]:
    """One aggregate per table: ``count_if(predicate)`` for all of its rules, unpivoted to report rows."""
    by_table: dict[str, list[RowRule]] = {}
    for r in rules:
        by_table.setdefault(r.table, []).append(r)
    out = []
    for t, rs in by_table.items():
        aggs = [F.count_if(F.coalesce(F.expr(r.predicate), F.lit(False))).alias(f"c{i}") for i, r in enumerate(rs)]
        counts = table(wh, t).agg(*aggs)
        stack = "stack({n}, {cells}) as (check_name, issue_count)".format(
            n=len(rs), cells=", ".join(f"'{r.name}', c{i}" for i, r in enumerate(rs)))
        out.append(counts.selectExpr(stack).withColumn("table_name", F.lit(t)))
    return out


def eval_key_rule(wh: Warehouse, r: KeyRule) -> DataFrame:
    df = table(wh, r.table)
    keys = list(r.keys)
    if r.mode == "dup_groups":
        nn = df
        if len(keys) == 1:  # dbt's unique test ignores NULL keys
            nn = df.filter(F.col(keys[0]).isNotNull())
        dup = nn.groupBy(*keys).count().filter(F.col("count") > 1)
        c = dup.agg(F.count(F.lit(1)).alias("issue_count"))
    else:
        # count(*) - count(distinct key): two-level aggregate, no Expand
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        nonnull = F.lit(True)
        for k in keys:
            nonnull = nonnull & F.col(k).isNotNull()
        c = per_key.agg((F.sum("n") - F.count_if(nonnull)).alias("issue_count"))
    return c.select(F.lit(r.name).alias("check_name"), F.lit(r.table).alias("table_name"),
                    F.coalesce(F.col("issue_count"), F.lit(0)).alias("issue_count"))


def _key_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows per key value, combined map-side: a hot key becomes one row per task before any join."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))


def eval_ref_rule(wh: Warehouse, r: RefRule) -> DataFrame:
    """Orphan child rows: child key counts LEFT ANTI parent keys, then summed."""
    child = table(wh, r.table).select(*r.column)
    if r.skip_null:
        for c in r.column:
            child = child.filter(F.col(c).isNotNull())
    parent = table(wh, r.parent).select(*[F.col(p).alias(c) for p, c in zip(r.parent_column, r.column)]).distinct()
    orphans = _key_counts(child, list(r.column)).join(parent, list(r.column), "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("issue_count")).select(
        F.lit(r.name).alias("check_name"), F.lit(r.table).alias("table_name"), "issue_count")


def eval_values_rules(wh: Warehouse, rules: Iterable[ValuesRule]) -> list[DataFrame]:
    """All accepted-values rules of a table in one pass: each rule's offending values are tagged with the
    rule, de-duplicated (map-side) and counted per rule."""
    by_table: dict[str, list[ValuesRule]] = {}
    for r in rules:
        by_table.setdefault(r.table, []).append(r)
    out = []
    for t, rs in by_table.items():
        df = table(wh, t)
        cells = [F.struct(F.lit(i).alias("r"),
                          F.when(F.col(r.column).isNotNull() & ~F.col(r.column).isin(list(r.values)),
                                 F.col(r.column).cast("string")).alias("v"))
                 for i, r in enumerate(rs)]
        bad = (df.select(F.explode(F.array(*cells)).alias("e")).select("e.r", "e.v")
               .filter(F.col("v").isNotNull()).distinct())
        counts = bad.agg(*[F.count_if(F.col("r") == i).alias(f"c{i}") for i in range(len(rs))])
        stack = "stack({n}, {cells}) as (check_name, issue_count)".format(
            n=len(rs), cells=", ".join(f"'{r.name}', c{i}" for i, r in enumerate(rs)))
        out.append(counts.selectExpr(stack).withColumn("table_name", F.lit(t)))
    return out


def _product_refs(wh: Warehouse) -> DataFrame:
    """Products whose aisle or department is missing (each product counted once)."""
    p = wh.raw("products")
    a = wh.raw("aisles").select("aisle_id").distinct().withColumn("_a", F.lit(1))
    d = wh.raw("departments").select("department_id").distinct().withColumn("_d", F.lit(1))
    j = p.join(small(a, wh.rows("dim_aisles")), "aisle_id", "left").join(small(d, wh.rows("dim_departments")),
                                                                        "department_id", "left")
    return j.agg(F.count_if(F.col("_a").isNull() | F.col("_d").isNull()).alias("issue_count")).select(
        F.lit("product_refs").alias("check_name"), F.lit("raw_products").alias("table_name"), "issue_count")


def _train_refs(wh: Warehouse) -> DataFrame:
    """Train items whose order or product is missing."""
    t = _key_counts(wh.raw("order_products_train"), ["order_id", "product_id"])
    o = wh.raw("orders").select("order_id").distinct().withColumn("_o", F.lit(1))
    p = wh.raw("products").select("product_id").distinct().withColumn("_p", F.lit(1))
    j = t.join(o, "order_id", "left").join(small(p, wh.rows("dim_products")), "product_id", "left")
    return j.agg(F.coalesce(F.sum(F.when(F.col("_o").isNull() | F.col("_p").isNull(), F.col("_n"))), F.lit(0))
                 .alias("issue_count")).select(
        F.lit("train_refs").alias("check_name"), F.lit("raw_order_products_train").alias("table_name"), "issue_count")


def _partition_consistency(wh: Warehouse) -> list[DataFrame]:
    """Prior items only on prior orders, train items only on train orders."""
    o = wh.raw("orders").select("order_id", "eval_set")
    out = []
    for s in ("prior", "train"):
        items = _key_counts(wh.raw(f"order_products_{s}"), ["order_id"])
        c = items.join(o, "order_id").agg(
            F.coalesce(F.sum(F.when(F.col("eval_set") != s, F.col("_n"))), F.lit(0)).alias("issue_count"))
        out.append(c.select(F.lit(f"partition_consistency_{s}").alias("check_name"),
                            F.lit(f"raw_order_products_{s}").alias("table_name"), "issue_count"))
    return out


def _key_report(wh: Warehouse) -> list[DataFrame]:
    """Mart orphans plus invalid reordered flags on the marts."""
    parts = [eval_ref_rule(wh, r) for r in dbt_relationship_rules()]
    parts += eval_row_rules(wh, [RowRule("invalid_reordered_fact_order_items", "fact_order_items",
                                         "reordered NOT IN (0, 1)")])
    return parts


def _tables_exist(wh: Warehouse) -> DataFrame:
    """Number of the six expected tables that have no source file.  A listing of paths: a missing table is counted,
    one that is there without rows is not, and no data is read."""
    return wh.spark.createDataFrame([("tables_exist", "catalog", len(wh.missing()))], "check_name string, table_name string, issue_count bigint")


def _null_breakdown(wh: Warehouse) -> DataFrame:
    """NULL gaps by order_number and NULL baskets by eval_set (informational rows)."""
    fo = wh.fact_order
    gaps = (fo.filter(F.col("days_since_prior_order").isNull()).groupBy("order_number").count()
            .select(F.concat(F.lit("null_gap_order_number_"), F.col("order_number").cast("string")).alias("check_name"),
                    F.lit("fact_order").alias("table_name"), F.col("count").alias("issue_count")))
    baskets = (fo.filter(F.col("basket_size").isNull()).groupBy("eval_set").count()
               .select(F.concat(F.lit("null_basket_eval_set_"), F.col("eval_set")).alias("check_name"),
                       F.lit("fact_order").alias("table_name"), F.col("count").alias("issue_count")))
    return gaps.unionByName(baskets).select("check_name", "table_name",
                                            F.col("issue_count").cast("bigint").alias("issue_count"),
                                            F.lit("INFO").alias("status"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def evaluate(wh: Warehouse, rules: list) -> list[DataFrame]:
    rows = [r for r in rules if isinstance(r, RowRule)]
    values = [r for r in rules if isinstance(r, ValuesRule)]
    parts = eval_row_rules(wh, rows) if rows else []
    parts += eval_values_rules(wh, values) if values else []
    for r in rules:
        if isinstance(r, KeyRule):
            parts.append(eval_key_rule(wh, r))
        elif isinstance(r, RefRule):
            parts.append(eval_ref_rule(wh, r))
    return parts


def _orphans(wh: Warehouse) -> list[DataFrame]:
    """Every anti-join orphan check -- mart relationships and raw references."""
    parts = [eval_ref_rule(wh, r) for r in dbt_relationship_rules()]
    parts += [eval_ref_rule(wh, r) for rs in raw_ref_rules().values() for r in rs]
    return parts + [_train_refs(wh), _product_refs(wh)]


SPECIAL: dict[str, Callable[[Warehouse], list[DataFrame]]] = {
    "dq_orphans": _orphans,
    "dq_all_matched": lambda wh: evaluate(wh, star_rules()["dq_star_refs"]),
    "dq_product_refs": lambda wh: [_product_refs(wh)],
    "dq_train_refs": lambda wh: [_train_refs(wh)],
    "dq_partition_consistency": _partition_consistency,
    "dq_key_report": _key_report,
    "dq_tables_exist": lambda wh: [_tables_exist(wh)],
}


def run_key(wh: Warehouse, key: str) -> DataFrame:
    """Report rows of one DQ key."""
    if key == "dq_null_breakdown":
        return _null_breakdown(wh)
    if key == "dq_ingestion_log":
        from trolley.sources.files import logged_checks
        return logged_checks(wh)
    parts = SPECIAL[key](wh) if key in SPECIAL else evaluate(wh, suite()[key])
    return _rows(_union(parts))


GATE_KEYS = (
    "dq_not_null", "dq_unique", "dq_accepted_values", "dq_relationships", "dq_cart_position", "dq_source_valid",
    "dq_dow_valid", "dq_hour_valid", "dq_pk_unique", "dq_item_pair_unique", "dq_required_not_null",
    "dq_positive_ids", "dq_names_not_blank", "dq_product_refs", "dq_prior_order_refs", "dq_prior_product_refs",
    "dq_train_refs", "dq_order_ranges", "dq_item_ranges", "dq_partition_consistency", "dq_star_pk",
    "dq_star_refs", "dq_rate_bounds", "dq_basket_positive", "dq_gap_null_iff_first", "dq_test_orders_empty",
    "dq_slot_complete",
)


def dq_report(wh: Warehouse) -> DataFrame:
    """All SQL-expressible checks in few passes over the tables (``quality_pass``)."""
    from trolley.operators.quality_pass import report

    return _rows(report(wh))


def report_by_rule(wh: Warehouse) -> DataFrame:
    """The same report rule by rule, as the single keys evaluate it."""
    rules: list = []
    special: list[DataFrame] = []
    for k in GATE_KEYS:
        if k in SPECIAL:
            special += SPECIAL[k](wh)
        else:
            rules += suite()[k]
    return _rows(_union(evaluate(wh, rules) + special))


def dq_gate(wh: Warehouse) -> DataFrame:
    """The report plus one ``gate`` row whose issue_count is the number of failed checks."""
    rep = wh.written("dq_report", dq_report(wh))  # evaluated once, read twice
    gate = rep.agg(F.count_if(F.col("status") == "FAIL").alias("issue_count")).select(
        F.lit("gate").alias("check_name"), F.lit("*").alias("table_name"), "issue_count")
    return rep.unionByName(_rows(gate))


def enforce(wh: Warehouse) -> DataFrame:
    """Run the gate and raise when any check failed (a non-zero exit for a pipeline)."""
    report = wh.written("dq_gate", dq_gate(wh))
    rows = report.collect()  # one row per check: bounded by the size of the suite
    failed = [r for r in rows if r.status == "FAIL" and r.check_name != "gate"]
    if failed:
        raise AssertionError("data quality failed: " + ", ".join(f"{r.check_name}={r.issue_count}" for r in failed))
    return report
