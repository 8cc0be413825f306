"""Column profiling of the six raw tables.

Each profile is one aggregate pass per table (all columns at once) and is
reshaped to long form with ``stack`` -- no per-column jobs, no driver loops
over data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.columns import safe_ratio
from trolley.functions.quantiles import exact_quantiles
from trolley.plans.warehouse import Warehouse
from trolley.sources.schemas import RAW_KEYS, RAW_TABLES, type_name


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _each(make: Callable[[str], DataFrame], names: Iterable[str]) -> list[DataFrame]:
    """``make`` for every table, the selections of several tables at the same time."""
    names = list(names)
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        return list(pool.map(make, names))


def profile_missing(wh: Warehouse) -> DataFrame:
    """Per column type, total, non-null, missing and missing % (2 dp)."""
    parts = []
    for t in RAW_TABLES:
        df = wh.raw(t)
        fields = df.schema.fields
        agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(f.name).alias(f"nn{i}") for i, f in enumerate(fields)])
        cells = [f"'{f.name}', '{type_name(f.dataType)}', nn{i}" for i, f in enumerate(fields)]
        long = agg.selectExpr("_n", f"stack({len(fields)}, {', '.join(cells)}) as (column_name, data_type, non_null)")
        parts.append(long.select(
            F.lit(t).alias("table_name"), "column_name", "data_type", F.col("_n").alias("total_rows"), "non_null",
            (F.col("_n") - F.col("non_null")).alias("missing"),
            F.round(safe_ratio(F.col("_n") - F.col("non_null"), F.col("_n")) * 100.0, 2).alias("missing_pct")))
    return _union(parts)


def profile_shape(wh: Warehouse) -> DataFrame:
    """T5: rows x columns per table."""
    return _union([wh.raw(t).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(t).alias("table_name"), "n_rows", F.lit(len(wh.raw(t).columns)).alias("n_columns"))
        for t in RAW_TABLES])


def profile_duplicates(wh: Warehouse) -> DataFrame:
    """Exact-row duplicates and key duplicates (keep-first: count - distinct count)."""
    parts = []
    for t in RAW_TABLES:
        df = wh.raw(t)
        keys = list(RAW_KEYS[t])
        rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n")).agg(
            (F.sum("n") - F.count(F.lit(1))).alias("duplicate_rows"))
        key_dups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(
            (F.sum("n") - F.count(F.lit(1)))).scalar()
        parts.append(rows.select(
            F.lit(t).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
            F.coalesce("duplicate_rows", F.lit(0)).cast("bigint").alias("duplicate_rows"),
            F.coalesce(key_dups, F.lit(0)).cast("bigint").alias("duplicate_keys")))
    return _union(parts)


# The four IQR-profiled measures (table, column).
IQR_COLUMNS = (("orders", "order_number"), ("orders", "days_since_prior_order"),
               ("order_products_prior", "add_to_cart_order"), ("order_products_train", "add_to_cart_order"))


def iqr_outliers(wh: Warehouse, columns=IQR_COLUMNS, k: float = 1.5) -> DataFrame:
    """T4/F8: Q1, Q3, IQR, Tukey fences and the count/% of values outside them (flagged, never removed).

    Exact linear-interpolated quartiles; all columns of a table share the scans of one selection and of one count.
    """
    by_table: dict[str, list[str]] = {}
    for t, c in columns:
        by_table.setdefault(t, []).append(c)

    def outside(t: str) -> DataFrame:
        df, cs = wh.raw(t), by_table[t]
        q = exact_quantiles(df, {c: [0.25, 0.75] for c in cs})
        lines, cells = [], []
        for i, c in enumerate(cs):
            q1, q3 = q[c, 0.25], q[c, 0.75]
            fences = (None, None, None) if q1 is None else (q3 - q1, q1 - k * (q3 - q1), q3 + k * (q3 - q1))
            x, (iqr, lower, upper) = F.col(c).cast("double"), fences
            cells.append((F.lit(0) if q1 is None else F.count_if((x < lower) | (x > upper))).cast("bigint").alias(f"o{i}"))
            numbers = [F.lit(v).cast("double").alias(n) for v, n in zip((q1, q3, iqr, lower, upper), ("q1", "q3", "iqr", "lower", "upper"))]
            lines.append(F.struct(F.lit(c).alias("column_name"), *numbers, F.col(f"o{i}").alias("outlier_count")))
        counts = df.agg(F.count(F.lit(1)).alias("_n"), *cells)
        return counts.select("_n", F.explode(F.array(*lines)).alias("x")).select(
            F.lit(t).alias("table_name"), "x.*", F.round(safe_ratio(F.col("x.outlier_count"), F.col("_n")) * 100.0, 2).alias("outlier_pct"))

    return _union(_each(outside, by_table))


_NUMERIC = ("int", "bigint", "double", "float", "smallint", "tinyint")


def describe_table(wh: Warehouse, table: str) -> DataFrame:
    """The described columns of one table: one selection for all quartiles, one grouping of all (column, value) pairs
    for ``unique``, ``top`` and ``freq`` (combined in each task first), one aggregate for counts and moments."""
    df = wh.raw(table)
    fields = df.schema.fields
    kinds = {f.name: type_name(f.dataType) for f in fields}
    q = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c, k in kinds.items() if k in _NUMERIC})
    # one slot per kind of value keeps numbers in number order
    slot = {c: "d" if k in ("double", "float") else "l" if k in _NUMERIC else "s" for c, k in kinds.items()}

    def cell(i: int, c: str) -> F.Column:
        held = {"l": F.lit(None).cast("bigint"), "d": F.lit(None).cast("double"), "s": F.lit(None).cast("string")}
        held[slot[c]] = F.col(c).cast({"l": "bigint", "d": "double", "s": "string"}[slot[c]])
        return F.when(F.col(c).isNotNull(), F.struct(F.lit(i).alias("i"), *[v.alias(n) for n, v in held.items()]))

    values = (df.select(F.explode(F.array(*[cell(i, f.name) for i, f in enumerate(fields)])).alias("v")).where("v IS NOT NULL")
              .groupBy("v.i", "v.l", "v.d", "v.s").agg(F.count(F.lit(1)).alias("n")))
    # the most frequent value; of equals the smallest
    first = F.min(F.struct((-F.col("n")).alias("n"), "l", "d", "s"))
    tops = values.groupBy("i").agg(F.count(F.lit(1)).alias("unique"), first.alias("first"))
    x = {f.name: F.col(f.name).cast("double") for f in fields}
    stats, lines = [], []
    for i, f in enumerate(fields):
        c, numeric = f.name, kinds[f.name] in _NUMERIC
        stats += [F.count(c).alias(f"n{i}")] + ([F.avg(x[c]).alias(f"m{i}"), F.stddev_samp(x[c]).alias(f"s{i}"), F.min(x[c]).alias(f"lo{i}"), F.max(x[c]).alias(f"hi{i}")] if numeric else [])
        nul = F.lit(None).cast("double")
        lines.append(F.struct(
            F.lit(i).alias("i"), F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"),
            *[(F.round(F.col(f"{a}{i}"), 6) if numeric else nul).alias(n) for a, n in (("m", "mean"), ("s", "std"))],
            (F.col(f"lo{i}") if numeric else nul).alias("min"),
            *[F.lit(q.get((c, p))).cast("double").alias(n) for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))],
            (F.col(f"hi{i}") if numeric else nul).alias("max")))
    described = df.agg(*stats).select(F.explode(F.array(*lines)).alias("x")).select("x.*")
    top = F.coalesce(F.col("first.l").cast("string"), F.col("first.d").cast("string"), F.col("first.s"))
    return (described.join(F.broadcast(tops), "i", "left")  # one row a column
            .select(F.lit(table).alias("table_name"), "column_name", "count", F.coalesce("unique", F.lit(0)).alias("unique"), top.alias("top"),
                    (-F.col("first.n")).alias("freq"), "mean", "std", "min", "q25", "q50", "q75", "max"))


def profile_describe(wh: Warehouse) -> DataFrame:
    """describe(include='all') of all six tables in long form: count, unique, top, freq, mean, std, min, quartiles, max."""
    return _union(_each(lambda t: describe_table(wh, t), RAW_TABLES))
