"""Sources and sinks (S1-S23): CSV landing, typed/inferred ingest, writers, subset export,
keyed upsert, bulk copy and the ingestion log.

All paths live under the warehouse root (inside the shared work folder), so
every write is visible to every executor and survives executor loss.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.plans.warehouse import Warehouse
from trolley.sources import store
from trolley.sources.schemas import RAW_KEYS, RAW_SCHEMAS, RAW_TABLES

# ----------------------------------------------------------------- landing / ingest

# All CSV is RFC 4180: header row, '"' quotes, quotes inside values doubled.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def csv_reader(spark: SparkSession):
    return spark.read.options(**CSV_OPTIONS)


def land_csv(wh: Warehouse) -> str:
    """Write the six raw tables as headed CSV files (the landing zone the loaders read)."""
    base = wh.path("landing", "csv")
    with wh._name_lock("_landed"):
        if not getattr(wh, "_landed", False):
            for t in RAW_TABLES:
                write_csv(wh.raw(t), f"{base}/{t}")
            wh._landed = True
    return base


def require_sources(spark: SparkSession, paths: dict[str, str]) -> None:
    """S3: fail listing *every* missing source before reading any of them."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for name, p in paths.items():
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if not hp.getFileSystem(conf).exists(hp):
            missing.append(f"{name} ({p})")
    if missing:
        raise FileNotFoundError("missing required sources: " + ", ".join(missing))


def ingest_infer(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header, types inferred (one extra pass over the file)."""
    return csv_reader(spark).option("inferSchema", True).csv(path)


def ingest_typed(spark: SparkSession, path: str, table: str) -> DataFrame:
    """CSV with the declared schema (no inference pass); a malformed cell fails the job, empty cells and
    ``NaN`` are NULL."""
    return ingest_file(spark, path, table)


def ingest_file(spark: SparkSession, path: str, table: str, file_format: str = "csv",
                mode: str = "FAILFAST") -> DataFrame:
    """Typed ingest of one source file; double columns map ``NaN`` to NULL (never store NaN)."""
    schema = RAW_SCHEMAS[table]
    if file_format == "csv":
        # RFC 4180 quoting: names may contain commas and doubled quotes
        df = (csv_reader(spark).option("mode", mode).option("nullValue", "")
              .option("nanValue", "NaN").schema(schema).csv(path))
    else:
        df = spark.read.format(file_format).load(path).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return df.select(*[
        (F.when(~F.isnan(f.name), F.col(f.name)) if f.dataType.simpleString() == "double" else F.col(f.name))
        .alias(f.name) for f in schema.fields])


def load_raw(wh: Warehouse, typed: bool = True) -> dict[str, DataFrame]:
    """Read all six landed tables after checking they all exist."""
    base = land_csv(wh)
    paths = {t: f"{base}/{t}" for t in RAW_TABLES}
    require_sources(wh.spark, paths)
    if typed:
        return {t: ingest_typed(wh.spark, p, t) for t, p in paths.items()}
    return {t: ingest_infer(wh.spark, p) for t, p in paths.items()}


def ingest_row_counts(wh: Warehouse) -> DataFrame:
    """Rows per table in the source itself (not in the loaded copy)."""
    return _counts({t: wh.source(t) for t in RAW_TABLES}, "row_count")


def _counts(tables: dict[str, DataFrame], name: str) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias(name)).select(F.lit(t).alias("table_name"), name) for t, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_reconciliation(wh: Warehouse) -> DataFrame:
    """Source vs warehouse (loaded) row counts per table with PASS/FAIL."""
    src = ingest_row_counts(wh).withColumnRenamed("row_count", "source_rows")
    loaded = _counts({t: wh.raw(t) for t in RAW_TABLES}, "loaded_rows")
    return src.join(loaded, "table_name", "full").select(
        "table_name", "source_rows", "loaded_rows",
        F.when(F.col("source_rows") == F.col("loaded_rows"), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"))


# ----------------------------------------------------------------------------- sinks


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S9."""
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", null_value: str = "",
              compression: str | None = None) -> None:
    """Headed CSV; NULL written as ``null_value`` (never ``NaN``); optional codec."""
    w = df.write.mode(mode).options(**CSV_OPTIONS).option("nullValue", null_value)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def read_back_parquet(wh: Warehouse, name: str = "dim_product") -> DataFrame:
    """S9 + S19: write a mart as Parquet and read it back."""
    out = wh.path("export", f"{name}.parquet")
    write_parquet(getattr(wh, name), out)
    return wh.spark.read.parquet(out)


def write_tables(wh: Warehouse) -> DataFrame:
    """S9 + S19: each of the six cleaned tables as Parquet, read back: rows, and nulls over all columns."""
    parts = []
    for t in RAW_TABLES:
        out = wh.path("export", f"clean/{t}.parquet")
        write_parquet(wh.raw(t), out)
        back = wh.spark.read.parquet(out)
        nulls = [F.count_if(F.col(c).isNull()) for c in back.columns]
        parts.append(back.agg(F.count(F.lit(1)).alias("row_count"), sum(nulls[1:], nulls[0]).alias("null_count"))
                     .select(F.lit(t).alias("table_name"), "row_count", "null_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_back_csv(wh: Warehouse, name: str = "dim_user") -> DataFrame:
    """S10 + S19: write a mart as CSV (blank NULLs) and read it back with its schema."""
    df = getattr(wh, name)
    out = wh.path("export", f"{name}.csv")
    write_csv(df, out)
    return csv_reader(wh.spark).option("nullValue", "").schema(df.schema).csv(out)


def append_items(wh: Warehouse) -> DataFrame:
    """Write prior items, append train items to the same folder, read the union back."""
    out = wh.path("export", "fact_order_item.csv")
    cols = ["order_id", "product_id", "add_to_cart_order", "reordered"]
    write_csv(wh.stg_order_products_prior.select(*cols), out, mode="overwrite")
    write_csv(wh.stg_order_products_train.select(*cols), out, mode="append")
    schema = "order_id bigint, product_id int, add_to_cart_order int, reordered int"
    return csv_reader(wh.spark).schema(schema).csv(out)


def export_user_subset(wh: Warehouse, max_user_id: int = 20_000, compression: str | None = None) -> DataFrame:
    """Consistent six-table subset -- users <= N, only their orders and items, full catalogue.

    Items are restricted with a semi join on the exported orders, so the
    subset is referentially closed.  Returns the exported row counts (read
    back from the written files).
    """
    base = wh.path("export", f"subset_{max_user_id}")
    orders = wh.raw("orders").filter(F.col("user_id") <= max_user_id)
    keep = orders.select("order_id")
    tables = {
        "aisles": wh.raw("aisles"),
        "departments": wh.raw("departments"),
        "products": wh.raw("products"),
        "orders": orders,
        "order_products_prior": wh.raw("order_products_prior").join(keep, "order_id", "left_semi"),
        "order_products_train": wh.raw("order_products_train").join(keep, "order_id", "left_semi"),
    }
    parts = []
    for t, df in tables.items():
        write_csv(df, f"{base}/{t}", compression=compression)
        back = csv_reader(wh.spark).schema(RAW_SCHEMAS[t]).csv(f"{base}/{t}")
        parts.append(back.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -------------------------------------------------------------------------- upsert


def upsert(existing: DataFrame, batch: DataFrame, keys: list[str], order_col: str | None = None) -> DataFrame:
    """Merge ``batch`` into ``existing`` by ``keys`` (merge-duplicates, last wins).

    Within the batch the last row per key wins: ``max(struct(order_col,
    payload...))`` per key is an ordinary aggregate with map-side partial
    aggregation, so many copies of one key collapse inside each task
    before the shuffle (ties on ``order_col`` resolve on the payload, so
    the result is deterministic).  The result is the existing rows whose
    key is not in the batch plus the de-duplicated batch.
    """
    cols = list(existing.columns)
    payload = [c for c in cols if c not in keys]
    b = last_per_key(batch, keys, payload, order_col)
    return existing.join(b.select(*keys), keys, "left_anti").select(*cols).unionByName(b.select(*cols))


def last_per_key(df: DataFrame, keys: list[str], payload: list[str], order_col: str | None) -> DataFrame:
    """One row per key: the one with the highest ``order_col`` (then highest payload) -- skew-safe aggregate."""
    order = [order_col] if order_col else []
    best = F.max(F.struct(*[F.col(c) for c in order + payload])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in order + payload])


def upsert_merge(wh: Warehouse) -> DataFrame:
    """Merge a later extract (composite key) into a keyed table of the prior items: the train items are new, the first
    item of each prior order has a corrected flag, and all other rows stay as they are."""
    from pyspark.sql import types as T

    from trolley.sources.keyed import KeyedTable
    from trolley.streaming.incremental import order_width

    cols = ["order_id", "product_id", "add_to_cart_order", "reordered"]
    existing = wh.stg_order_products_prior.select(*cols)
    corrected = existing.filter(F.col("add_to_cart_order") == 1).withColumn("reordered", 1 - F.col("reordered"))
    schema = T.StructType([RAW_SCHEMAS["order_products_prior"][c] for c in cols])
    table = KeyedTable(wh.spark, wh.path("upsert", f"items-{uuid.uuid4().hex[:8]}"), ["order_id", "product_id"], schema, order_width(wh))
    table.merge(existing, "extracts", 0)
    table.merge(wh.stg_order_products_train.select(*cols).unionByName(corrected), "extracts", 1)
    return table.read()


# ----------------------------------------------------------------------- bulk copy


def table_copy(wh: Warehouse, table: str = "orders", batch_rows: int = 100_000) -> DataFrame:
    """Warehouse-to-warehouse copy in files of at most ``batch_rows``: rows whose key the target already
    holds stay, the others are appended (nothing is overwritten)."""
    out, keys = wh.path("copy", table), list(RAW_KEYS[table])
    rows = wh.raw(table)
    try:
        rows = rows.join(wh.spark.read.parquet(out).select(*keys), keys, "left_anti").select(*rows.columns)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    rows.write.mode("append").option("maxRecordsPerFile", batch_rows).parquet(out)
    return wh.spark.read.parquet(out)


# ------------------------------------------------------------------- ingestion log

LOG_SCHEMA = ("run_id string, table_name string, status string, actual_rows bigint, expected_rows bigint, "
              "completed_at timestamp")


def load_run(wh: Warehouse, expected: dict[str, int] | None = None) -> str:
    """Load the six raw tables and log the run, one row a table.

    expected_rows are the rows that the source gave, counted by the write of the table itself (or ``expected``);
    actual_rows those that the written table holds.  A table that can't be loaded is logged as FAILED, the others are
    still loaded, and the first error is raised after the log is written."""
    run_id, rows, failed = uuid.uuid4().hex, [], None
    for t in RAW_TABLES:
        actual = given = None
        try:
            wh.raw(t)
            actual = wh.rows_raw(t)
            given = wh.source_rows(t)
        except Exception as e:
            failed = failed or e
        exp = (expected or {}).get(t, given if given is not None or actual is None else actual)
        done = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        rows.append((run_id, t, "SUCCESS" if actual is not None and exp == actual else "FAILED", actual, exp, done))
    wh.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(wh.path("meta", "ingestion_log"))
    if failed is not None:
        raise failed
    return run_id


def loaded(wh: Warehouse) -> None:
    """Load the raw tables unless a run over the present sources has been logged."""
    with wh._name_lock("_load_run"):
        if not store.exists(wh.spark, wh.path("meta", "ingestion_log")):
            load_run(wh)


def ingestion_log(wh: Warehouse) -> DataFrame:
    """Latest run of the log."""
    df = wh.spark.read.schema(LOG_SCHEMA).parquet(wh.path("meta", "ingestion_log"))
    latest = df.agg(F.max_by("run_id", "completed_at").alias("run_id"))
    return df.join(F.broadcast(latest), "run_id", "left_semi")


def logged_tables(wh: Warehouse) -> DataFrame:
    """The latest run's tables: what the load noted, without its random id and its times."""
    loaded(wh)
    return ingestion_log(wh).select("table_name", "status", "actual_rows", "expected_rows",
                                    (F.length("run_id") == 32).alias("has_run_id"), F.col("completed_at").isNotNull().alias("completed"))


def logged_checks(wh: Warehouse) -> DataFrame:
    """D23 over the log of the warehouse's own load."""
    loaded(wh)
    return check_ingestion_log(wh)


def check_ingestion_log(wh: Warehouse) -> DataFrame:
    """The latest run has six rows, six tables, no failed table and no count mismatch.  Only reads the log."""
    latest = ingestion_log(wh)
    agg = latest.agg(
        (F.lit(len(RAW_TABLES)) - F.count(F.lit(1))).alias("log_row_count"),
        (F.lit(len(RAW_TABLES)) - F.count_distinct("table_name")).alias("log_table_count"),
        F.count_if(F.col("status") != "SUCCESS").alias("log_failed_tables"),
        F.count_if(~F.col("actual_rows").eqNullSafe(F.col("expected_rows"))).alias("log_count_mismatch"),
    )
    long = agg.selectExpr("stack(4, 'log_row_count', log_row_count, 'log_table_count', log_table_count, "
                          "'log_failed_tables', log_failed_tables, 'log_count_mismatch', log_count_mismatch) "
                          "as (check_name, issue_count)")
    return long.select("check_name", F.lit("ingestion_log").alias("table_name"),
                       F.abs(F.col("issue_count")).cast("bigint").alias("issue_count"),
                       F.when(F.col("issue_count") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"))


# ------------------------------------------------------------------ catalogue / contracts


def catalog_listing(wh: Warehouse, built: bool = False) -> DataFrame:
    """Name, type and columns of the six source tables as the session's catalogue knows them, and their rows.

    Registers views of the sources and reads the catalogue; nothing is written or built.  A table without a source
    file is left out.  With ``built`` also the tables that this warehouse has written so far (rows not counted)."""
    gone = set(wh.missing())
    here = [t for t in RAW_TABLES if t not in gone]
    for t in here:
        wh.source(t).createOrReplaceTempView(f"raw_{t}")
    catalogue = wh.spark.catalog
    lines = []
    for t in (catalogue.getTable(f"raw_{t}") for t in here):
        lines.append((t.name, t.tableType, t.isTemporary, len(catalogue.listColumns(t.name))))
    if built:
        lines += [(t.name, t.tableType, t.isTemporary, len(catalogue.listColumns(t.name))) for t in catalogue.listTables(pattern=f"{wh._table_prefix}*")]
    names = wh.spark.createDataFrame(lines, "table_name string, table_type string, is_temporary boolean, n_columns int")
    if not here:
        return names.withColumn("row_count", F.lit(None).cast("bigint"))
    counts = _counts({f"raw_{t}": wh.spark.table(f"raw_{t}") for t in here}, "row_count")
    return names.join(F.broadcast(counts), "table_name", "left")  # one row a table


def schema_contract(wh: Warehouse, expected=None) -> DataFrame:
    """Declared column -> type map vs what the loaded tables carry (missing, extra, mismatched), with the
    number of non-null values that each column really holds."""
    expected = expected or RAW_SCHEMAS
    parts = []
    for t in RAW_TABLES:
        df = wh.raw(t)
        actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        exp = {f.name: f.dataType.simpleString() for f in expected[t].fields}
        names = sorted(set(actual) | set(exp))
        held = df.agg(*[(F.count(c) if c in actual else F.lit(0)).cast("bigint").alias(f"n{i}") for i, c in enumerate(names)])
        lines = [F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.lit(exp.get(c)).cast("string").alias("expected_type"),
                          F.lit(actual.get(c)).cast("string").alias("actual_type"), F.lit("PASS" if actual.get(c) == exp.get(c) else "FAIL").alias("status"),
                          F.col(f"n{i}").alias("values")) for i, c in enumerate(names)]
        parts.append(held.select(F.explode(F.array(*lines)).alias("x")).select("x.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_count_contract(wh: Warehouse, expected: dict[str, int] | None = None) -> DataFrame:
    """Exact expected row counts (default: the source's own counts) vs the loaded tables."""
    src = expected
    if src is None:
        src = {r.table_name: r.row_count for r in ingest_row_counts(wh).collect()}  # six rows
    exp = wh.spark.createDataFrame(list(src.items()), "table_name string, expected_rows bigint")
    act = _counts({t: wh.raw(t) for t in RAW_TABLES}, "actual_rows")
    return exp.join(act, "table_name", "full").select(
        "table_name", "expected_rows", "actual_rows",
        F.when(F.col("expected_rows") == F.col("actual_rows"), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"))


def coerce_landed(wh: Warehouse, table: str = "orders", strict: bool = False) -> DataFrame:
    """Read a landed CSV as text (no inference) and convert each column to its declared type.

    Lenient: blank/malformed/``NaN`` text becomes NULL (``try_cast``).
    Strict: ANSI ``cast`` -- one malformed value fails the job.
    """
    from trolley.plans.staging import coerce_lenient, coerce_strict

    schema = RAW_SCHEMAS[table]
    text = ", ".join(f"{f.name} string" for f in schema.fields)
    df = csv_reader(wh.spark).schema(text).csv(f"{land_csv(wh)}/{table}")
    for f in schema.fields:
        ty = f.dataType.simpleString()
        if ty == "string":
            continue
        df = coerce_strict(df, f.name, ty) if strict else coerce_lenient(df, f.name, ty)
    return df
