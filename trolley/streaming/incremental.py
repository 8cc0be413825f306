"""Incremental variants of the heaviest aggregates (I1-I3) on Structured Streaming.

Sources are file drops in the shared work folder; every query runs with
``Trigger.AvailableNow`` (drain what has arrived, then stop), a
``checkpointLocation`` (offsets + state, so a restarted job resumes where
it stopped) and ``maxFilesPerTrigger`` (bounded micro-batches).

* I1 ``stream_product_counts`` -- running purchase/reorder totals:
  a streaming ``groupBy`` whose state lives in the state store.
* I2 ``stream_pair_counts`` -- pair counts where an order's items can
  arrive in different files.  ``foreachBatch`` keeps the top-k items seen so
  far in a keyed table with ranges of order ids, and pairs a batch's new items
  with each other and with the earlier items of the *same orders*.  Only the
  ranges that the batch touches are read and written, so the bytes a batch
  reads follow the batch and not the history.  Running counts are at most
  k(k-1)/2 rows, a version a batch.
* I3 ``stream_upsert`` -- keyed last-wins upsert of a change feed into a
  keyed table: a batch rewrites the ranges it touches.
* ``load_tables`` -- all six tables loaded from their change feeds into keyed
  tables, by the conflict key of each, with a ledger of batches.

Replays: a keyed table's manifest holds the last batch that it has merged, so
a batch that runs again after a crash is skipped or done over, never counted
twice.
"""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.operators.affinity import AFFINITY_PRODUCTS, top_k_products
from trolley.plans.warehouse import Warehouse
from trolley.sources import store
from trolley.sources.keyed import KeyedTable, Merge, width_for
from trolley.sources.schemas import RAW_KEYS, RAW_SCHEMAS, RAW_TABLES

ITEM_SCHEMA = "order_id bigint, product_id int, add_to_cart_order int, reordered int"

# Micro-batch bound: files per trigger (the file source's default is unbounded).
FILES_PER_TRIGGER = 1000


FILE_BYTES = 64 << 20


def drop_items(wh: Warehouse, least: int = 8) -> str:
    """Land the item fact as Parquet files of about ``FILE_BYTES`` of input each (at least ``least`` files), cut by
    position in order of (order_id, product_id): an order can straddle two files."""
    files = max(least, -(-wh.input_bytes() // FILE_BYTES))
    path = wh.path("drop", "items")
    with wh._name_lock("_items_dropped"):
        if not getattr(wh, "_items_dropped", False):
            wh.fact_order_item.repartitionByRange(files, "order_id", "product_id").write.mode("overwrite").parquet(path)
            wh._items_dropped = True
    return path


def order_width(wh: Warehouse) -> int:
    """Order ids per range of a keyed table of orders or items."""
    first, last = wh.raw("orders").agg(F.min("order_id"), F.max("order_id")).first()
    return width_for(first or 0, last or 0, wh.input_bytes())


def _stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def _latest(spark: SparkSession, base: str) -> DataFrame | None:
    """The newest committed version under ``base``: the highest ``v=<batch id>`` folder whose write
    committed (has ``_SUCCESS``).  Listing is metadata only."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    versions = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            versions.append(int(name[2:]))
    return spark.read.parquet(f"{base}/v={max(versions)}") if versions else None


def _version(spark: SparkSession, base: str, v: int) -> DataFrame | None:
    """Version ``v`` (the state a batch starts from is version batch_id - 1, so replays are idempotent)."""
    path = f"{base}/v={v}"
    return spark.read.parquet(path) if v >= 0 and store.exists(spark, path) else None


def _commit(spark: SparkSession, df: DataFrame, base: str, batch_id: int) -> None:
    """Write version ``batch_id``; overwrite makes a replayed batch idempotent."""
    df.write.mode("overwrite").parquet(f"{base}/v={batch_id}")


# ---------------------------------------------------------------------------- I1


def stream_product_counts(wh: Warehouse, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Running per-product purchase and reorder totals; equals ``product_metrics`` counts when drained."""
    spark = wh.spark
    src = _stream(spark, drop_items(wh), ITEM_SCHEMA, files_per_trigger)
    agg = src.groupBy("product_id").agg(F.count(F.lit(1)).alias("purchase_count"),
                                        F.sum("reordered").cast("bigint").alias("reordered_count"))
    out = wh.path("stream", "product_counts")

    def sink(batch: DataFrame, batch_id: int) -> None:  # complete mode: each batch is the full table
        _commit(batch.sparkSession, batch, out, batch_id)

    q = (agg.writeStream.outputMode("complete").foreachBatch(sink)
         .option("checkpointLocation", wh.path("checkpoints", "product_counts"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return _latest(spark, out)


# ---------------------------------------------------------------------------- I2


def seen_items(wh: Warehouse, k: int) -> KeyedTable:
    """The (order, product) pairs that ``stream_pair_counts`` has met."""
    schema = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("product_id", T.IntegerType())])
    return KeyedTable(wh.spark, wh.path("stream", f"pairs_seen{k}"), ["order_id", "product_id"], schema, order_width(wh))


def stream_pair_counts(wh: Warehouse, k: int = AFFINITY_PRODUCTS, files_per_trigger: int = FILES_PER_TRIGGER,
                       on_batch=None) -> DataFrame:
    """Unordered pair counts among the top-k products, correct when orders straddle files.

    ``on_batch`` is called with each batch's id, its rows' ranges and the earlier rows read for them."""
    spark = wh.spark
    top = top_k_products(wh, k).select("product_id")
    top_path = wh.path("stream", f"pairs_top{k}")
    if not store.exists(spark, f"{top_path}/_SUCCESS"):  # k rows, fixed at the first start: counts and seen items refer to it
        top.write.mode("overwrite").parquet(top_path)
    seen = seen_items(wh, k)
    counts_base, new_base = wh.path("stream", f"pairs_counts{k}"), wh.path("stream", f"pairs_new{k}")

    def step(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        if seen.merged_up_to("items") >= batch_id:  # merged before a crash, and so counted
            return
        universe = F.broadcast(s.read.parquet(top_path))  # k rows
        arrived = batch.select("order_id", "product_id").join(universe, "product_id", "left_semi").distinct()
        touched = seen.touched(arrived)
        earlier = seen.read(touched)
        arrived.join(earlier, ["order_id", "product_id"], "left_anti").write.mode("overwrite").parquet(f"{new_base}/b={batch_id}")
        new = s.read.schema(seen.schema).parquet(f"{new_base}/b={batch_id}")  # a replayed item is not new
        if on_batch:
            on_batch(batch_id, touched, earlier)
        x = new.select("order_id", F.col("product_id").alias("x"))
        y = new.withColumn("old", F.lit(False)).unionByName(earlier.withColumn("old", F.lit(True)))
        fresh = (x.join(y.withColumnRenamed("product_id", "y"), "order_id").where("old OR x < y")
                 .select(F.least("x", "y").alias("product_a_id"), F.greatest("x", "y").alias("product_b_id"))
                 .groupBy("product_a_id", "product_b_id").agg(F.count(F.lit(1)).alias("pair_order_count")))
        prev = _version(s, counts_base, batch_id - 1)
        total = fresh if prev is None else prev.unionByName(fresh).groupBy("product_a_id", "product_b_id").agg(
            F.sum("pair_order_count").cast("bigint").alias("pair_order_count"))
        _commit(s, total, counts_base, batch_id)
        seen.merge(new, "items", batch_id, touched=touched)  # last: from here on the batch counts as done
        store.delete(s, f"{new_base}/b={batch_id}")

    src = _stream(spark, drop_items(wh), ITEM_SCHEMA, files_per_trigger)
    q = (src.writeStream.foreachBatch(step)
         .option("checkpointLocation", wh.path("checkpoints", f"pair_counts{k}"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return _latest(spark, counts_base)


# ---------------------------------------------------------------------------- I3


def drop_order_changes(wh: Warehouse, least: int = 8) -> str:
    """A change feed of orders in two extracts: an early one (gap not yet known, seq 1), then the final rows (seq 2);
    files hold ranges of order ids, about ``FILE_BYTES`` of input each."""
    path = wh.path("drop", "order_changes")
    files = max(least, -(-wh.input_bytes() // FILE_BYTES))
    with wh._name_lock("_changes_dropped"):
        if not getattr(wh, "_changes_dropped", False):
            o = wh.stg_orders.repartitionByRange(files, "order_id")
            early = o.withColumn("days_since_prior_order", F.lit(None).cast("double")).withColumn("_seq", F.lit(1))
            final = o.withColumn("_seq", F.lit(2))
            early.write.mode("overwrite").parquet(f"{path}/part=1")
            final.write.mode("overwrite").parquet(f"{path}/part=2")
            wh._changes_dropped = True
    return path


def upserted_orders(wh: Warehouse) -> KeyedTable:
    """The target of ``stream_upsert``."""
    schema = T.StructType([*RAW_SCHEMAS["orders"].fields, T.StructField("_seq", T.IntegerType())])
    return KeyedTable(wh.spark, wh.path("stream", "orders_upsert"), ["order_id"], schema, order_width(wh))


def stream_upsert(wh: Warehouse, files_per_trigger: int = FILES_PER_TRIGGER, on_merge=None) -> DataFrame:
    """Keyed (order_id) last-wins upsert of the change feed; resumable and replay-safe.

    A batch rewrites only the ranges of order ids that it touches.  Of rows with one key the highest ``_seq`` stays, so
    the result does not depend on the order of files.  ``on_merge`` is called with each batch's ``Merge``."""
    spark = wh.spark
    table = upserted_orders(wh)

    def step(batch: DataFrame, batch_id: int) -> None:
        done = table.merge(batch, "changes", batch_id, order_col="_seq")
        if on_merge:
            on_merge(done)

    src = _stream(spark, drop_order_changes(wh), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema.fields) + ", part int", files_per_trigger)
    q = (src.writeStream.foreachBatch(step)
         .option("checkpointLocation", wh.path("checkpoints", "orders_upsert"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return table.read().drop("_seq")


# ---------------------------------------------------------------------------- resumable load of the six tables

EXTRACTS = 3
FEED_BYTES = 256 << 20
SMALL_FILES = 16


def feed_files(total_bytes: int, least: int) -> int:
    """Files of an extract: of ``FILE_BYTES`` of input each up to ``SMALL_FILES``, then larger ones up to ``FEED_BYTES``, so
    that a batch of a few files has work for all cores and the number of batches stays low."""
    return max(least, -(-total_bytes // FEED_BYTES), min(SMALL_FILES, -(-total_bytes // FILE_BYTES)))


def land_changes(wh: Warehouse, least: int = 2) -> str:
    """The change feeds of the six raw tables as headed CSV files, three extracts each: first every second key with only
    its key known, then the other rows, then the first ones' right values."""
    from trolley.sources.files import write_csv

    base = wh.path("landing", "changes")
    files = feed_files(wh.input_bytes(), least)
    with wh._name_lock("_changes_landed"):
        if not getattr(wh, "_changes_landed", False):
            for t in RAW_TABLES:
                keys = list(RAW_KEYS[t])
                # put in order once for the three extracts
                rows = wh.raw(t).repartitionByRange(files, *keys).persist(StorageLevel.DISK_ONLY)
                early = sum((F.col(k) for k in keys[1:]), F.col(keys[0])) % 2 == 0
                known = [F.col(f.name) if f.name in keys else F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_SCHEMAS[t].fields]
                try:
                    for n, part in enumerate((rows.where(early).select(*known), rows.where(~early), rows.where(early)), 1):
                        write_csv(part, f"{base}/{t}/_seq={n}")
                finally:
                    rows.unpersist()
            wh._changes_landed = True
    return base


def loaded_table(wh: Warehouse, table: str) -> KeyedTable:
    """The target of a table's load; its key is the table's conflict key."""
    keys = list(RAW_KEYS[table])
    schema = T.StructType([*RAW_SCHEMAS[table].fields, T.StructField("_seq", T.IntegerType())])
    if keys[0] == "order_id":
        width = order_width(wh)
    else:
        first, last = wh.raw(table).agg(F.min(keys[0]), F.max(keys[0])).first()
        width = width_for(first or 0, last or 0, wh.input_bytes())
    return KeyedTable(wh.spark, wh.path("loaded", f"keyed/{table}"), keys, schema, width)


class Ledger:
    """What each batch of a load has done: one small file when a batch starts and one when it is merged, never changed."""

    SCHEMA = "table_name string, batch bigint, first_key bigint, last_key bigint, row_count bigint, status string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _write(self, table: str, batch: int, status: str, keys: dict[int, tuple[int, int, int]]) -> None:
        final = f"{self.path}/{table}/{batch:08d}-{status}.json"
        if store.exists(self.spark, final):  # a replayed batch
            return
        line = {"table_name": table, "batch": batch, "first_key": min((f for f, _, _ in keys.values()), default=None),
                "last_key": max((x for _, x, _ in keys.values()), default=None), "row_count": sum(n for _, _, n in keys.values()), "status": status}
        store.write_text(self.spark, f"{self.path}/{table}/.{batch:08d}-{status}", final, json.dumps(line))

    def started(self, table: str, batch: int, keys: dict[int, tuple[int, int, int]]) -> None:
        self._write(table, batch, "loading", keys)

    def done(self, table: str, batch: int, keys: dict[int, tuple[int, int, int]]) -> None:
        self._write(table, batch, "merged", keys)

    def read(self) -> DataFrame:
        """One row per table and batch: the range of its leading keys, its rows, and 'merged' or (begun only) 'loading'."""
        lines = self.spark.read.schema(self.SCHEMA).json(f"{self.path}/*/*.json")
        return lines.groupBy("table_name", "batch", "first_key", "last_key", "row_count").agg(F.max("status").alias("status"))


def load_ledger(wh: Warehouse) -> Ledger:
    return Ledger(wh.spark, wh.path("meta", "load_ledger"))


def start_load(wh: Warehouse, table: str, files_per_trigger: int = FILES_PER_TRIGGER):
    """Start a table's load: micro-batches of its change feed, merged by its conflict key, each noted in the ledger."""
    from trolley.sources.files import CSV_OPTIONS

    target, ledger = loaded_table(wh, table), load_ledger(wh)

    def step(batch: DataFrame, batch_id: int) -> None:
        keys = target.touched(batch)
        ledger.started(table, batch_id, keys)
        target.merge(batch, "changes", batch_id, order_col="_seq", touched=keys)
        ledger.done(table, batch_id, keys)

    src = (wh.spark.readStream.schema(target.schema).options(**CSV_OPTIONS).option("nullValue", "")
           .option("maxFilesPerTrigger", files_per_trigger).csv(f"{land_changes(wh)}/{table}"))
    return (src.writeStream.foreachBatch(step).option("checkpointLocation", wh.path("checkpoints", f"keyed_{table}"))
            .trigger(availableNow=True).start())


def load_all(wh: Warehouse, files_per_trigger: int = FILES_PER_TRIGGER) -> None:
    """Drain the six feeds.  A load that failed goes on at its first unmerged batch when called again."""
    land_changes(wh)
    running = [start_load(wh, t, files_per_trigger) for t in RAW_TABLES]
    failed = []
    for q in running:
        try:
            q.awaitTermination()
        except Exception as e:  # the others go on to their end
            failed.append(e)
    if failed:
        raise failed[0]


def load_tables(wh: Warehouse, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """S14 + S15: the six tables as their loads have merged them: (table_name, key_1, key_2, payload), a row per key;
    payload holds the other columns as text, joined by '|' (a null is empty)."""
    load_all(wh, files_per_trigger)
    out = None
    for t in RAW_TABLES:
        keys = [F.col(k).cast("bigint") for k in RAW_KEYS[t]] + [F.lit(None).cast("bigint")]
        rest = [F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in RAW_SCHEMAS[t].fields if f.name not in RAW_KEYS[t]]
        part = loaded_table(wh, t).read().select(F.lit(t).alias("table_name"), keys[0].alias("key_1"), keys[1].alias("key_2"),
                                                 F.concat_ws("|", *rest).alias("payload"))
        out = part if out is None else out.unionByName(part)
    return out


def load_summary(wh: Warehouse, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """The ledger by table: rows read, first and last leading key, whether it took at least three batches, and batches
    that are not merged."""
    load_all(wh, files_per_trigger)
    return load_ledger(wh).read().groupBy("table_name").agg(
        F.sum("row_count").alias("rows_read"), F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"),
        (F.count("*") >= EXTRACTS).alias("in_batches"), F.count_if(F.col("status") != "merged").alias("open_batches"))


def incremental_load(wh: Warehouse, table: str = "orders", files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Load a landed CSV table into Parquet in bounded batches, resuming from the last committed file.

    The file source's checkpoint records which files were loaded, so a
    re-run after a crash (or after new files land) loads only the rest.
    """
    from trolley.sources.files import CSV_OPTIONS, land_csv

    spark = wh.spark
    src = (spark.readStream.schema(RAW_SCHEMAS[table]).options(**CSV_OPTIONS).option("nullValue", "")
           .option("maxFilesPerTrigger", files_per_trigger).csv(f"{land_csv(wh)}/{table}"))
    out = wh.path("loaded", table)
    q = (src.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", wh.path("checkpoints", f"load_{table}"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


__all__ = ["Merge", "stream_product_counts", "stream_pair_counts", "stream_upsert", "load_tables", "load_summary", "incremental_load"]
