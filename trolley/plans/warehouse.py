"""The layered basket warehouse: raw -> staging (views) -> marts (written tables).

Like the dbt project it mirrors, staging and intermediate models are lazy
views (Catalyst inlines them) and marts are materialised once.  Every
materialisation is a Parquet table in the shared work folder named by
``spark.checkpoint.dir``: it cuts lineage so a lost executor recomputes from
the written table, not from the raw sources, and every query that reuses a
mart reads it with column pruning and predicate pushdown.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
import warnings
from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trolley.plans import features as fe
from trolley.plans import marts as mt
from trolley.plans import staging as st
from trolley.session import work_dir
from trolley.sources import driver, store
from trolley.sources.schemas import RAW_TABLES

# staging + intermediate models and projection marts are views; other marts are written tables
VIEW_NAMES = ("stg_orders", "stg_products", "stg_aisles", "stg_departments", "stg_order_products_prior",
              "stg_order_products_train", "int_order_products", "int_order_items_enriched")
MART_NAMES = ("fact_order_items", "dim_orders", "dim_products", "dim_aisles", "dim_departments", "dim_users",
              "dim_product", "dim_order_slot", "fact_order", "order_features", "dim_user", "product_metrics")

ALL_TABLES = ("fact_order_items", "dim_orders", "dim_products", "dim_aisles", "dim_departments", "order_baskets",
              "dim_users", "dim_product", "dim_order_slot", "fact_order", "order_features", "dim_user",
              "product_metrics", "item_cube")  # the four projection dims are views; building them just writes their raw table

# A bucket of order keys: about a million order lines, which a task holds without spilling.  Buckets stay this small up
# to MOST_SMALL of them (128 GB of input); a larger input has larger ones, of 256 MB at most.
BUCKET_BYTES = 16 << 20
MOST_SMALL = 8192

_LOCK = threading.Lock()
_CACHE: dict[tuple[str, str], "Warehouse"] = {}


class Warehouse:
    """Lazily built, memoised tables for one (session, source) pair."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None,
                 raw: dict[str, DataFrame] | None = None, files: dict[str, str] | None = None,
                 file_format: str = "csv", guarded: bool = True):
        """``guarded``: marts with a many-to-one or one-to-one contract fail on a key that breaks it.  Sources that are
        still to be checked are opened with ``guarded=False``, so that the quality report can name all they break."""
        self.spark = spark
        self.guarded = guarded
        self.sf_dir = sf_dir.rstrip("/")
        self._files = files
        self._file_format = file_format
        tag = hashlib.sha1(self.sf_dir.encode()).hexdigest()[:10]
        self.root = root or os.path.join(work_dir(spark), "trolley", f"{tag}-{uuid.uuid4().hex[:8]}")
        self._raw_override = raw
        self._tables: dict[str, DataFrame] = {}
        self._rows: dict[str, int] = {}
        self._lock = threading.RLock()
        self._locks: dict[str, threading.Lock] = {}
        self._needs: dict[str, set[str]] = {}  # written table -> the tables and sources that its build read
        self._building = threading.local()
        self._prints: dict[str, str] = {}  # source -> fingerprint of its files when it was last looked at
        self._generation: dict[str, int] = {}  # written table -> how often it has been rebuilt
        self._epoch = 0  # number of changes seen in the sources
        self.observed: dict[str, dict[str, int]] = {}  # raw table -> rows that its source gave to the write
        # Order-keyed tables are bucketed by order_id so order-level joins and aggregates need no
        # exchange.  Bucket count: spark.trolley.orderBuckets, else sized from the input (_bucket_count).
        # order_id is a safe bucket key: an order holds at most one row per product (the
        # (order_id, product_id) key is checked by dq_item_pair_unique), so the largest group in a
        # bucket is bounded by the catalogue size, never by the data size.
        conf = spark.conf
        self.bucketing = conf.get("spark.trolley.bucketing", "true").lower() == "true"
        configured = conf.get("spark.trolley.orderBuckets", None)
        self.buckets = int(configured) if configured else self._bucket_count()
        self._table_prefix = "trolley_" + hashlib.sha1(self.root.encode()).hexdigest()[:12] + "_"

    # ------------------------------------------------------------------ infra
    @classmethod
    def from_files(cls, spark: SparkSession, source_dir: str, file_format: str = "csv",
                   names: dict[str, str] | None = None, root: str | None = None) -> "Warehouse":
        """A warehouse over the six source files themselves (logical name -> file, ``SOURCE_FILES``).

        Raw tables are ingested once with the declared schemas (fail-fast on a
        malformed value; ``NaN`` cells become NULL) and written as Parquet; all
        models and queries then run unchanged.
        """
        from trolley.sources.schemas import SOURCE_FILES
        names = names or SOURCE_FILES
        base = source_dir.rstrip("/")
        files = {t: f"{base}/{names[t]}" for t in RAW_TABLES}
        return cls(spark, base, root=root, files=files, file_format=file_format)

    @classmethod
    def get(cls, spark: SparkSession, sf_dir: str) -> "Warehouse":
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        with _LOCK:
            wh = _CACHE.get(key)
            if wh is None:
                wh = _CACHE[key] = cls(spark, sf_dir)
        wh.refresh()
        return wh

    # ------------------------------------------------------------------ sources
    def sources(self) -> dict[str, str]:
        """Source name -> path of the files behind the raw tables (none for given frames)."""
        if self._files is not None:
            return dict(self._files)
        if self._raw_override is not None:
            return {}
        return {t: f"{self.sf_dir}/{t}.parquet" for t in ("orders", "lineitem", "part")}

    def sources_of(self, raw_table: str) -> tuple[str, ...]:
        """The sources that a raw table is read or derived from."""
        if self._files is not None:
            return (raw_table,)
        if self._raw_override is not None:
            return ()
        return {"orders": ("orders", "lineitem"), "order_products_prior": ("orders", "lineitem", "part"),
                "order_products_train": ("orders", "lineitem", "part")}.get(raw_table, ("part",))

    def fingerprints(self) -> dict[str, str]:
        """Source -> digest of its files' names, sizes and times (a listing, no data); '' where no file is."""
        out = {}
        for name, path in self.sources().items():
            found = store.files(self.spark, path)
            out[name] = "" if found is None else hashlib.sha1(repr(found).encode()).hexdigest()
        return out

    def missing(self) -> list[str]:
        """Raw tables without a file to read them from (a listing; an empty table is not missing)."""
        gone = {s for s, path in self.sources().items() if not store.exists(self.spark, path)}
        return [t for t in RAW_TABLES if gone & set(self.sources_of(t))]

    def refresh(self) -> list[str]:
        """Forget every written table that depends on a source whose files have changed since they were last looked at;
        the next use builds it anew, in a folder of its own.  Returns the names; others stay as they are."""
        if self._raw_override is not None:
            return []
        with self._lock:
            now = self.fingerprints()
            changed = {f"source:{s}" for s in now if s in self._prints and self._prints[s] != now[s]}
            self._prints = now
            if not changed:
                return []
            stale = set(changed)
            while more := {t for t, needs in self._needs.items() if t not in stale and needs & stale}:
                stale |= more
            gone = sorted(t for t in stale if t in self._tables)
            for t in gone:
                del self._tables[t]
                self._needs.pop(t, None)
                self._generation[t] = self._generation.get(t, 0) + 1
            self._rows.clear()
            self.observed.clear()
            self._checked = False
            # landed files, change feeds, loads and logs belong to one state of the sources
            self._epoch += 1
            self._landed = self._items_dropped = self._changes_dropped = self._changes_landed = False
            return gone

    def _uses(self, name: str) -> None:
        """Note that the table being built in this thread reads ``name``."""
        stack = getattr(self._building, "stack", [])
        if stack and stack[-1] != name:
            self._needs.setdefault(stack[-1], set()).add(name)

    def _input_paths(self) -> list[str]:
        if self._files is not None:
            return list(self._files.values())
        if self._raw_override is not None:
            return []
        return [f"{self.sf_dir}/{t}.parquet" for t in ("orders", "lineitem")]

    def input_bytes(self) -> int:
        """Total size of the source files (metadata only)."""
        sc = self.spark.sparkContext
        total = 0
        conf = sc._jsc.hadoopConfiguration()
        for p in self._input_paths():
            hp = sc._jvm.org.apache.hadoop.fs.Path(p)
            fs = hp.getFileSystem(conf)
            if fs.exists(hp):
                total += fs.getContentSummary(hp).getLength()
        return total

    def _bucket_count(self, target_bytes: int = 256 << 20) -> int:
        """One bucket for each ``BUCKET_BYTES`` of input up to ``MOST_SMALL`` buckets, so that a task sorts or groups one
        in memory; beyond, input bytes / 256 MB.  At least the default parallelism."""
        total = self.input_bytes()
        by_size = max(-(-total // target_bytes), min(MOST_SMALL, -(-total // BUCKET_BYTES)))
        return max(1, self.spark.sparkContext.defaultParallelism, by_size)

    def path(self, layer: str, name: str) -> str:
        of = f"@{self._epoch}" if self._epoch and layer not in ("raw", "marts", "reports") else ""
        return f"{self.root}/{layer}{of}/{name}"

    def _name_lock(self, name: str) -> threading.Lock:
        with self._lock:
            return self._locks.setdefault(name, threading.Lock())

    def materialise(self, name: str, build: Callable[[], DataFrame], layer: str = "marts",
                    partition_by: str | None = None, bucket_by: str | None = None,
                    count_by: str | None = None) -> DataFrame:
        """Write ``build()`` once as Parquet and return a DataFrame reading it back.

        With ``bucket_by`` the table is written bucketed (and sorted) on that
        column as an external catalogue table at the same shared path, so
        joins and aggregates on the bucket key between such tables skip the
        exchange.  One lock per table: independent tables can be written
        concurrently (``build_all``) while a table needed by two builders is
        written once; the dependency graph is acyclic, so nested locks cannot
        deadlock.

        Raw tables' rows are counted by the write itself (``observed``; by value of ``count_by`` if given).
        """
        self._uses(name)
        done = self._tables.get(name)
        if done is not None:
            return done
        with self._name_lock(name):
            if name not in self._tables:
                again = self._generation.get(name, 0)
                out = self.path(layer, f"{name}.{again}" if again else name)
                stack = self._building.stack = [*getattr(self._building, "stack", []), name]
                try:
                    df = build()
                finally:
                    stack.pop()
                    self._building.stack = stack
                seen = None
                if layer == "raw":
                    own = ("order_products_prior", "order_products_train") if name in ("items", "placed_items") else (name,)
                    self._needs.setdefault(name, set()).update(f"source:{x}" for t in own for x in self.sources_of(t))
                    seen = Observation()
                    counts = [F.count(F.lit(1)).alias("rows")] + [F.count_if(F.col(count_by) == v).alias(v) for v in ("prior", "train") if count_by]
                    df = df.observe(seen, *counts)
                if bucket_by and self.bucketing:
                    # one task per bucket (same hash as bucketing): one file per bucket and partition value
                    df = df.repartition(self.buckets, bucket_by)
                writer = df.write.mode("overwrite")
                if partition_by:
                    writer = writer.partitionBy(partition_by)
                done = False
                if bucket_by and self.bucketing:
                    table = self._table_prefix + name + (f"_{again}" if again else "")
                    try:
                        writer.bucketBy(self.buckets, bucket_by).sortBy(bucket_by).option("path", out) \
                            .saveAsTable(table)
                        self._tables[name] = self.spark.table(table)
                        done = True
                    except AnalysisException as exc:  # the catalogue refuses the table; nothing was written yet
                        warnings.warn(f"bucketed write of {name} refused ({type(exc).__name__}); writing plain Parquet")
                        writer = df.write.mode("overwrite")
                        if partition_by:
                            writer = writer.partitionBy(partition_by)
                if not done:
                    writer.parquet(out)
                    self._tables[name] = self.spark.read.parquet(out)
                if seen is not None:
                    self.observed[name] = dict(seen.get)
            return self._tables[name]

    def build_all(self, names: Iterable[str] = ALL_TABLES, threads: int = 8) -> None:
        """Materialise several tables with concurrent Spark jobs (each job is still fully distributed)."""
        names = list(names)
        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            for f in [pool.submit(getattr, self, n) for n in names]:
                f.result()

    def source_rows(self, raw_table: str) -> int | None:
        """Rows that the source gave to the write of a raw table, as that write counted them (None: not written here)."""
        if raw_table in ("order_products_prior", "order_products_train"):
            return self.observed.get("items", {}).get(raw_table.rsplit("_", 1)[1])
        return self.observed.get(raw_table, {}).get("rows")

    def rows(self, name: str) -> int:
        """Row count of a materialised table (read from the written files once)."""
        got = self._rows.get(name)
        if got is None:
            got = getattr(self, name).count()  # no lock held while a table may be building
            self._rows[name] = got
        return got

    def rows_raw(self, name: str) -> int:
        """Row count of a raw table (cached)."""
        key = f"raw_{name}"
        if key not in self._rows:
            self._rows[key] = self.raw(name).count()
        return self._rows[key]

    def source(self, name: str) -> DataFrame:
        """A raw table as its source holds it now: never the written copy that the models read."""
        if self._raw_override is not None:
            return self._raw_override[name]
        if self._files is not None:
            from trolley.sources.files import ingest_file
            return ingest_file(self.spark, self._files[name], name, self._file_format)
        if name in ("aisles", "departments", "products"):
            return driver.derive_catalogue(self.spark, self.sf_dir)[name]
        orders = driver.derive_orders(self.spark, self.sf_dir, self.buckets)
        if name == "orders":
            return orders
        part_product = driver.derive_catalogue(self.spark, self.sf_dir)["_part_product"]
        items = driver.derive_items(self.spark, self.sf_dir, orders, part_product, self.buckets)
        return items.filter(F.col("eval_set") == name.rsplit("_", 1)[1]).drop("eval_set")

    def written(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` as it is now, written to a folder of its own and read back."""
        out = self.path("reports", f"{name}-{uuid.uuid4().hex[:8]}")
        df.write.parquet(out)
        return self.spark.read.schema(df.schema).parquet(out)

    def close(self) -> None:
        """Drop this warehouse's catalogue tables and delete its folder."""
        for t in self.spark.catalog.listTables(pattern=f"{self._table_prefix}*"):
            self.spark.sql(f"DROP TABLE IF EXISTS {t.name}")
        self._tables.clear()
        self._rows.clear()
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        with _LOCK:
            for key in [k for k, wh in _CACHE.items() if wh is self]:
                del _CACHE[key]

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose raw tables, staging views and marts as temp views (the catalogue of S16/S20)."""
        from trolley.sources.schemas import RAW_TABLES as raw_names
        names = []
        for t in raw_names:
            self.raw(t).createOrReplaceTempView(f"{prefix}raw_{t}")
            names.append(f"{prefix}raw_{t}")
        for t in VIEW_NAMES + MART_NAMES:
            getattr(self, t).createOrReplaceTempView(f"{prefix}{t}")
            names.append(f"{prefix}{t}")
        return names

    # -------------------------------------------------------------------- raw
    def _placed_items(self) -> DataFrame:
        """The driver's items before their reorder flags, bucketed by order_id: read for the flags and for the items."""
        def build() -> DataFrame:
            part_product = driver.derive_catalogue(self.spark, self.sf_dir)["_part_product"]
            return driver.place_items(self.spark, self.sf_dir, self.raw("orders"), part_product, self.buckets)
        return self.materialise("placed_items", build, layer="raw", bucket_by="order_id")

    def _raw_items(self) -> DataFrame:
        """Prior and train items in one table: partitioned by eval_set, bucketed by order_id."""
        def build() -> DataFrame:
            if self._files is not None:
                from trolley.sources.files import ingest_file
                return ingest_file(self.spark, self._files["order_products_prior"], "order_products_prior",
                                   self._file_format).withColumn("eval_set", F.lit("prior")).unionByName(
                    ingest_file(self.spark, self._files["order_products_train"], "order_products_train",
                                self._file_format).withColumn("eval_set", F.lit("train")))
            items = driver.flag_reorders(self._placed_items(), self.buckets)
            return items.filter(F.col("eval_set").isin("prior", "train"))  # test orders have no basket
        return self.materialise("items", build, layer="raw", partition_by="eval_set", bucket_by="order_id", count_by="eval_set")

    def raw(self, name: str) -> DataFrame:
        """One of the six raw tables (``RAW_TABLES``)."""
        if name not in RAW_TABLES:
            raise KeyError(name)
        if not self._prints and self._raw_override is None:
            self.refresh()  # from here on a change of the files is noticed
        if self._raw_override is not None:
            return self._raw_override[name]
        if self._files is not None:
            from trolley.sources.files import ingest_file, require_sources
            with self._name_lock("_required"):
                if not getattr(self, "_checked", False):
                    require_sources(self.spark, self._files)  # all missing files reported at once
                    self._checked = True
            if name not in ("order_products_prior", "order_products_train"):
                return self.materialise(
                    name, lambda: ingest_file(self.spark, self._files[name], name, self._file_format), layer="raw",
                    bucket_by="order_id" if name == "orders" else None)
        if name in ("order_products_prior", "order_products_train"):
            source = name.rsplit("_", 1)[1]
            # partition pruning on eval_set=... directories
            return self._raw_items().filter(F.col("eval_set") == source).drop("eval_set")
        if name == "orders":
            return self.materialise(name, lambda: driver.derive_orders(self.spark, self.sf_dir, self.buckets), layer="raw",
                                    bucket_by="order_id")
        return self.materialise(
            name, lambda: driver.derive_catalogue(self.spark, self.sf_dir)[name], layer="raw")

    # ---------------------------------------------------------------- staging
    @property
    def stg_orders(self) -> DataFrame:
        return st.stg_orders(self.raw("orders"))

    @property
    def stg_products(self) -> DataFrame:
        return st.stg_products(self.raw("products"))

    @property
    def stg_aisles(self) -> DataFrame:
        return st.stg_aisles(self.raw("aisles"))

    @property
    def stg_departments(self) -> DataFrame:
        return st.stg_departments(self.raw("departments"))

    @property
    def stg_order_products_prior(self) -> DataFrame:
        return st.stg_order_products(self.raw("order_products_prior"), "prior")

    @property
    def stg_order_products_train(self) -> DataFrame:
        return st.stg_order_products(self.raw("order_products_train"), "train")

    @property
    def int_order_products(self) -> DataFrame:
        return mt.int_order_products(self.stg_order_products_prior, self.stg_order_products_train)

    @property
    def int_order_items_enriched(self) -> DataFrame:
        return mt.int_order_items_enriched(self.int_order_products, self.stg_orders, self.stg_products,
                                           self.rows("dim_products"))

    # ------------------------------------------------------------ dbt marts
    @property
    def fact_order_items(self) -> DataFrame:
        return self.materialise("fact_order_items", lambda: mt.fact_order_items(self.int_order_items_enriched),
                                bucket_by="order_id")

    # Projection marts are views over the written raw tables: a second copy would add a write and,
    # for dim_orders, lose the order_id bucketing that its uniqueness check and joins use.
    @property
    def dim_orders(self) -> DataFrame:
        return mt.dim_orders(self.stg_orders)

    @property
    def dim_products(self) -> DataFrame:
        return mt.dim_products(self.stg_products)

    @property
    def dim_aisles(self) -> DataFrame:
        return mt.dim_aisles(self.stg_aisles)

    @property
    def dim_departments(self) -> DataFrame:
        return mt.dim_departments(self.stg_departments)

    @property
    def item_cube(self) -> DataFrame:
        return self.materialise("item_cube", lambda: mt.item_cube(self.fact_order_items))

    @property
    def order_baskets(self) -> DataFrame:
        return self.materialise("order_baskets", lambda: mt.order_baskets(self.int_order_products),
                                bucket_by="order_id")

    @property
    def dim_users(self) -> DataFrame:
        return self.materialise("dim_users", lambda: mt.dim_users(self.order_baskets, self.stg_orders))

    # --------------------------------------------------------- V1 star schema
    @property
    def dim_product(self) -> DataFrame:
        return self.materialise("dim_product", lambda: mt.dim_product(
            self.raw("products"), self.raw("aisles"), self.raw("departments"),
            self.rows("dim_aisles"), self.rows("dim_departments"), self.guarded))

    @property
    def dim_order_slot(self) -> DataFrame:
        return self.materialise("dim_order_slot", lambda: mt.dim_order_slot(self.stg_orders))

    @property
    def fact_order(self) -> DataFrame:
        return self.materialise("fact_order", lambda: mt.fact_order(
            self.stg_orders, self.dim_order_slot, self.order_baskets, self.rows("dim_order_slot")), bucket_by="order_id")

    @property
    def fact_order_item(self) -> DataFrame:
        return mt.fact_order_item(self.stg_order_products_prior, self.stg_order_products_train)

    @property
    def order_features(self) -> DataFrame:
        return self.materialise("order_features", lambda: fe.order_features(self.stg_orders, self.order_baskets, self.guarded),
                                bucket_by="order_id")

    @property
    def customer_order_features(self) -> DataFrame:
        return fe.customer_order_features(self.stg_orders)

    @property
    def customer_basket_features(self) -> DataFrame:
        return fe.customer_basket_features(self.order_features)

    @property
    def customer_product_features(self) -> DataFrame:
        return fe.customer_product_features(self.int_order_products, self.stg_orders)

    @property
    def dim_user(self) -> DataFrame:
        return self.materialise("dim_user", lambda: fe.dim_user(
            self.customer_order_features, self.customer_basket_features, self.customer_product_features))

    @property
    def dim_user_segmented(self) -> DataFrame:
        return self.materialise("dim_user_segmented", lambda: fe.dim_user_segmented(self.dim_user))

    @property
    def product_metrics(self) -> DataFrame:
        return self.materialise("product_metrics", lambda: fe.product_metrics(
            self.item_cube, self.dim_product, self.rows("dim_product"), from_cube=True))
