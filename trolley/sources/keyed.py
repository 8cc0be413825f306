"""A Parquet table with a key, merged batch by batch (S14, I3): rows lie by ranges of the leading key column.

Layout under one folder of the shared store::

    data/v=<version>/_range=<r>/*.parquet     rows whose leading key is in [r * width, (r + 1) * width)
    manifest/<version>.json                   which version holds each range; which batches have been merged

A merge reads only the ranges that its batch touches, writes them anew in a version folder of its own and then writes
the manifest of that version in one rename.  Until then readers see the version before; a run that dies earlier leaves
a folder that no manifest names and that the next run overwrites.  The manifest also holds the last batch id of each
feed, so a batch that is merged a second time (a replay after a crash) changes nothing.

A range holds at most ``width`` leading keys.  The leading key may repeat only as often as the other key columns differ
(an order's products).  A row with a null key is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.sources import store

# Ranges of SMALL_RANGE bytes, which a task groups by key in memory, up to MOST_SMALL of them; a larger table's grow up to
# RANGE_BYTES.
RANGE_BYTES = 128 << 20
SMALL_RANGE = 16 << 20
MOST_SMALL = 8192
LEAST_RANGES = 16


def width_for(first: int, last: int, total_bytes: int) -> int:
    """Keys per range so that a range holds about ``SMALL_RANGE`` bytes (of a very large table, up to ``RANGE_BYTES``) of a
    table over [first, last]."""
    ranges = max(LEAST_RANGES, -(-total_bytes // RANGE_BYTES), min(MOST_SMALL, -(-total_bytes // SMALL_RANGE)))
    return max(1, -(-(last - first + 1) // ranges))


@dataclass
class Manifest:
    version: int = -1
    width: int | None = None
    ranges: dict[int, int] = field(default_factory=dict)  # range -> version that holds it
    merged: dict[str, int] = field(default_factory=dict)  # feed -> its last merged batch

    def text(self) -> str:
        return json.dumps({"version": self.version, "width": self.width, "ranges": self.ranges, "merged": self.merged})

    @classmethod
    def of(cls, text: str) -> Manifest:
        d = json.loads(text)
        return cls(d["version"], d["width"], {int(r): v for r, v in d["ranges"].items()}, d["merged"])


@dataclass(frozen=True)
class Merge:
    """What one merge did."""

    version: int
    touched: tuple[int, ...]
    kept: int  # ranges that stayed as they were
    replayed: bool = False


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: T.StructType, width: int):
        """``width`` counts when the table is first written; a table that exists keeps its own."""
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.width = self.manifest().width or int(width)
        self.schema = schema
        self.columns = schema.fieldNames()

    # ------------------------------------------------------------------ manifest
    def manifest(self) -> Manifest:
        names = [n for n in store.names(self.spark, f"{self.path}/manifest") if n.endswith(".json")]
        return Manifest.of(store.read_text(self.spark, f"{self.path}/manifest/{max(names)}")) if names else Manifest()

    def _commit(self, m: Manifest) -> None:
        final = f"{self.path}/manifest/{m.version:012d}.json"
        store.write_text(self.spark, f"{self.path}/manifest/.{uuid.uuid4().hex}", final, m.text())

    # ------------------------------------------------------------------ rows
    def _range(self) -> F.Column:
        lead = f"CAST(`{self.keys[0]}` AS BIGINT)"
        below = f"CASE WHEN {lead} < 0 THEN {lead} - {self.width - 1} ELSE {lead} END"  # div rounds toward zero
        nulls = " OR ".join(f"`{k}` IS NULL" for k in self.keys)
        return F.expr(f"CASE WHEN {nulls} THEN raise_error('null in key {', '.join(self.keys)}') ELSE ({below}) div {self.width} END").cast("bigint")

    def _read(self, ranges: dict[int, int]) -> DataFrame | None:
        by_version: dict[int, list[int]] = {}
        for r, v in ranges.items():
            by_version.setdefault(v, []).append(r)
        out = None
        schema = T.StructType([*self.schema.fields, T.StructField("_range", T.LongType())])
        for v, rs in sorted(by_version.items()):
            part = self.spark.read.schema(schema).parquet(f"{self.path}/data/v={v}").where(F.col("_range").isin(rs))
            out = part if out is None else out.unionByName(part)
        return out

    def read(self, ranges: Iterable[int] | None = None) -> DataFrame:
        """The table as of now; only ``ranges`` if given (only their folders are read)."""
        m = self.manifest()
        found = self._read(m.ranges if ranges is None else {r: m.ranges[r] for r in ranges if r in m.ranges})
        return self.spark.createDataFrame([], self.schema) if found is None else found.select(*self.columns)

    def touched(self, batch: DataFrame) -> dict[int, tuple[int, int, int]]:
        """For each range that holds a key of the batch: its first and last leading key there, and its rows (one line
        a range at most)."""
        lead = F.col(self.keys[0]).cast("bigint")
        found = batch.groupBy(self._range().alias("r")).agg(F.min(lead), F.max(lead), F.count("*")).collect()
        return {r[0]: (r[1], r[2], r[3]) for r in sorted(found)}

    # ------------------------------------------------------------------ merge
    def merge(self, batch: DataFrame, feed: str = "batch", batch_id: int | None = None, order_col: str | None = None,
              touched: Iterable[int] | None = None) -> Merge:
        """Insert the batch's new keys and replace the rows of known ones.

        Of rows with one key the highest ``order_col`` wins, then the batch's over the table's, then the highest
        other values, so the result does not depend on the order of rows.  Without ``order_col`` the batch wins.
        """
        m = self.manifest()
        if batch_id is not None and m.merged.get(feed, -1) >= batch_id:
            return Merge(m.version, (), len(m.ranges), True)
        touched = sorted(self.touched(batch) if touched is None else touched)
        rest = [c for c in self.columns if c not in self.keys and c != order_col]
        order = [order_col] if order_col else []

        def last(df: DataFrame, by: list[str], first: list[str]) -> DataFrame:
            best = F.max(F.struct(*[F.col(c) for c in first + rest])).alias("_best")
            return df.groupBy(*by).agg(best).select(*by, *[F.col(f"_best.{c}").alias(c) for c in first + rest])

        # copies of a key collapse in each task before the batch is shuffled
        new = last(batch.select(*self.columns).withColumn("_gen", F.lit(1)), self.keys, [*order, "_gen"]).withColumn("_range", self._range())
        old = self._read({r: m.ranges[r] for r in touched if r in m.ranges})
        both = new if old is None else new.unionByName(old.withColumn("_gen", F.lit(0)))
        version = m.version + 1
        # one shuffle by range serves the grouping by key and the folders
        merged = last(both.repartition("_range"), ["_range", *self.keys], [*order, "_gen"])
        merged.select(*self.columns, "_range").write.mode("overwrite").partitionBy("_range").parquet(f"{self.path}/data/v={version}")
        self._commit(Manifest(version, self.width, m.ranges | {r: version for r in touched},
                              m.merged | ({feed: batch_id} if batch_id is not None else {})))
        return Merge(version, tuple(touched), len(m.ranges) - len(set(touched) & set(m.ranges)))

    def merged_up_to(self, feed: str) -> int:
        """Last batch of the feed that the table holds (-1: none)."""
        return self.manifest().merged.get(feed, -1)

    def vacuum(self) -> int:
        """Delete version folders that the present manifest doesn't name; returns how many.  For a time without readers."""
        live = {f"v={v}" for v in self.manifest().ranges.values()}
        gone = [n for n in store.names(self.spark, f"{self.path}/data") if n not in live]
        for n in gone:
            store.delete(self.spark, f"{self.path}/data/{n}")
        return len(gone)
