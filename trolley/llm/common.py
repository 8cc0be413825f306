"""Helpers of the training-data operators: written intermediate tables, connected components,
distributed row numbers and a vectorised tokeniser."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trolley.session import work_dir


class Scratch:
    """Intermediate tables, written as Parquet in the shared folder (spark.checkpoint.dir) and read back,
    so that a lost executor re-reads a file instead of recomputing its ancestors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
        self.n = 0

    def table(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/t{self.n}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables of this object that no later step reads.  A collection of the driver's garbage lets Spark's
        cleaner release their shuffle files and broadcasts too, which it does only for plans that are gone."""
        jvm = self.spark.sparkContext._jvm
        jvm.System.gc()
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t.scratch_path)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under working names: other columns of the caller can't clash."""
    return df.select(*[df[c].alias(n) for n, c in columns.items()])


# ------------------------------------------------------------------ connected components

def components(scratch: Scratch, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node reachable.

    Alternating large-star and small-star rounds: each links neighbours to the smallest one seen, so paths
    shorten at every round.  Every round is a grouped minimum and a join, written before the next; nothing
    is collected but a count and a checksum.
    """
    def norm(df: DataFrame) -> DataFrame:
        return df.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    now = scratch.table(norm(edges))
    state = _sum(now)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # the star's centre itself keeps its own link to the minimum
        large = norm(large.unionByName(least.select("a", F.col("m").alias("b"))))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        nxt = scratch.table(norm(small.unionByName(least.select("a", F.col("m").alias("b")))))
        after = _sum(nxt)
        scratch.drop(now)
        now, done, state = nxt, after == state, after
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())


def _sum(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.shiftright(F.xxhash64("b", "a"), 40))).first()
    return r[0], r[1], r[2]


# ------------------------------------------------------------------ row numbers without one large window

def numbered(df: DataFrame, by: list[str], order: str, out: str, rows: int, per_window: int = 200_000) -> DataFrame:
    """Adds ``out``: 0-based rank of each row within ``by``, in ascending ``order`` (lower-case hex text, evenly spread).

    A window holds one prefix of ``order``; as many digits are used as keep a window near ``per_window``
    rows even if one group has all ``rows``.  Ranks before a prefix come from a window over counts by prefix.
    """
    digits = 1
    while 16 ** digits * per_window < rows:
        digits += 1
    df = df.withColumn("_pre", F.substring(order, 1, digits))
    counts = df.groupBy(*by, "_pre").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_pre").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*by, "_pre", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*by, "_pre").orderBy(order)
    ranked = df.withColumn("_in", F.row_number().over(within) - 1)
    keys = [ranked[c].eqNullSafe(counts[c]) for c in [*by, "_pre"]]
    cond = keys[0]
    for k in keys[1:]:
        cond = cond & k
    return (ranked.join(counts, cond).select(*[ranked[c] for c in df.columns if c != "_pre"],
                                             (F.col("_in") + F.col("_before")).cast("long").alias(out)))


# ------------------------------------------------------------------ vectorised tokens

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_LOWER += np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_VALUE = np.where(_SPACE, np.uint64(0), _LOWER)
PIECE = 1 << 20


class _Powers:
    """Powers of the base and of its inverse, made where they are needed and not sent with a job."""

    def __init__(self):
        self.tables = [np.ones(1, np.uint64)] * 2

    def __reduce__(self):
        return _Powers, ()

    def upto(self, n: int) -> list[np.ndarray]:
        if len(self.tables[0]) < n:
            size = max(PIECE * 2, 1 << int(n - 1).bit_length())
            self.tables = [np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)])) for b in (_BASE, _INV)]
        return self.tables


_POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    a = a.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def pieces(off: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together; a longer text stands alone."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words (maximal runs without ASCII white space, A-Z lower-cased), offsets of each
    text's words, and each word's first byte."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64), np.zeros(0, np.int64)
    space = _SPACE[data]
    start = ~space
    start[1:] &= space[:-1]
    firsts = off[:-1][(off[:-1] < off[1:])]
    start[firsts] = ~space[firsts]
    at = np.flatnonzero(start)
    if len(at) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64), at
    pw, inv = _POWERS.upto(n)
    h = np.add.reduceat(_VALUE[data] * pw[:n], at) * inv[at]
    return mix(h), np.searchsorted(at, off), at


_STEP = [np.uint64(x) for x in (0x8CB92BA72F3D8DD7, 0xABC98388FB8FAC03, 0x9E6C63D0876A9A47, 0xD1B54A32D192ED03, 0x94D049BB133111EB, 0xBF58476D1CE4E5B9, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]


def shingles(h: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words by text, with offsets; a text of fewer words has its whole sequence."""
    n = np.diff(off)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out_off = np.concatenate([[0], np.cumsum(count)])
    first = np.repeat(off[:-1] - out_off[:-1], count) + np.arange(out_off[-1])
    left = np.repeat(np.minimum(n, k), count)  # words in the run
    pad = np.concatenate([h, np.zeros(k, np.uint64)])
    g = left.astype(np.uint64)
    for j in range(k):
        g = g + np.where(j < left, pad[first + j], np.uint64(0)) * np.uint64(pow(int(_STEP[j % 8]), 1 + j // 8, 1 << 64))
    return mix(g), out_off
