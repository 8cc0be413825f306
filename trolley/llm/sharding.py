"""Sharding by longest-processing-time scheduling.

Rows with equal texts stay together (null texts are one such group).  Groups go, largest first, to the
least-loaded shard.  The schedule works on a histogram of group sizes: sizes keep their ten leading bits, so
there are at most 1024 classes per power of two whatever the input, and a heap deals each class's groups out
at the class's mean size.  Within a class groups are interchangeable; they take their turns by hash.

Slots number a shard's rows by hash; with ``as_stored``, in the order of the files and rows they were read from.  Rows
that don't come straight from files have no such order; their slots go by hash in either case.

Defined results: null or empty texts weigh 16 bytes; repeated rows are kept and share a shard; null doc_ids
are kept (numbered like others); ties between shards go to the smaller shard number; extra columns are
ignored; an empty table gives an empty result.  A group above the mean load makes its shard the largest, as
it has to stay together.
"""

from __future__ import annotations

import heapq

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import Scratch, numbered, pick

OVERHEAD = 16
LEADING_BITS = 10
STORED_ROWS = 200_000


def size_class(size) -> "F.Column":
    """The size with all but its leading bits zeroed: groups of one class differ by less than 0.2 %."""
    shift = F.greatest(F.lit(0), F.length(F.bin(size)) - LEADING_BITS)
    return F.call_function("shiftleft", F.call_function("shiftright", size, shift), shift)


def schedule(classes: list[tuple[int, int, int]], shards: int) -> list[tuple[int, list[int], list[int]]]:
    """Of (class, groups, bytes), the runs of each class: (class, ends of runs, shard of each run).

    Long classes are dealt in whole rounds once all loads are within one group of each other; heap picks
    before that and for the rest are those of plain longest-processing-time scheduling."""
    heap = [(0.0, s) for s in range(shards)]
    out = []
    for size, groups, total in sorted(classes, reverse=True):
        mean, got = total / groups, [0] * shards
        while groups:
            low, high = heap[0][0], max(heap)[0] if groups >= 2 * shards else None
            if high is not None and high - low <= mean:
                rounds = groups // shards
                heap = [(load + rounds * mean, s) for load, s in heap]
                heapq.heapify(heap)
                got = [g + rounds for g in got]
                groups -= rounds * shards
            else:
                for _ in range(min(groups, shards)):
                    load, s = heap[0]
                    heapq.heapreplace(heap, (load + mean, s))
                    got[s] += 1
                    groups -= 1
        ends, where, end = [], [], 0
        for s, g in enumerate(got):
            if g:
                end += g
                ends.append(end)
                where.append(s)
        out.append((size, ends, where))
    return out


def stored(docs: DataFrame, doc_id: str, text: str) -> DataFrame | None:
    """doc_id and text of the rows with file (a number that grows with Spark's part and file numbers) and row (the place in it) of
    file-backed ``docs``; None for others."""
    name = F.col("_metadata.file_path")
    part, cut = (F.regexp_extract(name, x, 1).try_cast("long") for x in (r"part-(\d+)[^/]*$", r"-c(\d+)(?:\.[^/]*)?$"))
    file = F.coalesce(part * (1 << 20) + F.coalesce(cut, F.lit(0)), F.crc32(name.cast("binary")))
    try:
        return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), file.alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        return None


def numbered_as_stored(df: DataFrame, by: str, out: str) -> DataFrame:
    """Adds ``out``: 0-based rank within ``by`` in the order of (file, row); a window holds a bounded piece of a file."""
    df = df.withColumn("piece", F.floor(F.col("row") / STORED_ROWS))
    counts = df.groupBy(F.col(by).alias("_by"), F.col("file").alias("_f"), F.col("piece").alias("_p")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_by").orderBy("_f", "_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_by", "_f", "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = df.withColumn("_in", F.row_number().over(Window.partitionBy(by, "file", "piece").orderBy("row", "turn")) - 1)
    ranked = ranked.join(counts, (F.col(by) == F.col("_by")) & (F.col("file") == F.col("_f")) & (F.col("piece") == F.col("_p")))
    return ranked.withColumn(out, (F.col("_in") + F.col("_before")).cast("long"))


def shard(docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text", as_stored: bool = False) -> DataFrame:
    """One row per row: doc_id, size, text_crc32, law, shard, slot, grown_shard; size-balanced (law ``bytes``)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    place = stored(docs, doc_id, text) if as_stored else None
    rows = pick(docs, doc_id=doc_id, text=text) if place is None else place
    rows = scratch.table(rows.select(
        "doc_id", *([] if place is None else ["file", "row"]), (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("0" * 31 + "-")).alias("g"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("turn")))
    groups = rows.groupBy("g").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).withColumn("class", size_class(F.col("bytes")))
    groups = scratch.table(groups)
    classes = [tuple(r) for r in groups.groupBy("class").agg(F.count("*"), F.sum("bytes")).toLocalIterator()]
    total = sum(c[1] for c in classes)
    runs = spark.createDataFrame(schedule(classes, shards), "class long, ends array<long>, shards array<int>")
    turns = numbered(groups.select("g", "class"), ["class"], "g", "turn_in_class", total)
    placed = turns.join(F.broadcast(runs), "class").select("g", F.expr("shards[size(filter(ends, e -> e <= turn_in_class))]").alias("shard"))
    count = rows.count()
    out = rows.join(placed, "g")
    key = F.md5(F.concat_ws(":", "turn", "g", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    out = out.withColumn("turn", key)
    out = numbered(out, ["shard"], "turn", "slot", count) if place is None else numbered_as_stored(out, "shard", "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
