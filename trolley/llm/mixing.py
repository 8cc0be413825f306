"""Mixing sources to target weights by Pfair scheduling, with DataFrame and SQL functions only.

Each source's rows are cut into blocks of equal length.  With a weight of w = a / period blocks per slot,
block j of a source (from 0) has the release time floor(j / w) and the deadline ceil((j + 1) / w).  At every
slot, of the blocks that are released, the one with the earliest deadline is taken (ties: the larger weight,
then the source's name).  As the weights add up to one block per slot, every block meets its deadline, so
after any number of slots each source is less than one block away from its share.

The schedule repeats after ``period`` slots, in which a source with weight a / period has a blocks.  One
period is simulated once, by a fold in SQL over the weights alone; the rows then find their slot from their
rank in their source by a join on (source, block in period).  Beyond the end of a short source its slots stay
empty and the others go on in their proportions; no row is dropped.

Defined results: a null source is a source of its own; without given weights, a source weighs the square root
of its number of rows (sources far above the others are damped, none vanishes), rounded to a share of
1 / ``PERIOD``; given weights must be positive, a source without one gets the least given; given weights are kept
exactly if they have at most ``DIGITS`` decimals and come out even within ``LONGEST`` slots, else they are
rounded to shares of 1 / ``LONGEST``; every source gets at least one block in a period;
repeated rows and null doc_ids are kept; ties in a source go by md5 of doc_id, then of the text, equal rows
in any order; extra columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import Scratch, numbered, pick

PERIOD = 1000
LONGEST = 50_000
DIGITS = 9
SEGMENT = 1000
CYCLES = 4096

_GCD = "aggregate(ws, 0L, (g, x) -> aggregate(sequence(1, 92), struct(g as a, x as b), (s, k) -> if(s.b = 0, s, struct(s.b as a, s.a % s.b as b)), s -> s.a))"


def period_shares(weights: DataFrame, period: int, parts: int | None = None) -> DataFrame:
    """(source, weight) to (source, period, blocks): blocks / period is the weight's share, exactly if it can be.

    Weights of at most ``DIGITS`` decimals are whole numbers of a unit; divided by their greatest common divisor
    they are the blocks of the shortest exact period, of which as many follow each other as reach ``period``.  If
    that is longer than ``LONGEST``, or a weight has more decimals, shares are rounded to whole ``parts`` (by
    default ``period``; at least four for each source on average, and one block).  One row per source."""
    unit = F.col("weight").try_cast("decimal(38,18)") * F.lit(10 ** DIGITS).cast("decimal(10,0)")
    w = weights.select("source", "weight", unit.alias("unit"))
    whole = F.coalesce((F.col("unit") == F.floor("unit")) & (F.col("unit") >= 1) & (F.col("unit") < 10 ** 16), F.lit(False))
    facts = w.agg(F.min(whole).alias("whole"), F.collect_list(F.col("unit").try_cast("long")).alias("ws"), F.sum("weight").alias("total"), F.count("*").alias("sources"))
    facts = facts.select("whole", "total", F.greatest(F.lit(parts or period), 4 * F.col("sources")).alias("parts"), F.expr(f"greatest({_GCD}, 1L)").alias("gcd"),
                         F.expr("aggregate(ws, cast(0 as decimal(38,0)), (a, x) -> cast(a + x as decimal(38,0)))").alias("units"))
    facts = facts.withColumn("exact", F.expr(f"whole and units / gcd <= {LONGEST}"))
    facts = facts.withColumn("times", F.when(F.col("exact"), F.expr(f"cast(ceil({period} / (units / gcd)) as bigint)")))
    of = w.select("*", facts.select(F.struct("exact", "gcd", "times", "total", "parts")).scalar().alias("of"))
    exact = F.expr("try_cast(unit as bigint) div of.gcd * of.times")
    shares = of.select("source", F.when(F.col("of.exact"), exact).otherwise(F.greatest(F.lit(1), F.round(F.col("weight") / F.col("of.total") * F.col("of.parts")))).cast("int").alias("blocks"))
    return shares.select("source", F.sum("blocks").over(Window.partitionBy(F.lit(0))).cast("int").alias("period"), "blocks")


def period_slots(shares: DataFrame) -> DataFrame:
    """(source, block, slot, period, blocks, release, deadline) of one period, simulated slot by slot."""
    order = "array_sort(collect_list(struct(blocks, source)), (x, y) -> case when x.blocks != y.blocks then y.blocks - x.blocks when x.source is null and y.source is null then 0 when x.source is null then -1 when y.source is null then 1 when x.source < y.source then -1 when x.source > y.source then 1 else 0 end)"
    one = shares.groupBy("period").agg(F.expr(order).alias("s"))
    # state: blocks taken of each source, and the source taken at each slot (an index into s)
    # next deadline of source i at slot t: ceil((done + 1) * period / blocks), if floor(done * period / blocks) <= t
    choose = """array_min(transform(s, (x, i) -> struct(
        case when acc.done[i] < x.blocks and (acc.done[i] * period) div x.blocks <= t
             then ((acc.done[i] + 1) * period + x.blocks - 1) div x.blocks else 1000000000000L end as d, i as i))).i"""
    # the choice is made once a slot: fold over (acc, slot) with the pick bound by a one-element transform; a segment
    # of slots collects its own picks, so that the long array of all picks grows once a segment only
    segment = f"""aggregate(sequence(g * {SEGMENT}, least(period, (g + 1) * {SEGMENT}) - 1),
        struct(all.done as done, cast(array() as array<int>) as took),
        (acc, t) -> transform(array({choose}), p -> struct(transform(acc.done, (n, i) -> if(i = p, n + 1, n)) as done, concat(acc.took, array(p)) as took))[0])"""
    fold = f"""aggregate(sequence(0, (period - 1) div {SEGMENT}),
        struct(array_repeat(0L, size(s)) as done, cast(array() as array<int>) as took),
        (all, g) -> transform(array({segment}), x -> struct(x.done as done, concat(all.took, x.took) as took))[0],
        all -> all.took)"""
    took = one.select("period", "s", F.posexplode(F.expr(fold)).alias("slot", "i"))
    taken = took.select("period", "slot", F.expr("s[i].source").alias("source"), F.expr("s[i].blocks").alias("blocks"))
    taken = taken.withColumn("block", F.row_number().over(Window.partitionBy("source").orderBy("slot")) - 1)
    return taken.select("source", "block", "slot", "period", "blocks",
                        F.expr("cast(block as bigint) * period div blocks").alias("release"),
                        F.expr("((cast(block as bigint) + 1) * period + blocks - 1) div blocks").alias("deadline"))


def placed(docs: DataFrame, weights: DataFrame | None = None, block_rows: int = 16, period: int = PERIOD,
        doc_id: str = "doc_id", source: str = "source", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per row: _id, _source, _keep_<i>, block, release, deadline, _cycle, slot, _in (place in its block); written.
    Rows ordered by slot and _in are in mixed order."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    rows = docs.select(docs[doc_id].alias("_id"), docs[source].alias("_source"), docs[text].alias("_text"), *[docs[c].alias(f"_keep_{i}") for i, c in enumerate(keep or [])])
    count = pick(docs, source=source).groupBy("source").agg(F.count("*").alias("rows"))
    count = scratch.table(count)
    total = count.agg(F.sum("rows")).first()[0] or 0
    parts = period if weights is None else LONGEST
    if weights is None:
        weights = count.select("source", F.sqrt("rows").alias("weight"))
    else:
        given = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double").alias("_w")).where("_w > 0 and _w < double('infinity')")
        weights = (count.join(F.broadcast(given), F.col("source").eqNullSafe(F.col("_s")), "left")
                   .select("source", F.coalesce("_w", F.lit(given.agg(F.min("_w")).first()[0] or 1.0)).alias("weight")))
    slots = scratch.table(period_slots(period_shares(weights, period, parts)))
    md5 = lambda c: F.md5(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary"))
    rows = rows.withColumn("_turn", F.concat(md5("_id"), md5("_text"))).drop("_text")
    ranked = numbered(rows, ["_source"], "_turn", "_rank", total)
    ranked = ranked.withColumn("_j", F.floor(F.col("_rank") / block_rows))
    # one row per block of a period: period rows, whatever the input
    cyc = F.broadcast(slots) if slots.count() <= max(period, 100_000) else slots
    per = slots.groupBy(F.col("source").alias("_s")).agg(F.first("blocks").alias("_blocks"), F.first("period").alias("_period"))
    ranked = ranked.join(F.broadcast(per), F.col("_source").eqNullSafe(F.col("_s"))).withColumn("_b", (F.col("_j") % F.col("_blocks")).cast("int")).withColumn("_cycle", F.floor(F.col("_j") / F.col("_blocks")))
    at = ranked.join(cyc.select(F.col("source").alias("_s2"), F.col("block").alias("_b2"), "slot", "release", "deadline"), F.col("_source").eqNullSafe(F.col("_s2")) & (F.col("_b") == F.col("_b2")))
    start = F.col("_cycle") * F.col("_period")
    at = at.select("_id", "_source", *[f"_keep_{i}" for i in range(len(keep or []))], F.col("_j").alias("block"), (start + F.col("release")).alias("release"), (start + F.col("deadline")).alias("deadline"),
                   F.col("_cycle"), (start + F.col("slot")).alias("slot"), (F.col("_rank") % block_rows).alias("_in"))
    return scratch.table(at)


def mix(docs: DataFrame, weights: DataFrame | None = None, block_rows: int = 16, period: int = PERIOD,
        doc_id: str = "doc_id", source: str = "source", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per row: doc_id, source, block, release, deadline, slot, position (a permutation of 0..rows-1).

    weights: (source, weight).  keep: columns of ``docs`` to carry along."""
    at = placed(docs, weights, block_rows, period, doc_id, source, text, keep)
    # rows before a slot: running sums over the slots of a cycle, and over the cycles (rows / (block_rows * period) of them)
    fill = at.groupBy("_cycle", "slot").agg(F.count("*").alias("n"))
    before = Window.unboundedPreceding
    in_cycle = fill.select("_cycle", "slot", F.coalesce(F.sum("n").over(Window.partitionBy("_cycle").orderBy("slot").rowsBetween(before, -1)), F.lit(0)).alias("n0"))
    cycles = fill.groupBy("_cycle").agg(F.sum("n").alias("n"))
    cycles = cycles.withColumn("_run", F.floor(F.col("_cycle") / CYCLES))  # a window holds the cycles of a run, the other one the runs
    runs = cycles.groupBy(F.col("_run").alias("_r")).agg(F.sum("n").alias("n"))
    runs = runs.select("_r", F.coalesce(F.sum("n").over(Window.orderBy("_r").rowsBetween(before, -1)), F.lit(0)).alias("r0"))
    in_run = F.coalesce(F.sum("n").over(Window.partitionBy("_run").orderBy("_cycle").rowsBetween(before, -1)), F.lit(0))
    cycles = cycles.withColumn("c0", in_run).join(runs, F.col("_run") == F.col("_r")).select(F.col("_cycle").alias("_c"), (F.col("c0") + F.col("r0")).alias("c0"))
    starts = in_cycle.join(cycles, F.col("_cycle") == F.col("_c")).select(F.col("slot").alias("_slot"), (F.col("n0") + F.col("c0")).alias("_start"))
    out = at.join(starts, at["slot"] == starts["_slot"])
    return out.select(F.col("_id").alias("doc_id"), F.col("_source").alias("source"), *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep or [])] if keep else [],
                      "block", "release", "deadline", "slot", (F.col("_start") + F.col("_in")).cast("long").alias("position"))


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """All rows and columns of ``docs``, written in mixed order: ranges of positions, sorted within each.  Positions count
    the rows by slot and place in the block, so these alone give the order and no sums are joined to the texts."""
    own = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    names = dict(zip(docs.columns, own.columns))
    at = placed(own, doc_id=names["doc_id"], source=names["source"], text=names["text"], keep=own.columns, **params)
    ordered = at.repartitionByRange("slot", "_in").sortWithinPartitions("slot", "_in")
    return ordered.select([f"_keep_{i}" for i in range(len(own.columns))]).toDF(*docs.columns)
