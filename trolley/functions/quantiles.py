"""Exact quantiles without funnelling every distinct value into one task.

``F.median`` / ``F.percentile`` keep one counter per distinct value and
merge all of them in a single task -- fine for small domains (basket sizes,
cart positions, department averages), not for per-customer rates at
warehouse scale.  ``exact_quantile`` selects instead:

1. a ``percentile_approx`` sketch (fixed size, merged map-side) of the values in the current band, asked a
   little below and above the target ranks, gives a narrower band;
2. one aggregate counts the rows below and inside the new band.  If the target ranks aren't inside, the
   margin is doubled and the same band asked again;
3. both repeat until the band holds at most ``accuracy`` rows or a single value.  Every round divides the
   band by about ``accuracy / 6``, so there are two or three whatever the table's size;
4. a cumulative count over the band's distinct values (``accuracy`` at most) finds the two values around
   position ``p * (n - 1)``, which are interpolated linearly (``lo * (1 - d) + hi * d``).  That equals
   DuckDB's ``quantile_cont`` exactly for medians and integer-valued data; for other fractions DuckDB fuses
   the multiply-add, so the last bit may differ.

Bands become literals, so their filters reach the Parquet scan.
"""

from __future__ import annotations

import math

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 10_000  # Spark's default sketch size: small per-task buffers to merge, band ~6e-4 * n


def exact_quantile(df: DataFrame, column: str | Column, p: float, accuracy: int = DEFAULT_ACCURACY,
                   alias: str = "q") -> DataFrame:
    """One row, one double column ``alias``: the linear-interpolated p-quantile of non-null values (NULL if none).

    Runs the narrowing jobs immediately (each returns a few scalars); the returned frame is the lazy
    selection over the last band.
    """
    spark = df.sparkSession
    x = (F.col(column) if isinstance(column, str) else column).cast("double")
    v = df.select(x.alias("x")).filter(F.col("x").isNotNull())
    xc = F.col("x")
    n = v.count()
    if n == 0:
        return spark.createDataFrame([(None,)], f"{alias} double")
    h = (n - 1) * float(p)
    r0, r1 = math.floor(h), math.ceil(h)
    frac = h - r0
    band, below, inside, margin = v, 0, n, 3.0 / accuracy
    while inside > accuracy:
        lo_p, hi_p = max((r0 - below) / inside - margin, 0.0), min((r1 + 1 - below) / inside + margin, 1.0)
        lo, hi = band.agg(F.percentile_approx("x", F.array(F.lit(lo_p), F.lit(hi_p)), accuracy)).first()[0]
        lo_ok, hi_ok = lo_p == 0.0, hi_p == 1.0  # the band's own ends stay
        got = band.agg(F.count_if(xc < lo).alias("less"), F.count_if(xc <= hi).alias("upto")).first()
        less, upto = (0 if lo_ok else got["less"]), (inside if hi_ok else got["upto"])
        if below + less > r0 or below + upto <= r1:
            margin *= 2
            continue
        narrower = band
        if not lo_ok:
            narrower = narrower.filter(xc >= lo)
        if not hi_ok:
            narrower = narrower.filter(xc <= hi)
        stuck = upto - less == inside
        band, below, inside = narrower, below + less, upto - less
        if lo == hi and not lo_ok and not hi_ok or stuck and margin * inside < 3:
            break
        margin = margin / 2 if stuck else 3.0 / accuracy
    counts = band.groupBy(xc.alias("k")).agg(F.count(F.lit(1)).alias("c"))
    w = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("cum", F.sum("c").over(w) + below)
    first = F.col("cum") - F.col("c")  # rank of the value's first copy
    last = F.col("cum") - 1
    picked = ranked.agg(
        F.max(F.when((first <= r0) & (F.lit(r0) <= last), F.col("k"))).alias("v0"),
        F.max(F.when((first <= r1) & (F.lit(r1) <= last), F.col("k"))).alias("v1"),
    )
    value = F.col("v0") * F.lit(1.0 - frac) + F.col("v1") * F.lit(frac)
    return picked.select((value if frac else F.col("v0")).alias(alias))


def exact_median(df: DataFrame, column: str | Column, alias: str = "median",
                 accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    return exact_quantile(df, column, 0.5, accuracy, alias)


# ------------------------------------------------------------------ many quantiles at once

@dataclass
class _Target:
    """One wanted quantile while it is narrowed: ranks r0 and r1 of n values lie in [low, high] (None: open)."""

    column: int
    p: float
    n: int = 0
    low: float | None = None
    high: float | None = None
    below: int = 0  # values under the band
    inside: int = 0
    margin: float = 0.0

    @property
    def ranks(self) -> tuple[int, int]:
        h = (self.n - 1) * self.p
        return math.floor(h), math.ceil(h)

    def shares(self) -> tuple[float, float]:
        """Shares of the band that surround the ranks."""
        r0, r1 = self.ranks
        return (max((r0 - self.below) / self.inside - self.margin, 0.0), min((r1 + 1 - self.below) / self.inside + self.margin, 1.0))

    def holds(self, x: Column) -> Column:
        cond = x.isNotNull()
        if self.low is not None:
            cond = cond & (x >= self.low)
        return cond if self.high is None else cond & (x <= self.high)


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]], accuracy: int = DEFAULT_ACCURACY,
                    pick_rows: int = 1_000_000) -> dict[tuple[str, float], float | None]:
    """The linear-interpolated quantiles of several columns together: {(column, p): value}, None without values.

    Every step serves all columns and fractions in one scan of the table:

    1. one aggregate counts the values and asks a sketch for a band around each quantile;
    2. one grouping counts the values below each band and each value inside it, which gives the answer if the band
       holds the ranks (it is asked again with twice the margin if not).

    A band has about ``6 / accuracy`` of the values.  One that would hold over ``pick_rows`` is first narrowed by further
    rounds of a sketch inside it and one count, so what the last step groups never grows with the table.
    """
    names = list(wanted)
    x = {i: F.col(c).cast("double") for i, c in enumerate(names)}
    targets = [_Target(i, float(p)) for i, c in enumerate(names) for p in wanted[c]]
    if not targets:
        return {}
    margin = 3.0 / accuracy
    first = [F.count(x[i]) for i in x] + [F.percentile_approx(x[i], F.array(*[F.lit(v) for p in wanted[c] for v in (max(p - margin, 0.0), min(p + margin, 1.0))]), accuracy)
                                         for i, c in enumerate(names)]
    got = df.agg(*[e.alias(f"e{j}") for j, e in enumerate(first)]).first()
    seen = dict.fromkeys(x, 0)
    for t in targets:
        t.n = t.inside = got[t.column]
        t.margin = margin
        if t.n > accuracy:
            a, b = t.p - margin, t.p + margin
            k = seen[t.column]
            lo, hi = got[len(names) + t.column][2 * k], got[len(names) + t.column][2 * k + 1]
            t.low, t.high = (lo if a > 0 else None), (hi if b < 1 else None)
        seen[t.column] += 1
    out: dict[tuple[str, float], float | None] = {(names[t.column], t.p): None for t in targets if not t.n}
    open_ = [t for t in targets if t.n]
    expected = {id(t): min(t.n, 2 * margin * t.n) if t.n > accuracy else t.n for t in open_}
    while any(expected[id(t)] > pick_rows for t in open_):
        _narrow(df, x, open_, expected, accuracy, pick_rows)
    while open_:
        open_ = _pick(df, x, open_, names, out)
    return out


def _counts(df: DataFrame, x: dict[int, Column], targets: list[_Target]) -> None:
    """Fills in ``below`` and ``inside`` of every target: one aggregate."""
    cells = []
    for j, t in enumerate(targets):
        v = x[t.column]
        cells += [(F.count_if(v < t.low) if t.low is not None else F.lit(0)).alias(f"b{j}"), F.count_if(t.holds(v)).alias(f"i{j}")]
    got = df.agg(*cells, F.count(F.lit(1)).alias("n")).first()
    for j, t in enumerate(targets):
        t.below, t.inside = got[f"b{j}"], got[f"i{j}"]


def _narrow(df: DataFrame, x: dict[int, Column], targets: list[_Target], expected: dict[int, float], accuracy: int, pick_rows: int) -> None:
    """One round for all targets: count the bands, widen those that miss their ranks, sketch inside the large ones."""
    _counts(df, x, targets)
    large = []
    for t in targets:
        r0, r1 = t.ranks
        if not (t.below <= r0 and r1 < t.below + t.inside):
            t.low, t.high, t.margin = None, None, t.margin * 2
            t.below, t.inside = 0, t.n
            large.append(t)
        elif t.inside > pick_rows and not (t.low is not None and t.low == t.high):
            large.append(t)
        else:
            expected[id(t)] = 0
    if not large:
        return
    asked = []
    for j, t in enumerate(large):
        a, b = t.shares()
        asked.append((a, b))
        large[j] = t
    cells = [F.percentile_approx(F.when(t.holds(x[t.column]), x[t.column]), F.array(F.lit(a), F.lit(b)), accuracy).alias(f"s{j}")
             for j, (t, (a, b)) in enumerate(zip(large, asked))]
    got = df.agg(*cells).first()
    for j, (t, (a, b)) in enumerate(zip(large, asked)):
        low, high = got[f"s{j}"]
        before = (t.low, t.high)
        t.low, t.high = (low if a > 0 else t.low), (high if b < 1 else t.high)
        # a band that can't shrink is one value, or few: its group is small whatever it counts
        expected[id(t)] = 0 if (t.low, t.high) == before or t.low == t.high else (b - a) * t.inside


def _pick(df: DataFrame, x: dict[int, Column], targets: list[_Target], names: list[str],
          out: dict[tuple[str, float], float | None]) -> list[_Target]:
    """Values around the ranks of each target: one grouping of (target, value inside the band or null below it).
    Returns the targets whose band missed, widened."""
    cells = []
    for j, t in enumerate(targets):
        v = x[t.column]
        upto = v.isNotNull() if t.high is None else v.isNotNull() & (v <= t.high)
        cells.append(F.when(upto, F.struct(F.lit(j).alias("t"), (v if t.low is None else F.when(v >= t.low, v)).alias("v"))))
    counts = (df.select(F.explode(F.array(*cells)).alias("c")).where("c IS NOT NULL").groupBy("c.t", "c.v").agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("t").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = F.create_map(*[F.lit(y) for j, t in enumerate(targets) for y in (j, list(t.ranks))])
    placed = counts.withColumn("upto", F.sum("n").over(w)).withColumn("r", ranks[F.col("t")])
    holds = [(F.col("upto") - F.col("n") <= F.col("r")[i]) & (F.col("r")[i] < F.col("upto")) for i in (0, 1)]
    found = placed.where(holds[0] | holds[1]).select("t", "v", holds[0].alias("h0"), holds[1].alias("h1")).collect()  # two rows a target at most
    values: dict[int, list[float | None]] = {j: [None, None] for j in range(len(targets))}
    for r in found:
        for i, h in enumerate((r.h0, r.h1)):
            if h:
                values[r.t][i] = r.v
    again = []
    for j, t in enumerate(targets):
        low, high = values[j]
        if low is None or high is None:
            t.low = t.high = None  # the band missed a rank: all values
            again.append(t)
            continue
        r0, _ = t.ranks
        part = (t.n - 1) * t.p - r0
        out[names[t.column], t.p] = low * (1.0 - part) + high * part if part else low
    return again
