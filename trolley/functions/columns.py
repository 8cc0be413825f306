"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day-part labels and their right-closed hour bins
# (-1, 5] Night, (5, 11] Morning, (11, 17] Afternoon, (17, 23] Evening.
DAY_PARTS = (("Night", -1, 5), ("Morning", 5, 11), ("Afternoon", 11, 17), ("Evening", 17, 23))

# Customer segment labels, in rule order; the last is the default.
SEGMENTS = (
    "Frequent Repeat Customers",
    "Frequent Variety Customers",
    "Occasional Repeat Customers",
    "Occasional Variety Customers",
)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_part(hour: str | Column) -> Column:
    """Right-closed bins; hours outside (-1, 23] (and NULL) give NULL, like ``pd.cut``."""
    h = col(hour)
    expr = None
    for label, lo, hi in DAY_PARTS:
        cond = (h > lo) & (h <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / nullif(den, 0)`` as double (plain ``/ 0`` raises under ANSI)."""
    return col(num).cast("double") / F.nullif(col(den), F.lit(0))


def percent(x: str | Column, digits: int | None = None) -> Column:
    v = col(x) * F.lit(100.0)
    return F.round(v, digits) if digits is not None else v


def slot_code(dow: str | Column, hour: str | Column) -> Column:
    return F.concat_ws("_", col(dow).cast("string"), col(hour).cast("string"))


def customer_segment(orders: str | Column, rate: str | Column, order_threshold: Column, rate_threshold: Column) -> Column:
    """Median-split segment; a NULL rate matches no rule and falls to the default, as in ``np.select``."""
    o, r = col(orders), col(rate)
    frequent = o >= order_threshold
    occasional = o < order_threshold
    repeat = r >= rate_threshold
    variety = r < rate_threshold
    return (
        F.when(frequent & repeat, F.lit(SEGMENTS[0]))
        .when(frequent & variety, F.lit(SEGMENTS[1]))
        .when(occasional & repeat, F.lit(SEGMENTS[2]))
        .otherwise(F.lit(SEGMENTS[3]))
    )


def equal_width_bin(x: str | Column, lo: Column, hi: Column, n: int) -> Column:
    """0-based bin of ``n`` equal-width bins over [lo, hi]; the top edge folds into the last bin."""
    v = col(x)
    width = (hi - lo) / F.lit(n)
    raw = F.floor((v - lo) / F.when(width > 0, width)).cast("int")
    return F.when(v.isNull(), None).when(width <= 0, F.lit(0)).otherwise(F.least(raw, F.lit(n - 1)))
