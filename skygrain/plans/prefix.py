"""Running totals and exact order statistics over sorted values, without one task that holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skygrain.plans.skew import PART, TIE, cut_ranges


def running_totals(df: DataFrame, by: Sequence[str], order: Sequence[str], measures: Sequence[str],
                   unique: bool = False) -> DataFrame:
    """Add ``{m}_before`` (sum over earlier rows) and ``{m}_total`` (sum over the group) for each measure.

    The rows are sorted over the cluster; each range sums its own rows and adds the totals of the ranges before it.
    ``by`` may be empty (one global order). The per-range totals are at most (groups + ranges) rows. ``unique`` says
    that (by, order) names a row.
    """
    ranges = cut_ranges(df, by, order, unique=unique, shuffled=True)
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier_ranges = whole.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    sums = ranges.groupBy(*by, PART).agg(*[F.sum(m).alias(f"_{m}") for m in measures])
    for m in measures:
        sums = sums.withColumn(f"_{m}_start", F.coalesce(F.sum(f"_{m}").over(earlier_ranges), F.lit(0)))
        sums = sums.withColumn(f"{m}_total", F.sum(f"_{m}").over(whole))
    local = Window.partitionBy(*by, PART).orderBy(*order, TIE).rowsBetween(Window.unboundedPreceding, -1)
    cond = F.col(f"a.{PART}") == F.col(f"b.{PART}")
    for k in by:
        cond = cond & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    within = ranges
    for m in measures:
        within = within.withColumn(f"_{m}_local", F.coalesce(F.sum(m).over(local), F.lit(0)))
    return (
        within.alias("a")
        .join(sums.alias("b"), cond)
        .select(
            *[F.col(f"a.{c}") for c in df.columns],
            *[(F.col(f"b._{m}_start") + F.col(f"a._{m}_local")).alias(f"{m}_before") for m in measures],
            *[F.col(f"b.{m}_total").alias(f"{m}_total") for m in measures],
        )
    )


def exact_quantiles(df: DataFrame, value: str | Column, probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Linearly interpolated quantiles of ``value`` per group, one output column per entry of ``probs``.

    Equal values are counted first (combined before the shuffle), then ranked by running totals. ``percentile``
    would keep every distinct value of a group in one task's memory.
    """
    v = F.col(value) if isinstance(value, str) else value
    counts = (
        df.select(*by, v.cast("double").alias("_v"))
        .filter(F.col("_v").isNotNull())
        .groupBy(*by, "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    ranked = running_totals(counts, by, ["_v"], ["_c"], unique=True)
    last = F.col("_c_total") - 1

    def at(position: Column) -> Column:
        covers = (F.col("_c_before") <= position) & (position < F.col("_c_before") + F.col("_c"))
        return F.max(F.when(covers, F.col("_v")))

    parts, final = [], []
    for name, p in probs.items():
        parts += [
            at(F.floor(last * p)).alias(f"_{name}_lo"),
            at(F.ceil(last * p)).alias(f"_{name}_hi"),
            F.max(last * p - F.floor(last * p)).alias(f"_{name}_w"),
        ]
        lo, hi, w = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), F.col(f"_{name}_w")
        final.append((lo + (hi - lo) * w).alias(name))
    return ranked.groupBy(*by).agg(*parts).select(*by, *final)
