"""Ordered per-key work that does not put a hot key into one task.

Row windows (lag, lead, rolling frames) need a key's rows in order. Most keys are small, so one shuffle by key is
the best plan. A key above ``HOT_ROWS`` is cut into ranges by the sort order instead. Each range also gets the few
neighbouring rows that its frames can reach, so that the results equal those of one whole window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from skygrain.plans.durable import materialize

HOT_ROWS_CONF = "spark.skygrain.hotGroupRows"
HOT_ROWS = 2_000_000

PART = "_range"
TIE = "_tie"
OWN = "_own_row"
ROW_NO = "_row_no"
GROUP_ROWS = "_group_rows"
HOT_COUNT = "_hot_rows"

Build = Callable[[DataFrame, WindowSpec], DataFrame]


def hot_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(HOT_ROWS)))


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Keys with more rows than one task should sort, and their row counts; None when there are none.

    There are at most (rows / limit) such keys. The table is written, so its joins are planned by its size.
    The count reads only the key columns and is combined before its shuffle.
    """
    over = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(HOT_COUNT)).filter(F.col(HOT_COUNT) > hot_rows(df))
    if over.isEmpty():
        return None
    return materialize(over, "hot-keys")


def _same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


def split_by_key(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of hot keys, all other rows)."""
    left, right = df.alias("l"), hot.alias("r")
    cond = _same_key("l", "r", keys)
    return left.join(right, cond, "left_semi"), left.join(right, cond, "left_anti")


def ranges_for(hot: DataFrame) -> int:
    """How many ranges keep the hot keys' rows at ``HOT_ROWS`` a task, and no fewer than the session's partitions."""
    total = hot.agg(F.coalesce(F.sum(HOT_COUNT), F.lit(0))).first()[0]
    least = int(hot.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(total / hot_rows(hot)))


def cut_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], count: int | None = None,
               unique: bool = False, shuffled: bool = False) -> DataFrame:
    """Sort by (keys, order) over the cluster, note each row's range, and write the result.

    The cut points are sampled, so the table is written before anything relies on the range numbers. ``_tie`` makes
    the order total: many copies of one row are spread over several ranges too. With ``unique`` the order is total
    already. ``shuffled`` input may be numbered differently when a lost task is run again, which could lose or double
    a tied row between ranges, so its numbered rows are written first. ``count`` sets the number of ranges.
    """
    if unique:
        numbered, by = df.withColumn(TIE, F.lit(0).cast("long")), [*keys, *order]
    else:
        numbered, by = df.withColumn(TIE, F.monotonically_increasing_id()), [*keys, *order, TIE]
        if shuffled:
            numbered = materialize(numbered, "numbered")
    ranged = numbered.repartitionByRange(count, *by) if count else numbered.repartitionByRange(*by)
    return materialize(ranged.withColumn(PART, F.spark_partition_id()), "ranges")


def range_offsets(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per (key, range): rows in it, rows before it and rows of the whole key.

    There are at most (keys + ranges) such rows.
    """
    whole = Window.partitionBy(*keys)
    before = whole.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranges.groupBy(*keys, PART)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn(GROUP_ROWS, F.sum("_n").over(whole))
    )


def _borrowed(ranges: DataFrame, offsets: DataFrame, keys: Sequence[str], order: Sequence[str], reach: int,
              earlier: bool) -> DataFrame:
    """Copies of the rows that other ranges of the same key can reach.

    ``earlier`` copies the last ``reach`` rows of a range forward to later ranges, otherwise its first rows backward.
    Ranges are never empty, so the rows a range can reach lie in at most ``reach`` neighbours.
    """
    chain = Window.partitionBy(*keys).orderBy(PART)
    edge = Window.partitionBy(*keys, PART).orderBy(*[F.desc(c) if earlier else F.asc(c) for c in (*order, TIE)])
    span = chain.rowsBetween(1, reach) if earlier else chain.rowsBetween(-reach, -1)
    targets = (
        offsets.withColumn("_near", F.collect_list(F.struct(PART, "_start", "_n")).over(span))
        .withColumn("_t", F.explode("_near"))
        .select(
            *keys,
            PART,
            F.col(f"_t.{PART}").alias("_to"),
            (
                F.col("_t._start") - F.col("_start") - F.col("_n")
                if earlier
                else F.col("_start") - F.col("_t._start") - F.col("_t._n")
            ).alias("_gap"),
        )
        .filter(F.col("_gap") < reach)
    )
    near = ranges.withColumn("_rank", F.row_number().over(edge)).filter(F.col("_rank") <= reach)
    cond = _same_key("a", "b", keys) & (F.col(f"a.{PART}") == F.col(f"b.{PART}"))
    return (
        near.alias("a")
        .join(targets.alias("b"), cond)
        .filter(F.col("a._rank") + F.col("b._gap") <= reach)
        .select(*[F.col(f"a.{c}") for c in ranges.columns if c != PART], F.col("b._to").alias(PART))
    )


def ordered_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], build: Build, back: int = 0,
                 ahead: int = 0, numbered: bool = False) -> DataFrame:
    """Apply ``build(rows, window)`` to each key's rows in ``order``.

    ``build`` may add columns that look at most ``back`` rows back and ``ahead`` rows ahead. With ``numbered`` it
    also sees ``_row_no`` (1-based position) and ``_group_rows`` (rows of the key). ``order`` should be unique per key;
    rows that tie in it come in any order.
    """
    hot = hot_keys(df, keys)
    if hot is None:
        return _whole_windows(df, keys, order, build, numbered)
    big, rest = split_by_key(df, hot, keys)
    done = _range_windows(big, keys, order, build, back, ahead, numbered, ranges_for(hot))
    return _whole_windows(rest, keys, order, build, numbered).unionByName(done)


def _whole_windows(df: DataFrame, keys: Sequence[str], order: Sequence[str], build: Build, numbered: bool) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    if not numbered:
        return build(df, w)
    rows = df.withColumn(ROW_NO, F.row_number().over(w).cast("long")).withColumn(
        GROUP_ROWS, F.count(F.lit(1)).over(Window.partitionBy(*keys))
    )
    return build(rows, w).drop(ROW_NO, GROUP_ROWS)


def _range_windows(df: DataFrame, keys: Sequence[str], order: Sequence[str], build: Build, back: int, ahead: int,
                   numbered: bool, count: int) -> DataFrame:
    ranges = cut_ranges(df, keys, order, count, shuffled=True)
    offsets = range_offsets(ranges, keys)
    own = ranges
    if numbered:
        own = number_rows(ranges, offsets, keys, order)
    rows = own.withColumn(OWN, F.lit(True))
    for reach, earlier in ((back, True), (ahead, False)):
        if reach:
            copies = _borrowed(ranges, offsets, keys, order, reach, earlier).withColumn(OWN, F.lit(False))
            rows = rows.unionByName(copies, allowMissingColumns=numbered)
    built = build(rows, Window.partitionBy(*keys, PART).orderBy(*order, TIE))
    return built.filter(OWN).drop(OWN, PART, TIE, ROW_NO, GROUP_ROWS)


def number_rows(ranges: DataFrame, offsets: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Position of each row within its key, from range offsets and the position within the range."""
    local = Window.partitionBy(*keys, PART).orderBy(*order, TIE)
    cond = _same_key("a", "b", keys) & (F.col(f"a.{PART}") == F.col(f"b.{PART}"))
    return (
        ranges.withColumn("_local", F.row_number().over(local))
        .alias("a")
        .join(offsets.alias("b"), cond)
        .select(
            *[F.col(f"a.{c}") for c in ranges.columns],
            (F.col("b._start") + F.col("a._local")).cast("long").alias(ROW_NO),
            F.col(f"b.{GROUP_ROWS}").alias(GROUP_ROWS),
        )
    )
