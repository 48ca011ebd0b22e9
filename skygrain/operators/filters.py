"""Row filters and cleaning reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skygrain.functions.values import PHYSICAL_LIMITS, within_limits


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any of the columns."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def clean_rows(df: DataFrame) -> Column:
    """True for rows without nulls whose present variables lie within their physical limits."""
    ok = F.lit(True)
    for name in df.columns:
        ok = ok & F.col(name).isNotNull()
    for name, _ in _limited(df):
        ok = ok & within_limits(F.col(name), name)
    return ok


def _limited(df: DataFrame) -> list[tuple[str, tuple]]:
    return [(n, lim) for n, lim in PHYSICAL_LIMITS.items() if n in df.columns]


def physical_range_filter(df: DataFrame) -> DataFrame:
    """Drop rows with nulls, then rows outside the physical limits of the columns that exist."""
    out = drop_nulls(df)
    for name, _ in _limited(df):
        out = out.filter(within_limits(F.col(name), name))
    return out


def removed_rows(df: DataFrame) -> DataFrame:
    """Rows before and after cleaning, in one pass."""
    kept = F.count_if(clean_rows(df))
    total = F.count(F.lit(1))
    return df.agg(total.alias("rows_before"), kept.alias("rows_after"), (total - kept).alias("rows_removed"))


def recent_window(df: DataFrame, now: Column, minutes: int = 15, time: str = "created_at") -> DataFrame:
    """Rows created in the last ``minutes`` before ``now``."""
    return df.filter(F.col(time) >= now - F.expr(f"INTERVAL {int(minutes)} MINUTES"))


def by_horizon(df: DataFrame) -> DataFrame:
    return df.orderBy("horizon_hours", "created_at")


def select_available(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in columns if c in df.columns])
