"""Drop observations that did not change since the last accepted one.

A row is a duplicate when every variable is within its tolerance of the *last accepted* row of its location (null
equals null, null differs from a value). The accepted row moves only on a change, so the rule is a fold over time and
``lag`` cannot express it. Rows stream through each task in order and only the last accepted row is carried along.
A location too large for one task is cut into time ranges, which are folded at the same time. A range with a reset (a
row too far from the one before to be a duplicate) ends alike whatever is carried into it; the others are folded again
wherever the row carried in turns out different, until nothing changes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from skygrain.plans.durable import materialize
from skygrain.plans.skew import PART, TIE, cut_ranges, hot_keys, ranges_for, split_by_key

# Largest change of each variable that still counts as unchanged.
TOLERANCES = {
    "temperature": 0.01,
    "humidity": 0.1,
    "wind_speed": 0.01,
    "pressure": 0.1,
    "cloud_cover": 0.1,
    "precipitation": 0.001,
}
ACCEPTED = "accepted"
CERTAIN = "_certain"  # a range whose last accepted row does not depend on the row carried into it
FIRST_BLOCK = 4  # rows compared at once after an accepted one; doubles while nothing differs


def changed(row: np.ndarray, anchor: np.ndarray, tol: np.ndarray, row_null: np.ndarray, anchor_null: np.ndarray):
    """Which rows (last axis = variables) differ from the anchor."""
    with np.errstate(invalid="ignore"):
        beyond = (np.abs(row - anchor) > tol) & ~row_null & ~anchor_null
    return (beyond | (row_null != anchor_null)).any(axis=-1)


def fold_run(x: np.ndarray, nulls: np.ndarray, tol: np.ndarray, anchor: tuple | None) -> tuple[np.ndarray, tuple, bool]:
    """Accepted flags of one location's rows in order, the last accepted row, and whether the run holds a reset.

    The last accepted row is always within tolerance of the row just passed. So a row that moves by more than twice
    the tolerance is new whatever was accepted last (a reset), and a row equal to the one before is a duplicate. The
    rows in between are compared with the accepted row in blocks that double until one differs; the fold goes on from
    that row. Slow drift costs a few block comparisons per accepted row instead of one comparison per row.
    """
    n = len(x)
    keep = np.zeros(n, dtype=bool)
    open_ = np.ones(n, dtype=bool)
    plain = not np.isnan(x[~nulls]).any() and (anchor is None or not np.isnan(anchor[0][~anchor[1]]).any())
    if plain and n > 1:
        slack = 2 * tol + 1e-9 * (1 + np.abs(np.where(nulls, 0, x)).max(axis=0))
        new = changed(x[1:], x[:-1], slack, nulls[1:], nulls[:-1])
        same = (nulls[1:] == nulls[:-1]).all(axis=1) & ((x[1:] == x[:-1]) | nulls[1:]).all(axis=1)
        keep[1:] = new
        open_[1:] = ~(new | same)
    resets = np.flatnonzero(keep)
    rows = np.flatnonzero(open_)
    stops = np.append(np.searchsorted(rows, resets), len(rows))  # open rows before each reset, and before the end
    whole = not nulls.any()
    starts = np.concatenate([[0], stops[:-1]])
    for k in np.flatnonzero(stops > starts):
        at, stop = starts[k], stops[k]
        if k:
            anchor = (x[resets[k - 1]], nulls[resets[k - 1]])
        if anchor is None:
            keep[rows[at]] = True
            anchor = (x[rows[at]], nulls[rows[at]])
            at += 1
        size = FIRST_BLOCK
        while at < stop:
            block = rows[at : min(at + size, stop)]
            if whole and not anchor[1].any():
                with np.errstate(invalid="ignore"):
                    differs = (np.abs(x[block] - anchor[0]) > tol).any(axis=1)
            else:
                differs = changed(x[block], anchor[0], tol, nulls[block], anchor[1])
            first = int(differs.argmax())
            if differs[first]:
                keep[block[first]] = True
                anchor = (x[block[first]], nulls[block[first]])
                at += first + 1
                size = max(FIRST_BLOCK, 2 * (first + 1))
            else:
                at += len(block)
                size *= 2
    last = np.flatnonzero(keep)
    return keep, (x[last[-1]], nulls[last[-1]]) if last.size else anchor, bool(len(resets))


def _matrix(batch: pa.RecordBatch, names: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    cols = [batch.column(batch.schema.get_field_index(n)) for n in names]
    nulls = np.column_stack([np.asarray(c.is_null()) for c in cols])
    x = np.column_stack([pc.fill_null(c.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False) for c in cols])
    return x, nulls


def _key_starts(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Positions where a new key begins within the batch (position 0 excluded)."""
    n = batch.num_rows
    new = np.zeros(max(n - 1, 0), dtype=bool)
    for k in keys:
        c = batch.column(batch.schema.get_field_index(k))
        differ = pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, n - 1)), False)
        null_differ = pc.not_equal(c.slice(1).is_null(), c.slice(0, n - 1).is_null())
        new |= np.asarray(differ) | np.asarray(null_differ)
    return np.flatnonzero(new) + 1


def _fold(keys: Sequence[str], tolerances: Mapping[str, float], carried: bool, ends_only: bool) -> Callable:
    """Arrow batches (sorted by keys and time) to flagged batches, or to one row per key with its last accepted row.

    With ``carried`` the rows bring the start row of their key in columns ``_start_*`` (``_has_start``).
    """
    names, tol = list(tolerances), np.array(list(tolerances.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, anchor, certain = None, None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            x, nulls = _matrix(batch, names)
            bounds = [0, *_key_starts(batch, keys).tolist(), batch.num_rows]
            keep = np.zeros(batch.num_rows, dtype=bool)
            closed = []
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                here = tuple(batch.column(batch.schema.get_field_index(k))[lo].as_py() for k in keys)
                if here != key:
                    if key is not None:
                        closed.append((key, anchor, certain))
                    key, anchor, certain = here, None, False
                    if carried and batch.column(batch.schema.get_field_index("_has_start"))[lo].as_py():
                        sx, sn = _matrix(batch.slice(lo, 1), [f"_start_{n}" for n in names])
                        anchor = (sx[0], sn[0])
                keep[lo:hi], anchor, reset = fold_run(x[lo:hi], nulls[lo:hi], tol, anchor)
                certain |= reset
            if not ends_only:
                cols = [batch.column(i) for i, n in enumerate(batch.schema.names) if not n.startswith("_start_")
                        and n != "_has_start"]
                kept_names = [n for n in batch.schema.names if not n.startswith("_start_") and n != "_has_start"]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(keep)], [*kept_names, ACCEPTED])
            elif closed:
                yield _ends(closed, keys, names, batch.schema)
        if ends_only and key is not None:
            yield _ends([(key, anchor, certain)], keys, names, batch.schema)

    return run


def _ends(closed: list, keys: Sequence[str], names: Sequence[str], schema: pa.Schema) -> pa.RecordBatch:
    cols = [pa.array([k[i] for k, *_ in closed], schema.field(name).type) for i, name in enumerate(keys)]
    for j in range(len(names)):
        cols.append(pa.array([None if a[1][j] else float(a[0][j]) for _, a, _ in closed], pa.float64()))
    cols.append(pa.array([c for *_, c in closed], pa.bool_()))
    return pa.RecordBatch.from_arrays(cols, [*keys, *[f"_end_{n}" for n in names], CERTAIN])


def flag_unchanged(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   tolerances: Mapping[str, float] | None = None) -> DataFrame:
    """Add ``accepted``: false where a row repeats the last accepted row of its key."""
    tol = {n: t for n, t in (tolerances or TOLERANCES).items() if n in df.columns}
    hot = hot_keys(df, keys)
    if hot is None:
        return _flag_whole(df, keys, order, tol)
    big, rest = split_by_key(df, hot, keys)
    return _flag_whole(rest, keys, order, tol).unionByName(_flag_ranges(big, keys, order, tol, ranges_for(hot)))


def _flagged(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(ACCEPTED, T.BooleanType())])


def _flag_whole(df: DataFrame, keys: Sequence[str], order: Sequence[str], tol: Mapping[str, float]) -> DataFrame:
    sorted_ = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return sorted_.mapInArrow(_fold(keys, tol, False, False), _flagged(df.schema))


def _flag_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], tol: Mapping[str, float],
                 count: int) -> DataFrame:
    ranges = cut_ranges(df, keys, order, count, shuffled=True)
    at, order = [*keys, PART], [*order, TIE]
    names = list(tol)
    end_schema = T.StructType(
        [ranges.schema[k] for k in at] + [T.StructField(f"_end_{n}", T.DoubleType()) for n in names]
        + [T.StructField(CERTAIN, T.BooleanType())]
    )
    chain = Window.partitionBy(*keys).orderBy(PART)
    has, starts_cols = "_has_start", [f"_start_{n}" for n in names]

    def starts_from(ends: DataFrame) -> DataFrame:
        return ends.select(
            *at,
            F.lag(F.lit(True), 1, False).over(chain).alias(has),
            *[F.lag(f"_end_{n}").over(chain).alias(f"_start_{n}") for n in names],
        )

    def with_starts(starts: DataFrame) -> DataFrame:
        joined = ranges.alias("a").join(starts.alias("b"), _equal(at))
        picked = joined.select("a.*", *[F.col(f"b.{c}") for c in (has, *starts_cols)])
        return picked.repartition(*at).sortWithinPartitions(*at, *order)

    def fold_ends(rows: DataFrame) -> DataFrame:
        narrow = rows.select(*at, *order, *[n for n in names if n not in order], has, *starts_cols)
        return narrow.mapInArrow(_fold(at, tol, True, True), end_schema)

    starts = ranges.select(*at).distinct().select(
        *at, F.lit(False).alias(has), *[F.lit(None).cast("double").alias(c) for c in starts_cols]
    )
    ends = materialize(fold_ends(with_starts(starts)), "dedup-ends")
    odd = F.lit(False)
    for c in starts_cols:
        odd = odd | F.coalesce(F.isnan(f"a.{c}"), F.lit(False))
    while True:
        new = materialize(starts_from(ends), "dedup-starts")
        differs = ~F.struct(*[F.col(f"a.{c}") for c in (has, *starts_cols)]).eqNullSafe(
            F.struct(*[F.col(f"b.{c}") for c in (has, *starts_cols)])
        )
        moved = new.alias("a").join(starts.alias("b"), _equal(at) & differs, "left_semi")
        # A range with a reset ends alike whatever is carried in, unless that is not a number.
        settled = ends.filter(CERTAIN).alias("b")
        moved = materialize(moved.alias("a").join(settled, _equal(at) & ~odd, "left_anti"), "dedup-moved")
        starts = new
        if moved.isEmpty():
            break
        redone = fold_ends(with_starts(moved))
        kept = ends.alias("a").join(moved.alias("b"), _equal(at), "left_anti")
        ends = materialize(kept.unionByName(redone), "dedup-ends")
    rows = with_starts(starts)
    plain = T.StructType([*ranges.schema.fields])
    return rows.mapInArrow(_fold(at, tol, True, False), _flagged(plain)).drop(PART, TIE)


def _equal(columns: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return cond


def dedup_unchanged(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    tolerances: Mapping[str, float] | None = None) -> DataFrame:
    """Only the rows that changed since the last accepted row of their key."""
    return flag_unchanged(df, keys, order, tolerances).filter(ACCEPTED).drop(ACCEPTED)


def dedup_counts(flagged: DataFrame) -> DataFrame:
    """Processed and duplicate counts of a flagged frame."""
    return flagged.agg(
        F.count_if(F.col(ACCEPTED)).alias("processed"),
        F.count_if(~F.col(ACCEPTED)).alias("duplicates"),
    )
