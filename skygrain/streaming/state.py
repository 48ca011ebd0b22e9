"""Stateful feature engineering: the dedup anchor and the last rows of each location as streaming state.

Row frames do not exist on streams, so each location keeps the 23 rows before the current one (the widest feature
looks at 24), the last accepted row and a running count. Within a micro-batch rows are taken in event-time order;
across batches arrival order rules. State is checkpointed, so a restart goes on with the history it had.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from skygrain.functions import series as S
from skygrain.operators.dedup import TOLERANCES, fold_run
from skygrain.operators.features import SERIES, historical_names

VARIABLES = list(TOLERANCES)
SERIES_COLUMNS = list(SERIES.values())
STATE = T.StructType(
    [T.StructField("samples", T.LongType()), T.StructField("anchor", T.ArrayType(T.DoubleType()))]
    + [T.StructField(c, T.ArrayType(T.DoubleType())) for c in SERIES_COLUMNS]
)


def rolling_frame(x: np.ndarray, n: int) -> np.ndarray:
    """Each row's last ``n`` values (missing rows before the start are NaN)."""
    padded = np.concatenate([np.full(n - 1, np.nan), x])
    return np.lib.stride_tricks.sliding_window_view(padded, n)


def history_values(columns: dict[str, np.ndarray], new: int) -> pd.DataFrame:
    """The 73 historical values for the last ``new`` rows of each series (NaN = null)."""
    out: dict[str, np.ndarray] = {}
    total = len(next(iter(columns.values())))
    position = np.arange(1, total + 1)
    take = slice(total - new, total)

    def shifted(x: np.ndarray, n: int) -> np.ndarray:
        return np.concatenate([np.full(min(n, total), np.nan), x[: max(total - n, 0)]])

    def stats(x: np.ndarray, n: int) -> dict[str, np.ndarray]:
        frame = rolling_frame(x, n)
        seen = np.count_nonzero(~np.isnan(frame), axis=1)
        ok = (position >= n) & (seen > 0)
        filled = np.where(np.isnan(frame), 0.0, frame)
        mean = filled.sum(axis=1) / np.maximum(seen, 1)
        spread = np.where(np.isnan(frame), 0.0, frame - mean[:, None])
        std = np.sqrt((spread**2).sum(axis=1) / np.maximum(seen, 1))
        low = np.where(np.isnan(frame), np.inf, frame).min(axis=1)
        high = np.where(np.isnan(frame), -np.inf, frame).max(axis=1)
        named = {"mean": mean, "std": std, "min": low, "max": high}
        return {f"{k}_{n}h": np.where(ok, v, np.nan)[take] for k, v in named.items()}

    for s, c in SERIES.items():
        x = columns[c]
        for n in S.ROLLING_ROWS:
            out |= {f"{s}_{k}": v for k, v in stats(x, n).items()}
        out |= {f"{s}_delta_{n}h": (x - shifted(x, n))[take] for n in S.DELTA_ROWS[s]}
        out |= {f"{s}_lag_{n}h": shifted(x, n)[take] for n in S.LAG_ROWS[s]}
    for s, n in S.RATE_ROWS:
        x = columns[SERIES[s]]
        out[f"{s}_roc_{n}h"] = ((x - shifted(x, n)) / n)[take]
    out["temp_volatility_6h"] = out["temp_std_6h"]
    return pd.DataFrame(out)


def _advance(rows: pd.DataFrame, state: GroupState, dedup: bool) -> pd.DataFrame:
    samples, anchor, history = 0, None, {c: np.array([]) for c in SERIES_COLUMNS}
    if state.exists:
        samples, saved, *kept = state.get
        history = {c: np.array([np.nan if v is None else v for v in h], dtype=float) for c, h in zip(SERIES_COLUMNS, kept)}
        if saved is not None:
            values = np.array([np.nan if v is None else v for v in saved], dtype=float)
            anchor = (np.nan_to_num(values), np.isnan(values))
    rows = rows.sort_values(["event_time", "id"], kind="stable").reset_index(drop=True)
    if dedup:
        x = rows[VARIABLES].to_numpy(dtype=float)
        keep, anchor, _ = fold_run(np.nan_to_num(x), np.isnan(x), np.array(list(TOLERANCES.values())), anchor)
        rows = rows[keep].reset_index(drop=True)
    new = len(rows)
    series = {c: np.concatenate([history[c], rows[c].to_numpy(dtype=float)]) for c in SERIES_COLUMNS}
    # History reaches back to the first sample or at least 23 rows, so positions below 24 are exact counts.
    features = history_values(series, new)
    features["samples"] = samples + np.arange(1, new + 1)
    kept = [[None if np.isnan(v) else float(v) for v in series[c][-S.STREAM_BACK:]] for c in SERIES_COLUMNS]
    saved = None if anchor is None else [None if n else float(v) for v, n in zip(*anchor)]
    state.update((samples + new, saved, *kept))
    return pd.concat([rows, features], axis=1)


def with_history(stream: DataFrame, key: str, dedup: bool = True) -> DataFrame:
    """Add the flat historical values and ``samples`` to a stream of observations, dropping unchanged rows.

    Expects ``event_time`` and ``id`` for the order within a micro-batch.
    """
    numeric = [c for c in VARIABLES]
    typed = stream.withColumns({c: F.col(c).cast("double") for c in numeric})
    out = T.StructType(
        [*typed.schema.fields]
        + [T.StructField(n, T.DoubleType()) for n in historical_names()]
        + [T.StructField("samples", T.LongType())]
    )
    names = out.fieldNames()

    def run(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames), ignore_index=True)
        done = _advance(rows, state, dedup)
        yield done[names]

    return typed.groupBy(key).applyInPandasWithState(run, out, STATE, "append", GroupStateTimeout.NoTimeout)
