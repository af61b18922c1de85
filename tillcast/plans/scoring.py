"""Recursive scoring with a caller's model: the one step that runs in Python.

Each prediction enters the window of the next, and the model is an arbitrary
callable, so a series is handed whole to a grouped-map function.  A series is
at most a few hundred rows; Spark shuffles and schedules the series.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.operators.predicates import with_saturday_off
from tillcast.operators.snapshot import top_n_by

LOOKBACK, HORIZON, STEPS = 15, 10, 32
MIN_ROWS = 57  # fixed value: series with fewer days are not scored

Model = Callable[[np.ndarray], float]


def framed_row(window: np.ndarray, horizon: int = HORIZON) -> np.ndarray:
    """Model input out of one scaled window of ``lookback + horizon`` rows.

    Rows are laid out in time order; the own metric (column 0) is left out of
    the horizon rows, the last of which is the target.
    """
    keep = np.ones(window.shape, dtype=bool)
    keep[-horizon:, 0] = False
    return window[keep]


def score_series(
    values: np.ndarray,
    closed: np.ndarray,
    model: Model,
    median: np.ndarray,
    iqr: np.ndarray,
    lookback: int = LOOKBACK,
    horizon: int = HORIZON,
    steps: int = STEPS,
) -> np.ndarray:
    """Own metric of the last ``steps`` rows, predicted one after the other."""
    rows = values.astype("float64").copy()
    scale = np.where(iqr != 0, iqr, 1.0)
    shift = np.where(iqr != 0, median, 0.0)
    first = len(rows) - steps
    for t in range(first, len(rows)):
        if closed[t]:
            rows[t, 0] = 0.0
            continue
        window = (rows[t - lookback - horizon + 1 : t + 1] - shift) / scale
        rows[t, 0] = float(model(framed_row(window, horizon))) * scale[0] + shift[0]
    return rows[first:, 0]


def score_recursive(
    df: DataFrame,
    keys: list[str],
    metric: str,
    features: list[str],
    model: Model,
    median: list[float],
    iqr: list[float],
    sat_off: DataFrame,
    lookback: int = LOOKBACK,
    horizon: int = HORIZON,
    steps: int = STEPS,
) -> DataFrame:
    """Predictions for the last ``steps`` days of every series; holidays are 0.

    ``features`` follow the metric as model columns.  Series too short for one
    window give no rows here: see :func:`score_gated`.
    """
    med, spread = np.asarray(median, "float64"), np.asarray(iqr, "float64")
    columns = [metric, *features]
    flagged = with_saturday_off(df, sat_off)
    shut = (F.col("dayofweek") == 7) | (F.col("_sat_off") & (F.col("dayofweek") == 6))
    prepared = flagged.select(
        *keys,
        "business_date",
        *[F.col(c).cast("double").alias(c) for c in columns],
        shut.alias("_closed"),
        (F.col("holiday") == 1).alias("_holiday"),
    )
    schema = T.StructType(
        [prepared.schema[k] for k in keys]
        + [
            T.StructField("business_date", T.DateType()),
            T.StructField("forecast", T.DoubleType()),
        ]
    )

    def score(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("business_date")
        tail = group.tail(steps)
        if len(group) < steps + lookback + horizon - 1:
            return tail.iloc[:0][[*keys, "business_date"]].assign(forecast=[])
        scored = score_series(
            group[columns].to_numpy(), group["_closed"].to_numpy(), model, med, spread,
            lookback, horizon, steps,
        )
        scored = np.where(tail["_holiday"].to_numpy(), 0.0, np.maximum(scored, 0.0))
        return tail[[*keys, "business_date"]].assign(forecast=scored)

    return prepared.groupBy(*keys).applyInPandas(score, schema)


def gates(
    df: DataFrame, keys: list[str], as_of: date, rows: int = MIN_ROWS, steps: int = STEPS, limit: int = 6
) -> DataFrame:
    """Per series its rows and the gate that it meets: ``short``, ``stale``, or null to be scored.

    A short series has fewer than ``rows`` days; of a stale one the first day to forecast
    lies more than ``limit`` days before the run date.
    """
    first = F.date_sub(F.max("business_date"), steps - 1)
    series = df.groupBy(*keys).agg(F.count("*").alias("rows_count"), first.alias("first_forecast_date"))
    short = F.when(F.col("rows_count") < rows, "short")
    stale = F.when(F.datediff(F.lit(as_of), "first_forecast_date") > limit, "stale")
    return series.withColumn("gate", F.coalesce(short, stale))


def score_gated(
    df: DataFrame,
    keys: list[str],
    metric: str,
    features: list[str],
    model: Model,
    median: list[float],
    iqr: list[float],
    sat_off: DataFrame,
    as_of: date,
    rows: int = MIN_ROWS,
    steps: int = STEPS,
    **window: int,
) -> tuple[DataFrame, DataFrame]:
    """Two outputs: forecasts of the last ``steps`` days, and the short series with the reason.

    Short series are left to the naive forecast; stale ones are forecast as 0 on each of
    their days; all others are scored.  Every series is in one of the two outputs.
    """
    known = gates(df, keys, as_of, rows, steps)

    def of(gate: Column) -> DataFrame:
        return df.join(known.where(gate).select(*keys), keys, "left_semi")

    scored = score_recursive(
        of(F.col("gate").isNull()), keys, metric, features, model, median, iqr, sat_off, steps=steps, **window
    )
    zeros = top_n_by(of(F.col("gate") == "stale"), keys, [F.desc("business_date")], steps)
    zeros = zeros.select(*keys, "business_date", F.lit(0.0).alias("forecast"))
    gated = known.where("gate = 'short'").select(*keys, "rows_count", F.col("gate").alias("reason"))
    return scored.unionByName(zeros), gated


def apply_by_key(
    df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema
) -> DataFrame:
    """Grouped map for bounded groups; use built-in expressions wherever they do."""
    return df.groupBy(*keys).applyInPandas(fn, schema)
