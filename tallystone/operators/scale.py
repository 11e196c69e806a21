"""Scalers: parameters from one aggregate, applied as one projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.functions.columns import number
from tallystone.operators.quantiles import exact_quantiles

METHODS = ("standard", "minmax", "robust", "maxabs")
PARAMS_SCHEMA = "column string, method string, center double, scale double"


def fit_scaler(df: DataFrame, columns: Sequence[str], method: str = "standard") -> DataFrame:
    """``(column, method, center, scale)``; a column without spread gets scale 1.

    standard: mean and population deviation; minmax: minimum and range;
    robust: median and interquartile range; maxabs: 0 and the largest magnitude.
    Columns absent from the table are skipped.
    """
    if method not in METHODS:
        raise ValueError(f"unknown scaling method: {method}")
    columns = [c for c in columns if c in df.columns]
    rows = []
    if method == "robust":
        for c, s in exact_quantiles(df, columns, [0.25, 0.5, 0.75]).items():
            if s.n:
                rows.append((c, s.values[0.5], s.values[0.75] - s.values[0.25]))
    else:
        pair = {
            "standard": lambda v: (F.avg(v), F.stddev_pop(v)),
            "minmax": lambda v: (F.min(v), F.max(v) - F.min(v)),
            "maxabs": lambda v: (F.count(v) * 0.0, F.max(F.abs(v))),
        }[method]
        aggs = []
        for i, c in enumerate(columns):
            center, scale = pair(number(df, c))
            aggs += [center.alias(f"c{i}"), scale.alias(f"s{i}")]
        row = df.agg(*aggs).first() if aggs else {}
        rows = [(c, row[f"c{i}"], row[f"s{i}"]) for i, c in enumerate(columns) if row[f"s{i}"] is not None]
    fitted = [(c, method, float(center), float(scale) or 1.0) for c, center, scale in rows]
    return df.sparkSession.createDataFrame(fitted, PARAMS_SCHEMA)


def _params(params: DataFrame | None) -> list:
    if params is None:
        raise ValueError("the scaler has not been fitted")
    return params.collect()  # one row per column


def apply_scaler(df: DataFrame, params: DataFrame) -> DataFrame:
    return df.withColumns({
        r["column"]: (number(df, r["column"]) - r["center"]) / r["scale"]
        for r in _params(params)
        if r["column"] in df.columns
    })


def invert_scaler(df: DataFrame, params: DataFrame) -> DataFrame:
    """Back to source units."""
    return df.withColumns({
        r["column"]: number(df, r["column"]) * r["scale"] + r["center"]
        for r in _params(params)
        if r["column"] in df.columns
    })
