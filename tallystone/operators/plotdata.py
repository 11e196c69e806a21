"""The data behind the plots: bins, curves and cells as tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystone.functions.columns import column_aggregates, double_literal, number, ref
from tallystone.operators.metrics import score_cells
from tallystone.operators.quantiles import exact_quantiles

BINS_PER_BANDWIDTH = 32  # resolution of the density estimate
SPAN = {"min": "min({v})", "max": "max({v})"}
GRID = 200  # fixed value: points of a density curve


def auto_bins(n: int, low: float, high: float, iqr: float) -> int:
    """The smaller of the Freedman–Diaconis and Sturges widths, as a number of bins."""
    if n == 0 or high == low:
        return 1
    width = (high - low) / (math.log2(n) + 1.0)
    robust = 2.0 * iqr / n ** (1.0 / 3.0)
    if robust > 0:
        width = min(width, robust)
    return max(1, math.ceil((high - low) / width))


def _binned(df: DataFrame, spans: dict[str, tuple[float, float, int]]) -> DataFrame:
    """``(column, bin, value)`` with equal-width bins; the last bin includes the maximum."""
    entries = []
    for c, (low, high, bins) in spans.items():
        v = number(df, c)
        if high > low:
            place = F.floor((v - low) * bins / (high - low)).cast("long" if bins > 2**31 else "int")
            place = F.least(place, F.lit(bins - 1))
        else:
            place = F.lit(0)
        entries.append(
            F.struct(F.lit(c).alias("column"), F.when(v.isNotNull(), place).alias("bin"), v.alias("value"))
        )
    return df.select(F.inline(F.array(*entries))).where(F.col("bin").isNotNull())


def histogram(df: DataFrame, columns: Sequence[str], bins: int | str = "auto") -> DataFrame:
    """``(column, bin, left_edge, right_edge, n)`` for all columns, empty bins included."""
    spans = {}
    if bins == "auto":
        found = exact_quantiles(df, columns, [0.25, 0.75], extras=SPAN)
        for c, s in found.items():
            if s.n:
                low, high = s.extras["min"], s.extras["max"]
                spans[c] = (low, high, auto_bins(s.n, low, high, s.values[0.75] - s.values[0.25]))
    else:
        for c, low, high in column_aggregates(df, columns, SPAN).collect():  # one row per column
            if low is not None:
                spans[c] = (low, high, int(bins))
    counts = _binned(df, spans).groupBy("column", "bin").agg(F.count("*").alias("n"))
    frame = df.sparkSession.createDataFrame(
        [(c, low, (high - low) / b, b) for c, (low, high, b) in spans.items()],
        "column string, low double, width double, bins int",
    )
    every = frame.select("column", "low", "width", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"))
    return every.join(counts, ["column", "bin"], "left").select(
        "column",
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("left_edge"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def density(
    df: DataFrame, columns: Sequence[str], grid: int = GRID, bins_per_bandwidth: int = BINS_PER_BANDWIDTH
) -> DataFrame:
    """Gaussian kernel density on an even grid over the data range, Scott bandwidth.

    Rows are reduced to bins of a fixed fraction of the bandwidth, each kept by count, mean and variance;
    empty bins cost nothing. A bin's kernel sum is its Taylor sum around the mean up to the variance, so the
    error is of the third order in that fraction, however long the tails are.
    """
    fields = {"n": "count({v})", **SPAN, "s": "stddev_samp({v})"}
    rows = [r for r in column_aggregates(df, columns, fields).collect() if r["n"] > 1 and r["s"] > 0]
    width = {r["column"]: r["s"] * r["n"] ** -0.2 / bins_per_bandwidth for r in rows}
    spans = {r["column"]: (r["min"], r["max"], math.ceil((r["max"] - r["min"]) / width[r["column"]])) for r in rows}
    cells = _binned(df, spans).groupBy("column", "bin").agg(
        F.count("*").alias("n"), F.avg("value").alias("center"), F.var_pop("value").alias("spread")
    )
    shape = df.sparkSession.createDataFrame(
        [
            (r["column"], r["min"], (r["max"] - r["min"]) / (grid - 1), r["s"] * r["n"] ** -0.2, r["n"])
            for r in rows
        ],
        "column string, low double, step double, bandwidth double, total long",
    )
    u = (F.col("x") - F.col("center")) / F.col("bandwidth")
    bent = 1.0 + 0.5 * F.col("spread") / (F.col("bandwidth") * F.col("bandwidth")) * (u * u - 1.0)
    kernel = F.col("n") * bent * F.exp(-0.5 * u * u) / (F.col("total") * F.col("bandwidth") * math.sqrt(2 * math.pi))
    return (
        cells.join(F.broadcast(shape), "column")  # one row per column
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
        .withColumn("x", F.col("low") + F.col("point") * F.col("step"))
        .groupBy("column", "point", "x")
        .agg(F.sum(kernel).alias("density"))
    )


def _box_bounds(df: DataFrame, columns: Sequence[str], k: float) -> dict[str, tuple[float, ...]]:
    found = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    out = {}
    for c, s in found.items():
        if s.n:
            q1, q2, q3 = (s.values[q] for q in (0.25, 0.5, 0.75))
            out[c] = (q1, q2, q3, q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return out


def box_stats(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> DataFrame:
    """Quartiles, mean, whiskers at the furthest value within k·IQR, and the number beyond them."""
    bounds = _box_bounds(df, columns, k)

    def at(i: int) -> Callable[[str], str]:
        return lambda c: f"any_value({double_literal(bounds[c][i])})"

    def low(c: str) -> str:
        return double_literal(bounds[c][3])

    def high(c: str) -> str:
        return double_literal(bounds[c][4])

    fields = {
        "q1": at(0),
        "median": at(1),
        "q3": at(2),
        "mean": "avg({v})",
        "whisker_low": lambda c: f"min(CASE WHEN {{v}} >= {low(c)} THEN {{v}} END)",
        "whisker_high": lambda c: f"max(CASE WHEN {{v}} <= {high(c)} THEN {{v}} END)",
        "n_outliers": lambda c: f"count_if({{v}} < {low(c)} OR {{v}} > {high(c)})",
    }
    return column_aggregates(df, list(bounds), fields)


def box_outliers(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> DataFrame:
    """The values beyond the whiskers, each with its number of rows."""
    entries = []
    for c, (_, _, _, low, high) in _box_bounds(df, columns, k).items():
        v = number(df, c)
        entries.append(F.struct(F.lit(c).alias("column"), F.when((v < low) | (v > high), v).alias("value")))
    rows = df.select(F.inline(F.array(*entries))).where(F.col("value").isNotNull())
    return rows.groupBy("column", "value").agg(F.count("*").alias("n"))


def roc_points(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """``(threshold, fpr, tpr)`` at every distinct score; the origin has an infinite threshold."""
    return _curve(score_cells(scored, y, p), lambda tp, fp, pos, neg: {
        "fpr": F.try_divide(fp, neg), "tpr": F.try_divide(tp, pos)
    }, (float("inf"), 0.0, 0.0))


def precision_recall_points(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """``(threshold, precision, recall)`` at every distinct score; the curve ends at (1, 0)."""
    return _curve(score_cells(scored, y, p), lambda tp, fp, pos, neg: {
        "precision": tp / (tp + fp), "recall": F.try_divide(tp, pos)
    }, (float("inf"), 1.0, 0.0))


def _curve(cells: DataFrame, make, end: tuple[float, float, float]) -> DataFrame:
    pos, neg = cells.agg(F.sum("pos"), F.sum("neg")).first()  # two numbers
    tp, fp = F.col("pos_upto").cast("double"), F.col("neg_upto").cast("double")
    columns = make(tp, fp, F.lit(pos).cast("double"), F.lit(neg).cast("double"))
    points = cells.select(F.col("score").alias("threshold"), *[c.alias(n) for n, c in columns.items()])
    last = cells.sparkSession.createDataFrame([end], points.schema)
    return points.unionByName(last)


def calibration_curve(scored: DataFrame, y: str = "y", p: str = "p", bins: int = 10) -> DataFrame:
    """Mean predicted probability and share of positives per equal-width bin of the score."""
    score = ref(p).cast("double")
    place = sum(((score > i / bins).cast("int") for i in range(1, bins)), F.lit(0))
    return scored.groupBy(place.alias("bin")).agg(
        F.count("*").alias("n"),
        F.avg(score).alias("mean_predicted"),
        F.avg(ref(y)).alias("positive_share"),
    )


def importance_bars(importances: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` largest ``(feature, importance)`` rows with their position."""
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("importance"), "feature")  # one row per feature
    return importances.withColumn("position", F.row_number().over(w)).where(F.col("position") <= n)
