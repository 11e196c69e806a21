"""Outlier handling: bounds fitted on one table, action applied to any."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystone.functions.columns import number, present, ref
from tallystone.operators.quality import iqr_bounds, zscore_bounds
from tallystone.operators.quantiles import exact_quantiles
from tallystone.session import materialize

BOUNDS_SCHEMA = "column string, method string, lower double, upper double"


def fit_outliers(
    df: DataFrame,
    columns: Sequence[str],
    method: str = "iqr",
    multiplier: float = 1.5,
    threshold: float = 3.0,
) -> DataFrame:
    """Bounds per column by interquartile range (``iqr``) or z-score (``zscore``)."""
    if method == "iqr":
        bounds = iqr_bounds(df, columns, multiplier)
    elif method == "zscore":
        bounds = zscore_bounds(df, columns, threshold)
    else:
        raise ValueError(f"unknown outlier method: {method}")
    rows = [(c, method, b[0], b[1]) for c, b in bounds.items()]
    return df.sparkSession.createDataFrame(rows, BOUNDS_SCHEMA)


def apply_outliers(df: DataFrame, bounds: DataFrame, action: str = "clip") -> DataFrame:
    """``clip`` to the bounds, ``remove`` rows outside any of them, or ``transform`` by log1p.

    A missing value is clipped to nothing, but fails the test of ``remove``.
    ``transform`` touches only columns whose every value is above zero.
    """
    limits = {r["column"]: (r["lower"], r["upper"]) for r in bounds.collect() if r["column"] in df.columns}
    if action == "clip":
        clipped = {}
        for c, (low, high) in limits.items():
            v = number(df, c)
            clipped[c] = F.when(v < low, low).when(v > high, high).otherwise(v)
        return df.withColumns(clipped)
    if action == "remove":
        inside = F.lit(True)
        for c, (low, high) in limits.items():
            inside = inside & present(df, c).between(low, high)
        return df.where(inside)
    if action == "transform":
        least = df.agg(
            *[F.min(number(df, c)).alias(c + "|min") for c in limits],
            *[F.count_if(number(df, c).isNull()).alias(c + "|holes") for c in limits],
        ).first()
        positive = [
            c for c in limits
            if least[c + "|min"] is not None and least[c + "|min"] > 0 and least[c + "|holes"] == 0
        ]
        return df.withColumns({c: F.log1p(number(df, c)) for c in positive})
    raise ValueError(f"unknown outlier action: {action}")


# ---- isolation forest -------------------------------------------------------------------

TREE_ROWS = 256  # fixed value: rows per tree
TREES = 100  # fixed value: trees per forest
EULER = 0.5772156649015329


def _path_norm(n: np.ndarray | float) -> np.ndarray | float:
    """Mean path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        long = 2.0 * (np.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Nodes ``(node, feature, cut, left, right, length)`` of one random tree."""
    nodes: list[tuple] = []
    todo = [(0, np.arange(len(x)), 0)]
    next_id = 1
    while todo:
        node, rows, depth = todo.pop()
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        open_features = np.flatnonzero(high > low)
        if depth >= max_depth or len(rows) <= 1 or len(open_features) == 0:
            nodes.append((node, -1, 0.0, -1, -1, depth + float(_path_norm(len(rows)))))
            continue
        f = int(rng.choice(open_features))
        cut = float(rng.uniform(low[f], high[f]))
        left = x[rows, f] <= cut
        nodes.append((node, f, cut, next_id, next_id + 1, 0.0))
        todo += [(next_id, rows[left], depth + 1), (next_id + 1, rows[~left], depth + 1)]
        next_id += 2
    return nodes


def fit_isolation_forest(
    df: DataFrame, key: str, columns: Sequence[str], trees: int = TREES, seed: int = 42
) -> DataFrame:
    """Node rows of the forest; every tree grows on its own random ``TREE_ROWS`` rows.

    The trees draw from a pool of rows with the lowest key hashes, found with a
    bound on the hash, so the table is scanned but never sorted.
    """
    columns = list(columns)
    rows = df.select(
        ref(key).alias("_key"),
        F.xxhash64(ref(key), F.lit(seed)).alias("_hash"),
        *[F.coalesce(number(df, c), F.lit(0.0)).alias(c) for c in columns],
    )
    n = rows.count()
    need = trees * TREE_ROWS
    share = min(1.0, 1.2 * need / max(n, 1))
    top = 2**63 - 1 if share >= 1.0 else int(-(2**63) + share * 2.0**64)
    pool = materialize(rows.where(F.col("_hash") <= top), "forest-pool")
    depth = int(np.ceil(np.log2(TREE_ROWS)))
    w = Window.partitionBy("tree").orderBy(F.xxhash64("_key", "tree", F.lit(seed)))
    drawn = (
        pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        .withColumn("at", F.row_number().over(w))
        .where(F.col("at") <= TREE_ROWS)
    )

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = pdf.sort_values("at")[columns].to_numpy(dtype=float)
        nodes = _grow(x, np.random.default_rng([seed, tree]), depth)
        out = pd.DataFrame(nodes, columns=["node", "feature", "cut", "left", "right", "length"])
        return out.assign(tree=tree, sample=len(x))

    return drawn.groupBy("tree").applyInPandas(
        grow,
        "node int, feature int, cut double, left int, right int, length double, tree int, sample int",
    )


def isolation_scores(df: DataFrame, columns: Sequence[str], forest: DataFrame, column: str = "score") -> DataFrame:
    """Add the anomaly score; lower is more isolated (the negated 2^(-path/norm))."""
    columns = list(columns)
    # bounded: TREES trees of at most 2 * TREE_ROWS nodes
    nodes = forest.toPandas().sort_values(["tree", "node"])
    packed = []
    for _, t in nodes.groupby("tree"):
        packed.append(tuple(t[f].to_numpy() for f in ("feature", "cut", "left", "right", "length")))
    norm = float(_path_norm(int(nodes["sample"].max())))
    shared = df.sparkSession.sparkContext.broadcast((packed, norm))

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        trees, scale = shared.value
        for parts in batches:
            x = np.column_stack([p.to_numpy(dtype=float) for p in parts])
            total = np.zeros(len(x))
            for feature, cut, left, right, length in trees:
                at = np.zeros(len(x), dtype=np.int64)
                while True:
                    f = feature[at]
                    inner = np.flatnonzero(f >= 0)
                    if len(inner) == 0:
                        break
                    here = at[inner]
                    goes_left = x[inner, f[inner]] <= cut[here]
                    at[inner] = np.where(goes_left, left[here], right[here])
                total += length[at]
            yield pd.Series(-np.exp2(-(total / len(trees)) / scale))

    return df.withColumn(column, score(*[F.coalesce(number(df, c), F.lit(0.0)) for c in columns]))


def isolation_outliers(
    df: DataFrame, key: str, columns: Sequence[str], contamination: float = 0.1, seed: int = 42
) -> DataFrame:
    """Count and percent of rows scored below the ``contamination`` quantile of all scores."""
    forest = fit_isolation_forest(df, key, columns, seed=seed)
    scored = materialize(isolation_scores(df, columns, forest).select("score"), "scores")
    cut = exact_quantiles(scored, ["score"], [contamination])["score"].values[contamination]
    return scored.agg(
        F.lit("isolation_forest").alias("method"),
        F.count_if(F.col("score") < cut).alias("outlier_count"),
        F.round(F.count_if(F.col("score") < cut) * 100.0 / F.count("*"), 2).alias("outlier_percent"),
    )
