"""Distribution shift between two tables: Kolmogorov–Smirnov, PSI and chi-square."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.functions import tails
from tallystone.functions.columns import categorical_columns, long_numbers, number, numeric_columns
from tallystone.operators.association import chi_square_tests
from tallystone.operators.quantiles import exact_quantiles
from tallystone.operators.ranks import running

SHIFT_SCHEMA = (
    "column string, statistic double, p_value double, shift_detected boolean, threshold double"
)


def _both(base: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    parts = [
        d.select(F.lit(side).alias("side"), *[number(d, c).alias(c) for c in columns])
        for side, d in ((1, base), (2, other))
    ]
    return parts[0].unionByName(parts[1])


def ks_statistics(base: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, n1, n2, d)``: the largest gap between the two empirical distributions."""
    cells = (
        long_numbers(_both(base, other, columns), columns, ["side"])
        .groupBy("column", "value")
        .agg(F.count_if(F.col("side") == 1).alias("a"), F.count_if(F.col("side") == 2).alias("b"))
    )
    cum = running(cells, ["column"], ["value"], ["a", "b"])
    # from the written counts, not from another scan of the tables
    totals = cum.groupBy("column").agg(F.sum("a").alias("n1"), F.sum("b").alias("n2"))
    gap = F.abs(F.col("a_upto") / F.col("n1") - F.col("b_upto") / F.col("n2"))
    return (
        cum.join(F.broadcast(totals), "column")  # one row per column
        .where("n1 > 0 AND n2 > 0")
        .groupBy("column", "n1", "n2")
        .agg(F.max(gap).alias("d"))
    )


def distribution_shift(
    base: DataFrame,
    other: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "ks_test",
    threshold: float = 0.05,
    exclude: Sequence[str] = (),
    tail: str = "asymptotic",
) -> DataFrame:
    """Compare each column of two tables; ``method`` is ``ks_test``, ``psi`` or ``chi_square``.

    Without ``columns``, the KS test and PSI take the numeric columns and
    chi-square the other ones. Columns absent from either table are skipped. The KS
    p-value takes its tail from ``tail``: ``asymptotic`` or ``exact`` (counted on the driver, for small samples).
    """
    if tail not in ("asymptotic", "exact"):
        raise ValueError(f"unknown tail: {tail}")
    pick = categorical_columns if method == "chi_square" else numeric_columns
    wanted = list(columns) if columns is not None else pick(base, exclude)
    shared = [c for c in wanted if c in base.columns and c in other.columns]
    if method == "psi":
        return psi(base, other, shared)
    if method == "chi_square":
        parts = [
            d.select(F.lit(side).alias("_side"), *[F.col(c).cast("string").alias(c) for c in shared])
            for side, d in (("1", base), ("2", other))
        ]
        tests = chi_square_tests(parts[0].unionByName(parts[1]), shared, "_side", threshold)
        return tests.select(
            "column",
            F.col("chi2").alias("statistic"),
            "p_value",
            F.col("significant").alias("shift_detected"),
            F.lit(threshold).alias("threshold"),
        )
    if method != "ks_test":
        raise ValueError(f"unknown shift method: {method}")
    rows = []
    for r in ks_statistics(base, other, shared).collect():
        n1, n2 = r["n1"], r["n2"]
        if tail == "exact":
            p = tails.ks_exact_sf(r["d"], n1, n2)
        else:
            p = tails.kolmogorov_sf(r["d"], n1 * n2 / (n1 + n2))
        rows.append((r["column"], round(r["d"], 4), round(p, 6), p < threshold, threshold))
    return base.sparkSession.createDataFrame(rows, SHIFT_SCHEMA)


def psi(
    base: DataFrame, other: DataFrame, columns: Sequence[str], bins: int = 10, floor: float = 1e-6
) -> DataFrame:
    """Population stability index over quantile bins of the first table.

    Empty bins count as ``floor`` so that the logarithm stays finite.
    """
    cuts = exact_quantiles(base, columns, [i / bins for i in range(1, bins)])
    rows = _both(base, other, columns)
    entries = []
    for c in columns:
        edges = sorted({e for e in cuts[c].values.values() if e is not None})
        v = F.col(f"`{c}`")
        # the bin is the number of edges below the value
        bin_no = sum(((v > e).cast("int") for e in edges), F.lit(0))
        entries.append(
            F.struct(F.lit(c).alias("column"), F.when(v.isNotNull(), bin_no).alias("bin"))
        )
    counts = (
        rows.select("side", F.inline(F.array(*entries)))
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count_if(F.col("side") == 1).alias("a"), F.count_if(F.col("side") == 2).alias("b"))
    )
    totals = counts.groupBy("column").agg(F.sum("a").alias("n1"), F.sum("b").alias("n2"))
    p = F.greatest(F.col("a") / F.col("n1"), F.lit(floor))
    q = F.greatest(F.col("b") / F.col("n2"), F.lit(floor))
    return (
        counts.join(F.broadcast(totals), "column")  # one row per column
        .where("n1 > 0 AND n2 > 0")
        .groupBy("column")
        .agg(F.sum((q - p) * F.ln(q / p)).alias("psi"))
    )
