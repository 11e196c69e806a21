"""Confidence intervals and tests that compare a numeric column between groups.

All listed columns share each pass: moments come from one grouped aggregate,
ranks from one ordering of the distinct values. Only result-sized rows reach
the driver, where the tail probability is filled in.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystone.functions import tails
from tallystone.functions.columns import column_aggregates, long_numbers, number, quoted, ref
from tallystone.functions.normality import shapiro_wilk
from tallystone.operators.ranks import average_ranks, tie_term, value_cells
from tallystone.session import materialize

EXACT_CELLS = 1_000_000
LIMIT_CELLS = 20_000  # hash bounds that are broadcast
GATE_ROWS = 5000  # fixed value: the normality check looks at no more rows than this per group
TWO_GROUP_SCHEMA = (
    "column string, test_type string, group1_mean double, group2_mean double, group1_std double, "
    "group2_std double, group1_n bigint, group2_n bigint, statistic double, p_value double, "
    "significant boolean, cohens_d double, effect string"
)
MOMENTS = {"n": "count({v})", "mean": "avg({v})", "std": "stddev_samp({v})"}
MULTI_GROUP_SCHEMA = (
    "column string, test_type string, n_groups bigint, statistic double, p_value double, "
    "significant boolean"
)


def confidence_intervals(df: DataFrame, columns: Sequence[str], confidence: float = 0.95) -> DataFrame:
    """Mean with its t interval per column; columns with fewer than two values are left out."""
    rows = []
    for c, n, m, s in column_aggregates(df, columns, MOMENTS).collect():  # one row per column
        if n < 2:
            continue
        se = s / math.sqrt(n)
        margin = tails.t_quantile((1 + confidence) / 2, n - 1) * se
        cells = [round(x, 4) for x in (m, m - margin, m + margin, margin)]
        rows.append((c, *cells, n, confidence))
    return df.sparkSession.createDataFrame(
        rows,
        "column string, mean double, lower_bound double, upper_bound double, "
        "margin_of_error double, sample_size bigint, confidence_level double",
    )


def group_moments(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """``(group, column, n, mean, std)`` from one grouped aggregate; missing groups are dropped."""
    rows = df.where(ref(group).isNotNull())
    return column_aggregates(rows, columns, MOMENTS, by={"group": f"CAST({quoted(group)} AS STRING)"})


def rank_sums(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """``(column, group, n, rank_sum, tie_sum)``; add the tie sums of a column's groups up."""
    return (
        average_ranks(value_cells(df, columns, group))
        .groupBy("column", "group")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("rank") * F.col("n")).alias("rank_sum"),
            tie_term().alias("tie_sum"),
        )
    )


def gate_limits(sizes: DataFrame, slack: float) -> DataFrame:
    """Hash bounds from ``(column, group, n, k)``: keep a little more than ``k`` of ``n`` rows."""
    share = (F.col("k") + slack * F.sqrt("k") + 16.0) / F.col("n")
    top = (share * F.lit(2.0**60)).cast("long")
    return sizes.select(
        "column", "group", "k", F.when(share >= 1.0, F.lit(2**63 - 1)).otherwise(top).alias("top")
    )


def sample_per_group(
    df: DataFrame, columns: Sequence[str], group: str, key: str, sizes: DataFrame, seed: int = 42
) -> DataFrame:
    """A reproducible sample of exactly ``k`` rows per (column, group): those with the lowest key hash.

    ``sizes`` holds ``(column, group, n, k)``. The known row count turns into a
    hash bound, so only slightly more than ``k`` rows per group are ever sorted.
    """
    base = df.where(ref(group).isNotNull()).select(
        ref(group).cast("string").alias("group"),
        F.conv(F.substring(F.md5(F.concat(F.coalesce(ref(key).cast("string"), F.lit("")), F.lit(f"-{seed}")).cast("binary")), 1, 15), 16, 10).cast("long").alias("hash"),
        *[number(df, c).alias(c) for c in columns],
    )
    long = long_numbers(base, columns, ["group", "hash"])
    slack = 8.0
    while True:
        near = _below_limits(long, gate_limits(sizes, slack))
        w = Window.partitionBy("column", "group").orderBy("hash")
        sample = materialize(
            near.withColumn("at", F.row_number().over(w)).where("at <= k"), "sample"
        ).select("column", "group", "value")
        got = sample.groupBy("column", "group").agg(F.count("*").alias("got"))
        short = sizes.join(got, ["column", "group"], "left").where(F.coalesce("got", F.lit(0)) < F.col("k"))
        if short.isEmpty():
            return sample
        slack *= 8.0  # the hash was less even than expected: widen the bound, never settle for less


def _below_limits(long: DataFrame, limits: DataFrame) -> DataFrame:
    """Rows at or below the hash bound of their (column, group), cut before any shuffle.

    Up to ``LIMIT_CELLS`` bounds are sent to every task; with more, rows are first cut by the loosest
    bound of their column and then joined.
    """
    found = limits.limit(LIMIT_CELLS + 1).collect()
    if len(found) <= LIMIT_CELLS:
        small = long.sparkSession.createDataFrame(found, limits.schema)
        return long.join(F.broadcast(small), ["column", "group"]).where("hash <= top")
    loosest = F.broadcast(limits.groupBy("column").agg(F.max("top").alias("_most")))  # one row per column
    some = long.join(loosest, "column").where("hash <= _most").drop("_most")
    return some.join(limits, ["column", "group"]).where("hash <= top")


def normality(
    df: DataFrame, columns: Sequence[str], group: str, key: str, sizes: DataFrame, seed: int = 42
) -> DataFrame:
    """Shapiro–Wilk per (column, group) on the sampled rows, at most ``GATE_ROWS`` each."""

    def check(pdf: pd.DataFrame) -> pd.DataFrame:
        w, p = shapiro_wilk(pdf["value"].to_numpy())
        first = pdf.iloc[0]
        return pd.DataFrame(
            [(first["column"], first["group"], len(pdf), w, p)],
            columns=["column", "group", "n", "w", "p_value"],
        )

    sample = sample_per_group(df, columns, group, key, sizes, seed)
    return sample.groupBy("column", "group").applyInPandas(
        check, "column string, group string, n bigint, w double, p_value double"
    )


def normality_check(
    df: DataFrame, columns: Sequence[str], group: str, key: str, seed: int = 42
) -> DataFrame:
    """Shapiro–Wilk of every column within every group of at least three values."""
    moments = materialize(group_moments(df, columns, group), "moments")
    return normality(df, columns, group, key, _gate_sizes(moments), seed)


def _gate_sizes(moments: DataFrame) -> DataFrame:
    k = F.least("n", F.lit(GATE_ROWS)).cast("long")
    return moments.where("n >= 3").select("column", "group", "n", k.alias("k"))


def effect_label(value: float, limits: tuple[float, float, float]) -> str:
    names = ("negligible", "small", "medium", "large")
    return names[sum(value >= limit for limit in limits)]


D_LIMITS = (0.2, 0.5, 0.8)
V_LIMITS = (0.1, 0.3, 0.5)


def effect_case(value: Column, limits: tuple[float, float, float]) -> Column:
    return (
        F.when(value < limits[0], "negligible")
        .when(value < limits[1], "small")
        .when(value < limits[2], "medium")
        .otherwise("large")
    )


def cohens_d(m1: float, s1: float, m2: float, s2: float) -> float:
    pooled = math.sqrt((s1 * s1 + s2 * s2) / 2.0)
    return abs(m1 - m2) / pooled if pooled > 0 else 0.0


def welch(n1: int, m1: float, s1: float, n2: int, m2: float, s2: float) -> tuple[float, float]:
    v1, v2 = s1 * s1 / n1, s2 * s2 / n2
    if v1 + v2 == 0:
        return (0.0, 1.0) if m1 == m2 else (math.copysign(math.inf, m1 - m2), 0.0)
    t = (m1 - m2) / math.sqrt(v1 + v2)
    freedom = (v1 + v2) ** 2 / (v1 * v1 / (n1 - 1) + v2 * v2 / (n2 - 1))
    return t, tails.t_two_sided(t, freedom)


def mann_whitney(
    n1: int, n2: int, rank_sum1: float, tie_sum: float, tail: str = "asymptotic"
) -> tuple[float, float]:
    """U of the first group; ``tail`` is ``asymptotic`` or ``exact`` (without ties only).

    The exact tail counts arrangements in a table of ``n1 * n2`` cells; beyond ``EXACT_CELLS`` it is refused.
    """
    u = rank_sum1 - n1 * (n1 + 1) / 2.0
    if tail == "exact":
        if tie_sum:
            raise ValueError("the exact tail needs values without ties")
        if n1 * n2 > EXACT_CELLS:
            raise ValueError(f"the exact tail of {n1} and {n2} rows is too large")
        return u, tails.rank_sum_exact_two_sided(u, n1, n2)
    if tail != "asymptotic":
        raise ValueError(f"unknown tail: {tail}")
    n = n1 + n2
    variance = n1 * n2 / 12.0 * ((n + 1) - tie_sum / (n * (n - 1)))
    if variance <= 0:
        return u, 1.0
    larger = max(u, n1 * n2 - u)
    z = (larger - n1 * n2 / 2.0 - 0.5) / math.sqrt(variance)
    return u, min(1.0, 2.0 * tails.normal_sf(z))


def _by_column(rows: DataFrame) -> dict[str, dict[str, dict]]:
    out: dict[str, dict[str, dict]] = defaultdict(dict)
    for r in rows.collect():  # columns x groups rows
        out[r["column"]][r["group"]] = r.asDict()
    return out


def two_group_compare(
    df: DataFrame,
    columns: Sequence[str],
    group: str,
    first: str,
    second: str,
    key: str | None = None,
    test: str = "auto",
    alpha: float = 0.05,
    min_size: int = 3,
    seed: int = 42,
    tail: str = "asymptotic",
) -> DataFrame:
    """Welch's t or Mann–Whitney U with Cohen's d, one row per column.

    ``test`` is ``welch``, ``rank`` or ``auto``; the last checks normality in both
    groups on a sample chosen by ``key`` and ranks only the columns that need it.
    A column with fewer than ``min_size`` values in a group is left out. ``tail`` is
    that of :func:`mann_whitney`.
    """
    if test not in ("auto", "welch", "rank"):
        raise ValueError(f"unknown test: {test}")
    if test == "auto" and key is None:
        raise ValueError("test='auto' needs the key column that orders the sample")
    rows = df.where(ref(group).cast("string").isin(first, second))
    moments = _by_column(group_moments(rows, columns, group))
    usable = [
        c
        for c in columns
        if all(moments.get(c, {}).get(g, {"n": 0})["n"] >= min_size for g in (first, second))
    ]
    ranked = usable if test == "rank" else []
    if test == "auto":
        sizes = []
        for c in usable:
            both = [moments[c][g]["n"] for g in (first, second)]
            sizes += [(c, g, n, min(GATE_ROWS, *both)) for g, n in zip((first, second), both)]
        limits = df.sparkSession.createDataFrame(sizes, "column string, group string, n long, k long")
        checks = normality(rows, usable, group, key, limits, seed).collect() if usable else []
        failed = {r["column"] for r in checks if r["p_value"] < alpha}
        ranked = [c for c in usable if c in failed]
    sums = _by_column(rank_sums(rows, ranked, group)) if ranked else {}
    result = []
    for c in usable:
        a, b = moments[c][first], moments[c][second]
        if c in sums:
            ties = sum(g["tie_sum"] for g in sums[c].values())
            stat, p = mann_whitney(a["n"], b["n"], sums[c][first]["rank_sum"], ties, tail)
            name = "Mann-Whitney U"
        else:
            stat, p = welch(a["n"], a["mean"], a["std"], b["n"], b["mean"], b["std"])
            name = "Welch's t-test"
        d = cohens_d(a["mean"], a["std"], b["mean"], b["std"])
        result.append((
            c, name, round(a["mean"], 4), round(b["mean"], 4), round(a["std"], 4), round(b["std"], 4),
            a["n"], b["n"], round(stat, 4), round(p, 6), p < alpha, round(d, 4), effect_label(d, D_LIMITS),
        ))
    return df.sparkSession.createDataFrame(result, TWO_GROUP_SCHEMA)


def anova_parts(moments: DataFrame) -> DataFrame:
    """Sums of squares per column from ``(column, group, n, mean, std)``, two-pass for accuracy."""
    grand = moments.groupBy("column").agg(
        F.sum("n").alias("total"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand")
    )
    shift = F.col("mean") - F.col("grand")
    return (
        moments.join(F.broadcast(grand), "column")  # one row per column
        .groupBy("column")
        .agg(
            F.count("*").alias("groups"),
            F.first("total").alias("total"),
            F.sum(F.col("n") * shift * shift).alias("between"),
            F.sum((F.col("n") - 1) * F.col("std") * F.col("std")).alias("within"),
        )
    )


def anova(groups: int, total: int, between: float, within: float) -> tuple[float, float]:
    d1, d2 = groups - 1, total - groups
    if within == 0:
        return (math.inf, 0.0) if between > 0 else (math.nan, math.nan)
    f = (between / d1) / (within / d2)
    return f, tails.f_sf(f, d1, d2)


def tukey_hsd(df: DataFrame, columns: Sequence[str], group: str, alpha: float = 0.05) -> DataFrame:
    """Tukey's honestly significant difference (Tukey-Kramer for unequal groups) of all pairs of groups, per column.

    Only group moments are paired, never rows. Groups with fewer than two values are left out; a column with fewer than two
    groups has no row, one without any spread inside its groups has no p-value.

    Returns ``(column, group1, group2, mean_difference, statistic, p_value, significant)``.
    """
    moments = materialize(group_moments(df, columns, group).where("n >= 2"), "moments")
    pooled = anova_parts(moments).where("groups >= 2").select(
        "column", "groups", (F.col("total") - F.col("groups")).alias("freedom"), (F.col("within") / (F.col("total") - F.col("groups"))).alias("mse")
    )
    side = lambda i: moments.select("column", F.col("group").alias(f"group{i}"), F.col("n").alias(f"n{i}"), F.col("mean").alias(f"mean{i}"))
    pairs = side(1).join(side(2), "column").where("group1 < group2").join(F.broadcast(pooled), "column")  # one row per column
    gap = F.col("mean1") - F.col("mean2")
    error = F.sqrt(F.col("mse") / 2 * (1 / F.col("n1") + 1 / F.col("n2")))
    tested = pairs.withColumns({"gap": gap, "q": F.when(F.col("mse") > 0, F.abs(gap) / error)})

    def tail(batches):
        for pdf in batches:
            p = pd.Series(math.nan, index=pdf.index)
            for (k, freedom), rows in pdf[pdf["q"].notna()].groupby(["groups", "freedom"]):
                p.loc[rows.index] = tails.studentized_range_sf(rows["q"].to_numpy(), int(k), float(freedom))
            yield pdf.assign(p=p)

    schema = "column string, group1 string, group2 string, gap double, q double, groups long, freedom long"
    names = [f.split()[0] for f in schema.split(", ")]
    found = tested.select(*names).mapInPandas(tail, f"{schema}, p double")
    p = F.nanvl("p", F.lit(None).cast("double"))
    return found.select(
        "column", "group1", "group2", F.round("gap", 4).alias("mean_difference"), F.round("q", 4).alias("statistic"),
        F.round(p, 6).alias("p_value"), (p < alpha).alias("significant"),
    )


def kruskal_parts(sums: DataFrame) -> DataFrame:
    square = F.col("rank_sum") * F.col("rank_sum") / F.col("n")
    return sums.groupBy("column").agg(
        F.count("*").alias("groups"),
        F.sum("n").alias("total"),
        F.sum(square).alias("squares"),
        F.sum("tie_sum").alias("ties"),
    )


def kruskal(groups: int, total: int, squares: float, ties: float) -> tuple[float, float]:
    n = float(total)
    correction = 1.0 - ties / (n**3 - n)
    if correction == 0:
        return math.nan, math.nan
    h = (12.0 / (n * (n + 1)) * squares - 3.0 * (n + 1)) / correction
    return h, tails.chi2_sf(h, groups - 1)


def multi_group_compare(
    df: DataFrame,
    columns: Sequence[str],
    group: str,
    key: str | None = None,
    test: str = "auto",
    alpha: float = 0.05,
    min_size: int = 3,
    seed: int = 42,
) -> DataFrame:
    """One-way ANOVA or Kruskal–Wallis per column over all groups of ``group``.

    ``test`` is ``anova``, ``rank`` or ``auto``. A column is left out with fewer
    than two groups or a group below ``min_size``. The number of groups is free:
    per-group rows stay in Spark, one row per column reaches the driver. The
    group means are :func:`tallystone.operators.profile.group_means`.
    """
    if test not in ("auto", "anova", "rank"):
        raise ValueError(f"unknown test: {test}")
    if test == "auto" and key is None:
        raise ValueError("test='auto' needs the key column that orders the sample")
    moments = materialize(group_moments(df, columns, group), "moments")
    fit = moments.groupBy("column").agg(F.count("*").alias("g"), F.min("n").alias("least"))
    usable_rows = fit.where((F.col("g") >= 2) & (F.col("least") >= min_size)).collect()
    usable = [c for c in columns if c in {r["column"] for r in usable_rows}]
    ranked = usable if test == "rank" else []
    if test == "auto" and usable:
        sizes = _gate_sizes(moments.where(F.col("column").isin(usable)))
        checks = normality(df, usable, group, key, sizes, seed)
        worst = checks.groupBy("column").agg(F.min("p_value").alias("p")).where(F.col("p") < alpha)
        failed = {r["column"] for r in worst.collect()}
        ranked = [c for c in usable if c in failed]
    parts = {r["column"]: r.asDict() for r in anova_parts(moments).collect()}
    if ranked:
        for r in kruskal_parts(rank_sums(df, ranked, group)).collect():
            parts[r["column"]] = r.asDict()
    result = []
    for c in usable:
        args = {k: v for k, v in parts[c].items() if k != "column"}
        stat, p = kruskal(**args) if c in ranked else anova(**args)
        name = "Kruskal-Wallis H-test" if c in ranked else "One-way ANOVA"
        result.append((c, name, args["groups"], round(stat, 4), round(p, 6), p < alpha))
    return df.sparkSession.createDataFrame(result, MULTI_GROUP_SCHEMA)


def paired_t(df: DataFrame, first: str, second: str) -> DataFrame:
    """Paired t-test from the moments of the difference; rows missing either side are left out."""
    d = number(df, first) - number(df, second)
    r = df.agg(F.count(d).alias("n"), F.avg(d).alias("m"), F.stddev_samp(d).alias("s")).first()
    rows = []
    if r["n"] >= 2 and r["s"]:
        t = r["m"] / (r["s"] / math.sqrt(r["n"]))
        rows.append((r["n"], round(r["m"], 4), round(t, 4), round(tails.t_two_sided(t, r["n"] - 1), 6)))
    return df.sparkSession.createDataFrame(rows, "n bigint, mean_difference double, statistic double, p_value double")


def two_proportions(df: DataFrame, group: str, first: str, second: str, success) -> DataFrame:
    """Pooled two-proportion z-test of ``success`` (a boolean column) between two groups.

    With an empty group there is no test: its share, z and p are NULL.
    """
    g = ref(group).cast("string")
    counts = df.agg(
        *[F.count_if((g == v) & success.isNotNull()).alias(f"n{i}") for i, v in enumerate((first, second))],
        *[F.count_if((g == v) & success).alias(f"x{i}") for i, v in enumerate((first, second))],
    ).first()
    n1, n2, x1, x2 = counts["n0"], counts["n1"], counts["x0"], counts["x1"]
    schema = "n1 bigint, n2 bigint, share1 double, share2 double, z double, p_value double"
    if not n1 or not n2:
        shares = [round(x / n, 6) if n else None for x, n in ((x1, n1), (x2, n2))]
        return df.sparkSession.createDataFrame([(n1, n2, *shares, None, None)], schema)
    p1, p2, pooled = x1 / n1, x2 / n2, (x1 + x2) / (n1 + n2)
    se = math.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n2))
    z = (p1 - p2) / se if se > 0 else 0.0
    row = (n1, n2, round(p1, 6), round(p2, 6), round(z, 4), round(2 * tails.normal_sf(abs(z)), 6))
    return df.sparkSession.createDataFrame([row], schema)


def adjust_p_values(results: DataFrame, method: str = "bonferroni", p: str = "p_value", alpha: float = 0.05) -> DataFrame:
    """Multiple-testing correction over result rows: ``bonferroni``, ``fdr`` or ``none``."""
    everything = Window.partitionBy(F.lit(0))  # result rows: one per test
    m = F.count("*").over(everything)
    if method == "bonferroni":
        adjusted = F.least(F.lit(1.0), ref(p) * m)
        out = results.withColumn("p_adjusted", adjusted)
    elif method == "fdr":
        order = everything.orderBy(ref(p))
        raw = results.withColumn("_r", ref(p) * m / F.row_number().over(order))
        back = everything.orderBy(ref(p)).rowsBetween(0, Window.unboundedFollowing)
        out = raw.withColumn("p_adjusted", F.least(F.lit(1.0), F.min("_r").over(back))).drop("_r")
    elif method == "none":
        out = results.withColumn("p_adjusted", ref(p))
    else:
        raise ValueError(f"unknown correction: {method}")
    return out.withColumn("significant_adjusted", F.col("p_adjusted") < alpha)
