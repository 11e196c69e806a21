"""Exact interpolated quantiles in two scans.

The first scan brackets every quantile with an approximate sketch of known rank
error. The second scan counts what lies below each bracket and keeps only the
distinct values inside it, so about ``4 / accuracy`` of the rows per quantile
take part in the ordering instead of the whole column.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.functions.columns import column_aggregates, double_literal, number, quoted, text_literal
from tallystone.operators.ranks import running

# below this many kept rows per column one window task is enough
SMALL_WINDOW = 1_000_000


@dataclass
class ColumnQuantiles:
    n: int
    values: dict[float, float | None]
    extras: dict[str, float | None] = field(default_factory=dict)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int = 10_000,
    extras: Mapping[str, str] | None = None,
    small_window: int = SMALL_WINDOW,
) -> dict[str, ColumnQuantiles]:
    """Linear-interpolated quantiles per column, nulls and NaN left out.

    ``extras`` are further aggregates, as SQL over ``{v}``, taken in the first scan,
    so that a profile needs no pass of its own.
    """
    extras = extras or {}
    columns = list(columns)
    if not columns:
        return {}
    eps = 1.0 / accuracy
    marks = sorted({m for q in probabilities for m in (max(0.0, q - 2 * eps), min(1.0, q + 2 * eps))})
    wide = df.select(*[number(df, c).alias(c) for c in columns])
    points = "array(" + ", ".join(double_literal(m) for m in marks) + ")"
    fields = {"n": "count({v})", "marks": f"percentile_approx({{v}}, {points}, {accuracy})", **extras}
    width = max(1, 50 // len(fields))  # many sketches in one aggregate make long plans: go in groups
    first: dict[str, dict] = {}
    for start in range(0, len(columns), width):
        part = column_aggregates(wide, columns[start : start + width], fields)
        first |= {r["column"]: r.asDict() for r in part.collect()}  # one row per column

    result = {
        c: ColumnQuantiles(
            first[c]["n"], {q: None for q in probabilities}, {name: first[c][name] for name in extras}
        )
        for c in columns
    }
    filled = [c for c in columns if result[c].n > 0]
    if not filled:
        return result

    def bracket(c: str, q: float) -> tuple[float, float]:
        found = dict(zip(marks, first[c]["marks"]))
        return found[max(0.0, q - 2 * eps)], found[min(1.0, q + 2 * eps)]

    brackets = {c: _merge([bracket(c, q) for q in probabilities]) for c in filled}
    positions = {
        c: sorted({k for q in probabilities for k in _neighbours(q, result[c].n)}) for c in filled
    }
    found = _values_at(wide, brackets, positions, result, accuracy, len(probabilities), small_window)
    lost = [c for c in filled if any(k not in found[c] for k in positions[c])]
    if lost:  # a sketch outside its promised error: order the whole column instead
        whole = {c: [(-math.inf, math.inf)] for c in lost}
        found |= _values_at(wide, whole, positions, result, 1, len(probabilities), small_window)
    for c in filled:
        n = result[c].n
        for q in probabilities:
            low, high = _neighbours(q, n)
            a, b = found[c][low], found[c][high]
            result[c].values[q] = a if a == b else a + (b - a) * (q * (n - 1) - low)
    return result


def _neighbours(q: float, n: int) -> tuple[int, int]:
    pos = q * (n - 1)
    return math.floor(pos), min(n - 1, math.ceil(pos))


def _merge(intervals: list[tuple[float, float]]) -> list[tuple[float, float]]:
    merged: list[tuple[float, float]] = []
    for low, high in sorted(intervals):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _values_at(wide, brackets, positions, result, accuracy, n_q, small_window):
    """Values at the wanted 0-based positions: ``{column: {position: value}}``."""
    entries = []
    for c, intervals in brackets.items():
        v = quoted(c)
        cases = ""  # even slots are the gaps between brackets, odd slots the brackets
        inside = []
        for i, (low, high) in enumerate(intervals):
            low_sql, high_sql = double_literal(low), double_literal(high)
            cases += f" WHEN {v} < {low_sql} THEN {2 * i} WHEN {v} <= {high_sql} THEN {2 * i + 1}"
            inside.append(f"{v} BETWEEN {low_sql} AND {high_sql}")
        entries.append(
            f"named_struct('column', {text_literal(c)},"
            f" 'slot', CASE WHEN {v} IS NULL THEN NULL{cases} ELSE {2 * len(intervals)} END,"
            f" 'value', CASE WHEN {' OR '.join(inside)} THEN {v} END)"
        )
    cells = (
        wide.selectExpr(f"inline(array({', '.join(entries)}))")
        .where(F.col("slot").isNotNull())
        .groupBy("column", "slot", "value")
        .agg(F.count("*").alias("n"))
    )
    kept = max(result[c].n for c in brackets) * min(1.0, 8.0 * n_q / accuracy)
    cum = running(cells, ["column"], ["slot", "value"], ["n"], bounded=kept <= small_window)
    wanted = F.expr(
        "CASE "
        + " ".join(
            f"WHEN `column` = {text_literal(c)} THEN array({', '.join(f'{k}L' for k in positions[c])})" for c in brackets
        )
        + " END"
    )
    before = F.col("n_upto") - F.col("n")
    hits = (
        cum.where(F.col("slot") % 2 == 1)
        .select(
            "column",
            "value",
            F.explode(F.filter(wanted, lambda k: (k >= before) & (k < F.col("n_upto")))).alias("k"),
        )
        .collect()  # columns x quantiles x 2 rows
    )
    found: dict[str, dict[int, float]] = {c: {} for c in brackets}
    for row in hits:
        found[row["column"]][row["k"]] = row["value"]
    return found
