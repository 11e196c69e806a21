"""Feature engineering: log, formula and polynomial columns, and their check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import combinations, combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.functions.columns import column_aggregates, finite_or_zero, is_numeric, number, ref
from tallystone.functions.formula import formula_column
from tallystone.operators.profile import SKEWNESS, log_profile
from tallystone.operators.selectors import CheckFailed

LOG_EPSILON = 1e-8  # fixed value: added before log and log10, not before log1p

# each method with the lowest input it is defined for (exclusive)
LOG_METHODS = {
    "log1p": (lambda c: F.log1p(c), -1.0),
    "log": (lambda c: F.log(c + LOG_EPSILON), -LOG_EPSILON),
    "log10": (lambda c: F.log10(c + LOG_EPSILON), -LOG_EPSILON),
}


@dataclass(frozen=True)
class LogSpec:
    method: str = "log1p"
    suffix: str = "_log"
    keep_original: bool = True


@dataclass(frozen=True)
class FormulaSpec:
    formula: str
    dtype: str | None = None  # "int" or "float" casts the result


@dataclass(frozen=True)
class PolynomialSpec:
    columns: Sequence[str]
    degree: int = 2
    interaction_only: bool = False
    include_bias: bool = False
    keep_original: bool = True


def fit_log(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Profile of the columns to transform; a negative value is an error."""
    profile = log_profile(df, columns)
    bad = [r["column"] for r in profile.where("has_negatives").collect()]
    if bad:
        raise CheckFailed(f"negative values cannot be log-transformed: {bad}")
    return profile


def log_features(df: DataFrame, specs: Mapping[str, LogSpec], check: bool = False) -> DataFrame:
    """Add ``{column}{suffix}``. ``check`` counts inputs outside the domain first and raises."""
    new: dict[str, Column] = {}
    dropped = []
    invalid = []
    for c, spec in specs.items():
        if spec.method not in LOG_METHODS:
            raise ValueError(f"unknown log method: {spec.method}")
        if c not in df.columns:
            continue
        function, least = LOG_METHODS[spec.method]
        v = number(df, c)
        new[c + spec.suffix] = function(v)
        # Spark gives NULL where the logarithm is undefined, so the input is what is checked
        invalid.append(F.count_if(v.isNull() | (v <= least) | (v == float("inf"))).alias(c))
        if not spec.keep_original:
            dropped.append(c)
    if check and invalid:
        bad = {c: n for c, n in df.agg(*invalid).first().asDict().items() if n}
        if bad:
            raise CheckFailed(f"log transform gives missing or infinite values: {bad}")
    return df.withColumns(new).drop(*[ref(c) for c in dropped])


def formula_features(df: DataFrame, specs: Mapping[str, FormulaSpec | str]) -> DataFrame:
    """Add formula columns in order; later formulas may use earlier names.

    The value of a formula that is not finite, or has a missing input, is 0.
    """
    known = {c: number(df, c) for c in df.columns if is_numeric(df.schema[c].dataType)}
    new: dict[str, Column] = {}
    for name, spec in specs.items():
        spec = FormulaSpec(spec) if isinstance(spec, str) else spec
        value = finite_or_zero(formula_column(spec.formula, known))
        known[name] = value
        kinds = {None: value, "int": value.cast("int"), "float": value}
        if spec.dtype not in kinds:
            raise ValueError(f"unknown feature type: {spec.dtype}")
        new[name] = kinds[spec.dtype]
    return df.withColumns(new)


def polynomial_terms(spec: PolynomialSpec) -> dict[str, list[str]]:
    """Term name → factors, by degree and then by position: ``a``, ``b``, ``a^2``, ``a b``, ``b^2``."""
    pick = combinations if spec.interaction_only else combinations_with_replacement
    terms: dict[str, list[str]] = {"1": []} if spec.include_bias else {}
    for degree in range(1, spec.degree + 1):
        for factors in pick(spec.columns, degree):
            parts = []
            for c in dict.fromkeys(factors):
                power = factors.count(c)
                parts.append(c if power == 1 else f"{c}^{power}")
            terms[" ".join(parts)] = list(factors)
    return terms


def polynomial_features(df: DataFrame, spec: PolynomialSpec) -> DataFrame:
    """Add product columns at the end of the row.

    Without ``keep_original`` the source columns move there too, as the terms of degree one.
    """
    new = {}
    for name, factors in polynomial_terms(spec).items():
        if len(factors) == 1 and spec.keep_original:
            continue
        product = number(df, factors[0]) if factors else F.lit(1.0)
        for c in factors[1:]:
            product = product * number(df, c)
        new[name] = product
    if spec.keep_original:
        return df.withColumns(new)
    rest = [ref(c) for c in df.columns if c not in spec.columns]
    return df.select(*rest, *[c.alias(name) for name, c in new.items()])


def feature_report(df: DataFrame, features: Sequence[str], skew_limit: float = 1.0) -> DataFrame:
    """Checks of engineered columns in one aggregate, one row per column.

    Infinite, missing, negative-after-log and constant columns are fatal; high
    skewness is a warning.
    """
    features = [c for c in features if c in df.columns]
    fields = {
        "n_inf": "count_if(abs({v}) = double('inf'))",
        "n_missing": "count_if({v} IS NULL)",
        "n_negative_log": lambda c: "count_if({v} < 0)" if "_log" in c else "count_if(false)",
        "skewness": SKEWNESS,
        "is_constant": "coalesce(min({v}) = max({v}), false)",
        "mean": "avg({v})",
        "std": "stddev_samp({v})",
        "min": "min({v})",
        "max": "max({v})",
    }
    fatal = (
        (F.col("n_inf") > 0) | (F.col("n_missing") > 0) | (F.col("n_negative_log") > 0) | F.col("is_constant")
    )
    skewed = F.coalesce(F.abs("skewness") > skew_limit, F.lit(False))
    report = column_aggregates(df, features, fields)
    return report.withColumn(
        "severity", F.when(fatal, "FATAL").when(skewed, "WARNING").otherwise("OK")
    )


def validate_features(df: DataFrame, features: Sequence[str], skew_limit: float = 1.0) -> DataFrame:
    """Raise on a fatal finding, else return the table unchanged."""
    bad = feature_report(df, features, skew_limit).where("severity = 'FATAL'").collect()
    if bad:
        raise CheckFailed(f"engineered columns failed: {[r['column'] for r in bad]}")
    return df


@dataclass(frozen=True)
class FeaturePlan:
    """All engineered columns, added in a fixed order: log, interaction, polynomial, domain."""

    logs: Mapping[str, LogSpec] = field(default_factory=dict)
    interactions: Mapping[str, FormulaSpec | str] = field(default_factory=dict)
    polynomial: PolynomialSpec | None = None
    domain: Mapping[str, FormulaSpec | str] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> FeaturePlan:
        """Check that the columns to log-transform allow it."""
        columns = [c for c in self.logs if c in df.columns]
        if columns:
            fit_log(df, columns)
        return self

    def apply(self, df: DataFrame) -> DataFrame:
        out = formula_features(log_features(df, self.logs), self.interactions)
        if self.polynomial is not None:
            out = polynomial_features(out, self.polynomial)
        return formula_features(out, self.domain)

    def names(self, df: DataFrame) -> list[str]:
        """The engineered columns, in order."""
        return [c for c in self.apply(df).columns if c not in df.columns]
