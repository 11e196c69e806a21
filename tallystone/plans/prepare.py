"""Preparation: validate, drop, split, engineer, encode, scale, compare, save."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.functions.columns import numeric_columns, ref
from tallystone.operators import drift, encode, features, impute, outliers, scale, selectors
from tallystone.operators.split import stratified_split
from tallystone.session import materialize
from tallystone.sources.tables import append_run_metadata, load_params, save_params, save_split


@dataclass(frozen=True)
class PrepareSettings:
    key: str
    target: str
    positive: str
    negative: str
    drop: Mapping[str, str] = field(default_factory=dict)
    one_hot: Sequence[str] = ()
    max_categories: int | None = None
    scale: Sequence[str] = ()
    scale_method: str = "standard"
    feature_plan: features.FeaturePlan = field(default_factory=features.FeaturePlan)
    check_features: bool = True
    impute_numeric: str | None = None
    impute_categorical: str = "mode"
    outlier_method: str | None = None
    outlier_action: str = "clip"
    outlier_columns: Sequence[str] = ()
    test_size: float = 0.2
    seed: int = 42
    keep_key: bool = False
    expected_columns: Sequence[str] = ()
    expected_numeric: Sequence[str] = ()
    expected_categorical: Sequence[str] = ()
    ranges: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)


SETTINGS_VERSION = 1


def settings_from(stored: Mapping) -> PrepareSettings:
    """Settings from their plain form (nested dicts and lists)."""
    plan = stored["feature_plan"]
    formulas = lambda found: {k: v if isinstance(v, str) else features.FormulaSpec(**v) for k, v in found.items()}
    rebuilt = features.FeaturePlan(
        {c: features.LogSpec(**v) for c, v in plan["logs"].items()},
        formulas(plan["interactions"]),
        features.PolynomialSpec(**plan["polynomial"]) if plan["polynomial"] else None,
        formulas(plan["domain"]),
    )
    ranges = {c: tuple(v) for c, v in stored["ranges"].items()}
    return PrepareSettings(**{**stored, "feature_plan": rebuilt, "ranges": ranges})


@dataclass
class FittedPreparation:
    """Small parameter tables; :meth:`apply` is one projection, on batch or streaming input."""

    settings: PrepareSettings
    one_hot: DataFrame | None
    scaler: DataFrame | None
    imputer: DataFrame | None = None
    bounds: DataFrame | None = None
    shift: DataFrame | None = None

    def apply(self, df: DataFrame, with_target: bool = True) -> DataFrame:
        s = self.settings
        out = df
        if self.imputer is not None:
            out = impute.apply_imputer(out, self.imputer)
        if self.bounds is not None:
            out = outliers.apply_outliers(out, self.bounds, s.outlier_action)
        out = s.feature_plan.apply(out)
        if self.one_hot is not None:
            out = encode.apply_one_hot(out, self.one_hot)
        if with_target and s.target in out.columns:
            out = encode.label_encode(out, s.target, s.positive, s.negative)
        if self.scaler is not None:
            out = scale.apply_scaler(out, self.scaler)
        kept = [s.key] if s.keep_key else []
        return out.drop(*[ref(c) for c in s.drop if c not in kept])

    def save(self, path: str) -> None:
        """The fitted parameters, and the settings as one row with the version of their form."""
        row = [(SETTINGS_VERSION, json.dumps(asdict(self.settings)))]
        spark = SparkSession.active()
        spark.createDataFrame(row, "version int, settings string").write.mode("overwrite").json(f"{path}/settings")
        for name in ("one_hot", "scaler", "imputer", "bounds"):
            params = getattr(self, name)
            if params is not None:
                save_params(params, f"{path}/{name}")

    @classmethod
    def load(cls, spark, path: str, settings: PrepareSettings | None = None) -> FittedPreparation:
        """What :meth:`save` wrote; the folder is enough, other ``settings`` may be given in place of its own."""
        if settings is None:
            row = spark.read.schema("version int, settings string").json(f"{path}/settings").first()
            if row["version"] != SETTINGS_VERSION:
                raise ValueError(f"settings of version {row['version']}, this is {SETTINGS_VERSION}")
            settings = settings_from(json.loads(row["settings"]))

        def get(name: str) -> DataFrame | None:
            try:
                return load_params(spark, f"{path}/{name}")
            except FileNotFoundError:
                return None

        return cls(settings, get("one_hot"), get("scaler"), get("imputer"), get("bounds"))


def fit_preparation(train: DataFrame, s: PrepareSettings) -> FittedPreparation:
    """Learn every parameter from the training rows; each fit is one or two aggregates."""
    fitted = FittedPreparation(s, None, None)
    base = train
    if s.impute_numeric:
        fitted.imputer = impute.fit_imputer(base, s.impute_numeric, s.impute_categorical)
        base = impute.apply_imputer(base, fitted.imputer)
    if s.outlier_method:
        fitted.bounds = outliers.fit_outliers(base, s.outlier_columns, s.outlier_method)
        base = outliers.apply_outliers(base, fitted.bounds, s.outlier_action)
    s.feature_plan.fit(base)
    if s.check_features:
        features.validate_features(s.feature_plan.apply(base), s.feature_plan.names(base))
    if s.one_hot:
        fitted.one_hot = encode.fit_one_hot(base, s.one_hot, s.max_categories)
    if s.scale:
        fitted.scaler = scale.fit_scaler(s.feature_plan.apply(base), s.scale, s.scale_method)
    return fitted


def prepare(
    df: DataFrame, s: PrepareSettings, check_shift: bool = True
) -> tuple[DataFrame, FittedPreparation]:
    """Split, fit on train and apply to both parts; the result carries a ``split`` column.

    ``check_shift`` compares every prepared column of the two parts. The split table is written once: the fits and the final projection then read
    the same rows without recomputing what lies before.
    """
    selectors.validate(df, s.expected_columns, s.expected_numeric, s.expected_categorical, s.ranges)
    split = materialize(
        stratified_split(df, s.key, s.target, 1.0 - s.test_size, s.test_size, s.seed), "split"
    )
    fitted = fit_preparation(split.where("split = 'train'").drop("split"), s)
    ready = fitted.apply(split)
    order = [c for c in ready.columns if c not in (s.target, "split")]
    ready = ready.select(*[ref(c) for c in order], s.target, "split")
    if check_shift:
        ready = materialize(ready, "ready")  # both sides and the result read it
        compared = numeric_columns(ready, [s.target, s.key])
        fitted.shift = drift.distribution_shift(
            ready.where(F.col("split") == "train"), ready.where(F.col("split") == "test"), compared
        )
    return ready, fitted


def save_prepared(ready: DataFrame, fitted: FittedPreparation, path: str, run_id: str) -> None:
    """Both parts, the fitted parameters and the facts of the run."""
    spark = ready.sparkSession
    save_split(ready, f"{path}/data")
    fitted.save(f"{path}/params")
    counts = {r["split"]: r["count"] for r in ready.groupBy("split").count().collect()}
    facts = {f"{k}_rows": n for k, n in counts.items()} | {
        "columns": ",".join(c for c in ready.columns if c != "split"),
        "dropped": dict(fitted.settings.drop),
        "scaling": fitted.settings.scale_method,
        "seed": fitted.settings.seed,
    }
    for name in ("scaler", "one_hot", "shift"):
        params = getattr(fitted, name)
        if params is not None:
            facts[name] = [r.asDict() for r in params.collect()]
    append_run_metadata(spark, f"{path}/metadata", run_id, facts)


def loan_settings() -> PrepareSettings:
    """The preparation of the loan table. Columns, formulas, ranges and labels."""
    formula = features.FormulaSpec
    plan = features.FeaturePlan(
        logs={"Applicant_Income": features.LogSpec(), "Coapplicant_Income": features.LogSpec()},
        interactions={
            "Total_Income": "Applicant_Income + Coapplicant_Income",
            "Income_Ratio": "Applicant_Income / (Coapplicant_Income + 1)",
            "Loan_to_Income": "Loan_Amount / (Applicant_Income + Coapplicant_Income + 1)",
            "Income_per_Dependent": "(Applicant_Income + Coapplicant_Income) / (Dependents + 1)",
        },
        polynomial=features.PolynomialSpec(["Applicant_Income", "Coapplicant_Income", "Loan_Amount"]),
        domain={
            "EMI": "Loan_Amount / Loan_Amount_Term",
            "Loan_Income_Ratio": "Loan_Amount / (Applicant_Income + Coapplicant_Income + 1)",
            "EMI_to_Income": "(Loan_Amount / Loan_Amount_Term)"
            " / ((Applicant_Income / 12) + (Coapplicant_Income / 12) + 1)",
            "Has_Coapplicant": formula("Coapplicant_Income > 0", "int"),
            "Total_Experience": "Applicant_Income / 1000",
            "Loan_Term_Years": "Loan_Amount_Term / 12",
        },
    )
    return PrepareSettings(
        key="Customer_ID",
        target="Loan_Status",
        positive="Y",
        negative="N",
        drop={"Customer_ID": "an identifier, not predictive"},
        one_hot=["Married", "Education", "Gender", "Self_Employed", "Property_Area"],
        scale=["Dependents", "Applicant_Income", "Coapplicant_Income", "Loan_Amount", "Loan_Amount_Term"],
        feature_plan=plan,
        expected_columns=[
            "Customer_ID", "Gender", "Married", "Dependents", "Education", "Self_Employed",
            "Applicant_Income", "Coapplicant_Income", "Loan_Amount", "Loan_Amount_Term",
            "Property_Area", "Credit_History", "Loan_Status",
        ],
        expected_numeric=[
            "Customer_ID", "Dependents", "Applicant_Income", "Coapplicant_Income", "Loan_Amount",
            "Loan_Amount_Term", "Credit_History",
        ],
        expected_categorical=[
            "Gender", "Married", "Education", "Self_Employed", "Property_Area", "Loan_Status",
        ],
        ranges={
            "Dependents": (0, 10),
            "Applicant_Income": (0, 1_000_000),
            "Coapplicant_Income": (0, 1_000_000),
            "Loan_Amount": (0, 10_000),
            "Loan_Amount_Term": (0, 480),
            "Credit_History": (0, 1),
        },
    )
