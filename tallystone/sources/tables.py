"""Reading and writing tables, fitted parameters, results and models."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.functions.columns import ref, require_columns
from tallystone.operators.encode import require_same_features

LOAN_SCHEMA = T.StructType([
    T.StructField("Customer_ID", T.LongType()),
    T.StructField("Gender", T.StringType()),
    T.StructField("Married", T.StringType()),
    T.StructField("Dependents", T.IntegerType()),
    T.StructField("Education", T.StringType()),
    T.StructField("Self_Employed", T.StringType()),
    T.StructField("Applicant_Income", T.DoubleType()),
    T.StructField("Coapplicant_Income", T.DoubleType()),
    T.StructField("Loan_Amount", T.DoubleType()),
    T.StructField("Loan_Amount_Term", T.IntegerType()),
    T.StructField("Property_Area", T.StringType()),
    T.StructField("Credit_History", T.IntegerType()),
    T.StructField("Loan_Status", T.StringType()),
])


class EmptyTable(ValueError):
    """The source exists but holds no rows."""


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    categorical: Sequence[str] = (),
    require_rows: bool = True,
    **options: str,
) -> DataFrame:
    """Read csv (with header), parquet, json or orc.

    A missing path raises ``FileNotFoundError``, a table without rows
    ``EmptyTable``. Give a schema for csv where it is known: inference costs a
    scan. ``categorical`` columns are read as text whatever they look like.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        options = {"header": "true", **({} if schema is not None else {"inferSchema": "true"}), **options}
    try:
        df = reader.options(**options).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise
    require_columns(df, categorical)
    df = df.withColumns({c: ref(c).cast("string") for c in categorical})
    if require_rows and df.isEmpty():
        raise EmptyTable(f"no rows in {path}")
    return df


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    writer = df.write.mode(mode).format(fmt).partitionBy(*partition_by)
    (writer.option("header", "true") if fmt == "csv" else writer).save(path)


def save_split(df: DataFrame, path: str, split: str = "split", fmt: str = "parquet") -> None:
    """Train and test as one dataset partitioned by the split column."""
    write_table(df, path, fmt, [split])


def load_split(spark: SparkSession, path: str, target: str, split: str = "split", fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """The train and test tables of :func:`save_split`; only their own partition is read."""
    both = read_table(spark, path, fmt)
    require_columns(both, [target, split])
    train = both.where(F.col(split) == "train").drop(split)
    test = both.where(F.col(split) == "test").drop(split)
    return train, test


def load_training(train: DataFrame, test: DataFrame, target: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Check two prepared tables against each other; also return the feature names in order."""
    for df in (train, test):
        require_columns(df, [target])
    require_same_features(train.drop(target), test.drop(target))
    return train, test, [c for c in train.columns if c != target]


def training_metadata(train: DataFrame, test: DataFrame, target: str) -> DataFrame:
    """``(split, class, n, n_features)`` of both tables."""
    sides = None
    for name, df in (("train", train), ("test", test)):
        part = df.groupBy(ref(target).alias("class")).agg(F.count("*").alias("n")).select(
            F.lit(name).alias("split"),
            "class",
            "n",
            F.lit(len(df.columns) - 1).cast("bigint").alias("n_features"),
        )
        sides = part if sides is None else sides.unionByName(part)
    return sides


def save_params(params: DataFrame, path: str) -> None:
    """Fitted parameters of an encoder, scaler, imputer or outlier step: one small file."""
    params.coalesce(1).write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, "parquet", require_rows=False)


def append_run_metadata(spark: SparkSession, path: str, run_id: str, facts: Mapping[str, object]) -> None:
    """``(run_id, fact, value)`` rows beside those of other runs; values are kept as text. A repeated run id replaces its rows."""
    rows = [(k, str(v)) for k, v in facts.items()]
    table = spark.createDataFrame(rows, "fact string, value string")
    table.coalesce(1).write.mode("overwrite").json(f"{path}/run_id={run_id}")


def load_run_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("fact string, value string, run_id string").json(path)


def save_results(results: Mapping[str, DataFrame], path: str, run_id: str, fmt: str = "parquet") -> None:
    """Every result table under its own name, one partition per run."""
    if fmt not in ("parquet", "json"):
        raise ValueError(f"unknown result format: {fmt}")
    for name, df in results.items():
        df.write.mode("overwrite").format(fmt).save(f"{path}/{name}/run_id={run_id}")


def load_results(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(f"{path}/{name}")


class RunPublished(ValueError):
    """A run of this id is already published."""


def publish_run(results: Mapping[str, DataFrame], path: str, run_id: str, replace: bool = False, fmt: str = "parquet") -> None:
    """Write all result tables of a run so that readers see either all of them or none.

    The tables are staged under the name of this attempt; one row that names the attempt is written last, and
    :func:`read_published` follows only such rows. A run that breaks off, or is tried again after it, leaves nothing behind that a
    reader could count twice. A published run id is refused, or with ``replace`` its new attempt takes over.
    """
    if fmt not in ("parquet", "json"):
        raise ValueError(f"unknown result format: {fmt}")
    if not results:
        raise ValueError("a run without results")
    spark = next(iter(results.values())).sparkSession
    if not replace and not _published(spark, path).where(F.col("run_id") == run_id).isEmpty():
        raise RunPublished(run_id)
    attempt = uuid.uuid4().hex
    for name, df in results.items():
        df.write.mode("errorifexists").format(fmt).save(f"{path}/tables/{name}/attempt={attempt}")
    row = spark.createDataFrame([(attempt, sorted(results))], "attempt string, tables array<string>")
    row.write.mode("overwrite" if replace else "errorifexists").json(f"{path}/published/run_id={run_id}")


def _published(spark: SparkSession, path: str) -> DataFrame:
    """``(attempt, tables, run_id)``, one row per published run."""
    return read_or_empty(spark, f"{path}/published", "attempt string, tables array<string>, run_id string")


def read_published(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A result table of all published runs, with their ``run_id``; attempts that were not published are not read."""
    runs = _published(spark, path).where(F.array_contains("tables", name)).select("attempt", "run_id")
    rows = spark.read.format(fmt).load(f"{path}/tables/{name}")
    rows = rows.withColumn("attempt", F.col("attempt").cast("string"))
    return rows.join(F.broadcast(runs), "attempt").drop("attempt")  # one row per run; it prunes the folders


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON rows of a folder with a given schema; none while nothing has been written there."""
    try:
        return spark.read.schema(schema).json(path).select(*T.StructType.fromDDL(schema).names)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def save_model(
    model: Model, path: str, features: Sequence[str], metrics: DataFrame, cv: DataFrame | None = None
) -> None:
    """The model, its feature names in order, its metric rows and its fold scores."""
    spark = metrics.sparkSession
    stages = model if isinstance(model, PipelineModel) else PipelineModel(stages=[model])
    stages.write().overwrite().save(f"{path}/model")
    names = spark.createDataFrame([(i, f) for i, f in enumerate(features)], "position int, feature string")
    names.coalesce(1).write.mode("overwrite").json(f"{path}/features")
    metrics.coalesce(1).write.mode("overwrite").json(f"{path}/metrics")
    if cv is not None:
        cv.coalesce(1).write.mode("overwrite").json(f"{path}/cv")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, list[str]]:
    names = spark.read.json(f"{path}/features").orderBy("position").collect()
    return PipelineModel.load(f"{path}/model"), [r["feature"] for r in names]
