"""Missing-value imputation: fitted on one table, applied to any."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystone.functions.columns import (
    column_aggregates,
    is_numeric,
    missing,
    missing_sql,
    number,
    present,
    ref,
    text_literal,
)
from tallystone.operators.neighbours import nearest_donors
from tallystone.operators.profile import categorical_profile
from tallystone.operators.quantiles import exact_quantiles
from tallystone.operators.ranks import value_cells
from tallystone.session import materialize

PARAMS_SCHEMA = "column string, strategy string, number double, text string"


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, missing_count, missing_percent, dtype)`` of the columns with holes."""
    columns = list(columns or df.columns)
    dtypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    fields = {
        "missing_count": "count_if({v})",
        "missing_percent": "round(count_if({v}) * 100.0D / count(*), 2)",
        "dtype": lambda c: f"any_value({text_literal(dtypes[c])})",
    }
    return column_aggregates(df, columns, fields, value=missing_sql).where("missing_count > 0")


def remaining_missing(df: DataFrame) -> int:
    row = df.agg(*[F.count_if(missing(df, c)).alias(str(i)) for i, c in enumerate(df.columns)]).first()
    return sum(row)


def fit_imputer(
    df: DataFrame,
    numeric: str = "median",
    categorical: str = "mode",
    numeric_constant: float = 0.0,
    categorical_constant: str = "Unknown",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One parameter row per column that has missing values.

    Numeric strategies: mean, median, mode, constant. Categorical: mode, constant.
    The mode takes the smallest of the most frequent values.
    """
    if numeric not in ("mean", "median", "mode", "constant"):
        raise ValueError(f"unknown numeric strategy: {numeric}")
    if categorical not in ("mode", "constant"):
        raise ValueError(f"unknown categorical strategy: {categorical}")
    columns = list(columns or df.columns)
    holes = df.agg(*[F.count_if(missing(df, c)).alias(c) for c in columns]).first()
    affected = [c for c in columns if holes[c]]
    nums = [c for c in affected if is_numeric(df.schema[c].dataType)]
    cats = [c for c in affected if c not in nums]
    rows: list[tuple] = []
    if nums and numeric == "mean":
        means = df.agg(*[F.avg(number(df, c)).alias(c) for c in nums]).first()
        rows += [(c, "mean", means[c], None) for c in nums]
    elif nums and numeric == "median":
        found = exact_quantiles(df, nums, [0.5])
        rows += [(c, "median", found[c].values[0.5], None) for c in nums]
    elif nums and numeric == "mode":
        rows += [(c, "mode", m, None) for c, m in _numeric_modes(df, nums).items()]
    else:
        rows += [(c, "constant", float(numeric_constant), None) for c in nums]
    if cats and categorical == "mode":
        modes = {r["column"]: r["most_frequent"] for r in categorical_profile(df, cats).collect()}
        rows += [(c, "mode", None, modes.get(c)) for c in cats]
    else:
        rows += [(c, "constant", None, categorical_constant) for c in cats]
    return df.sparkSession.createDataFrame(rows, PARAMS_SCHEMA)


def _numeric_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value"))).alias("b")
    return {r["column"]: r["b"]["value"] for r in value_cells(df, columns).groupBy("column").agg(best).collect()}


def apply_imputer(df: DataFrame, params: DataFrame) -> DataFrame:
    """Fill the fitted columns in one projection. A mean or median makes its column double; a mode keeps
    the type, and so does a constant that is whole."""
    fills = {r["column"]: r for r in params.collect() if r["column"] in df.columns}
    changes = {}
    for c, r in fills.items():
        if is_numeric(df.schema[c].dataType):
            if r["number"] is None:
                continue
            kind = df.schema[c].dataType
            keeps = r["strategy"] in ("mode", "constant") and float(r["number"]).is_integer()
            changes[c] = F.coalesce(present(df, c), F.lit(r["number"])).cast(kind if keeps else "double")
        else:
            changes[c] = F.coalesce(ref(c), F.lit(r["text"]).cast(df.schema[c].dataType))
    return df.withColumns(changes)


KNN_HOLES = 20_000  # incomplete rows per block
KNN_DONORS = 500_000  # donor rows per block


def knn_impute(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    donors: DataFrame | None = None,
    k: int = 5,
    holes_per_block: int = KNN_HOLES,
    donors_per_block: int = KNN_DONORS,
) -> DataFrame:
    """Fill each hole with the mean of the ``k`` nearest donors that have the value.

    Distance is Euclidean over the columns both rows have, scaled up by the share of columns left out. Rows with the same
    columns present form a pattern; for each pattern of incomplete rows and each of donors the columns of both are searched
    by a tree of blocks (see :mod:`tallystone.operators.neighbours`), so that donors which cannot be nearer are not visited, and the
    nearest over all donor patterns are taken. Equal distances go to the lower donor key, a row is not its own donor; a hole
    without any donor takes the mean of the donors' column.
    """
    return knn_search(df, key, columns, donors, k, holes_per_block, donors_per_block)[0]


def knn_search(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    donors: DataFrame | None = None,
    k: int = 5,
    holes_per_block: int = KNN_HOLES,
    donors_per_block: int = KNN_DONORS,
) -> tuple[DataFrame, DataFrame | None]:
    """The filled table, and ``(g, queries, donors, pairs)``: the distances measured for each pair of patterns.

    Without holes, or where no donor shares a column with an incomplete row, there is nothing to measure and the second is None.
    """
    donors = donors if donors is not None else df
    columns = list(columns)
    plain = [number(df, c).alias(c) if c in columns else ref(c) for c in df.columns]
    values = lambda d: F.array(*[number(d, c) for c in columns])
    pattern = F.concat_ws("", F.transform("v", lambda v: F.when(v.isNull(), "0").otherwise("1")))
    holes = df.select(ref(key).alias("_key"), values(df).alias("v")).withColumn("has", pattern)
    holes = materialize(holes.where(F.contains("has", F.lit("0"))), "holes")
    pool = donors.select(ref(key).alias("d"), values(donors).alias("v")).withColumn("has", pattern)
    means = donors.agg(*[F.avg(number(donors, c)).alias(c) for c in columns]).first()
    mean_or = lambda c, fill: F.coalesce(number(df, c), fill, F.lit(means[c]))
    by_mean = df.select(*[mean_or(c, F.lit(None).cast("double")).alias(c) if c in columns else ref(c) for c in df.columns])

    patterns = lambda d: sorted(r["has"] for r in d.select("has").distinct().collect())
    wanted = patterns(holes)
    if not wanted:
        return df.select(*plain), None
    met = []
    for o in wanted:
        for d in patterns(pool):
            shared = "".join("1" if a == b == "1" else "0" for a, b in zip(o, d))
            if "1" in shared and any(a == "0" and b == "1" for a, b in zip(o, d)):
                met.append((f"{o}|{d}", o, d, shared))
    if not met:
        return by_mean, None
    pairs = F.broadcast(df.sparkSession.createDataFrame(met, "g string, o string, p string, shared string"))  # pairs of patterns
    part = F.filter(
        F.transform("v", lambda v, i: F.when(F.substring("shared", i + 1, F.lit(1)) == "1", v)), lambda v: v.isNotNull()
    )
    asked = holes.join(pairs, F.col("has") == F.col("o")).select("_key", "g", part.alias("x"), "v")
    given = pool.join(pairs, F.col("has") == F.col("p")).select("g", "d", part.alias("x"), "v")
    # one more than k: a row's own key may be among the donors
    near = nearest_donors(asked, given, k + 1, holes_per_block, donors_per_block)
    found = asked.select("_key", "g", "x", F.col("v").alias("mine")).join(near.found, ["g", "x"]).where(F.col("d") != F.col("_key"))
    scale = F.sqrt(F.lit(float(len(columns))) / F.size("x"))
    cells = found.select(
        "_key", "d", (F.col("distance") * scale).alias("distance"),
        F.posexplode(F.transform("mine", lambda m, i: F.when(m.isNull(), F.get("v", i)))).alias("at", "value"),
    ).where(F.col("value").isNotNull())
    w = Window.partitionBy("_key", "at").orderBy("distance", "d")
    best = cells.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k)
    filled = best.groupBy("_key").agg(
        *[F.avg(F.when(F.col("at") == i, F.col("value"))).alias(f"{c}|fill") for i, c in enumerate(columns)]
    )
    joined = df.join(filled, df[key] == filled["_key"], "left")
    done = joined.select(*[mean_or(c, ref(f"{c}|fill")).alias(c) if c in columns else ref(c) for c in df.columns])
    return done, near.work
