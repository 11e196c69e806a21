"""Synthetic minority rows: points on the way from a row to one of its neighbours in the same class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.functions.columns import number, ref, require_columns
from tallystone.operators.neighbours import nearest_donors
from tallystone.operators.split import fit_cutoffs
from tallystone.session import materialize


def _draw(key: Column, copy: Column, seed: int, salt: str, digits: int) -> Column:
    """The first hex digits of an md5 as a whole number: the same draw on every run and engine."""
    text = F.concat_ws("-", key.cast("string"), copy.cast("string"), F.lit(str(seed)), F.lit(salt))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def smote(
    df: DataFrame, key: str, target: str, columns: Sequence[str], k: int = 5, ratio: float = 1.0, seed: int = 42
) -> DataFrame:
    """Synthetic rows that raise every class to ``ratio`` of the largest one.

    Every complete row of a class makes the same number of synthetic rows, give or take one; the rows that make one more
    come first in a hash order of the key. Each lies at a random place between its row and one of the row's ``k`` nearest
    rows of the same class (Euclidean distance over ``columns``, ties by key). Neighbours are exact: they come from a tree of blocks per
    class, not from all pairs. Draws are md5 hashes of key, copy and seed, so a run can be repeated. Rows with a missing value in
    ``columns`` count for their class but make nothing; a class that must grow needs two complete rows. Keys must be unique and present.

    Returns ``(target, columns…, base, neighbour, copy, gap)``: ``base + gap * (neighbour - base)`` in every column.
    """
    require_columns(df, [key, target, *columns])
    if not 0 < ratio <= 1:
        raise ValueError(f"ratio must be in (0, 1], got {ratio}")
    columns = list(columns)
    rows = df.select(
        ref(key).alias("d"), ref(target).cast("string").alias("g"), F.array(*[number(df, c) for c in columns]).alias("x")
    ).where("g IS NOT NULL")
    whole = ~F.exists("x", lambda v: v.isNull())
    sizes = {r["g"]: r for r in rows.groupBy("g").agg(F.count("*").alias("n"), F.count_if(whole).alias("usable")).collect()}
    most = max((r["n"] for r in sizes.values()), default=0)
    needed = {g: int(most * ratio) - r["n"] for g, r in sizes.items() if int(most * ratio) > r["n"]}
    schema = f"`{target}` {df.schema[target].dataType.simpleString()}, " + ", ".join(f"`{c}` double" for c in columns)
    kind = df.schema[key].dataType.simpleString()
    if not needed:
        return df.sparkSession.createDataFrame([], f"{schema}, base {kind}, neighbour {kind}, copy int, gap double")
    short = [g for g in needed if sizes[g]["usable"] < 2]
    if short:
        raise ValueError(f"classes with fewer than two complete rows: {short}")
    rows = materialize(rows.where(whole & F.col("g").isin(list(needed))), "minority")
    extra = fit_cutoffs(rows, "d", "g", lambda counts: {g: [needed[g] % n] for g, n in counts.items()}, seed).below(0)
    least = F.create_map(*[F.lit(v) for g, n in needed.items() for v in (g, n // sizes[g]["usable"])])
    copies = F.element_at(least, F.col("g")) + extra.cast("int")
    near = nearest_donors(rows, rows.withColumn("v", F.col("x")), k + 1)  # a row finds itself
    lists = near.found.groupBy("g", "x").agg(F.array_sort(F.collect_list(F.struct("distance", "d", "v"))).alias("near"))
    made = rows.withColumn("copies", copies).where("copies > 0").join(lists, ["g", "x"])
    made = made.withColumn("near", F.slice(F.filter("near", lambda o: o["d"] != F.col("d")), 1, k))
    made = made.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    chosen = F.pmod(_draw(F.col("d"), F.col("copy"), seed, "neighbour", 15), F.size("near")).cast("int")
    made = made.withColumn("other", F.get("near", chosen))
    gap = _draw(F.col("d"), F.col("copy"), seed, "gap", 13) / F.lit(float(16**13))
    made = made.withColumn("gap", gap)
    at = lambda i: F.get("x", F.lit(i)) + F.col("gap") * (F.get(F.col("other")["v"], F.lit(i)) - F.get("x", F.lit(i)))
    return made.select(
        F.col("g").cast(df.schema[target].dataType).alias(target), *[at(i).alias(c) for i, c in enumerate(columns)],
        F.col("d").alias("base"), F.col("other")["d"].alias("neighbour"), "copy", "gap",
    )
