"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallystone.plans.catalog import (
    description,
    evaluation,
    inference,
    modelling,
    preparation,
    quality,
)
from tallystone.plans.catalog.registry import ORACLES, QUERIES

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (description, quality, inference, preparation, evaluation, modelling)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
