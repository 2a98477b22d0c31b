"""Registered queries: name -> (Spark function, DuckDB text or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import extract
from ..session import tune
from ..sources.clinical import ClinicalTables, from_driver_tables
from ..sources.materialize import data_version, materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: add a query under ``name``, with its SQL twin where one exists."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


_TABLES: dict[tuple[str, str, str], ClinicalTables] = {}


def tables(spark: SparkSession, sf_dir: str) -> ClinicalTables:
    """The clinical views over one data folder; lazy, so only the plans are kept."""
    slot = (spark.sparkContext.applicationId, sf_dir, data_version(spark, sf_dir))
    if slot not in _TABLES:
        _TABLES[slot] = from_driver_tables(spark, sf_dir)
    return _TABLES[slot]


def matrix_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The materialized feature matrix every later stage reads."""
    build = lambda: extract.feature_matrix_a(tables(spark, sf_dir))
    return materialize(spark, "feature_matrix_a", sf_dir, build)
