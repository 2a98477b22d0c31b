"""Readers for feature tables: CSV, parquet, catalog table, JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import BASE_FEATURES, LABEL


def load_data(
    spark: SparkSession,
    source: str,
    path: str | None = None,
    table: str = "ae_model_features",
    schema: T.StructType | str | None = None,
    jdbc: dict | None = None,
) -> DataFrame:
    """Read a feature table, coerce its model columns and drop unlabelled rows.

    ``source`` is ``csv``, ``parquet``, ``table`` or ``jdbc``.  An unknown source or
    a missing input raises.  For JDBC pass ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` in ``jdbc`` so executors read in parallel.
    """
    if source == "csv":
        df = read_csv(spark, path, schema)
    elif source == "parquet":
        df = spark.read.parquet(path)
    elif source == "table":
        df = spark.table(table)
    elif source == "jdbc":
        df = spark.read.format("jdbc").options(dbtable=table, **(jdbc or {})).load()
    else:
        raise ValueError(f"unknown source: {source!r}")
    return drop_unlabelled(coerce_numeric(df))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header.  Give a schema at scale: inference reads the data twice."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def coerce_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Model columns to DOUBLE; text that is no number becomes null, and so does NaN."""
    columns = columns or BASE_FEATURES + [LABEL]
    present = [c for c in columns if c in df.columns]
    number = {c: F.col(c).try_cast("double") for c in present}
    return df.withColumns({c: F.when(~F.isnan(v), v) for c, v in number.items()})


def drop_unlabelled(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=[LABEL])


def split_features_target(
    df: DataFrame, features: list[str] | None = None, keep: list[str] = ()
) -> DataFrame:
    """Features that exist as DOUBLE plus the label as INT, on the same rows.

    A Spark model reads both from one DataFrame, so nothing has to be re-joined.
    """
    present = [c for c in (features or BASE_FEATURES) if c in df.columns]
    return df.select(
        *keep,
        *[F.col(c).cast("double").alias(c) for c in present],
        F.col(LABEL).cast("int").alias(LABEL),
    )
