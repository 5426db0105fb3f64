"""Keyed covariate files: one row per cohort row and covariate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Column names of the covariate format.
COVARIATE_COLUMNS = ("rowId", "covariateId", "covariateValue")


def load_covariates(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    missing = [c for c in COVARIATE_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"covariate file {path} lacks {', '.join(missing)}")
    return df.select(*COVARIATE_COLUMNS)


def save_covariates(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.select(*COVARIATE_COLUMNS).write.mode(mode).parquet(path)
