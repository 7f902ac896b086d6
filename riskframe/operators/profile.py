"""Profiling and validation of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# --- Fixed values: columns that are never features -----------------------------------------------

FEATURE_EXCLUSIONS = [
    "patient_id", "encounter_id", "label", "target", "readmission", "timestamp", "primary_diagnosis",
    "final_diagnosis", "risk_level", "requires_icu", "label_index", "features", "raw_features",
    "scaled_features", "prediction", "rawPrediction", "probability",
]
TRAINING_EXCLUSIONS = [
    "patient_id", "timestamp", "primary_diagnosis", "final_diagnosis", "risk_level", "requires_icu",
    "features", "raw_features", "scaled_features", "prediction", "rawPrediction", "probability", "label_index",
    "label",
]


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, nullability, row count, number and percentage of NULLs. One scan of the table."""
    entries = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.lit(field.nullable).alias("nullable"),
            F.count(F.lit(1)).alias("n_rows"),
            (F.count(F.lit(1)) - F.count(F.col(f"`{field.name}`"))).alias("n_null"),
        )
        for position, field in enumerate(df.schema.fields)
    ]
    share = F.when(F.col("n_rows") > 0, F.col("n_null") / F.col("n_rows") * 100).otherwise(F.lit(0.0))
    return df.agg(F.array(*entries).alias("e")).select(F.inline("e")).withColumn("pct_null", share)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of rows and columns of each table in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def completeness(columns: list[str]) -> Column:
    """Share of non-NULL columns in a row, rounded to 4 digits."""
    filled = sum((F.col(f"`{c}`").isNotNull().cast("int") for c in columns), F.lit(0))
    return F.round(filled / F.lit(len(columns)), 4)


def with_completeness(df: DataFrame, name: str = "data_completeness_score") -> DataFrame:
    return df.withColumn(name, completeness(df.columns))


def numeric_columns(df: DataFrame, exclude: list[str] | tuple[str, ...] = FEATURE_EXCLUSIONS) -> list[str]:
    """Names of the numeric columns that are not in ``exclude``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in set(exclude)]
