"""Duplicate handling.

De-duplication numbers an identifier's rows and keeps the first.  The limit goes
below the exchange (one row per identifier leaves a map task), so an identifier
holding a third of all rows is reduced where it is read, and a row is carried
once, not beside an ordering key that repeats its columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def completeness(features: Sequence[str]) -> Column:
    """Number of non-null values among ``features``."""
    total = F.lit(0)
    for c in features:
        total = total + F.col(c).isNotNull().cast("int")
    return total


def dedup_most_complete(
    df: DataFrame, identifier: str, features: Sequence[str], tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """Per identifier keep the row with the most non-null features.

    Ties are broken by the remaining columns in ascending order (NULL first),
    then they are identical rows (H9: Spark has no input order to fall back on).
    Rows with a NULL identifier are kept as they are, like the reference.
    """
    others = [c for c in df.columns if c != identifier]
    tiebreak = list(tiebreak) if tiebreak is not None else others
    order = [(-completeness(features)).asc(), *[F.col(c).asc_nulls_first() for c in tiebreak]]
    number = F.row_number().over(Window.partitionBy(identifier).orderBy(*order))
    kept = df.filter(F.col(identifier).isNotNull()).withColumn("_number", number).filter("_number <= 1").drop("_number")
    return kept.unionByName(df.filter(F.col(identifier).isNull())).select(*df.columns)


def count_duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A3: rows equal to an earlier row over all (or the given) columns."""
    cols = list(columns) if columns else df.columns
    return (
        df.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))
    )


def duplicate_identifier_table(df: DataFrame, identifier: str) -> DataFrame:
    """Identifiers that occur more than once, with their row counts."""
    return (
        df.filter(F.col(identifier).isNotNull())
        .groupBy(identifier)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def count_duplicate_identifiers(df: DataFrame, identifier: str) -> DataFrame:
    """A4: rows whose identifier occurs more than once (every copy counted)."""
    return duplicate_identifier_table(df, identifier).agg(
        F.count(F.lit(1)).alias("duplicated_identifiers"),
        F.coalesce(F.sum("occurrences"), F.lit(0)).alias("duplicate_identifier_rows"),
    )
