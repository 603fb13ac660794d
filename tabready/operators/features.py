"""Column construction and projection (P3, P11, P12, P19) and the cleaning
stage that applies P4-P8 according to a contract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabready.contract import Contract, is_numeric_type, reject_prohibited_features
from tabready.functions.cleaning import clean_categorical, null_non_positive, null_out_of_range, parse_numeric_or_time


def synthesize_identifier(df: DataFrame, name: str = "row_id", columns: Sequence[str] | None = None) -> DataFrame:
    """A deterministic identifier when the table has none.

    ``row_<md5 of the row>_<ordinal>``; the ordinal numbers identical rows.  One
    aggregate counts each distinct row (partial counts, so a row that fills a
    third of the table is one buffer per task) and its copies are generated
    from that count: no row is numbered twice or lost, whatever the
    partitioning or retries, and no window sees a hot row's copies.
    """
    cols = list(columns) if columns else df.columns
    content = F.md5(F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"}))
    counted = df.withColumn("_h", content).groupBy("_h", *df.columns).agg(F.count(F.lit(1)).alias("_n"))
    # rows that agree in ``columns`` only share a hash: their ordinals follow each other
    others = Window.partitionBy("_h").orderBy(*df.columns).rowsBetween(Window.unboundedPreceding, -1)
    first = F.lit(0).cast("long") if set(cols) == set(df.columns) else F.coalesce(F.sum("_n").over(others), F.lit(0))
    return (counted.withColumn("_first", first)
            .select(*df.columns, "_h", "_first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("_k"))
            .select(*df.columns, F.concat(F.lit("row_"), "_h", F.lit("_"), (F.col("_first") + F.col("_k")).cast("string")).alias(name)))


def clean_features(df: DataFrame, contract: Contract) -> DataFrame:
    """Apply P4 to numeric features, P7 ranges, P8 positives and P6 to categoricals."""
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs: dict[str, Column] = {}
    for c in contract.numeric_features:
        v = parse_numeric_or_time(c, is_numeric=is_numeric_type(types[c]))
        lo_hi = contract.valid_ranges.get(c)
        if lo_hi is not None:
            v = null_out_of_range(v, *lo_hi)
        if c in contract.positive_only:
            v = null_non_positive(v)
        exprs[c] = v
    for c in contract.categorical_features:
        exprs[c] = clean_categorical(c)
    return df.withColumns(exprs)


def add_engineered_features(df: DataFrame, engineered: Mapping[str, Column]) -> DataFrame:
    """Add configured engineered columns (one projection)."""
    return df.withColumns(dict(engineered)) if engineered else df


def body_features(weight: str = "weight", height: str = "height", age: str = "age") -> dict[str, Column]:
    """The reference's engineered set: BMI (imperial), age squared and
    weight/height ratio; a height ``<= 0`` gives NULL."""
    valid_height = F.when(F.col(height) > 0, F.col(height))
    return {
        "bmi": F.lit(703.0) * F.col(weight) / F.pow(valid_height, 2),
        "age_squared": F.pow(F.col(age), 2),
        "weight_height_ratio": F.col(weight) / valid_height,
    }


def project_model_frame(
    df: DataFrame, features: Sequence[str], target: str, identifier: str | None = None,
    prohibited: Sequence[str] = (),
) -> DataFrame:
    """``[id?, features..., target]``; F7 rejects leaking features first."""
    reject_prohibited_features(features, [*prohibited, target, *([identifier] if identifier else [])])
    cols = ([identifier] if identifier else []) + list(features) + [target]
    return df.select(*cols)


def drop_split_and_filter(df: DataFrame, label: str, split_col: str = "data_split") -> DataFrame:
    """One split without the split column (partition-pruned when the
    table is written with ``partitionBy(split_col)``)."""
    return df.filter(F.col(split_col) == label).drop(split_col)
