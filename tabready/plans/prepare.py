"""Contract-driven preparation.

``prepare_table`` is the raw-to-prepared step for any contract, as one lazy
plan with a single shuffle (on the identifier):

- target build (P10), cleaning (P4-P8) and engineered features (P11, which
  run before the row filters);
- the target, identifier and required-feature filters (F1-F3);
- the model projection (P12) and most-complete de-duplication (W1).

``prepare_and_split`` adds the exact-size split (M1).
``quality_gate_and_resplit`` applies the target bounds and splits again
(F6 + M3).  ``export_splits`` relabels for export, gates the table (F9) and
writes a new versioned directory partitioned by split (S6), so a lost
executor re-reads the written table rather than this plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabready.contract import Contract
from tabready.operators.dedup import dedup_most_complete
from tabready.operators.features import add_engineered_features, clean_features, project_model_frame
from tabready.operators.gates import validate_split_export
from tabready.operators.split import deterministic_split, resplit_after_cleaning
from tabready.operators.target import build_target, drop_missing_required, filter_complete_target, filter_identified
from tabready.sources.io import write_splits


def clean_table(raw: DataFrame, contract: Contract) -> DataFrame:
    """Target (P10), cleaning (P4-P8) and engineered features (P11), before any row filter."""
    df = build_target(raw, contract.target, contract.components, contract.sentinels)
    df = clean_features(df, contract)
    return add_engineered_features(df, contract.engineered)


def prepare_table(raw: DataFrame, contract: Contract) -> DataFrame:
    """Raw table to ``[id, features..., target]``, one row per identifier."""
    df = clean_table(raw, contract)
    df = filter_identified(filter_complete_target(df, contract.target), contract.identifier)
    df = drop_missing_required(df, contract.required_features)
    df = project_model_frame(df, contract.features, contract.target, contract.identifier,
                             prohibited=contract.components)
    return dedup_most_complete(df, contract.identifier, contract.features)


def prepare_and_split(
    raw: DataFrame, contract: Contract, fractions: Sequence[float] = (0.64, 0.16, 0.20), seed: int = 42,
    split_col: str = "data_split",
) -> DataFrame:
    """The prepared table with exact-size train/validation/test labels."""
    return deterministic_split(prepare_table(raw, contract), contract.identifier, fractions, seed,
                               split_col=split_col)


def quality_gate_and_resplit(
    prepared: DataFrame, contract: Contract, fractions: Sequence[float] = (0.64, 0.16, 0.20), seed: int = 42,
    split_col: str = "data_split",
) -> DataFrame:
    """Keep targets inside the contract's bounds (inclusive), then split again."""
    if contract.target_bounds is None:
        raise ValueError("The contract has no target bounds.")
    lo, hi = contract.target_bounds
    return resplit_after_cleaning(prepared, contract.identifier, contract.target, lo, hi, fractions, seed,
                                  split_col=split_col)


def export_splits(split: DataFrame, contract: Contract, base: str, name: str = "export",
                  split_col: str = "data_split") -> str:
    """Export labels (``validation`` becomes ``validate``), the F9 checks, then
    the write.  Raises listing the failed checks, and writes nothing then."""
    labelled = split.withColumn(split_col, F.when(F.col(split_col) == "validation", "validate")
                                .otherwise(F.col(split_col)))
    checks = validate_split_export(labelled, contract.identifier, contract.target, split_col)
    failed = [r["check_name"] for r in checks.filter(F.col("status") == "FAIL").collect()]
    if failed:
        raise ValueError(f"Export checks failed: {', '.join(failed)}.")
    return write_splits(labelled, base, name, split_col)
