"""Bindings of the operators to the driver's tables.

The reference works on one athletes CSV that is not available; these frames
give each operator a real table with the same shape of problem:

* ``lineitem`` is the raw table: four components (quantity, price, discount,
  tax) with sentinel 1 build the target ``line_total``; the identifier
  ``row_key`` repeats, so de-duplication does real work.
* ``documents`` joined with ``labels`` is the model table: ``n_chars`` is the
  learnable target, word and line counts, language and source are features,
  and the partial labels give sparse features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabready.contract import Contract
from tabready.operators.split import deterministic_split
from tabready.plans.prepare import clean_table, prepare_table
from tabready.session import staged
from tabready.sources.io import read_parquet_table

# Fixed parameters of the stand-in problems.
SEED = 42
SPLIT_FRACTIONS = (0.64, 0.16, 0.20)
LINE_COMPONENTS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINE_SENTINELS = (1.0,)
LINE_TARGET_BOUNDS = (1000.0, 100000.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return read_parquet_table(spark, f"{sf_dir}/{name}.parquet")


def line_contract() -> Contract:
    valid_supp = F.when(F.col("l_suppkey") > 0, F.col("l_suppkey"))
    return Contract(
        identifier="row_key",
        target="line_total",
        components=LINE_COMPONENTS,
        sentinels=LINE_SENTINELS,
        numeric_features=("l_partkey", "l_suppkey", "l_linenumber"),
        categorical_features=("l_returnflag", "l_linestatus"),
        required_features=("l_linenumber", "l_returnflag"),
        engineered={
            "linenumber_squared": F.pow(F.col("l_linenumber"), 2),
            "part_supp_ratio": F.col("l_partkey") / valid_supp,
        },
        valid_ranges={"l_linenumber": (1.0, 6.0)},
        positive_only=("l_partkey",),
        target_bounds=LINE_TARGET_BOUNDS,
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table: identifier, components and raw feature columns."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("row_key"),
        *LINE_COMPONENTS,
        "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus",
    )


def cleaned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw -> target (P10) -> cleaning (P4-P8) -> engineered (P11), before row filters."""
    return clean_table(raw_lines(spark, sf_dir), line_contract())


def prepared_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 -> F2 -> F3 -> projection (P12) -> de-duplication (W1) on the cleaned lines."""
    return prepare_table(raw_lines(spark, sf_dir), line_contract())


def prepared_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepared table as later steps read it: written once per session
    (S5) and scanned back, as the quality gate, statistics and resplit read
    the prepared Parquet rather than re-running preparation."""
    return staged(spark, f"prepared_lines:{sf_dir}", lambda: prepared_lines(spark, sf_dir),
                  [f"{sf_dir}/lineitem.parquet"])


def split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepared table with its split labels, staged once per session."""
    c = line_contract()
    return staged(spark, f"split_lines:{sf_dir}",
                  lambda: deterministic_split(prepared_table(spark, sf_dir), c.identifier, SPLIT_FRACTIONS, SEED),
                  [f"{sf_dir}/lineitem.parquet"])


# ---- the documents model table ------------------------------------------------

DOC_NUMERIC = ("word_count", "line_count", "quality", "toxic")
DOC_CATEGORICAL = ("lang", "source")
DOC_TARGET = "n_chars"


def doc_inputs(sf_dir: str) -> list[str]:
    """The files that the documents model table is made of."""
    return [f"{sf_dir}/documents.parquet", f"{sf_dir}/labels.parquet"]


def doc_model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, word_count, line_count, quality, toxic, lang, source, n_chars``.

    ``labels`` covers part of the documents, so ``quality``/``toxic`` are sparse.
    """
    # the counts are made on the scan, so that no text goes through an exchange
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.size(F.split(F.col("text"), " ")).cast("double").alias("word_count"),
        F.size(F.split(F.col("text"), "\n")).cast("double").alias("line_count"),
        "lang",
        "source",
        F.col("n_chars").cast("double").alias("n_chars"),
    )
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left").select(
        "doc_id", "word_count", "line_count", F.col("quality").cast("double").alias("quality"),
        F.col("toxic").cast("double").alias("toxic"), "lang", "source", "n_chars",
    )


def doc_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model table with its split labels, staged once per session."""
    return staged(spark, f"doc_splits:{sf_dir}",
                  lambda: deterministic_split(doc_model_table(spark, sf_dir), "doc_id", SPLIT_FRACTIONS, SEED), doc_inputs(sf_dir))
