"""Registered queries for cleaning, target, funnel, dedup and split operators.

Each entry is ``name -> (spark_fn(spark, sf_dir), oracle_sql or None)``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabready.contract import normalize_columns
from tabready.functions import cleaning as C
from tabready.operators import dedup, split, target
from tabready.operators.features import add_engineered_features
from tabready.plans import sql as S
from tabready.plans.standins import (
    LINE_COMPONENTS, LINE_SENTINELS, LINE_TARGET_BOUNDS, SEED, SPLIT_FRACTIONS, cleaned_lines, line_contract, prepared_lines, prepared_table,
    raw_lines, split_lines, table,
)

LO, HI = LINE_TARGET_BOUNDS


# ---- scalar functions on real columns ------------------------------------------

def q_normalize_columns(spark, sf):
    """P1 on a frame whose column names need normalising (derived from customer)."""
    cust = table(spark, sf, "customer")
    messy = cust.select(
        F.col("c_custkey").alias(" Customer Key "),
        F.col("c_mktsegment").alias("Mkt-Segment"),
        F.col("c_acctbal").alias("Account Balance ($)"),
    )
    return normalize_columns(messy)


SQL_NORMALIZE = """SELECT c_custkey AS customer_key, c_mktsegment AS mkt_segment, c_acctbal AS account_balance
FROM customer"""


def _event_texts(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select(
        "event_id",
        F.regexp_extract("props", r"(\d+)", 1).alias("props_text"),
        F.date_format("ts", "H:mm:ss").alias("clock_text"),
        F.concat(F.col("user_id").cast("string"), F.lit(",000")).alias("thousands_text"),
        F.concat(F.lit(" "), F.col("event_type"), F.lit("\t")).alias("word_text"),
    )


SQL_EVENT_TEXTS = r"""ev AS (
  SELECT event_id,
         regexp_extract(props, '(\d+)', 1) AS props_text,
         strftime(ts, '%-H:%M:%S') AS clock_text,
         CAST(user_id AS VARCHAR) || ',000' AS thousands_text,
         ' ' || event_type || chr(9) AS word_text
  FROM events)"""


def _sql_parse(x: str) -> str:
    t = f"(CASE WHEN {S.strip(x)} NOT IN ('', 'nan', 'none', 'null') THEN {S.strip(x)} END)"
    digits = f"replace({t}, ',', '')"
    clock = (f"CASE WHEN len(string_split({t}, ':')) = 2 THEN "
             f"TRY_CAST(string_split({t}, ':')[1] AS DOUBLE) * 60 + TRY_CAST(string_split({t}, ':')[2] AS DOUBLE) "
             f"WHEN len(string_split({t}, ':')) = 3 THEN "
             f"TRY_CAST(string_split({t}, ':')[1] AS DOUBLE) * 3600 + TRY_CAST(string_split({t}, ':')[2] AS DOUBLE) * 60 "
             f"+ TRY_CAST(string_split({t}, ':')[3] AS DOUBLE) END")
    number = f"CASE WHEN regexp_full_match({digits}, '{C.NUMBER_PATTERN}') THEN TRY_CAST({digits} AS DOUBLE) END"
    return f"CASE WHEN regexp_full_match({t}, '{C.CLOCK_PATTERN}') THEN {clock} ELSE {number} END"


def q_parse_numeric_or_time(spark, sf):
    """P4 on four text columns derived from events: digits, clock, thousands, words."""
    ev = _event_texts(spark, sf)
    return ev.select(
        "event_id",
        C.parse_numeric_or_time("props_text").alias("props_value"),
        C.parse_numeric_or_time("clock_text").alias("clock_value"),
        C.parse_numeric_or_time("thousands_text").alias("thousands_value"),
        C.parse_numeric_or_time("word_text").alias("word_value"),
    )


SQL_PARSE = S.with_(SQL_EVENT_TEXTS) + f"""SELECT event_id,
  {_sql_parse('props_text')} AS props_value,
  {_sql_parse('clock_text')} AS clock_value,
  {_sql_parse('thousands_text')} AS thousands_value,
  {_sql_parse('word_text')} AS word_value
FROM ev"""


def q_clock_to_seconds(spark, sf):
    """P5 on event clock times (``H:mm:ss``)."""
    ev = _event_texts(spark, sf)
    return ev.select("event_id", "clock_text", C.clock_to_seconds("clock_text").alias("seconds"))


SQL_CLOCK = S.with_(SQL_EVENT_TEXTS) + """SELECT event_id, clock_text,
  CAST(split_part(clock_text, ':', 1) AS DOUBLE) * 3600 + CAST(split_part(clock_text, ':', 2) AS DOUBLE) * 60
  + CAST(split_part(clock_text, ':', 3) AS DOUBLE) AS seconds
FROM ev"""


def q_clean_categorical(spark, sf):
    """P6 on padded, upper-cased market segments and order priorities."""
    cust = table(spark, sf, "customer")
    return cust.select(
        "c_custkey",
        C.clean_categorical(F.concat(F.lit("  "), F.upper("c_mktsegment"), F.lit(" "))).alias("segment"),
        C.clean_categorical(F.when(F.col("c_acctbal") > 0, F.lit("NULL")).otherwise(F.col("c_name")))
        .alias("name_or_null"),
    )


SQL_CLEAN_CAT = f"""SELECT c_custkey,
  {S.cat("'  ' || upper(c_mktsegment) || ' '")} AS segment,
  {S.cat("CASE WHEN c_acctbal > 0 THEN 'NULL' ELSE c_name END")} AS name_or_null
FROM customer"""


def q_null_out_of_range(spark, sf):
    """Account balances outside [0, 5000] become NULL."""
    cust = table(spark, sf, "customer")
    return cust.select("c_custkey", C.null_out_of_range("c_acctbal", 0.0, 5000.0).alias("acctbal_in_range"))


SQL_OUT_OF_RANGE = """SELECT c_custkey, CASE WHEN c_acctbal >= 0.0 AND c_acctbal <= 5000.0 THEN c_acctbal END
  AS acctbal_in_range FROM customer"""


def q_null_non_positive(spark, sf):
    """Non-positive balances, discounts and taxes become NULL."""
    cust = table(spark, sf, "customer")
    return cust.select("c_custkey", C.null_non_positive("c_acctbal").alias("acctbal_positive"))


SQL_NON_POSITIVE = """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS acctbal_positive FROM customer"""


# ---- target ------------------------------------------------------------------

def q_target_build(spark, sf):
    """P10 over every lineitem row."""
    c = line_contract()
    df = target.build_target(raw_lines(spark, sf), c.target, c.components, c.sentinels)
    return df.select("row_key", *LINE_COMPONENTS, "line_total")


SQL_TARGET_BUILD = S.with_(S.RAW) + f"""SELECT row_key, l_quantity, l_extendedprice, l_discount, l_tax,
  {S.comp('l_quantity')} + {S.comp('l_extendedprice')} + {S.comp('l_discount')} + {S.comp('l_tax')} AS line_total
FROM raw"""


def q_sentinel_counts(spark, sf):
    """P9 counts: sentinel values per component."""
    return target.sentinel_counts(raw_lines(spark, sf), LINE_COMPONENTS, LINE_SENTINELS)


SQL_SENTINEL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS component, CAST(count_if({c} = 1.0) AS BIGINT) AS sentinel_count FROM lineitem"
    for c in LINE_COMPONENTS
)


def q_target_readiness(spark, sf):
    """A2: readiness summary (zeros kept)."""
    return target.target_readiness(raw_lines(spark, sf), LINE_COMPONENTS, LINE_SENTINELS, "row_key")


_T_READY = " + ".join(S.comp(c, mask_non_positive=False) for c in LINE_COMPONENTS)
_COMPLETE = " AND ".join(f"{c} IS NOT NULL AND {c} <> 1.0" for c in LINE_COMPONENTS)
SQL_READINESS = S.with_(S.RAW) + f""", r AS (
  SELECT row_key IS NOT NULL AS id_ok, ({_COMPLETE}) AS complete, {_T_READY} AS t,
         {' + '.join(f'CAST({c} = 1.0 AS INTEGER)' for c in LINE_COMPONENTS)} AS n_sent
  FROM raw)
SELECT CAST(count(*) AS BIGINT) AS initial_rows,
  CAST(count_if(NOT id_ok) AS BIGINT) AS missing_identifier_rows,
  CAST(count_if(id_ok AND NOT complete) AS BIGINT) AS missing_or_invalid_target_rows,
  CAST(count_if(id_ok AND complete) AS BIGINT) AS eligible_rows,
  CAST(sum(n_sent) AS BIGINT) AS total_sentinel_replacements,
  CAST(count(CASE WHEN id_ok AND complete THEN t END) AS BIGINT) AS target_count,
  min(CASE WHEN id_ok AND complete THEN t END) AS target_min,
  max(CASE WHEN id_ok AND complete THEN t END) AS target_max,
  round(avg(CASE WHEN id_ok AND complete THEN t END), 6) AS target_mean,
  round(median(CASE WHEN id_ok AND complete THEN t END), 6) AS target_median,
  round(stddev_samp(CASE WHEN id_ok AND complete THEN t END), 6) AS target_std
FROM r"""


def q_engineered_features(spark, sf):
    """P11 on the cleaned lineitem features."""
    c = line_contract()
    df = add_engineered_features(cleaned_lines(spark, sf), c.engineered)
    return df.select("row_key", "l_linenumber", "linenumber_squared", "part_supp_ratio")


SQL_ENGINEERED = S.with_(S.CLEANED) + "SELECT row_key, l_linenumber, linenumber_squared, part_supp_ratio FROM cleaned"


def q_prep_funnel(spark, sf):
    """rows after target, identifier, required-feature and dedup steps."""
    c = line_contract()
    return target.prep_funnel(cleaned_lines(spark, sf), c.target, c.identifier, c.required_features)


SQL_FUNNEL = S.with_(S.CLEANED) + """, per_id AS (
  SELECT row_key,
         count(*) AS n_raw,
         count_if(line_total IS NOT NULL) AS n_target,
         count_if(line_total IS NOT NULL AND row_key IS NOT NULL) AS n_id,
         count_if(line_total IS NOT NULL AND row_key IS NOT NULL AND l_linenumber IS NOT NULL
                  AND l_returnflag IS NOT NULL) AS n_kept
  FROM cleaned GROUP BY row_key)
SELECT CAST(sum(n_raw) AS BIGINT) AS initial_rows,
  CAST(sum(n_target) AS BIGINT) AS rows_after_target_filter,
  CAST(sum(n_target) - sum(n_id) AS BIGINT) AS missing_identifier_rows,
  CAST(sum(n_id) AS BIGINT) AS rows_after_identifier_filter,
  CAST(sum(n_id) - sum(n_kept) AS BIGINT) AS rows_removed_for_required_features,
  CAST(sum(n_kept) AS BIGINT) AS rows_after_required_filter,
  CAST(coalesce(sum(CASE WHEN n_kept > 1 THEN n_kept END), 0) AS BIGINT) AS duplicate_identifier_rows,
  CAST(sum(n_kept) - count_if(n_kept > 0) AS BIGINT) AS duplicates_removed,
  CAST(count_if(n_kept > 0) AS BIGINT) AS final_rows
FROM per_id"""


def q_target_outlier_audit(spark, sf):
    """F5 on the prepared table."""
    df = target.audit_target_outliers(prepared_table(spark, sf), "line_total", LO, HI)
    return df.select("row_key", "line_total", "target_quality_reason")


SQL_AUDIT = S.with_(S.PREPARED) + f"""SELECT row_key, line_total,
  CASE WHEN line_total IS NULL THEN 'missing_target' WHEN line_total < {LO} THEN 'below_minimum'
       WHEN line_total > {HI} THEN 'above_maximum' END AS target_quality_reason
FROM prepared WHERE line_total IS NULL OR line_total < {LO} OR line_total > {HI}"""


def q_valid_target_filter(spark, sf):
    """inclusive bounds."""
    return target.filter_valid_target(prepared_table(spark, sf), "line_total", LO, HI)


SQL_VALID = S.with_(S.PREPARED) + f"SELECT * FROM prepared WHERE line_total BETWEEN {LO} AND {HI}"


def q_target_statistics(spark, sf):
    """A6 grouped by return flag (the first slice of SURVEY 7.3)."""
    return target.target_statistics(prepared_table(spark, sf), "line_total", by=["l_returnflag"])


SQL_TARGET_STATS = S.with_(S.PREPARED) + """SELECT l_returnflag,
  CAST(count(line_total) AS BIGINT) AS target_count, min(line_total) AS target_min, max(line_total) AS target_max,
  round(avg(line_total), 6) AS target_mean, round(median(line_total), 6) AS target_median,
  round(stddev_samp(line_total), 6) AS target_std, round(quantile_cont(line_total, 0.99), 6) AS target_p99
FROM prepared GROUP BY l_returnflag"""


def q_value_counts(spark, sf):
    """Rows per outlier reason."""
    audit = target.audit_target_outliers(prepared_table(spark, sf), "line_total", LO, HI)
    return target.value_counts(audit, ["target_quality_reason"])


SQL_VALUE_COUNTS = S.with_(S.PREPARED) + f""", a AS (
  SELECT CASE WHEN line_total IS NULL THEN 'missing_target' WHEN line_total < {LO} THEN 'below_minimum'
       WHEN line_total > {HI} THEN 'above_maximum' END AS target_quality_reason FROM prepared)
SELECT target_quality_reason, CAST(count(*) AS BIGINT) AS row_count FROM a
WHERE target_quality_reason IS NOT NULL GROUP BY 1"""


# ---- duplicates --------------------------------------------------------------

def q_dedup_most_complete(spark, sf):
    """W1 on the filtered, projected lineitem table."""
    return prepared_lines(spark, sf)


SQL_DEDUP = S.with_(S.PREPARED) + "SELECT * FROM prepared"


def q_duplicate_identifiers(spark, sf):
    """A4 on the raw identifiers."""
    return dedup.count_duplicate_identifiers(raw_lines(spark, sf), "row_key")


SQL_DUP_IDS = S.with_(S.RAW) + """, g AS (SELECT row_key, count(*) AS n FROM raw WHERE row_key IS NOT NULL
  GROUP BY row_key HAVING count(*) > 1)
SELECT CAST(count(*) AS BIGINT) AS duplicated_identifiers, CAST(coalesce(sum(n), 0) AS BIGINT)
  AS duplicate_identifier_rows FROM g"""


def q_duplicate_rows(spark, sf):
    """A3 over all columns of the raw table."""
    return dedup.count_duplicate_rows(raw_lines(spark, sf))


SQL_DUP_ROWS = S.with_(S.RAW) + """, g AS (SELECT count(*) AS n FROM raw
  GROUP BY row_key, l_quantity, l_extendedprice, l_discount, l_tax, l_partkey, l_suppkey, l_linenumber,
           l_returnflag, l_linestatus)
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM g"""


# ---- split -------------------------------------------------------------------

def q_deterministic_split(spark, sf):
    """M1: exact-size 64/16/20 split of the written prepared table (the split itself computed, not staged)."""
    c = line_contract()
    return split.deterministic_split(prepared_table(spark, sf), c.identifier, SPLIT_FRACTIONS, SEED).select(
        "row_key", "data_split")


SQL_SPLIT = S.with_(S.LINE_SPLITS) + "SELECT row_key, data_split FROM line_splits"


def q_split_summary(spark, sf):
    """A5 per split."""
    return split.split_summary(split_lines(spark, sf), "line_total")


SQL_SPLIT_SUMMARY = S.with_(S.LINE_SPLITS) + """, per AS (
  SELECT data_split, count(*) AS rows, round(avg(line_total), 6) AS target_mean,
         round(median(line_total), 6) AS target_median, round(stddev_samp(line_total), 6) AS target_std,
         max(line_total) AS target_max
  FROM line_splits GROUP BY data_split)
SELECT data_split, CAST(rows AS BIGINT) AS rows, target_mean, target_median, target_std, target_max,
  round(rows * 100.0 / sum(rows) OVER (), 4) AS percent_of_rows FROM per"""


def q_split_isolation(spark, sf):
    """Identifiers in several splits, repeated or missing (all zero when clean)."""
    return split.split_isolation_summary(split_lines(spark, sf), "row_key")


SQL_ISOLATION = S.with_(S.LINE_SPLITS) + """, per AS (
  SELECT row_key, count(*) AS occ, count(DISTINCT data_split) AS nsplit FROM line_splits GROUP BY row_key)
SELECT CAST(count_if(row_key IS NOT NULL) AS BIGINT) AS distinct_identifiers,
  CAST(count_if(nsplit > 1) AS BIGINT) AS identifiers_in_multiple_splits,
  CAST(count_if(row_key IS NOT NULL AND occ > 1) AS BIGINT) AS duplicated_identifiers,
  CAST(coalesce(sum(CASE WHEN row_key IS NULL THEN occ END), 0) AS BIGINT) AS missing_identifier_rows
FROM per"""


def q_id_overlap(spark, sf):
    """Shared identifiers per pair of splits."""
    return split.id_overlap_between_splits(split_lines(spark, sf), "row_key")


SQL_ID_OVERLAP = S.with_(S.LINE_SPLITS) + """, per AS (
  SELECT row_key, max(CAST(data_split = 'train' AS INTEGER)) AS a, max(CAST(data_split = 'validation' AS INTEGER)) AS b,
         max(CAST(data_split = 'test' AS INTEGER)) AS c FROM line_splits GROUP BY row_key)
SELECT 'train' AS left_split, 'validation' AS right_split, CAST(count_if(a = 1 AND b = 1) AS BIGINT) AS shared_identifiers FROM per
UNION ALL SELECT 'train', 'test', CAST(count_if(a = 1 AND c = 1) AS BIGINT) FROM per
UNION ALL SELECT 'validation', 'test', CAST(count_if(b = 1 AND c = 1) AS BIGINT) FROM per"""


def q_combine_splits(spark, sf):
    """The three splits relabelled for export and stacked."""
    df = split_lines(spark, sf).select("row_key", "line_total", "data_split")
    frames = {
        "train": df.filter(F.col("data_split") == "train").drop("data_split"),
        "validate": df.filter(F.col("data_split") == "validation").drop("data_split"),
        "test": df.filter(F.col("data_split") == "test").drop("data_split"),
    }
    return split.combine_splits(frames)


SQL_COMBINE = S.with_(S.LINE_SPLITS) + """SELECT row_key, line_total,
  CASE data_split WHEN 'validation' THEN 'validate' ELSE data_split END AS data_split FROM line_splits"""


def q_distinct_split_labels(spark, sf):
    """Observed vs expected export labels."""
    return split.distinct_split_labels(q_combine_splits(spark, sf))


SQL_LABELS = S.with_(S.LINE_SPLITS) + """, obs AS (
  SELECT DISTINCT CASE data_split WHEN 'validation' THEN 'validate' ELSE data_split END AS split_label
  FROM line_splits),
exp AS (SELECT * FROM (VALUES ('train'), ('validate'), ('test')) AS t(split_label))
SELECT coalesce(o.split_label, e.split_label) AS split_label, o.split_label IS NOT NULL AS observed,
  e.split_label IS NOT NULL AS expected
FROM obs o FULL OUTER JOIN exp e ON o.split_label = e.split_label"""


def q_sample_rows(spark, sf):
    """M2: 1,000 rows by hash order."""
    return split.sample_rows(prepared_table(spark, sf), "row_key", 1000, SEED).select("row_key")


SQL_SAMPLE = S.with_(S.PREPARED) + f"""SELECT row_key FROM prepared
ORDER BY md5('{SEED}:' || row_key), row_key LIMIT 1000"""


def q_resplit_after_cleaning(spark, sf):
    """M3: target gate, then a fresh split."""
    df = split.resplit_after_cleaning(split_lines(spark, sf), "row_key", "line_total", LO, HI)
    return df.select("row_key", "data_split")


SQL_RESPLIT = S.with_(S.PREPARED + f""",
valid AS (SELECT * FROM prepared WHERE line_total BETWEEN {LO} AND {HI})""",
                      S.split_cte("valid", "row_key", "resplit")) + "SELECT row_key, data_split FROM resplit"


QUERIES = {
    "normalize_columns": (q_normalize_columns, SQL_NORMALIZE),
    "parse_numeric_or_time": (q_parse_numeric_or_time, SQL_PARSE),
    "clock_to_seconds": (q_clock_to_seconds, SQL_CLOCK),
    "clean_categorical": (q_clean_categorical, SQL_CLEAN_CAT),
    "null_out_of_range": (q_null_out_of_range, SQL_OUT_OF_RANGE),
    "null_non_positive": (q_null_non_positive, SQL_NON_POSITIVE),
    "target_build": (q_target_build, SQL_TARGET_BUILD),
    "sentinel_counts": (q_sentinel_counts, SQL_SENTINEL),
    "target_readiness": (q_target_readiness, SQL_READINESS),
    "engineered_features": (q_engineered_features, SQL_ENGINEERED),
    "prep_funnel": (q_prep_funnel, SQL_FUNNEL),
    "target_outlier_audit": (q_target_outlier_audit, SQL_AUDIT),
    "valid_target_filter": (q_valid_target_filter, SQL_VALID),
    "target_statistics": (q_target_statistics, SQL_TARGET_STATS),
    "value_counts": (q_value_counts, SQL_VALUE_COUNTS),
    "dedup_most_complete": (q_dedup_most_complete, SQL_DEDUP),
    "duplicate_identifiers": (q_duplicate_identifiers, SQL_DUP_IDS),
    "duplicate_rows": (q_duplicate_rows, SQL_DUP_ROWS),
    "deterministic_split": (q_deterministic_split, SQL_SPLIT),
    "split_summary": (q_split_summary, SQL_SPLIT_SUMMARY),
    "split_isolation": (q_split_isolation, SQL_ISOLATION),
    "id_overlap_between_splits": (q_id_overlap, SQL_ID_OVERLAP),
    "combine_splits": (q_combine_splits, SQL_COMBINE),
    "distinct_split_labels": (q_distinct_split_labels, SQL_LABELS),
    "sample_rows": (q_sample_rows, SQL_SAMPLE),
    "resplit_after_cleaning": (q_resplit_after_cleaning, SQL_RESPLIT),
}
