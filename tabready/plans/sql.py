"""DuckDB oracle fragments that mirror ``standins`` step by step.

They are written independently of the Spark code (plain SQL over the driver's
views) so the correctness check compares two separate derivations.
"""

from __future__ import annotations

from tabready.plans.standins import LINE_TARGET_BOUNDS, SEED, SPLIT_FRACTIONS

TRAIN_F, VAL_F, TEST_F = SPLIT_FRACTIONS
VAL_OF_REST = VAL_F / (TRAIN_F + VAL_F)
LO, HI = LINE_TARGET_BOUNDS


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def cat(x: str) -> str:
    t = f"lower({strip(f'CAST({x} AS VARCHAR)')})"
    return f"CASE WHEN {t} NOT IN ('', 'nan', 'none', 'null') THEN {t} END"


def comp(x: str, mask_non_positive: bool = True) -> str:
    cond = f"{x} <> 1.0" + (f" AND {x} > 0" if mask_non_positive else "")
    return f"CASE WHEN {cond} THEN CAST({x} AS DOUBLE) END"


RAW = """raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS row_key,
         l_quantity, l_extendedprice, l_discount, l_tax,
         l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus
  FROM lineitem)"""

CLEANED = RAW + f""",
cleaned0 AS (
  SELECT row_key, l_quantity, l_extendedprice, l_discount, l_tax,
         CASE WHEN CAST(l_partkey AS DOUBLE) > 0 THEN CAST(l_partkey AS DOUBLE) END AS l_partkey,
         CAST(l_suppkey AS DOUBLE) AS l_suppkey,
         CASE WHEN CAST(l_linenumber AS DOUBLE) >= 1.0 AND CAST(l_linenumber AS DOUBLE) <= 6.0
              THEN CAST(l_linenumber AS DOUBLE) END AS l_linenumber,
         {cat('l_returnflag')} AS l_returnflag,
         {cat('l_linestatus')} AS l_linestatus,
         {comp('l_quantity')} + {comp('l_extendedprice')} + {comp('l_discount')} + {comp('l_tax')} AS line_total
  FROM raw),
cleaned AS (
  SELECT *, pow(l_linenumber, 2) AS linenumber_squared,
         l_partkey / CASE WHEN l_suppkey > 0 THEN l_suppkey END AS part_supp_ratio
  FROM cleaned0)"""

FEATURES = ["l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus",
            "linenumber_squared", "part_supp_ratio"]
COMPLETENESS = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in FEATURES)
TIEBREAK = ", ".join(f"{c} ASC NULLS FIRST" for c in [*FEATURES, "line_total"])

PREPARED = CLEANED + f""",
filtered AS (
  SELECT row_key, {', '.join(FEATURES)}, line_total FROM cleaned
  WHERE line_total IS NOT NULL AND row_key IS NOT NULL
    AND l_linenumber IS NOT NULL AND l_returnflag IS NOT NULL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY ({COMPLETENESS}) DESC, {TIEBREAK}) AS _rn
  FROM filtered),
prepared AS (SELECT row_key, {', '.join(FEATURES)}, line_total FROM ranked WHERE _rn = 1)"""


def split_cte(src: str, ident: str, name: str = "splits") -> str:
    """Exact-size split by rank of ``(md5(seed:id), id)``; same sizes rule as M1."""
    return f"""{name}_r AS (
  SELECT *, row_number() OVER (ORDER BY md5('{SEED}:' || CAST({ident} AS VARCHAR)), CAST({ident} AS VARCHAR)) AS _rk,
         count(*) OVER () AS _n
  FROM {src}),
{name}_c AS (SELECT *, CAST(ceil(_n * CAST({TEST_F!r} AS DOUBLE)) AS BIGINT) AS _n_test FROM {name}_r),
{name}_c2 AS (SELECT *, CAST(ceil((_n - _n_test) * CAST({VAL_OF_REST!r} AS DOUBLE)) AS BIGINT) AS _n_val FROM {name}_c),
{name} AS (
  SELECT * EXCLUDE (_rk, _n, _n_test, _n_val),
         CASE WHEN _rk <= _n_test THEN 'test' WHEN _rk <= _n_test + _n_val THEN 'validation' ELSE 'train' END
           AS data_split
  FROM {name}_c2)"""


LINE_SPLITS = PREPARED + ",\n" + split_cte("prepared", "row_key", "line_splits")

DOC_MODEL = """doc_model AS (
  SELECT d.doc_id,
         CAST(len(string_split(d.text, ' ')) AS DOUBLE) AS word_count,
         CAST(len(string_split(d.text, chr(10))) AS DOUBLE) AS line_count,
         CAST(l.quality AS DOUBLE) AS quality,
         CAST(l.toxic AS DOUBLE) AS toxic,
         d.lang, d.source,
         CAST(d.n_chars AS DOUBLE) AS n_chars
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

DOC_SPLITS = DOC_MODEL + ",\n" + split_cte("doc_model", "doc_id", "doc_splits")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
