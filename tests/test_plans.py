"""Plan shapes that matter at scale: no cross joins and no Python UDFs in
any SQL-checked query, pruned scans, one shared shuffle in the profile."""

import contextlib
import io

import re

import __spark_entry__ as E
from tabready.operators import profile
from tabready.plans.standins import line_contract, raw_lines

SF = "/root/testdata/sf0.001"


def plan_of(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_no_cross_join_or_python_udf_in_sql_checked_queries(spark):
    queries, sql = E.queries(), E.oracle_sql()
    bad = {}
    for name in sorted(sql):
        plan = plan_of(queries[name](spark, SF))
        found = [k for k in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
                 if k in plan]
        if found:
            bad[name] = found
    assert bad == {}


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(E.queries()["target_build"](spark, SF), "formatted")
    read = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert read and all("l_shipdate" not in line for line in read)


def test_profile_counts_and_samples_share_one_shuffle(spark):
    c = line_contract()
    df = profile.column_profile(raw_lines(spark, SF), c.target, c.components, [c.identifier])
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_no_text_in_an_exchange(spark):
    from tabready.plans.standins import doc_model_table

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(doc_model_table(spark, SF), "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanged = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan)
    assert exchanged and not any("text" in x for x in exchanged)


def test_candidates_score_in_one_pass(spark):
    from tabready.operators.candidates import candidate_predictions
    from tabready.plans import models as X
    from tabready.plans.standins import doc_splits

    splits = doc_splits(spark, SF)
    preds = candidate_predictions(splits, X.CANDIDATES, "doc_id", X.DOC_TARGET)
    plan = plan_of(preds, "simple")
    assert plan.count("FileScan") == 1 and " Exchange" not in plan and "SortMergeJoin" not in plan
    assert preds.count() == splits.count() * len(X.CANDIDATES)


def test_profile_of_texts_shuffles_digests(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = plan_of(profile.column_profile(docs, columns=["text", "lang"]), "formatted")
    assert "md5" in plan
    long = spark.createDataFrame([("a" * 5000 + str(k),) for k in range(20)] * 2, "t string")
    row = profile.column_profile(long).first()
    assert (row.unique_count, row.row_count, row.sample_values) == (20, 40, " | ".join(["a" * 100] * 3))
