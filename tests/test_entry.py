"""The driver contract: every query has a unique name, oracle keys are a
subset, and the flagship query runs on sf0.001."""

import __spark_entry__ as E
from tabready.plans import registry
from conftest import SF_SMALL


def test_registry_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 70
    assert not any(k.startswith("op") and k[2:3].isdigit() for k in registry())


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and {"model", "validation_rmse", "validation_rank"} <= set(df.columns)


def test_small_queries_run(spark):
    for name in ("prep_funnel", "deterministic_split", "recommendation", "permutation_importance"):
        assert E.queries()[name](spark, SF_SMALL).count() >= 0
