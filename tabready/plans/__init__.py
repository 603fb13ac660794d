"""Compositions of the operators over the driver's tables, and the registry
of named queries with their SQL oracles."""

from __future__ import annotations


def registry() -> dict:
    """``name -> (spark_fn(spark, sf_dir), oracle_sql or None)`` for every query."""
    from tabready.plans import experiment_queries, ml_queries, model_queries, ops_queries, prep_queries, sink_queries

    out: dict = {}
    for mod in (prep_queries, model_queries, ops_queries, ml_queries, sink_queries, experiment_queries):
        for k, v in mod.QUERIES.items():
            if k in out:
                raise ValueError(f"duplicate query name {k}")
            out[k] = v
    return out
