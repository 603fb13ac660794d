"""Exact-size deterministic splits, sampling and split checks
(M1-M3, J5, U1, U2, U5, A5).

Plan shape of the split (SURVEY 4.3 item 1, refined): every row gets
``h = md5(seed ':' id)``; rows are ranked by ``(h, id)``.  A row's rank is at
most a cut ``c`` exactly when its key is at most the key ranked ``c``, so the
split only needs the two boundary keys.  They are found without a global
sort: rows are bucketed by the first hex digits of ``h`` (uniform, so buckets
are balanced whatever the key skew), bucket counts (at most 16^digits rows)
locate the bucket and position of each cut, and only those buckets are
ranked with a window.  Labelling is then a projection with two literal
comparisons -- no join and no shuffle of the table itself.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabready.functions.arithmetic import round_metric

SPLIT_LABELS: tuple[str, ...] = ("train", "validation", "test")
EXPORT_LABELS: tuple[str, ...] = ("train", "validate", "test")


def split_hash(identifier: str, seed: int):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(identifier).cast("string")))


def split_sizes(n: int, fractions: Sequence[float]) -> tuple[int, int, int]:
    """Exact sizes: ``n_test = ceil(n*test)``, ``n_val = ceil(rest*val/(train+val))``."""
    train, val, test = fractions
    n_test = math.ceil(n * test)
    n_val = math.ceil((n - n_test) * (val / (train + val)))
    return n - n_test - n_val, n_val, n_test


def _check_fractions(fractions: Sequence[float]) -> None:
    if len(fractions) != 3 or not math.isclose(sum(fractions), 1.0, rel_tol=0, abs_tol=1e-8):
        raise ValueError(f"three fractions with sum 1 are needed, got {list(fractions)}")


def _rank_cut(
    df: DataFrame,
    identifier: str,
    seed: int,
    cut_exprs,
    labels: Sequence[str],
    label_col: str,
    hex_digits: int,
    max_window_rows: int = 1 << 20,
) -> DataFrame:
    """Label rows by global rank of ``(md5(seed:id), id)`` against cut points.

    ``cut_exprs(total)`` returns Column cut points ``c1 <= c2 <= ...``; rank
    ``r`` (1-based) gets ``labels[i]`` for the first ``i`` with ``r <= c_i``,
    else the last label.  Rank ``r <= c_i`` exactly when the row's key is at
    most the key ranked ``c_i``, so only those few boundary keys are looked
    up (:func:`_boundary_keys`) and labelling is a projection of ``df`` that
    keeps its partitioning: no join, no shuffle of the rows.  A row with a
    NULL identifier is not ranked and gets a NULL label.
    """
    bounds = _boundary_keys(df, identifier, seed, cut_exprs, hex_digits, max_window_rows)
    h, ident = split_hash(identifier, seed), F.col(identifier).cast("string")
    label = None
    for i, key in enumerate(bounds):
        if key is None:  # a cut at rank 0 holds no row
            continue
        kh, kid = key
        within = (h < F.lit(kh)) | ((h == F.lit(kh)) & (ident <= F.lit(kid)))
        label = F.when(within, labels[i]) if label is None else label.when(within, labels[i])
    last = F.lit(labels[len(bounds)])
    label = last if label is None else label.otherwise(last)
    return df.withColumn(label_col, F.when(h.isNotNull(), label))


def _boundary_keys(df: DataFrame, identifier: str, seed: int, cut_exprs, hex_digits: int,
                   max_window_rows: int = 1 << 20) -> list:
    """The ``(hash, id)`` key ranked ``c_i`` for every cut, without a global sort.

    Rows are bucketed by the first hex digits of the hash (uniform, so no
    bucket is hot whatever the key skew).  One identifier-only pass counts
    the rows per bucket (at most 16^digits rows); running totals locate the
    bucket and in-bucket position of each cut.  A located bucket holding more
    than ``max_window_rows`` rows is split by the next three hex digits (one
    identifier-only count, at most 4,096 rows back) until it fits, so the
    final identifier-only pass ranks at most ``max_window_rows`` rows per cut
    with a window, whatever the table size.
    """
    keyed = (df.select(split_hash(identifier, seed).alias("_h"), F.col(identifier).cast("string").alias("_id"))
             .filter(F.col("_h").isNotNull())
             .withColumn("_bucket", F.substring("_h", 1, hex_digits)))
    counts = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # Window without partitionBy is allowed here: the input is the aggregated
    # bucket table, at most 16**hex_digits rows.
    w = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = counts.withColumn("_cum", F.sum("_n").over(w)).withColumn(
        "_total", F.sum("_n").over(Window.partitionBy(F.lit(1))))
    cuts = cut_exprs(F.col("_total"))
    per_cut = totals.select("_bucket", "_n", (F.col("_cum") - F.col("_n")).alias("_before"), "_cum",
                            F.posexplode(F.array(*[c.cast("long") for c in cuts])).alias("_i", "_c"))
    located = per_cut.filter((F.col("_before") < F.col("_c")) & (F.col("_c") <= F.col("_cum"))).select(
        "_i", "_bucket", (F.col("_c") - F.col("_before")).alias("_k"), "_n")
    # cut -> (hash prefix, position inside it, rows under the prefix)
    where = {r["_i"]: (r["_bucket"], r["_k"], r["_n"]) for r in located.collect()}
    bounds: list = [None] * len(cuts)
    if not where:
        return bounds
    while True:
        big = sorted({p for p, _, n in where.values() if n > max_window_rows and len(p) < 32})
        if not big:
            break
        for p in big:
            width = min(3, 32 - len(p))
            sub = sorted((r["_s"], r["_n"]) for r in (
                keyed.filter(F.col("_h").startswith(p))
                .groupBy(F.substring("_h", 1, len(p) + width).alias("_s"))
                .agg(F.count(F.lit(1)).alias("_n")).collect()))
            for i, (q, k, _) in list(where.items()):
                if q != p:
                    continue
                before = 0
                for s_, n_ in sub:
                    if before < k <= before + n_:
                        where[i] = (s_, k - before, n_)
                        break
                    before += n_
                else:
                    raise RuntimeError("The split input changed between its counting passes.")
    # one hash with more rows than a window holds is one identifier: told from the
    # counts, without sorting its rows
    for i, (p, k, n) in list(where.items()):
        if n > max_window_rows:
            only = keyed.filter(F.col("_h") == p).agg(F.max("_id").alias("_id")).first()["_id"]
            if k < n:
                raise ValueError(f"identifier {only!r} repeats at a cut, so no exact cut exists; de-duplicate first")
            bounds[i] = (p, only)
            del where[i]
    if not where:
        return bounds
    prefixes = sorted({p for p, _, _ in where.values()})
    prefix = None
    for p in prefixes:
        prefix = F.when(F.col("_h").startswith(p), p) if prefix is None else prefix.when(F.col("_h").startswith(p), p)
    wanted = None
    for p, k, _ in where.values():
        c = (F.col("_p") == p) & (F.col("_r") == k)
        wanted = c if wanted is None else wanted | c
    ranked = (keyed.withColumn("_p", prefix).filter(F.col("_p").isNotNull())
              .withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy("_h", "_id")))
              .withColumn("_next", F.lead("_id").over(Window.partitionBy("_p").orderBy("_h", "_id")))
              .filter(wanted)
              .select("_p", "_r", "_h", "_id", "_next"))
    found = {}
    for r in ranked.collect():
        if r["_next"] == r["_id"]:
            raise ValueError(f"identifier {r['_id']!r} repeats at a cut, so no exact cut exists; de-duplicate first")
        found[(r["_p"], r["_r"])] = (r["_h"], r["_id"])
    for i, (p, k, _) in where.items():
        bounds[i] = found[(p, k)]
    return bounds


def deterministic_split(
    df: DataFrame,
    identifier: str,
    fractions: Sequence[float] = (0.64, 0.16, 0.20),
    seed: int = 42,
    labels: Sequence[str] = SPLIT_LABELS,
    split_col: str = "data_split",
    hex_digits: int = 4,
    max_window_rows: int = 1 << 20,
) -> DataFrame:
    """M1: exact-size, repeatable, disjoint train/validation/test labels.

    Identifiers must be unique (run W1 first).  Ranks ``1..n_test`` are test,
    the next ``n_val`` validation, the rest train.  An identifier that repeats
    across a cut raises: its rows belong together and the sizes are exact.
    Membership differs from
    scikit-learn's shuffle (H5); sizes and determinism match.
    """
    _check_fractions(fractions)
    train, val, test = (float(x) for x in fractions)
    val_of_rest = val / (train + val)

    def cuts(total):
        n_test = F.ceil(total * F.lit(test))
        n_val = F.ceil((total - n_test) * F.lit(val_of_rest))
        return [n_test, n_test + n_val]

    test_l, val_l, train_l = labels[2], labels[1], labels[0]
    return _rank_cut(df, identifier, seed, cuts, [test_l, val_l, train_l], split_col, hex_digits, max_window_rows)


def sample_rows(df: DataFrame, identifier: str, n: int, seed: int = 42, hex_digits: int = 4) -> DataFrame:
    """M2: ``n`` rows without replacement (all rows if fewer), chosen by the
    same hash order as the split, so the sample is repeatable and exact-size."""
    labelled = _rank_cut(df, identifier, seed, lambda total: [F.least(total, F.lit(n))], ["in", "out"], "_sample",
                         hex_digits)
    return labelled.filter(F.col("_sample") == "in").drop("_sample")


def resplit_after_cleaning(
    df: DataFrame, identifier: str, target: str, minimum: float, maximum: float,
    fractions: Sequence[float] = (0.64, 0.16, 0.20), seed: int = 42, split_col: str = "data_split",
) -> DataFrame:
    """M3: drop the old split, apply the target gate (F6), split again."""
    from tabready.operators.target import filter_valid_target

    base = df.drop(split_col) if split_col in df.columns else df
    return deterministic_split(filter_valid_target(base, target, minimum, maximum), identifier, fractions, seed,
                               split_col=split_col)


# ---- J5 / U5: isolation ------------------------------------------------------

def split_isolation_summary(df: DataFrame, identifier: str, split_col: str = "data_split") -> DataFrame:
    """J5 as one row of counts (zero everywhere means the split is clean)."""
    per_id = df.groupBy(identifier).agg(
        F.count(F.lit(1)).alias("occurrences"), F.count_distinct(split_col).alias("split_count")
    )
    return per_id.agg(
        F.count_if(F.col(identifier).isNotNull()).alias("distinct_identifiers"),
        F.count_if(F.col("split_count") > 1).alias("identifiers_in_multiple_splits"),
        F.count_if(F.col(identifier).isNotNull() & (F.col("occurrences") > 1)).alias("duplicated_identifiers"),
        F.coalesce(F.sum(F.when(F.col(identifier).isNull(), F.col("occurrences"))), F.lit(0)).alias(
            "missing_identifier_rows"
        ),
    )


def id_overlap_between_splits(
    df: DataFrame, identifier: str, split_col: str = "data_split", labels: Sequence[str] = SPLIT_LABELS
) -> DataFrame:
    """Number of identifiers shared by each pair of splits, one pass."""
    per_id = df.filter(F.col(identifier).isNotNull()).groupBy(identifier).agg(
        *[F.max((F.col(split_col) == lab).cast("int")).alias(f"_in{i}") for i, lab in enumerate(labels)]
    )
    pairs = [(i, j) for i in range(len(labels)) for j in range(i + 1, len(labels))]
    counts = per_id.agg(
        *[F.count_if((F.col(f"_in{i}") == 1) & (F.col(f"_in{j}") == 1)).alias(f"p{i}_{j}") for i, j in pairs]
    )
    stack = ", ".join(f"'{labels[i]}', '{labels[j]}', p{i}_{j}" for i, j in pairs)
    return counts.selectExpr(f"stack({len(pairs)}, {stack}) as (left_split, right_split, shared_identifiers)")


# ---- U1 / U2: combine and label checks ---------------------------------------

def combine_splits(
    frames: Mapping[str, DataFrame], split_col: str = "data_split", expected: Sequence[str] = EXPORT_LABELS
) -> DataFrame:
    """Label each split and stack them (UNION ALL by name).

    Raises on a wrong key order or any column mismatch, before any job runs.
    """
    from tabready.contract import validate_schemas_match

    if tuple(frames.keys()) != tuple(expected):
        raise ValueError(f"expected the splits {list(expected)} in this order, got {list(frames)}")
    cols = validate_schemas_match(frames)
    out = None
    for label in expected:
        part = frames[label].select(*cols).withColumn(split_col, F.lit(label))
        out = part if out is None else out.unionByName(part, allowMissingColumns=False)
    return out


def distinct_split_labels(df: DataFrame, split_col: str = "data_split", expected: Sequence[str] = EXPORT_LABELS):
    """Observed labels with a flag for whether each was expected.  A label
    set that differs from ``expected`` shows as an unexpected or missing row."""
    observed = df.select(F.col(split_col).alias("split_label")).distinct().withColumn("observed", F.lit(True))
    exp = df.sparkSession.createDataFrame([(x,) for x in expected], "split_label string").withColumn(
        "expected", F.lit(True)
    )
    return observed.join(F.broadcast(exp), "split_label", "full_outer").select(
        "split_label",
        F.coalesce("observed", F.lit(False)).alias("observed"),
        F.coalesce("expected", F.lit(False)).alias("expected"),
    )


# ---- A5 ----------------------------------------------------------------------

def split_summary(df: DataFrame, target: str, split_col: str = "data_split") -> DataFrame:
    """A5: per split rows, share of all rows, target mean/median/std/max."""
    from tabready.functions.cleaning import present
    from tabready.operators.quantiles import aggregate_with_quantiles

    value = present(df, target)
    aggs = [
        F.count(F.lit(1)).alias("rows"),
        round_metric(F.avg(value)).alias("target_mean"),
        round_metric(F.stddev_samp(value)).alias("target_std"),
        F.max(value).alias("target_max"),
    ]
    per = aggregate_with_quantiles(df, value, aggs, [0.5], ["target_median"], [split_col]).withColumn(
        "target_median", round_metric("target_median"))
    # the aggregated table has one row per split label: an unpartitioned window is fine
    total = F.sum("rows").over(Window.partitionBy(F.lit(1)))
    return per.withColumn("percent_of_rows", round_metric(F.col("rows") * 100.0 / total, 4))
