"""Exact quantiles with bounded memory (the median and p99 of A2, A5, A6, A11, L1).

Spark's exact ``percentile`` keeps a value -> count map per group and merges
it in one task, so a global median over a large table holds every distinct
value in one place.  Here the value at each needed rank is found by
histogram narrowing:

1. one aggregate gives ``n``, ``min`` and ``max`` per group; each probability
   ``p`` needs the values at ranks ``floor((n-1)p)`` and ``ceil((n-1)p)``;
2. each pass buckets the values inside every unresolved rank's interval -- by
   sign and binary exponent where the interval spans several, by equal width
   within one -- with a partial aggregate, finds the bucket that holds the rank
   and shrinks the interval to that bucket's ``[min, max]``.  A bucket whose
   min equals its max resolves the rank, so a value that fills a third of the
   table resolves at once.  The smallest and largest value of an interval never
   share a bucket, so every pass makes progress, and one exponent holds 2^52
   doubles, so a handful of passes ends it for any input, infinities included;
3. an interval of at most ``final_rows`` values is ranked with a window
   partitioned by (group, interval): bounded work per task.

A group of more than ``final_rows`` values is never hashed on its key: the
ranks of such groups (there are at most rows / ``final_rows`` of them) are
broadcast in slices of ``STATE_GROUPS`` groups and the values are selected on
the map side.  Only groups that fit one bounded window go there whole.

NaN counts as missing.  Passes re-read the input; ``materialize=True``
checkpoints the value column first for an input that is expensive to recompute.
``aggregate_with_quantiles`` takes ``n``, ``min`` and ``max`` from the caller's
own aggregate pass.  The result equals Spark's ``percentile`` (same
interpolation, ``(hi - pos) * v_lo + (pos - lo) * v_hi``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabready.functions.cleaning import nan_to_null
from tabready.session import ensure_checkpoint_dir

BUCKETS, FINAL_ROWS = 4096, 1 << 20
#: Large groups whose ranks are broadcast at a time.
STATE_GROUPS = 50_000
SMALLEST = 5e-324


def _octave(x: Column) -> Column:
    """Sign and binary exponent as one number that grows with ``x``."""
    exponent = F.when(F.abs(x) == float("inf"), 3000).otherwise(F.floor(F.log2(F.abs(x))) + 1100)
    return F.when(x == 0, 0).otherwise(F.signum(x) * exponent).cast("long")


def _bucket(v: Column, lo: Column, hi: Column, buckets: int) -> Column:
    """Monotone in ``v``; the ends of an interval get different buckets."""
    width = F.greatest((hi - lo) / buckets, F.lit(SMALLEST))
    return (F.when(_octave(lo) != _octave(hi), _octave(v))
            .otherwise(F.least(F.floor((v - lo) / width), F.lit(buckets - 1))))


def _join(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner", broadcast: bool = False) -> DataFrame:
    """Join on ``by``, null keys included; the columns of ``left`` stay."""
    named = right.withColumnsRenamed({c: f"_r_{c}" for c in by})
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in by])
    out = left.join(F.broadcast(named) if broadcast else named, on, how)
    return out.drop(*[f"_r_{c}" for c in by]) if how in ("inner", "left") else out


def _targets(stats: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    pos = (F.col("_n") - 1) * F.col("_p")
    per_p = stats.select(*by, "_n", "_lo", "_hi", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("_p"))
    ranks = per_p.select(*by, "_n", "_lo", "_hi", F.explode(F.array_distinct(F.array(
        F.floor(pos), F.ceil(pos)))).alias("_rank"))
    return ranks.distinct().select(
        *by, "_rank", "_lo", "_hi", F.lit(0).cast("long").alias("_base"), F.col("_n").alias("_c"),
        F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).alias("_value"),
    )


def _narrow(values: DataFrame, state: DataFrame, by: Sequence[str], buckets: int, open_rank: Column) -> DataFrame:
    """One histogram pass over the open ranks; ``state`` is broadcast."""
    active = state.filter(open_rank)
    v = F.col("_v")
    hist = (_join(values, active.drop("_c", "_value"), by, broadcast=True)
            .filter(v.between(F.col("_lo"), F.col("_hi")))
            .groupBy(*by, "_rank", "_base", _bucket(v, F.col("_lo"), F.col("_hi"), buckets).alias("_b"))
            .agg(F.count(F.lit(1)).alias("_c"), F.min(v).alias("_bmin"), F.max(v).alias("_bmax")))
    # some thousand buckets per (group, rank) at most: a bounded window
    w = Window.partitionBy(*by, "_rank").orderBy("_b")
    cum = hist.withColumn("_before", F.col("_base") + F.sum("_c").over(w) - F.col("_c"))
    hit = cum.filter((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_c")))
    nxt = hit.select(
        *by, "_rank", F.col("_bmin").alias("_lo"), F.col("_bmax").alias("_hi"), F.col("_before").alias("_base"), "_c",
        F.when(F.col("_bmin") == F.col("_bmax"), F.col("_bmin")).alias("_value"),
    )
    return state.filter(~open_rank).unionByName(nxt)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    buckets: int = BUCKETS,
    final_rows: int | None = None,
    names: Sequence[str] | None = None,
    materialize: bool = False,
) -> DataFrame:
    """Exact interpolated quantiles of ``value`` per group (NULL and NaN ignored).

    Returns one row per group with one column per probability (named
    ``names`` or ``q_<p>``); groups without values are absent, so join the
    result to other aggregates with a left join.

    Narrowing passes (only for groups above ``final_rows`` values) re-read
    ``df``: cheap for a scan or a written table, where only the one column
    is read again.  ``materialize=True`` checkpoints the value column first,
    for an input that is expensive to recompute.
    """
    names = list(names) if names else [f"q_{p}" for p in probs]
    by = list(by)
    values = df.select(*by, nan_to_null(value).alias("_v")).filter(F.col("_v").isNotNull())
    stat_cols = [F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    if not by:
        n, lo, hi = values.agg(*stat_cols).first()
        qs = _global_quantiles(values, n, lo, hi, probs, buckets, final_rows, materialize)
        rows = [] if n == 0 else [tuple(qs)]
        return df.sparkSession.createDataFrame(rows, ", ".join(f"`{c}` double" for c in names))
    # one row per group, checkpointed: the only full pass when groups are small
    stats = values.groupBy(*by).agg(*stat_cols).checkpoint(eager=True)
    return _quantiles(values, stats, by, probs, names, buckets, final_rows, materialize)


def _interpolate(n: int, p: float, at: dict[int, float]) -> float:
    """Spark's ``percentile`` interpolation between the two ranks around ``(n-1)p``."""
    pos = (n - 1) * p
    r0, r1 = math.floor(pos), math.ceil(pos)
    v0, v1 = at[r0], at[r1]
    if r0 == r1 or v0 == v1:
        return v0
    return (r1 - pos) * v0 + (pos - r0) * v1


def _intervals(values: DataFrame, intervals: Sequence[tuple[float, float]]) -> DataFrame:
    """``(_iv, _lo, _v)`` for every value inside each of a few literal intervals
    (a Generate over literal structs: no join, nothing broadcast)."""
    spans = [F.struct(F.lit(i).alias("_iv"), F.lit(float(lo)).alias("_lo"), F.lit(float(hi)).alias("_hi"))
             for i, (lo, hi) in enumerate(intervals)]
    inside = None
    for lo, hi in intervals:
        c = F.col("_v").between(float(lo), float(hi))
        inside = c if inside is None else inside | c
    return (values.filter(inside).select("_v", F.explode(F.array(*spans)).alias("_s"))
            .filter(F.col("_v").between(F.col("_s._lo"), F.col("_s._hi")))
            .select(F.col("_s._iv").alias("_iv"), F.col("_s._lo").alias("_lo"), "_v"))


def _global_quantiles(
    values: DataFrame, n: int, lo: float | None, hi: float | None, probs: Sequence[float],
    buckets: int, final_rows: int | None, materialize: bool,
) -> list[float | None]:
    """The ungrouped case: the state is at most two ranks per probability, so
    it lives on the driver; each pass returns some thousand rows per
    unresolved interval."""
    final_rows = FINAL_ROWS if final_rows is None else final_rows
    if n == 0:
        return [None] * len(probs)
    ranks = sorted({r for p in probs for r in (math.floor((n - 1) * p), math.ceil((n - 1) * p))})
    # rank -> [lo, hi, base (values below lo), count inside, value]
    state = {r: [lo, hi, 0, n, lo if lo == hi else None] for r in ranks}
    pending = lambda: {(st[0], st[1]) for st in state.values() if st[4] is None and st[3] > final_rows}
    if materialize and pending():
        values = values.checkpoint(eager=True)
    while spans := sorted(pending()):
        rows = _histograms(values, spans, buckets)
        for r, st in state.items():
            if st[4] is not None or st[3] <= final_rows:
                continue
            cum = st[2]
            for b_lo, b_hi, c in rows[spans.index((st[0], st[1]))]:
                if cum <= r < cum + c:
                    state[r] = [b_lo, b_hi, cum, c, b_lo if b_lo == b_hi else None]
                    break
                cum += c
    # bounded residue: one window per remaining interval, ranks looked up
    rest = sorted({(st[0], st[1], st[2]) for st in state.values() if st[4] is None})
    if rest:
        w = Window.partitionBy("_iv").orderBy("_v")
        ranked = _intervals(values, [(a, b) for a, b, _ in rest]).withColumn("_i", F.row_number().over(w) - 1)
        wanted = [(i, r - base) for i, (a, b, base) in enumerate(rest)
                  for r, st in state.items() if st[4] is None and (st[0], st[1]) == (a, b)]
        hit = None
        for i, k in wanted:
            c = (F.col("_iv") == i) & (F.col("_i") == k)
            hit = c if hit is None else hit | c
        for row in ranked.filter(hit).select("_iv", "_i", "_v").collect():
            base = rest[row["_iv"]][2]
            for r, st in state.items():
                if st[4] is None and (st[0], st[1]) == rest[row["_iv"]][:2] and r - base == row["_i"]:
                    st[4] = row["_v"]
    at = {r: st[4] for r, st in state.items()}
    return [_interpolate(n, p, at) for p in probs]


def _histograms(values: DataFrame, spans: Sequence[tuple[float, float]], buckets: int) -> list[list[tuple]]:
    """Per interval, ``(min, max, count)`` of each non-empty equal-width bucket
    in bucket order -- some thousand rows per interval at most reach the driver."""
    iv = _intervals(values, spans)
    his = F.element_at(F.array(*[F.lit(float(hi)) for _, hi in spans]), F.col("_iv") + 1)
    b = _bucket(F.col("_v"), F.col("_lo"), his, buckets)
    rows = (iv.groupBy("_iv", b.alias("_b"))
            .agg(F.min("_v").alias("_bmin"), F.max("_v").alias("_bmax"), F.count(F.lit(1)).alias("_c"))
            .collect())
    out: list[list[tuple]] = [[] for _ in spans]
    for r in sorted(rows, key=lambda r: (r["_iv"], r["_b"])):
        out[r["_iv"]].append((r["_bmin"], r["_bmax"], r["_c"]))
    return out


def _quantiles(
    values: DataFrame, stats: DataFrame, by: Sequence[str], probs: Sequence[float], names: Sequence[str],
    buckets: int, final_rows: int | None, materialize: bool,
) -> DataFrame:
    """``values``: ``by`` + non-NULL double ``_v``; ``stats``: ``by`` + ``_n``,
    ``_lo``, ``_hi`` of the same values (groups with ``_n > 0`` only)."""
    ensure_checkpoint_dir(values.sparkSession)
    final_rows = FINAL_ROWS if final_rows is None else final_rows
    large = stats.filter(F.col("_n") > final_rows)
    slices = -(-large.count() // STATE_GROUPS)
    if slices and materialize:
        # an expensive input is written once (reliably, in spark.checkpoint.dir)
        values = values.checkpoint(eager=True)
    # groups that fit a window are ranked there, sharing one sort for all their ranks
    few = _targets(stats.filter(F.col("_n") <= final_rows), by, probs)
    rest = values
    for k in range(slices):
        rest = _join(rest, _slice(large, by, slices, k).select(*by), by, "left_anti", broadcast=True)
    found = _resolved(few).unionByName(_ranked(rest, few, by, broadcast=False))
    open_rank = F.col("_value").isNull() & (F.col("_c") > final_rows)
    for k in range(slices):
        state = _targets(_slice(large, by, slices, k), by, probs)
        while not state.filter(open_rank).isEmpty():
            state = _narrow(values, state, by, buckets, open_rank).checkpoint(eager=True)
        found = found.unionByName(_resolved(state)).unionByName(_ranked(values, state, by, broadcast=True))
    found = found.select(*by, "_rank", "_value")
    # interpolate exactly as Spark's percentile does
    pos = (F.col("_n") - 1) * F.col("_p")
    per_p = stats.select(*by, "_n", F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("_k", "_p")) \
        .withColumn("_r0", F.floor(pos)).withColumn("_r1", F.ceil(pos)).withColumn("_pos", pos)
    lo = found.select(*by, F.col("_rank").alias("_r0"), F.col("_value").alias("_v0"))
    hi = found.select(*by, F.col("_rank").alias("_r1"), F.col("_value").alias("_v1"))
    q = (_join(_join(per_p, lo, [*by, "_r0"]), hi, [*by, "_r1"])
         .withColumn("_q", F.when(F.col("_r0") == F.col("_r1"), F.col("_v0"))
                     .when(F.col("_v0") == F.col("_v1"), F.col("_v0"))
                     .otherwise((F.col("_r1") - F.col("_pos")) * F.col("_v0")
                                + (F.col("_pos") - F.col("_r0")) * F.col("_v1"))))
    return q.groupBy(*by).agg(*[F.max(F.when(F.col("_k") == i, F.col("_q"))).alias(n) for i, n in enumerate(names)])


def _slice(groups: DataFrame, by: Sequence[str], slices: int, k: int) -> DataFrame:
    return groups.filter(F.pmod(F.xxhash64(*by), F.lit(slices)) == k)


def _resolved(state: DataFrame) -> DataFrame:
    return state.filter(F.col("_value").isNotNull())


def _ranked(values: DataFrame, state: DataFrame, by: Sequence[str], broadcast: bool) -> DataFrame:
    """The rest of ``state``: rank the values inside each bounded interval.
    Ranks that share an interval share one sort."""
    pending = (state.filter(F.col("_value").isNull()).groupBy(*by, "_lo", "_hi", "_base")
               .agg(F.collect_set("_rank").alias("_ranks")))
    inside = _join(values, pending, by, broadcast=broadcast).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    ranked = (inside.withColumn("_rank", F.col("_base") - 1 + F.row_number().over(
                  Window.partitionBy(*by, "_lo", "_hi").orderBy("_v")))
              .filter(F.array_contains("_ranks", F.col("_rank"))))
    nothing = F.lit(0).cast("long")
    return ranked.select(*by, "_rank", "_lo", "_hi", "_base", nothing.alias("_c"), F.col("_v").alias("_value"))


def aggregate_with_quantiles(
    df: DataFrame, value: Column, aggs: Sequence[Column], probs: Sequence[float], names: Sequence[str],
    by: Sequence[str] = (), buckets: int = BUCKETS, final_rows: int | None = None, materialize: bool = False,
) -> DataFrame:
    """``df.groupBy(by).agg(*aggs)`` (or a one-row global aggregate) plus exact
    quantile columns of ``value``.

    The count, min and max the quantiles need come from the same aggregate
    pass as the caller's ``aggs``, so small groups cost that pass and one
    bounded ranking pass.
    """
    by = list(by)
    v = nan_to_null(value)
    stat_cols = [F.count(v).alias("_n"), F.min(v).alias("_lo"), F.max(v).alias("_hi")]
    values = df.select(*by, v.alias("_v")).filter(F.col("_v").isNotNull())
    if not by:
        full = df.agg(*aggs, *stat_cols).checkpoint(eager=True)
        n, lo, hi = full.select("_n", "_lo", "_hi").first()
        qs = _global_quantiles(values, n, lo, hi, probs, buckets, final_rows, materialize)
        return full.drop("_n", "_lo", "_hi").withColumns(
            {name: F.lit(q).cast("double") for name, q in zip(names, qs)})
    full = df.groupBy(*by).agg(*aggs, *stat_cols).checkpoint(eager=True)
    stats = full.filter(F.col("_n") > 0).select(*by, "_n", "_lo", "_hi")
    q = _quantiles(values, stats, by, probs, names, buckets, final_rows, materialize)
    return _join(full, q, by, "left").drop("_n", "_lo", "_hi")
