"""Centroid clustering by progressive search over Walsh-Hadamard coefficients.

A vector of 64 components becomes integers, floor(64 x), and goes through an
exact integer transform, ordered from coarse to fine (by sign changes).  Squared
differences of coefficients sum to 64 times the squared distance, so a partial
sum is a bound from below.  The centroid that leads after the first few
coefficients is finished at once; then the others are followed from coarse to
fine, and one whose partial sum is strictly worse than the leader's whole
distance is given up.  What survives is finished over all 64 coefficients, so
the nearest centroid, and the smallest number among equals, is exact.

Each round is one pass: a task sends its sums by cluster and component (at most
16 x 64 rows whatever it has read), Spark merges them, and the driver holds the
16 centroids only.

Defined results: vectors that are null, have another length, or hold a null or
non-finite component are left out.  Integers are exact at any size; a squared
distance beyond a long is null, and so are the sums that hold it.  Rows with
equal ids stay apart; among equal hashes the smaller vector starts first, rows
without an id come last.  With fewer than 16 kept vectors there are as many
centroids; without any the result is empty.  Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabready.llm.common import releasing, written

DIMS = 64
#: Integers up to this size are transformed and squared within 64 bits.
SMALL = 1 << 24
#: Sums travel in parts of so many bits.
PART_BITS = 48


def _sign_changes(size: int) -> np.ndarray:
    """Of each row of the Hadamard matrix in natural order."""
    rows = hadamard(np.eye(size, dtype=np.int64))
    return (rows[:, 1:] != rows[:, :-1]).sum(axis=1)


def hadamard(x: np.ndarray) -> np.ndarray:
    """The transform of each row, in natural order, by sums and differences."""
    n, size = x.shape
    half = 1
    while half < size:
        x = x.reshape(n, size // (2 * half), 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        half *= 2
        x = x.reshape(n, size)
    return x


COARSE_TO_FINE = np.argsort(_sign_changes(DIMS), kind="stable")
#: Coefficients are added in these steps; the first gives the leader.
STEPS = [(0, 4), (4, 8), (8, 16), (16, 32), (32, 64)]


def coefficients(x: np.ndarray) -> np.ndarray:
    return hadamard(x)[:, COARSE_TO_FINE]


def integers(flat: np.ndarray) -> np.ndarray:
    """floor(64 x) as exact integers: 64-bit if all are small, else Python's."""
    with np.errstate(over="ignore"):
        scaled = np.floor(flat.astype(np.float64) * 64)
    if not np.isfinite(scaled).all():  # 64 x beyond a double
        return np.array([int(x) * 64 for x in flat.tolist()], object).reshape(-1, DIMS)
    if len(scaled) and np.abs(scaled).max() > SMALL:
        return np.array([int(x) for x in scaled.tolist()], object).reshape(-1, DIMS)
    return scaled.astype(np.int64).reshape(-1, DIMS)


def nearest(vectors: np.ndarray, centroids: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid."""
    wide = vectors.dtype == object or any(abs(v) > SMALL for c in centroids for v in c)
    kind = object if wide else np.int64
    x, c = coefficients(vectors.astype(kind)), coefficients(np.array(centroids, kind).reshape(-1, DIMS))
    lo, hi = STEPS[0]
    part = ((x[:, None, lo:hi] - c[None, :, lo:hi]) ** 2).sum(axis=2)
    leader = part.argmin(axis=1)
    best = ((x - c[leader]) ** 2).sum(axis=1)
    row, number = np.nonzero((part <= best[:, None]).astype(bool))
    part = part[row, number]
    for lo, hi in STEPS[1:]:
        part = part + ((x[row, lo:hi] - c[number, lo:hi]) ** 2).sum(axis=1)
        alive = (part <= best[row]).astype(bool)
        row, number, part = row[alive], number[alive], part[alive]
    # survivors stand in order of row and number: the first with the least sum wins
    starts = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else row
    least = np.minimum.reduceat(part, starts) if len(row) else part
    winners = np.flatnonzero((part == least[row]).astype(bool))
    first = winners[np.flatnonzero(np.append(True, row[winners][1:] != row[winners][:-1]))] if len(row) else winners
    return number[first], part[first] // DIMS


def _matrix(column: pa.Array) -> np.ndarray:
    return integers(column.flatten().to_numpy(zero_copy_only=False))


def kept_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, vector``: vectors of 64 finite components, as doubles."""
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
            .where((F.size("vector") == DIMS) & whole))


def first_centroids(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors of the smallest hashes of ``seed:vec_id``, in their order."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select(name.alias("name"), "vector").orderBy(F.col("name").asc_nulls_last(), "vector").limit(k).collect()
    return [integers(np.array(r["vector"]))[0].tolist() for r in rows]


def _parts(total: int) -> Iterator[tuple[int, int]]:
    """The parts of an integer that are not 0, each with its sign."""
    sign, left, at = (-1 if total < 0 else 1), abs(total), 0
    while left:
        if left & ((1 << PART_BITS) - 1):
            yield at, sign * (left & ((1 << PART_BITS) - 1))
        left >>= PART_BITS
        at += 1


def moved(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: every vector goes to its nearest centroid, which becomes the
    floor of its vectors' mean; a centroid without vectors stays."""

    @releasing
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = [0] * len(centroids), [[0] * DIMS for _ in centroids]
        for batch in batches:
            vectors = _matrix(batch.column("vector"))
            number, _ = nearest(vectors, centroids)
            for c in set(number.tolist()):
                own = vectors[number == c]
                count[c] += len(own)
                total[c] = [t + int(s) for t, s in zip(total[c], own.sum(axis=0).tolist())]
        rows = [(c, -1, 0, n) for c, n in enumerate(count) if n]
        rows += [(c, d, at, part) for c, sums_ in enumerate(total) for d, t in enumerate(sums_) for at, part in _parts(t)]
        yield pa.RecordBatch.from_pylist([dict(zip(("cluster", "dim", "part", "total"), r)) for r in rows],
                                         pa.schema([("cluster", pa.int32()), ("dim", pa.int32()), ("part", pa.int32()), ("total", pa.int64())]))

    merged = (kept.select("vector").mapInArrow(sums, "cluster int, dim int, part int, total long")
              .groupBy("cluster", "dim", "part").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
    count, total = {}, {}
    for r in merged.collect():  # at most 16 x 65 rows and their parts
        if r["dim"] < 0:
            count[r["cluster"]] = int(r["total"])
        else:
            total[r["cluster"], r["dim"]] = total.get((r["cluster"], r["dim"]), 0) + (int(r["total"]) << (PART_BITS * r["part"]))
    return [[total.get((c, d), 0) // count[c] for d in range(DIMS)] if c in count else old for c, old in enumerate(centroids)]


def cluster_vectors(table: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``,
    one row per kept vector."""
    spark, kept = table.sparkSession, kept_vectors(table, id_col, vector_col)
    centroids = first_centroids(kept, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(kept, centroids)

    @releasing
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, distance = nearest(_matrix(batch.column("vector")), centroids)
            fits = [int(d) if d < 1 << 63 else None for d in distance.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number, pa.int32()), pa.array(fits, pa.int64())],
                                             ["vec_id", "cluster", "distance"])

    assigned = written(kept.mapInArrow(assign, "vec_id long, cluster int, distance long"), "clusters")
    rows = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"),
                                           F.count_if(F.col("distance").isNull()).alias("beyond")).collect()
    own = {r["cluster"]: None if r["beyond"] else int(r["d"]) for r in rows}
    every = None if None in own.values() else sum(own.values())
    fits = lambda x: x if x is not None and x < 1 << 63 else None
    facts = [(c, fits(d), fits(every), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, d in own.items()]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = 16, rounds: int = 3, seed: int = 1) -> str:
    """The same result in DuckDB's SQL."""
    near = """a{i} AS MATERIALIZED (
            SELECT r, any_value(vec_id) AS vec_id, any_value(k.v) AS v, min({{'d': list_sum(list_transform(
                     range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i]))), 'c': c}}) AS best
            FROM kept k, c{i} c GROUP BY r)"""
    move = """c{j} AS MATERIALIZED (
            SELECT c{i}.c, coalesce(m.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
                SELECT c, list(q ORDER BY i) AS v FROM (
                    SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS q FROM (
                        SELECT best.c AS c, i, sum(v[i]) AS s, count(*) AS n FROM a{i}, range(1, 65) t(i) GROUP BY 1, 2))
                GROUP BY c) m ON m.c = c{i}.c)"""
    steps = []
    for i in range(rounds):
        steps += [near.format(i=i), move.format(i=i, j=i + 1)]
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
            FROM embeddings WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {DIMS}),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c, v FROM kept
            ORDER BY sha256('{seed}:' || vec_id) LIMIT {k}),
        {", ".join(steps)}, {near.format(i=rounds)}
        SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
               CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = best.c"""
