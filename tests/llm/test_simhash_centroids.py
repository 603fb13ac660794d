"""SimHash near-duplicates and centroid clustering against brute force."""

import hashlib
import itertools
import math
import random

import duckdb
import numpy as np
import pytest
import regex
import xxhash

from tabready.llm import centroid_search, simhash
from tabready.llm.centroid_search import cluster_vectors, coefficients, hadamard, integers, moved, nearest
from tabready.llm.common import ship
from tabready.llm.components import connected_components
from tabready.llm.simhash import counts_here, fingerprint, forest, keys_of, link_fingerprints, links, near_duplicates
from tests.llm.helpers import awkward_texts, sentence, table


def plain_fingerprint(text):
    words = regex.findall(r"[^\x20\x09-\x0D]+", regex.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def plain_components(fps):
    """The least index that each fingerprint reaches."""
    distinct = list(dict.fromkeys(fps))
    up = {f: f for f in distinct}

    def top(f):
        while up[f] != f:
            f = up[f]
        return f

    for a, b in itertools.combinations(distinct, 2):
        if (a ^ b).bit_count() <= 3:
            up[top(a)] = top(b)
    return [top(f) for f in fps]


def near_values(rng, n, centre_flips=6):
    """Fingerprints in a few dense balls, chains and single ones."""
    out = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(n):
            f = centre
            for _ in range(rng.randrange(centre_flips)):
                f ^= 1 << rng.randrange(64)
            out.add(f)
    # many that share a segment
    low = rng.getrandbits(32)
    for _ in range(n):
        out.add(rng.getrandbits(32) << 32 | low ^ (1 << rng.randrange(32) if rng.random() < 0.3 else 0))
        out.add((rng.getrandbits(12) << 32 + rng.choice([0, 8, 20])) | low)
    return sorted(out)


def plain_edges(fps):
    return {(a, b) for a, b in itertools.combinations(fps, 2) if (a ^ b).bit_count() <= 3}


@pytest.mark.parametrize("text", [*awkward_texts(), "a b", "A b\x0bC\x0cd É ", "x" * 100 + " " + "y z " * 70_000, "a b c d e f", "A\x1cb c d"])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("hot", [None, 20])
def test_each_pair_counts_in_one_group(hot):
    fps = np.array(near_values(random.Random(1), 35), np.uint64)
    values = [(s << 32) | (int(f) >> 32 * s & 0xFFFFFFFF) for f in fps for s in (0, 1)]
    crowded = np.array(sorted({v for v in values if hot and values.count(v) > hot}), np.uint64)
    assert bool(len(crowded)) == bool(hot)
    found = []
    rows = list(zip(*(np.concatenate(x) for x in zip(*keys_of(fps, crowded)))))
    rows.sort()
    for key, group in itertools.groupby(rows, key=lambda r: r[0]):
        found += [(int(a), int(b)) for (_, a), (_, b) in itertools.combinations(list(group), 2) if counts_here(key, a, b)]
    assert len(found) == len(set(found))
    assert set(found) == plain_edges([int(f) for f in fps])


@pytest.mark.parametrize("short, full, hot, n", [(24, 2048, 0, 150), (2, 2048, 0, 100), (2, 8, 0, 14), (3, 12, 15, 30), (2, 4, 5, 12)])
def test_links_keep_components(monkeypatch, short, full, hot, n):
    monkeypatch.setattr(simhash, "SHORT", short)
    monkeypatch.setattr(simhash, "FULL", full)
    fps = near_values(random.Random(2), n)
    values = [(s << 32) | (f >> 32 * s & 0xFFFFFFFF) for f in fps for s in (0, 1)]
    crowded = np.array(sorted({v for v in values if hot and values.count(v) > hot}), np.uint64)
    key, fp = (np.concatenate(x) for x in zip(*keys_of(np.array(fps, np.uint64), crowded)))
    order = np.argsort(key, kind="stable")
    a, b = links(key[order], fp[order])
    at = {f: i for i, f in enumerate(fps)}
    i, j = (np.array([at[int(x)] for x in side], np.int64) for side in (a, b))
    label = np.arange(len(fps))
    node, least = forest(len(fps), i, j)
    label[node] = least
    want = plain_components(fps)
    assert len({(int(x), y) for x, y in zip(label, want)}) == len(set(want)) == len(set(label.tolist()))


@pytest.mark.parametrize("hot", [None, 10])
def test_linked_fingerprints_on_spark(spark, hot):
    ship(spark)
    fps = near_values(random.Random(3), 80)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long").repartition(5)
    got = {r.node: r.component for r in connected_components(link_fingerprints(df, hot)).collect()}
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    assert len({(got.get(f, f), c) for f, c in zip(signed, plain_components(fps))}) == len(set(plain_components(fps)))


def check(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    fps = [plain_fingerprint(t) for _, t in rows]
    tops, least = plain_components(fps), {}
    for (i, _), top in zip(rows, tops):
        if i is not None:
            least[top] = min(least.get(top, i), i)
    want = [(i, f"{f:016x}", least.get(top)) for (i, _), f, top in zip(rows, fps, tops)]
    out = near_duplicates(df)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    return want


def test_near_duplicates(spark):
    rng = random.Random(9)
    words = [f"{a}{b}{c}" for a in "bdfgkl" for b in "aeiou" for c in "nrst"]
    base = [sentence(rng, 400, words).split() for _ in range(5)]
    texts = awkward_texts()
    for b in base:
        for _ in range(12):
            edited = list(b)
            edited[rng.randrange(len(b))] = rng.choice(words)
            texts.append(" ".join(edited))
    want = check(table(spark, texts))
    assert len({c for *_, c in want}) < len({f for _, f, _ in want})  # links between different fingerprints


def test_whole_table_and_empty_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))
    assert near_duplicates(table(spark, [])).collect() == []


# --- centroids


def plain_clusters(rows, k=16, rounds=3):
    """``rows``: (vec_id, components).  By definition, in Python's integers."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(near(v)[1], []).append(v)
        centroids = [[sum(x) // len(own[n]) for x in zip(*own[n])] if n in own else c for n, c in enumerate(centroids)]
    out = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    total = {n: sum(d for _, m, d in out if m == n) for n in {m for _, m, _ in out}}
    fits = lambda x: x if x < 1 << 63 else None
    beyond = any(d >= 1 << 63 for *_, d in out)
    return [(i, n, fits(d), None if any(e >= 1 << 63 for _, m, e in out if m == n) else fits(total[n]),
             None if beyond else fits(sum(total.values())),
             hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for i, n, d in out]


def vectors(spark, rows, kind="float"):
    ship(spark)
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    for name in ("vector", "cluster", "distance", "name", "dim"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def same(got, rows):
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain_clusters(rows)))


def test_transform():
    x = np.random.default_rng(1).integers(-1000, 1000, (5, 64))
    y = hadamard(x)
    assert (hadamard(y) == 64 * x).all() and ((y ** 2).sum(1) == 64 * (x ** 2).sum(1)).all()
    changes = [(np.diff(np.sign(r)) != 0).sum() for r in coefficients(np.eye(64, dtype=np.int64)).T]
    assert changes == list(range(64))


@pytest.mark.parametrize("scale", [5, 1 << 22, 1 << 40])
def test_nearest_is_exact(scale):
    rng = np.random.default_rng(2)
    x = rng.integers(-scale, scale, (300, 64))
    c = np.concatenate([x[:7], x[:3], rng.integers(-scale, scale, (6, 64))])
    x = np.concatenate([x, np.zeros((2, 64), np.int64)])
    number, distance = nearest(x, c.tolist())
    for v, n, d in zip(x.tolist(), number, distance):
        assert min((sum((a - b) ** 2 for a, b in zip(v, w)), m) for m, w in enumerate(c.tolist())) == (d, n)


def test_clusters_by_definition(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(i % 5, 0.3) for _ in range(64)]) for i in range(150)]
    rows = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    rows += [rows[3], (3, rows[8][1]), (None, rows[9][1]), (500, [0.0] * 64), (501, [-0.0] * 64), (502, [1.0] * 63),
             (503, None), (504, [None] * 64), (505, [float("nan")] + [0.0] * 63), (506, [float("-inf")] * 64), (507, [])]
    same(cluster_vectors(vectors(spark, rows).repartition(4)), rows)


def test_large_components_stay_exact(spark):
    rows = [(i, [float((-1) ** d * (i + 1) * 10.0 ** (i % 20)) for d in range(64)]) for i in range(40)]
    same(cluster_vectors(vectors(spark, rows, "double")), rows)
    assert integers(np.array([1e308, -1e308] * 32))[0, 1] == -int(1e308) * 64
    assert moved(vectors(spark, [(1, [3e38] * 64), (2, [1e38] * 64)]).selectExpr("CAST(embedding AS array<double>) AS vector"),
                 [[0] * 64])[0][0] == (int(float(np.float32(3e38))) * 64 + int(float(np.float32(1e38))) * 64) // 2


def test_few_and_no_vectors(spark):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    same(cluster_vectors(vectors(spark, rows)), rows)
    assert cluster_vectors(vectors(spark, [(1, [1.0])])).collect() == []
    assert cluster_vectors(vectors(spark, [])).collect() == []


def test_sql_twin(spark):
    path = "/root/testdata/sf0.001/embeddings.parquet"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    want = con.sql(centroid_search.oracle()).fetchall()
    got = cluster_vectors(spark.read.parquet(path))
    assert got.columns == [d[0] for d in con.sql(centroid_search.oracle()).description]
    assert sorted(map(tuple, got.collect())) == sorted(want)
