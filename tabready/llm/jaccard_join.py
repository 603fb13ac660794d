"""N-gram Jaccard join by chosen paths.

Every text becomes its set of hashed five-word shingles.  Equal sets are joined
at once and go on as one row with a number of copies.  The join then splits the
sets recursively: at each node of the recursion some coordinates of the minwise
signature are sampled (each with probability 1 / (threshold * coordinates)), and
a set moves on to one child per sampled coordinate, named by the shared token
that is its minimum there.  Nodes of at most ``LEAF`` sets are compared pair by
pair on byte sketches.  ``RUNS`` independent recursions reach ``TARGET_RECALL``
for pairs at the threshold at the greatest depth, and more for closer ones.

A larger node is looked at before it splits: its sets are compared with three of
them, and the one that most are alike is its pivot.  Where few sets are unlike
the pivot (``BLOCK`` at most) the node ends here: alike sets link through the
pivot, and those unlike it are compared with all.  So a group of near copies ends
where it first meets and isn't carried through the levels.  Other nodes split; at
the last depth they end in the same way.

All that grows from a node stays among its sets, so one task takes the whole
recursion below a node of at most ``LOCAL`` sets and returns spanning edges only.
Nodes beyond that are compared, split and ended by joins, in blocks.

Sketches only propose.  Proposed edges give components; the shingles of each
component's sets are gathered once and all of its pairs are counted exactly
(blocks of ``BLOCK`` sets for large components).  No pair is emitted on the way:
tasks return one row per set with its number of links and one spanning edge.

Defined results: words are lower-cased and separated by white space; a text of
fewer than five words is one shingle; null and empty texts have no set, are a
class of their own and link to nothing; repeated rows are copies of each other;
a class is named by its smallest non-null id; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabready.llm.common import releasing, row_key, small_batches, written
from tabready.llm.components import connected_components

WORDS, THRESHOLD = 5, 0.8
COORDINATES, DEPTH, LEAF, BLOCK = 128, 4, 48, 512
#: Sets of a node whose recursion one task takes: 5 MB of signatures, and some
#: seconds where all are compared with all at the last depth.
LOCAL = 8192
#: Sets of a large node that are tried as its pivot, and the nodes whose pivots
#: may be broadcast (under 10 MB); more are joined.
PIVOTS, BROADCAST_NODES = 3, 20_000
#: About so many sets of a large node tell whether it is worth comparing all of
#: them with the pivot; a node that isn't splits, so nothing hangs on the sample.
SAMPLE = 64
TARGET_RECALL = 0.999
#: A sketch estimate this far under the threshold (about three deviations) still proposes.
MARGIN = 0.11
#: Keys of proposed sets that may be broadcast to the second scan; more are joined.
BROADCAST_KEYS = 500_000

_RNG = np.random.default_rng(20240607)
A = (_RNG.integers(0, 1 << 31, COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[None, :]
B = _RNG.integers(0, 1 << 32, COORDINATES, dtype=np.uint32)[None, :]
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def runs_for(threshold: float = THRESHOLD, depth: int = DEPTH, recall: float = TARGET_RECALL) -> int:
    """Recursions needed until a pair at the threshold survives one of them to
    ``depth`` with probability ``recall``.  The sampled coordinates in which it
    agrees are Poisson with mean 1 at each node."""
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-alive)
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


class Shingler:
    """Shingle sets of texts; word hashes are kept for a bounded number of words."""

    def __init__(self, kept: int = 200_000):
        self.kept, self.words = kept, {}

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit shingle hashes."""
        words = (text or "").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(words) < WORDS:
            return np.array([xxhash.xxh3_64_intdigest(" ".join(words), 1)], np.uint64)
        get, known = self.words.get, self.words
        codes = [get(w) for w in words]
        if None in codes:
            if len(known) > self.kept:
                known.clear()
            for i, c in enumerate(codes):
                if c is None:
                    codes[i] = known[words[i]] = xxhash.xxh3_64_intdigest(words[i])
        code = np.array(codes, np.uint64)
        n = len(code) - WORDS + 1
        total = np.zeros(n, np.uint64)
        for k in range(WORDS):
            total = total * np.uint64(0x9E3779B97F4A7C15) + code[k:k + n]
        return np.unique(mixed(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minwise signature of a set that is not empty."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)[:, None]
    out = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(x), 256):
        np.minimum(out, (x[lo:lo + 256] * A + B).min(0), out)
    return out


def set_id(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sampled(node: int) -> np.ndarray:
    """The coordinates that a node of the recursion splits by."""
    draws = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(node))
    return np.flatnonzero(draws < np.uint64(int(2.0 ** 64 / (THRESHOLD * COORDINATES))))


def children(node: int, signatures: np.ndarray) -> np.ndarray:
    """The children (columns) of ``node`` that each signature (row) moves to."""
    at = sampled(node)
    salt = np.uint64((node * 0x2545F4914F6CDD1D + 1) & 0xFFFFFFFFFFFFFFFF)
    return mixed(mixed(signatures[:, at].astype(np.uint64) << np.uint64(8) | at.astype(np.uint64)) ^ salt)


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of sketches, row by row."""
    # eight coordinates are counted in the bytes of one word, none beyond 16
    words = np.add.reduce((a == b).view(np.uint64), axis=-1)
    return (words * np.uint64(0x0101010101010101) >> np.uint64(56)) / COORDINATES


def sketches(signatures: np.ndarray) -> np.ndarray:
    """The low byte of every signature coordinate."""
    return np.ascontiguousarray(signatures.view(np.uint8)[:, ::4])


def _rows(column) -> np.ndarray:
    """Fixed-size binary values as the rows of a byte matrix."""
    values = column.tolist()
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1) if values else np.zeros((0, COORDINATES), np.uint8)


def _spanning(near: np.ndarray) -> np.ndarray:
    """The least member of each one's component, from a symmetric matrix."""
    label = np.arange(len(near))
    while True:
        new = np.where(near, label[None, :], len(near)).min(1)
        new = np.minimum(new, label)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def leaf_pairs(sketch: np.ndarray, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of alike sets in each leaf: rows ``lo`` to ``lo + size``."""
    pairs = lo[size == 2]
    pairs = pairs[alike(sketch[pairs], sketch[pairs + 1]) >= THRESHOLD - MARGIN]
    a, b = [pairs], [pairs + 1]
    for first, n in zip(lo[size > 2], size[size > 2]):
        own = sketch[first:first + n]
        label = _spanning(alike(own[:, None, :], own[None, :, :]) >= THRESHOLD - MARGIN)
        joined = np.flatnonzero(label != np.arange(n))
        a.append(first + label[joined])
        b.append(first + joined)
    return np.concatenate(a), np.concatenate(b)


def star_pairs(sketch: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of all pairs of alike sets that hold one of the ``centres``."""
    label = np.arange(len(sketch))
    a, b = [], []
    for k in centres:
        near = np.flatnonzero(alike(sketch, sketch[k]) >= THRESHOLD - MARGIN)
        met, first = np.unique(label[near], return_index=True)
        if len(met) > 1:
            other = met != label[k]
            a.append(np.full(other.sum(), k))
            b.append(near[first[other]])
            label[np.isin(label, met)] = met[0]
    return tuple(np.concatenate(x) if x else np.empty(0, int) for x in (a, b))


def recursed(node: int, sid: np.ndarray, signatures: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges (as row numbers) of alike sets that meet in ``node`` or, of
    ``levels`` below it, in a leaf or a node that ends."""
    sketch = sketches(signatures)
    names = np.array([int.from_bytes(x[:8], "little") for x in sid], np.uint64)
    # drawn by name, so that nodes of the same sets have the same pivots and their edges are equal
    draws = [mixed(names ^ np.uint64(k + 1)) for k in range(PIVOTS)]
    a, b, open_nodes = [], [], [(node, np.arange(len(sid)), levels)]
    while open_nodes:
        node, own, levels = open_nodes.pop()
        tried = [own[d[own].argmin()] for d in draws]
        close = [alike(sketch[own], sketch[p]) >= THRESHOLD - MARGIN for p in tried]
        best = max(range(PIVOTS), key=lambda k: close[k].sum())
        odd = np.flatnonzero(~close[best])
        if len(odd) <= BLOCK or not levels:
            x, y = star_pairs(sketch[own], np.concatenate([np.flatnonzero(own == tried[best]), odd]))
            a.append(own[x])
            b.append(own[y])
            continue
        kids = children(node, signatures[own])
        at, kid = np.repeat(own, kids.shape[1]), kids.ravel()
        order = np.argsort(kid, kind="stable")
        at, kid = at[order], kid[order]
        lo = np.concatenate([[0], np.flatnonzero(kid[1:] != kid[:-1]) + 1]) if len(kid) else np.empty(0, int)
        size = np.diff(np.append(lo, len(kid)))
        leaf = (size > 1) & (size <= LEAF)
        x, y = leaf_pairs(sketch[at], lo[leaf], size[leaf])
        a.append(at[x])
        b.append(at[y])
        open_nodes += [(int(kid[i]), at[i:i + n], levels - 1) for i, n in zip(lo[size > LEAF], size[size > LEAF])]
    return np.concatenate(a), np.concatenate(b)


def grouped(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of rows that come sorted by ``keys``: many small groups at a
    time, none divided between two results."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = np.ones(len(batch), bool)
        for k in keys:
            last &= (batch[k] == batch[k].iloc[-1]).to_numpy()
        cut = len(batch) - int(last[::-1].cumprod().sum())
        held.append(batch)
        if cut:
            whole = pd.concat(held, ignore_index=True) if len(held) > 1 else batch
            cut += len(whole) - len(batch)
            yield whole.iloc[:cut].reset_index(drop=True)
            held = [whole.iloc[cut:].reset_index(drop=True)]
    if held:
        yield pd.concat(held, ignore_index=True)


def _bounds(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    new = np.zeros(len(frame), bool)
    for k in keys:
        v = frame[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.concatenate([[0], np.flatnonzero(new), [len(frame)]])


# -- steps ----------------------------------------------------------------
def shingle_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, key, sid, sig``: each row's set name and signature (null without words)."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for texts in batches:
            rows = []
            for t in texts:
                s = shingler(t)
                rows.append((set_id(s), signature(s).tobytes()) if len(s) else (None, None))
            yield pd.DataFrame(rows, columns=["sid", "sig"])

    made = F.pandas_udf(releasing(run), "sid binary, sig binary")(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), F.unhex(row_key(id_col, text_col)).alias("key"), made.alias("s")).select("doc_id", "key", "s.*")


def split_nodes(rows: DataFrame) -> DataFrame:
    """One level down: ``node, sid, sig`` to the children's."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            signatures = _rows(batch["sig"]).view("<u4")
            order = np.argsort(batch["node"].to_numpy(), kind="stable")
            bounds = _bounds(batch.iloc[order], ["node"])
            at, nodes = [], []
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                own = order[lo:hi]
                kids = children(int(batch["node"].iloc[own[0]]) & 0xFFFFFFFFFFFFFFFF, signatures[own])
                at.append(np.repeat(own, kids.shape[1]))
                nodes.append(kids.ravel().view(np.int64))
            at = np.concatenate(at) if at else np.empty(0, int)
            out = batch.iloc[at][["sid", "sig"]].reset_index(drop=True)
            out.insert(0, "node", np.concatenate(nodes) if nodes else np.empty(0, np.int64))
            yield out

    return rows.select("node", "sid", "sig").mapInPandas(releasing(run), "node long, sid binary, sig binary")


def first_nodes(sets: DataFrame, runs: int) -> DataFrame:
    """``node, sid``: the children of the roots of all runs.  Signatures stay
    behind: most nodes hold one set and end here."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            signatures = _rows(batch).view("<u4")
            kids = np.concatenate([children(int(mixed(np.array([r + 1], np.uint64))[0]), signatures) for r in range(runs)], axis=1)
            yield pd.Series(list(kids.view(np.int64)), dtype="object")

    nodes = F.pandas_udf(releasing(run), "array<long>")(F.col("sig"))
    return sets.select(F.explode(nodes).alias("node"), "sid")


def sketch_edges(leaves: DataFrame) -> DataFrame:
    """Spanning edges ``a, b`` between alike sets of each leaf (``node, sid, sketch``)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in grouped(batches, ["node"]):
            sketch, sid = _rows(frame["sketch"]), frame["sid"].to_numpy()
            bounds = _bounds(frame, ["node"])
            a, b = leaf_pairs(sketch, bounds[:-1], np.diff(bounds))
            yield pd.DataFrame({"a": sid[a], "b": sid[b]})

    return (leaves.repartition("node").sortWithinPartitions("node").select("node", "sid", "sketch")
            .mapInPandas(releasing(run), "a binary, b binary"))


def local_edges(rows: DataFrame, levels: int) -> DataFrame:
    """Edges ``a, b`` of nodes (``node, sid, sig``) of at most ``LOCAL`` sets, with
    ``levels`` below them, each recursed in one task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in grouped(batches, ["node"]):
            bounds, sid = _bounds(frame, ["node"]), frame["sid"].to_numpy()
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                signatures = _rows(frame["sig"].iloc[lo:hi]).view("<u4")
                a, b = recursed(int(frame["node"].iloc[lo]) & 0xFFFFFFFFFFFFFFFF, sid[lo:hi], signatures, levels)
                yield pd.DataFrame({"a": sid[lo + a], "b": sid[lo + b]})

    return (rows.repartition("node").sortWithinPartitions("node").select("node", "sid", "sig")
            .mapInPandas(releasing(run), "a binary, b binary"))


def marked(rows: DataFrame, pivots: list[Column]) -> DataFrame:
    """Add ``m``: bit k says whether a set's sketch is like the k-th pivot's."""
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for x, *others in batches:
            own = _rows(x)
            near = [alike(own, _rows(y)) >= THRESHOLD - MARGIN for y in others]
            yield pd.Series(sum(n.astype(np.int32) << k for k, n in enumerate(near)), dtype="int32")

    return rows.withColumn("m", F.pandas_udf(releasing(run), "int")("sketch", *pivots))


def node_pivots(rows: DataFrame) -> DataFrame:
    """``node, pivot, sketch, share`` of large nodes (``node, sid, sketch, n``): of
    three sets, drawn by a hash of the set (so that nodes of the same sets have the
    same pivots, and their edges are equal), the one that most of a sample of the
    node are alike, and their share of the sample."""
    draw = lambda k: F.min(F.struct(F.xxhash64(F.lit(k), "sid").alias("_h"), "sid", "sketch"))
    drawn = rows.groupBy("node").agg(*[draw(k).alias(f"p{k}") for k in range(PIVOTS)])
    sample = rows.where(F.pmod(F.xxhash64(F.lit(PIVOTS), "node", "sid"), F.col("n")) < SAMPLE)
    seen = marked(sample.join(drawn, "node"), [F.col(f"p{k}.sketch") for k in range(PIVOTS)])
    share = lambda k: F.avg(F.shiftright("m", k).bitwiseAND(F.lit(1)))
    best = seen.groupBy("node").agg(F.any_value(F.struct(*[f"p{k}" for k in range(PIVOTS)])).alias("p"),
                                    F.greatest(*[F.struct(share(k).alias("share"), F.lit(k).alias("k")) for k in range(PIVOTS)]).alias("b"))
    own = F.element_at(F.array(*[F.col(f"p.p{k}") for k in range(PIVOTS)]), F.col("b.k") + 1)
    return best.select("node", own["sid"].alias("pivot"), own["sketch"].alias("pivot_sketch"), F.col("b.share").alias("share"))


def scored_nodes(rows: DataFrame, all_nodes: bool = True) -> DataFrame:
    """``node, sid, sketch, n, pivot, close, r`` of large nodes (``node, sid, sketch,
    n``): whether a set is like the pivot, and the number of sets that are not.
    Without ``all_nodes`` those are left out whose sample says that more than twice
    ``BLOCK`` sets are unlike the pivot."""
    pivots = written(node_pivots(rows), "jaccard-drawn")
    small = pivots.count() <= BROADCAST_NODES
    both = rows.join(F.broadcast(pivots) if small else pivots, "node")
    if not all_nodes:
        both = both.where((1 - F.col("share")) * F.col("n") <= 2 * BLOCK)
    # rows are dealt evenly before they are compared: a node may be most of a file
    even = both.select("node", "sid", "sketch", "n", "pivot", "pivot_sketch").repartition(
        int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    near = written(marked(even, [F.col("pivot_sketch")]).select("node", "sid", "sketch", "n", "pivot", (F.col("m") == 1).alias("close")), "jaccard-marks")
    unlike = near.groupBy("node").agg(F.count_if(~F.col("close")).alias("r"))
    return written(near.join(F.broadcast(unlike) if small else unlike, "node"), "jaccard-pivots", near, pivots)


def pivot_edges(rows: DataFrame) -> DataFrame:
    """Edges of large nodes (``node, sid, sketch``) that end here."""
    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    return ended_edges(scored_nodes(rows.drop("n").join(sizes, "node")))


def ended_edges(scored: DataFrame) -> DataFrame:
    """Edges of scored nodes: all sets against the node's pivot, then those
    unlike it against all, in blocks."""
    close = F.col("close")
    stars = scored.where(close & (F.col("sid") != F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("sid").alias("b"))
    odd, several = scored.where(~close), scored.where("r > 0")
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    at = lambda n: F.pmod(F.xxhash64("sid"), n).cast("int")
    left = (odd.withColumn("i", at(blocks("r")))
            .select("node", "sid", "sketch", "i", F.explode(F.sequence(F.lit(0), blocks("n") - 1)).alias("j"), F.lit(0).alias("side")))
    right = (several.withColumn("j", at(blocks("n")))
             .select("node", "sid", "sketch", F.explode(F.sequence(F.lit(0), blocks("r") - 1)).alias("i"), "j", F.when(close, 1).otherwise(2).alias("side")))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in grouped(batches, ["node", "i", "j"]):
            sketch, sid, side = _rows(frame["sketch"]), frame["sid"].to_numpy(), frame["side"].to_numpy()
            bounds = _bounds(frame, ["node", "i", "j"])
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                odds, joined, others = (lo + np.flatnonzero(side[lo:hi] == k) for k in (0, 1, 2))
                near = np.array([alike(sketch[joined], sketch[k]) for k in odds]).reshape(len(odds), len(joined)) >= THRESHOLD - MARGIN
                # the pivot has joined that side already: one edge does
                some = near.any(1) if len(joined) else np.zeros(len(odds), bool)
                a, b = [sid[joined[near.argmax(1)[some]]] if some.any() else sid[:0]], [sid[odds[some]]]
                both = np.concatenate([odds, others])
                full = np.zeros((len(both), len(both)), bool)
                for n, k in enumerate(odds):
                    full[n, len(odds):] = alike(sketch[others], sketch[k]) >= THRESHOLD - MARGIN
                full |= full.T
                label = _spanning(full)
                moved = np.flatnonzero(label != np.arange(len(both)))
                a.append(sid[both[label[moved]]])
                b.append(sid[both[moved]])
                yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    rest = left.unionByName(right)
    keys = ["node", "i", "j"]
    found = rest.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(releasing(compare), "a binary, b binary")
    return stars.unionByName(found)


def contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges ``a, b`` with the same components.  A set of a large group is
    joined to a pivot in every node that the two meet in, each time maybe another:
    it keeps the least, and that one is joined to the others, which are few.  Rows
    of one ``b`` are as many as the nodes that it was a member of."""
    least = F.min("a").over(Window.partitionBy("b"))
    led = edges.where("a <> b").select("a", "b", least.alias("m"))
    return led.select(F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b")).distinct()


def proposed_edges(sets: DataFrame, runs: int, depth: int = DEPTH) -> DataFrame:
    """Run the recursion and return spanning edges of alike sets."""
    rows, edges, before = first_nodes(sets, runs), [], []
    for level in range(1, depth + 1):
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        own = rows.join(sizes, "node")
        if level == 1:
            own = own.join(sets.select("sid", "sig"), "sid")
        own = written(own.select("node", "sid", "sig", "n"), f"jaccard-level-{level}", *before)
        found = sketch_edges(with_sketch(own.where(F.col("n") <= LEAF)))
        local = local_edges(own.where((F.col("n") > LEAF) & (F.col("n") <= LOCAL)), depth - level)
        edges.append(written(found.unionByName(local).distinct(), "jaccard-edges"))
        large, before = own.where(F.col("n") > max(LEAF, LOCAL)), [own]
        if large.isEmpty():
            break
        scored = scored_nodes(with_sketch(large), all_nodes=level == depth)
        ended = scored if level == depth else scored.where(F.col("r") <= BLOCK)
        edges.append(written(ended_edges(ended).where("a <> b").distinct(), "jaccard-edges"))
        if level == depth:
            before.append(scored)
            break
        over = written(ended.select("node").distinct(), "jaccard-ended", scored)
        going = written(large.select("node").distinct().join(over, "node", "left_anti"), "jaccard-going", over)
        before.append(going)
        if going.isEmpty():
            break
        # sizes and rows both read it
        rows = written(split_nodes(large.join(going, "node", "left_semi")), "jaccard-split")
        before.append(rows)
    out = edges[0]
    for more in edges[1:]:
        out = out.unionByName(more)
    return written(contracted(out.distinct()), "jaccard-proposed", *edges, *before)


def with_sketch(rows: DataFrame) -> DataFrame:
    """The low byte of every signature coordinate."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([x.tobytes() for x in sketches(_rows(batch))], dtype="object")

    return rows.select("node", "sid", F.pandas_udf(releasing(run), "binary")("sig").alias("sketch"), "n")


def intersections(a: list[np.ndarray], b: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of all intersections of ``a`` with ``b`` (or among ``a``), some
    thousand shingles at a time, from those only that two sets share."""
    both = a if b is None else a + b
    code, place = np.unique(np.concatenate(both), return_inverse=True)
    row = np.repeat(np.arange(len(both)), [len(x) for x in both])
    if b is None:
        shared = np.bincount(place, minlength=len(code)) > 1
    else:
        split = sum(map(len, a))
        shared = np.zeros(len(code), bool)
        shared[place[:split]] = True
        second = np.zeros(len(code), bool)
        second[place[split:]] = True
        shared &= second
    keep = shared[place]
    row, col = row[keep], (np.cumsum(shared) - 1)[place[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((len(a), len(both) - len(a) if b is not None else len(a)), np.float32)
    step = 2048
    for lo in range(0, int(shared.sum()), step):
        i, j = np.searchsorted(col, [lo, lo + step])
        m = np.zeros((len(both), step), np.float32)
        m[row[i:j], col[i:j] - lo] = 1
        out += m @ m.T if b is None else m[:len(a)] @ m[len(a):].T
    if b is None:
        np.fill_diagonal(out, [len(x) for x in a])
    return out


def exact_links(members: DataFrame) -> DataFrame:
    """``sid, root, links, whole`` from ``component, size, sid, copies, shingles``:
    documents linked to a set, and the least set that it reaches in its block
    (``whole`` if the block is its whole component)."""
    n = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = members.withColumn("n", n).withColumn("at", F.pmod(F.xxhash64("sid"), F.col("n")).cast("int"))
    # a set meets every block: as (at, k) where at <= k, else as (k, at)
    tasks = (placed.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
             .withColumn("i", F.least("at", "k")).withColumn("j", F.greatest("at", "k")))
    keys = ["component", "i", "j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in grouped(batches, keys):
            bounds = _bounds(frame, keys)
            out = []
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                part = frame.iloc[lo:hi].drop_duplicates("sid")
                part = part.sort_values("at", kind="stable")
                sets = [np.frombuffer(s, np.uint64) for s in part["shingles"]]
                sid, copies, at = part["sid"].to_numpy(), part["copies"].to_numpy(), part["at"].to_numpy()
                count = np.array([len(s) for s in sets], np.float64)
                near = np.zeros((len(sets), len(sets)), bool)
                first = int((at == at[0]).sum()) if part["i"].iloc[0] != part["j"].iloc[0] else 0
                if not first:
                    inner = intersections(sets)
                    near = inner >= THRESHOLD * (count[:, None] + count[None, :] - inner) - 1e-9
                elif first < len(sets):  # pairs inside a block are counted in its own task
                    inner = intersections(sets[:first], sets[first:])
                    cross = inner >= THRESHOLD * (count[:first, None] + count[None, first:] - inner) - 1e-9
                    near[:first, first:], near[first:, :first] = cross, cross.T
                label = _spanning(near)
                np.fill_diagonal(near, False)
                out.append(pd.DataFrame({"sid": sid, "root": sid[label], "links": near @ copies, "whole": part["n"].to_numpy() == 1}))
            yield pd.concat(out, ignore_index=True)

    return (tasks.select(*keys, "at", "n", "sid", "copies", "shingles").repartition(*keys).sortWithinPartitions(*keys)
            .mapInPandas(releasing(run), "sid binary, root binary, links long, whole boolean"))


def shingles_of(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``sid, shingles`` of the documents with the given ``key``."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for texts in batches:
            for lo in range(0, len(texts), 500):  # a few MB of shingles at a time
                sets = [shingler(t) for t in texts.iloc[lo:lo + 500]]
                yield pd.DataFrame({"sid": [set_id(s) for s in sets], "shingles": [s.tobytes() for s in sets]})

    rows = docs.select(F.unhex(row_key(id_col, text_col)).alias("key"), F.col(text_col).alias("text"))
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    made = F.pandas_udf(releasing(run), "sid binary, shingles binary")(F.col("text"))
    return rows.join(keys, "key", "left_semi").select(made.alias("s")).select("s.*")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = TARGET_RECALL) -> DataFrame:
    """``doc_id, key, class_id, n_links, n_rows``, one row per input row.

    ``class_id`` is the least id of the documents that chains of links reach,
    ``n_links`` the number of other documents at the threshold or above, copies
    included.  ``key`` names equal rows (id and text).
    """
    with small_batches(docs.sparkSession):
        made = written(shingle_table(docs, id_col, text_col), "jaccard-sets")
    sets = written(made.where("sid IS NOT NULL").groupBy("sid").agg(
        F.min("doc_id").alias("rep"), F.min("key").alias("key"), F.count(F.lit(1)).alias("copies"), F.any_value("sig").alias("sig")),
        "jaccard-distinct")
    # signatures are needed of distinct sets, and until edges are proposed
    table = written(made.select("doc_id", "key", "sid"), "jaccard-rows", made)
    edges = proposed_edges(sets, runs_for(recall=recall))
    sets = written(sets.drop("sig"), "jaccard-names", sets)
    parts = written(connected_components(edges).withColumnsRenamed({"node": "sid"}), "jaccard-parts", edges)
    sized = parts.join(parts.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "component")
    known = written(sized.join(sets.select("sid", "key", "rep", "copies"), "sid"), "jaccard-known", parts)
    bodies = shingles_of(docs, known.select("key"), id_col, text_col)
    with small_batches(docs.sparkSession):
        counted = written(exact_links(known.join(bodies, "sid").select("component", "size", "sid", "copies", "shingles")), "jaccard-links")
    links = counted.groupBy("sid").agg(F.sum("links").alias("links"), F.min("root").alias("root"), F.min("whole").alias("whole"))
    across = connected_components(counted.where("NOT whole").select(F.col("sid").alias("a"), F.col("root").alias("b")))
    across = across.select(F.col("node").alias("sid"), F.col("component").alias("joined"))
    named = links.join(across, "sid", "left").select("sid", "links", F.coalesce("joined", "root").alias("class")).join(
        known.select("sid", "rep"), "sid")
    named = written(named, "jaccard-classes", known, counted)
    least = named.groupBy("class").agg(F.min("rep").alias("class_id"))
    result = named.join(least, "class").select("sid", "links", "class_id")
    every = sets.select("sid", "rep", "copies").join(result, "sid", "left").select(
        "sid", F.coalesce("class_id", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = table.select("doc_id", "key", "sid").join(every, "sid", "left")
    return out.select("doc_id", "key", F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("sid").isNotNull().alias("has_words"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class (the least id, then the least row key) and every
    row without words, all columns kept."""
    found = written(near_duplicates(docs, id_col, text_col), "jaccard-keep")
    best = found.where("has_words").groupBy("class_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("b"))
    winners = best.select(F.col("b.key").alias("key")).distinct()
    again = found.where("has_words").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    chosen = winners.join(again, "key").unionByName(
        found.where("NOT has_words").select("key", F.lit(0).cast("long").alias("n")).distinct())
    names = [c for c in docs.columns]
    mark, often = fresh("key", names), fresh("n", names)
    rows = docs.withColumn(mark, F.unhex(row_key(id_col, text_col))).join(chosen.toDF(mark, often), mark)
    single = rows.where(F.col(often) <= 1).select(*names)
    return single.unionByName(rows.where(F.col(often) > 1).dropDuplicates([mark]).select(*names))


def fresh(name: str, taken: list[str]) -> str:
    """A column name that is not taken."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name
