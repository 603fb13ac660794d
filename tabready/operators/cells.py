"""L6 on large tables: a regression forest over cells, rows that share all of their bins.

As in ``pyspark.ml``, a tree sees a feature through at most ``maxBins`` bins, so
the rows of a cell go the same way at every split.  For a tree a cell is the
number of times that its rows were drawn and the sum of their labels, which is
all that a split by variance, a leaf's size and its value are made of.

- ``bin_thresholds`` cuts every feature, from all rows.
- ``with_cell`` adds a row's bins as one binary value.
- ``CellForest`` draws every row by Poisson(1) for every tree on the row's own
  partition and sums the draws by cell there; the sums of a tree meet in one task,
  which grows the tree whole.  A task holds at most ``MERGED`` such tables.
- ``CellForestModel`` predicts for cells.

Bootstrap, feature subsets per node, depth, least rows of a leaf and least gain
are those of ``RandomForestRegressor``, whose parameters are read.  What a task
holds grows with the cells, not with the rows: ``fits`` says whether they do.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# tasks need not import this module: its functions go to them by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELL = "_cell"
#: Rows whose cells a task sums at a time.
BLOCK = 1 << 18
#: Tables of sums that meet in one task.
MERGED = 16
#: Cells, and bytes of their bins, that one tree's task holds.
MOST_CELLS, MOST_BYTES = 1 << 20, 1 << 26
#: Nodes that are split at a time.
FRONTIER = 4096
#: Values of a feature that a task counts one by one, and that it hands on.
COUNTED, POINTS = 1 << 16, 1 << 12


# ---- bins ---------------------------------------------------------------------

def _matrix(column) -> np.ndarray:
    """An Arrow list column of vectors as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _counted(values: np.ndarray, counts: np.ndarray, most: int, points: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their counts; beyond ``most`` of them, ``points`` values of about equal counts."""
    distinct, at = np.unique(values, return_inverse=True)
    counts = np.bincount(at, counts, len(distinct))
    if len(distinct) <= most:
        return distinct, counts
    upto = counts.cumsum()
    keep = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, points + 1) / points).clip(0, len(upto) - 1))
    return distinct[keep], np.diff(upto[keep], prepend=0.0)


def _cuts(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Spark's thresholds: between all values if they are few, else where the counts fill a stride."""
    between = (values[:-1] + values[1:]) / 2
    if len(values) <= bins:
        return between
    stride, upto, cuts = counts.sum() / bins, counts.cumsum(), []
    target = stride
    for i in range(1, len(values)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            cuts.append(between[i - 1])
            target += stride
    return np.asarray(cuts[:bins - 1])


def bin_thresholds(rows: DataFrame, features: str, bins: int) -> list[np.ndarray]:
    """Ascending thresholds of every slot of the vectors ``features``, at most
    ``bins - 1`` each, from all rows: exact for at most ``POINTS`` values, else
    ranks are off by about one in ``POINTS``.  Like Spark's fit it rejects NaN and infinite values."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            x = _matrix(batch.column(0)) if len(batch) else np.zeros((0, len(found)))
            found = found or [(np.zeros(0), np.zeros(0))] * x.shape[1]
            if not np.isfinite(x).all():
                raise ValueError("The training features have NaN or infinite values.")
            for f in range(x.shape[1]):
                own = x[:, f] + 0.0  # -0.0 is 0.0
                values, counts = found[f]
                found[f] = _counted(np.concatenate([values, own]), np.concatenate([counts, np.ones(len(own))]), COUNTED, POINTS)
        found = [_counted(v, c, POINTS, POINTS) for v, c in found]
        if found:
            piece = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pylist([_packed(f, piece, *pair) for f, pair in enumerate(found)], arrow)

    def met(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        table = table.sort_by([("piece", "ascending")])
        return _counted(*(np.frombuffer(b"".join(table[k].to_pylist())) for k in ("values", "counts")), COUNTED, POINTS)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([_packed(key[0].as_py(), key[1].as_py(), *met(table))], arrow)

    def cut(key: tuple, table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([{"feature": key[0].as_py(), "cuts": _cuts(*met(table), bins).tobytes()}],
                                    pa.schema([("feature", pa.int32()), ("cuts", pa.binary())]))

    schema = "feature int, piece int, values binary, counts binary"
    arrow = pa.schema([("feature", pa.int32()), ("piece", pa.int32()), ("values", pa.binary()), ("counts", pa.binary())])
    counted = rows.select(vector_to_array(features).alias("x")).mapInArrow(count, schema)
    for wider in _rounds(rows):
        counted = counted.withColumn("piece", wider).groupBy("feature", "piece").applyInArrow(merge, schema)
    cuts = counted.groupBy("feature").applyInArrow(cut, "feature int, cuts binary").collect()
    return [np.frombuffer(bytes(r["cuts"])) for r in sorted(cuts, key=lambda r: r["feature"])]


def _packed(feature: int, piece: int, values: np.ndarray, counts: np.ndarray) -> dict:
    """Counted values of a feature as a row."""
    return {"feature": feature, "piece": piece, "values": values.tobytes(), "counts": counts.tobytes()}


def _rounds(rows: DataFrame) -> Iterator[Column]:
    """Pieces to merge into, round by round, until at most ``MERGED`` are left of one per partition."""
    pieces = rows.rdd.getNumPartitions()
    while pieces > MERGED:
        pieces = -(-pieces // MERGED)
        yield F.floor(F.col("piece") / MERGED).cast("int")


def _layout(cuts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Features of more than two bins (a byte each) and the others (a bit each)."""
    wide = np.array([len(c) > 1 for c in cuts], dtype=bool)
    return np.flatnonzero(wide), np.flatnonzero(~wide)


def _places(cuts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each feature's bin is in a packed row: byte, bits to its right, and its bits."""
    (wide, narrow), (byte, shift, mask) = _layout(cuts), (np.zeros(len(cuts), np.int32), *(np.zeros(len(cuts), np.uint8) for _ in range(2)))
    byte[wide], mask[wide] = np.arange(len(wide)), 255
    byte[narrow], shift[narrow], mask[narrow] = len(wide) + np.arange(len(narrow)) // 8, 7 - np.arange(len(narrow)) % 8, 1
    return byte, shift, mask


def _pack(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Rows of values as rows of packed bins."""
    wide, narrow = _layout(cuts)
    # a value at a threshold is left of it; NaN is right of all
    codes = {f: np.searchsorted(cuts[f], x[:, f], side="left") for f in range(len(cuts))}
    parts = [np.stack([codes[f] for f in wide], 1).astype(np.uint8)] if len(wide) else []
    if len(narrow):
        parts.append(np.packbits(np.stack([codes[f] for f in narrow], 1).astype(bool), axis=1))
    return np.ascontiguousarray(np.hstack(parts))


def _unpack(keys: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """The bins of packed rows, a byte each."""
    wide, narrow = _layout(cuts)
    out = np.empty((len(keys), len(cuts)), np.uint8)
    out[:, wide] = keys[:, :len(wide)]
    if len(narrow):
        out[:, narrow] = np.unpackbits(keys[:, len(wide):], axis=1, count=len(narrow))
    return out


def _width(cuts: Sequence[np.ndarray]) -> int:
    """Bytes of a packed row."""
    wide, narrow = _layout(cuts)
    return len(wide) + (len(narrow) + 7) // 8


def _keys(column, width: int) -> np.ndarray:
    """An Arrow binary column of packed rows as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct packed rows, and the place of every row among them."""
    n, width = keys.shape
    if width <= 8:
        whole = np.zeros((n, 8), np.uint8)
        whole[:, :width] = keys
        found, at = np.unique(whole.view(np.uint64).ravel(), return_inverse=True)
        return np.ascontiguousarray(found.view(np.uint8).reshape(-1, 8)[:, :width]), at
    found, at = np.unique(np.ascontiguousarray(keys).view(f"V{width}").ravel(), return_inverse=True)
    return found.view(np.uint8).reshape(-1, width), at


def with_cell(df: DataFrame, features: str, cuts: Sequence[np.ndarray]) -> DataFrame:
    """``df`` with the bins of its vectors as the binary column ``_cell``."""
    width = _width(cuts)

    def cell(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.binary())
        raw = _pack(_matrix(vectors), cuts).tobytes()
        return pa.array([raw[i:i + width] for i in range(0, len(raw), width)], pa.binary())

    return df.withColumn(CELL, F.arrow_udf(cell, "binary")(vector_to_array(features)))


# ---- trees ----------------------------------------------------------------------

def _poisson_cuts() -> list[int]:
    """Where 32 random bits reach one draw more, by Poisson(1)."""
    cuts, below, term = [], 0.0, math.exp(-1)
    for k in range(1, 14):
        below += term
        term /= k
        if below < 1 - 2.0 ** -32:
            cuts.append(round(below * 2 ** 32))
    return cuts


def _drawn(rng: np.random.Generator, n: int) -> np.ndarray:
    """How often each of ``n`` rows is drawn."""
    bits, out = rng.integers(0, 1 << 32, n, dtype=np.uint32), np.zeros(n, np.uint8)
    for cut in _poisson_cuts():
        out += bits >= np.uint32(cut)
    return out


def _sums(tree: int, piece: int, keys: np.ndarray, n: np.ndarray, s: np.ndarray) -> dict:
    """A row of sums: the drawn cells only."""
    some = n > 0
    return {"tree": tree, "piece": piece, "cells": keys[some].tobytes(), "n": n[some].astype(np.uint32).tobytes(), "s": s[some].tobytes()}


SUMS = "tree int, piece int, cells binary, n binary, s binary"
SUMS_ARROW = pa.schema([("tree", pa.int32()), ("piece", pa.int32()), *((c, pa.binary()) for c in ("cells", "n", "s"))])


def _merged(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells, draws and label sums of several rows of sums."""
    # in the order of their pieces, as sums of doubles depend on it
    table = table.sort_by([("piece", "ascending")])
    keys, at = _distinct(_keys(table["cells"], width))
    n, s = (np.bincount(at, np.frombuffer(b"".join(table[c].to_pylist()), t), len(keys)) for c, t in (("n", np.uint32), ("s", np.float64)))
    return keys, n, s


def grow(keys: np.ndarray, n: np.ndarray, s: np.ndarray, cuts: Sequence[np.ndarray], depth: int, least: float, gain: float,
         taken: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """One tree over cells: their packed bins ``keys``, draws ``n`` > 0, label sums ``s``.

    Returns arrays by node: ``feature`` and ``bin`` (codes up to it go left),
    ``left`` (the right child follows it) and ``value``; a leaf leads to itself."""
    bins = np.array([len(c) + 1 for c in cuts])
    features, most, flat, width, (byte, shift, mask) = len(cuts), int(bins.max()), keys.ravel(), keys.shape[1], _places(cuts)

    def code_of(at: np.ndarray, node: np.ndarray, feature: np.ndarray) -> np.ndarray:
        """The bin of every cell in its node's feature."""
        return (flat[at * width + byte[feature][node]] >> shift[feature][node]) & mask[feature][node]

    made, count, deepest = [], 1, 0
    todo = [(np.arange(len(keys), dtype=np.int32), np.zeros(len(keys), np.int32), np.zeros(1, np.int64), 0)]
    while todo:
        at, node, ids, level = todo.pop()
        size = len(ids)
        if size > FRONTIER:
            half = size // 2
            low = node < half
            todo += [(at[~low], node[~low] - half, ids[half:], level), (at[low], node[low], ids[:half], level)]
            continue
        deepest = max(deepest, level)
        cn, cs = n[at], s[at]
        tn, ts = np.bincount(node, cn, size), np.bincount(node, cs, size)
        best, feature, cut = np.zeros(size), np.full(size, -1), np.zeros(size, np.int64)
        before = ts * ts / tn
        if level < depth:
            chosen = np.argpartition(rng.random((size, features)), taken - 1, axis=1)[:, :taken] if taken < features else \
                np.broadcast_to(np.arange(features), (size, features))
            open_ = tn >= 2 * least
            for j in range(taken):
                f = chosen[:, j]
                code = code_of(at, node, f)
                many = bins[f] > 2
                first = code == 0
                ln, ls = np.bincount(node[first], cn[first], size), np.bincount(node[first], cs[first], size)
                bin_ = np.zeros(size, np.int64)
                if many.any():
                    place, own = np.cumsum(many) - 1, many[node]
                    key, w = place[node[own]] * most + code[own], int(many.sum())
                    hn, hs = (np.bincount(key, c[own], w * most).reshape(w, most)[:, :-1].cumsum(1) for c in (cn, cs))
                    b = _scores(hn, hs, tn[many, None], ts[many, None], least).argmax(1)
                    row = np.arange(w)
                    ln[many], ls[many], bin_[many] = hn[row, b], hs[row, b], b
                score = _scores(ln, ls, tn, ts, least)
                better = open_ & (score - before > best) & (score - before > 1e-11 * score) & (score - before >= gain * tn)
                best[better], feature[better], cut[better] = (score - before)[better], f[better], bin_[better]
        split = feature >= 0
        k = int(split.sum())
        left = ids.copy()
        left[split] = count + 2 * np.arange(k)
        made.append((ids, np.where(split, feature, 0), np.where(split, cut, 255), left, ts / tn))
        if k:
            on = split[node]
            at, node = at[on], node[on]
            right = code_of(at, node, feature) > cut[node]
            todo.append((at, 2 * (np.cumsum(split, dtype=np.int32) - 1)[node] + right, count + np.arange(2 * k), level + 1))
            count += 2 * k
    order = np.argsort(np.concatenate([m[0] for m in made]))
    columns = [np.concatenate([m[i] for m in made])[order] for i in range(1, 5)]
    return {"feature": columns[0].astype(np.int32), "bin": columns[1].astype(np.uint8), "left": columns[2].astype(np.int32),
            "value": columns[3], "depth": np.array([deepest], np.int32)}


def _scores(ln: np.ndarray, ls: np.ndarray, tn: np.ndarray, ts: np.ndarray, least: float) -> np.ndarray:
    """What a split leaves of the sum of squares: larger is better."""
    rn, rs = tn - ln, ts - ls
    ok = (ln >= least) & (rn >= least)
    return np.where(ok, ls * ls / np.where(ok, ln, 1) + rs * rs / np.where(ok, rn, 1), -np.inf)


NODES = (("feature", np.int32), ("bin", np.uint8), ("left", np.int32), ("value", np.float64), ("depth", np.int32))


def subset_size(strategy: str, trees: int, features: int) -> int | None:
    """Features that a node looks at, by Spark's names; None for others."""
    sizes = {"sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log2(features))),
             "onethird": math.ceil(features / 3), "all": features}
    sizes["auto"] = sizes["onethird"] if trees > 1 else features
    return sizes.get(strategy)


def fits(forest: RandomForestRegressor, cuts: Sequence[np.ndarray], cells: int) -> bool:
    """Can one task hold a tree's cells, and are all of the forest's settings known here?"""
    if not 0 < cells <= MOST_CELLS or cells * _width(cuts) > MOST_BYTES:
        return False
    return forest.getBootstrap() and forest.getSubsamplingRate() == 1 and not forest.getMinWeightFractionPerNode() and \
        not (forest.isDefined(forest.weightCol) and forest.getWeightCol()) and forest.getMaxBins() <= 256 and \
        subset_size(forest.getFeatureSubsetStrategy(), forest.getNumTrees(), len(cuts)) is not None


class CellForest(RandomForestRegressor):
    """The forest of ``RandomForestRegressor``'s settings, fitted on rows ``(_cell, label)``
    that come in a fixed order within their partitions."""

    def on(self, cuts: Sequence[np.ndarray], center: float) -> CellForest:
        """The bins of the cells, and a label to subtract while summing."""
        self.cuts, self.center = list(cuts), center
        return self

    def _fit(self, dataset: DataFrame) -> CellForestModel:
        cuts, center, trees, seed = self.cuts, self.center, self.getNumTrees(), self.getSeed()
        width, depth, least, gain = _width(cuts), self.getMaxDepth(), self.getMinInstancesPerNode(), self.getMinInfoGain()
        taken = subset_size(self.getFeatureSubsetStrategy(), trees, len(cuts))

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            piece, held, rows, block = TaskContext.get().partitionId(), [], 0, 0

            def summed() -> Iterator[pa.RecordBatch]:
                table = pa.Table.from_batches(held)
                keys, at = _distinct(_keys(table[0], width))
                y = table[1].to_numpy() - center
                for tree in range(trees):
                    times = _drawn(np.random.Generator(np.random.SFC64([seed & (2 ** 64 - 1), tree, piece, block])), len(y))
                    n, s = np.bincount(at, times, len(keys)), np.bincount(at, times * y, len(keys))
                    if n.any():
                        yield pa.RecordBatch.from_pylist([_sums(tree, piece, keys, n, s)], SUMS_ARROW)

            for batch in batches:
                held.append(batch)
                rows += len(batch)
                if rows >= BLOCK:
                    yield from summed()
                    held, rows, block = [], 0, block + 1
            if rows:
                yield from summed()

        def merge(key: tuple, table: pa.Table) -> pa.Table:
            keys, n, s = _merged(table, width)
            return pa.Table.from_pylist([_sums(key[0].as_py(), key[1].as_py(), keys, n, s)], SUMS_ARROW)

        def tree(key: tuple, table: pa.Table) -> pa.Table:
            keys, n, s = _merged(table, width)
            made = grow(keys, n, s, cuts, depth, least, gain, taken,
                        np.random.default_rng([seed & (2 ** 64 - 1), key[0].as_py()]))
            made["value"] = made["value"] + center
            return pa.table({"tree": pa.array([key[0].as_py()], pa.int32()),
                             **{c: pa.array([made[c].astype(t).tobytes()], pa.binary()) for c, t in NODES}})

        sums = dataset.select(CELL, F.col(self.getLabelCol()).cast("double")).mapInArrow(draw, SUMS)
        for wider in _rounds(dataset):
            sums = sums.withColumn("piece", wider).groupBy("tree", "piece").applyInArrow(merge, SUMS)
        grown = sums.repartition(trees, "tree").groupBy("tree").applyInArrow(
            tree, "tree int, " + ", ".join(f"{c} binary" for c, _ in NODES)).collect()
        return CellForestModel(cuts, [{c: np.frombuffer(bytes(r[c]), t) for c, t in NODES} for r in sorted(grown, key=lambda r: r["tree"])])


class CellForestModel:
    """Fitted trees; ``transform`` predicts by ``_cell``."""

    def __init__(self, cuts: list[np.ndarray], trees: list[dict[str, np.ndarray]]) -> None:
        self.cuts, self.trees = cuts, trees

    @property
    def totalNumNodes(self) -> int:  # noqa: N802, Spark's name
        return sum(len(t["value"]) for t in self.trees)

    @property
    def getNumTrees(self) -> int:  # noqa: N802, Spark's name
        return len(self.trees)

    def transform(self, dataset: DataFrame) -> DataFrame:
        shared, width = dataset.sparkSession.sparkContext.broadcast((self.cuts, self.trees)), _width(self.cuts)

        def predict(cells: pa.Array) -> pa.Array:
            cuts, trees = shared.value
            return pa.array(_predicted(_unpack(_keys(cells, width), cuts), trees))

        return dataset.withColumn("prediction", F.arrow_udf(predict, "double")(F.col(CELL)))


def _predicted(codes: np.ndarray, trees: Sequence[dict[str, np.ndarray]]) -> np.ndarray:
    """The mean of the trees' values at every row of bins."""
    flat, start, out = codes.ravel(), np.arange(len(codes)) * codes.shape[1], np.zeros(len(codes))
    for t in trees:
        node = np.zeros(len(codes), np.int32)
        for _ in range(int(t["depth"][0])):
            node = t["left"][node] + (flat[start + t["feature"][node]] > t["bin"][node])
        out += t["value"][node]
    return out / len(trees)
