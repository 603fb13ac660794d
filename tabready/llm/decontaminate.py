"""Benchmark decontamination by q-gram lemma filtering.

A passage within ``e`` edits of an item of ``n`` characters shares at least
``n - q + 1 - q * e`` of its q-grams with it, on diagonals (text position minus
item position) at most ``e`` apart.  The operator looks up every q-gram of
every whole text, counts hits per item in overlapping diagonal bands twice as
wide as that, keeps bands that reach the bound, and aligns the item with the
band's region.  A region within the budget is a match.

The items are the query set: they go to the tasks in blocks of at most
``BLOCK_CHARS`` characters, one pass over the documents per block.  A benchmark
of one block is map only.  With more, the blocks run one after the other and
their matches are gathered in the shared folder, so the driver's memory does
not grow with the benchmark, but the time does; documents are then dropped by a
join on the digests of the texts that matched.

Defined results: case and kind of white space do not matter; null and empty
texts match nothing, nor do null and empty items; texts of any length are read
whole; repeated documents match each for itself; of items with the same id one
match per place is given, the best (of equal ones the first found); an empty
table of either kind gives no match; further columns are ignored.
"""

from __future__ import annotations

import gc
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabready.llm.common import releasing, scratch_path
from pyspark.sql import types as T

Q = 8
ERROR_RATE = 0.1
BLOCK_CHARS = 4 << 20
#: Positions that are looked up at a time, and q-grams from which an item may leave frequent ones out.
STEP, FREQUENT = 1 << 20, 64
MIX = np.uint64(0x9E3779B97F4A7C15)

_FOLD = bytearray(range(256))
for _b in range(256):
    _c = chr(_b).lower()
    _FOLD[_b] = 32 if chr(_b).isspace() else ord(_c) if len(_c) == 1 and ord(_c) < 256 else _b
FOLD = bytes(_FOLD)


def folded(text: str) -> bytes:
    """One byte per character: lower case, any white space as a space.  Equal
    characters get equal bytes; characters beyond Latin-1 may share one."""
    try:
        return text.encode("latin-1").translate(FOLD)
    except UnicodeEncodeError:
        low = "".join([c if len(c) == 1 else x for x, c in ((x, x.lower()) for x in text)])
        points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")
        out = np.where(points < 256, points, 128 + points % 125).astype(np.uint8)
        return out.tobytes().translate(FOLD)


def characters(text: str) -> np.ndarray:
    """Code points, folded one by one."""
    if text.isascii():
        return np.frombuffer(folded(text), np.uint8).astype(np.int64)
    return np.array([32 if c.isspace() else ord(low) if len(low := c.lower()) == 1 else ord(c) for c in text], np.int64)


def gram_codes(data: bytes, q: int = Q) -> np.ndarray:
    """The ``q`` bytes from each position, as one number each."""
    if len(data) < q:
        return np.empty(0, np.uint64)
    if q == 8:
        return np.ndarray((len(data) - q + 1,), "<u8", data, strides=(1,))
    return np.ndarray((len(data) - q + 1,), "<u8", data + bytes(8), strides=(1,)) & np.uint64((1 << 8 * q) - 1)


def edit_budget(n: int, rate: float) -> int:
    """Edits allowed for an item of ``n`` characters."""
    return int(n * rate)


def gram_length(n: int, rate: float) -> int:
    """q for an item of ``n`` characters: after all allowed edits one q-gram is whole."""
    return min(Q, n // (edit_budget(n, rate) + 1))


def align(item: np.ndarray, region: np.ndarray, budget: int) -> tuple[int, int] | None:
    """Least edits of ``item`` against a part of ``region`` and where that part
    ends.  Rows are cells of one item character; only the diagonals that the
    region leaves to it are computed."""
    n, width = len(item), len(region) - len(item) + 1 + 2 * budget
    if width <= 0:
        return None
    # cell k of row i is text position i + k - budget
    offset = np.arange(width)
    padded = np.concatenate([np.full(budget, -1), region, np.full(budget + n + width, -2)])
    row = np.where((offset - budget >= 0) & (offset - budget <= len(region)), 0, n)
    for i in range(n):
        cost = row + (padded[i:i + width] != item[i])
        cost[:-1] = np.minimum(cost[:-1], row[1:] + 1)
        row = np.minimum.accumulate(cost - offset) + offset
        if row.min() > budget:
            return None
    ends = n + offset - budget
    row = np.where((ends >= 0) & (ends <= len(region)), row, n + 1)
    k = int(np.argmin(row))
    return (int(row[k]), int(ends[k])) if row[k] <= budget else None


class BenchmarkBlock:
    """The q-gram indexes of one block of items, one for each q."""

    def __init__(self, items: list[tuple], rate: float = ERROR_RATE):
        by_length: dict[int, list[tuple]] = {}
        for k, t in items:
            if t and (q := gram_length(len(t), rate)):
                by_length.setdefault(q, []).append((k, t))
        self.parts = [GramIndex(own, rate, q) for q, own in sorted(by_length.items())]

    def matches(self, texts: list[str | None]) -> list[list[tuple]]:
        """For each text the (item id, start, end, edits) of its matches."""
        out: list[list[tuple]] = [[] for _ in texts]
        if self.parts:
            data = [folded(t) if t else b"" for t in texts]
            for part in self.parts:
                for found, new in zip(out, part.matches(texts, data)):
                    for match in new:
                        add_match(found, match)
        return [sorted(m, key=lambda x: (x[1], x[2], str(x[0]))) for m in out]


class GramIndex:
    """The index of items of one q."""

    def __init__(self, items: list[tuple], rate: float, q: int):
        self.q = q
        self.ids = [k for k, _ in items]
        self.texts = [t for _, t in items]
        self.folded = [folded(t) for t in self.texts]
        self.length = np.array([len(t) for t in self.texts], np.int64)
        self.budget = np.array([edit_budget(n, rate) for n in self.length], np.int64)
        self.bound = self.length - q + 1 - q * self.budget
        codes = [np.array(gram_codes(f, q)) for f in self.folded]
        code = np.concatenate(codes) if codes else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(items)), [len(c) for c in codes])
        at = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.empty(0, np.int64)
        _, inverse, often = np.unique(code, return_inverse=True, return_counts=True)
        keep = np.ones(len(code), bool)
        if len(code) and often.max() > FREQUENT:
            # an item may leave out frequent q-grams if its bound sinks by as many
            frequency = often[inverse]
            for i in np.unique(item[frequency > FREQUENT]):
                own = np.flatnonzero((item == i) & (frequency > FREQUENT))
                own = own[np.argsort(-frequency[own], kind="stable")][:int(self.bound[i] - 1) // 2]
                keep[own] = False
                self.bound[i] -= len(own)
        order = np.argsort(code[keep], kind="stable")
        self.item, self.at = item[keep][order], at[keep][order]
        self.code, first = np.unique(code[keep][order], return_index=True)
        self.first = np.append(first, keep.sum())
        self.bits = max(20, min(27, int(len(self.code)).bit_length() + 5))
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self._slot(self.code)] = True

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes * MIX) >> np.uint64(64 - self.bits)

    def hits(self, data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Text positions, items and item positions of shared q-grams."""
        codes = gram_codes(data, self.q)
        for start in range(0, len(codes), STEP):
            part = codes[start:start + STEP]
            at = np.flatnonzero(self.seen[self._slot(part)])
            if not len(at):
                continue
            own = part[at]
            k = np.minimum(np.searchsorted(self.code, own), len(self.code) - 1)
            true = self.code[k] == own
            at, k = at[true] + start, k[true]
            n = self.first[k + 1] - self.first[k]
            flat = np.repeat(self.first[k] - np.cumsum(n) + n, n) + np.arange(n.sum())
            yield np.repeat(at, n), self.item[flat], self.at[flat]

    def matches(self, texts: list[str | None], parts: list[bytes]) -> list[list[tuple]]:
        """The matches of texts, given with their folded bytes."""
        out: list[list[tuple]] = [[] for _ in texts]
        # texts lie behind each other, further apart than any diagonal reaches
        gap = b"\x00" * Q
        starts = np.concatenate([[0], np.cumsum([len(p) + Q for p in parts])])
        keys, bands = [], int(starts[-1] + self.length.max()) + 2
        for at, item, pos in self.hits(gap.join(parts) + gap):
            doc = np.searchsorted(starts, at, side="right") - 1
            band = (at - starts[doc] - pos + self.length[item]) // (self.budget[item] + 1)
            keys.append((doc * len(self.ids) + item) * bands + band)
        if not keys:
            return out
        key, n = np.unique(np.concatenate(keys), return_counts=True)
        following = np.append(key[1:] == key[:-1] + 1, False)  # the last band of an item is never used
        both = n + np.where(following, np.append(n[1:], 0), 0)
        pair, band = np.divmod(key, bands)
        doc, item = np.divmod(pair, len(self.ids))
        tried: tuple = ()
        for k in np.flatnonzero(both >= self.bound[item]):
            d, i, b = int(doc[k]), int(item[k]), int(band[k])
            if tried[:3] == (d, i, b - 1) and tried[3] and both[k] == n[k]:
                continue  # the band before held all of these hits and has its match
            found = self._verify(texts[d], parts[d], i, b)
            tried = (d, i, b, found)
            if found:
                add_match(out[d], (self.ids[i], *found))
        return out

    def _verify(self, text: str, data: bytes, i: int, band: int) -> tuple[int, int, int] | None:
        n, e = int(self.length[i]), int(self.budget[i])
        diagonal = band * (e + 1) - n
        low, high = max(0, diagonal - e), min(len(data), diagonal + 2 * (e + 1) + e + n)
        item = characters(self.texts[i])
        exact = data.find(self.folded[i], low, high)
        if exact >= 0 and (characters(text[exact:exact + n]) == item).all():
            return exact, exact + n, 0
        region = characters(text[low:high])
        ahead = align(item, region, e)
        if ahead is None:
            return None
        edits, end = ahead
        _, back = align(item[::-1], region[:end][::-1][:n + e], e) or (0, min(end, n))
        return low + end - back, low + end, edits


def add_match(found: list[tuple], new: tuple) -> None:
    """Neighbouring bands see the same region: the better match stays."""
    for k, old in enumerate(found):
        if old[0] == new[0] and old[1] < new[2] and new[1] < old[2]:
            if new[3] < old[3]:
                found[k] = new
            return
    found.append(new)


def blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple]]:
    """The items in blocks whose characters are bounded, in no order."""
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")).where("char_length(text) > 0")
    size = items.agg(F.sum(F.char_length("text")).alias("n")).first().n or 0
    n = -(-size // BLOCK_CHARS) or 1
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        held, chars = [], 0
        for row in part.toLocalIterator():
            held.append((row.item_id, row.text))
            chars += len(row.text)
            if chars >= BLOCK_CHARS:
                yield held
                held, chars = [], 0
        if held:
            yield held


def matches_column(items: list[tuple], item_type: T.DataType, text: Column, rate: float = ERROR_RATE) -> Column:
    """The matches of one block of items in ``text``, as an array."""
    match = T.StructType([T.StructField("item_id", item_type), T.StructField("start", T.LongType()),
                          T.StructField("end", T.LongType()), T.StructField("edits", T.LongType())])

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        block = BenchmarkBlock(items, rate)
        for batch in batches:
            out: list = []
            texts, size, first = batch.tolist(), 0, 0
            for k, t in enumerate(texts):  # a few MB at a time
                size += len(t or "")
                if size > 4 * STEP or k == len(texts) - 1:
                    out += block.matches(texts[first:k + 1])
                    size, first = 0, k + 1
            yield pd.Series([[dict(zip(("item_id", "start", "end", "edits"), m)) for m in ms] for ms in out], dtype="object")

    return F.pandas_udf(releasing(run), T.ArrayType(match))(text)


def gathered(found_in: Callable[[list[tuple]], DataFrame], parts: Iterator[list[tuple]]) -> DataFrame | None:
    """The rows that each block of items gives.  More than one block are run
    one after the other, and their rows gathered in the shared folder: the
    driver holds two blocks at a time, and the plan none.  None: no block."""
    items, after = next(parts, None), next(parts, None)
    if items is None or after is None:
        return found_in(items) if items else None
    path = None
    while items:
        found = found_in(items)
        path = path or scratch_path(found.sparkSession, "benchmark-matches")
        found.write.mode("append").parquet(path)
        spark, schema = found.sparkSession, found.schema
        del found
        gc.collect()
        spark._jvm.System.gc()
        items, after = after, next(parts, None)
    return spark.read.schema(schema).parquet(path)


def find_benchmark_passages(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            item_col: str = "item_id", item_text_col: str = "text", rate: float = ERROR_RATE) -> DataFrame:
    """``doc_id, item_id, start, end, edits, similarity``: a row per passage of
    a document (characters from ``start`` up to ``end``) that is within the
    edit budget of an item."""
    item_type = benchmark.schema[item_col].dataType

    def found_in(items: list[tuple]) -> DataFrame:
        return docs.select(F.col(id_col).alias("doc_id"), F.explode(
            matches_column(items, item_type, F.col(text_col), rate)).alias("m")).select("doc_id", "m.*")

    out = gathered(found_in, blocks(benchmark, item_col, item_text_col))
    if out is None:
        out = docs.select(F.col(id_col).alias("doc_id"), F.lit(None).cast(item_type).alias("item_id"),
                          *(F.lit(0).cast("long").alias(c) for c in ("start", "end", "edits"))).where("false")
    return out.withColumn("similarity", 1 - F.col("edits") / (F.col("end") - F.col("start")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", rate: float = ERROR_RATE) -> DataFrame:
    """The documents without any such passage, all columns kept.  Equal texts
    are decided alike, so with several blocks the texts' digests are gathered."""
    item_type = benchmark.schema[item_col].dataType
    parts = blocks(benchmark, item_col, item_text_col)
    first = list(itertools.islice(parts, 2))
    if len(first) < 2:
        for items in first:
            docs = docs.where(F.coalesce(F.size(matches_column(items, item_type, docs[text_col], rate)), F.lit(0)) <= 0)
        return docs

    def found_in(items: list[tuple]) -> DataFrame:
        return (docs.where(F.size(matches_column(items, item_type, docs[text_col], rate)) > 0)
                .select(F.md5(docs[text_col]).alias("text_digest")).distinct())

    parts = itertools.chain(first, parts)
    del first
    digests = gathered(found_in, parts)
    return docs.join(digests, F.md5(docs[text_col]) == digests["text_digest"], "left_anti")
