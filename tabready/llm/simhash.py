"""SimHash near-duplicates by deletion-variant signatures.

A text's fingerprint has 64 bits: bit i is 1 if more than half of its 3-word
shingles have it in their hash.  Fingerprints link at 3 differing bits or fewer.
Cut into two segments of 32 bits, one segment of a linked pair differs in at most
one bit, so the pair agrees in a variant of that segment with this one bit taken
out.  Each distinct fingerprint is indexed under its 2 x 32 variants; rows that
share one are compared, and a pair counts in one variant only.

A segment value that many fingerprints share would make a large group.  Values
are counted first; groups of those over ``HOT`` are indexed by a second cut, of
the other segment into halves of 16 bits with one bit taken out again.  A group
then fixes 46 of 64 bits, so it never holds more than 2^18 fingerprints, whatever
the table.  Within a task, groups are split further by the same rule until they
can be compared in full; large ones send on a spanning forest of their links.

Copies of a fingerprint are one row from the start; documents get their component
by a join on it that Spark can split.

Defined results: a null or empty text, or one without words, has fingerprint 0,
which links like any other; a text of fewer than three words is one shingle; texts
of any length are hashed whole; repeated shingles count as often as they stand;
exactly half is not over half.  Repeated rows get equal results.  Null ids are
never the smallest; a component of null ids alone has a null name.  An empty table
gives an empty result.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabready.llm.common import releasing, written
from tabready.llm.components import connected_components

BITS, SEGMENT, MAX_DIFFERENCE = 64, 32, 3
WORDS, SEED = 3, 42
#: A segment value of more distinct fingerprints than this is indexed by the
#: second cut.  At most twice the fingerprints / HOT values are collected.
HOT = 1 << 15
#: Groups up to this size are compared row by row of the batch, those up to the
#: next one in full, larger ones are split.
SHORT, FULL = 24, 2048
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None) -> int:
    """The unsigned fingerprint of a text."""
    words = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= WORDS:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.append(0, ends[:-WORDS])
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), (ends[WORDS - 1:] - 1).tolist())]
    hashes = np.array(hashes, np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at:at + BLOCK, None].view(np.uint8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed long."""

    @F.pandas_udf("long")
    @releasing
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t) for t in batch], np.uint64).view(np.int64))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), run(F.col(text_col)).alias("fp"))


def without_bit(value: np.ndarray, bit: int) -> np.ndarray:
    low = value & np.uint64((1 << bit) - 1)
    return (value >> np.uint64(bit + 1) << np.uint64(bit)) | low


def part_of(fp: np.ndarray, at: int, width: int) -> np.ndarray:
    return (fp >> np.uint64(at)) & np.uint64((1 << width) - 1)


def variants(fp: np.ndarray, at: int, width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(half, bit, rest)`` of the two halves of a field: the half's value with the bit taken out."""
    half = width // 2
    for h in (0, 1):
        value = part_of(fp, at + h * half, half)
        for bit in range(half):
            yield h, bit, without_bit(value, bit)


def first_variant(difference: np.ndarray, at: int, width: int) -> np.ndarray:
    """The variant, as ``half * width / 2 + bit``, in which a pair counts: of the
    first half that differs in one bit at most, the bit, or 0 if there is none."""
    half = width // 2
    parts = [part_of(difference, at + h * half, half) for h in (0, 1)]
    first = np.bitwise_count(parts[0]) <= 1
    one = np.where(first, parts[0], parts[1])
    bit = np.bitwise_count(np.where(one > 0, one, np.uint64(1)) - np.uint64(1))
    return np.where(first, 0, half) + bit


def keys_of(fp: np.ndarray, hot: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index rows ``key, fp``.  ``hot`` holds ``segment << 32 | value``, sorted.
    A key is ``variant (6 bits), rest (31)``; by the second cut further
    ``variant (5), rest (15)`` and a mark follow."""
    for s, bit, rest in variants(fp, 0, BITS):
        key = np.uint64((s * SEGMENT + bit) << 31) | rest
        value = part_of(fp, s * SEGMENT, SEGMENT) | np.uint64(s << 32)
        crowded = _among(value, hot) | _among(value ^ np.uint64(1 << bit), hot)
        yield key[~crowded], fp[~crowded]
        if crowded.any():
            inner, key = fp[crowded], key[crowded]
            for h, bit2, rest2 in variants(inner, SEGMENT * (1 - s), SEGMENT):
                yield np.uint64(1 << 62) | key << np.uint64(20) | np.uint64((h * 16 + bit2) << 15) | rest2, inner


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def counts_here(key: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a pair links and counts in the group of this key."""
    d = a ^ b
    ok = np.bitwise_count(d) <= MAX_DIFFERENCE
    second = key >> np.uint64(62) == 1
    outer = np.where(second, key >> np.uint64(20) & np.uint64((1 << 37) - 1), key)
    variant = (outer >> np.uint64(31)).astype(np.int64)
    ok &= first_variant(d, 0, BITS) == variant
    other = np.where(variant < SEGMENT, d >> np.uint64(SEGMENT), d & np.uint64((1 << SEGMENT) - 1))
    inner = (key >> np.uint64(15) & np.uint64(31)).astype(np.int64)
    return ok & (~second | (first_variant(other, 0, SEGMENT) == inner))


def runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal keys."""
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return starts, np.diff(np.append(starts, len(key)))


def forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges between each node and the least of its component, for the edges i, j."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        for end in (i, j, label[i], label[j]):
            np.minimum.at(new, end, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def group_links(key: int, fp: np.ndarray, at: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links, as positions, of one group's distinct
    fingerprints, which may differ in the field ``at, width`` and in single bits."""
    n = len(fp)
    if n <= FULL or width <= 8:
        i, j = [], []
        for lo in range(0, n, FULL):
            near = counts_here(np.uint64(key), fp[lo:lo + FULL, None], fp[None, :])
            x, y = np.nonzero(near)
            i, j = [*i, x + lo], [*j, y]
    else:
        i, j, half = [], [], width // 2
        for h, _, rest in variants(fp, at, width):
            order = np.argsort(rest, kind="stable")
            starts, sizes = runs(rest[order])
            for a, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
                own = order[a:a + size]
                x, y = group_links(key, fp[own], at + (1 - h) * half, half)
                i, j = [*i, own[x]], [*j, own[y]]
    return forest(n, np.concatenate([np.zeros(0, np.int64), *i]), np.concatenate([np.zeros(0, np.int64), *j]))


def free_field(key: int) -> tuple[int, int]:
    """The bits that a group's key leaves open, but for the single bits."""
    if not key >> 62:
        return (SEGMENT, SEGMENT) if key >> 31 < SEGMENT else (0, SEGMENT)
    at = SEGMENT if (key >> 51) & 63 < SEGMENT else 0
    return (at + 16, 16) if (key >> 15) & 31 < 16 else (at, 16)


def links(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of whole groups, sorted by key: all of small groups, a
    spanning forest of a large one's."""
    starts, sizes = runs(key)
    a, b = [], []
    left = np.repeat(np.where(sizes <= SHORT, starts + sizes, 0), sizes) - np.arange(len(key))  # rows from here to the run's end
    for step in range(1, SHORT):
        i = np.flatnonzero(left > step)
        if not len(i):
            break
        near = counts_here(key[i], fp[i], fp[i + step])
        a, b = [*a, fp[i[near]]], [*b, fp[i[near] + step]]
    for s, size in zip(starts[sizes > SHORT].tolist(), sizes[sizes > SHORT].tolist()):
        own = fp[s:s + size]
        i, j = group_links(int(key[s]), own, *free_field(int(key[s])))
        a, b = [*a, own[i]], [*b, own[j]]
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def link_fingerprints(distinct: DataFrame, hot: int | None = None) -> DataFrame:
    """Pairs ``a, b`` of the distinct fingerprints ``fp`` that connect all linked ones."""
    values = distinct.select(F.explode(F.array(F.col("fp").bitwiseAND(0xFFFFFFFF),
                                               F.shiftrightunsigned("fp", SEGMENT).bitwiseOR(1 << 32))).alias("v"))
    crowded = values.groupBy("v").count().where(F.col("count") > (HOT if hot is None else hot)).select("v").collect()
    hot_values = np.sort(np.array([r["v"] for r in crowded], np.uint64))
    schema = "key long, fp long"

    @releasing
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, fp in keys_of(batch.column("fp").to_numpy().view(np.uint64), hot_values):
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], ["key", "fp"])

    @releasing
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, open_key = [], None  # the rows of the last key, whose run may go on
        for batch in batches:
            key, fp = (batch.column(c).to_numpy().view(np.uint64) for c in ("key", "fp"))
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))
            if cut or key[-1] != open_key:
                done = [*kept, (key[:cut], fp[:cut])]
                kept, open_key = [], key[-1]
                yield _pairs(*links(*(np.concatenate(x) for x in zip(*done))))
            kept.append((key[cut:], fp[cut:]))
        if kept:
            yield _pairs(*links(*(np.concatenate(x) for x in zip(*kept))))

    rows = distinct.select("fp").mapInArrow(index, schema)
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(compare, "a long, b long")


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int | None = None) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row per input row."""
    rows = written(fingerprints(docs, id_col, text_col), "simhash")
    least = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    names = written(connected_components(link_fingerprints(least, hot)), "simhash-components")
    of_component = (least.join(names, F.col("fp") == F.col("node")).groupBy("component").agg(F.min("least").alias("first")))
    first = names.join(of_component, "component").select("node", "first")
    named = least.join(first, F.col("fp") == F.col("node"), "left").select(F.col("fp").alias("own"), F.coalesce("first", "least").alias("component_id"))
    return rows.join(named, F.col("fp") == F.col("own")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
