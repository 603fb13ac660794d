"""Cross-tokenizer alignment of a byte-level BPE vocabulary (A) and a
sentencepiece model (B) over the same bytes.

A chunk of documents is a pair of Arrow list columns of token ids.  They are
flattened with their parent indices; byte ends are cumulative sums of token
lengths, less what stood before the document.  A full outer Acero hash join of
both sides on (document, end) gives every place where a token of either side
ends: where both do, a group ends, and each stretch between two such places is
one overlapping token pair (a link), named by the next A and B token that end.
``Table.group_by`` counts links by document and pair, and documents by pair, in
the chunk; Spark merges the partial counts over all chunks and sends each chunk
the counts of its own pairs back, by (chunk, code).

So nothing is exchanged for each token: a chunk (at most ``CHUNK_BYTES`` of
text, or one longer document) ships one row per distinct pair, and its
documents' packed links once.  The most frequent pair is one row per chunk.

Encoding goes by stretches of text between single spaces: neither vocabulary
has a token that crosses such a place (A's word pattern gives the space to what
follows; no piece of B has a space after another character, which is checked on
loading).  Ids of a bounded number of stretches are kept per worker.

Defined results: a null or empty text, and a text whose tokens don't spell it
(for one, U+2581 is read as a space by B), has no tokens: zeros and an empty
``groups_sha256``.  Texts of any length are encoded whole.  Repeated rows are
documents of their own, in results and in counts; null ids stay null.  Pairs
with equal counts are all best.  An empty table gives an empty result.  Further
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabready.llm.bpe import byte_symbols
from tabready.llm.common import releasing, written

#: Bytes of text that are aligned at once.
CHUNK_BYTES = 4 << 20
#: Stretches whose ids a worker keeps (twice as many at most), and the longest.
KEPT_STRETCHES, KEPT_LENGTH = 120_000, 40

# The word pattern of A, and the sign that B has for a space.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "▁"

#: A single space between two characters that are no white space.
STRETCH = re.compile(r"(?<=\S) (?=\S)")
#: A space beside other white space.
WIDE = re.compile(r" \s|\s ")

CHUNK_SCHEMA = ("chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                "codes array<int>, times array<int>, code int, pair long, docs long")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Vocabularies:
    """Both encoders, with the bytes and the decimal text of every id as Arrow columns."""

    def __init__(self, a_path: str, b_path: str):
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {s: b for b, s in enumerate(byte_symbols())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        a_bytes = {i: bytes(byte[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in special}
        self.a_path = a_path
        self.a = tiktoken.Encoding("a", pat_str=WORD, mergeable_ranks=_ranks(spec, a_bytes), special_tokens={})
        self.a_ids = _positions(spec, a_bytes, self.a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        b_bytes = {}
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"piece {piece!r} holds a space after another character")
            b_bytes[i] = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode()
        self.lone = self.b.piece_to_id(SPACE)
        self.bytes = [_column(x) for x in (a_bytes, b_bytes)]
        self.lengths = [pc.cast(pc.binary_length(x), pa.int64()) for x in self.bytes]
        self.digits = [pc.cast(pa.array(range(len(x))), pa.string()) for x in self.bytes]
        self._kept: dict[str, tuple[bytes, bytes]] = {}
        self._before: dict[str, tuple[bytes, bytes]] = {}

    def _encode_a(self, text: str) -> list[int]:
        """Ids of a text as it stands."""
        if not text.isascii() and any(c > "\u024f" for c in text) and regex.search(r"\p{Cn}", text):
            # code points that the word pattern's tables may not agree on
            return library_of(self.a_path).encode(text, add_special_tokens=False).ids
        ids = self.a.encode_ordinary(text)
        return ids if self.a_ids is None else [self.a_ids[i] for i in ids]

    def _learn(self, stretches: Iterable[str]) -> dict[str, tuple[bytes, bytes]]:
        """Ids of stretches with the space before each, packed; the short ones are kept."""
        out, new = {}, []
        for s in dict.fromkeys(stretches):
            if s in self._before:
                out[s] = self._before[s]
            elif s:
                new.append(s)
            else:  # alone, the space that B adds would not count
                out[s] = array("i", self._encode_a(" ")).tobytes(), array("i", [self.lone]).tobytes()
        for s, b in zip(new, self.b.encode(new, num_threads=1)):
            out[s] = array("i", self._encode_a(" " + s)).tobytes(), array("i", b).tobytes()
        short = {s: x for s, x in out.items() if len(s) <= KEPT_LENGTH}
        if len(self._kept) + len(short) > KEPT_STRETCHES:
            self._before, self._kept = self._kept, {}
        self._kept.update(short)
        return out

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Packed ids of space + text, by A and by B, of each text."""
        parts, kept = [stretches(t) if t else [] for t in texts], self._kept
        missing = self._learn(s for p in parts for s in p if s not in kept)
        out = []
        for p in parts:
            ids = [kept.get(s) or missing[s] for s in p]
            out.append((b"".join([x[0] for x in ids]), b"".join([x[1] for x in ids])))
        return out


def stretches(text: str) -> list[str]:
    """The text cut at single spaces between characters that are no white space."""
    if text[0] == " " or text[-1] == " " or WIDE.search(text):
        return STRETCH.split(text)
    return text.split(" ")


def _ranks(spec: dict, token_bytes: dict[int, bytes]) -> dict[bytes, int]:
    """Ranks in the order of the merges: single bytes first, then each merge's result."""
    ranks = {b: i for i, b in enumerate(b for b in token_bytes.values() if len(b) == 1)}
    vocab = spec["model"]["vocab"]
    for merge in spec["model"]["merges"]:
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        ranks.setdefault(token_bytes[vocab[left + right]], len(ranks))
    return ranks


def _positions(spec: dict, token_bytes: dict[int, bytes], encoding: tiktoken.Encoding) -> list[int] | None:
    """The vocabulary's id of each rank; None if they are equal."""
    by_bytes = {b: i for i, b in token_bytes.items()}
    ids = [by_bytes[encoding.decode_single_token_bytes(r)] for r in range(encoding.max_token_value + 1)]
    return None if ids == list(range(len(ids))) else ids


def _column(token_bytes: dict[int, bytes]) -> pa.Array:
    return pa.array([token_bytes.get(i, b"") for i in range(max(token_bytes) + 1)], pa.binary())


@lru_cache(maxsize=1)
def load(a_path: str, b_path: str) -> Vocabularies:
    """The vocabularies, read once per worker."""
    return Vocabularies(a_path, b_path)


@lru_cache(maxsize=1)
def library_of(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def _lists(packed: list[bytes]) -> pa.ListArray:
    counts = np.fromiter((len(p) // 4 for p in packed), np.int64, len(packed))
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)),
                                    pa.array(np.frombuffer(b"".join(packed), np.int32)))


def _spelled(lists: pa.ListArray, token_bytes: pa.Array, texts: list[bytes]) -> np.ndarray:
    """Of each document, whether the joined token bytes are its text."""
    joined = pc.take(pc.cast(token_bytes, pa.large_binary()), lists.values)
    ends = np.frombuffer(joined.buffers()[1], np.int64)[: len(joined) + 1]
    at = ends[lists.offsets.to_numpy()]
    data = memoryview(joined.buffers()[2] or b"")
    return np.fromiter((bytes(data[s:e]) == t for s, e, t in zip(at, at[1:], texts)), bool, len(texts))


def _ends(lists: pa.ListArray, lengths: pa.Array) -> pa.Table:
    """``key`` (document, byte end within it) and ``id`` of every token."""
    ids, parent = lists.flatten(), pc.cast(pc.list_parent_indices(lists), pa.int64())
    total = pc.cumulative_sum(pc.take(lengths, ids))
    # what had been summed up before each document
    before = np.append(0, total.to_numpy())[lists.offsets.to_numpy()[:-1]]
    end = pc.subtract(total, pc.take(pa.array(before), parent))
    return pa.table({"key": pc.add(pc.shift_left(parent, pa.scalar(32, pa.int64())), end), "id": ids})


def _joined_by(strings: pa.Array, ends: pa.Array, separator: str) -> pa.Array:
    """Runs of strings that end where ``ends`` is true, each joined."""
    at = np.append(0, np.flatnonzero(ends.to_numpy(zero_copy_only=False)) + 1).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(at), strings), separator)


def align(v: Vocabularies, texts: list[str | None]) -> tuple[dict, pa.Table, pa.Table]:
    """Of a chunk of texts: result columns, the links as ``doc, code, times`` by
    document, and the chunk's pairs as ``code, pair, docs``."""
    texts = ["" if text is None or SPACE in text else text for text in texts]
    packed, spelled = v.encode(texts), [b" " + t.encode() if t else b"" for t in texts]
    sides = [_lists([p[k] for p in packed]) for k in (0, 1)]
    good = _spelled(sides[0], v.bytes[0], spelled) & _spelled(sides[1], v.bytes[1], spelled)
    if not good.all():
        sides = [_lists([p[k] if g else b"" for p, g in zip(packed, good)]) for k in (0, 1)]
    del packed, spelled

    a, b = (_ends(side, lengths) for side, lengths in zip(sides, v.lengths))
    both = a.rename_columns(["key", "a"]).join(b.rename_columns(["key", "b"]), "key", join_type="full outer", use_threads=False)
    both = both.combine_chunks().sort_by("key")
    key, a, b = (both.column(c).combine_chunks() for c in ("key", "a", "b"))
    has_a, has_b = pc.is_valid(a), pc.is_valid(b)
    common = pc.and_(has_a, has_b)
    doc = pc.shift_right(key, pa.scalar(32, pa.int64()))

    n = len(texts)
    docs = doc.to_numpy()
    n_groups = np.bincount(docs[common.to_numpy(zero_copy_only=False)], minlength=n)
    left = _joined_by(pc.take(v.digits[0], pc.filter(a, has_a)), pc.filter(common, has_a), ",")
    right = _joined_by(pc.take(v.digits[1], pc.filter(b, has_b)), pc.filter(common, has_b), ",")
    groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_groups)).astype(np.int32)),
                                                     pc.binary_join_element_wise(left, right, "|")), ";")
    columns = {"n_a": pc.list_value_length(sides[0]), "n_b": pc.list_value_length(sides[1]), "n_groups": n_groups,
               "n_links": np.bincount(docs, minlength=n),
               "groups_sha256": [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups.to_pylist()]}
    del left, right, groups

    pair = pc.bit_wise_or(pc.shift_left(pc.cast(pc.fill_null_backward(a), pa.int64()), pa.scalar(32, pa.int64())),
                          pc.cast(pc.fill_null_backward(b), pa.int64()))
    pair = pair.dictionary_encode()
    links = pa.table({"doc": doc, "code": pair.indices}).group_by(["doc", "code"], use_threads=False).aggregate([([], "count_all")])
    links = links.rename_columns(["doc", "code", "times"]).combine_chunks().sort_by("doc")
    pairs = links.group_by("code", use_threads=False).aggregate([([], "count_all")]).rename_columns(["code", "docs"])
    return columns, links, pairs.append_column("pair", pc.take(pair.dictionary, pairs.column("code")))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Ids and texts of at most ``CHUNK_BYTES``, or of one longer text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
        start = 0
        while start < len(sizes):
            many = int(np.searchsorted(np.cumsum(sizes[start:]), CHUNK_BYTES, "right"))
            part = batch.slice(start, max(many, 1))
            yield part.column("doc_id"), part.column("text").to_pylist()
            start += max(many, 1)


def aligned_chunks(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document with its packed links, and a row per chunk and pair."""

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        v, schema = load(a_path, b_path), pa.schema([
            ("chunk", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
            ("groups_sha256", pa.string()), ("codes", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())),
            ("code", pa.int32()), ("pair", pa.int64()), ("docs", pa.int64())])

        def rows(number: int, given: dict) -> pa.RecordBatch:
            n = len(next(iter(given.values())))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, number)) if f.name == "chunk" else _as(given[f.name], f.type) if f.name in given else pa.nulls(n, f.type)
                 for f in schema], schema=schema)

        for k, (ids, texts) in enumerate(_chunks(batches)):
            number = TaskContext.get().partitionId() << 32 | k
            columns, links, pairs = align(v, texts)
            at = pa.array(np.append(0, np.cumsum(np.bincount(links["doc"].to_numpy(), minlength=len(texts)))).astype(np.int32))
            packed = {"codes": links["code"], "times": pc.cast(links["times"], pa.int32())}
            yield rows(number, {"doc_id": ids, **columns} | {c: pa.ListArray.from_arrays(at, x.combine_chunks()) for c, x in packed.items()})
            for part in pairs.to_batches(max_chunksize=50_000):
                yield rows(number, {c: part.column(c) for c in ("code", "pair", "docs")})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, CHUNK_SCHEMA)


def _as(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return pc.cast(values, kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``pair, n, best``: in how many documents the pair is linked, and whether
    no other pair of its A id has more.  A window holds the pairs of one A id,
    at most the ids of B."""
    total = chunks.where("pair is not null").groupBy("pair").agg(F.sum("docs").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    return total.select("pair", "n", (F.col("n") == most).alias("best"))


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its numbers of tokens, groups and links, how many links are
    their A id's most frequent, the sum of their counts, and a digest of the groups."""
    chunks = written(aligned_chunks(docs, a_path, b_path, id_col, text_col), "token-alignment")
    pairs = chunks.where("pair is not null").select("chunk", "code", "pair")
    known = pairs.join(pair_counts(chunks), "pair").select(F.col("chunk").alias("of"), "code", "n", "best")

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        n, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        code = right["code"].to_numpy()
        n[code], best[code] = right["n"].to_numpy(), right["best"].to_numpy(zero_copy_only=False)
        codes, times = left["codes"].combine_chunks(), left["times"].combine_chunks().flatten().to_numpy()
        at, flat = np.append(0, np.cumsum(pc.list_value_length(codes).to_numpy())), codes.flatten().to_numpy()
        sums = [np.append(0, np.cumsum(x[flat] * times)) for x in (best, n)]
        out = left.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        for name, total in zip(("n_best", "count_sum"), sums):
            out = out.append_column(name, pa.array(total[at[1:]] - total[at[:-1]]))
        return out.append_column("groups_sha256", left["groups_sha256"])

    rows = chunks.where("pair is null").drop("code", "pair", "docs")
    return rows.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(look_up, RESULT)
