"""BPE encoding and decoding with a public vocabulary file.

Text is split at special tokens, normalised (NFC, lower case), cut into words
and mapped to byte symbols.  Within a word, the leftmost adjacent pair of lowest
rank merges until none is left.  Short words, nearly all, look through their few
ranks for it; in a longer one a segment tree over the ranks has it at its root and
each merge updates at most three leaves, so n bytes take O(n log n) steps.
Words repeat, so a worker keeps the ids of a bounded number of them.

Letters, numbers and cases follow this Python's Unicode tables.  A text with a
code point that they do not know yet (rare) is cut into words by the tokenizers
library, whose tables may be newer; merging stays the same.

Defined results: a null text counts as empty and has no ids; the empty text
decodes to the empty text; text of any length is encoded whole; repeated rows
get equal results; further columns are ignored.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabready.llm.common import releasing

#: Words whose ids a worker keeps (at most twice as many: those met since the
#: last change of generation and those of the one before), and the longest word
#: (in characters) it keeps.
KEPT_WORDS, KEPT_LENGTH = 160_000, 64
#: The longest word (in bytes) whose ranks are looked through for each merge.
SHORT_WORD = 64
NO_PAIR = 1 << 60

# The word pattern of this vocabulary.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")


def byte_symbols() -> list[str]:
    """Printable bytes stand for themselves; the others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    extra = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class RankTree:
    """Ranks of the pairs of a word.  Every node holds the least rank below it;
    the root's holder is found by going down to the left where both sides tie."""

    def __init__(self, ranks: list[int]):
        size = 1
        while size < len(ranks):
            size *= 2
        self.size = size
        self.node = [NO_PAIR] * size + ranks + [NO_PAIR] * (size - len(ranks))
        for i in range(size - 1, 0, -1):
            self.node[i] = min(self.node[2 * i], self.node[2 * i + 1])

    def first_lowest(self) -> int:
        """The position of the leftmost lowest rank, or -1."""
        node, i = self.node, 1
        if node[1] == NO_PAIR:
            return -1
        while i < self.size:
            i *= 2
            if node[i] > node[i + 1]:
                i += 1
        return i - self.size

    def put(self, position: int, rank: int) -> None:
        node, i = self.node, position + self.size
        node[i] = rank
        i //= 2
        while i:
            least = min(node[2 * i], node[2 * i + 1])
            if node[i] == least:
                break
            node[i] = least
            i //= 2


class Bpe:
    """Encoder and decoder over one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        #: The rank of a pair of ids a, b, under a * base + b, and the id that a rank makes.
        self.base = 1 + max(self.vocab.values())
        self.ranks = {self.vocab[a] * self.base + self.vocab[b]: rank for rank, (a, b) in enumerate(model["merges"])}
        self.made = [self.vocab[a + b] for a, b in model["merges"]]
        symbols = byte_symbols()
        self.inner = [self.vocab[s] for s in symbols]
        self.last = [self.vocab[s + self.suffix] for s in symbols]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self._kept: dict[str, tuple[bytes, int, str]] = {}
        self._before: dict[str, tuple[bytes, int, str]] = {}

    def forget(self) -> None:
        """Drop the kept words."""
        self._kept, self._before = {}, {}

    def merge_word(self, word: str) -> list[int]:
        """The ids of one word."""
        data = word.encode("utf-8", "replace")
        ids = [self.inner[b] for b in data]
        ids[-1] = self.last[data[-1]]
        return self._merge_short(ids) if len(ids) <= SHORT_WORD else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        get, base, made = self.ranks.get, self.base, self.made
        ranks = [get(a * base + b, NO_PAIR) for a, b in zip(ids, ids[1:])]
        while ranks and (low := min(ranks)) != NO_PAIR:
            i = ranks.index(low)
            ids[i] = new = made[low]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(new * base + ids[i + 1], NO_PAIR)
            if i:
                ranks[i - 1] = get(ids[i - 1] * base + new, NO_PAIR)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        ranks, base, n = self.ranks, self.base, len(ids)
        rank = lambda a, b: ranks.get(a * base + b, NO_PAIR)
        tree = RankTree([rank(a, b) for a, b in zip(ids, ids[1:])])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        while (i := tree.first_lowest()) >= 0:
            j = after[i]
            ids[i] = self.made[ranks[ids[i] * base + ids[j]]]
            alive[j] = False
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                tree.put(i, rank(ids[i], ids[k]))
            else:
                tree.put(i, NO_PAIR)
            if j < n - 1:
                tree.put(j, NO_PAIR)
            if before[i] >= 0:
                tree.put(before[i], rank(ids[before[i]], ids[i]))
        return [x for x, y in zip(ids, alive) if y]

    def _word(self, word: str) -> tuple[bytes, int, str]:
        """A word that is not among the recently met."""
        out = self._kept.get(word) or self._before.get(word)
        if out is None:
            ids = self.merge_word(word)
            out = array("I", ids).tobytes(), len(ids), self.decode(ids)
        if len(word) <= KEPT_LENGTH:
            if len(self._kept) >= KEPT_WORDS:
                self._before, self._kept = self._kept, {}
            self._kept[word] = out
        return out

    def pieces(self, text: str) -> list[tuple[bytes, int, str]]:
        """Packed ids, their number and their decoded text, word by word."""
        make, out = self._word, []
        for k, part in enumerate(self.cut.split(text) if "<|" in text else [text]):
            if k % 2:
                out.append((array("I", [self.special[part]]).tobytes(), 1, part))
                continue
            words = self.words(part)
            known = map(self._kept.get, words)
            out += [piece or make(word) for piece, word in zip(known, words)]
        return out

    def words(self, part: str) -> list[str]:
        """The normalised words of a text without special tokens."""
        if not part.isascii() and any(c > "\u024f" and unicodedata.category(c) == "Cn" for c in set(part)):
            library = library_of(self.path)
            pre = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(part))
            byte = {s: b for b, s in enumerate(byte_symbols())}
            return [bytes(byte[c] for c in word).decode("utf-8") for word, _ in pre]
        # str.lower() has a special final sigma; the vocabulary's rule goes letter by letter
        return WORD.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())

    def encode(self, text: str | None) -> list[int]:
        return array("I", b"".join(p[0] for p in self.pieces(text or ""))).tolist()

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by one space, special ones included."""
        return " ".join([self.token[i] for i in ids if i in self.token])


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """The vocabulary, read once per worker."""
    return Bpe(path)


@contextlib.contextmanager
def tokenizer(path: str) -> Iterator[Bpe]:
    """The vocabulary for one task.  The words it has kept go when the task ends:
    the worker lives on, idle or in other operators' tasks."""
    bpe = load(path)
    try:
        yield bpe
    finally:
        bpe.forget()


@lru_cache(maxsize=2)
def library_of(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``, one row per input row."""

    @F.pandas_udf("ids array<int>, decoded string")
    @releasing
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        with tokenizer(path) as bpe:
            for batch in texts:
                ids = [bpe.encode(t) for t in batch]
                yield pd.DataFrame({"ids": ids, "decoded": [bpe.decode(x) for x in ids]})

    return docs.select(F.col(id_col).alias("doc_id"), run(F.col(text_col)).alias("r")).select("doc_id", "r.*")


def digest_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encodes and decodes as
    ``encode_texts`` does and returns digests in place of ids and text."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    @releasing
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        with tokenizer(path) as bpe:
            for batch in texts:
                rows = []
                for text in batch:
                    pieces = bpe.pieces(text or "")
                    ids, decoded = b"".join([p[0] for p in pieces]), " ".join([p[2] for p in pieces])
                    rows.append((sum([p[1] for p in pieces]), hashlib.sha256(ids).hexdigest(),
                                 hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest()))
                yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).alias("doc_id"), run(F.col(text_col)).alias("r")).select("doc_id", "r.*")
