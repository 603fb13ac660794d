"""Language identification by a linear-chain conditional random field.

Every word is a position; a run of letters is cut where its script changes, and
into stretches that fit the script, so that writing without spaces has as many
positions as its length asks for.  A position's emission scores are sums of learned weights of
its affixes, character n-grams and itself (the lexicon), hashed; transitions
between the languages of neighbouring words are learned as well.  Forward and
backward messages give each word's language probabilities, also where a text
switches; a document's language is the one with the largest sum, its score that
sum over the number of words.

Training takes a bounded sample of labelled texts (``DOCS_PER_LANGUAGE`` and
``MAX_TRAINING_CHARS`` state the bound; longer texts give pieces) and splices runs of words from
different documents, so that switches are seen.

Defined results: a null text, or one without a letter, is ``und`` with score 0,
and so is every text if nothing could be learned (an empty or unlabelled table);
repeated rows get equal results; ties go to the first language in alphabetical order; texts of any
length are labelled whole; further columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tabready.llm.common import release_memory, releasing

# The most letters of a position, by script (names of Unicode).
STRETCHES = {"Han": 2, "Hiragana": 4, "Katakana": 4, "Thai": 6, "Lao": 6, "Khmer": 6, "Myanmar": 6, "Tibetan": 6, "Latin": 40, "Cyrillic": 40,
             "Greek": 40, "Arabic": 40, "Hebrew": 40, "Devanagari": 40, "Bengali": 40, "Tamil": 40, "Hangul": 40, "Armenian": 40, "Georgian": 40}
LONGEST_WORD = 40
_LISTED = "".join(rf"\p{{{script}}}" for script in STRETCHES)
#: Positions of any text, each letter with its marks, and of one in Latin-1, which needs no look at scripts.
POSITION = regex.compile("|".join([*(rf"(?:[\p{{L}}&&\p{{{script}}}]\p{{M}}*){{1,{n}}}" for script, n in STRETCHES.items()),
                                   rf"(?:[\p{{L}}--[{_LISTED}]]\p{{M}}*){{1,{LONGEST_WORD}}}"]), regex.V1)
LATIN_POSITION = regex.compile(rf"\p{{L}}{{1,{LONGEST_WORD}}}")
UNKNOWN = "und"
BUCKETS = 1 << 17
#: Bounds of the training sample: documents of a language, characters of a
#: document, the most languages (more are an error); and pieces that a longer document gives.
DOCS_PER_LANGUAGE, MAX_TRAINING_CHARS, MAX_LANGUAGES, PIECES = 300, 20_000, 500, 4
#: Words whose scores a worker keeps; words that run through the chain at a time.
KEPT_WORDS, CHAIN_WORDS = 200_000, 200_000
#: About the most weights (features by languages) that are summed at a time.
FEATURE_WEIGHTS = 1 << 19


def crc_steps() -> np.ndarray:
    """What each byte adds to a CRC-32."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    return step


CRC_STEPS = crc_steps()


def crc_of_next(crc: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """CRC-32 states (inverted, as they run) after one more character each, in UTF-8."""
    def byte(crc: np.ndarray, b: np.ndarray) -> np.ndarray:
        return CRC_STEPS[(crc ^ b) & 0xFF] ^ (crc >> 8)

    out = byte(crc, chars)
    for least, mark, shifts in ((0x80, 0xC0, (0,)), (0x800, 0xE0, (6, 0)), (0x10000, 0xF0, (12, 6, 0))):
        if len(at := np.flatnonzero(chars >= least)):
            c = chars[at]
            state = byte(crc[at], mark | c >> 6 * len(shifts))
            for shift in shifts:
                state = byte(state, 0x80 | c >> shift & 0x3F)
            out[at] = state
    return out


def hashed_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features of all words, word by word, and how many each word
    has.  A feature's bucket is the CRC-32 of its name: ``w`` and the word; ``p``
    and its first 1 to 4 letters; ``s`` and its last 1 to 4; the 2-grams, then the
    3-grams of ``^word$``.  Names grow by a character in all words at once."""
    fenced = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32)
    n = np.array([len(w) for w in words], np.int64)
    affixes = np.minimum(n, 4)
    sizes = 2 + 2 * affixes + 2 * n
    at = np.cumsum(sizes) - sizes
    head = np.cumsum(n + 2) - (n + 2)
    out = np.zeros(sizes.sum(), np.uint32)
    out[at] = [~zlib.crc32(f"w{w}".encode("utf-8", "surrogatepass")) & 0xFFFFFFFF for w in words]
    start = {c: np.uint32(~zlib.crc32(c) & 0xFFFFFFFF) for c in (b"", b"p", b"s")}
    crc = np.full(len(words), start[b"p"])
    for k in range(1, 5):
        long = np.flatnonzero(n >= k)
        crc[long] = crc_of_next(crc[long], fenced[head[long] + k])
        out[at[long] + k] = crc[long]
        tail = np.full(len(long), start[b"s"])
        for j in range(k):
            tail = crc_of_next(tail, fenced[head[long] + n[long] + 1 - k + j])
        out[at[long] + affixes[long] + k] = tail
    # 2-grams start at all characters of ^word$ but the last, 3-grams at all but the last two
    two = np.arange(len(fenced)) - np.repeat(head, n + 2)
    word = np.repeat(np.arange(len(words)), n + 2)
    place = (at + 1 + 2 * affixes)[word] + two
    pairs = np.flatnonzero(two <= n[word])
    crc = crc_of_next(crc_of_next(np.full(len(pairs), start[b""]), fenced[pairs]), fenced[pairs + 1])
    out[place[pairs]] = crc
    more = two[pairs] < n[word[pairs]]
    triples = pairs[more]
    out[place[triples] + n[word[triples]] + 1] = crc_of_next(crc[more], fenced[triples + 2])
    return (~out % BUCKETS).astype(np.int64), sizes


def blocks_of(words: list[str], features: int) -> Iterator[list[str]]:
    """The words, with about so many features at a time."""
    sizes = np.cumsum([2 * len(w) + 10 for w in words]) // max(features, 1)
    cuts = (np.flatnonzero(np.diff(sizes)) + 1).tolist()
    for lo, hi in zip([0, *cuts], [*cuts, len(words)]):
        if lo < hi:
            yield words[lo:hi]


def word_features(word: str) -> list[int]:
    """Hashed features of one position."""
    return hashed_features([word])[0].tolist()


class Numbers(dict):
    """Words by the order in which they are met first."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def position_pattern(text: str) -> regex.Pattern:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return POSITION
    return LATIN_POSITION


def words_of(text: str | None) -> list[str]:
    """The positions of a text, in lower case."""
    if not text:
        return []
    low = text.lower()
    return position_pattern(low).findall(low)


def summed(where: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows with the same place."""
    return np.stack([np.bincount(where, rows[:, j], n) for j in range(rows.shape[1])], axis=1)


class Crf:
    """Weights of the chain: emissions by bucket and language, transitions, start."""

    def __init__(self, languages: list[str]):
        k = len(languages)
        self.languages = languages
        self.weights = np.zeros((BUCKETS, k), np.float32)
        self.transitions = np.zeros((k, k))
        self.start = np.zeros(k)
        self._index = Numbers()
        self._emit = np.zeros((0, k))

    def __getstate__(self):
        return (self.languages, self.weights, self.transitions, self.start)

    def __setstate__(self, state):
        self.languages, self.weights, self.transitions, self.start = state
        self._index, self._emit = Numbers(), np.zeros((0, len(self.languages)))

    # -- learning ---------------------------------------------------------
    def fit(self, sequences: list[tuple[list[str], list[int]]], epochs: int = 3, batch: int = 64, rate: float = 0.3,
            ridge: float = 1e-6) -> Crf:
        """Adaptive gradient ascent on the conditional log-likelihood."""
        k = len(self.languages)
        if k < 2:
            return self
        index = Numbers()
        seqs = [(np.array([index[w] for w in ws], np.int64), np.array(ys, np.int64)) for ws, ys in sequences]
        feats = [hashed_features(block) for block in blocks_of(list(index), FEATURE_WEIGHTS // k)]
        flat = np.concatenate([f for f, _ in feats])
        first = np.concatenate([[0], np.cumsum(np.concatenate([n for _, n in feats]))])
        squares, t_squares, s_squares = np.full((BUCKETS, k), 1e-8, np.float32), np.full((k, k), 1e-8), np.full(k, 1e-8)
        order = np.random.default_rng(7)
        for _ in range(epochs):
            shuffled = order.permutation(len(seqs))
            for lo in range(0, len(seqs), batch):
                part = sorted((seqs[i] for i in shuffled[lo:lo + batch]), key=lambda s: -len(s[0]))
                used, inverse = np.unique(np.concatenate([s[0] for s in part]), return_inverse=True)
                cols = np.concatenate([flat[first[w]:first[w + 1]] for w in used])
                sizes = first[used + 1] - first[used]
                owner = np.repeat(np.arange(len(used)), sizes)
                emit = np.add.reduceat(self.weights[cols].astype(float), np.cumsum(sizes) - sizes, axis=0)
                lengths = np.array([len(s[0]) for s in part])
                b, t = len(part), lengths[0]
                word, label, mask = np.zeros((b, t), np.int64), np.zeros((b, t), np.int64), np.zeros((b, t), bool)
                at = 0
                for r, (ws, ys) in enumerate(part):
                    word[r, :len(ws)], label[r, :len(ws)], mask[r, :len(ws)] = inverse[at:at + len(ws)], ys, True
                    at += len(ws)
                gamma, pairs, begin = self._expect(emit[word], mask)
                truth = np.zeros((b, t, k))
                truth[np.arange(b)[:, None], np.arange(t), label] = 1
                gap = (truth - gamma) * mask[..., None]
                by_word = summed(word[mask], gap[mask], len(used))
                touched, where = np.unique(cols, return_inverse=True)
                grad = summed(where, by_word[owner], len(touched)) / b - ridge * self.weights[touched]
                squares[touched] += grad ** 2
                self.weights[touched] += (rate * grad / np.sqrt(squares[touched])).astype(np.float32)
                seen = np.zeros((k, k))
                both = mask[:, 1:]
                np.add.at(seen, (label[:, :-1][both], label[:, 1:][both]), 1)
                g = (seen - pairs) / b
                t_squares += g ** 2
                self.transitions += rate * g / np.sqrt(t_squares)
                g = (truth[:, 0].sum(0) - begin) / b
                s_squares += g ** 2
                self.start += rate * g / np.sqrt(s_squares)
        return self

    def _expect(self, scores: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected labels, transitions and first labels of padded sequences."""
        b, t, k = scores.shape
        e = np.exp(scores - scores.max(-1, keepdims=True))
        a = np.exp(self.transitions - self.transitions.max())
        alpha, beta = np.zeros((b, t, k)), np.ones((b, t, k))
        x = np.exp(self.start - self.start.max()) * e[:, 0]
        alpha[:, 0] = x / x.sum(-1, keepdims=True)
        for i in range(1, t):
            x = (alpha[:, i - 1] @ a) * e[:, i]
            alpha[:, i] = np.where(mask[:, i, None], x / x.sum(-1, keepdims=True), alpha[:, i - 1])
        for i in range(t - 2, -1, -1):
            x = (beta[:, i + 1] * e[:, i + 1]) @ a.T
            beta[:, i] = np.where(mask[:, i + 1, None], x / x.sum(-1, keepdims=True), 1.0)
        gamma = alpha * beta
        gamma /= gamma.sum(-1, keepdims=True)
        pair = alpha[:, :-1, :, None] * a * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
        pair /= pair.sum((-1, -2), keepdims=True)
        return gamma, (pair * mask[:, 1:, None, None]).sum((0, 1)), gamma[:, 0].sum(0)

    # -- labelling --------------------------------------------------------
    def word_ids(self, texts: Iterable[list[str]]) -> list[np.ndarray]:
        """Rows of the emission table for the words of each text; rows are made
        for words not seen yet, of all texts together.  Ids hold until the next call."""
        if len(self._index) > KEPT_WORDS:
            self._index, self._emit = Numbers(), np.zeros((0, len(self.languages)))
        known, number = len(self._index), self._index.__getitem__
        out = [np.fromiter(map(number, words), np.int32, len(words)) for words in texts]
        self._learn_words(list(itertools.islice(self._index, known, None)))
        return out

    def _learn_words(self, new: list[str]) -> None:
        """Rows of the last words of the index."""
        k = len(self.languages)
        at, n = len(self._index) - len(new), len(self._index)
        if n > len(self._emit):
            grown = np.zeros((max(2 * len(self._emit), n, 1024), k))
            grown[:at] = self._emit[:at]
            self._emit = grown
        for block in blocks_of(new, FEATURE_WEIGHTS // max(k, 1)):
            feats, sizes = hashed_features(block)
            sums = np.add.reduceat(self.weights[feats].astype(float), np.cumsum(sizes) - sizes, axis=0)
            self._emit[at:at + len(block)] = np.exp(np.maximum(sums - sums.max(1, keepdims=True), -300))
            at += len(block)

    def _groups(self, ids: list[np.ndarray]) -> Iterator[list[int]]:
        """Texts of similar length, some words at a time, longest first."""
        order, at = sorted((i for i, t in enumerate(ids) if len(t)), key=lambda i: -len(ids[i])), 0
        while at < len(order):
            group, size = [], 0
            while at < len(order) and (not group or size + len(ids[order[at]]) <= CHAIN_WORDS):
                group.append(order[at])
                size += len(ids[order[at]])
                at += 1
            yield group

    def posteriors(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Language probabilities of every word of every text."""
        ids = self.word_ids(texts)
        out: list[np.ndarray] = [np.zeros((0, len(self.languages)))] * len(ids)
        for group in self._groups(ids):
            p, major = self._chain([ids[i] for i in group])
            minor = np.empty_like(p)
            minor[major] = p
            for i, part in zip(group, np.split(minor, np.cumsum([len(ids[i]) for i in group])[:-1])):
                out[i] = part
        return out

    def _chain(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Language probabilities of all words, side by side: all first words,
        all second words, ...; and the place of each in the texts' order.  The
        texts come longest first."""
        lengths = np.array([len(t) for t in texts])
        rows = np.concatenate(texts)
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        # position-major order: all first words, all second words, ...
        step = np.arange(lengths.sum()) - np.repeat(first, lengths)
        major = np.argsort(step, kind="stable")
        e = self._emit[rows[major]]
        active = np.bincount(step)
        off = np.concatenate([[0], np.cumsum(active)])
        a = np.exp(self.transitions - self.transitions.max())
        alpha = np.empty_like(e)
        x = np.exp(self.start - self.start.max()) * e[:off[1]]
        alpha[:off[1]] = x / x.sum(1, keepdims=True)
        for t in range(1, len(active)):
            n = active[t]
            x = (alpha[off[t - 1]:off[t - 1] + n] @ a) * e[off[t]:off[t + 1]]
            alpha[off[t]:off[t + 1]] = x / x.sum(1, keepdims=True)
        beta = np.ones((len(texts), len(self.languages)))
        back = a.T.copy()
        for t in range(len(active) - 1, 0, -1):
            n = active[t]
            x = (beta[:n] * e[off[t]:off[t + 1]]) @ back
            alpha[off[t]:off[t + 1]] *= beta[:n]
            beta[:n] = x / x.sum(1, keepdims=True)
        alpha[:off[1]] *= beta
        alpha /= alpha.sum(1, keepdims=True)
        return alpha, major

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text."""
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        out = [(UNKNOWN, 0.0)] * len(texts)
        ids = self.word_ids(map(words_of, texts))
        for group in self._groups(ids):
            p, major = self._chain([ids[i] for i in group])
            lengths = np.array([len(ids[i]) for i in group])
            sums = summed(np.repeat(np.arange(len(group)), lengths)[major], p, len(group))
            best = sums.argmax(1)
            for i, k, total, n in zip(group, best, sums.max(1), lengths):
                out[i] = self.languages[k], float(min(1.0, total / n))
        return out

    def runs(self, text: str | None) -> list[tuple[int, int, str]]:
        """Stretches of one language: (start, end, language) in characters."""
        if not text or not self.languages:
            return []
        low = text if len(text.lower()) != len(text) else text.lower()
        spans = [m.span() for m in position_pattern(low).finditer(low)]
        labels = self.posteriors([[low[a:b].lower() for a, b in spans]])[0].argmax(1) if spans else []
        out: list[tuple[int, int, str]] = []
        for (a, b), k in zip(spans, labels):
            if out and out[-1][2] == self.languages[k]:
                out[-1] = (out[-1][0], b, out[-1][2])
            else:
                out.append((a, b, self.languages[k]))
        return out


def spliced(texts: list[tuple[list[str], int]], longest: int = 64) -> list[tuple[list[str], list[int]]]:
    """Training sequences that hold every word once: each text is cut into runs,
    and runs are joined to sequences, half of them across texts."""
    rng = np.random.default_rng(11)
    runs = []
    for words, y in texts:
        at = 0
        while at < len(words):
            n = int(rng.integers(4, 48))
            runs.append((words[at:at + n], y))
            at += n
    kept, mixed = [], []
    for run in runs:
        (mixed if rng.random() < 0.5 else kept).append(run)
    mixed = [mixed[i] for i in rng.permutation(len(mixed))]
    out: list[tuple[list[str], list[int]]] = [(ws, [y] * len(ws)) for ws, y in kept]
    ws, ys = [], []
    for run, y in mixed:
        ws, ys = ws + run, ys + [y] * len(run)
        if len(ws) >= longest:
            out.append((ws, ys))
            ws, ys = [], []
    return out + ([(ws, ys)] if ws else [])


def held_out(id_col: str) -> Column:
    """True where crc32 of the id as text leaves 1 modulo 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    per_language: int = DOCS_PER_LANGUAGE) -> list[Row]:
    """``lang, pieces`` of at most ``per_language`` labelled documents of each
    language that have a letter and are not held out: those with the least hash
    of id and text.  Repeats of a row count once.  A text of more than
    ``MAX_TRAINING_CHARS`` gives ``PIECES`` pieces of together that length: one
    from its first letter, and one from each further part of it."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        ~held_out(id_col) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", "text", F.xxhash64("id", "text").alias("key"))
    counts = (rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("key").alias("distinct"))
              .orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES + 1).collect())
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"the documents are labelled with more than {MAX_LANGUAGES} languages")
    # the least hashes of about twice as many documents as are taken, so that the window orders a few rows only
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, 2.0 * (per_language + 10) / max(r["distinct"], 1)))).otherwise(share)
    length, piece = F.char_length("text"), MAX_TRAINING_CHARS // PIECES
    part = F.floor(length / PIECES).cast("int")
    starts = [F.regexp_instr("text", F.lit(r"(\p{L})")), *(F.lit(1) + k * part + F.pmod("key", part - piece + 1).cast("int") for k in range(1, PIECES))]
    pieces = F.when(length <= MAX_TRAINING_CHARS, F.array("text")).otherwise(F.array(*(F.substring("text", at, F.lit(piece)) for at in starts)))
    order = F.pmod("key", F.lit(1 << 20)) / (1 << 20)
    drawn = rows.where(order < share).select("lang", "key", pieces.alias("pieces")).dropDuplicates(["lang", "key"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("key", F.lit(1 << 20)), "key"))
    return drawn.withColumn("rank", rank).where(F.col("rank") <= per_language).orderBy("lang", "rank").select("lang", "pieces").collect()


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = DOCS_PER_LANGUAGE) -> Crf:
    """Learn from ``training_sample``."""
    sample = training_sample(docs, id_col, text_col, lang_col, per_language)
    texts = [(words_of(p), r.lang) for r in sample for p in r.pieces]
    languages = sorted({lang for words, lang in texts if words})
    y = {lang: k for k, lang in enumerate(languages)}
    model = Crf(languages).fit(spliced([(words, y[lang]) for words, lang in texts if words]))
    del sample, texts
    release_memory()
    return model


def predictions(model: Crf, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of each text, two million characters at a time."""
    out: list[tuple[str, float]] = []
    size = first = 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size > 1 << 21 or k == len(texts) - 1:
            out += model.predict(texts[first:k + 1])
            size, first = 0, k + 1
    return out


def prediction(model: Crf, text: Column) -> Column:
    """``lang_pred`` and ``score`` of a text column, as a struct."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(predictions(model, batch.tolist()), columns=["lang_pred", "score"]).astype({"score": "float64"})

    return F.pandas_udf(releasing(run), "lang_pred string, score double")(text)


def predict_language(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``, one row per input row."""
    return (docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                        prediction(model, F.col(text_col)).alias("p")).select("doc_id", "held_out", "p.*"))


def label_runs(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, end, lang``: the stretches of one language of each text."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[dict(zip(("start", "end", "lang"), r)) for r in model.runs(t)] for t in batch], dtype="object")

    runs = F.pandas_udf(releasing(run), "array<struct<start: long, end: long, lang: string>>")(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), F.explode(runs).alias("r")).select("doc_id", "r.*")


def known_language(docs: DataFrame, model: Crf, text_col: str = "text") -> DataFrame:
    """The rows that get a language, all columns kept.  The score is the share
    of the main language, which is small for clean texts of several languages,
    so it does not decide."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([lang != UNKNOWN for lang, _ in predictions(model, batch.tolist())], dtype="bool")

    return docs.where(F.pandas_udf(releasing(run), "boolean")(docs[text_col]))
