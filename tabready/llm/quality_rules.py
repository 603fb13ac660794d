"""Quality rules: text statistics, a base rule, and a learned decision list.

``text_statistics`` counts words, symbols and repetitions of each whole text.
``learn_decision_list`` runs sequential covering on labelled statistics: it
grows a conjunction of thresholds by FOIL gain on two thirds of the rows,
prunes it on the other third, keeps it if it is precise there, removes what it
covers, and repeats.  ``DecisionList.column`` emits the ordered rules as one
Spark conditional expression.

Defined results: a null or empty text has no words, fails the base rule and is
dropped; repeated rows get equal results; with an empty or one-sided label
table the list is empty and the base rule alone decides; further columns of
the inputs are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabready.llm.common import releasing, written

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SEPARATORS = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_lines")
#: What the rules may test: ratios, so that a rule means the same at every length.
FEATURES = {
    "mean_word_chars": "try_divide(word_chars, n_words)",
    "symbols_per_word": "try_divide(n_symbols, n_words)",
    "dup_line_share": "try_divide(n_dup_lines, n_lines)",
    "repeat_share": "try_divide(n_repeat_words, n_words)",
    "distinct_share": "try_divide(n_distinct_words, n_words)",
    "words_per_line": "try_divide(n_words, n_lines)",
    "n_words": "CAST(n_words AS DOUBLE)",
}
#: Bound of the labelled rows that the driver learns from.
MAX_TRAINING_ROWS = 50_000


def repeated_words(words: list[str]) -> int:
    """Words inside 3-word windows that the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    covered, reach = 0, 0
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered += i + 3 - max(i, reach)
            reach = i + 3
    return covered


def count_text(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one text."""
    text = text or ""
    words = WORD.findall(text)
    seen: set[str] = set()
    lines = repeats = 0
    for line in text.split("\n"):
        if line.strip(SEPARATORS):
            lines += 1
            repeats += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), repeats, repeated_words(words),
            len(set(words)), lines)


def _counts(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([count_text(t) for t in batch], columns=list(COUNTS), dtype="int64")


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` with ``COUNTS`` and ``base_failed``, one row per input row."""
    counts = F.pandas_udf(releasing(_counts), ", ".join(f"{c} long" for c in COUNTS))
    return (docs.select(F.col(id_col).alias("doc_id"), counts(F.col(text_col)).alias("c")).select("doc_id", "c.*")
            .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))


@dataclass(frozen=True)
class Condition:
    feature: str
    op: str  # "<=" or ">"
    threshold: float

    def mask(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] <= self.threshold if self.op == "<=" else x[self.feature] > self.threshold

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        test = value <= F.lit(self.threshold) if self.op == "<=" else value > F.lit(self.threshold)
        return F.coalesce(test, F.lit(False))

    def __str__(self) -> str:
        return f"{self.feature} {self.op} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Rules in order; a row that none fits is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def column(self) -> Column:
        """The text of the first rule that rejects the row, else null."""
        out = F.lit(None).cast("string")
        for rule in reversed(self.rules):
            test = rule[0].column()
            for c in rule[1:]:
                test = test & c.column()
            out = F.when(test, F.lit(" and ".join(map(str, rule)))).otherwise(out)
        return out


def _fits(rule: list[Condition], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.mask(x)
    return out


def _best_condition(x, bad, covered, cuts) -> tuple[float, Condition | None]:
    p0, n0 = int((bad & covered).sum()), int((~bad & covered).sum())
    base = np.log2(p0 / (p0 + n0))
    best, found = 0.0, None
    for name, values in x.items():
        thresholds = cuts[name]
        if not len(thresholds):
            continue
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        cell = np.searchsorted(edges, values[covered], side="left") - 1  # (edge i, edge i + 1]
        low_p = np.cumsum(np.bincount(cell[bad[covered]], minlength=len(edges) - 1))[:-1]
        low_n = np.cumsum(np.bincount(cell[~bad[covered]], minlength=len(edges) - 1))[:-1]
        for op, p, n in (("<=", low_p, low_n), (">", p0 - low_p, n0 - low_n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / np.maximum(p + n, 1)) - base), 0.0)
            k = int(np.argmax(gain))
            if gain[k] > best + 1e-12:
                best, found = float(gain[k]), Condition(name, op, float(thresholds[k]))
    return best, found


def learn_decision_list(features: pd.DataFrame, bad: np.ndarray, max_rules: int = 12, max_conditions: int = 4,
                        min_precision: float = 0.8, min_covered: int = 5, cuts_per_feature: int = 256) -> DecisionList:
    """Sequential covering of the rows where ``bad`` holds."""
    x = {c: np.nan_to_num(features[c].to_numpy(float)) for c in FEATURES}
    bad = np.asarray(bad, bool)
    grow = np.arange(len(bad)) % 3 != 2  # rows come in hash order, so this is a random third
    left, out = np.ones(len(bad), bool), DecisionList()
    cuts = {}
    for name, values in x.items():
        distinct = np.unique(values)
        if len(distinct) > cuts_per_feature:
            distinct = np.unique(np.quantile(distinct, np.linspace(0, 1, cuts_per_feature)))
        cuts[name] = (distinct[1:] + distinct[:-1]) / 2
    while len(out.rules) < max_rules and (bad & left & grow).sum() >= min_covered:
        rule: list[Condition] = []
        covered = left & grow
        while len(rule) < max_conditions and (~bad & covered).any() and (bad & covered).any():
            _, found = _best_condition(x, bad, covered, cuts)
            if found is None:
                break
            rule.append(found)
            covered &= found.mask(x)

        def worth(r):
            hit = _fits(r, x, len(bad)) & left & ~grow
            p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
            return (p - n) / (p + n) if p + n else -1.0

        if not rule:
            break
        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)))
        hit = _fits(rule, x, len(bad)) & left
        if (hit & bad).sum() < min_covered or (hit & bad).sum() < min_precision * hit.sum():
            break
        out.rules.append(rule)
        left &= ~hit
    return out


def train(statistics: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
          max_rows: int = MAX_TRAINING_ROWS) -> DecisionList:
    """Learn from at most ``max_rows`` labelled rows that pass the base rule, in
    hash order; ``label_col`` 0 is bad, rows without a label are left out."""
    labelled = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).dropna()
    rows = (statistics.where(~F.col("base_failed")).join(labelled, "doc_id")
            .select("doc_id", "label", *(F.expr(c).cast("double").alias(f"f_{n}") for n, c in FEATURES.items()))
            .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows).toPandas())
    features = rows[[f"f_{n}" for n in FEATURES]].set_axis(list(FEATURES), axis=1)
    return learn_decision_list(features, (rows["label"] == 0).to_numpy())


def apply_rules(statistics: DataFrame, rules: DecisionList) -> DataFrame:
    """Add ``kept`` and ``rule``, the text of the rule that rejected the row."""
    return (statistics.withColumn("rule", F.when(F.col("base_failed"), F.lit("base")).otherwise(rules.column()))
            .withColumn("kept", F.col("rule").isNull()))


def quality_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality") -> DataFrame:
    """Statistics, base rule and learned verdict of every document.  The texts
    are read once; learning and verdict read the written statistics."""
    statistics = written(text_statistics(docs, id_col, text_col), "quality")
    return apply_rules(statistics, train(statistics, labels, id_col, label_col))
