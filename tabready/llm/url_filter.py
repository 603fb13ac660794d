"""URL filter: path rules first, then logistic regression on hashed character
n-grams of host and path.

Rules are (host, path, verdict): a rule fits its host and all subdomains when
the url's path starts with the rule's path, and the longest rule (host and path
together) wins.  The rule list is configuration of at most ``MAX_RULES`` rows
and becomes one Spark conditional expression.

Defined results: a null url, or one without ``://``, has an empty host and path
and is allowed unless a rule fits; urls of any length are read whole; repeated urls
get equal results; of equally long rules that fit, the first in alphabetical order
wins; a score of exactly the threshold blocks; an empty table gives an empty result;
a training table that is empty or has one class only allows everything; further
columns are ignored.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabready.llm.common import releasing

MAX_RULES = 1000
DIMENSIONS = 1 << 16
#: Bound of the labelled urls that the driver learns from.
MAX_TRAINING_ROWS = 20_000
GRAMS = (3, 4, 5)

# Words of the labelled training urls, one kind of site per line.
BLOCKED = """
casino slots poker bet bets betting roulette jackpot blackjack bingo lotto gambling sportsbook wager
porn xxx sex adult nude cams escort hentai erotic hookup fetish milf videos-xxx webcam-girls singles-hot
viagra cialis pills meds rx levitra xanax tramadol steroids cheap-meds pharmacy-rx
warez crack keygen torrent nulled cracked serials
payday loans cash-advance fast-loans quick-credit
adserver ads-track ad-click clicktrack popads pixel banner-ads track-ads
backlinks linkfarm link-farm spam seo-links content-farm followers
replica fake-watches counterfeit
win-prize free-money claim-prize crypto-double double-coins get-rich
""".split()
ALLOWED = """
library university school museum weather gardening recipes history archive institute academy college
physics railway health travel chess cinema music birds tax parliament court farm speech education wildlife
mathematics theory lights tongue together station teachers translation inventions thoughts islands nature repairs
letters family handbook knitting books painting astronomy sailing theatre poetry language grammar novels opera
angebote bahnhof zeitung kirche rathaus wetter reisen verein buch gesundheit hochschule
mairie cuisine voyage livre actualites culture lycee jardin
noticias ayuntamiento cocina viajes libros escuela salud
better beta between alphabet betty essex sussex adventure address adobe advice adviser cashmere classics passage
analysis caterpillar pillars crackers cracking-codes pixelart bannerman spamming-law sextant unisex-fashion seaside
winter window wine rxjs loanwords torrential trackfield tracking-parcels clicker slotcar pokerface-song
hardware software kernel docs github-pages wiki forum blog support shop-window bakery bicycle furniture shoes
""".split()
#: Words that either kind of site has.
NEUTRAL = """online free best top my the shop buy cheap club live hub zone world new big city net web info home 24 365 pro max royal lucky
daily first real super easy""".split()
DOMAINS = "com net org example.com example.net example.org info co.uk de fr es it nl ru biz xyz io pl se ch at eu us ca com.au co.jp in site top online".split()


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path, both empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def rule_column(host: Column, path: Column, rules: Iterable[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null."""
    rules = sorted(rules, key=lambda r: (-len(r.text), r.text))
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} url rules, got {len(rules)}")
    out = F.lit(None).cast("string")
    for r in reversed(rules):
        fits = ((host == F.lit(r.host)) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.lit(value(r))).otherwise(out)
    return out


def gram_buckets(host: str, path: str) -> np.ndarray:
    """Distinct hashed n-grams of host and path, each part marked and fenced."""
    out = set()
    for mark, part in (("h", host), ("p", path)):
        fenced = f"^{part}$"
        for n in GRAMS:
            for i in range(len(fenced) - n + 1):
                out.add(zlib.crc32(f"{mark}{fenced[i:i + n]}".encode()) % DIMENSIONS)
    return np.fromiter(out, np.int64, len(out))


class UrlModel:
    """Weights per bucket and a bias; each url's features have length 1."""

    def __init__(self, weights: np.ndarray | None = None, bias: float = 0.0):
        self.weights = np.zeros(DIMENSIONS, np.float32) if weights is None else weights
        self.bias = bias

    def score(self, host: str, path: str) -> float:
        """The probability that the url is to be blocked."""
        b = gram_buckets(host, path)
        z = self.bias + (float(self.weights[b].sum()) / np.sqrt(len(b)) if len(b) else 0.0)
        return float(1 / (1 + np.exp(-z)))


def fit(rows: list[tuple[str, str, int]], ridge: float = 5e-5, steps: int = 900, rate: float = 20.0) -> UrlModel:
    """Full-batch gradient descent over (host, path, 1 if blocked)."""
    y = np.array([r[2] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return UrlModel(bias=-1.0)
    buckets = [gram_buckets(h, p) for h, p, _ in rows]
    row = np.repeat(np.arange(len(rows)), [len(b) for b in buckets])
    col = np.concatenate(buckets)
    value = 1 / np.sqrt(np.bincount(row, minlength=len(rows)))[row]
    weights, bias = np.zeros(DIMENSIONS), 0.0
    balance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(steps):
        z = np.bincount(row, value * weights[col], len(rows)) + bias
        gap = balance * (1 / (1 + np.exp(-z)) - y) / len(rows)
        weights -= rate * (np.bincount(col, value * gap[row], DIMENSIONS) + ridge * weights)
        bias -= rate * gap.sum() * 0.1
    return UrlModel(weights.astype(np.float32), float(bias))


def seed_rows(per_word: int = 6, seed: int = 31) -> list[tuple[str, int]]:
    """(url, label) of the labelled table: every word in turn stands in a host (or,
    sometimes, in the path of a host without one) among words, domains, numbers and
    path forms that either kind of site has.  Names made of random syllables are
    allowed, as most sites bear names that no list holds."""
    rng = random.Random(seed)
    syllables = [a + b + c for a in ("b", "d", "f", "g", "l", "m", "n", "r", "s", "st", "t", "th", "tr", "v", "w", "") for b in "aeiou"
                 for c in ("", "n", "r", "s", "nd", "l", "th", "ng")]
    invented = ["".join(rng.choice(syllables) for _ in range(rng.randrange(2, 5))) for _ in range(len(ALLOWED))]
    prefixes = ("", "", "", "www.", "www.", "m.", "blog.", "de.", "news.", "img.")
    paths = ("", "/", "/index.html", "/en/{n}", "/de/{n}/", "/fr/{n}.html", "/es/{n}?page=2", "/{n}#top", "/{w}", "/{w}/{w}.html", "/20{y}/0{d}/{w}-{w}",
             "/p/{n}", "/{w}.php?id={n}", "/a/{w}/{n}", "/category/{w}/page/{d}")

    def host(word: str) -> str:
        other = rng.choice(NEUTRAL)
        parts = rng.choice(((word,), (word, other), (other, word), (other, word), (word, str(rng.randrange(1, 999))), (word + "s",)))
        return rng.choice(prefixes) + rng.choice(("", "-", "")).join(parts) + "." + rng.choice(DOMAINS)

    def path(words: list[str]) -> str:
        form = rng.choice(paths)
        while "{w}" in form:
            form = form.replace("{w}", rng.choice(words), 1)
        return form.format(n=rng.randrange(1, 99_999), y=rng.randrange(10, 26), d=rng.randrange(1, 10))

    out = []
    for label, words in ((1, BLOCKED), (0, ALLOWED), (0, invented)):
        for word in words:
            for k in range(per_word if not label else per_word * 2):
                if k % 6 == 5:  # the path alone tells
                    url = host(rng.choice(NEUTRAL)) + "/" + word + rng.choice(("", "/", f"/{rng.randrange(999)}"))
                else:
                    url = host(word) + path([*NEUTRAL, *(words if k % 3 == 0 else NEUTRAL)])
                out.append((f"{rng.choice(('https', 'http'))}://{url}", label))
    return out


def seed_labels(spark) -> DataFrame:
    """The labelled table that ships with the filter."""
    return spark.createDataFrame(seed_rows(), "url string, label int")


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "label", max_rows: int = MAX_TRAINING_ROWS) -> UrlModel:
    """Learn from at most ``max_rows`` labelled urls, in hash order."""
    host, path = host_path(F.col(url_col))
    rows = (labelled.where(F.col(label_col).isNotNull()).select(host.alias("host"), path.alias("path"), F.col(label_col).cast("int").alias("label"))
            .orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(max_rows).collect())
    return fit([(r.host, r.path, r.label) for r in rows])


def judge_urls(pages: DataFrame, rules: Iterable[Rule], model: UrlModel, id_col: str = "page_id", url_col: str = "url",
               threshold: float = 0.5) -> DataFrame:
    """``page_id, host, path, rule, verdict, score``, one row per input row.
    ``score`` is the model's probability of a block, given for every url."""
    rules, weights, bias = list(rules), model.weights, model.bias

    @F.pandas_udf("double")
    @releasing
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        own = UrlModel(weights, bias)
        for hosts, paths in parts:
            yield pd.Series([own.score(h, p) if h or p else 0.0 for h, p in zip(hosts, paths)], dtype="float64")

    host, path = host_path(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    scored = parts.withColumn("score", score("host", "path"))
    h, p = F.col("host"), F.col("path")
    learned = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", rule_column(h, p, rules, lambda r: r.text).alias("rule"),
                         F.coalesce(rule_column(h, p, rules, lambda r: r.verdict), learned).alias("verdict"), "score")
