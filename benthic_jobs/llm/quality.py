"""A quality classifier: a sparse ensemble of rules over text statistics, compiled into Spark columns.

Shallow trees are boosted on bootstrap samples of the labelled rows; every path from a root to a node becomes a
conjunctive rule. A logistic model with a lasso penalty weighs the rules and drops most of them, and what is left is
one Spark expression over the statistics of a text: ``1 / (1 + exp(-(bias + sum of the weights of the rules that
hold))))``. The statistics cover the whole text and come from one pass over its bytes and words.

The model is fitted on ``sample`` labelled rows at most, those with the smallest hashes of their ids (a documented
bound; the rows that are scored have none). Labels of a document that disagree count as their mean, rounded. A null text is empty,
and empty texts have statistics (zeros) and so a score. With one class, or too few rows for a
rule, the score is the label's share.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free_name

SAMPLE = 20_000
STATISTICS = (
    "log_words", "word_length", "upper", "digit", "symbol", "bang", "bar", "punct", "wide", "line_length", "distinct_words",
    "top_word", "adjacent_equal", "distinct_lines", "marked_words", "short_words", "distinct_pairs", "control",
)


def _chars(chars: str) -> np.ndarray:
    out = np.zeros(256)
    out[[ord(c) for c in chars]] = 1
    return out


_UPPER, _DIGIT = _chars("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _chars("0123456789")
_LOWER, _SYMBOL = _chars("abcdefghijklmnopqrstuvwxyz"), _chars("#$%&*^~_=+<>{}[]\\@/")
_PUNCT = _chars(".,;:?!'\"()-")
_CONTROL = np.where(np.arange(256) < 32, 1.0, 0) - _chars("\t\n\r")
_WIDE = np.where(np.arange(256) >= 128, 1.0, 0)
_KINDS = np.stack([_UPPER, _LOWER, _DIGIT, _SYMBOL, _chars("!"), _chars("|"), _PUNCT, _WIDE, _CONTROL], axis=1)
_MARKS = frozenset(b"#$%&*!|^~_=+<>@")


def statistics(text: str | None) -> list[float]:
    """The figures named in ``STATISTICS`` of one text; all lie in a bounded range but the logarithm and lengths."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n = max(1, len(words))
    upper, lower, digit, symbol, bang, bar, punct, wide, control = np.bincount(
        np.frombuffer(raw, np.uint8), minlength=256
    ) @ _KINDS
    size = max(1, len(raw))
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    pairs = set(zip(words, words[1:]))
    return [
        float(np.log1p(len(words))), sum(map(len, words)) / n, upper / max(1, upper + lower), digit / size, symbol / size,
        bang / size, bar / size, punct / size, wide / size, np.log1p(len(words) / max(1, len(lines))), len(counts) / n,
        max(counts.values(), default=0) / n, sum(map(bytes.__eq__, words, words[1:])) / n, len(set(lines)) / max(1, len(lines)),
        sum(w[-1] in _MARKS for w in words) / n, sum(len(w) <= 3 for w in words) / n, len(pairs) / max(1, n - 1), control / size,
    ]


def with_statistics(docs: DataFrame, text_col: str = "text", stats: str = "stats") -> DataFrame:
    """``docs`` with the statistics as an array column."""

    @F.pandas_udf("array<double>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([statistics(t) for t in texts], dtype=object)

    return docs.withColumn(stats, measure.asNondeterministic()(F.col(text_col)))


Rule = tuple[tuple[int, bool, float], ...]


def _tree(x: np.ndarray, residual: np.ndarray, cuts: list[np.ndarray], depth: int, least: int) -> list[tuple[Rule, np.ndarray, float]]:
    """A regression tree: every node but the root as (path, rows, mean); splits minimise the squared error."""
    nodes: list[tuple[Rule, np.ndarray, float]] = []

    def grow(rows: np.ndarray, path: Rule) -> None:
        if path:
            nodes.append((path, rows, float(residual[rows].mean())))
        if len(path) == depth or len(rows) < 2 * least:
            return
        r, best = residual[rows], (1e-9, None)
        total = r.sum()
        for f, edges in enumerate(cuts):
            if not len(edges):
                continue
            bin_of = np.searchsorted(edges, x[rows, f], side="left")  # bin b: value <= edges[b]
            n = np.cumsum(np.bincount(bin_of, minlength=len(edges) + 1))[:-1]
            s = np.cumsum(np.bincount(bin_of, r, len(edges) + 1))[:-1]
            ok = (n >= least) & (len(rows) - n >= least)
            gain = np.where(ok, s**2 / np.maximum(n, 1) + (total - s) ** 2 / np.maximum(len(rows) - n, 1) - total**2 / len(rows), 0)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (f, float(edges[k])))
        if best[1]:
            f, edge = best[1]
            low = x[rows, f] <= edge
            grow(rows[low], (*path, (f, True, edge)))
            grow(rows[~low], (*path, (f, False, edge)))

    grow(np.arange(len(x)), ())
    return nodes


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.all([(x[:, f] <= t) == low for f, low, t in rule], axis=0)


def grow_rules(x: np.ndarray, y: np.ndarray, *, trees: int = 40, depth: int = 3, rate: float = 0.3, seed: int = 7) -> list[Rule]:
    """The paths of boosted trees, each grown on a bootstrap half of the rows."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(c, np.linspace(0.01, 0.99, 64), method="nearest")) for c in x.T]
    score, found = np.zeros(len(x)), {}
    for _ in range(trees):
        rows = rng.choice(len(x), max(2, len(x) // 2))
        residual = y - 1 / (1 + np.exp(-score))
        for path, _, mean in _tree(x[rows], residual[rows], cuts, depth, max(5, len(x) // 400)):
            found.setdefault(tuple(sorted(set(path))), None)
            if len(path) == depth:
                score += rate * 4 * mean * holds(path, x)
    return list(found)


def lasso_logistic(z: np.ndarray, y: np.ndarray, *, penalty: float = 1e-3, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Bias and sparse weights, by accelerated proximal gradient steps on the mean log loss."""
    n, k = z.shape
    base = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    bias, w = np.log(base / (1 - base)), np.zeros(k)
    step = 4.0 / (np.linalg.norm(np.column_stack([np.ones(n), z]), 2) ** 2 / n)
    at_b, at_w, t = bias, w.copy(), 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(at_b + z @ at_w))) - y
        new_b, raw = at_b - step * error.mean(), at_w - step * (z.T @ error) / n
        new_w = np.sign(raw) * np.maximum(np.abs(raw) - step * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        at_b, at_w = new_b + (t - 1) / t_new * (new_b - bias), new_w + (t - 1) / t_new * (new_w - w)
        bias, w, t = new_b, new_w, t_new
    return float(bias), w


class RuleModel:
    """Rules with weights; ``column`` is the score as a Spark expression over ``stats``."""

    def __init__(self, bias: float, rules: list[tuple[Rule, float]]) -> None:
        self.bias, self.rules = bias, rules

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, *, penalty: float = 1e-3) -> RuleModel:
        rules = grow_rules(x, y) if len(y) and y.min() < y.max() else []
        if not rules:
            share = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
            return cls(float(np.log(share / (1 - share))), [])
        bias, weights = lasso_logistic(np.column_stack([holds(r, x) for r in rules]).astype(float), y, penalty=penalty)
        return cls(bias, [(rules[i], float(weights[i])) for i in np.flatnonzero(np.abs(weights) > 1e-6)])

    def column(self, stats: str = "stats") -> Column:
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            each = [F.col(stats)[f] <= F.lit(t) if low else F.col(stats)[f] > F.lit(t) for f, low, t in rule]
            whole = each[0]
            for c in each[1:]:
                whole = whole & c
            total = total + F.when(whole, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def training_labels(labels: DataFrame, kind: str, *, train: Column, sample: int) -> DataFrame:
    """At most ``sample`` labelled ids: those with the smallest hashes among the rows that may be learned from."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(kind).isNotNull()).where(train)
    known = known.groupBy("doc_id").agg(F.round(F.avg(kind)).cast("double").alias("label"))
    return known.orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(sample)


def fold(divisor: int, held: int) -> Column:
    """Whether the row is held out: crc32 of the id as text, modulo ``divisor``."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == held, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, kind: str = "quality", train: Column | None = None, sample: int = SAMPLE) -> RuleModel:
    some = training_labels(labels, kind, train=F.lit(True) if train is None else train, sample=sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")  # some: at most ``sample`` ids and labels
    got = with_statistics(rows).select("doc_id", "stats", "label").orderBy("doc_id", "stats").collect()
    x = np.array([r["stats"] for r in got], float).reshape(len(got), len(STATISTICS))
    return RuleModel.fit(x, np.array([r["label"] for r in got], float))


def scored(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``docs`` with ``score``, which replaces a column of that name, and no other; the statistics are computed once for each row."""
    stats = free_name(docs, "__stats")
    return with_statistics(docs, stats=stats).withColumn("score", model.column(stats)).drop(stats)


def keep_good(docs: DataFrame, labels: DataFrame, *, least: float = 0.5) -> DataFrame:
    """Without the documents whose score says that label 0 is likelier. All columns stay as they are.

    Null and empty texts are scored like any other; repeated rows share their fate; without labels every row stays.
    """
    model = fit(docs, labels)
    stats = free_name(docs, "__stats")
    return with_statistics(docs, stats=stats).where(model.column(stats) >= least).drop(stats)
