"""Quality rules: gradient-boosted trees over statistics of the document.

One pass over the text makes a narrow table of statistics. The trees are fitted on a bounded sample of
labelled documents, held as flat arrays of nodes and applied to whole batches in numpy. Features of
MONOTONE may only lower the score as they rise.

Null or empty text: no words, base_failed, not kept. No labels: only the base rules decide. A document with several
labels counts by their mean, at least one half being good. Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import bounded_batches, table, utf8_bytes, written

#: At most so many labelled documents are used to fit the trees, by the hash of their id.
SAMPLE = 20_000
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "word_length", "symbols", "dup_lines", "repeats", "distinct", "upper", "digits", "marks", "word_lines"]
#: Features that may only lower the score.
MONOTONE = ("symbols", "dup_lines", "repeats", "upper", "digits")
_UPPER = bytes(range(65, 91))
_MARKS = b"!?;:,."


def statistics(text: str | None) -> tuple:
    """The five counts, then the features."""
    data = utf8_bytes(text)
    words = data.split()
    n = len(words)
    lines = data.split(b"\n")
    seen: set[bytes] = set()
    full = dup = 0
    for line in lines:
        if line.split(None, 1):
            full += 1
            dup += line in seen
            seen.add(line)
    ids: dict[bytes, int] = {}
    repeat = 0
    if n:
        code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
        if n >= 3:
            # The number of a window of two words is below n, so that of three fits too.
            _, pairs = np.unique(code[:-1] * n + code[1:], return_inverse=True)
            _, of, often = np.unique(pairs[:-1] * n + code[2:], return_inverse=True, return_counts=True)
            twice = np.flatnonzero(often[of] > 1)
            covered = np.zeros(n, bool)
            for k in range(3):
                covered[twice + k] = True
            repeat = int(covered.sum())
    chars = sum(map(len, words)) - data.translate(None, bytes(x for x in range(256) if not 0x80 <= x < 0xC0)).__len__()
    count = lambda among: len(data) - len(data.translate(None, among))
    symbols = count(SYMBOLS)
    letters = max(1, chars)
    features = (
        np.log1p(n), chars / max(1, n), symbols / letters, dup / max(1, full), repeat / max(1, n), len(ids) / max(1, n),
        count(_UPPER) / letters, count(b"0123456789") / letters, count(_MARKS) / max(1, n), n / max(1, full),
    )
    return (n, chars, symbols, dup, repeat, *map(float, features))


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the counts and the features of every row of docs (doc_id, text)."""
    bounded_batches(docs.sparkSession)
    names = COUNTS + FEATURES
    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), *(f"{c} double" for c in FEATURES)])

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [statistics(None if pd.isna(t) else t) for t in batch["text"]]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").array)
            yield out

    return docs.select("doc_id", "text").mapInPandas(measure, schema)


@dataclass
class Trees:
    """All trees in flat arrays: inner nodes have a feature, leaves -1; roots has the first node of each tree."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of each row of x; the right child follows the left one."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                inner = f >= 0
                right = x[rows, np.maximum(f, 0)] > self.threshold[node]
                node = np.where(inner, self.left[node] + right, node)
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray, y: np.ndarray, signs: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, least: int = 10
) -> Trees:
    """Boosted trees for the logistic loss on histograms. signs: -1 where the score may only fall as the feature rises.

    A split against its sign is refused, and the values below a split on such a feature stay on their side
    of the middle of both children, so every tree, and so the sum, is monotone.
    """
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    total = np.full(len(y), base)
    feature, threshold, left, value, roots = [], [], [], [], []

    def node() -> int:
        for part, start in ((feature, -1), (threshold, 0.0), (left, 0), (value, 0.0)):
            part.append(start)
        return len(feature) - 1

    def best(g, h, low, high):
        size, found = np.bincount(binned_at[:, 0], minlength=bins + 1).sum(), None
        for j, e in enumerate(edges):
            if not len(e):
                continue
            gs, hs, ns = (np.cumsum(np.bincount(binned_at[:, j], weights=w, minlength=len(e) + 1))[:-1] for w in (g, h, np.ones_like(g)))
            a, b = (np.clip(u / (v + 1.0), low, high) for u, v in ((gs, hs), (g.sum() - gs, h.sum() - hs)))
            gain = gs * a - (hs + 1) * a * a / 2 + (g.sum() - gs) * b - (h.sum() - hs + 1) * b * b / 2
            gain[(ns < least) | (size - ns < least) | (signs[j] * (b - a) < 0)] = -np.inf
            k = int(gain.argmax())
            if np.isfinite(gain[k]) and (found is None or gain[k] > found[0]):
                found = (gain[k], j, k, a[k], b[k])
        return found

    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        grad, hess = y - chance, chance * (1 - chance)
        roots.append(node())
        work = [(roots[-1], np.arange(len(y)), -4.0, 4.0, 0)]
        while work:
            at, rows, low, high, level = work.pop()
            binned_at, g, h = binned[rows], grad[rows], hess[rows]
            mine = float(np.clip(g.sum() / (h.sum() + 1.0), low, high))
            split = best(g, h, low, high) if level < depth and len(rows) >= 2 * least else None
            if split is None or split[0] <= g.sum() * mine - (h.sum() + 1) * mine * mine / 2 + 1e-6:
                value[at] = rate * mine
                total[rows] += value[at]
                continue
            _, j, k, a, b = split
            feature[at], threshold[at] = j, float(edges[j][k])
            left[at] = node()
            node()
            middle = (a + b) / 2
            bound = {-1: ((middle, high), (low, middle)), 1: ((low, middle), (middle, high)), 0: ((low, high),) * 2}[int(signs[j])]
            goes = binned_at[:, j] > k
            work.append((left[at], rows[~goes], *bound[0], level + 1))
            work.append((left[at] + 1, rows[goes], *bound[1], level + 1))
    arrays = (np.array(feature, int), np.array(threshold), np.array(left, int), np.array(value), np.array(roots, int))
    return Trees(*arrays, depth, base)


def fit_on_labels(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees | None:
    """Trees fitted on at most ``sample`` labelled documents; None if one class is missing."""
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.avg("quality") >= 0.5).alias("good"))
    chosen = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = stats.join(chosen, "doc_id").select("good", *FEATURES).limit(2 * sample).toPandas()
    rows = rows.sort_values(["good", *FEATURES])
    y = rows["good"].to_numpy(float)
    if len(y) < 40 or y.min() == y.max():
        return None
    signs = np.array([-1 if f in MONOTONE else 0 for f in FEATURES])
    return fit(rows[FEATURES].to_numpy(float), y, signs)


def with_verdict(stats: DataFrame, trees: Trees | None, least: float = 0.5) -> DataFrame:
    """doc_id, counts, base_failed, kept and quality_score of every row."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = stats.withColumn("base_failed", failed)
    if trees is None:
        return stats.select("doc_id", *COUNTS, "base_failed", (~failed).alias("kept"), F.lit(None).cast("double").alias("quality_score"))
    spread = stats.sparkSession.sparkContext.broadcast(astuple(trees))

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(Trees(*spread.value).score(np.stack([c.to_numpy(float) for c in columns], 1)))

    scored = stats.withColumn("quality_score", score(*FEATURES))
    return scored.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (F.col("quality_score") >= least)).alias("kept"), "quality_score")


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    stats = written(with_statistics(table(spark, sf_dir, "documents")), "statistics")
    return with_verdict(stats, fit_on_labels(stats, table(spark, sf_dir, "labels")))
