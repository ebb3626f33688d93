"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts come from all rows to learn from, summed in Spark; the matrix of log probabilities, one row per
language and one column per bucket, is broadcast. Its size is languages times BUCKETS doubles. A text is
scored by adding the columns of its n-grams, batch by batch in numpy.

Null text, empty text and text without a letter: ``und`` with score 0. Nothing to learn from: ``und`` for all.
Equal scores: the first language by code point. Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import bounded_batches, chunks, doc_crc, table

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
CHUNK = 1 << 20


def hashed_ngrams(texts: list[str], buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of arrays: index of the text, bucket of the n-gram. Texts are cut into bounded pieces that overlap."""
    pieces, owner, own = [], [], []
    overlap = max(ORDERS) - 1
    for i, text in enumerate(texts):
        low = text.lower()
        for start in range(0, len(low), CHUNK):
            pieces.append(low[start : start + CHUNK + overlap])
            own.append(min(CHUNK, len(low) - start))
            owner.append(i)
    for a, b in chunks([len(p) for p in pieces], CHUNK):
        codes = np.frombuffer("".join(pieces[a:b]).encode("utf-32-le", "surrogatepass"), "<u4")
        sizes = np.array([len(p) for p in pieces[a:b]])
        piece = np.repeat(np.arange(b - a), sizes)
        at = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        counted = at < np.array(own[a:b])[piece]
        left = sizes[piece] - at
        text_of = np.array(owner[a:b])[piece]
        value = np.zeros(len(codes), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            shifted = np.zeros_like(value)
            shifted[: len(codes) - n + 1] = codes[n - 1 :]
            value = (value ^ shifted) * np.uint32(2654435761) + np.uint32(n)
            if n in ORDERS:
                fits = counted & (left >= n)
                mixed = value[fits]
                yield text_of[fits], ((mixed ^ (mixed >> np.uint32(15))) % np.uint32(buckets)).astype(np.int64)


class Languages:
    """The learned model: names in the order of code points, log probabilities by language and bucket, log priors."""

    def __init__(self, names: list[str], columns: np.ndarray, priors: np.ndarray) -> None:
        self.names, self.columns, self.priors = names, columns, priors

    @classmethod
    def of_counts(cls, names: list[str], counts: np.ndarray, rows: np.ndarray) -> Languages:
        smooth = counts + SMOOTHING
        return cls(names, np.log(smooth / smooth.sum(1, keepdims=True)), np.log(rows / max(1, rows.sum())))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        known = [t is not None and any(map(str.isalpha, t)) for t in texts]
        if not self.names or not any(known):
            return ["und"] * len(texts), np.zeros(len(texts))
        kept = [t for t, k in zip(texts, known, strict=True) if k]
        total = np.tile(self.priors, (len(kept), 1))
        for text, bucket in hashed_ngrams(kept, self.columns.shape[1]):
            for i in range(len(self.names)):
                total[:, i] += np.bincount(text, weights=self.columns[i].take(bucket), minlength=len(kept))
        best = total.argmax(1)
        share = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        names, scores, j = [], np.zeros(len(texts)), 0
        for i, k in enumerate(known):
            names.append(self.names[best[j]] if k else "und")
            if k:
                scores[i] = share[j]
                j += 1
        return names, scores


def learn(docs: DataFrame) -> Languages:
    """From columns text and lang of all rows; null text or lang teaches nothing."""
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            names, of = np.unique(batch["lang"].to_numpy(str), return_inverse=True)
            for text, bucket in hashed_ngrams(batch["text"].tolist()):
                lang = of[text]
                for i, name in enumerate(names):
                    mine = bucket if len(names) == 1 else bucket[lang == i]
                    found[name] = found.get(name, 0) + np.bincount(mine, minlength=BUCKETS)
            for i, name in enumerate(names):
                rows[name] = rows.get(name, 0) + int((of == i).sum())
        for name, values in found.items():
            at = np.flatnonzero(values)
            yield pd.DataFrame({"lang": name, "bucket": at, "n": values[at]})
            yield pd.DataFrame({"lang": [name], "bucket": [-1], "n": [rows[name]]})

    counted = (
        docs.where("text IS NOT NULL AND lang IS NOT NULL AND text <> ''")
        .select("text", "lang")
        .mapInPandas(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    names = sorted(counted["lang"].unique())
    place = {n: i for i, n in enumerate(names)}
    counts, priors = np.zeros((len(names), BUCKETS)), np.ones(len(names))
    row, bucket, n = counted["lang"].map(place).to_numpy(int), counted["bucket"].to_numpy(int), counted["n"].to_numpy(float)
    inside = bucket >= 0
    counts[row[inside], bucket[inside]] = n[inside]
    priors[row[~inside]] = n[~inside]
    return Languages.of_counts(names, counts, priors)


def identify(docs: DataFrame, model: Languages, keep: list[str] | None = None) -> DataFrame:
    """The columns keep (all, if not given) of docs with lang_pred and score. docs has text."""
    bounded_batches(docs.sparkSession)
    spread = docs.sparkSession.sparkContext.broadcast((model.names, model.columns, model.priors))
    keep = docs.columns if keep is None else keep

    @F.pandas_udf("lang_pred string, score double")
    def predicted(text: pd.Series) -> pd.DataFrame:
        names, scores = Languages(*spread.value).predict([None if pd.isna(t) else t for t in text])
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return docs.select(*keep, predicted("text").alias("_said")).select(*keep, "_said.lang_pred", "_said.score")


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(doc_crc(column) % 3 == 1, F.lit(False))


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out()))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model, ["doc_id", "held_out"])


def keep_known(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose language is told with a score of at least ``least``; learned from the rows themselves."""
    model = learn(docs.where(~held_out()))
    named = identify(docs.select(F.struct("*").alias("_row"), "text"), model, ["_row"])
    return named.where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select("_row.*")
