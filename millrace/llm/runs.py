"""Periodic run detection over words, by a dictionary of basic factors.

Every factor (stretch of words) whose length L is a power of two gets a number; equal factors of one document have equal
numbers. The occurrences of a factor, in order, fall into arithmetic progressions: neighbours at most L / 2 apart all have
the same distance. Two progressions less than 2L apart propose the distances between their members as periods from L to
2L. A proposal counts where its period cannot begin earlier; comparing the dictionary's numbers from the longest factors
down shows how far it reaches. Proposals with the same words keep the smallest period, so that every run is found once.

A run is a stretch of words with smallest period q, at least ``least`` and 2q words long, that no neighbouring word
extends. A word is dropped if a run holds it after that run's first q words; the others are joined by one space.

Null and empty texts have no words and no runs, and collapse to the empty text. Repeated rows are treated alike, and there are
no ties between documents. All columns of the input stay, but those named ``runs`` and ``collapsed`` are replaced. Very
long texts are taken whole: memory in a task is about 8 bytes for each word and doubling of the longest text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import WORD, bounded_batches, chunks, doc_crc, table, utf8_bytes

#: The fewest words of a run.
LEAST = 12
#: Words whose factors are numbered together; a longer document is taken alone.
WORDS_AT_ONCE = 400_000


class Dictionary:
    """The basic factors of a sequence of word numbers: levels[k][i] tells factors of 2**k words at i apart.

    A factor that occurs once has -1, which equals nothing. Levels end where every factor occurs once.
    """

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.levels: list[np.ndarray] = []
        #: Per level: starts of the factors that occur twice or more, by factor and place, and their numbers.
        self.occurrences: list[tuple[np.ndarray, np.ndarray]] = []
        places, keys, length = np.arange(len(words)), words.astype(np.int64), 1
        while len(places):
            order = np.argsort(keys, kind="stable")
            places, keys = places[order], keys[order]
            same = keys[1:] == keys[:-1]
            often = np.r_[False, same] | np.r_[same, False]
            number = np.cumsum(~np.r_[False, same])[often]
            places = places[often]
            if not len(places):
                break
            level = np.full(len(words) + 1, -1, np.int32)
            level[places] = number
            self.levels.append(level)
            self.occurrences.append((places, number))
            starts = np.sort(places)
            starts = starts[starts + length < len(words)]
            second = level[starts + length]
            places, second = starts[second >= 0], second[second >= 0].astype(np.int64)
            keys = level[places].astype(np.int64) * (int(number[-1]) + 1) + second
            length *= 2

    def proposals(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and periods at which a run may begin."""
        found_at, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, (places, number) in enumerate(self.occurrences):
            length = 1 << k
            gap = places[1:] - places[:-1]
            near = (number[1:] == number[:-1]) & (2 * gap <= length)
            head = np.flatnonzero(~np.r_[False, near])
            size = np.diff(np.r_[head, len(places)])
            first, last, factor = places[head], places[head + size - 1], number[head]
            # All progressions of a factor have the same step: its smallest period. Single places have none.
            step = np.full(int(number[-1]) + 1, 4 * length)
            many = size > 1
            step[factor[many]] = gap[head[many]]
            apart = 1
            while apart < len(head):
                a = np.flatnonzero(factor[apart:] == factor[:-apart])
                b = a + apart
                least = first[b] - last[a]
                close = least < 2 * length
                a, b, least = a[close], b[close], least[close]
                if not len(a):
                    break
                by = step[factor[a]]
                low = np.maximum(0, -((least - length) // by))
                high = np.minimum(size[a] + size[b] - 2, (2 * length - 1 - least) // by)
                some = np.maximum(0, high - low + 1)
                of = np.repeat(np.arange(len(a)), some)
                nth = np.arange(len(of)) - np.repeat(np.cumsum(some) - some, some) + low[of]
                period = least[of] + nth * by[of]
                # The earliest member of the first progression whose partner is in the second.
                at = np.maximum(first[a][of], first[b][of] - period)
                begins = (at == 0) | (self.words[at - 1] != self.words[at + period - 1])
                found_at.append(at[begins])
                found.append(period[begins])
                apart += 1
        return np.concatenate(found_at), np.concatenate(found)

    def agreement(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a on equal those from b on; a before b."""
        a, b = a.copy(), b.copy()
        start = a.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            left = self.levels[k][a]
            equal = (left >= 0) & (left == self.levels[k][b])
            a += equal << k
            b += equal << k
        return a - start

    def runs(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and smallest period of every run, by start, then period."""
        at, period = self.proposals()
        end = at + period + self.agreement(at, at + period)
        long = end - at >= np.maximum(2 * period, least)
        at, end, period = at[long], end[long], period[long]
        order = np.lexsort((period, end, at))
        at, end, period = at[order], end[order], period[order]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (end[1:] != end[:-1])
        at, end, period = at[new], end[new], period[new]
        order = np.lexsort((period, at))
        return at[order], end[order], period[order]


def documents_runs(texts: list[bytes], least: int = LEAST) -> list[tuple[list[dict], bytes]]:
    """The runs of each text, and what is left of it."""
    split = [t.split() for t in texts]
    out: list[tuple[list[dict], bytes]] = []
    for low, high in chunks([len(w) for w in split], WORDS_AT_ONCE):
        numbers: list[int] = []
        for words in split[low:high]:
            # Numbers of one document begin above those of the one before, so nothing matches across documents.
            ids: dict[bytes, int] = {}
            base = len(numbers)
            numbers.extend([base + ids.setdefault(w, len(ids)) for w in words])
        at, end, period = Dictionary(np.array(numbers, np.int64)).runs(least)
        firsts = np.cumsum([0, *map(len, split[low:high])])
        cuts = np.searchsorted(at, firsts)
        for n, words in enumerate(split[low:high]):
            mine = slice(cuts[n], cuts[n + 1])
            starts, ends, periods = at[mine] - firsts[n], end[mine] - firsts[n], period[mine]
            if len(starts):
                covered = np.zeros(len(words) + 1, np.int64)
                np.add.at(covered, starts + periods, 1)
                np.add.at(covered, ends, -1)
                words = [w for w, gone in zip(words, np.cumsum(covered) > 0) if not gone]
            found = zip(starts.tolist(), (ends - starts).tolist(), periods.tolist(), strict=True)
            out.append(([{"start": s, "length": m, "period": q} for s, m, q in found], b" ".join(words)))
    return out


def with_runs(docs: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """docs with ``runs``, an array of (start, length, period) by start, then period, and ``collapsed``, the text without repeats."""
    bounded_batches(docs.sparkSession)
    schema = "runs array<struct<start: long, length: long, period: long>>, collapsed binary"

    @F.pandas_udf(schema)
    def detect(column: pd.Series) -> pd.DataFrame:
        found = documents_runs([b"" if t is None else bytes(t) for t in column], least)
        return pd.DataFrame({"runs": [r for r, _ in found], "collapsed": [c for _, c in found]})

    # As bytes, a text reaches Python unchanged whatever it holds.
    found = docs.withColumn("_found", detect(F.col(text).cast("binary")))
    found = found.withColumn("runs", F.col("_found.runs")).withColumn("collapsed", F.col("_found.collapsed").cast("string"))
    return found.drop("_found")


def longest(runs: Column) -> Column:
    """The run with the greatest length; ties: smallest start, then period. Null without runs."""
    place = F.transform(runs, lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period")))
    return F.array_min(place)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; in a tenth of the documents, by hash of the id, all words from one on are made periodic. Without id: none."""
    words, n = F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.size("_words")
    h = doc_crc()
    g = F.floor(h / 10)
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    place = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + F.pmod(i - F.col("_a"), F.col("_p")))
    made = F.concat_ws(" ", F.transform("_words", lambda w, i: F.get("_words", place(i).cast("int"))))
    chosen = docs.select("doc_id", "text", F.when(F.pmod(h, F.lit(10)) == 0, words).alias("_words"))
    chosen = chosen.withColumn("_a", F.when(n > 0, a)).withColumn("_p", F.when(n > 0, p))
    return chosen.select("doc_id", F.when(n > 0, made).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = with_runs(with_planted_periods(table(spark, sf_dir, "documents"))).withColumn("_best", longest(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("_best")
    length = -best["n"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        length.alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * length / best["period"]).alias("exponent_milli"),
        F.sha2(F.concat_ws("", line), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
