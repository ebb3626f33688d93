"""Toxicity: Levenshtein automata intersected with a lexicon trie, with scores of the context of each hit.

The lexicon is learned from labelled documents: words, and stems that stand for all words they begin. It
becomes a trie. The Levenshtein automata of all entries run over it together: a state is the set of pairs (trie node,
edits so far) that are still alive, made on demand and remembered; so a word costs a few look-ups. Around each
hit a window of words tells abuse from quotation: hits inside quotation marks or after a word of saying count apart
from bare ones and from hits that stand close together. A logistic model weighs these counts; hits, misspelt ones too, can
only raise a score, and quotation only lower it. What labelled texts seldom show is made from them: toxic texts are learned
again with their hits misspelt, clean ones with an entry quoted.

Null and empty text: no hits, and the score of a text without hits. No labels to learn from: score 0 for all.
Several labels of a document: toxic if any says so; ties of the sample go by id. Repeated rows are scored alike. Very long
texts are read whole, one at a time. Other columns, whatever their names, take no part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import bounded_batches, doc_crc, table

#: At most so many labelled documents of each class are learned from, by the hash of their id.
SAMPLE = 8_000
#: At most so many lexicon entries, the strongest first.
ENTRIES = 2_000
#: Different toxic texts that an entry stands in at least, and the lower bound of its log-odds (at so many deviations).
LEAST_TEXTS = 3
LEAST_ODDS = 1.0
CERTAINTY = 1.64
#: Least likelihood ratio (G) of an entry's texts against chance: of 30,000 words as frequent as it about one gets there by chance.
LEAST_RATIO = 16.0
#: Texts of fewer words, which share phrases without being copies, are told apart by all their words.
SHORT = 50
#: Times by which words an edit away, and stems, are to be rarer in clean texts than in toxic ones.
CLEANER = 50
STEMS_CLEANER = 150
STEMS = (4, 5, 6)
WINDOW = 8
TOKEN = re.compile(r"[\w@$*]+")
QUOTES = "\"“”„«»"
#: Words of saying that mark a quotation. Fixed values.
SAYING = frozenset(
    "said says called wrote quote quoted word term sagte sagt nannte schrieb zitat wort dit disait appelé écrit mot "
    "cité dijo dice llamó escribió cita palabra".split()
)
FEATURES = ("exact", "near", "bare", "quoted", "close", "share")
#: What a feature may do to a score: raise or lower it.
SIGNS = (1, 1, 1, -1, 1, 1)
#: Ways to quote a term, for learning.
QUOTING = ('"{}"', "„{}“", "“{}”", "the word {}", "they said {}")


def edits_allowed(length: int, stem: bool) -> int:
    if stem:
        return 1 if length >= 6 else 0
    return 0 if length < 5 else 1 if length < 9 else 2


class Automaton:
    """The lexicon's trie with the automata of its entries; match() gives the edits of the nearest entry, or None.

    rigid: entries that are allowed no edits.
    """

    def __init__(self, entries: list[str], rigid: frozenset[str] = frozenset()) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[int, bool, str]]] = [[]]
        self.most = [0]
        for entry in entries:
            stem = entry.endswith("*")
            word = entry.rstrip("*")
            allowed, node = 0 if entry in rigid else edits_allowed(len(word), stem), 0
            self.most[0] = max(self.most[0], allowed)
            for c in word:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], allowed)
            self.ends[node].append((allowed, stem, entry))
        self.states: list[frozenset] = []
        self.known: dict[frozenset, int] = {}
        self.moves: list[dict[str, int]] = []
        self.result: list[tuple[int | None, int | None]] = []
        self.start = self._state({(0, 0)})
        self.prefixes: dict[str, bool] = {}

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """Adds what deletions reach; keeps the least edits per node."""
        least: dict[int, int] = {}
        work = list(pairs)
        while work:
            node, e = work.pop()
            if e > self.most[node] or least.get(node, 99) <= e:
                continue
            least[node] = e
            work += [(child, e + 1) for child in self.children[node].values()]
        key = frozenset(least.items())
        if key not in self.known:
            self.known[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            ends = [(e, stem) for node, e in key for allowed, stem, _ in self.ends[node] if e <= allowed]
            self.result.append((min((e for e, _ in ends), default=None), min((e for e, s in ends if s), default=None)))
        return self.known[key]

    def _move(self, state: int, c: str) -> int:
        to = self.moves[state].get(c)
        if to is None:
            pairs = set()
            for node, e in self.states[state]:
                pairs.add((node, e + 1))
                for label, child in self.children[node].items():
                    pairs.add((child, e + (label != c)))
            to = self.moves[state][c] = self._state(pairs)
        return to

    def alive(self, prefix: str) -> bool:
        """Whether a word that begins like this may match; remembered for short prefixes."""
        found = self.prefixes.get(prefix)
        if found is None:
            state, stem = self.start, False
            for c in prefix:
                state = self._move(state, c)
                stem = stem or self.result[state][1] is not None
            if len(self.prefixes) > 500_000:
                self.prefixes.clear()
            found = self.prefixes[prefix] = stem or bool(self.states[state])
        return found

    def match(self, word: str) -> int | None:
        state, best = self.start, None
        for c in word:
            state = self._move(state, c)
            if not self.states[state]:
                return best
            stem = self.result[state][1]
            if stem is not None and (best is None or stem < best):
                best = stem
        whole = self.result[state][0]
        return whole if best is None or whole is not None and whole < best else best

    def nearest(self, word: str) -> set[str]:
        """All entries that match."""
        state, found = self.start, set()
        for i, c in enumerate(word, 1):
            state = self._move(state, c)
            for node, e in self.states[state]:
                found.update(name for allowed, stem, name in self.ends[node] if e <= allowed and (stem or i == len(word)))
        return found


def features(text: str | None, automaton: Automaton) -> tuple:
    """Counts of hits by kind, and their share of the words; see FEATURES."""
    low = (text or "").lower()
    tokens = TOKEN.findall(low)
    alive = automaton.alive
    hits = {t: e for t in set(tokens) if alive(t[:4]) and (e := automaton.match(t)) is not None}
    if not hits:
        return (0.0,) * len(FEATURES)
    spans = [(m.group(), m.start()) for m in TOKEN.finditer(low)]
    at = [i for i, (t, _) in enumerate(spans) if t in hits]
    exact = near = bare = quoted = close = 0
    marks, seen = 0, 0
    for k, i in enumerate(at):
        token, start = spans[i]
        exact += hits[token] == 0
        near += hits[token] > 0
        line = low.rfind("\n", 0, start) + 1
        marks = sum(low.count(q, max(line, seen), start) for q in QUOTES) + (marks if line <= seen else 0)
        seen = start
        said = any(t in SAYING for t, _ in spans[max(0, i - WINDOW) : i])
        pair = k and i - at[k - 1] <= WINDOW or k + 1 < len(at) and at[k + 1] - i <= WINDOW
        if marks % 2 or said:
            quoted += 1
        else:
            bare += 1
        close += bool(pair)
    return tuple(map(float, np.log1p([exact, near, bare, quoted, close]))) + (min(1.0, 10 * len(at) / len(spans)),)


def misspelt(text: str, automaton: Automaton) -> str:
    """text with one letter changed, left out or doubled in every word that an entry matches as it is."""

    def change(m: re.Match) -> str:
        word = m.group()
        if len(word) < 5 or automaton.match(word.lower()) != 0:
            return word
        mark = zlib.crc32(word.lower().encode("utf-8", "replace"))
        i = 1 + mark % (len(word) - 1)
        return word[:i] + ("*", "", 2 * word[i])[mark // 64 % 3] + word[i + 1 :]

    return TOKEN.sub(change, text)


def quoting(text: str, lexicon: list[str]) -> str:
    """text with an entry quoted between two of its words."""
    mark = zlib.crc32(text.encode("utf-8", "replace"))
    said = QUOTING[mark % len(QUOTING)].format(lexicon[mark // 8 % len(lexicon)].rstrip("*"))
    spaces = [m.start() for m in re.finditer(r"\s", text)] or [0]
    at = spaces[mark // 64 % len(spaces)]
    return f"{text[:at]} {said} {text[at:]}"


def terms(text: str) -> set[str]:
    """The words of a text and their stems, marked with a star."""
    words = {w for w in TOKEN.findall(text.lower()) if 3 <= len(w) <= 40}
    return words | {f"{w[:k]}*" for w in words for k in STEMS if len(w) > k}


def fingerprint(text: str) -> int:
    """The least hash of a text's runs of five words: most near copies of a text share it. Short texts stand for themselves."""
    words = TOKEN.findall(text.lower())
    size = 5 if len(words) >= SHORT else len(words)
    return min(zlib.crc32(" ".join(words[i : i + size]).encode("utf-8", "replace")) for i in range(len(words) - size + 1))


def learn_lexicon(sample: DataFrame, entries: int = ENTRIES) -> list[str]:
    """Words and stems that stand in toxic texts far more often. sample: text, toxic (boolean).

    Near copies count as one text. A term is taken by the lower bound of its smoothed log-odds, so that rare terms
    are learned and words that clean texts quote now and then stay for the context to weigh; stems must be all but clean.
    """

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(print=[fingerprint(t) for t in batch["text"]])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, sizes = (Counter(), Counter()), [0, 0]
        last, together = None, set()
        for batch in batches:
            for text, toxic, mark in zip(batch["text"], batch["toxic"], batch["print"], strict=True):
                if (mark, toxic) != last:
                    if last:
                        found[int(last[1])].update(together)
                    last, together = (mark, toxic), set()
                    sizes[int(toxic)] += 1
                together |= terms(text)
        if last:
            found[int(last[1])].update(together)
        found[0][""], found[1][""] = sizes
        names = list(found[0].keys() | found[1].keys())
        yield pd.DataFrame({"term": names, "clean": [found[0][t] for t in names], "bad": [found[1][t] for t in names]})

    marked = sample.select("text", "toxic").mapInPandas(mark, "text string, toxic boolean, print long")
    marked = marked.repartition("print").sortWithinPartitions("print", "toxic")
    counted = marked.mapInPandas(count, "term string, clean long, bad long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    counted = counted.where((F.col("bad") >= LEAST_TEXTS) | (F.col("term") == "")).persist()
    sizes = counted.where("term = ''").first()
    if not sizes or not sizes["bad"] or not sizes["clean"]:
        counted.unpersist()
        return []
    bad, clean = F.col("bad") + 0.5, F.col("clean") + 0.5
    odds = F.log(bad / (sizes["bad"] + 1.0 - bad)) - F.log(clean / (sizes["clean"] + 1.0 - clean))
    sure = F.round(odds - CERTAINTY * F.sqrt(1 / bad + 1 / clean), 9)
    # Against what chance gives: the term's texts toxic as often as all are.
    n, part = F.col("bad") + F.col("clean"), sizes["bad"] / (sizes["bad"] + sizes["clean"])
    quiet = F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (n * (1 - part)))).otherwise(0.0)
    ratio = F.round(2 * (F.col("bad") * F.log(F.col("bad") / (n * part)) + quiet), 9)
    unclean = F.col("clean") / float(sizes["clean"]) * STEMS_CLEANER >= F.col("bad") / float(sizes["bad"])
    # Shorter entries first: a stem speaks for the words that it begins, as far as they are spelled right.
    rows = (
        counted.where((F.col("term") != "") & (F.col("bad") >= LEAST_TEXTS)).withColumn("sure", sure)
        .where((F.col("sure") >= LEAST_ODDS) & (ratio >= LEAST_RATIO) & ~(F.col("term").endswith("*") & unclean))
        .orderBy(F.desc("sure"), F.length("term"), "term").limit(4 * entries).toPandas()
    )
    counted.unpersist()
    kept: dict[str, None] = {}
    for term in sorted(rows["term"], key=lambda t: (len(t), t)):
        word, stem = term.rstrip("*"), term.endswith("*")
        shorter = [f"{word[:k]}*" for k in STEMS if k < len(word) + (not stem)]
        # A stem without edits cannot stand for an entry that is allowed some.
        if edits_allowed(len(word), stem) or not any(s in kept for s in shorter):
            kept[term] = None
    by_odds = dict(zip(rows["term"], rows["sure"], strict=True))
    return sorted(kept, key=lambda t: (-by_odds[t], t))[:entries]


def rigid_entries(sample: DataFrame, lexicon: list[str]) -> frozenset[str]:
    """Entries whose edits are words of clean texts, rather than misspellings. sample: text, toxic (boolean)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(lexicon)
        own, edited, sizes = Counter(), Counter(), [0, 0]
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                sizes[int(toxic)] += 1
                words = set(TOKEN.findall(text.lower()))
                edits = {t: automaton.match(t) for t in words if automaton.alive(t[:4])}
                of = [(t, e) for t, e in edits.items() if e is not None and (e == 0) == toxic]
                (own if toxic else edited).update(set().union(*(automaton.nearest(t) for t, _ in of)))
        own[""], edited[""] = sizes[1], sizes[0]
        names = list(own.keys() | edited.keys())
        yield pd.DataFrame({"entry": names, "own": [own[n] for n in names], "edited": [edited[n] for n in names]})

    counted = sample.select("text", "toxic").mapInPandas(count, "entry string, own long, edited long")
    rows = {r["entry"]: r for r in counted.groupBy("entry").agg(F.sum("own").alias("own"), F.sum("edited").alias("edited")).collect()}
    if "" not in rows:
        return frozenset()
    bad, clean = max(1, rows[""]["own"]), max(1, rows[""]["edited"])
    return frozenset(n for n, r in rows.items() if n and r["edited"] * CLEANER * bad > r["own"] * clean)


def fit_logistic(x: np.ndarray, y: np.ndarray, signs: tuple = SIGNS, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights by Newton's method, the intercept last. Those that would get the wrong sign are zero.

    The first feature weighs at least as much as the second: a misspelling says no more than the word.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    x[:, 1] += x[:, 0]
    sign = np.array([*signs, 0])
    ridge = np.diag([penalty] * len(signs) + [1e-3])
    used = np.ones(x.shape[1], bool)
    while True:
        w = np.zeros(x.shape[1])
        part, own = x[:, used], ridge[np.ix_(used, used)]
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((part * (p * (1 - p))[:, None]).T @ part + own, part.T @ (y - p) - own @ w[used])
            w[used] += step
            if np.abs(step).max() < 1e-8:
                break
        wrong = np.where(w * sign < 0, np.abs(w), 0)
        if not wrong.any():
            w[0] += w[1]
            return w
        used[wrong.argmax()] = False


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """The lexicon, its rigid entries and the weights from at most ``sample`` documents of each class; docs: doc_id, text. None without labels of both."""
    bounded_batches(docs.sparkSession)
    toxic = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") >= 1).alias("toxic"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = toxic.where("toxic").orderBy(*order).limit(sample).unionAll(toxic.where("NOT toxic").orderBy(*order).limit(sample))
    rows = docs.where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    rows = rows.persist()
    lexicon = learn_lexicon(rows)
    rigid = rigid_entries(rows, lexicon)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(lexicon, rigid)
        for batch in batches:
            shown = [misspelt(t, automaton) if bad else quoting(t, lexicon) if lexicon else t for t, bad in zip(batch["text"], batch["toxic"], strict=True)]
            out = pd.DataFrame([features(t, automaton) for t in [*batch["text"], *shown]], columns=list(FEATURES))
            yield out.assign(toxic=np.tile(batch["toxic"].to_numpy(), 2))

    schema = ", ".join(f"{f} double" for f in FEATURES) + ", toxic boolean"
    table = rows.mapInPandas(measure, schema).groupBy(*FEATURES, "toxic").count().toPandas()
    rows.unpersist()
    if table["toxic"].nunique() < 2:
        return None
    table = table.sort_values([*FEATURES, "toxic"])
    times = table["count"].to_numpy()
    x = np.repeat(table[list(FEATURES)].to_numpy(float), times, 0)
    return lexicon, rigid, fit_logistic(x, np.repeat(table["toxic"].to_numpy(float), times))


def score(docs: DataFrame, model, keep: list[str]) -> DataFrame:
    """keep, score and predicted of every row of docs."""
    bounded_batches(docs.sparkSession)
    if model is None:
        return docs.select(*keep, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    spread = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon, rigid, weights = spread.value
        automaton = Automaton(lexicon, rigid)
        for texts in batches:
            x = np.array([features(None if pd.isna(t) else t, automaton) for t in texts]).reshape(-1, len(FEATURES))
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))))

    return docs.select(*keep, scored("text").alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(doc_crc(column) % 5 == 0, F.lit(False))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out())
    model = learn(docs.select("doc_id", "text"), labels)
    return score(docs.select("doc_id", held_out().alias("held_out"), "text"), model, ["doc_id", "held_out"])
