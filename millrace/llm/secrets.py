"""Secret scans: fixed patterns, and a linear-chain conditional random field for what they miss.

Words are cut into tokens at marks. The field tags each token as outside, begin or inside of a secret. Its features are the token's
shape (kinds of characters, length, share of digits, changes of kind, variety), the tokens one to three places before
and one behind, and features of the file (assignments, short lines, braces). Viterbi decodes the best tags. Tokens that
are outside in every best sequence, which a bound of the transitions proves, cut a text into short stretches.

The field is fitted by gradient ascent on a bounded sample: at most SAMPLE documents with a match of the patterns and
SAMPLE of any kind, by hash, and at most WINDOWS stretches of their tokens. Matches with letters and digits are its
secrets; each is learned again in other spellings (alphabet, length, split), half of them with other words around, so that the
field learns shapes and surroundings rather than the patterns. A span it finds is added if it overlaps none of them.

Offsets are code points, ends exclusive. Null and empty texts have no spans. Repeated rows are treated alike; spans with one start
come in the order of KINDS. Without any match in the data the field adds nothing. Whole texts are read, however long.
All columns of the input stay, but one named ``spans`` is replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import bounded_batches, chunks, table

#: At most so many documents with a match, and of any kind, are sampled, and so many stretches of them learned.
SAMPLE = 2_000
WINDOWS = 4_000
#: Tokens before and behind the middle of a stretch; stretches of one document and sort.
REACH = 12
PER_DOCUMENT = 6
#: Stretches with secrets in other spellings, at least.
RESPELLED = 1_500
#: Characters of texts that are tagged together; a longer text is taken alone.
CHARS_AT_ONCE = 2_000_000

KINDS = ("assign", "access", "hex", "field")
# The patterns.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run that is too short fails from each of its places, so the least lengths can stand in the patterns.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
LEAST_VALUE = 12
_ASSIGN, _ACCESS, _HEX = re.compile(ASSIGN, re.IGNORECASE | re.ASCII), re.compile(ACCESS), re.compile(HEX)
_NAMED = ("passw", "secret", "token", "key")

OUT, BEGIN, INSIDE = 0, 1, 2
STATES = 3
OFFSETS = (-3, -2, -1, 1)
_PIECE = re.compile(r"[\w+/.~-]+|[^\w+/.~-]+")
_WORD = re.compile(r"\S+")


def pattern_spans(text: str) -> list[tuple[str, int, int, int]]:
    """Kind, start, end, and start of the value, of all matches; leftmost and not overlapping within a kind."""
    found = []
    low = text.lower()
    if any(n in low for n in _NAMED):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST_VALUE:
                found.append(("assign", m.start(), m.end(), m.start(2)))
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m.start()) for m in _ACCESS.finditer(text)]
    return found + [("hex", m.start(), m.end(), m.start()) for m in _HEX.finditer(text)]


def shape(token: str) -> list[str]:
    """Features of a token by itself."""
    n = len(token)
    size = "n" + str(next((k for k in (2, 4, 6, 8, 10, 12, 16, 20, 24, 32, 40, 64) if n <= k), 99))
    if token.isalpha():
        case = "low" if token.islower() else "up" if token.isupper() else "title" if token[1:].islower() else "mix"
        return ["alpha", f"{case}", f"{case}:{size}"]
    digits = sum(c.isdigit() for c in token)
    upper, lower = sum(c.isupper() for c in token), sum(c.islower() for c in token)
    if not digits + upper + lower:
        return ["marks", f"marks:{token[:3]}"]
    kinds = ("D" if digits else "") + ("U" if upper else "") + ("l" if lower else "")
    other = n - digits - upper - lower
    kind = [0 if c.isdigit() else 1 if c.isalpha() else 2 for c in token]
    changes = sum(a != b for a, b in zip(kind, kind[1:]))
    share = "d" + str(int(5 * digits / n))
    variety = "v" + str(min(4, int(len(set(token)) / 4)))
    return [
        "mixed",
        kinds,
        f"{kinds}:{size}",
        f"{kinds}:{share}",
        f"c{min(8, changes)}",
        f"{kinds}:c{min(6, int(20 * changes / n))}",
        f"{kinds}:{variety}",
        f"o{min(3, other)}:{kinds}",
        f"{'hex' if re.fullmatch('[0-9a-fA-F]+', token) else 'nohex'}:{size}",
    ]


def sort_of(token: str) -> str:
    """What a token is to its neighbours, where it has no name of its own."""
    return "*alpha" if token.isalpha() else "*number" if token.isdigit() else "*mixed" if any(map(str.isalnum, token)) else "*marks"


def file_features(text: str) -> int:
    """Three yes-or-no features of a file as a number from 0 to 7."""
    lines = text.count("\n") + 1
    assigned, braces = text.count("=") + text.count(":"), text.count("{") + text.count("}") + text.count(";")
    return (10 * assigned > 3 * lines) + 2 * (len(text) < 60 * lines) + 4 * (5 * braces > lines)


def logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


@dataclass
class Field:
    """The weights. Row 0 of ``around`` is a place beyond the text, whose tag is outside."""

    shapes: dict[str, int]
    own: np.ndarray
    names: dict[str, int]
    around: np.ndarray
    file: np.ndarray
    step: np.ndarray

    def of_tokens(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The shape's score for each tag, and the number as a neighbour, of each token."""
        names, alpha = self.names, self.names["*alpha"]
        table: list[np.ndarray] = []
        # Most tokens are words of small letters, which only their length tells apart.
        rows: dict[int | tuple, int] = {}
        row, number = [], []
        for token in tokens:
            if token.islower() and token.isalpha():
                key, kind, known = len(token), alpha, names.get(token, 0)
            else:
                key, kind, known = tuple(shape(token)), 0, names.get(token.lower(), 0)
            at = rows.get(key)
            if at is None:
                at = rows[key] = len(table)
                table.append(self.own[[self.shapes[f] for f in shape(token) if f in self.shapes]].sum(0))
            row.append(at)
            number.append(known or kind or names[sort_of(token)])
        return np.array(table)[row], np.array(number)

    def emissions(self, score: np.ndarray, number: np.ndarray, file: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Scores of each tag for a sequence of tokens; ends are those of the documents."""
        out = score + self.file[file]
        starts = np.r_[0, ends[:-1]]
        sizes = ends - starts
        place = np.arange(len(number)) - np.repeat(starts, sizes)
        left = np.repeat(sizes, sizes) - 1 - place
        for k, offset in enumerate(OFFSETS):
            beyond = place < -offset if offset < 0 else left < offset
            out += self.around[k, np.where(beyond, 0, np.roll(number, -offset))]
        return out

    def decode(self, emissions: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The best tags of all documents."""
        t = self.step
        # What a token can gain by its neighbours' transitions if it is not outside.
        gain = max((t[:, s, None] + t[None, s, :] - t[:, OUT, None] - t[None, OUT, :]).max() for s in (BEGIN, INSIDE))
        open_ = np.flatnonzero(emissions[:, OUT] - emissions[:, 1:].max(1) <= gain)
        tags = np.zeros(len(emissions), np.int8)
        if not len(open_):
            return tags
        document = np.searchsorted(ends, open_, side="right")
        first = np.flatnonzero(np.r_[True, (np.diff(open_) > 1) | (np.diff(document) > 0)])
        for a, b in zip(first, np.r_[first[1:], len(open_)]):
            rows = open_[a:b]
            # Before and behind a stretch stands a token outside, or the text's edge.
            score, back = t[OUT] + emissions[rows[0]], []
            for r in rows[1:]:
                way = score[:, None] + t
                back.append(way.argmax(0))
                score = way.max(0) + emissions[r]
            tag = int((score + t[:, OUT]).argmax())
            tags[rows[-1]] = tag
            for r, came in zip(rows[-2::-1], reversed(back)):
                tag = int(came[tag])
                tags[r] = tag
        return tags


@dataclass
class Window:
    tokens: list[str]
    tags: list[int]
    file: int


def respelled(window: Window, rng: np.random.Generator, plain: list[str], file: int) -> Window:
    """The same stretch with other secrets in another kind of file, and with plain words around if there are any."""
    alphabets = ["0123456789ABCDEF", "0123456789abcdef"]
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    alphabets += [letters, letters, letters + "+/", letters + "_-", letters[26:], letters[:26] + letters[52:]]
    # Without a name before it, only a long value is a secret.
    size = int(rng.integers(20, 45)) if plain else int(rng.integers(8, 45))
    tokens, tags = [], []
    for token, tag in zip(window.tokens, window.tags):
        if tag == OUT:
            tokens.append(plain[rng.integers(len(plain))] if plain else token)
            tags.append(OUT)
        elif tag == BEGIN:
            alphabet = alphabets[rng.integers(len(alphabets))]
            value = "".join(alphabet[i] for i in rng.integers(0, len(alphabet), size))
            # A value of letters alone is no secret by its shape.
            value = value[:-2] + alphabet[rng.integers(10)] + "7" if alphabet[0] == "0" else value[:3] + "7" + value[4:-2] + "3" + value[-1]
            cut = int(rng.integers(size // 3, size)) if size >= 24 and rng.random() < 0.3 else size
            tokens += [value[:cut]] + ([value[cut:]] if cut < size else [])
            tags += [BEGIN] + ([INSIDE] if cut < size else [])
    return Window(tokens, tags, file)


def fit(windows: list[Window], rounds: int = 60, rate: float = 0.25, weight: float = 0.002, least: int = 3) -> Field | None:
    """The field with the best penalised likelihood of the stretches; None where they hold no secret."""
    rng = np.random.default_rng(0)
    secret = [w for w in windows if BEGIN in w.tags]
    if not secret:
        return None
    times = max(1, -(-RESPELLED // (2 * len(secret))))
    files = [w.file for w in windows]
    plain = sorted({t for w in windows for t in w.tokens if t.isalpha()}) or ["a"]
    again = [(w, bare) for w in secret for bare in (False, True) for _ in range(times)]
    windows = windows + [respelled(w, rng, plain if bare else [], files[rng.integers(len(files))]) for w, bare in again]
    # A token has a name of its own if it stands beside enough different secrets, as written in the texts.
    near: dict[str, set[str]] = {}
    for w in secret:
        for i, tag in enumerate(w.tags):
            for o in OFFSETS if tag != OUT else ():
                if 0 <= i + o < len(w.tokens) and w.tags[i + o] == OUT and len(w.tokens[i + o]) <= 20:
                    near.setdefault(w.tokens[i + o].lower(), set()).add(w.tokens[i])
    names = {n: i for i, n in enumerate(["*edge", "*alpha", "*number", "*mixed", "*marks"])}
    names |= {t: len(names) + i for i, t in enumerate(sorted(t for t, values in near.items() if len(values) >= least))}
    shapes: dict[str, int] = {}
    distinct: dict[str, int] = {}
    features, owner = [], []
    for w in windows:
        for token in w.tokens:
            if token not in distinct:
                distinct[token] = len(distinct)
                for f in shape(token):
                    features.append(shapes.setdefault(f, len(shapes)))
                    owner.append(distinct[token])
    features, owner = np.array(features), np.array(owner)
    number = np.array([names.get(t.lower(), 0) or names[sort_of(t)] for t in distinct])

    n, width = len(windows), max(len(w.tokens) for w in windows)
    token = np.zeros((n, width), np.int64)
    tag = np.zeros((n, width), np.int64)
    size = np.array([len(w.tokens) for w in windows])
    file = np.array([w.file for w in windows])
    for i, w in enumerate(windows):
        token[i, : size[i]] = [distinct[t] for t in w.tokens]
        tag[i, : size[i]] = w.tags
    inside = np.arange(width)[None, :] < size[:, None]
    neighbour = np.where(inside, number[token], 0)
    around = []
    for offset in OFFSETS:
        moved = np.zeros_like(neighbour)
        if offset < 0:
            moved[:, -offset:] = neighbour[:, :offset]
        else:
            moved[:, :-offset] = neighbour[:, offset:]
        around.append(np.where(inside, moved, 0))
    truth = np.eye(STATES)[tag] * inside[..., None]
    steps = np.zeros((STATES, STATES))
    padded = np.concatenate([np.zeros((n, 1), np.int64), np.where(inside, tag, 0), np.zeros((n, 1), np.int64)], 1)
    real = np.arange(width + 1)[None, :] <= size[:, None]
    np.add.at(steps, (padded[:, :-1][real], padded[:, 1:][real]), 1)

    own, near_by = np.zeros((len(shapes), STATES)), np.zeros((len(OFFSETS), len(names), STATES))
    of_file, step = np.zeros((8, STATES)), np.zeros((STATES, STATES))
    parameters = [own, near_by, of_file, step]
    mean, square = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]

    def count(index: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
        return np.stack([np.bincount(index, values[:, s], rows) for s in range(STATES)], 1)

    for at in range(1, rounds + 1):
        score = count(owner, own[features], len(distinct))
        e = score[token] + of_file[file][:, None, :]
        for k in range(len(OFFSETS)):
            e = e + near_by[k][around[k]]
        ahead, behind = np.zeros((n, width, STATES)), np.zeros((n, width, STATES))
        ahead[:, 0] = step[OUT] + e[:, 0]
        for i in range(1, width):
            ahead[:, i] = logsum(ahead[:, i - 1, :, None] + step, 1) + e[:, i]
        for i in range(width - 1, -1, -1):
            last = (size == i + 1)[:, None]
            follows = logsum(step + (e[:, i + 1] + behind[:, i + 1])[:, None, :], 2) if i + 1 < width else 0.0
            behind[:, i] = np.where(last, step[:, OUT], follows)
        rows = np.arange(n)
        total = logsum(ahead[rows, size - 1] + step[:, OUT], 1)
        share = np.exp(np.where(inside[..., None], ahead + behind - total[:, None, None], -np.inf))
        expected = np.zeros((STATES, STATES))
        expected[OUT] += share[:, 0].sum(0)
        expected[:, OUT] += share[rows, size - 1].sum(0)
        pair = ahead[:, :-1, :, None] + step + (e + behind)[:, 1:, None, :] - total[:, None, None, None]
        expected += np.exp(np.where(inside[:, 1:, None, None], pair, -np.inf)).sum((0, 1))

        rest = truth - share
        flat = rest.reshape(-1, STATES)
        by_token = count(token.ravel(), flat, len(distinct))
        gradients = [
            count(features, by_token[owner], len(shapes)),
            np.stack([count(a.ravel(), flat, len(names)) for a in around]),
            count(file, rest.sum(1), 8),
            steps - expected,
        ]
        for p, g, m, v in zip(parameters, gradients, mean, square):
            g = g / n - weight * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (m / (1 - 0.9**at)) / (np.sqrt(v / (1 - 0.99**at)) + 1e-6)
    return Field(shapes, own, names, near_by, of_file, step)


def pieces(word: str) -> list[str]:
    return [word] if word.isalnum() else _PIECE.findall(word)


def tokens_of(text: str) -> list[tuple[str, int, int]]:
    """The tokens of a text with their offsets."""
    out = []
    for w in _WORD.finditer(text):
        start = w.start()
        for piece in pieces(w.group()):
            out.append((piece, start, start + len(piece)))
            start += len(piece)
    return out


def field_spans(texts: list[str], field: Field) -> list[list[tuple[int, int]]]:
    """What the field finds in each text."""
    out: list[list[tuple[int, int]]] = []
    for low, high in chunks([len(t) for t in texts], CHARS_AT_ONCE):
        some = texts[low:high]
        words: dict[str, int] = {}
        numbers: list[int] = []
        sizes = []
        for text in some:
            split = text.split()
            sizes.append(len(split))
            numbers.extend([words.setdefault(w, len(words)) for w in split])
        # Each different word is cut and judged once.
        tokens: dict[str, int] = {}
        cut = [[tokens.setdefault(p, len(tokens)) for p in pieces(w)] for w in words]
        if not tokens:
            out += [[] for _ in some]
            continue
        length = np.array([len(c) for c in cut])
        begin = np.cumsum(length) - length
        flat = np.array([p for c in cut for p in c])
        word = np.array(numbers, np.int64)
        per_word = length[word]
        last = np.cumsum(per_word)
        token = flat[np.repeat(begin[word], per_word) + np.arange(last[-1]) - np.repeat(last - per_word, per_word)]
        ends = np.r_[0, last][np.cumsum(sizes)]
        file = np.repeat([file_features(t) for t in some], np.diff(np.r_[0, ends]))
        score, number = field.of_tokens(list(tokens))
        tags = field.decode(field.emissions(score[token], number[token], file, ends), ends)
        tagged = np.flatnonzero(tags)
        cuts = np.searchsorted(tagged, np.r_[0, ends])
        for i, text in enumerate(some):
            places = tagged[cuts[i] : cuts[i + 1]]
            found: list[tuple[int, int]] = []
            if len(places):
                first = ends[i - 1] if i else 0
                offsets = tokens_of(text)
                before = -2
                for place in places.tolist():
                    _, start, end = offsets[place - first]
                    if tags[place] == INSIDE and before == place - 1:
                        found[-1] = (found[-1][0], end)
                    else:
                        found.append((start, end))
                    before = place
            # The stop behind a sentence is no part of a secret.
            out.append([(s, s + len(text[s:e].rstrip(".-"))) for s, e in found if text[s:e].rstrip(".-")])
    return out


def scan(texts: list[str], field: Field | None) -> list[list[dict]]:
    """All spans of each text, by start, then kind."""
    more = field_spans(texts, field) if field else [[] for _ in texts]
    out = []
    for text, found in zip(texts, more, strict=True):
        spans = [(s, KINDS.index(k), e) for k, s, e, _ in pattern_spans(text)]
        found = [(s, e) for s, e in found if not any(s < b and a < e for a, _, b in spans)]
        spans = sorted(spans + [(s, KINDS.index("field"), e) for s, e in found])
        out.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
    return out


def windows_of(text: str) -> list[Window]:
    """Stretches of a text's tokens around its secrets, around other mixed tokens, and anywhere."""
    tokens = tokens_of(text)
    if not tokens:
        return []
    values = [(v, e) for _, s, e, v in pattern_spans(text) if any(map(str.isalpha, text[v:e])) and any(map(str.isdigit, text[v:e]))]
    tags = []
    for _, start, end in tokens:
        inside = [v for v, e in values if v < end and start < e and 2 * (min(e, end) - max(v, start)) >= end - start]
        # The first token of a value begins it.
        tags.append(OUT if not inside else INSIDE if tags and tags[-1] != OUT and inside[0] < start else BEGIN)
    secret = [i for i, tag in enumerate(tags) if tag == BEGIN]
    mixed = [i for i, (t, _, _) in enumerate(tokens) if not t.isalpha() and any(map(str.isdigit, t)) and tags[i] == OUT]
    spread = lambda places: places[:: max(1, len(places) // PER_DOCUMENT)][:PER_DOCUMENT]
    out = []
    for middle in [*spread(secret), *spread(mixed), len(tokens) // 2]:
        part = slice(max(0, middle - REACH), middle + REACH)
        out.append(Window([t for t, _, _ in tokens[part]], tags[part], file_features(text)))
    return out


def learned(docs: DataFrame, text: str = "text", sample: int = SAMPLE, windows: int = WINDOWS) -> Field | None:
    """The field fitted on a bounded sample of docs."""
    place = F.xxhash64(F.col(text), F.lit(5))
    docs = docs.select(F.col(text).alias("text"), place.alias("place"))
    match = F.col("text").rlike(f"(?i:{ASSIGN})|{ACCESS}|{HEX}")

    def limit(rows: DataFrame) -> int | None:
        return rows.select("place").orderBy("place").limit(sample).agg(F.max("place")).first()[0]

    with_match, any_kind = limit(docs.where(match)), limit(docs)
    if with_match is None:
        return None

    def cut(batches):
        for batch in batches:
            found = [(p, i, w.tokens, w.tags, w.file) for p, t in zip(batch["place"], batch["text"]) if t for i, w in enumerate(windows_of(t))]
            yield pd.DataFrame(found, columns=["place", "nth", "tokens", "tags", "file"])

    chosen = docs.where((F.col("place") <= any_kind) | ((F.col("place") <= with_match) & match))
    rows = chosen.mapInPandas(cut, "place long, nth int, tokens array<string>, tags array<int>, file int")
    # Stretches with secrets first; copies of one text have the same place.
    secret = F.array_contains("tags", BEGIN)
    rows = rows.dropDuplicates(["place", "nth"]).withColumn("spread", F.xxhash64("place", "nth"))
    taken = [r for s in (secret, ~secret) for r in rows.where(s).orderBy("spread").limit(windows // 2).collect()]
    return fit([Window(r["tokens"], r["tags"], r["file"]) for r in taken])


def with_secrets(docs: DataFrame, text: str = "text", field: Field | None = None) -> DataFrame:
    """docs with ``spans``, an array of (kind, start, end) by start, then kind; without a field, of the patterns only."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("array<struct<kind: string, start: long, end: long>>")
    def found(column: pd.Series) -> pd.Series:
        return pd.Series(scan([t or "" for t in column], field))

    return docs.withColumn("spans", found(F.coalesce(F.col(text), F.lit(""))))


def listed(spans: Column) -> Column:
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.concat_ws(",", one)


def of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def op12_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_secrets(docs, field=learned(docs))
    base = F.filter("spans", lambda s: s["kind"] != "field")
    counts = [of_kind(F.col("spans"), k).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
