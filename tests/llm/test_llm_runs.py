"""Periodic run detection against a plain search over all periods."""

import hashlib
import random
import zlib

import pytest
from llm_fixtures import documents, stored, words

from millrace.llm.runs import LEAST, documents_runs, op11_periodic_runs, with_runs


def plain_runs(w, least=LEAST):
    """(start, length, period): stretches that equal themselves one period on, with the smallest period of each."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q):
                found.setdefault((start, i + q), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def sequences():
    rng = random.Random(0)
    for _ in range(1500):
        w = [rng.choice("abcde"[: rng.choice([1, 2, 2, 3, 5])]) for _ in range(rng.randint(0, 80))]
        if len(w) > 5 and rng.random() < 0.5:
            a = rng.randrange(len(w))
            p = 1 + rng.randrange((len(w) - a) // 2 + 1)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        yield w + w if rng.random() < 0.2 else w
    yield from (fibonacci(n) for n in (50, 200, 377))
    # Two stretches of one step with a break between: the periods across it form progressions.
    yield list("ab" * 25 + "a" + "ab" * 30)
    yield list("aab" * 20 + "ab" * 15 + "aab" * 15)


@pytest.mark.parametrize("least", [2, LEAST])
def test_all_runs_are_found(least):
    split = [[x.encode() for x in w] for w in sequences()]
    for w, (runs, left) in zip(split, documents_runs([b" ".join(w) for w in split], least), strict=True):
        expected = plain_runs(w, least)
        assert [(r["start"], r["length"], r["period"]) for r in runs] == expected
        assert left == collapsed(w, expected)


def test_long_documents_of_repeats():
    for w in (["long"] * 60_000, fibonacci(30_000)):
        ((runs, _),) = documents_runs([" ".join(w).encode()])
        assert len(runs) >= 1
        assert all(r["length"] >= max(LEAST, 2 * r["period"]) for r in runs)


def expected_row(doc_id, text):
    w = words(text)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if w and h is not None and h % 10 == 0:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w) if len(w) < 5_000 else [(1, len(w) - 1, 1)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, sha(listed), sha(collapsed(w, runs)))


def test_query_on_odd_rows(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows, ids that are null or negative, extra columns."""
    docs = documents(spark).where("doc_id IS NULL OR doc_id <> 900008")
    found = op11_periodic_runs(spark, stored(spark, tmp_path, documents=docs)).collect()
    expected = [expected_row(r["doc_id"], r["text"]) for r in docs.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[7])
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)
    assert sum(r["n_runs"] > 0 for r in found) > 15


def test_operator_keeps_columns(spark):
    rows = [(1, "a b " * 8 + "c", "x"), (1, "a b " * 8 + "c", "x"), (2, None, "y"), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    found = sorted(map(tuple, with_runs(docs.withColumn("_other", docs.runs)).select("doc_id", "text", "_other", "runs", "collapsed").collect()), key=str)
    assert found[0] == found[1]
    assert found[0][3] == [(0, 16, 2)] and found[0][4] == "a b c"
    assert [(r[3], r[4]) for r in found[2:]] == [([], ""), ([], "")]
