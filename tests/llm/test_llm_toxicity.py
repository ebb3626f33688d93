"""What spelling and quotation do to the scores of held-out texts, and what the model may not learn."""

import re

import numpy as np
import pytest

from millrace.llm import toxicity

INSULT = re.compile(r"\b(trash|pathetic|idiot|worthless|disgusting|stupid|clown|moron|loser)\b", re.IGNORECASE)
CLEAN = "the plain words of a text that goes on about gardens and rivers " * 8


@pytest.fixture(scope="module")
def model(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    learned = toxicity.learn(docs, labels.where(~toxicity.held_out()))
    rows = docs.join(labels, "doc_id").where(toxicity.held_out()).select("text", "toxic").collect()
    return learned, [r["text"] for r in rows if r["toxic"]], [r["text"] for r in rows if not r["toxic"]]


@pytest.fixture(scope="module")
def score(model):
    (lexicon, rigid, weights), _, _ = model
    automaton = toxicity.Automaton(lexicon, rigid)
    return lambda text: float(np.array([*toxicity.features(text, automaton), 1.0]) @ weights)


def test_misspelt_insults_are_found(model, score):
    _, toxic, clean = model
    found = lambda change: sum(score(INSULT.sub(change, t)) >= 0 for t in toxic)
    plain = found(lambda m: m[0])
    assert plain >= 0.9 * len(toxic)
    assert found(lambda m: f"{m[0][0]}x{m[0][2:]}") >= 0.8 * plain
    assert found(lambda m: f"{m[0][:-1]}x") >= 0.8 * plain
    assert sum(score(t) >= 0 for t in clean) <= 0.01 * len(clean)


@pytest.mark.parametrize("word", ["idiot", "pathetic", "worthless"])
def test_a_misspelling_clears_nothing_and_quotation_says_less(score, word):
    none, plain = score(CLEAN), score(f"{CLEAN}you are {word}")
    assert none < score(f"{CLEAN}you are {word[:2]}x{word[3:]}") <= plain
    assert score(f'{CLEAN}you are "{word}"') < plain
    assert score(f"{CLEAN}they said the word {word}") < plain


def test_quoted_hits_of_toxic_texts_score_less(model, score):
    _, toxic, _ = model
    texts = [t for t in toxic if INSULT.search(t)]
    assert len(texts) > 30
    assert all(score(INSULT.sub(lambda m: f'"{m[0]}"', t)) < score(t) for t in texts if not set(toxicity.QUOTES) & set(t))


def test_weights_keep_their_signs():
    """Data that say the opposite of a sign leave a weight of zero, and an edit weighs no more than the word."""
    random = np.random.default_rng(0)
    x = random.integers(0, 3, (4000, 6)).astype(float)
    y = (x @ [1.0, 2.5, -1.0, 1.0, 0.5, 0.2] + random.normal(size=4000) > 3).astype(float)
    w = toxicity.fit_logistic(x, y)
    assert w[0] >= w[1] > 0 and w[2] == w[3] == 0 and w[4] > 0


def test_edits_that_are_clean_words_are_lost(spark):
    data = [(f"text{i} you {'moron' if i % 2 else 'hater'}", True) for i in range(40)] + [(f"text{i} about water", False) for i in range(80)]
    sample = spark.createDataFrame(data, "text string, toxic boolean")
    rigid = toxicity.rigid_entries(sample, ["moron", "hater"])
    assert rigid == {"hater"}
    automaton = toxicity.Automaton(["moron", "hater"], rigid)
    assert [automaton.match(w) for w in ("water", "hater", "morom")] == [None, 0, 1]


def test_made_examples():
    automaton = toxicity.Automaton(["moron", "idio*"])
    changed = toxicity.misspelt("You MORON and idiotic ant", automaton)
    assert changed.startswith("You ") and changed.endswith(" ant") and "MORON" not in changed and "idiotic" not in changed
    for text in ("", "one", "a longer text of words\nand lines"):
        quoted = toxicity.quoting(text, ["moron", "idio*"])
        assert len(quoted) > len(text) and set(text.split()) <= set(quoted.split())
