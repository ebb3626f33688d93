"""The operators against plain Python, and their defined results for odd rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import connect, spark_rows, sql_rows
from llm_fixtures import documents, near_classes, stored, words
from pyspark.sql import functions as F

from millrace.llm import langid, lines, mixing, neardup, packing, quality, queries, substrings, topk, toxicity, urls

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).persist()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


@pytest.fixture
def folder(spark, docs, tmp_path):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    return stored(spark, tmp_path, documents=docs, labels=labels)


@pytest.fixture
def empty(spark, docs, tmp_path):
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    none = spark.createDataFrame([], LABELS)
    return stored(spark, tmp_path, documents=docs.where("false"), labels=none, embeddings=vectors, pages=pages)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_empty_tables(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_same_rows_as_sql(spark, sf_dir, name):
    columns, found = spark_rows(queries.QUERIES[name](spark, sf_dir))
    expected_columns, expected = sql_rows(connect(sf_dir), queries.ORACLES[name])
    assert columns == expected_columns
    assert found == expected


def test_toxicity(spark, sf_dir, folder, rows):
    found = queries.QUERIES["op1_toxicity"](spark, folder).collect()
    assert sorted(r["doc_id"] or 0 for r in found) == sorted(i or 0 for i, _ in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.op1_toxicity(spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in scored]) > 0.9


def test_automaton_finds_what_edit_distance_finds():
    rng = np.random.default_rng(0)
    letters = list("abcd")
    word = lambda low, high: "".join(rng.choice(letters, rng.integers(low, high)))
    lexicon = sorted({word(3, 11) for _ in range(25)})
    automaton = toxicity.Automaton(lexicon)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        return row[-1]

    for _ in range(1500):
        text = word(1, 12)
        near = [d for e in lexicon if (d := distance(text, e)) <= toxicity.edits_allowed(len(e), False)]
        assert automaton.match(text) == min(near, default=None)
        assert not near or automaton.alive(text[:4])


def test_learned_words_keep_their_edits(spark):
    """Stems stand beside the words they begin, so that a misspelling in the first letters is found."""
    insults = ["idiot", "worthless", "moron", "disgusting"]
    data = [(f"text{i} goes on like this you {insults[i % 4]}", True) for i in range(40)] + [(f"text{i} is fine", False) for i in range(80)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(data, "text string, toxic boolean"))
    automaton = toxicity.Automaton(lexicon)
    assert set(insults) <= set(lexicon) and "idio*" in lexicon
    assert [automaton.match(w) for w in ("idiotic", "1diot", "id1ot", "mooron", "w0rthless", "dsgusting")] == [0, 1, 1, 1, 1, 1]
    assert toxicity.features("such a 1diot", automaton)[toxicity.FEATURES.index("near")] > 0


def test_rare_and_quoted_terms_are_learned(spark):
    """A slur in 8 of 1000 toxic texts, and one that clean texts quote too; not a word of copies of one text."""
    own = lambda kind, i: " ".join(f"{kind}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{i // 676}{c}" for c in "abcdef")
    data = [(f"{own('t', i)} you {'scumbag' if i < 8 else 'clown' if i < 200 else 'trash'}", True) for i in range(1000)]
    data += [(f"{own('c', i)} he said clown" if i < 60 else own("c", i), False) for i in range(3000)]
    data += [(f"{' '.join(f'long{i}' for i in range(60))} copied version{i}", True) for i in range(60)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(data, "text string, toxic boolean"))
    assert {"scumbag", "clown", "trash"} <= set(lexicon)
    assert not any(t.startswith("copi") for t in lexicon)


def test_quotation_counts_apart_from_abuse():
    automaton = toxicity.Automaton(["moron"])
    bare = dict(zip(toxicity.FEATURES, toxicity.features("you moron go away", automaton), strict=True))
    quoted = dict(zip(toxicity.FEATURES, toxicity.features('it reads "a morom here" on the wall', automaton), strict=True))
    assert bare["bare"] and bare["exact"] and not bare["quoted"]
    assert quoted["quoted"] and quoted["near"] and not quoted["bare"]


def brute_repeats(rows, length=100):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, (rows[i][1] or "").encode()))
    seen, out = set(), {}
    for i in order:
        data = (rows[i][1] or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            if s in seen:
                gone[p : p + length] = True
            seen.add(s)
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out[i] = (rows[i][0], len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted(out.values(), key=repr)


@pytest.mark.parametrize("sizes", [(1 << 22, 1 << 24), (60_000, 100_000)])
def test_suffix_array_dedup(docs, rows, sizes):
    found = substrings.dedup(docs, *sizes).drop("kept").collect()
    assert sorted(map(tuple, found), key=repr) == brute_repeats(rows)


def test_deep_shallow_sorts():
    rng = np.random.default_rng(1)
    text = bytes(rng.choice(list(b"ab\0"), 600).tolist()) + b"x" * 90 + b"ab" * 90 + b"x" * 90
    strings = list({text[i : i + 70] for i in range(len(text))})
    order, shared = substrings.deep_shallow(strings)
    assert [strings[i] for i in order] == sorted(strings)
    for a, b, n in zip(order, order[1:], shared[1:], strict=False):
        assert substrings.shared_prefix(strings[a], strings[b]) == n


def test_topk_with_odd_vectors(spark):
    rng = np.random.default_rng(2)
    data = [(int(i), [float(x) for x in rng.normal(size=8)]) for i in range(400)]
    data += [(500, data[0][1]), (501, data[0][1]), (500, data[0][1]), (550, None), (600, [None] * 8), (650, [float("nan")] * 8),
             (700, []), (750, [float("inf")] * 8), (None, data[1][1]), (800, [0.5, 0.25]), (801, [1.0, 0.0])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    vectors = frame.select("vec_id", topk.quantised(F.col("embedding")).alias("v")).where("v IS NOT NULL")
    found = defaultdict(list)
    for r in topk.nearest(vectors, vectors.where("vec_id % 50 = 0"), 5, shard=60, block=4).orderBy("rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    sound = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in data if i is not None and v and None not in v and np.isfinite(v).all()]
    queries = {i: v for i, v in sound if i % 50 == 0}
    assert set(found) == {q for q, v in queries.items() if any(len(w) == len(v) and i != q for i, w in sound)}
    for q, v in queries.items():
        best = sorted(((-int(v @ w), i) for i, w in sound if i != q and len(w) == len(v)))[:5]
        assert found[q] == [(i, -s) for s, i in best]


def test_quality_counts(spark, folder, rows):
    found = queries.QUERIES["op4_quality_rules"](spark, folder).collect()
    expected = []
    for doc_id, text in rows:
        w = (re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {i + k for i, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if windows[g] > 1 for k in range(3)}
        seen, dup = set(), 0
        for line in (text or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        n = len(w)
        expected.append((doc_id, n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n))
    names = ["doc_id", *quality.COUNTS, "base_failed"]
    assert sorted((tuple(r[c] for c in names) for r in found), key=repr) == sorted(expected, key=repr)
    assert all(not r["kept"] for r in found if r["base_failed"])


def test_trees_are_monotone_and_learn():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 3))
    y = (x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.1 * rng.normal(size=3000) < 0.6).astype(float)
    trees = quality.fit(x, y, np.array([-1, 0, 0]))
    assert ((trees.score(x) >= 0.5) == y).mean() > 0.9
    for _ in range(50):
        line = np.repeat(rng.random((1, 3)), 40, 0)
        line[:, 0] = np.linspace(0, 1, 40)
        assert (np.diff(trees.score(line)) <= 1e-12).all()


def test_language_id(spark, sf_dir, folder, rows):
    found = queries.QUERIES["op5_language_id"](spark, folder).collect()
    assert len(found) == len(rows)
    texts = defaultdict(list)
    for doc_id, text in rows:
        texts[doc_id].append(text)
    for r in found:
        assert 0 <= r["score"] <= 1
        no_letter = [t is None or not any(map(str.isalpha, t)) for t in texts[r["doc_id"]]]
        assert (r["lang_pred"] == "und") in no_letter
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    known = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    scored = langid.op5_language_id(spark, sf_dir).join(known, "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in scored]) > 0.97


def test_a_long_text_scores_as_in_pieces(monkeypatch):
    text = "the quick brown fox " * 500
    whole = sorted(b for _, bucket in langid.hashed_ngrams([text]) for b in bucket.tolist())
    monkeypatch.setattr(langid, "CHUNK", 37)
    assert sorted(b for _, bucket in langid.hashed_ngrams([text]) for b in bucket.tolist()) == whole


def test_packing(spark, docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path("byte_bpe_50k.json"))
    pieces = packing.pack(docs.select("doc_id", "text", "source"), packing.tokenizer_path(), partition=30_000).collect()
    ids = {}
    for doc_id, text in rows:
        ids.setdefault(doc_id, []).append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0])
    assert sum(p["length"] for p in pieces) == sum(len(x) for texts in ids.values() for x in texts)
    for p in pieces:
        ends = p["start"] + p["length"]
        texts = [x for x in ids[p["doc_id"]] if len(x) == p["doc_tokens"]]
        assert any(zlib.crc32(np.array(x[p["start"] : ends], "<u4").tobytes()) == p["ids_crc32"] for x in texts)
    filled = defaultdict(list)
    for p in pieces:
        filled[p["sequence_id"]].append((p["offset"], p["length"]))
    for at, parts in filled.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == 1024 or at == max(filled)
    shares = Counter()
    for p in pieces:
        shares[p["source_key"], p["sequence_id"]] += p["length"]
    total = Counter()
    for (source, _), n in shares.items():
        total[source] += n
    largest = max(total, key=total.get)
    part = np.array([shares[largest, i] for i in range(max(filled))]) / 1024
    assert abs(part.mean() - total[largest] / sum(total.values())) < 0.05


def test_line_dedup(spark, docs):
    own = [" ".join("unlike" + chr(97 + i) + chr(97 + j) for j in range(6)) for i in range(8)]
    texts = [f"Posted by user{i} at 10:{i:02d} today\n{own[i]}\nshort" for i in range(8)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(8, None), (9, ""), (None, texts[0])], "doc_id long, text string")
    found = {r["doc_id"]: r for r in lines.without_recurring(frame).collect()}
    assert found[None]["n_dropped"] == 0  # null ids come first
    assert found[3]["text"].startswith("unlike") and found[3]["n_dropped"] == 1
    assert (found[8]["text"], found[8]["n_lines"]) == (None, 0)
    assert (found[9]["text"], found[9]["n_lines"]) == ("", 1)
    cleaned = lines.without_recurring(docs)
    assert cleaned.count() == docs.count()
    assert cleaned.where("n_dropped = 0 AND NOT text <=> row.text").count() == 0
    plan = cleaned._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_url_rules_and_links(spark):
    page = lambda i, url, *links: (i, url, "".join(f'<a href="{x}">x</a>' for x in links))
    data = [
        page(1, "https://a.example.net/en/x", "https://good.example.com/1"), page(2, "http://x.net/", "/own"),
        page(3, "HTTP://Bad.example.com/de/?q", "https://other.org/"), page(4, "https://bad.example.com/de/2"),
        page(5, "https://farm.example.org/", "https://bad.example.com/de/2"), page(6, "https://good.example.com/1"),
        page(7, "https://b.org/fr/x#y"), page(8, "no host"), page(9, None), (10, "https://lonely.org", None), page(11, "http://net"),
    ]
    frame = spark.createDataFrame(data, "page_id long, url string, html string")
    found = {r["page_id"]: r for r in urls.judge(frame).collect()}
    assert [found[i]["rule"] for i in (1, 2, 3, 7, 8, 11)] == ["example.net/en/", "net/", "example.com/de/", "org/fr/", None, None]
    assert (found[3]["host"], found[3]["path"]) == ("bad.example.com", "/de/")
    assert (found[8]["host"], found[8]["path"], found[9]["host"], found[9]["path"]) == ("", "", "", "")
    assert found[5]["verdict"] == "block"  # it links to a blocked host
    assert [found[i]["verdict"] for i in (6, 8, 9, 10)] == ["allow"] * 4
    assert found[6]["trust"] > 0


def test_distrust_goes_down_long_chains_and_settles_in_cycles(spark):
    chain = [(f"h{i}", f"h{i + 1}", 1.0) for i in range(14)]
    cycle = [("a", "b", 1.0), ("b", "c", 1.0), ("c", "a", 1.0)]
    edges = spark.createDataFrame(chain + cycle, "src string, dst string, weight double")
    seeds = spark.createDataFrame([("h0", 0.5), ("a", 0.5)], "host string, seed double")
    found = {r["host"]: r["score"] for r in urls.spread(edges, seeds).collect()}
    assert [found[f"h{i}"] for i in range(15)] == pytest.approx([0.075 * 0.85**i for i in range(15)])
    assert [found[x] for x in "abc"] == pytest.approx([0.075 * 0.85**i / (1 - 0.85**3) for i in range(3)], abs=1e-5)


def test_near_duplicates(docs, rows):
    found = neardup.near_duplicates(docs.select("doc_id", "text")).select("doc_id", "class_id", "n_links").collect()
    expected = [(d, c, n) for (d, _), (c, n) in zip(rows, near_classes(rows), strict=True)]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_groups_of_sketches():
    """Components by reach are those of the whole matrix of links, also between two blocks."""
    random = np.random.default_rng(1)
    for i in range(200):
        n, least = random.integers(1, 60), random.integers(7, 13)
        x, block = random.integers(0, 2, (n, 12)).astype(np.uint8), random.integers(0, 2, n)
        linked = (x[:, None] == x[None]).sum(2) >= least
        if i % 2:
            linked &= block[:, None] != block[None]
        assert (neardup.sketch_groups(x, block, bool(i % 2), least) == neardup.local_stars(linked)).all()


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """A group larger than a block: every link is counted."""
    for module, name, value in ((neardup, "BLOCK_MEMBERS", 8), (neardup, "BLOCK_WORDS", 600), (neardup, "FREQUENT", 3)):
        monkeypatch.setattr(module, name, value)
    base = [f"w{i}" for i in range(120)]
    data = []
    for i in range(40):
        text = list(base)
        text[3 * i] = f"new{i}"
        data.append((i, " ".join(text)))
    frame = spark.createDataFrame(data, "doc_id long, text string")
    found = sorted(tuple(r) for r in neardup.near_duplicates(frame).select("class_id", "n_links", "doc_id").collect())
    assert found == sorted((c, n, d) for (d, _), (c, n) in zip(data, near_classes(data), strict=True))


def test_mixing(docs, rows):
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    mixed = mixing.curriculum(docs, mixing.word_count(F.col("text")), key).collect()
    assert len(mixed) == len(rows)
    sizes = Counter()
    for r in mixed:
        assert r["size"] == len(words(r["row"]["text"]))
        sizes[r["row"]["source"]] += r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, full, total = {}, set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in order if s not in full)
        target = {s: 3 * sizes[s] if s in full else weight[s] * left / open_weight for s in order}
        over = {s for s in order if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            break
        full |= over
    taken, largest = Counter(), Counter()
    for r in mixed:
        source = r["row"]["source"]
        assert r["target"] == pytest.approx(target[source])
        assert 0 <= r["copies"] <= 3 and len(r["positions"]) == r["copies"]
        assert all(0 <= p <= 1 + 1e-9 for p in r["positions"])
        taken[source] += r["size"] * r["copies"]
        largest[source] = max(largest[source], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in order)
    ordered = mixing.training_order(mixing.curriculum(docs, mixing.word_count(F.col("text")), key))
    places = [r["position"] for r in ordered.select("position").collect()]
    assert places == sorted(places)
