"""The stages of the corpus pipeline, each against plain Python on what it is given."""

from collections import Counter

import corpus_pipeline
from llm_fixtures import documents, near_classes, stored, words

from millrace.llm.packing import pack, stored_order, tokenizer_path
from millrace.llm.shared import written


def test_stages(spark, tmp_path):
    docs = written(documents(spark), "docs")
    folder = stored(spark, tmp_path, documents=docs)
    stages = dict(corpus_pipeline.STAGES)

    known = written(stages["language_id"](spark, docs, folder), "a")
    assert known.dtypes == docs.dtypes
    letters = [r for r in docs.collect() if r["text"] and any(map(str.isalpha, r["text"]))]
    assert 0.97 * len(letters) <= known.count() <= len(letters)

    clean = written(stages["line_dedup"](spark, known, folder), "b")
    assert clean.dtypes == docs.dtypes
    assert all(words(r["text"]) for r in clean.collect())

    one = written(stages["ngram_jaccard"](spark, clean, folder), "c")
    assert one.dtypes == docs.dtypes
    rows = [(r["doc_id"], r["text"]) for r in clean.collect()]
    classes = {(c, None if c is not None else t) for (_, t), (c, _) in zip(rows, near_classes(rows), strict=True)}
    kept = [(r["doc_id"], r["text"]) for r in one.collect()]
    assert len(kept) == len(classes)
    assert {d for d, _ in kept if d is not None} == {c for c, _ in classes if c is not None}

    mixed = written(stages["mix_sources"](spark, one, folder), "d")
    assert mixed.dtypes == docs.dtypes
    assert max(Counter((r["doc_id"], r["text"]) for r in mixed.collect()).values()) <= 3

    pieces = stages["pack_windows"](spark, mixed, folder)
    assert pieces.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


def test_verbatim_lines_go(spark, tmp_path):
    """Long lines from two documents on, also those full of digits; shorter ones from five, whatever their digits."""
    passage, figures = " ".join(f"word{chr(97 + i % 26)}{'x' * (i // 26)}" for i in range(60)), " ".join(map(str, range(60)))
    prices = "call 0800 123 456 now 99"
    own = lambda i: " ".join(f"unlike{chr(97 + i)}{chr(97 + j)}" for j in range(6))
    texts = [f"{own(i)}\n{prices}" + (f"\n{passage}\n{figures}\n{figures} {i}" if i < 2 else "") for i in range(6)]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    found = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, str(tmp_path)).collect()}
    assert found[0] == texts[0]
    assert found[1] == f"{own(1)}\n{figures} 1"
    assert [found[i] for i in range(2, 6)] == [own(i) for i in range(2, 6)]


def test_packing_keeps_the_training_order(spark):
    """Within a source later documents start later, copies stand a pass apart, and proportions follow the order."""
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    # Source a in the first half of the order, b mostly in the second; ids 0 to 99 of a come twice.
    order = [("a", i % 100) if k % 4 else ("b", 1000 + i) for k, i in enumerate(range(200))] + [("b", 2000 + i) for i in range(200)]
    rows = [(i, text(i), s, k) for k, (s, i) in enumerate(order)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, place int")
    docs = written(frame.repartitionByRange(4, "place").sortWithinPartitions("place").drop("place"), "docs")
    for size in (30_000, 2_000_000):
        pieces = pack(docs, tokenizer_path(), partition=size, order=stored_order(), chars=19).collect()
        pieces = sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"]))
        for source in "ab":
            starts = [p["doc_id"] for p in pieces if p["start"] == 0 and p["source_key"] == "s" + source]
            assert starts == [i for s, i in order if s == source]
        ends = [p["sequence_id"] * 1024 + p["offset"] + p["length"] for p in pieces]
        assert ends[:-1] == [p["sequence_id"] * 1024 + p["offset"] for p in pieces[1:]]
        half = [p["length"] for p in pieces if p["source_key"] == "sa"]
        late = [p["length"] for p in pieces if p["source_key"] == "sa" and p["sequence_id"] * 1024 > 0.55 * ends[-1]]
        assert sum(half) and not sum(late)


def test_classes_of_repeated_and_missing_ids(spark, tmp_path):
    """Unrelated texts under one id both stay; of near copies without ids one does."""
    text = lambda name: " ".join(f"{name}{i}" for i in range(200))
    rows = [(1, text("a")), (1, text("b")), (None, text("c")), (None, text("c") + " more"), (2, text("b") + " more")]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string"), "docs")
    kept = corpus_pipeline.ngram_jaccard(spark, docs, str(tmp_path)).collect()
    assert sorted(r["text"].split()[0] for r in kept) == ["a0", "b0", "c0"]
    assert [r["doc_id"] for r in kept if r["doc_id"] is not None] == [1, 1]


def test_an_empty_table_passes(spark, tmp_path):
    folder = stored(spark, tmp_path, documents=documents(spark).where("false"))
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_no_copy_is_torn(spark, tmp_path):
    """Of copies in the input, whatever lines they share, one stays, and whole; other documents lose their passage."""
    line = lambda name: " ".join(f"{name}{chr(97 + j // 26)}{chr(97 + j % 26)}" for j in range(55))
    copied = "\n".join(line(f"x{chr(97 + i)}") for i in range(12)) + "\n" + line("sh")
    rows = [(1, copied), (2, copied), (None, copied), (5, line("p") + "\n" + line("sh")), (6, line("q") + "\n" + line("xa"))]
    docs = written(spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long"), "docs")
    clean = written(corpus_pipeline.line_dedup(spark, docs, str(tmp_path)), "clean")
    found = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert found == {1: copied, 2: copied, None: copied, 5: line("p"), 6: line("q")}
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.ngram_jaccard(spark, clean, str(tmp_path)).collect()}
    assert kept == {1: copied, 5: line("p"), 6: line("q")}


def test_of_every_group_of_copies_in_the_input_one_stays(spark, tmp_path):
    """Exact copies of one text that language identification keeps: one is left. Pairs that are alike: most lose one member."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = written(corpus_pipeline.language_id(spark, docs, str(tmp_path)), "known")
    rows = [(r["doc_id"], r["text"]) for r in known.collect()]
    clean = written(corpus_pipeline.line_dedup(spark, known, str(tmp_path)), "clean")
    kept = {r["doc_id"] for r in corpus_pipeline.ngram_jaccard(spark, clean, str(tmp_path)).collect()}
    copies = Counter(t for _, t in rows)
    left = Counter(t for i, t in rows if i in kept and copies[t] > 1)
    assert len(left) > 20
    assert max(left.values()) == 1
    alike = Counter(c for (i, _), (c, links) in zip(rows, near_classes(rows), strict=True) if links and i in kept)
    print("left of classes", sorted(alike.values()))
    assert sum(n > 1 for n in alike.values()) <= 0.15 * len(alike)
