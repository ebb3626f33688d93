"""Small tables with odd rows, and plain Python versions of what the operators compute."""

from collections import Counter

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, size long, block int"
PASSAGE = " ".join(f"passage{i}" for i in range(60))


def documents(spark, folder="/root/testdata/sf0.001"):
    """Documents with nulls, empty and very long texts, repeated rows, ties, and columns that clash with internal names."""
    known = spark.read.parquet(f"{folder}/documents.parquet")
    odd = [
        (900_001, None, None, None), (900_002, "", "en", "src0"), (900_003, " \n\t\n", None, "src1"), (None, "no id " + PASSAGE, "en", "src1"),
        (None, "no id " + PASSAGE, "en", "src1"), (900_004, "twice " + PASSAGE, "en", None), (900_004, "twice " + PASSAGE, "en", None),
        (900_004, "other text " + PASSAGE, "en", None), (900_005, "1234 5678 !?", "de", "src2"), (900_006, "a b c", "en", "src2"),
        (900_007, "a b c", "en", "src2"), (900_008, "long " * 60_000, "en", "only"), (900_009, "é ß\x1c " * 40, "fr", "src3"),
        (-5, "before all " + PASSAGE, "en", "src3"), (900_010, "aaaa" * 100, "en", "src3"),
    ]
    rows = [(i, t, lang, s, None, "x", "y", 1, 2) for i, t, lang, s in odd]
    more = {"row": F.lit("x"), "key": F.lit("y"), "size": F.lit(1).cast("long"), "block": F.lit(2)}
    return known.withColumns(more).unionByName(spark.createDataFrame(rows, SCHEMA)).select(*spark.createDataFrame([], SCHEMA).columns)


def stored(spark, tmp_path, **tables):
    for name, frame in tables.items():
        frame.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def words(text):
    return (text or "").encode().split()


def near_classes(rows, threshold=0.8):
    """Per row number: class and links, from all pairs. rows: (doc_id, text)."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent, links = list(range(len(rows))), Counter()

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(least.get(find(i)), links[i]) for i in range(len(rows))]
