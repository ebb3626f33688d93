"""N-gram Jaccard join: banded MinHash LSH over shingles of five words, then exact verification.

Exact copies become one node first. Every node has a signature of TREES times DEPTH minima. Nodes that share a band,
the first minima of one of the TREES, are candidates; the same length, the longest for which all bands
together find a pair at the threshold with the target recall. It is not an LSH forest: no
prefix is shortened by what the data holds. Within a bucket, sketches of one byte per minimum tell
what may reach the threshold; what is linked so falls into tight groups, and inside these every pair is verified on its
whole shingle sets. Buckets and groups that are large are cut into blocks, and pairs of blocks are dealt out; only counts
of links and the edges of a spanning forest leave a task, never all pairs.

A text of one to four words is one shingle. Null, empty and blank texts: a class of their own each, no links. Rows
without id take part; a class is named by the smallest id in it. Repeated rows are documents each, and copies
of each other. Empty table: no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import bounded_batches, chunks, mix64, small, table, utf8_bytes, written

WORDS = 5
THRESHOLD = 0.8
TREES = 24
DEPTH = 6
RECALL = 0.9999
#: Members of a block of a bucket; words of a block of a group.
BLOCK_MEMBERS = 2_048
BLOCK_WORDS = 400_000
#: Rows of buckets, words of groups that go to Python together.
BATCH_MEMBERS = 40_000
BATCH_WORDS = 800_000
#: Documents to verify, up to which their keys are broadcast.
BROADCAST_ROWS = 500_000
#: A shingle in more documents than this is counted by a matrix product, others pair by pair.
FREQUENT = 24


def prefix_length(threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which a pair at the threshold is found with the target recall."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def least_matches(threshold: float = THRESHOLD, n: int = TREES * DEPTH) -> int:
    """Matching bytes of two sketches that a pair at the threshold reaches but for one in 17,000."""
    return math.floor(n * (threshold - 4 * math.sqrt(threshold * (1 - threshold) / n)))


def shingles(text: str | None, known: dict[bytes, int], size: int = WORDS) -> np.ndarray:
    """The different shingles of a text as 64-bit hashes, sorted. known remembers hashes of words."""
    words = utf8_bytes(text).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(known) > 500_000:
        known.clear()
    for word in set(words).difference(known):
        known[word] = xxhash.xxh3_64_intdigest(word)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    value = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        value = mix64(value + h[i : len(words) - size + 1 + i])
    return np.unique(value)


def signatures(sets: list[np.ndarray], n: int = TREES * DEPTH) -> np.ndarray:
    """One row of n minima for each set that is not empty."""
    out = np.zeros((len(sets), n), np.uint64)
    factors = mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    full = [i for i, s in enumerate(sets) if len(s)]
    for a, b in chunks([len(sets[i]) for i in full], 1 << 17):
        rows = full[a:b]
        values = np.concatenate([sets[i] for i in rows])
        starts = np.cumsum([0, *(len(sets[i]) for i in rows[:-1])])
        for j, factor in enumerate(factors):
            out[rows, j] = np.minimum.reduceat(values * factor, starts)
    return out


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text; null if it has no word), n (shingles), paths (four bytes per minimum), sketch (one byte)."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("n int, paths binary, sketch binary")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        known: dict[bytes, int] = {}
        sets = [shingles(None if pd.isna(t) else t, known) for t in texts]
        minima = signatures(sets)
        paths = ((minima >> np.uint64(16)) & np.uint64(0xFFFFFFFF)).astype("<u4")
        small = ((minima >> np.uint64(24)) & np.uint64(0xFF)).astype(np.uint8)
        return pd.DataFrame(
            {"n": [len(s) for s in sets], "paths": [p.tobytes() for p in paths], "sketch": [s.tobytes() for s in small]}
        )

    rows = docs.select("doc_id", text_key().alias("key"), sketch("text").alias("s")).select("doc_id", "key", "s.*")
    return rows.withColumn("key", F.when(F.col("n") > 0, F.col("key")))


def text_key(text: str = "text") -> Column:
    return F.unhex(F.md5(F.col(text).cast("binary")))


def local_stars(linked: np.ndarray) -> np.ndarray:
    """For a symmetric matrix of links, the smallest member of each one's component."""
    label = np.arange(len(linked))
    while True:
        nearest = np.where(linked, label, len(label)).min(1, initial=len(label))
        new = np.minimum(label, nearest)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def sketch_groups(x: np.ndarray, block: np.ndarray, across: bool, least: int) -> np.ndarray:
    """The smallest member of each one's component, where sketches with ``least`` equal bytes are linked.

    across: only members of different blocks are. Each member is compared with those that nothing has reached yet; so
    a group of near copies, which its first member reaches at once, costs little more than one pass.
    """
    label = np.arange(len(x))
    waiting = np.arange(len(x))
    while len(waiting):
        seed, waiting = waiting[0], waiting[1:]
        reached = np.array([seed])
        while len(reached) and len(waiting):
            node, reached = reached[0], reached[1:]
            linked = np.count_nonzero(x[waiting] == x[node], 1) >= least
            if across:
                linked &= block[waiting] != block[node]
            if linked.any():
                found, waiting = waiting[linked], waiting[~linked]
                label[found] = seed
                reached = np.r_[reached, found]
    return label


def units(rows: pd.DataFrame, names: list[str]):
    """The rows of each unit of a batch, with whether it is a pair of two blocks."""
    rows = rows.sort_values([*names, "block"], kind="stable")
    same = np.ones(len(rows), bool)
    for c in names:
        values = rows[c].to_numpy()
        same[1:] &= values[1:] == values[:-1]
    starts = np.flatnonzero(~same[1:]) + 1
    for part in np.split(np.arange(len(rows)), starts):
        yield rows.iloc[part[0] : part[-1] + 1]


def dealt_in_blocks(rows: DataFrame, name: str, blocks: Column, batches: int) -> DataFrame:
    """Every row goes to each pair of blocks (i <= j) that its own block is in; batch: where it is worked on."""
    rows = rows.withColumn("blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other)
    rows = rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other", "blocks")
    return rows.withColumn("batch", F.pmod(F.xxhash64(name, "i", "j"), F.lit(batches)).cast("int"))


def candidate_links(nodes: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Edges (a, b) of a forest over what shares a bucket and may reach the threshold. nodes: key, paths, sketch."""
    length, least = prefix_length(threshold, recall), least_matches(threshold)
    prefix = lambda t: F.xxhash64(t, F.substring(F.col("paths"), t * (4 * DEPTH) + 1, F.lit(4 * length)))
    members = nodes.select("key", F.explode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), prefix)).alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    members = written(members.join(buckets, "bucket"), "members")
    many = max(1, -(-members.count() // BATCH_MEMBERS))
    rows = members.join(nodes.select("key", "sketch"), "key")
    rows = dealt_in_blocks(rows, "bucket", F.ceil(F.col("size") / BLOCK_MEMBERS), many)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        for unit in units(rows, ["bucket", "i", "j"]):
            keys, block = unit["key"].to_numpy(), unit["block"].to_numpy()
            x = np.frombuffer(b"".join(unit["sketch"]), np.uint8).reshape(len(unit), -1)
            label = sketch_groups(x, block, unit["i"].iloc[0] != unit["j"].iloc[0], least)
            far = np.flatnonzero(label != np.arange(len(label)))
            a.append(keys[far])
            b.append(keys[label[far]])
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)}).drop_duplicates()

    cut = rows.select("batch", "bucket", "i", "j", "block", "key", "sketch")
    return cut.groupBy("batch").applyInPandas(compare, "a binary, b binary").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(key, component) of all nodes with an edge (a, b): the smallest key that can be reached."""
    both = edges.unionAll(edges.select("b", "a")).unionAll(edges.select("a", "a")).unionAll(edges.select("b", "b"))
    both = written(both.toDF("a", "b").distinct(), "edges")
    labels = both.groupBy("a").agg(F.min("b").alias("label"))
    while True:
        near = both.join(labels.withColumnsRenamed({"a": "b"}), "b").groupBy("a").agg(F.min("label").alias("near"))
        jump = labels.select(F.col("a").alias("near"), F.col("label").alias("far"))
        new = near.join(jump, "near").join(labels.withColumnRenamed("label", "old"), "a")
        new = written(new.select("a", F.least("near", "far").alias("label"), "old"), "labels")
        labels = new.select("a", "label")
        if new.where("label <> old").isEmpty():
            return labels.select(F.col("a").alias("key"), F.col("label").alias("component"))


def common(sets: list[np.ndarray]) -> np.ndarray:
    """The number of shingles that each pair of sets has in common."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, of, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often[of] > 1
    order = np.argsort(of[shared], kind="stable")
    of, owner = of[shared][order], owner[shared][order]
    counts = np.zeros((m, m))
    if not len(of):
        return counts
    starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    sizes = np.diff(np.r_[starts, len(of)])
    for size in np.unique(sizes[sizes <= FREQUENT]):
        rows = owner[starts[sizes == size][:, None] + np.arange(size)]
        left, right = np.triu_indices(size, 1)
        pair, often = np.unique((rows[:, left] * m + rows[:, right]).ravel(), return_counts=True)
        counts.ravel()[pair] += often
    counts += counts.T
    wide = np.flatnonzero(sizes > FREQUENT)
    for a in range(0, len(wide), 2048):
        column = np.zeros((m, len(wide[a : a + 2048])), np.float32)
        for c, w in enumerate(wide[a : a + 2048]):
            column[owner[starts[w] : starts[w] + sizes[w]], c] = 1
        counts += column @ column.T
    return counts


def verified(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, links): the links of a by exact Jaccard similarity, and b, a smaller member of its component or a itself.

    rows: component, key, copies, n, text. Sums of links over the rows of a are whole.
    """
    sizes = rows.groupBy("component").agg(F.sum("n").alias("words"))
    total = rows.agg(F.sum("n")).first()[0] or 0
    rows = rows.join(sizes, "component")
    rows = dealt_in_blocks(rows, "component", F.ceil(F.col("words") / BLOCK_WORDS), max(1, -(-total // BATCH_WORDS)))

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        known: dict[bytes, int] = {}
        a, b, links = [], [], []
        for unit in units(rows, ["component", "i", "j"]):
            sets = [shingles(t, known) for t in unit["text"]]
            block, copies, keys = unit["block"].to_numpy(), unit["copies"].to_numpy(float), unit["key"].to_numpy()
            size = np.array([len(s) for s in sets])
            both = common(sets)
            # both / (size + size' - both) >= threshold, in integers up to rounding of the threshold
            linked = both * (1 + threshold) >= threshold * (size[:, None] + size[None]) - 1e-9
            np.fill_diagonal(linked, False)
            if unit["i"].iloc[0] != unit["j"].iloc[0]:
                linked &= block[:, None] != block[None]
            some = linked.any(1)
            label = local_stars(linked)
            a.append(keys[some])
            b.append(keys[label[some]])
            links.append((linked @ copies)[some])
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b), "links": np.concatenate(links).astype(np.int64)})

    cut = rows.select("batch", "component", "i", "j", "block", "key", "copies", "text")
    return cut.groupBy("batch").applyInPandas(verify, "a binary, b binary, links long")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, key, component, class_id and n_links of every row of docs (doc_id, text).

    component: the key that names the class, also where ids are null or repeated; null if the text has no word.
    class_id: the smallest id among what links join. n_links: documents, copies included, at or above the threshold.
    """
    rows = written(sketched(docs), "sketches")
    nodes = rows.where("key IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("copies"), F.max("n").alias("n"),
        F.any_value("paths").alias("paths"), F.any_value("sketch").alias("sketch"),
    )
    nodes = written(nodes, "nodes")
    groups = components(candidate_links(nodes, threshold, recall))
    wanted = written(groups.join(nodes.select("key", "first", "copies", "n"), "key"), "groups")
    texts = docs.select(F.col("doc_id").alias("first"), "text", text_key().alias("key"))
    # Few documents are wanted as a rule; then the other texts need no shuffle.
    wanted = small(wanted.withColumnsRenamed({"first": "_first", "key": "_key"}), BROADCAST_ROWS)
    found = texts.join(wanted, F.col("first").eqNullSafe(F.col("_first")) & (F.col("key") == F.col("_key")))
    # A node of which a row is repeated is met once for each; one is enough.
    found = found.drop("_first", "_key").dropDuplicates(["first", "key"])
    links = written(verified(found, threshold), "verified")
    classes = components(links.where("a <> b").select("a", "b"))
    info = nodes.select("key", "first", "copies").join(classes, "key", "left")
    info = info.withColumn("component", F.coalesce("component", "key"))
    names = info.groupBy("component").agg(F.min("first").alias("class_id"))
    counts = links.groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    info = info.join(names, "component").join(counts, "key", "left")
    info = info.select("key", "component", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return rows.select("doc_id", "key").join(info, "key", "left").select(
        "doc_id", "key", "component",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def op9_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("key", "component")
