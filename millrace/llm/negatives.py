"""Hard-negative mining by inner product, with bounds along spanning trees of anchors.

Anchors are sorted by the signs of random projections and cut into blocks, and these into trees: minimal spanning trees by
Euclidean distance. Candidates are dealt into shards. In a shard, a tree's root is scored against every candidate. Going
down an edge, the score of a candidate changes by at most the edge's length times the candidate's norm; so the score at
the parent, known or bounded itself, bounds that at the child. Only candidates whose bounds overlap the window that the
child looks for are scored exactly, in integers; the others pass their wider bounds on.

There are two passes. In the first, the window of an anchor is all from its k-th best lower bound up, and what is found are its
positives: the best rows of its label. In the second it is what the shares allow below its positives' scores; what is
found are the best rows of other labels for each positive. Both merge the few best of each shard.

Rows without id, label or vector, with an empty vector or a component that is null or not finite take no part; an anchor
sees vectors of its own length. Scores are exact below 2**52. A row that comes twice (id, label and vector alike) counts once; rows of one id that differ
are rows of their own. Ties: the smaller id. Fewer than k: all of them. An anchor without positives, or a positive
without negatives, gives no row; an empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import bounded_batches, table, written
from millrace.llm.topk import quantised

#: Candidates of a shard, anchors of a block and of a tree; a shard and a block meet in one task.
SHARD = 16_384
BLOCK = 2_048
TREE = 128
#: Candidates that are bounded together.
STEP = 4_096
#: Share of the widest bound that is added for rounding.
SLACK = 1e-9
PACKED = "ids binary, labels binary, numbers binary, x binary, width int"


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of visit, parent (the root's is itself) and length of the edge to it, of a minimal spanning tree of the rows of x."""
    norm = (x * x).sum(1)
    distance = np.sqrt(np.maximum(norm[:, None] + norm[None, :] - 2 * (x @ x.T), 0))
    n = len(x)
    parent, edge, order = np.zeros(n, np.int64), distance[0].copy(), [0]
    out = np.ones(n, bool)
    out[0] = False
    for _ in range(n - 1):
        at = int(np.argmin(np.where(out, edge, np.inf)))
        order.append(at)
        out[at] = False
        closer = out & (distance[at] < edge)
        edge[closer], parent[closer] = distance[at][closer], at
    # Lengths anew from the differences, which are whole numbers: the ones above have lost digits.
    return np.array(order), parent, np.sqrt(((x - x[parent]) ** 2).sum(1))


class Candidates:
    """Some rows that anchors are held against."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, numbers: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.labels, self.numbers, self.values = ids, labels, numbers, x.astype(float)
        self.norm = np.sqrt((self.values * self.values).sum(1))

    def scores(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Inner products of some rows; sums of whole numbers, which doubles hold exactly below 2**52."""
        if 2 * rows.sum() > len(rows):
            return (self.values @ anchor)[rows]
        return self.values[rows] @ anchor

    def walk(self, anchors: np.ndarray, visit) -> None:
        """Every anchor once, parents first: ``visit(anchor number, low, high)`` gets the bounds of all
        candidates' scores and returns those to be scored, then takes their exact scores."""
        for start in range(0, len(anchors), TREE):
            x = anchors[start : start + TREE].astype(float)
            order, parent, edge = spanning_tree(x)
            children = np.bincount(parent, minlength=len(x))
            bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for at in order:
                if at == order[0]:
                    middle, radius = np.zeros(len(self.ids)), np.full(len(self.ids), np.inf)
                else:
                    middle, radius = bounds[parent[at]]
                    radius = radius + edge[at] * self.norm * (1 + SLACK)
                    children[parent[at]] -= 1
                    if not children[parent[at]]:
                        del bounds[parent[at]]
                wanted, take = visit(start + at, middle - radius, middle + radius)
                if at == order[0]:
                    wanted = np.ones(len(self.ids), bool)
                exact = self.scores(x[at], wanted)
                if children[at]:
                    middle, radius = middle.copy(), radius.copy()
                    middle[wanted], radius[wanted] = exact, 0
                    bounds[at] = middle, radius
                take(np.flatnonzero(wanted), exact)


def best(k: int, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    keep = np.flatnonzero(scores >= kth(scores, k))
    return keep[np.lexsort((ids[rows[keep]], -scores[keep]))[:k]]


def kth(values: np.ndarray, k: int) -> float:
    """The k-th largest value, or minus infinity."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def positives_of(block: dict, shard: dict, k: int) -> pd.DataFrame:
    """Each anchor's k best other rows of its label among the rows of a shard."""
    out = []
    # What each anchor has at least, from the candidates before.
    reached = np.full((len(block["ids"]), k), -np.inf)
    for c in steps(shard):

        def visit(a, low, high, c=c):
            own = (c.ids == block["ids"][a]) & (c.numbers == block["numbers"][a])
            fit = (c.labels == block["labels"][a]) & ~own
            wanted = fit.copy()
            wanted[fit] = high[fit] >= kth(np.concatenate([reached[a], low[fit]]), k)

            def take(rows, scores):
                mine = fit[rows]
                rows, scores = rows[mine], scores[mine]
                top = best(k, rows, scores, c.ids)
                reached[a] = np.sort(np.concatenate([reached[a], scores[top]]))[-k:]
                out.append((np.full(len(top), a), c.ids[rows[top]], c.numbers[rows[top]], scores[top]))

            return wanted, take

        c.walk(block["x"], visit)
    return frame(out, ["slot", "found_id", "found_number", "score"])


def negatives_of(block: dict, windows: dict, shard: dict, k: int, low_share: int, high_share: int) -> pd.DataFrame:
    """For each anchor and each score of its positives, the k best rows of other labels inside the window."""
    out = []
    for c in steps(shard):

        def visit(a, low, high, c=c):
            scores_of = windows.get(a, [])
            fit = c.labels != block["labels"][a]
            wanted = np.zeros(len(fit), bool)
            for p in scores_of:
                least = low_share * p / 100
                # Rows that are inside for certain raise the floor.
                sure = fit & (low >= least) & (100 * high <= high_share * p)
                floor = max(least, kth(low[sure], k))
                wanted |= fit & (high >= floor) & (100 * low <= high_share * p)

            def take(rows, scores):
                rows, scores = rows[fit[rows]], scores[fit[rows]]
                for p in scores_of:
                    inside = (low_share * p <= 100 * scores) & (100 * scores <= high_share * p)
                    some, theirs = rows[inside], scores[inside]
                    top = best(k, some, theirs, c.ids)
                    out.append((np.full(len(top), a), np.full(len(top), p), c.ids[some[top]], theirs[top]))

            return wanted, take

        c.walk(block["x"], visit)
    return frame(out, ["slot", "positive_score", "negative_id", "negative_score"])


def frame(parts: list[tuple], names: list[str]) -> pd.DataFrame:
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0)] * len(names)
    return pd.DataFrame({n: c.astype(np.int64) for n, c in zip(names, columns, strict=True)})


def steps(shard: dict):
    for start in range(0, len(shard["ids"]), STEP):
        part = slice(start, start + STEP)
        yield Candidates(shard["ids"][part], shard["labels"][part], shard["numbers"][part], shard["x"][part])


def packed_rows(rows: pd.DataFrame) -> dict:
    """The rows of a group as one row of arrays, in the narrowest integers that hold them."""
    rows = rows.sort_values([*(["code"] if "code" in rows else []), "vec_id", "number"])
    x = np.stack(rows["v"].to_numpy()).astype(np.int64)
    width = next((w for w in (1, 2, 4) if -(1 << 8 * w - 1) <= x.min() and x.max() < 1 << 8 * w - 1), 8)
    as_bytes = lambda c: c.to_numpy(np.int64).tobytes()
    return {
        "ids": as_bytes(rows["vec_id"]),
        "labels": as_bytes(rows["label"]),
        "numbers": as_bytes(rows["number"]),
        "x": x.astype(f"i{width}").tobytes(),
        "width": width,
    }


def unpacked(row) -> dict:
    out = {n: np.frombuffer(row[n], np.int64) for n in ("ids", "labels", "numbers")}
    return out | {"x": np.frombuffer(row["x"], f"i{row['width']}").reshape(len(out["ids"]), -1).astype(np.int64)}


def signs(vectors: pd.Series) -> pd.Series:
    """32 signs of random projections as a number; neighbours mostly agree in the first ones."""
    out = np.zeros(len(vectors), np.int64)
    by_length = vectors.map(len)
    for n in by_length.unique():
        rows = np.flatnonzero(by_length == n)
        x = np.stack(vectors.iloc[rows].to_numpy()).astype(float)
        up = x @ np.random.default_rng(n).standard_normal((n, 32)) > 0
        out[rows] = up @ (1 << np.arange(31, -1, -1, dtype=np.int64))
    return pd.Series(out)


def hard_negatives(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low_share: int = 80, high_share: int = 100,
    shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: vec_id, label and v, an array of integers; anchors: the condition that names the anchors. A negative's
    score is from low_share to high_share hundredths of its positive's.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND size(v) > 0").select(
        "vec_id", F.col("label").cast("long").alias("label"), "v", F.size("v").alias("dims"), F.xxhash64("label", "v").alias("number")
    )
    rows = written(rows.dropDuplicates(["vec_id", "number"]), "rows")
    shards = max(1, -(-rows.count() // shard))
    part = F.pmod(F.xxhash64("vec_id", "number"), F.lit(shards)).cast("int")

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"dims": group["dims"].iloc[0], "part": group["part"].iloc[0]} | packed_rows(group)])

    packed = f"dims int, part int, {PACKED}"
    shard_rows = rows.withColumn("part", part).groupBy("dims", "part").applyInPandas(pack, packed)
    shard_rows = written(shard_rows, "shards")

    code = F.pandas_udf(signs, "long")
    chosen = written(rows.where(anchors).withColumn("code", code("v")), "anchors")
    blocks = max(1, -(-chosen.count() // block))
    # Ranges of the code, so that a block's anchors are neighbours; ids split a code that very many anchors share.
    chosen = chosen.repartitionByRange(blocks, "dims", "code", "vec_id", "number").withColumn("part", F.pmod(F.spark_partition_id(), F.lit(blocks)))
    block_rows = written(written(chosen, "dealt").groupBy("dims", "part").applyInPandas(pack, packed), "blocks")

    def grid(frame: DataFrame, own: str, other: str, n: int) -> DataFrame:
        return frame.withColumnRenamed("part", own).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))

    key = ["dims", "shard", "block"]
    by_shard = grid(shard_rows, "shard", "block", blocks).groupBy(*key)

    def find_positives(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return frame([], ["slot", "found_id", "found_number", "score"]).assign(dims=0, block=0)
        found = positives_of(unpacked(right.iloc[0]), unpacked(left.iloc[0]), positives)
        return found.assign(dims=left["dims"].iloc[0], block=left["block"].iloc[0])

    found = by_shard.cogroup(grid(block_rows, "block", "shard", shards).groupBy(*key)).applyInPandas(
        find_positives, "slot long, found_id long, found_number long, score long, dims int, block int"
    )
    slot = ["dims", "block", "slot"]
    order = Window.partitionBy(*slot).orderBy(F.desc("score"), "found_id", "found_number")
    found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    found = written(found, "positives")
    windows = found.groupBy("dims", "block").agg(F.collect_set(F.struct("slot", "score")).alias("windows"))
    with_windows = block_rows.withColumnRenamed("part", "block").join(windows, ["dims", "block"])
    with_windows = with_windows.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def find_negatives(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return frame([], ["slot", "positive_score", "negative_id", "negative_score"]).assign(dims=0, block=0)
        wanted: dict[int, list[int]] = {}
        for w in right["windows"].iloc[0]:
            wanted.setdefault(w["slot"], []).append(w["score"])
        anchors, candidates = unpacked(right.iloc[0]), unpacked(left.iloc[0])
        out = negatives_of(anchors, wanted, candidates, negatives, low_share, high_share)
        return out.assign(dims=left["dims"].iloc[0], block=left["block"].iloc[0])

    mined = by_shard.cogroup(with_windows.groupBy(*key)).applyInPandas(
        find_negatives, "slot long, positive_score long, negative_id long, negative_score long, dims int, block int"
    )
    order = Window.partitionBy(*slot, "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    mined = mined.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)

    def anchor_ids(group: pd.DataFrame) -> pd.DataFrame:
        ids = np.frombuffer(group["ids"].iloc[0], np.int64)
        return pd.DataFrame({"dims": group["dims"].iloc[0], "block": group["part"].iloc[0], "slot": np.arange(len(ids)), "anchor_id": ids})

    names = block_rows.select("dims", "part", "ids").groupBy("dims", "part").applyInPandas(
        anchor_ids, "dims int, block int, slot long, anchor_id long"
    )
    pairs = found.select(*slot, F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        pairs.join(mined, [*slot, "positive_score"])
        .join(names, slot)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        quantised(F.col("embedding")).alias("v"),
    )
    return hard_negatives(rows.where("v IS NOT NULL"), F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH v AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
    SELECT a.vec_id AS anchor_id, a.v AS anchor, a.label AS anchor_label, c.vec_id, c.v, c.label,
        CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
    FROM v a JOIN v c ON len(a.v) = len(c.v) AND (a.vec_id, a.label, a.v) <> (c.vec_id, c.label, c.v) WHERE a.vec_id % 100 = 0),
p AS (
    SELECT *, row_number() OVER (PARTITION BY anchor_id, anchor_label, anchor ORDER BY score DESC, vec_id) AS place
    FROM s WHERE label = anchor_label),
n AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.anchor_label, p.anchor, p.vec_id, p.v ORDER BY s.score DESC, s.vec_id) AS rank
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.anchor_label = p.anchor_label AND s.anchor = p.anchor AND s.label <> s.anchor_label
    WHERE p.place <= 5 AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
