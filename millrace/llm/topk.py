"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Vectors are dealt into shards. A shard's index is cut into segments of postings by quantised impact, the
largest components first. Queries read the segments in that order and add what they find to the scores they
know. What is unread can change a score by at most the query's weights times the limit of the segments left. The search of a shard
stops only on proof: a vector whose score cannot reach the k-th best sure score is no member; the few that
are left are scored exactly in integers. Queries go to every shard in blocks; nothing is broadcast.

Vectors that are null, empty or hold null or non-finite components take no part, nor do rows without id. A query sees
vectors of its own length. Candidates are all rows with another id than the query's; repeated rows are
candidates each, and one query together. Fewer than k candidates: all of them. Ties: the smaller id.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import bounded_batches, table, written

SHARD = 8_192
BLOCK = 512
#: Queries of a block that are searched together.
STEP = 128
#: So many possible members are scored exactly rather than told apart by further segments.
FEW = 64


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null where the vector takes no part."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when((F.size(vector) > 0) & sound, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


class Shard:
    """The index of some vectors: posting segments by descending quantised impact.

    The impact of a posting is the bit length of its component's size; a segment holds all postings of one impact.
    """

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.x = ids, x
        size = np.abs(x)
        self.largest = size.max(0).astype(float)
        impact = np.frexp(size.astype(float))[1]
        self.segments = []
        for at in range(int(impact.max()), 0, -1):
            rows, dims = np.nonzero(impact == at)
            # What later segments hold is smaller than this.
            self.segments.append((float(1 << (at - 1)) if at > 1 else 0.0, rows, dims, x[rows, dims].astype(float)))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the query, ids and scores of every query's best k."""
        n = len(self.ids)
        own = self.ids[None, :] == query_ids[:, None]
        possible = ~own
        # Doubles hold the sums exactly below this; above it, every vector is scored exactly.
        if np.abs(queries).max() * self.largest.max() * queries.shape[1] < 2**52:
            open_ = np.flatnonzero(possible.sum(1) > max(k, FEW))
            known = np.zeros((len(open_), n))
            for limit, rows, dims, values in self.segments:
                if not len(open_):
                    break
                segment = np.zeros((self.x.shape[1], n))
                segment[dims, rows] = values
                weights = queries[open_].astype(float)
                known += weights @ segment
                rest = np.abs(weights) @ np.minimum(limit, self.largest)
                sure = np.where(own[open_], -np.inf, known)
                least = np.partition(sure, n - k, axis=1)[:, n - k] - 2 * rest
                members = sure >= least[:, None]
                done = (members.sum(1) <= FEW) | (rest == 0)
                possible[open_[done]] = members[done]
                open_, known = open_[~done], known[~done]
        out = []
        for i, query in enumerate(queries):
            rows = np.flatnonzero(possible[i] & ~own[i])
            scores = self.x[rows] @ query
            best = np.lexsort((self.ids[rows], -scores))[:k]
            out.append((np.full(len(best), i), self.ids[rows[best]], scores[best]))
        return tuple(map(np.concatenate, zip(*out, strict=True)))


def nearest(vectors: DataFrame, queries: DataFrame, k: int, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of every query's best k. vectors, queries: vec_id and v (integers, not null)."""
    bounded_batches(vectors.sparkSession)
    vectors = written(vectors.where("vec_id IS NOT NULL").withColumn("dims", F.size("v")), "vectors")
    queries = written(queries.where("vec_id IS NOT NULL").distinct().withColumn("dims", F.size("v")), "queries")
    shards = max(1, -(-vectors.count() // shard))
    blocks = max(1, -(-queries.count() // block))

    def part(n: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(n)).cast("int")

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        ids = rows["vec_id"].to_numpy(np.int64)
        x = np.stack(rows["v"].to_numpy()).astype(np.int64)
        return pd.DataFrame({"dims": [x.shape[1]], "part": [rows["part"].iloc[0]], "ids": [ids.tobytes()], "x": [x.tobytes()]})

    packed = "dims int, part int, ids binary, x binary"
    shard_rows = vectors.withColumn("part", part(shards)).groupBy("dims", "part").applyInPandas(pack, packed)
    block_rows = queries.withColumn("part", part(blocks)).groupBy("dims", "part").applyInPandas(pack, packed)
    shard_rows = shard_rows.withColumnRenamed("part", "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    block_rows = block_rows.withColumnRenamed("part", "block").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def unpack(row) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["x"], np.int64).reshape(-1, row["dims"])

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            index, (query_ids, x) = Shard(*unpack(left.iloc[0])), unpack(right.iloc[0])
            number = np.array([zlib.crc32(q.tobytes()) for q in x])
            for start in range(0, len(x), STEP):
                at, ids, scores = index.search(query_ids[start : start + STEP], x[start : start + STEP], k)
                at += start
                out.append(pd.DataFrame({"query_id": query_ids[at], "number": number[at], "vec_id": ids, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "number": [], "vec_id": [], "score": []}, dtype="int64")

    key = ["dims", "shard", "block"]
    found = shard_rows.groupBy(*key).cogroup(block_rows.groupBy(*key)).applyInPandas(search, "query_id long, number long, vec_id long, score long")
    order = Window.partitionBy("query_id", "number").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op3_exact_topk(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", quantised(F.col("embedding")).alias("v")).where("v IS NOT NULL")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"), 5)


OP3_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
