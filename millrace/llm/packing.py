"""Mixture-controlled packing: deficit round-robin over the queues of the sources.

Every window of 1024 tokens is filled with the sources in the proportions of their totals. A source's deficit is
what it is entitled to less what it has been given; it is served once that reaches a quantum, and what remains goes on
to the next window. Partitions hold equal shares of every source, to within a range of documents; each starts at
its token of the whole sequence, with the deficits that the partitions before it leave, both known from sums. So
windows run across partitions without a gap and only the last one of all is short. The ranges get finer as the tokens
grow, and one that holds much of a partition, as thousands of rows of one id and text do, is split once more.

Documents that come in training order keep it: a queue is sorted by file and row of the table, partitions are
stretches of the order, and what a source is entitled to follows its tokens along the order, so that the proportions
of the windows change as the order has them. All sources end with their partition, so none starts with a deficit.

Null text: only the closing id 0. Null source: a source of its own. Repeated rows are packed each. Empty table: no rows.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.mixing import source_key
from millrace.llm.shared import bounded_batches, running_total, small, table, written

WINDOW = 1024
#: Tokens from which a waiting source is served.
QUANTUM = 64
#: Rows of the training order over which the proportions of the sources are taken; digits of its keys that name a range of 256.
STEP = 16
STORED_RANGE = 18
#: Tokens of a partition, about.
PARTITION = 2_000_000
#: Rows of the table of ranges up to which it is broadcast, as its size is then known to be small.
SMALL = 500_000
#: Ranges of a source to a partition, at least, and the bits of the keys that name a range, at least.
FINE = 4
BITS = 12
#: Digits of a key that name a range where one range holds much of a partition: the hash, and four of the salt.
SPLIT = 36
SPACES = re.compile(r"\s\s")


class Encoder:
    """Ids of a byte-level BPE, as two bytes each, from its file of ranks.

    They are those that ``tokenizers`` gives with the JSON file of the same vocabulary, without added special tokens; the
    tests compare them. The pattern's look-ahead matters only where white space runs over several characters;
    for all other texts it is left out, which doubles the speed.
    """

    def __init__(self, path: str, special: str = "<|endoftext|>") -> None:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        if len(ranks) >= 1 << 16:
            raise ValueError("ids of more than two bytes")
        pattern = public_tokenizers.PATTERN
        self.exact, self.fast = (
            tiktoken.Encoding("ranks", pat_str=p, mergeable_ranks=ranks, special_tokens={special: len(ranks)})
            for p in (pattern, pattern.replace(r"|\s+(?!\S)", ""))
        )

    def encode(self, text: str) -> bytes:
        model = self.exact if SPACES.search(text) else self.fast
        return model.encode_to_numpy(text, allowed_special="all").astype("<u2").tobytes()


def hash_order() -> Column:
    """The hash of a row's id and text, then eight random digits that part repeated rows; to be written before it is used."""
    salt = F.lpad(F.hex((F.rand() * (1 << 32)).cast("long")), 8, "0")
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64("text").cast("string"))
    return F.concat(F.md5(key.cast("binary")), salt)


def stored_order() -> Column:
    """The place of a row in a written table, as text that sorts: number of the file, then row, 10 hexadecimal digits each."""
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("long")
    return F.concat(*(F.lpad(F.hex(x), 10, "0") for x in (part, F.col("_metadata.row_index"))))


def tokenized(docs: DataFrame, path: str, order: Column | None = None) -> DataFrame:
    """doc_id, source_key, order_key, n (ids with the closing 0) and ids (two bytes each). docs: doc_id, text, source."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(path)
        for texts in batches:
            yield pd.Series([(b"" if pd.isna(t) else encoder.encode(t)) + b"\0\0" for t in texts], dtype=object)

    rows = docs.select(
        "doc_id", source_key("source").alias("source_key"),
        (hash_order() if order is None else order).alias("order_key"),
        encode("text").alias("ids"),
    )
    return rows.withColumn("n", (F.octet_length("ids") / 2).cast("long"))


def in_hash_ranges(rows: DataFrame, partition: int) -> DataFrame:
    """rows with the range of each: some bits of its key, as many as the tokens ask for, or more of the key in heavy ranges."""
    total = rows.agg(F.sum("n")).first()[0] or 0
    bits = min(32, max(BITS, (FINE * -(-total // partition) - 1).bit_length()))
    head = F.conv(F.substring("order_key", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("range", F.lpad(F.hex(head - head % (1 << (32 - bits))), 8, "0"))
    heavy = rows.groupBy("source_key", "range").agg(F.sum("n").alias("n"), F.count("*").alias("many"))
    heavy = written(heavy.where((F.col("n") * FINE > partition) & (F.col("many") > 1)).select("source_key", "range"), "heavy")
    most = heavy.count()
    if not most:
        return rows
    heavy = heavy.withColumn("heavy", F.lit(True))
    rows = rows.join(F.broadcast(heavy) if most <= SMALL else heavy, ["source_key", "range"], "left")
    return rows.withColumn("range", F.when(F.col("heavy"), F.substring("order_key", 1, SPLIT)).otherwise(F.col("range"))).drop("heavy")


def part_starts(per: DataFrame) -> DataFrame:
    """part and part_start: the tokens in earlier partitions. per: part, n."""
    parts = per.groupBy("part").agg(F.sum("n").alias("n")).withColumn("key", F.lpad(F.hex("part"), 10, "0"))
    return running_total(parts.withColumn("all", F.lit("")), "all", "key", [], "n", "part_start", 7).select("part", "part_start")


def ranges(rows: DataFrame, partition: int) -> DataFrame:
    """Per source and range of keys: its partition, and what the partition's packing starts from. rows: source_key, range, n.

    part_start: tokens in earlier partitions; given: those of the source; source_total and all_total.
    """
    per = written(rows.groupBy("source_key", "range").agg(F.sum("n").alias("n")), "ranges")
    total = per.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total // partition))
    totals = per.groupBy("source_key").agg(F.sum("n").alias("source_total"))
    per = running_total(per, "source_key", "range", [], "n", "ahead").join(totals, "source_key")
    middle = (F.col("ahead") + F.col("n") / 2) / F.col("source_total")
    per = written(per.withColumn("part", F.least(F.floor(middle * parts), F.lit(parts - 1)).cast("int")), "dealt")
    given = per.groupBy("source_key", "part").agg(F.min("ahead").alias("given"))
    per = per.join(given, ["source_key", "part"]).join(part_starts(per), "part")
    return per.select("source_key", "range", "part", "source_total", "given", "part_start", F.lit(total).cast("long").alias("all_total"))


def stretches(rows: DataFrame, partition: int) -> DataFrame:
    """The same per source and range for documents in training order: partitions are neighbouring ranges of all sources."""
    per = written(rows.groupBy("source_key", "range").agg(F.sum("n").alias("n")), "ranges")
    total = per.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total // partition))
    whole = per.groupBy("range").agg(F.sum("n").alias("n")).withColumn("all", F.lit(""))
    # The first ten digits are the file.
    whole = running_total(whole, "all", "range", [], "n", "ahead", 10)
    whole = whole.withColumn("part", F.least(F.floor((F.col("ahead") + F.col("n") / 2) / total * parts), F.lit(parts - 1)).cast("int"))
    starts = whole.groupBy("part").agg(F.min("ahead").alias("part_start"))
    found = per.select("source_key", "range").join(whole.select("range", "part"), "range").join(starts, "part")
    return found.select("source_key", "range", "part", "part_start")


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source_key string"
)


def demand(rows: pd.DataFrame, names: list[str], step: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all sources, and of each, up to every ``step`` rows of the training order, from the partition's start."""
    ordered = rows.sort_values("order_key", kind="stable")
    tokens = ordered["ids"].str.len().to_numpy() // 2
    own = np.cumsum(np.where(ordered["source_key"].to_numpy()[:, None] == np.array(names, object), tokens[:, None], 0), 0)
    ends = np.unique(np.r_[np.arange(step, len(rows), step), len(rows)]) - 1
    return np.r_[0, np.cumsum(tokens)[ends]], np.vstack([np.zeros(len(names)), own[ends]])


def fill_windows(rows: pd.DataFrame, window: int = WINDOW, quantum: int = QUANTUM, step: int = STEP) -> pd.DataFrame:
    """The pieces of one partition; without columns of totals its rows are in training order."""
    rows = rows.sort_values(["source_key", "order_key", "doc_id", "ids"], kind="stable")
    at = start_at = int(rows["part_start"].iloc[0])
    first = rows.groupby("source_key", sort=True).first()
    names = list(first.index)
    if "source_total" in rows:
        share = first["source_total"].to_numpy(float) / int(rows["all_total"].iloc[0])
        owed = at * share - first["given"].to_numpy(float)

        def entitled(tokens: int) -> np.ndarray:
            return tokens * share
    else:
        places, curves = demand(rows, names, step)
        owed = np.zeros(len(names))

        def entitled(tokens: int) -> np.ndarray:
            a, b = (np.array([np.interp(x, places, c) for c in curves.T]) for x in (at - start_at, at - start_at + tokens))
            return b - a
    queues = [deque() for _ in names]
    left = np.zeros(len(names), np.int64)
    place = {s: i for i, s in enumerate(names)}
    for row, (doc, source, ids) in enumerate(zip(rows["doc_id"], rows["source_key"], rows["ids"], strict=True)):
        queues[place[source]].append([None if pd.isna(doc) else int(doc), np.frombuffer(ids, "<u2").astype("<u4"), 0])
        left[place[source]] += len(ids) // 2
    out: list[tuple] = []
    turn = 0

    def serve(i: int, tokens: int) -> None:
        nonlocal at
        left[i] -= tokens
        owed[i] -= tokens
        while tokens:
            doc, ids, start = head = queues[i][0]
            n = min(tokens, len(ids) - start)
            out.append((doc, start, n, zlib.crc32(ids[start : start + n].tobytes()), len(ids), at // window, at % window, names[i]))
            at, tokens, head[2] = at + n, tokens - n, start + n
            if head[2] == len(ids):
                queues[i].popleft()

    while left.any():
        room = int(min(window - at % window, left.sum()))
        owed += entitled(room)
        due = np.minimum(np.floor(owed).astype(np.int64), left)
        ready = np.flatnonzero((due >= quantum) | ((due > 0) & (due == left)))
        for i in np.concatenate([ready[ready >= turn], ready[ready < turn]]):
            tokens = min(room, int(due[i]))
            if tokens:
                serve(i, tokens)
                room -= tokens
                turn = int(i) + 1
        while room:
            i = int(np.where(left > 0, owed, -np.inf).argmax())
            tokens = int(min(room, left[i], max(quantum, owed[i])))
            serve(i, tokens)
            room -= tokens
    out_frame = pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")])
    out_frame["doc_id"] = pd.array([r[0] for r in out], dtype="Int64")
    return out_frame


def pack(docs: DataFrame, path: str, window: int = WINDOW, quantum: int = QUANTUM, partition: int = PARTITION, order: Column | None = None, chars: int = STORED_RANGE) -> DataFrame:
    """The pieces of all documents; see PIECES. docs: doc_id, text, source. path: the file of ranks.

    order: the documents' places in training order, as text; its first ``chars`` characters name a range. Without it
    queues go by the hash of the id and the proportions stay the same.
    """
    rows = written(tokenized(docs, path, order), "tokens")
    rows = in_hash_ranges(rows, partition) if order is None else rows.withColumn("range", F.substring("order_key", 1, chars))
    found = written(ranges(rows, partition) if order is None else stretches(rows, partition), "parts")
    rows = rows.join(small(found, SMALL), ["source_key", "range"]).drop("range", "n")

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        return fill_windows(rows, window, quantum)

    return rows.groupBy("part").applyInPandas(fill, PIECES)


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_packing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return pack(docs, tokenizer_path()).drop("source_key")
