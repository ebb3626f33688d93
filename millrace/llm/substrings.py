"""Suffix-array dedup: removes every byte that lies in a 100-byte string which also starts earlier in the corpus.

Not every suffix needs sorting. Every 100-byte string has an anchor, its 32-byte gram of least hash, which depends on its content
alone; equal strings have equal anchors at equal distance. So the suffixes that start at anchors whose gram
recurs, read to the right and to the left, decide all. They are sorted deep-shallow: multikey quicksort to a shallow
depth, then blind tries order the groups that share a long prefix. The lengths of common prefixes of neighbours
give, for each distance, the classes of equal strings; all but the earliest of a class are repeats.

Documents are dealt into blocks of bounded bytes. A block names its grams once, is told which recur anywhere, and sends
each different context once, whatever the number of copies in it; it is told which of their strings start earlier elsewhere.
Anchors are worked out anew for each of these steps, so only grams and contexts are shuffled beside the texts.

Order: null ids first, by text; then ids; rows of one id by text; of identical rows the first stays whole. Null text: no bytes.
Texts under 100 bytes are never touched. Empty table: no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import bounded_batches, mix64, table, utf8_bytes

LENGTH = 100
GRAM = 32
#: Grams of a string of LENGTH bytes: distances that its anchor can have from its start.
REACH = LENGTH - GRAM + 1
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
#: Positions hashed at a time.
STRETCH = 1 << 20
#: Depth in bytes to which quicksort goes.
SHALLOW = 16
WIDTH = LENGTH + REACH - 1
CONTEXT = np.dtype([("at", "<u4"), ("reach", "u1"), ("size", "u1"), ("ord", "<i8"), ("tie", "<i8"), ("off", "<u4"), ("s", "u1", WIDTH)])
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of all grams of GRAM bytes (a power of two)."""
    value, factor, size = _BYTE[data], np.uint64(0xD6E8FEB86659FD93), 1
    while size < GRAM:
        value = value[:-size] * factor + value[size:]
        with np.errstate(over="ignore"):
            factor = factor * factor
        size *= 2
    return mix64(value)


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of the gram, position, first and last start of a string, for every anchor. ends: of the documents."""
    parts = []
    for start in range(0, max(0, len(data) - LENGTH + 1), STRETCH):
        hashes = gram_hashes(data[start : start + STRETCH + LENGTH - 1])
        # The least by the upper bits of the hash, the first of equal ones.
        least = (hashes >> np.uint64(24) << np.uint64(24)) | np.arange(len(hashes), dtype=np.uint64)
        size = 1
        while size * 2 <= REACH:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        least = np.minimum(least[: len(least) - (REACH - size)], least[REACH - size :])
        at = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.arange(start, start + len(at))
        inside = first + LENGTH <= ends[np.searchsorted(ends, first, "right")]
        first, at = first[inside], at[inside]
        parts.append((hashes[at], at + start, first))
    if not parts or not sum(len(p[1]) for p in parts):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    gram, at, first = (np.concatenate(c) for c in zip(*parts, strict=True))
    # Strings that follow each other and share the anchor belong together.
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (first[1:] != first[:-1] + 1)])
    last = first[np.r_[new[1:], len(first)] - 1]
    return gram[new], at[new], first[new], last


class Block:
    """The documents of one block in their order, and their anchors."""

    def __init__(self, rows: pd.DataFrame) -> None:
        texts = [utf8_bytes(None if pd.isna(t) else t) for t in rows["text"]]
        ids = [None if pd.isna(i) else int(i) for i in rows["doc_id"]]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, texts[i]))
        self.ids, self.texts = [ids[i] for i in order], [texts[i] for i in order]
        self.ends = np.cumsum([len(t) for t in self.texts])
        self.starts = self.ends - [len(t) for t in self.texts]
        self.ord = np.array([-(2**63) if i is None else i for i in self.ids], np.int64)
        same = np.r_[False, self.ord[1:] == self.ord[:-1]]
        rank = np.arange(len(same)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
        digest = [int.from_bytes(hashlib.md5(t).digest()[:7]) if i is None else 0 for i, t in zip(self.ids, self.texts, strict=True)]
        self.tie = np.where(self.ord == -(2**63), digest, rank)
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)
        self.gram, self.at, self.first, self.last = anchors(self.data, self.ends)

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """The different grams, and whether they recur in the block."""
        gram, often = np.unique(self.gram, return_counts=True)
        return gram, often > 1

    def contexts(self, recurring: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The different contexts of anchors with such grams; for these anchors their number and that of their context."""
        chosen = np.flatnonzero(np.isin(self.gram, recurring))
        first, size = self.first[chosen], self.last[chosen] + LENGTH - self.first[chosen]
        found = np.zeros(len(chosen), CONTEXT)
        found["reach"], found["size"] = self.at[chosen] - first, size
        column = np.arange(WIDTH)
        for a in range(0, len(chosen), 1 << 14):
            part = slice(a, a + (1 << 14))
            read = self.data[np.minimum(first[part, None] + column, len(self.data) - 1)]
            found["s"][part] = np.where(column < size[part, None], read, 0)
        flat = np.concatenate([found["reach"][:, None], found["size"][:, None], found["s"]], axis=1)
        _, where, of = np.unique(np.ascontiguousarray(flat).view(f"V{flat.shape[1]}").ravel(), return_index=True, return_inverse=True)
        doc = np.searchsorted(self.ends, first[where], "right")
        kept = found[where]
        kept["at"] = np.arange(len(where))
        kept["ord"], kept["tie"], kept["off"] = self.ord[doc], self.tie[doc], first[where] - self.starts[doc]
        return kept, chosen, of

    def removed(self, recurring: np.ndarray, earlier: dict[int, bytes]) -> np.ndarray:
        """Whether each byte goes. earlier: by context, which distances of its first place have an earlier string."""
        _, chosen, of = self.contexts(recurring)
        change = np.zeros(len(self.data) + LENGTH + 1, np.int64)
        leads = np.zeros(len(chosen), bool)
        leads[np.unique(of, return_index=True)[1]] = True
        repeats = chosen[~leads]
        np.add.at(change, self.first[repeats], 1)
        np.add.at(change, self.last[repeats] + LENGTH, -1)
        for i in np.flatnonzero(leads):
            bits = earlier.get(int(of[i]))
            if bits:
                strings = self.at[chosen[i]] - np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8)))
                np.add.at(change, strings, 1)
                np.add.at(change, strings + LENGTH, -1)
        return np.cumsum(change)[: len(self.data)] > 0


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """The length of the common prefix, of which known bytes are known."""
    low, high = known, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class BlindTrie:
    """Orders strings that share a long prefix: inner nodes keep only a depth and the bytes there."""

    def __init__(self, strings: list[bytes], depth: int) -> None:
        self.strings, self.depth, self.root = strings, depth, None

    def add(self, i: int) -> None:
        """A node is a number of a string or (depth, {byte: node}); the end of a string counts as byte -1."""
        if self.root is None:
            self.root = i
            return
        text, node = self.strings[i], self.root
        while not isinstance(node, int):
            depth, below = node
            node = below.get(text[depth] if depth < len(text) else -1)
            if node is None:
                node = next(iter(below.values()))
        split = shared_prefix(text, self.strings[node], self.depth)
        other = self.strings[node]
        mine, theirs = (t[split] if split < len(t) else -1 for t in (text, other))
        parent, label, node = None, None, self.root
        while not isinstance(node, int) and node[0] < split:
            parent, label = node, text[node[0]] if node[0] < len(text) else -1
            node = parent[1][label]
        if not isinstance(node, int) and node[0] == split:
            node[1][mine] = i
            return
        inner = (split, {mine: i, theirs: node})
        if parent is None:
            self.root = inner
        else:
            parent[1][label] = inner

    def walk(self) -> tuple[list[int], list[int]]:
        """The strings in order, and how much each shares with the one before."""
        order, shared, work = [], [], [(self.root, self.depth)]
        while work:
            node, common = work.pop()
            if isinstance(node, int):
                order.append(node)
                shared.append(common)
                continue
            depth, below = node
            labels = sorted(below)
            work += [(below[c], depth if c != labels[0] else common) for c in reversed(labels)]
        return order, shared


def deep_shallow(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Order of different strings, and what each shares with the one before it (at least exact up to SHALLOW bytes).

    Multikey quicksort looks at eight bytes at a time down to SHALLOW; what is still equal there goes into blind tries.
    """
    n = len(strings)
    depth = SHALLOW // 8
    keys = np.frombuffer(b"".join(s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings), ">u8").reshape(n, depth).astype(np.uint64)
    order: list[int] = []
    shared: list[int] = []
    work = [(np.arange(n), 0)]
    while work:
        rows, level = work.pop()
        if level < depth and len(rows) > 1:
            key = keys[rows, level]
            pivot = np.partition(key, len(key) // 2)[len(key) // 2]
            parts = ((rows[key > pivot], level), (rows[key == pivot], level + 1), (rows[key < pivot], level))
            work += [p for p in parts if len(p[0])]
            continue
        if len(rows) == 1:
            found, common = [int(rows[0])], [0]
        else:
            trie = BlindTrie(strings, 0)
            for i in rows.tolist():
                trie.add(i)
            found, common = trie.walk()
        common[0] = shared_prefix(strings[order[-1]], strings[found[0]]) if order else 0
        order += found
        shared += common
    return np.array(order, np.int64), np.array(shared, np.int64)


def sorted_classes(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For strings that may be equal: the rank of each among the different ones, and the shared prefixes by rank."""
    different: dict[bytes, int] = {}
    of = np.array([different.setdefault(s, len(different)) for s in strings], np.int64)
    order, shared = deep_shallow(list(different))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[of], shared


def earlier_strings(found: np.ndarray) -> np.ndarray:
    """For each context, bits by distance: whether its string there also stands in a context at an earlier place."""
    text = [s.tobytes() for s in found["s"]]
    reach, size = found["reach"].astype(int), found["size"].astype(int)
    right, right_shared = sorted_classes([t[r:n] for t, r, n in zip(text, reach, size, strict=True)])
    left, left_shared = sorted_classes([t[:r][::-1] for t, r in zip(text, reach, strict=True)])
    order = np.lexsort((found["off"] + reach, found["tie"], found["ord"]))
    bits = np.zeros((len(found), -(-REACH // 8) * 8), bool)
    nearest = reach - (size - LENGTH)
    for distance in range(REACH):
        at = order[(nearest[order] <= distance) & (distance <= reach[order])]
        if len(at) < 2:
            continue
        group = np.cumsum(right_shared < LENGTH - distance)[right[at]] * (len(left_shared) + 1)
        group += np.cumsum(left_shared < distance)[left[at]] if distance else 0
        by = np.argsort(group, kind="stable")
        same = group[by][1:] == group[by][:-1]
        bits[at[by[1:][same]], distance] = True
    return np.packbits(bits, axis=1)


def dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row, and kept, the bytes that stay. docs: doc_id, text."""
    bounded_batches(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, buckets = -(-total // block_bytes) + 1, -(-total // bucket_bytes) + 1
    name = F.coalesce(F.col("doc_id").cast("string"), "text")
    block = F.pmod(F.xxhash64(name), F.lit(blocks)).cast("int")
    dealt = docs.select("doc_id", "text", block.alias("block")).repartition(blocks, "block")

    def by_bucket(of: np.ndarray):
        order = np.argsort(of, kind="stable")
        cuts = np.flatnonzero(np.diff(of[order])) + 1
        return ((int(of[part[0]]), part) for part in np.split(order, cuts) if len(part))

    def name_grams(rows: pd.DataFrame) -> pd.DataFrame:
        gram, often = Block(rows).grams()
        out = [(b, rows["block"].iloc[0], gram[p].tobytes(), often[p].tobytes()) for b, p in by_bucket((gram % np.uint64(buckets)).astype(int))]
        return pd.DataFrame(out, columns=["bucket", "block", "grams", "often"])

    def find_recurring(rows: pd.DataFrame) -> pd.DataFrame:
        gram = np.frombuffer(b"".join(rows["grams"]), np.uint64)
        often = np.frombuffer(b"".join(rows["often"]), bool)
        block = np.repeat(rows["block"].to_numpy(), [len(o) for o in rows["often"]])
        _, of, count = np.unique(gram, return_inverse=True, return_counts=True)
        kept = (count > 1)[of] | (np.bincount(of, weights=often) > 0)[of]
        gram, block = gram[kept], block[kept]
        return pd.DataFrame([(b, gram[p].tobytes()) for b, p in by_bucket(block)], columns=["block", "grams"])

    grams = dealt.groupBy("block").applyInPandas(name_grams, "bucket int, block int, grams binary, often binary")
    recurring = grams.groupBy("bucket").applyInPandas(find_recurring, "block int, grams binary").repartition(blocks, "block")

    def told(rows: pd.DataFrame, column: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(rows[column]), kind)

    def send_contexts(rows: pd.DataFrame, told_rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(told_rows):
            mine = Block(rows)
            found, chosen, of = mine.contexts(told(told_rows, "grams", np.uint64))
            lead = chosen[np.unique(of, return_index=True)[1]]
            number = rows["block"].iloc[0]
            out = [(b, number, found[p].tobytes()) for b, p in by_bucket((mine.gram[lead] % np.uint64(buckets)).astype(int))]
        return pd.DataFrame(out, columns=["bucket", "block", "contexts"])

    def sort_contexts(rows: pd.DataFrame) -> pd.DataFrame:
        found = told(rows, "contexts", CONTEXT)
        block = np.repeat(rows["block"].to_numpy(), [len(c) // CONTEXT.itemsize for c in rows["contexts"]])
        bits = earlier_strings(found)
        some = np.flatnonzero(bits.any(1))
        out = [(b, found["at"][some[p]].tobytes(), bits[some[p]].tobytes()) for b, p in by_bucket(block[some])]
        return pd.DataFrame(out, columns=["block", "at", "bits"])

    contexts = dealt.groupBy("block").cogroup(recurring.groupBy("block")).applyInPandas(send_contexts, "bucket int, block int, contexts binary")
    answers = contexts.groupBy("bucket").applyInPandas(sort_contexts, "block int, at binary, bits binary")
    # Both kinds of messages to a block in one table, so that the texts meet them in one step.
    messages = recurring.select("block", "grams", F.lit(None).cast("binary").alias("at"), F.lit(None).cast("binary").alias("bits")).unionAll(
        answers.select("block", F.lit(None).cast("binary"), "at", "bits")
    )
    messages = messages.repartition(blocks, "block")

    def remove(rows: pd.DataFrame, told_rows: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        if not len(rows):
            return pd.DataFrame([], columns=columns)
        mine = Block(rows)
        answers = told_rows[told_rows["at"].notna()]
        width = -(-REACH // 8)
        bits = told(answers, "bits", np.uint8).reshape(-1, width)
        earlier = {int(a): b.tobytes() for a, b in zip(told(answers, "at", np.uint32), bits, strict=True)}
        gone = mine.removed(told(told_rows[told_rows["grams"].notna()], "grams", np.uint64), earlier)
        out = []
        for doc_id, text, a, b in zip(mine.ids, mine.texts, mine.starts, mine.ends, strict=True):
            off = gone[a:b]
            n = int(off.sum())
            kept = text if not n else mine.data[a:b][~off].tobytes()
            spans = int(off[:1].sum() + (off[1:] & ~off[:-1]).sum())
            out.append((doc_id, len(text), n, spans, hashlib.sha256(kept).hexdigest(), kept))
        frame = pd.DataFrame(out, columns=columns)
        frame["doc_id"] = pd.array(mine.ids, dtype="Int64")
        return frame

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return dealt.groupBy("block").cogroup(messages.groupBy("block")).applyInPandas(remove, schema)


def op2_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")
