"""The corpus pipeline: language, recurring lines, near duplicates, mixture, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last return the
columns of docs. An empty table passes through all stages; nulls, ties and repeated rows are treated as the operators
say. Columns of docs beside those that a stage reads go through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.langid import keep_known
from millrace.llm.lines import without_recurring
from millrace.llm.mixing import curriculum, training_order
from millrace.llm.neardup import near_duplicates, text_key
from millrace.llm.packing import pack, stored_order, tokenizer_path
from millrace.llm.shared import table, word_count, written


#: Words from which a line that two documents share word for word is dropped.
VERBATIM_TOKENS = 50


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told. Without text or letters, or below a score of one half: rejected."""
    return keep_known(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go; a document that had words and has none left goes too. n_chars follows the text.

    Copies of one text count as one document, so that the next stage still finds them whole.
    """
    grouped = docs.select("doc_id", "text", text_key().alias("group"))
    cleaned = without_recurring(docs, grouped, verbatim_tokens=VERBATIM_TOKENS)
    left = cleaned.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_dropped") == 0, F.col("row.n_chars")).otherwise(F.length("text"))}
    return left.select(*[new[c].cast(t).alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c, t in docs.dtypes])


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays; of repeated rows one."""
    found = near_duplicates(docs.select("doc_id", "text"))
    # Ids may be null or stand for several texts, so classes are told apart by component. Texts without a word are no duplicates.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    first = found.where("key IS NOT NULL").groupBy("component").agg(F.min(order).alias("_first"))
    first = first.select(F.col("_first.doc_id").alias("_id"), F.col("_first.key").alias("_key"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_doc"), text_key().alias("_text"))
    wordless = ~F.coalesce(F.col("_row.text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = rows.where(~wordless).join(first, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_key")))
    kept = kept.dropDuplicates(["_doc", "_text"])
    return kept.select("_row.*").unionAll(rows.where(wordless).select("_row.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, as often as it takes them, in training order."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    mixed = curriculum(docs, word_count(F.col("text")), key)
    return training_order(mixed).select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 1024 tokens; docs is a written table, whose order of files and rows is kept."""
    return pack(docs, tokenizer_path(), order=stored_order())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("mix_sources", mix_sources),
    ("pack_windows", pack_windows),
]

#: Naive Bayes, MinHash and a tokenizer are beyond SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
