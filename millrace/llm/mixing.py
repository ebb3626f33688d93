"""Mixing sources to target weights along a time-varying curriculum.

Every source has a target, its share of all words by weight, capped at a multiple of its size. Its weight
changes over training time t in [0, 1]: 1 + slope * (2t - 1). The integral of that schedule, times the
target, is the source's cumulative demand of words; a document that stands at word c of its source's
order gets the time at which the demand reaches c. Documents sorted by this position in ranges are the
training order.

Null source: a source of its own, last. Null or empty text: size 0; it is taken as often as the passes over its
source say and adds no word. Repeated rows: each is a document. Empty table: no rows. Columns of the
input keep their names and values; the operator's own columns are those it names below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import running_total, table, word_count, written

WEIGHTS = (5, 2, 1)
SLOPES = (-0.5, 0.0, 0.5)
CAP = 3


def source_targets(sizes: DataFrame, weights=WEIGHTS, slopes=SLOPES, cap: int = CAP) -> DataFrame:
    """Per source: source_key, source_size, target, slope. sizes has source and size.

    A target is the least of cap times the size and weight times a level that is the same for all; the level
    is what is left to share over the weights left, once the sources that fill up first are out.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    per = per.withColumn("place", place.cast("int"))
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("place") + 1).cast("long"))
    per = per.withColumn("slope", F.element_at(F.array(*[F.lit(float(s)) for s in slopes]), F.col("place") % len(slopes) + 1))
    everything = Window.partitionBy(F.lit(0))
    filling = everything.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    left = F.sum("source_size").over(everything) - cap * F.coalesce(F.sum("source_size").over(earlier), none)
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), none)
    full = cap * F.col("source_size") * left_weight <= F.col("weight") * left
    per = per.withColumn("full", full)
    full_size = F.coalesce(F.sum(F.when(F.col("full"), F.col("source_size"))).over(everything), none)
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    to_share = F.sum("source_size").over(everything) - cap * full_size
    target = F.when(F.col("full"), (cap * F.col("source_size")).cast("double")).otherwise(
        (F.col("weight") * to_share).cast("double") / open_weight
    )
    return per.select(source_key("source").alias("source_key"), "source_size", target.alias("target"), "slope")


def source_key(source: str) -> Column:
    return F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source).cast("string")))


def curriculum(docs: DataFrame, size: Column, key: Column, weights=WEIGHTS, slopes=SLOPES, cap: int = CAP) -> DataFrame:
    """All columns of docs in a struct ``row``, with size, source_size, target, copies and positions.

    docs has a column source. key identifies a document; its hash sets the order in the source. copies is
    how often the mix takes the document, at the times in positions. A document whose middle lies
    in the part of a pass that the target still needs is taken once more.
    """
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("source").alias("source"),
        source_key("source").alias("source_key"),
        size.alias("size"),
        F.md5(key.cast("string").cast("binary")).alias("order_key"),
    )
    targets = source_targets(rows.select("source", "size"), weights, slopes, cap)
    rows = running_total(rows.drop("source"), "source_key", "order_key", [F.col("size")], "size", "before")
    rows = rows.join(targets, "source_key")
    passes = F.least(F.lit(cap), F.floor(F.col("target") / F.col("source_size"))).cast("int")
    rows = rows.withColumn("passes", F.when(F.col("source_size") > 0, passes).otherwise(0))
    middle = F.col("before") + F.col("size") / F.lit(2.0)
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    rows = rows.withColumn("copies", F.col("passes") + (middle < rest).cast("int"))
    a = F.col("slope")
    times = F.transform(
        F.slice(F.array(*map(F.lit, range(cap + 1))), 1, F.col("copies")),
        lambda i: _time((middle + i * F.col("source_size")) / F.col("target"), a),
    )
    return rows.select("row", "size", "source_size", "target", "copies", times.alias("positions"))


def _time(share: Column, slope: Column) -> Column:
    """The t at which the integral of the schedule is share: slope * t^2 + (1 - slope) * t = share."""
    return 2 * share / (1 - slope + F.sqrt((1 - slope) * (1 - slope) + 4 * slope * share))


def training_order(mixed: DataFrame) -> DataFrame:
    """The mixed documents, each copy a row with its position, range-sorted by position."""
    copies = mixed.where("copies > 0").select("row", F.explode("positions").alias("position"))
    return copies.repartitionByRange("position").sortWithinPartitions("position").select("row.*", "position")


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    mixed = curriculum(sizes, F.col("size"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    first = F.floor(F.element_at("positions", 1) * 1e6)
    return mixed.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        F.when(F.col("copies") > 0, first).alias("first_position_ppm"),
    )


OP10_SQL = r"""
WITH d AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
        CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS BIGINT) AS size
    FROM documents),
s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS p
    FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][p + 1] AS BIGINT) AS weight, [-0.5, 0.0, 0.5][p + 1]::DOUBLE AS slope FROM s),
o AS (
    SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS total_weight,
        coalesce(sum(source_size) OVER e, 0) AS c, coalesce(sum(weight) OVER e, 0) AS cw
    FROM w WINDOW e AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, 3 * source_size * (total_weight - cw) <= weight * (total - 3 * c) AS filled FROM o),
t AS (
    SELECT source, source_size, slope,
        CASE WHEN filled THEN CAST(3 * source_size AS DOUBLE)
        ELSE CAST(CAST(weight * (total - 3 * coalesce(sum(CASE WHEN filled THEN source_size END) OVER (), 0)) AS BIGINT) AS DOUBLE)
            / CAST(sum(CASE WHEN NOT filled THEN weight END) OVER () AS DOUBLE) END AS target
    FROM f),
r AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, t.slope,
        CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) + d.size / 2.0::DOUBLE AS middle
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(least(3, floor(target / source_size)) AS BIGINT) ELSE 0 END AS passes FROM r),
q AS (
    SELECT *, passes + CASE WHEN middle < target - passes * source_size THEN 1 ELSE 0 END AS copies, middle / target AS u FROM p)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken,
    CASE WHEN copies > 0 THEN CAST(floor(2 * u / (1 - slope + sqrt((1 - slope) * (1 - slope) + 4 * slope * u)) * 1e6) AS BIGINT) END
        AS first_position_ppm
FROM q
"""
