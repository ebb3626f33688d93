"""Line dedup with a log-template tree, in DataFrame functions only.

Lines are parsed to a fixed depth: number of tokens, then the leading tokens; tokens with a digit are variable (``<*>``)
from the start. In a leaf, a token that few documents have at its place is variable too; what is left is the
template of the line. A template with enough constant tokens that recurs in enough documents is dropped, but for
the document with the smallest id, which keeps its lines.

Where verbatim_tokens is given, lines that recur word for word go as well, whatever their share of digits: from two
documents on if they have so many tokens, else from min_docs on.

With a column ``group`` in docs, the documents of one group count as one, and keep or lose a line together; the one with the
smallest id stands for it. So copies and near copies stay what they are.

Only lines in leaves that enough documents reach are looked at token by token, each different line once.
Null text stays null. Empty text has one empty line, which is kept, as all lines below min_tokens are. Rows with the
same id and text are one document. Null ids come first. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import small, table, written

VARIABLE = "<*>"
#: Documents whose lines are asked for or dropped, up to which these are broadcast; beyond, the texts are shuffled.
BROADCAST_ROWS = 300_000


def tokens_of(line: Column) -> Column:
    """The words of a line, those with a digit masked. Most lines have neither digits nor other white space than spaces."""
    masked = F.regexp_replace(line, r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", VARIABLE)
    masked = F.regexp_replace(masked, r"[\x09\x0B-\x0D]", " ")
    return F.array_remove(F.split(F.when(line.rlike(r"[0-9\x09\x0B-\x0D]"), masked).otherwise(line), " "), "")


def _identity(text: Column) -> Column:
    return F.coalesce(F.xxhash64(text), F.lit(0))


def dropped_lines(docs: DataFrame, min_docs: int = 5, min_tokens: int = 3, depth: int = 3, similarity: float = 0.5, verbatim_tokens: int | None = None) -> DataFrame:
    """(doc_id, hash of the text, positions of dropped lines) of documents that lose lines. docs: doc_id, text, perhaps group."""
    group = ["group"] if "group" in docs.columns else []
    docs = docs.select("doc_id", "text", _identity(F.col("text")).alias("h"), *group)
    cut = docs.where("text IS NOT NULL").select("doc_id", "h", *group, F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    # What a line says, where its tokens with a digit do not tell.
    said = F.when(F.col("line").rlike("[0-9]"), F.unhex(F.md5(F.col("line").cast("binary"))))
    said = [] if verbatim_tokens is None else [said.alias("said")]
    cut = cut.select("doc_id", "h", *group, "pos", tokens_of(F.col("line")).alias("tokens"), *said)
    # Short lines are left out only afterwards: a filter here would cut each line into tokens twice.
    lines = written(
        cut.select(
            "doc_id", "h", *group, "pos", F.size("tokens").alias("n"),
            F.xxhash64(F.size("tokens"), F.array_join(F.slice("tokens", 1, depth), " ")).alias("leaf"),
            F.unhex(F.md5(F.array_join("tokens", " ").cast("binary"))).alias("line"),
            *["said"][: len(said)],
        ),
        "lines",
    ).where(F.col("n") >= min_tokens)
    in_docs = lines.groupBy("leaf", "line", "doc_id", "h").agg(F.min("pos").alias("pos"))
    if group:
        in_docs = lines.groupBy("leaf", "line", "group").agg(F.min(F.struct("doc_id", "h", "pos")).alias("at"))
        in_docs = in_docs.select("leaf", "line", "group", "at.*")
    per_line = in_docs.groupBy("leaf", "line").agg(
        F.count("*").alias("n_docs"), F.min(F.struct("doc_id", "h", "pos")).alias("at")
    )
    leaves = in_docs.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("leaf")
    lookup = written(per_line.join(leaves, "leaf", "left_semi"), "leaves")

    by_doc = lookup.groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.h").alias("h")).agg(
        F.collect_list(F.struct("at.pos", "leaf", "line", "n_docs")).alias("wanted")
    )
    found = _with(docs, small(written(by_doc, "wanted"), BROADCAST_ROWS), "inner").select(F.split("text", "\n").alias("all"), "wanted")
    found = found.select("all", F.explode("wanted").alias("w")).dropDuplicates(["w"])
    found = found.select("w.leaf", "w.line", "w.n_docs", tokens_of(F.element_at("all", F.col("w.pos") + 1)).alias("tokens"))
    token = found.select("leaf", "line", "n_docs", F.posexplode("tokens").alias("i", "token"))
    token = written(token, "tokens")
    constant = (
        token.where(F.col("token") != VARIABLE).groupBy("leaf", "i", "token").agg(F.sum("n_docs").alias("f"))
        .where(F.col("f") >= min_docs).select("leaf", "i", "token", F.lit(True).alias("fixed"))
    )
    marked = token.join(constant, ["leaf", "i", "token"], "left").withColumn("fixed", F.coalesce("fixed", F.lit(False)))
    places = F.array_sort(F.collect_list(F.struct("i", F.when(F.col("fixed"), F.col("token")).otherwise(VARIABLE).alias("token"))))
    templates = (
        marked.groupBy("leaf", "line")
        .agg(F.avg(F.col("fixed").cast("int")).alias("share"), F.array_join(F.transform(places, lambda p: p["token"]), " ").alias("template"))
        .where(F.col("share") >= similarity)
        .select("leaf", "line", F.unhex(F.md5(F.concat_ws(" ", F.col("leaf").cast("string"), "template").cast("binary"))).alias("template"))
    )
    templates = written(templates, "templates")
    of_doc = one_each(in_docs.join(templates, ["leaf", "line"]), ["template"], group)
    recurring = (
        of_doc.groupBy("template").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "h", *group)).alias("first"))
        .where(F.col("n") >= min_docs).select("template", "first")
    )
    spent = templates.join(recurring, "template").select("leaf", "line", "first")
    gone = lines.join(spent, ["leaf", "line"]).where(is_another(group))
    if verbatim_tokens is not None:
        gone = gone.select("doc_id", "h", "pos").unionAll(verbatim(lines, min_docs, verbatim_tokens, group))
    return gone.groupBy("doc_id", "h").agg(F.collect_set("pos").alias("gone"))


def one_each(rows: DataFrame, keys: list[str], group: list[str], *more: Column) -> DataFrame:
    """One row per key and document, or per key and group with its smallest id."""
    if not group:
        return rows.groupBy(*keys, "doc_id", "h").agg(*more or [F.lit(1).alias("one")])
    rows = rows.groupBy(*keys, *group).agg(F.min(F.struct("doc_id", "h")).alias("least"), *more)
    return rows.select("*", "least.*")


def is_another(group: list[str]) -> Column:
    """Whether a line's document, or its group, is another than the first."""
    return F.col("group") != F.col("first.group") if group else ~F.struct("doc_id", "h").eqNullSafe(F.col("first"))


def verbatim(lines: DataFrame, min_docs: int, long: int, group: list[str]) -> DataFrame:
    """(doc_id, h, pos) of lines that recur word for word, but for those of the document with the smallest id."""
    lines = lines.select("doc_id", "h", *group, "pos", "n", F.coalesce("said", "line").alias("said"))
    per = one_each(lines, ["said"], group, F.max("n").alias("n"))
    per = per.groupBy("said").agg(F.count("*").alias("docs"), F.max("n").alias("n"), F.min(F.struct("doc_id", "h", *group)).alias("first"))
    per = per.where((F.col("docs") >= min_docs) | (F.col("docs") >= 2) & (F.col("n") >= long)).select("said", "first")
    gone = lines.join(per, "said").where(is_another(group))
    return gone.select("doc_id", "h", "pos")


def _with(docs: DataFrame, more: DataFrame, how: str) -> DataFrame:
    """Joined on id and hash of the text, null ids included. docs has its columns and h."""
    more = more.withColumnsRenamed({"doc_id": "_id", "h": "_h"})
    return docs.join(more, docs["doc_id"].eqNullSafe(more["_id"]) & (docs["h"] == more["_h"]), how).drop("_id", "_h")


def without_recurring(docs: DataFrame, grouped: DataFrame | None = None, **settings) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (what is left of it) and row (the whole input row) of every row.

    grouped: doc_id, text and group of the same rows, where documents of a group count as one.
    """
    dropped = dropped_lines(docs.select("doc_id", "text") if grouped is None else grouped, **settings)
    rows = docs.select("doc_id", _identity(F.col("text")).alias("h"), F.struct(*docs.columns).alias("row"))
    rows = _with(rows, small(written(dropped, "dropped"), BROADCAST_ROWS), "left").withColumn("lines", F.split("row.text", "\n"))
    kept = F.filter("lines", lambda line, i: ~F.array_contains(F.col("gone"), i))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    return rows.select(
        "doc_id",
        F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
        text.alias("text"),
        "row",
    )


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_recurring(docs).drop("row")


#: The text of a document after its recurring lines are gone, from a relation {docs} of doc_id and text.
TEMPLATES_SQL = r"""
cut AS (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM {docs}),
tok AS (
    SELECT doc_id, text, pos, list_filter(regexp_split_to_array(
        regexp_replace(line, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), '[\x20\x09-\x0D]+'), lambda t: t <> '') AS tokens
    FROM cut),
line_of AS (
    SELECT doc_id, text, pos, tokens, array_to_string(tokens, ' ') AS line, len(tokens) || ' ' || array_to_string(tokens[1:3], ' ') AS leaf
    FROM tok WHERE len(tokens) >= 3),
in_docs AS (SELECT DISTINCT leaf, line, tokens, doc_id, text FROM line_of),
leaves AS (SELECT leaf FROM in_docs GROUP BY leaf HAVING count(*) >= 5),
per_line AS (SELECT leaf, line, tokens, count(*) AS n_docs FROM in_docs WHERE leaf IN (SELECT leaf FROM leaves) GROUP BY ALL),
token AS (SELECT leaf, line, n_docs, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS i FROM per_line),
constant AS (
    SELECT leaf, i, token FROM token WHERE token <> '<*>' GROUP BY ALL HAVING sum(n_docs) >= 5),
template_of AS (
    SELECT t.leaf, t.line, string_agg(CASE WHEN c.token IS NULL THEN '<*>' ELSE t.token END, ' ' ORDER BY t.i) AS template
    FROM token t LEFT JOIN constant c ON t.leaf = c.leaf AND t.i = c.i AND t.token = c.token
    GROUP BY t.leaf, t.line HAVING avg(CASE WHEN c.token IS NULL THEN 0 ELSE 1 END) >= 0.5),
of_doc AS (SELECT DISTINCT leaf, template, doc_id, text FROM in_docs JOIN template_of USING (leaf, line)),
recurring AS (SELECT leaf, template, min(doc_id) AS first FROM of_doc GROUP BY ALL HAVING count(*) >= 5),
gone AS (
    SELECT DISTINCT l.doc_id, l.text, l.pos FROM line_of l JOIN template_of USING (leaf, line) JOIN recurring r USING (leaf, template)
    WHERE l.doc_id <> r.first),
cleaned AS (
    SELECT c.doc_id, c.text AS before, count(*) AS n_lines, count(g.pos) AS n_dropped,
        coalesce(string_agg(CASE WHEN g.pos IS NULL THEN c.line END, chr(10) ORDER BY c.pos), '') AS text
    FROM cut c LEFT JOIN gone g ON c.doc_id = g.doc_id AND c.text = g.text AND c.pos = g.pos
    GROUP BY c.doc_id, c.text)"""

OP7_SQL = f"WITH {TEMPLATES_SQL.replace('{docs}', 'documents')} SELECT doc_id, n_lines, n_dropped, text FROM cleaned"
