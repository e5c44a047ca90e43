"""Line deduplication by a log-template tree of fixed depth.

A line is normalised (white space collapsed) and, if it has enough tokens, goes
down the tree by its token count and its leading tokens, with tokens that hold
digits masked. Each node also has wildcard children: a line stands below its
first two tokens, and below the first three without the first or the second, so
that a variable field may lead. In a leaf, a token that enough lines share at
its place is fixed and every other one is a variable field. What is enough goes
up in steps from ``min_docs`` lines, the same for leaves of any size: a value
that is common itself is still a field of a template far more common. A
template of which four fifths are fixed and that occurs in ``min_docs``
documents is dropped everywhere but at its first place (the smallest document
id, then the first line). A line that recurs word for word needs no
template and no least length; lines that differ in more fields, as the rows of
a table of numbers do, recur only word for word.

All of it is counts and joins over distinct lines, so no leaf is ever gathered,
copies of a line are one row, and the order of rows does not matter.

Cases: null text stays null and has no lines; blank lines stay; a null id sorts
before all numbers; rows that repeat id and text are one document and get the
same lines; a very long line is one line like any other; an empty table gives
no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from leadpanel.session import pin, small

#: Stands for a variable field.
FIELD = "<*>"


@dataclass(frozen=True)
class Tree:
    """Parameters of the tree."""

    depth: int = 2  # leading tokens that choose the leaf, wildcards left out
    min_tokens: int = 3  # shorter lines recur word for word only
    min_docs: int = 10  # documents in which a line or template must occur to be dropped
    similarity: float = 0.8  # share of a template's tokens that are not fields
    step: int = 4  # from min_docs on, each next number of lines from which a token is fixed is so many times as large


TREE = Tree()
#: Steps that are tried: up to any number of lines that fits a table.
STEPS = 18


def _two(*columns: str | Column) -> list[Column]:
    """128 bits of a value as two numbers."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(7), *columns)]


def named(names: list[str], *columns: str | Column) -> list[Column]:
    return [c.alias(n) for c, n in zip(_two(*columns), names)]


KEY, WHOLE, FORM, TEMPLATE = (["key", "key2"], ["whole", "whole2"], ["form", "form2"], ["template", "template2"])


def document_key() -> list[Column]:
    return named(KEY, "doc_id", "text")


def _single_spaces(line: Column) -> Column:
    """White space collapsed; plain searches spare most lines the regex."""
    odd = reduce(or_, [F.contains(line, F.lit(s)) for s in ("  ", "\t", "\r", "\f", "\x0b")])
    return F.trim(F.when(odd, F.regexp_replace(line, "[ \\t\\r\\f\\x0B]+", " ")).otherwise(line))


def _masked(plain: Column) -> Column:
    return F.when(plain.rlike("[0-9]"), F.regexp_replace(plain, "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", FIELD)).otherwise(plain)


def shaped_lines(docs: DataFrame, *more: str) -> DataFrame:
    """``key, key2, doc_id, n, plain, shape, size`` of each line that is not blank, and ``more`` columns of its document."""
    # Shaped before they are exploded, so that what follows reads columns and does not shape again.
    plain = F.transform(F.split("text", "\n"), _single_spaces)
    shaped = F.transform(plain, lambda line: F.struct(line.alias("plain"), _masked(line).alias("shape")))
    lines = docs.where(F.col("text").isNotNull()).select(*document_key(), "doc_id", *more, F.posexplode(shaped).alias("n", "line"))
    size = F.length("plain") - F.length(F.replace(F.col("plain"), F.lit(" "))) + 1
    return lines.select(*KEY, "doc_id", *more, "n", "line.*").where("plain <> ''").withColumn("size", size)


def leaves_of(tree: Tree) -> Column:
    """The leaves of a line: its leading tokens, and one more of them with a wildcard for each."""
    lead = F.split(F.substring_index("shape", " ", tree.depth + 1), " ")
    paths = [F.slice(lead, 1, tree.depth)] + [
        F.when(F.size(lead) > tree.depth, F.array(*[F.get(lead, F.lit(at)) for at in range(tree.depth + 1) if at != wild]))
        for wild in range(tree.depth)]
    return F.array_compact(F.array(*[F.when(path.isNotNull(), F.xxhash64("size", F.lit(at), path)) for at, path in enumerate(paths)]))


def _often(lines: DataFrame, names: list[str], tree: Tree) -> DataFrame:
    """``lines`` whose name stands in at least ``min_docs`` of them: few names, so that most lines are not shuffled further."""
    names_often = lines.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= tree.min_docs).select(*names)
    return lines.join(small(names_often), names, "left_semi")


def _recurring(lines: DataFrame, template: list[str], tree: Tree) -> DataFrame:
    """The templates in at least ``min_docs`` documents with their ``first`` place; counted per document before per template."""
    place = F.struct("doc_id", *KEY, "n")
    return small(
        _often(lines, template, tree).groupBy(*template, *KEY).agg(F.min(place).alias("place"))
        .groupBy(*template).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("docs"))
        .where(F.col("docs") >= tree.min_docs)
        .select(*template, "first")
    )


def templates_of(tokens: Column, size: Column, tree: Tree) -> Column:
    """The templates of a line from its tokens ``(at, token, lines)``, one for each step that leaves enough of them fixed."""
    steps = F.array(*[F.lit(tree.min_docs * tree.step ** k).cast("bigint") for k in range(STEPS)])
    fixed = F.transform(steps, lambda least: F.transform(
        F.filter(tokens, lambda t: t["lines"] >= least), lambda t: F.struct(t["at"].alias("at"), t["token"].alias("token"))))
    return F.array_distinct(F.filter(fixed, lambda f: F.size(f) >= tree.similarity * size))


def general_lines(docs: DataFrame, lines: DataFrame, tree: Tree) -> DataFrame:
    """``form, form2, template, template2``: the templates of every distinct masked line."""
    leafy = lines.where(F.col("size") >= tree.min_tokens)
    each = leafy.select(*FORM, F.explode("leaves").alias("leaf"), F.struct(*KEY, "n").alias("place"))
    # Copies of a line count as often as they are there, but are worked on once.
    forms = pin(_often(each, ["leaf"], tree).groupBy(*FORM, "leaf").agg(F.count(F.lit(1)).alias("lines"), F.min("place").alias("place")))
    # One line of each form is shaped again, for its words.
    wanted = forms.select("place.*").groupBy(*KEY).agg(F.collect_set("n").alias("wanted"))
    involved = docs.select("*", *document_key()).join(wanted, KEY).select(*docs.columns, "wanted")
    worded = (
        shaped_lines(involved, "wanted").where(F.array_contains("wanted", F.col("n")))
        .select(*named(FORM, "size", "shape"), "shape", "size").dropDuplicates(FORM)
    )
    tokens = pin(
        worded.join(forms.select(*FORM, "leaf", "lines"), FORM)
        .select(*FORM, "leaf", "size", "lines", F.posexplode(F.split("shape", " ")).alias("at", "token")).where(F.col("token") != FIELD)
    )
    counts = tokens.groupBy("leaf", "at", "token").agg(F.sum("lines").alias("_n")).where(F.col("_n") >= tree.min_docs)
    fixed = tokens.join(counts, ["leaf", "at", "token"]).groupBy(*FORM, "leaf", "size").agg(
        F.sort_array(F.collect_list(F.struct("at", "token", F.col("_n").alias("lines")))).alias("tokens"))
    found = fixed.select(*FORM, "size", F.explode(templates_of(F.col("tokens"), F.col("size"), tree)).alias("fixed"))
    return found.select(*FORM, *named(TEMPLATE, "size", "fixed")).distinct()


def recurring_lines(docs: DataFrame, tree: Tree = TREE) -> DataFrame:
    """``key, key2, n`` of every line that is a repetition of a recurring line or template."""
    shaped = shaped_lines(docs).withColumn("leaves", F.when(F.col("size") >= tree.min_tokens, leaves_of(tree)))
    lines = pin(shaped.select(*KEY, "doc_id", "n", *named(WHOLE, "plain"), *named(FORM, "size", "shape"), "size", "leaves"))
    general = small(general_lines(docs, lines, tree))
    placed = pin(lines.select(*KEY, "doc_id", "n", *FORM).join(general, FORM).drop(*FORM))
    again = (F.col("first.key") != F.col("key")) | (F.col("first.key2") != F.col("key2")) | (F.col("first.n") != F.col("n"))
    whole = lines.join(_recurring(lines, WHOLE, tree), WHOLE).where(again).select(*KEY, "n")
    return whole.unionByName(placed.join(_recurring(placed, TEMPLATE, tree), TEMPLATE).where(again).select(*KEY, "n"))


def drop_recurring_lines(docs: DataFrame, tree: Tree = TREE) -> DataFrame:
    """The documents with the repetitions of recurring lines taken out of ``text``.

    Returns struct ``row`` (the document as it came), ``text`` (what is left), ``n_lines`` and ``n_dropped``.
    """
    drops = recurring_lines(docs.select("doc_id", "text"), tree).groupBy(*KEY).agg(F.collect_set("n").alias("drop"))
    rows = docs.select(F.struct("*").alias("row"), *document_key())
    lines = F.split("row.text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("drop"))
    left = F.array_join(F.transform(stay, lambda n: F.get(lines, n)), "\n")
    return rows.join(drops, KEY, "left").select(
        "row",
        F.when(F.col("drop").isNull(), F.col("row.text")).otherwise(left).alias("text"),
        F.when(F.col("row.text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long").alias("n_dropped"),
    )


def deduplicate(docs: DataFrame, tree: Tree = TREE) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` per document."""
    return drop_recurring_lines(docs, tree).select(F.col("row.doc_id").alias("doc_id"), "text", "n_lines", "n_dropped")


#: Lines, leaves and templates spelled out instead of hashed.
ORACLE = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n
  FROM documents
), plain AS (
  SELECT doc_id, n, trim(regexp_replace(line, '[ \t\r\f\x0B]+', ' ', 'g'), ' ') AS plain FROM lines
), whole AS (
  SELECT plain, min((doc_id, n)) AS place FROM plain WHERE plain <> '' GROUP BY plain HAVING count(DISTINCT doc_id) >= 10
), shaped AS (
  SELECT doc_id, n, string_split(regexp_replace(plain, '[^ ]*[0-9][^ ]*', '<*>', 'g'), ' ') AS tokens FROM plain
), kept AS (
  SELECT doc_id, n, tokens FROM shaped WHERE len(tokens) >= 3
), forms AS (
  SELECT tokens, unnest([[CAST(len(tokens) AS VARCHAR), 'a', tokens[1], tokens[2]], [CAST(len(tokens) AS VARCHAR), 'b', tokens[2], tokens[3]],
                         [CAST(len(tokens) AS VARCHAR), 'c', tokens[1], tokens[3]]]) AS leaf, count(*) AS lines
  FROM kept GROUP BY tokens
), common AS (
  SELECT leaf FROM forms GROUP BY leaf HAVING sum(lines) >= 10
), words AS (
  SELECT tokens, leaf, lines, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM forms SEMI JOIN common USING (leaf)
), counts AS (
  SELECT leaf, pos, token, sum(lines) AS n FROM words WHERE token <> '<*>' GROUP BY ALL HAVING sum(lines) >= 10
), templates AS (
  SELECT DISTINCT tokens, list((pos, token) ORDER BY pos) AS template
  FROM words JOIN counts USING (leaf, pos, token), (SELECT unnest(range(18)) AS k)
  WHERE n >= 10 * 4 ** k GROUP BY tokens, leaf, k HAVING count(*) >= 0.8 * len(tokens)
), placed AS (
  SELECT DISTINCT doc_id, n, len(tokens) AS size, template FROM kept JOIN templates USING (tokens)
), general AS (
  SELECT size, template, min((doc_id, n)) AS place FROM placed GROUP BY size, template HAVING count(DISTINCT doc_id) >= 10
), drops AS (
  SELECT doc_id, n FROM plain JOIN whole USING (plain) WHERE (doc_id, n) <> place
  UNION
  SELECT doc_id, n FROM placed JOIN general USING (size, template) WHERE (doc_id, n) <> place
), left_lines AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.n) FILTER (d.n IS NULL) AS text,
         count(*) AS n_lines, count(d.n) AS n_dropped
  FROM lines l LEFT JOIN drops d ON d.doc_id = l.doc_id AND d.n = l.n GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN n_lines > 0 THEN coalesce(l.text, '') END AS text,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN left_lines l ON l.doc_id = d.doc_id
"""
