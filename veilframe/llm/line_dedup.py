"""Line dedup by a log-template tree, in DataFrame operations only.

A line descends a tree of fixed depth: first by its token count, then by its `depth`
leading tokens (all of them, where it has fewer). At the leaf its other tokens form
`segments` parts, and a template is the leaf with some parts generalised, whatever stands
there being a variable field: any two parts in lines of `pairs` tokens or more, any one in
lines of `singles` or more, none in shorter ones, which must agree entirely. So lines of a
leaf are one template if the tokens in which they differ lie in two parts of six, a third
of the line at most. Variable fields are also generalised lexically beforehand: a token
with a digit counts as `<*>`, and A-Z as a-z. A template that recurs in two documents or
more is dropped wherever it occurs but in its first document (the smallest id), which
keeps its lines.

The tree is walked as two aggregations: leaves found in one document only are left
behind before any template is formed. What is shuffled is a hash of 64 bits for each
leaf or template with a document id, pre-aggregated by task; texts move once, to meet
their dropped line numbers. What is found of leaves and templates is written down before
the lines meet it, so that a line that a third of all documents share makes a join of two
plain shuffles, which Spark splits where it is skewed.

Defined results: a null text stays null and an empty one empty. Lines without a token
always stay. Rows with a null id are left alone; rows with one id count as one document,
and each loses the lines at the numbers dropped for that id. A text whose lines are all
dropped becomes empty. An empty table gives an empty table. Other columns pass through
under their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, free_name

UPPER, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Tree:
    """depth: leading tokens of a leaf; segments: parts of the rest; singles, pairs: tokens from which on one, two parts vary."""

    depth: int = 3
    segments: int = 6
    singles: int = 5
    pairs: int = 9

    def open_parts(self, vary: int) -> list[tuple[int, ...]]:
        return list(combinations(range(self.segments), vary))


def _lines(docs: DataFrame, tree: Tree) -> DataFrame:
    """(id, pos, leaf, n, s0..): each line with its leaf and the hashes of its segments."""
    line = F.translate(F.col("line"), UPPER, LOW)
    # The first test is cheap and spares most lines the replacement; the look-behind tries each token once.
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+", "<*>")).otherwise(line)
    tokens = F.split(F.btrim(masked, F.lit(SPACES)), r"[\x20\x09-\x0D]+")
    rows = docs.where("id is not null and text is not null").select("id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    # Lines without a token are told by their text: a filter on the tokens would be pushed down and split every line twice.
    rows = rows.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select("id", "pos", tokens.alias("w")).withColumn("n", F.size("w"))
    rest = F.greatest(F.col("n") - tree.depth, F.lit(0))

    def segment(k: int) -> Column:
        start, end = (F.floor(rest * i / tree.segments).cast("int") for i in (k, k + 1))
        return F.xxhash64(F.slice("w", start + tree.depth + 1, end - start)).alias(f"s{k}")

    return rows.select("id", "pos", F.xxhash64("n", *[F.get("w", F.lit(k)) for k in range(tree.depth)]).alias("leaf"), "n", *map(segment, range(tree.segments)))


def _templates(tree: Tree) -> Column:
    """The templates of a line: those that leave one choice of parts open."""
    parts = [F.col(f"s{k}") for k in range(tree.segments)]

    def template(opened: tuple[int, ...]) -> Column:
        return F.xxhash64("leaf", F.lit(",".join(map(str, opened))), *[p for k, p in enumerate(parts) if k not in opened])

    by = lambda vary: F.array(*map(template, tree.open_parts(vary)))
    return F.when(F.col("n") >= tree.pairs, by(2)).when(F.col("n") >= tree.singles, by(1)).otherwise(by(0))


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tree: Tree = Tree()) -> DataFrame:
    """(id, gone): for each document with lines to drop, their 0-based numbers."""
    scratch = Scratch(docs.sparkSession)
    lines = scratch.write(_lines(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), tree), "lines")
    leaves = scratch.write(lines.groupBy("leaf").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("leaf"), "leaves")
    met = scratch.write(lines.join(leaves, "leaf").select("id", "pos", _templates(tree).alias("keys")), "met")
    entries = met.select("id", "pos", F.explode("keys").alias("key"))
    first = scratch.write(entries.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key", "lo"), "first")
    gone = entries.join(first, "key").where("id > lo").select("id", "pos").distinct()
    return gone.groupBy("id").agg(F.collect_list("pos").alias("gone"))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tree: Tree = Tree(), counts: tuple[str, str] | None = None) -> DataFrame:
    """docs with the recurring lines taken out of the text; with `counts`, also (lines, dropped lines) under these names."""
    gone_id, gone_at = free_name(docs, "__gone_id"), free_name(docs, "__gone")
    gone = recurring_lines(docs, id_col, text_col, tree).select(F.col("id").alias(gone_id), F.col("gone").alias(gone_at))
    joined = docs.join(gone, docs[id_col].cast("long") == gone[gone_id], "left")
    lines, at = F.split(F.col(f"`{text_col}`"), "\n"), F.col(f"`{gone_at}`")
    # One binding of the lines for all look-ups; array_except is a hash set, so this is linear in the lines.
    left = F.transform(F.array(lines), lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), at), lambda i: F.get(x, i)), "\n"))[0]
    text = F.when(at.isNull(), F.col(f"`{text_col}`")).otherwise(left)
    out = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if counts:
        out += [F.coalesce(F.size(lines), F.lit(0)).cast("long").alias(counts[0]), F.coalesce(F.size(at), F.lit(0)).cast("long").alias(counts[1])]
    return joined.select(*out)


_WORD = r"[^\x20\x09-\x0D]"
PAIRS, SINGLES = (", ".join(str(list(c)) for c in Tree().open_parts(vary)) for vary in (2, 1))
#: The same result by DuckDB, on strings instead of hashes.
SQL = rf"""
WITH src AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
each AS (SELECT doc_id, unnest(range(len(lines))) AS pos, unnest(lines) AS line FROM src),
words AS (
  SELECT doc_id, pos, list_filter(string_split_regex(regexp_replace(translate(line, '{UPPER}', '{LOW}'), '{_WORD}*[0-9]{_WORD}*', '<*>', 'g'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM each),
segs AS (
  SELECT doc_id, pos, len(w) AS n, w[1:3] AS lead,
    [w[4 + (k * greatest(len(w) - 3, 0)) // 6 : 3 + ((k + 1) * greatest(len(w) - 3, 0)) // 6] FOR k IN range(6)] AS s
  FROM words WHERE len(w) >= 1),
entries AS (
  SELECT doc_id, pos, n, lead, s, unnest(CASE WHEN n >= 9 THEN [{PAIRS}] WHEN n >= 5 THEN [{SINGLES}] ELSE [[-1]] END) AS open FROM segs),
keyed AS (
  SELECT doc_id, pos, (n, lead, open, [CASE WHEN list_contains(open, k) THEN NULL ELSE s[k + 1] END FOR k IN range(6)])::VARCHAR AS key FROM entries),
firsts AS (SELECT key, min(doc_id) AS lo FROM keyed GROUP BY key HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, pos FROM keyed JOIN firsts USING (key) WHERE doc_id > lo),
gone_of AS (SELECT doc_id, list(pos) AS at FROM gone GROUP BY doc_id)
SELECT d.doc_id,
  CASE WHEN g.at IS NULL THEN d.text
       ELSE coalesce(array_to_string([string_split(d.text, chr(10))[i + 1] FOR i IN range(len(string_split(d.text, chr(10)))) IF NOT list_contains(g.at, i)], chr(10)), '') END AS text,
  coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines,
  coalesce(len(g.at), 0)::BIGINT AS n_dropped
FROM documents d LEFT JOIN gone_of g USING (doc_id)
"""
