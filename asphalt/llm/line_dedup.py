"""Line deduplication by overlapping windows of three lines.

Every three consecutive lines of a document are a window. Windows that occur
more than once in the whole collection keep their first occurrence, by document
id and position; all later ones cover their three lines, and covered lines go.
So a passage of three or more lines goes wherever it is repeated, while single
lines that many documents share stay.

Everything is built-in functions. Windows are counted with partial sums, so a
window that a third of all documents share is one row per task; going back to
its occurrences is a plain equi-join that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINES = 3


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame, id_column: str, text_column: str, size: int = LINES) -> DataFrame:
    """A row for each window: (doc_id, same, at, mark). ``same`` tells texts of one id apart."""
    def marks(lines: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(lines) - size),
            lambda i: F.unhex(F.md5(F.array_join(F.slice(lines, i + 1, size), "\n"))))

    # split once: the lines are handed on through a one-element array
    marked = F.transform(
        F.array(lines_of(F.col(text_column))), lambda l: F.when(F.size(l) >= size, marks(l)))[0]
    rows = docs.where(F.col(text_column).contains("\n")).select(
        F.col(id_column).alias("doc_id"), F.xxhash64(text_column).alias("same"), F.posexplode(marked).alias("at", "mark"))
    return rows


def covered_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = LINES) -> DataFrame:
    """Positions of the lines that later occurrences cover: (doc_id, same, covered), one row a document with any."""
    marks = windows(docs, id_column, text_column, size)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "same", "at")
    repeated = marks.groupBy("mark").agg(F.min(place).alias("first"), F.max(place).alias("final")).where(
        "first != final").select("mark", "first")
    later = marks.join(repeated, "mark").where(place != F.col("first")).select("doc_id", "same", "at")
    found = later.groupBy("doc_id", "same").agg(F.collect_set("at").alias("starts"))
    spread = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (size - 1)))))
    return found.select("doc_id", "same", F.array_sort(spread).alias("covered"))


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = LINES) -> DataFrame:
    """All rows with the text that stays and what went: all columns, then ``kept_text``, ``n_lines``, ``n_removed``.

    Lines end at a line feed and are compared exactly. Null texts stay null and
    have no line; texts with fewer than three lines stay as they are. Rows that
    repeat an id and its text are one document and get the same result; texts
    of one id that differ are ordered by hash. Null ids come after all others.
    A text that goes altogether is empty. Input columns with the names of
    results are replaced.
    """
    covered = covered_lines(docs, id_column, text_column, size).select(
        F.col("doc_id").alias("__id"), F.col("same").alias("__same"), F.col("covered").alias("__covered"))
    names = ("kept_text", "n_lines", "n_removed")
    rows = docs.drop(*names)
    joined = rows.join(
        covered, rows[id_column].eqNullSafe(F.col("__id")) & (F.xxhash64(rows[text_column]) == F.col("__same")), "left")
    lines = lines_of(F.col(text_column))
    left = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains(F.col("__covered"), i)), "\n")
    return joined.select(
        *rows.columns,
        F.when(F.col("__covered").isNull(), F.col(text_column)).otherwise(left).alias("kept_text"),
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("__covered"), F.lit(0)).alias("n_removed"),
    )


ORACLE = """
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (
  SELECT doc_id, pos, lines[pos + 1] || chr(10) || lines[pos + 2] || chr(10) || lines[pos + 3] AS mark
  FROM (SELECT doc_id, lines, unnest(range(0, len(lines) - 2)) AS pos FROM l WHERE len(lines) >= 3)),
n AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY mark ORDER BY doc_id, pos) AS seen FROM w),
c AS (SELECT doc_id, list(DISTINCT p) AS covered FROM (
  SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS p FROM n WHERE seen > 1) GROUP BY doc_id),
r AS (SELECT l.doc_id, text, lines, covered FROM l LEFT JOIN c ON l.doc_id = c.doc_id),
k AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS kept FROM (
    SELECT doc_id, covered, unnest(lines) AS line, unnest(range(0, len(lines))) AS p FROM r WHERE covered IS NOT NULL)
  WHERE NOT list_contains(covered, p) GROUP BY doc_id)
SELECT r.doc_id, COALESCE(len(lines), 0) AS n_lines, COALESCE(len(covered), 0) AS n_removed,
  CASE WHEN covered IS NULL THEN text ELSE COALESCE(kept, '') END AS kept_text
FROM r LEFT JOIN k ON r.doc_id = k.doc_id
"""
