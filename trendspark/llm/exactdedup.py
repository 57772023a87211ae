"""Exact de-duplication by content-defined chunk recipes (operator 10), in DataFrame functions only.

Method: a text without blanks (``[\\x20\\x09-\\x0D]``) is cut into chunks where its own content says so: a chunk ends
at the first BOUNDARY past MIN_CHUNK characters (letters of some kinds in a row, or beyond ASCII a character and a
punctuation mark), or at MAX_CHUNK. A chunk is known by its SHA-256 digest, its length and a second hash, and no chunk's
text leaves the task that read it. The chunks of all documents are de-duplicated: every distinct chunk that stands in two
places or more becomes one identifier, a long. A chunk that differs from another in any of the three is another
identifier, so a collision of one digest joins nothing. A document with a chunk that stands in one place only has no
equal; of the others the ordered lists of identifiers are compared, and equal lists are equal texts.
What is shuffled is 44 bytes a chunk and then 8, never documents: first partial counts of chunks, then the identifiers
back to the rows, then partial maxima of each list, which reduce a list shared by a third of all rows before the shuffle.
The joins have exchanges of their own on both sides, so that AQE can split a chunk or a list that many rows share.

Of equal texts the row with the most code points in the original text, then the smallest doc_id, stays. Results: null
text counts as empty, and empty texts are equal to each other; repeated rows count as rows of a group; a row without a
doc_id belongs to its group but stays only if no row of it has one (keep_id is then null); an empty table gives an
empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import cut, fresh

#: Fixed value: the characters that do not count.
BLANKS = " \t\n\x0b\x0c\r"
MIN_CHUNK, MAX_CHUNK = 512, 4096
#: What ends a chunk: letters found at about one place in a hundred of Latin text; in other scripts punctuation.
BOUNDARY = r"(?:[k-t][a-e][n-z][a-l]|[^\x00-\x7F]\p{P})"


def normalised(text: Column) -> Column:
    """The text without blanks; null counts as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), BLANKS, "")


def recipe(norm: Column) -> Column:
    """The ordered chunks of a text, each as digest, length and second hash; the chunks together are the whole text."""
    pattern = f"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?{BOUNDARY}|.{{1,{MAX_CHUNK}}}"
    chunks = F.regexp_extract_all(norm, F.lit(pattern), F.lit(0))
    return F.transform(chunks, lambda c: F.concat(
        F.unhex(F.sha2(c, 256)), F.unhex(F.lpad(F.hex(F.length(c)), 8, "0")), F.unhex(F.lpad(F.hex(F.xxhash64(c)), 16, "0"))))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_points (of the original text), text_sha256 and recipe."""
    norm = normalised(F.col(text_col))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("n_points"),
        F.sha2(norm, 256).alias("text_sha256"),
        recipe(norm).alias("recipe"),
    )


def chunk_table(pieces: DataFrame) -> DataFrame:
    """One row for each distinct ``chunk`` of ``pieces`` that stands in two places or more: chunk, chunk_id."""
    repeated = cut(pieces.groupBy("chunk").agg(F.count("*").alias("places")).where("places > 1").select("chunk"))
    return repeated.withColumn("chunk_id", F.monotonically_increasing_id())  # of written rows, so the same at every reading


def identifier_lists(rows: DataFrame) -> DataFrame:
    """The rows (``row``, ``recipe``) that can have an equal, with their ordered identifiers: row, ids. Rows with a chunk
    that stands nowhere else are left out."""
    pieces = rows.select("row", F.size("recipe").alias("n"), F.posexplode("recipe").alias("at", "chunk"))
    known = pieces.join(chunk_table(pieces.select("chunk")), "chunk").groupBy("row").agg(
        F.any_value("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "chunk_id"))).alias("found"))
    return known.where(F.size("found") == F.col("n")).select("row", F.col("found.chunk_id").alias("ids"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = cut(recipes(docs, id_col, text_col)).withColumn("row", F.monotonically_increasing_id())
    own = F.when(F.size("recipe") == 0, F.array().cast("array<long>"))
    lists = identifier_lists(rows).withColumnRenamed("ids", "found")
    listed = cut(rows.withColumn("own", own).drop("recipe").join(lists, "row", "left").select(
        "doc_id", "n_points", "text_sha256", F.coalesce("own", "found").alias("ids")))
    best = F.max(F.struct(F.col("doc_id").isNotNull(), F.col("n_points"), F.bitwise_not("doc_id"))).alias("best")
    groups = listed.where("ids IS NOT NULL").groupBy("ids").agg(best, F.count("*").alias("group_size"))
    # written out, so that the join has an exchange of its own on both sides and AQE can split a large group
    groups = cut(groups.select("ids", F.bitwise_not(F.col("best.col3")).alias("keep_id"), "group_size"))
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    alone = listed.where("ids IS NULL").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256")
    out = listed.where("ids IS NOT NULL").join(groups, "ids").select(*columns).unionByName(alone)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def one_row(rows: DataFrame, by: list[str], columns: list[str], text_col: str) -> DataFrame:
    """``columns`` of one row of each group of ``rows``: the longest text, then the first in order of the row as JSON
    (rows equal in that are equal)."""
    whole = F.struct(*columns)
    order = F.struct(-F.length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), F.to_json(whole))
    return rows.groupBy(*by).agg(F.min_by(whole, order).alias("_row")).select("_row.*")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of equal texts, with all its columns: a row with the group's keep_id and its text; of
    several (repeated rows, or only rows without an id) the one that ``one_row`` chooses. An id with different texts
    stands in each of their groups by itself. Columns of any name keep their values."""
    rows = exact_groups(docs, id_col, text_col)
    none, own_id, sha, kept, n = fresh(docs.columns, "_none", "_id", "_sha", "_kept", "_n")
    key = [F.col("doc_id").isNull().alias(none), F.coalesce("doc_id", F.lit(0)).alias(own_id), F.col("text_sha256").alias(sha)]
    marks = rows.groupBy(*key, F.col("kept").alias(kept)).agg(F.count("*").alias(n))
    marks = cut(marks.where(~F.col(kept) | (F.col(n) > 1)).drop(n))
    own = F.col(id_col).cast("long")
    keyed = docs.withColumns({none: own.isNull(), own_id: F.coalesce(own, F.lit(0)), sha: F.sha2(normalised(F.col(text_col)), 256)})
    on = [none, own_id, sha]
    out = keyed.join(marks, on, "left_anti").select(*docs.columns)
    repeated = marks.where(kept)
    if repeated.isEmpty():
        return out
    return out.unionByName(one_row(keyed.join(repeated, on, "left_semi"), [sha], docs.columns, text_col))


ORACLE_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
