"""Line dedup: lines that many documents share stay in one of them only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import SPACE, ascii_lower, cut, lookup, written

MIN_CHARS, MIN_DOCS = 20, 3


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text", counts: bool = True) -> DataFrame:
    """The documents with their shared lines taken out, plus n_lines and n_dropped (which replace columns of these
    names) if `counts`.

    Lines are exploded, normalised (white space stripped, A-Z lowered) and hashed to 128 bits, once, into a narrow table;
    only hashes travel by line. Each hash's distinct documents are counted, and lines of a key of at least `min_chars` code
    points in at least `min_docs` documents go, except in the largest id. The rest is put together again by position.

    Null or empty text is one empty line. A null id counts as one document, smaller than all others. Rows that repeat an
    id are one document in the counts; each row keeps its own lines. A text of any length is one row; its lines are dealt
    out by hash, and put together in one task. An empty table gives an empty table.
    """
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in others)).alias("_row"),
        F.col(id_col).alias("_id"),
        F.col(text_col).alias("_text"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_version"),
    )
    lines = rows.select("_id", "_version", F.posexplode(_lines(F.col("_text"))).alias("_pos", "_line")).select("_id", "_version", "_pos", ascii_lower(F.btrim("_line", F.lit(SPACE))).alias("_key"))
    hashed = written(lines.where(F.char_length("_key") >= min_chars).select("_id", "_version", "_pos", F.unhex(F.md5("_key")).alias("_hash")))
    shared = cut(hashed.select("_hash", "_id").distinct().groupBy("_hash").agg(F.count(F.lit(1)).alias("_docs"), F.max("_id").alias("_keeper")).where(F.col("_docs") >= min_docs))
    marked = lookup(hashed, shared, "_hash", "_docs", F.xxhash64("_id", "_pos"))
    dropped = marked.where(F.col("_docs").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_keeper"))).groupBy("_id", "_version").agg(F.collect_set("_pos").alias("_gone"))
    d = dropped.select(F.col("_id").alias("_did"), F.col("_version").alias("_dversion"), "_gone")
    # the only shuffle of texts: each goes once, and is split only where lines go
    joined = rows.join(d, F.col("_id").eqNullSafe(F.col("_did")) & (F.col("_version") == F.col("_dversion")), "left").withColumn("_lines", F.when(F.col("_gone").isNotNull(), _lines(F.col("_text"))))
    whole = F.coalesce(F.col("_text"), F.lit(""))
    n = F.char_length(whole) - F.char_length(F.replace(whole, F.lit("\n"))) + 1
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))  # by hash set, in order of position
    text = F.when(F.col("_gone").isNull(), whole).otherwise(F.array_join(F.transform(stay, lambda p: F.get(F.col("_lines"), p)), "\n"))
    made = {"n_lines": n.cast("long"), "n_dropped": F.coalesce(F.size("_gone"), F.lit(0)).cast("long")} if counts else {}
    kept = [c for c in docs.columns if c not in made]
    return joined.select(*(text.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in kept), *(c.alias(k) for k, c in made.items()))


def without_shared_lines(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, in the texts that `dedup_lines` leaves; n_chars follows where there is one."""
    out = dedup_lines(docs, counts=False)
    return (out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out).select(*docs.columns)


def op1_line_dedup(docs: DataFrame) -> DataFrame:
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "utf-8"), 256).alias("kept_sha256"))


OP1_SQL = """
WITH lines AS (
  SELECT doc_id, p - 1 AS pos, parts[p] AS line,
         translate(trim(parts[p], concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS p
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), shared AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT l.doc_id, l.pos, l.line, (s.k IS NOT NULL AND l.doc_id <> s.keeper) AS gone
  FROM lines l LEFT JOIN shared s ON l.k = s.k
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
