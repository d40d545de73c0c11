"""Line dedup: a line that several documents hold stays in one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm.common import SPACE, ascii_lower, durable, id_or_last, own_columns, read, text_or_empty


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


@own_columns
def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with repeated lines taken out of the text, and n_lines and n_dropped (long).

    Lines explode with their place; the key's 128-bit hash is counted by distinct documents, and a key of at least
    min_chars code points in at least min_docs documents loses its lines in all of them but the one of the smallest
    id. What stays is joined again in its order. Rows that share an id are one document. A null or empty text is one
    empty line; a null id sorts last; rows stay as many as they were; columns n_lines and n_dropped of the input are
    replaced, all others carried. The counting keeps one row for each key and task, so a line that a third of the
    documents hold is no hot group; the join that follows splits.
    """
    lines = F.split(F.col("_text"), "\n")
    narrow = docs.select(id_or_last(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    keyed = (
        narrow.select("_id", F.xxhash64("_text").alias("_hash"), F.posexplode(lines).alias("_place", "_line"))
        .select("_id", "_hash", "_place", line_key(F.col("_line")).alias("_key"))
        .where(F.char_length("_key") >= min_chars)
        .select("_id", "_hash", "_place", F.xxhash64("_key").alias("_k1"), F.xxhash64(F.lit("second"), F.col("_key")).alias("_k2"))
    )
    holders = keyed.groupBy("_k1", "_k2")
    if min_docs <= 2:
        held = holders.agg(F.min("_id").alias("_first"), F.max("_id").alias("_end")).where(F.col("_first") < F.col("_end") if min_docs == 2 else F.lit(True))
    else:
        held = keyed.select("_k1", "_k2", "_id").distinct().groupBy("_k1", "_k2").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).where(F.col("_n") >= min_docs)
    # written down, so that the join's hot keys can split: an aggregate just below it would forbid that
    held = durable(held.select("_k1", "_k2", "_first"))
    dropped = (
        keyed.join(held, ["_k1", "_k2"])
        .where(F.col("_id") > F.col("_first"))
        .groupBy("_id", "_hash")
        .agg(F.collect_set("_place").alias("_dropped"))
        .withColumnsRenamed({"_id": "_of", "_hash": "_as"})
    )
    text = text_or_empty(text_col)
    joined = docs.drop("n_lines", "n_dropped").join(dropped, (id_or_last(id_col) == F.col("_of")) & (F.xxhash64(text) == F.col("_as")), "left")
    split = joined.withColumn("_lines", F.split(text, "\n")).withColumn("n_lines", F.size("_lines").cast("long")).withColumn("n_dropped", F.coalesce(F.size("_dropped"), F.lit(0)).cast("long"))
    kept = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped")), lambda place: F.get("_lines", place)), "\n")
    return split.withColumn(text_col, F.when(F.col("_dropped").isNull(), text).otherwise(kept)).drop("_lines", "_dropped", "_of", "_as")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line, lower_az(line) AS key
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), held AS (
  SELECT key, min(doc_id) AS first_id FROM lines
  WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT doc_id, i, line, held.key IS NOT NULL AND doc_id <> first_id AS gone
  FROM lines LEFT JOIN held USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""".replace("lower_az(line)", "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
