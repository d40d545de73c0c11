"""Quality rules: lines are judged first, then documents by what their lines leave."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm.common import SPACE, let, own_columns, read, text_or_empty

#: Characters that are symbols in prose.
SYMBOLS = "#*$%&|<>"
#: Characters between the links of a navigation bar.
LINKS = "|»›"
#: Phrases of page furniture, in lower case.
BOILERPLATE = (
    "accept all cookies",
    "all rights reserved",
    "click here to",
    "cookie policy",
    "enable javascript",
    "log in to continue",
    "privacy policy",
    "share on facebook",
    "share on twitter",
    "sign up for our newsletter",
    "skip to content",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
)


def chars_of(text: Column, some: str) -> Column:
    """How many characters of the text are in `some`."""
    return F.regexp_count(text, F.lit(f"[{some}]"))


@own_columns
def base_columns(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed.

    A word is a run without white space. n_repeat_words counts words inside 3-word windows found twice or more in the
    text; windows are told apart by 64-bit hashes, sorted in the row with their places, so that even a very long text
    takes n log n steps and nothing is shuffled. A null or empty text has no words, so it fails.
    """
    text = text_or_empty(text_col)
    words = F.array_remove(F.split(text, f"[{SPACE}]+"), "")
    counted = docs.withColumn("_words", words).withColumn("n_words", F.size("_words").cast("long"))
    hashes = F.when(
        F.col("n_words") >= 3,
        F.transform(F.sequence(F.lit(0), F.col("n_words").cast("int") - 3), lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))),
    ).otherwise(F.array().cast("array<long>"))

    def repeated(ordered: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(ordered, k)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(ordered, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))

    def covered(places: Column) -> Column:
        return F.aggregate(
            places,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")),
            lambda acc: acc["n"],
        )

    counted = counted.withColumn("_hashes", hashes).withColumn("_paired", F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    with_word = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    return (
        counted.withColumn("n_repeat_words", F.when(F.col("_paired").isNull(), F.lit(0).cast("long")).otherwise(covered(repeated(F.col("_paired")))))
        .withColumn("word_chars", F.char_length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"))
        .withColumn("n_dup_lines", let(with_word, lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
        .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
        .drop("_words", "_hashes", "_paired")
    )


def _phrase_in(lowered: Column) -> Column:
    return reduce(Column.__or__, [F.contains(lowered, F.lit(phrase)) for phrase in BOILERPLATE])


def suspect(text: Column) -> Column:
    """False only if no line of the text can fail: without symbols, exclamation marks, links and phrases."""
    return text.rlike(f"[{SYMBOLS}!{LINKS}]") | _phrase_in(F.lower(text))


def judged_lines(text: Column, max_symbol_share: float = 0.1, min_links: int = 3, link_share: float = 0.25, max_shout_share: float = 0.25) -> Column:
    """array<struct<line, chars, why>>: the text's lines, their characters but white space, and why one fails or null.

    punctuation: symbols are over max_symbol_share of the characters, or exclamation marks over max_shout_share of the
    words. navigation: at least min_links separators (| or a guillemet), over link_share of the words. boilerplate: a
    phrase of page furniture in under 30 words.
    """

    def judge(line: Column) -> Column:
        words = chars_of(F.btrim(line, F.lit(SPACE)), SPACE) + 1
        chars = F.char_length(line) - chars_of(line, SPACE)
        links = chars_of(line, LINKS)
        why = (
            F.when(chars == 0, None)
            .when((links >= min_links) & (links > link_share * words), "navigation")
            .when((chars_of(line, SYMBOLS) > max_symbol_share * chars) | (chars_of(line, "!") > F.greatest(F.lit(2), max_shout_share * words)), "punctuation")
            .when((words < 30) & _phrase_in(F.lower(line)), "boilerplate")
        )
        return F.struct(line.alias("line"), chars.alias("chars"), why.alias("why"))

    return F.transform(F.split(text, "\n"), judge)


@own_columns
def clean_lines(docs: DataFrame, max_lost: float = 0.3, text_col: str = "text") -> DataFrame:
    """docs with the columns of base_columns, cleaned (the text without failing lines), lost_chars, all_chars and kept.

    kept is false if base_failed, or if failing lines hold over max_lost of the characters. Columns of these names in
    the input are replaced, all others carried; a row in, a row out.
    """
    lines, text = F.col("_judged"), text_or_empty(text_col)
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda n, x: n + x["chars"])
    return (
        base_columns(docs, text_col)
        .withColumn("_judged", F.when(suspect(text), judged_lines(text)))
        .withColumn("all_chars", F.col("word_chars"))
        .withColumn("lost_chars", F.coalesce(total(F.filter(lines, lambda x: x["why"].isNotNull())), F.lit(0).cast("long")))
        .withColumn("cleaned", F.when(F.col("lost_chars") == 0, text).otherwise(F.array_join(F.transform(F.filter(lines, lambda x: x["why"].isNull()), lambda x: x["line"]), "\n")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("lost_chars") <= max_lost * F.col("all_chars")))
        .drop("_judged")
    )


@own_columns
def kept_documents(docs: DataFrame, max_lost: float = 0.3, text_col: str = "text") -> DataFrame:
    """clean_lines' rows that are kept.

    The filter stands on a row number, which the optimizer doesn't move it past: pushed below the projections, it
    would compute every nested column once more for each use.
    """
    judged = clean_lines(docs, max_lost, text_col).withColumn("_row", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("_row") >= 0)).drop("_row")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = clean_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars", "all_chars")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         string_split(text, chr(10)) AS lines, text, doc_id
  FROM d
), windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n > 1
), repeats AS (
  SELECT r, sum(least(3, i - coalesce(prev, -9)))::BIGINT AS n_repeat_words
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS prev FROM again) GROUP BY r
), line AS (
  SELECT r, l, length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g')) AS chars,
         len(regexp_extract_all(regexp_replace(l, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '[\x20\x09-\x0D]')) + 1 AS words,
         len(regexp_extract_all(l, '[|»›]')) AS links, len(regexp_extract_all(l, '[#*$%&|<>]')) AS symbols,
         len(regexp_extract_all(l, '!')) AS shouts
  FROM (SELECT r, unnest(lines) AS l FROM w)
), judged AS (
  SELECT r, sum(chars)::BIGINT AS all_chars,
         coalesce(sum(chars) FILTER (WHERE (links >= 3 AND links > 0.25 * words) OR symbols > 0.1 * chars
           OR shouts > greatest(2, 0.25 * words) OR (words < 30 AND regexp_matches(lower(l), 'PHRASES'))), 0)::BIGINT AS lost_chars,
         (count(*) FILTER (WHERE chars > 0) - count(DISTINCT l) FILTER (WHERE chars > 0)) AS n_dup_lines
  FROM line GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
       len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
       len(words) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(words) AS base_failed,
       NOT (len(words) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(words)) AND lost_chars <= 0.3 * all_chars AS kept,
       lost_chars, all_chars
FROM w JOIN judged USING (r) LEFT JOIN repeats USING (r)
""".replace("PHRASES", "|".join(BOILERPLATE))
