"""Line dedup across documents, in DataFrame operations only.

Lines are exploded with their position and keyed by two 64-bit hashes of the
normalised line. One grouped pass per key finds whether at least two documents
hold it: the smallest and the largest doc_id differ. That needs no distinct
count, and its partial aggregation shrinks hot lines before the shuffle. The
lines are then joined with the repeated keys only; a hot key's side of that
join is split by adaptive execution. What comes back to the documents is a
bitmap of dropped positions for each document, not the lines themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innspark.llm.common import ascii_lower

SPACES = " \t\n\x0b\x0c\r"


def _lines(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    key = ascii_lower(F.trim(F.col("line"), F.lit(SPACES)))
    return (docs.select("doc_id", F.hash(text).alias("th"), F.posexplode(F.split(text, "\n")))
            .toDF("doc_id", "th", "pos", "line")
            .where("doc_id is not null")
            .select("doc_id", "th", "pos", key.alias("key"))
            .where(F.char_length("key") >= min_chars)
            .select("doc_id", "th", "pos", F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit(7), "key").alias("h2")))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 10, text: str = "text") -> DataFrame:
    """(doc_id, text, n_lines, n_dropped, kept) for every row of ``docs``.

    A line's key is the line without ASCII white space at both ends, A-Z
    lower-cased. A key of at least ``min_chars`` code points that occurs in two
    or more documents loses all its lines but those in the smallest doc_id
    holding it; ``kept`` joins the other lines by a line feed.

    Null or empty text is one empty line. A row without doc_id is kept whole
    and its lines count for no key. Rows that repeat a doc_id are the same
    document; each of them is returned. Other columns are ignored.
    """
    # internal column names: the input's further columns can't clash with them
    docs = docs.select(F.col("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    lines = _lines(docs, "text", min_chars)
    repeated = (lines.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc"),
                                              F.max("doc_id").alias("last_doc"))
                .where("first_doc < last_doc").drop("last_doc"))
    words = (lines.join(repeated, ["h1", "h2"]).where("doc_id > first_doc")
             .groupBy("doc_id", "th", F.expr("pos div 64").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(pos % 64 as int))")).alias("bits")))
    dropped = (words.groupBy("doc_id", "th")
               .agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("by_word"),
                    F.max("word").alias("last_word"))
               .select("doc_id", "th",
                       F.expr("transform(sequence(0L, last_word), w -> coalesce(by_word[w], 0L))"
                              ).alias("gone")))
    out = docs.withColumn("th", F.hash("text")).join(dropped, ["doc_id", "th"], "left")
    keep = F.filter(F.split("text", "\n"), lambda x, i: F.expr("gone is null") | (
        F.coalesce(F.getbit(F.get(F.col("gone"), (i / 64).cast("int")), i % 64), F.lit(0)) == 0))
    return out.select(
        "doc_id", "text", F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
        F.coalesce(F.aggregate("gone", F.lit(0), lambda a, x: a + F.bit_count(x)), F.lit(0)
                   ).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(keep, "\n")
                                                                ).alias("kept"))


def op7_line_dedup(docs: DataFrame) -> DataFrame:
    return drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, l.pos AS pos, l.line AS line,
         translate(trim(l.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(list_transform(
          string_split(coalesce(text, ''), chr(10)),
          lambda x, i: {'pos': i, 'line': x})) AS l FROM documents)
), repeated AS (
  SELECT key, min(doc_id) AS first_doc FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT l.doc_id, l.pos, l.line, r.first_doc IS NOT NULL AND l.doc_id > r.first_doc AS gone
  FROM lines l LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
