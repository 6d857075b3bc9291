"""Benchmark decontamination, in DataFrame operations only.

Benchmark items become a set of hashed word windows; the documents' words are
hashed in windows of the same lengths and matched by an equality join whose
condition also compares the words themselves, so a hash hit is verified in the
same step. The window set is broadcast when its counted size is below a
bound and joined by a shuffle beyond it. One row without a window travels with
each document, so that a single grouping returns hits and clean documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innspark.llm.common import ascii_lower, fresh, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_WORDS = 2_000_000  # words and item ids of the benchmark's windows; some 30 MB


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), 0)


def _windows(benchmark: DataFrame, n: int) -> DataFrame:
    """(hash, len, window, items): the distinct windows of all items."""
    w = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    w = w.withColumn("len", F.least(F.size("w"), F.lit(n)))
    return (w.select("item_id", "len", F.explode(F.expr(
        "transform(sequence(0, size(w) - len), i -> slice(w, i + 1, len))")).alias("window"))
        .groupBy("len", "window").agg(F.collect_set("item_id").alias("items"))
        .withColumn("hash", _hash(F.col("window"), F.lit(0), F.col("len"), range(1, n + 1))))


def _hash(w: Column, pos: Column, length: Column, lens) -> Column:
    """Hash of the ``length`` words of ``w`` from ``pos``. Plain expressions on
    array items stay in generated code; a slice or a lambda for each window
    would be made as an object."""
    out = F.lit(None).cast("long")
    for k in lens:
        out = F.when(length == k, F.xxhash64(*(F.get(w, pos + j) for j in range(k)))).otherwise(out)
    return out


def _matches(docs: DataFrame, benchmark: DataFrame, n: int) -> DataFrame:
    """(doc_id, th, n_words, copies, at, items): distinct rows with their count."""
    docs = docs.select(F.col("doc_id"), F.col("text"))
    bench = written(_windows(benchmark.select(F.col("item_id"), F.col("text")), n), "windows")
    sizes = bench.groupBy("len").agg(F.count("*").alias("n"),
                                     F.sum(F.size("items")).alias("ids")).collect()  # n rows at most
    lens = sorted(r["len"] for r in sizes)
    small = sum(r["len"] * r["n"] + r["ids"] for r in sizes) <= BROADCAST_WORDS
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), words(F.col("text")).alias("w"))
    # -1 stands for the document itself, pos * (n + 1) + len for a window
    marks = [f"if(size(w) >= {k}, sequence({k}, (size(w) - {k}) * {n + 1} + {k}, {n + 1}), array())"
             for k in lens]
    spread = rows.select("doc_id", "th", F.size("w").alias("n_words"), "w",
                         F.explode(F.expr(f"concat({', '.join(['array(-1)', *marks])})")).alias("x"))
    spread = spread.select(
        "doc_id", "th", "n_words", "w", F.floor(F.col("x") / (n + 1)).cast("int").alias("pos"),
        F.pmod(F.col("x"), F.lit(n + 1)).alias("len"))
    spread = spread.withColumn("hash", _hash(F.col("w"), F.col("pos"), F.col("len"), lens))
    here = F.expr("slice(w, greatest(pos, 0) + 1, greatest(len, 1))")
    if not small:  # a shuffled row carries its own window, not the document's words
        spread = spread.withColumn("w", F.when(F.col("pos") >= 0, here))
        here = F.col("w")
    b = bench.select(F.col("hash").alias("b_hash"), "window", "items")
    # the words are compared as an order, which isn't taken for a join key: it is
    # evaluated where hashes agree only
    met = (spread.join(F.broadcast(b) if small else b, (F.col("hash") == F.col("b_hash"))
                       & (here >= F.col("window")) & (here <= F.col("window")), "left")
           .where("pos < 0 or items is not null"))
    found = met.groupBy("doc_id", "th", "n_words").agg(
        F.sum(F.when(F.col("pos") < 0, 1).otherwise(0)).cast("int").alias("copies"),
        F.array_sort(F.collect_set(F.when(F.col("pos") >= 0, F.struct("pos", "len")))).alias("at"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    return found.withColumn("at", _merged(F.col("at")))


def _merged(at: Column) -> Column:
    """Sorted (pos, len) as disjoint [start, end) intervals."""
    empty = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    one = lambda x: F.array(F.struct(x["pos"].alias("start"),
                                     (x["pos"] + x["len"]).alias("end")))

    def add(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        longer = F.array(F.struct(last["start"].alias("start"),
                                  F.greatest(last["end"], x["pos"] + x["len"]).alias("end")))
        return F.when(F.size(acc) == 0, one(x)).when(
            x["pos"] <= last["end"], F.concat(F.slice(acc, 1, F.size(acc) - 1), longer)
        ).otherwise(F.concat(acc, one(x)))

    return F.aggregate(at, empty, add)


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, hits, items) for every row of ``docs``.

    Words are runs of digits, letters and non-ASCII characters after A-Z is
    lower-cased. A window is ``n`` consecutive words of an item; an item with
    fewer words is one window. ``hits`` are the [start, end) word intervals
    covered by any window, merged; ``items`` the sorted ids (as strings) of the
    items that have a window in the document.

    Null or empty text has no words. Items without words match nothing; an
    item without id marks words but isn't listed. Repeated rows and rows
    without doc_id are each returned. An empty benchmark leaves all clean.
    Other columns are ignored.
    """
    found = _matches(docs, benchmark, n)
    size = F.aggregate("at", F.lit(0), lambda a, x: a + x["end"] - x["start"])
    return (found.withColumn("copy", F.explode(F.expr("sequence(1, copies)")))
            .select("doc_id", F.col("n_words").cast("long").alias("n_words"),
                    size.cast("long").alias("n_hit"), F.col("at").alias("hits"),
                    F.array_sort(F.transform("items", lambda x: x.cast("string"))).alias("items")))


def _bad(docs: DataFrame, benchmark: DataFrame, n: int) -> tuple[DataFrame, Column, str]:
    """The documents with hits, how a row of ``docs`` meets them, the column of the hits."""
    doc, text, at = (fresh(docs, c) for c in ("bad_id", "bad_text", "bad_at"))
    bad = (_matches(docs, benchmark, n).where(F.size("at") > 0)
           .select(F.col("doc_id").alias(doc), F.col("th").alias(text), F.col("at").alias(at)))
    return bad, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(text)), at


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window. Null and empty
    texts hold none; a row goes by its own text, also where others share its doc_id
    (or have none); all columns stay, whatever their names."""
    bad, same, _ = _bad(docs, benchmark, n)
    return docs.join(bad, same, "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """``docs`` whose texts lose the words of benchmark windows, together with
    what stands between two of them. Null and empty texts stay as they are; repeated
    rows are each returned; all other columns stay, whatever their names."""
    bad, same, at = _bad(docs, benchmark, n)
    whole = WORD.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")  # words before lower-casing
    word, gap = F.regexp_extract_all("text", F.lit(whole), 0), F.split("text", whole, -1)
    hit = lambda i: F.exists(at, lambda x: (x["start"] <= i) & (i < x["end"]))
    kept = F.transform(gap, lambda g, i: F.concat(
        F.when((i > 0) & hit(i) & hit(i - 1), F.lit("")).otherwise(g),
        F.when(hit(i), F.lit("")).otherwise(F.coalesce(F.get(word, i), F.lit("")))))
    return (docs.join(bad, same, "left")
            .withColumn("text", F.when(F.col(at).isNull(), F.col("text")).otherwise(F.array_join(kept, "")))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op6_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, len, array_to_string(list_slice(w, i, i + len - 1), ' ') AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS len,
               unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM item_words WHERE len(w) > 0)
), doc_windows AS (
  SELECT doc_id, k AS len, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM doc_words, (SELECT DISTINCT len AS k FROM windows) WHERE len(w) >= k)
), met AS (
  SELECT doc_id, item_id, i, len FROM doc_windows JOIN windows USING (len, win)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + len)) AS p FROM met) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met WHERE item_id IS NOT NULL)
  GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
