"""Ranked lexical search with buckets by vector length.

A document's impact vector holds, for the terms that any query uses, how much a term
adds to a score per unit of the term's weight. Scoring a query is an inner product, and
the largest inner products are found as in LEMP:

* vectors are ordered by length and cut into buckets; a query skips a bucket, and the
  rest of its task's buckets, when by Cauchy-Schwarz even the longest vector in it can't
  reach the query's threshold;
* inside a bucket the query's heaviest coordinates are summed exactly, the others bounded
  by the product of the remaining lengths; vectors below the threshold go;
* the survivors are scored again exactly, in integers.

Thresholds start from the longest vectors of all (each task's rise as it goes on). Every
bound only ever discards vectors that can't be among the best. Documents aren't shuffled:
a task orders and buckets what it reads.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innspark.llm.common import written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_TERMS = 500_000  # terms of a block of queries, with repeats; a pass over the documents each
BUCKET_ROWS = 2048
SHARD_CELLS = 1 << 21  # coordinates that a task orders at a time
HEAD = 8192  # vectors, at least, whose scores set the first thresholds
FOCUS = 0.85  # share of a query's squared length that its focus coordinates hold

#: bytes of terms stay, A-Z lower-cased; every other ASCII character separates
FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128
             else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


@dataclass
class Queries:
    """A block of items: the term numbers of each, distinct and ascending."""

    ids: list
    own: list[np.ndarray]
    numbers: dict[bytes, int]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


def _blocks(items: DataFrame, block_terms: int) -> Iterator[Queries]:
    """The queries in blocks of about ``block_terms`` terms, each small enough for the
    driver and the tasks. Rows that share an item_id are one query with all their terms."""
    items = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.regexp_count("text", F.lit(TERM))).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // block_terms))
    for b in range(blocks):
        mine = items if blocks == 1 else items.where(
            F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        by_item: dict = {}
        for r in mine.toLocalIterator():
            by_item.setdefault(r["item_id"], set()).update(terms(r["text"].encode()))
        ids = sorted(by_item, key=lambda x: (x is None, x if x is not None else 0))
        numbers = {t: k for k, t in enumerate(sorted(set().union(*by_item.values())))}
        if numbers:
            yield Queries(ids, [np.array(sorted(numbers[t] for t in by_item[i]), np.int64) for i in ids], numbers)


def _counted(docs: DataFrame, queries: Queries) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term."""
    numbers = queries.numbers
    many = len(numbers)

    @F.arrow_udf("struct<n: long, terms: array<int>, tfs: array<int>>")
    def count(texts: pa.Array) -> pa.Array:
        n, cells, home = [], [], []
        for k, text in enumerate(texts.cast(pa.binary()).to_pylist()):
            words = terms(text)
            n.append(len(words))
            known = [numbers[w] for w in words if w in numbers]
            cells.append(np.array(known, dtype=np.int64))
            home.append(len(known))
        codes = np.concatenate([*cells, np.zeros(0, np.int64)]) + np.repeat(np.arange(len(n)), home) * many
        codes, tfs = np.unique(codes, return_counts=True)
        rows = np.bincount(codes // many, minlength=len(n))
        offsets = pa.array(np.concatenate([[0], np.cumsum(rows)]), pa.int32())
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(codes % many, pa.int32())),
             pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))], names=["n", "terms", "tfs"])

    return docs.select("doc_id", count("text").alias("c")).select("doc_id", "c.*").where("n > 0")


def _weights(counted: DataFrame, queries: Queries) -> tuple[int, int]:
    """Sets the terms' weights; returns (documents with terms, their terms)."""
    size = counted.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    holds = np.zeros(len(queries.numbers), dtype=np.int64)
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).toLocalIterator():
        holds[r["t"]] = r["df"]  # one row for a query term
    queries.weights = np.array([math.floor(1000 * math.log((2 * size["docs"] + 2) / (2 * int(df) + 1)))
                                for df in holds], dtype=np.int64)
    return size["docs"], size["terms"] or 0


def _vectors(counted: DataFrame, queries: Queries, n_docs: int, n_terms: int) -> DataFrame:
    """(doc_id, terms, impacts, length): a vector's length weighs each squared impact."""
    weights = queries.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, tfs = batch.column(2), batch.column(3)
            size = pc.list_value_length(lists).to_numpy()
            own, tf = lists.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64)
            n = batch.column(1).to_numpy().tolist()
            # whole numbers of any size, then 64 bits: m is some 50 at the mean length
            m = np.array([100 - 50 + (50 * k * n_docs) // n_terms for k in n], dtype=np.int64)
            impact = (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, size))
            home = np.repeat(np.arange(len(size)), size)
            length = np.sqrt(np.bincount(home, weights[own] * impact.astype(float) ** 2, len(size)))
            offsets = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(own, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(impact, pa.int32())), pa.array(length)],
                names=["doc_id", "terms", "impacts", "length"])

    doc = counted.schema["doc_id"].dataType.simpleString()
    return counted.where(F.size("terms") > 0).mapInArrow(
        run, f"doc_id {doc}, terms array<int>, impacts array<int>, length double")


class _Best:
    """The best documents of each query so far in a task, and the score to reach."""

    def __init__(self, queries: int, k: int, floors: np.ndarray):
        self.k, self.floors = k, floors.copy()
        self.ids: pa.Array = None  # doc_ids of the task's rows
        self.rows = [np.zeros(0, np.int64) for _ in range(queries)]
        self.scores = [np.zeros(0, np.int64) for _ in range(queries)]

    def add(self, q: int, rows: np.ndarray, scores: np.ndarray) -> None:
        rows, scores = np.concatenate([self.rows[q], rows]), np.concatenate([self.scores[q], scores])
        if len(scores) > self.k:
            least = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            keep = scores >= least
            rows, scores = rows[keep], scores[keep]
            if len(scores) > 4 * self.k:  # many ties: those of the smallest doc_ids
                order = pc.sort_indices(self.ids.take(pa.array(rows)), null_placement="at_end").to_numpy()
                order = np.sort(order[np.argsort(-scores[order], kind="stable")[:self.k]])
                rows, scores = rows[order], scores[order]
            self.floors[q] = max(self.floors[q], least)
        self.rows[q], self.scores[q] = rows, scores


def _search_bucket(q: int, own: np.ndarray, weights: np.ndarray, floor: int, bucket: dict) -> tuple[np.ndarray, np.ndarray]:
    """(rows, exact scores) of the bucket's vectors that may reach ``floor`` for query q."""
    length, first, row, impact = bucket["length"], bucket["first"], bucket["row"], bucket["impact"]
    query_length = math.sqrt(float(weights[own].sum()))
    slack = 1 + 1e-9  # doubles round; a bound may only be too high
    if query_length * length[0] * slack < floor:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)  # the longest is too short
    reach = int(np.searchsorted(-length, -floor / (query_length * slack), side="right")) if floor > 0 else len(length)
    order = own[np.argsort(-weights[own], kind="stable")]
    held = np.cumsum(weights[order]) / max(1, weights[order].sum())
    focus = 1 + int(np.searchsorted(held, FOCUS)) if floor > 0 else len(order)
    score = np.zeros(len(length), dtype=np.int64)
    spent = np.zeros(len(length))
    for t in order[:focus]:
        a, b = first[t], first[t + 1]
        at, x = row[a:b], impact[a:b]
        score[at] += weights[t] * x
        if focus < len(order):
            spent[at] += weights[t] * x.astype(float) ** 2
    rest = order[focus:]
    if len(rest):
        left = np.sqrt(np.maximum(length * length * slack - spent, 0))
        bound = (score + math.sqrt(float(weights[rest].sum())) * left) * slack + 1
        alive = np.flatnonzero(bound[:reach] >= floor)
        if not len(alive):
            return alive, alive
        for t in rest:
            a, b = first[t], first[t + 1]
            score[row[a:b]] += weights[t] * impact[a:b]
    else:
        alive = np.arange(reach)
    exact = score[alive]
    good = exact >= max(floor, 1)
    return alive[good], exact[good]


def _searched(vectors: DataFrame, queries: Queries, k: int, floors: np.ndarray) -> DataFrame:
    """(q, doc_id, score): each task's best of every query."""
    weights, own, many = queries.weights, queries.own, len(queries.numbers)

    def shard(parts: list[pa.RecordBatch], best: _Best, base: int) -> None:
        table = pa.Table.from_batches(parts).combine_chunks()
        lists = table.column("terms").combine_chunks()
        size = pc.list_value_length(lists).to_numpy()
        flat = lists.flatten().to_numpy()
        impacts = table.column("impacts").combine_chunks().flatten().to_numpy().astype(np.int64)
        length, start = table.column("length").to_numpy(), np.concatenate([[0], np.cumsum(size)])
        order = np.argsort(-length, kind="stable")
        done = np.zeros(len(own), dtype=bool)
        for a in range(0, len(order), BUCKET_ROWS):
            rows = order[a:a + BUCKET_ROWS]
            cells = np.concatenate([np.arange(start[r], start[r + 1]) for r in rows])
            local = np.repeat(np.arange(len(rows)), size[rows])
            by = np.argsort(flat[cells], kind="stable")
            bucket = {"length": length[rows], "row": local[by], "impact": impacts[cells][by],
                      "first": np.searchsorted(flat[cells][by], np.arange(many + 1))}
            for q in np.flatnonzero(~done):
                if math.sqrt(float(weights[own[q]].sum())) * length[rows[0]] * (1 + 1e-9) < max(best.floors[q], 1):
                    done[q] = True  # later buckets are shorter still
                    continue
                at, scores = _search_bucket(q, own[q], weights, int(best.floors[q]), bucket)
                if len(at):
                    best.add(q, base + rows[at], scores)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, parts, cells = _Best(len(own), k, floors), [], 0

        def search() -> None:
            nonlocal parts, cells
            held = [] if best.ids is None else [best.ids]
            best.ids = pa.concat_arrays(held + [p.column(0) for p in parts])
            shard(parts, best, len(held[0]) if held else 0)
            # only the ids of the best go on
            rows = np.unique(np.concatenate([*best.rows, np.zeros(0, np.int64)]))
            best.rows = [np.searchsorted(rows, r) for r in best.rows]
            best.ids = best.ids.take(pa.array(rows))
            parts, cells = [], 0

        for batch in batches:
            parts.append(batch)
            cells += len(batch.column(1).flatten())
            if cells >= SHARD_CELLS:
                search()
        if parts:
            search()
        for q, (rows, scores) in enumerate(zip(best.rows, best.scores)):
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), q), pa.int32()), best.ids.take(pa.array(rows)),
                     pa.array(scores)], names=["q", "doc_id", "score"])

    doc = vectors.schema["doc_id"].dataType.simpleString()
    return vectors.select("doc_id", "terms", "impacts", "length").mapInArrow(run, f"q int, doc_id {doc}, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query. Rows of one (query, document score, doc_id) are told apart
    by nothing, so any of them may be the last."""
    by = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 50, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``k`` best documents of each item: (item_id, rank, doc_id, score).

    Terms are runs of ASCII letters and digits and of all non-ASCII characters, A-Z
    lower-cased. Scores are the integer ones of ``op11_lexical_search``; documents of
    score 0 aren't returned, equal scores go by ascending doc_id, null last.

    Null or empty text has no terms. Items without terms, or whose terms no document
    holds, return nothing; rows that share an item_id (null too) are one item with all
    their terms, once each. Repeated documents are ranked each for itself. No documents
    or no items give no rows. Very long texts are vectors like others; other columns
    are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    item = items.schema["item_id"].dataType.simpleString()
    doc = docs.schema["doc_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {item}, rank int, doc_id {doc}, score long")
    for queries in _blocks(items, block_terms):
        counted = written(_counted(docs, queries), "counted")
        n_docs, n_terms = _weights(counted, queries)
        if not n_docs:
            continue
        vectors = written(_vectors(counted, queries, n_docs, n_terms), "vectors")
        level = F.floor(F.log2(F.col("length") + 1) * 8)
        cut, seen = None, 0
        for r in sorted(vectors.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), reverse=True):
            cut, seen = r["level"], seen + r["n"]  # some 300 levels at most
            if seen >= HEAD:
                break
        if cut is None:
            continue
        floors = np.zeros(len(queries.ids), dtype=np.int64)
        head = written(_top(_searched(vectors.where(level >= cut), queries, k, floors), k), "head")
        for r in head.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("least")).collect():
            if r["n"] >= k:  # k documents score as much; less can't be among the best
                floors[r["q"]] = r["least"]
        rest = _searched(vectors.where(level < cut), queries, k, floors)
        names = spark.createDataFrame(list(enumerate(queries.ids)), f"q int, item_id {item}")
        best = _top(head.drop("rank").union(rest), k).join(F.broadcast(names), "q")  # a block's items
        out = out.union(written(best.select(
            "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "ranked"))
    return out


def op11_lexical_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The 50 best documents of every item; odd input as in ``search``.

    With N documents that hold a term, L terms in them, n in one of them, a term in df of
    them and tf times in one: weight w = floor(1000 ln((2N + 2) / (2 df + 1))),
    m = 50 + 50 n N div L, score = sum of w * (10^9 tf div (1000 tf + 20 m))."""
    return search(docs, items)


ORACLE = r"""
WITH doc_terms AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL
), sized AS (
  SELECT *, len(w) AS n FROM doc_terms WHERE len(w) > 0
), whole AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sized
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark WHERE text IS NOT NULL
), counts AS (
  SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS t FROM sized)
  WHERE t IN (SELECT t FROM asked) GROUP BY ALL
), weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, whole GROUP BY t
), scores AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) //
         (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN counts USING (t) JOIN weights USING (t), whole GROUP BY item_id, r
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM scores WHERE score > 0) WHERE rank <= 50
"""
