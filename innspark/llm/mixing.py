"""Mixing sources to target weights by the cube method.

Every document of a source has the same expected number of copies: the source's
target over its size. The whole part is taken outright; the fraction is the
inclusion probability of a balanced sample. The cube method moves the vector of
probabilities through the null space of the constraints (token total and
document total of the source) until its entries are 0 or 1.

The flight runs in blocks of bounded size that Spark forms by a hash within each
source. A block keeps its token and document totals exactly and leaves at most
two documents undecided, one for each constraint; the undecided ones of many
blocks form the blocks of the next round. When a source fits in one block, its
last two documents and twelve that didn't fly are the landing problem: of their
roundings, the one nearest to the totals.
"""

from __future__ import annotations

import hashlib
import random
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from innspark.functions.exprs import numbered_rows
from innspark.llm.common import fresh, join_hubs, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)  # by code point order of the sources, repeating
SHARE = 1.5  # of all sizes
MOST = 2.0  # copies of a source
BLOCK = 4096  # documents of a block
RUN = 10_000  # equal rows that a task numbers
LAND = 12  # documents of a source that land together with the last undecided two
EPS = 1e-9


def targets(by_source: DataFrame | dict, weights: tuple = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame | dict:
    """``by_source`` (source, size long, one row a source) with the column target, as a
    table: the source's weight's part of ``share`` of all sizes, at most ``most`` times
    its size; what is above goes to the others by weight. Weights go by code point
    order, the null source last. A dict of a few sources' sizes gives one of targets.

    Sources are ranked by a distributed sort. The level per unit of weight rises until
    no further source is above its bound; a round needs the sums of both kinds only."""
    if isinstance(by_source, dict):
        rows = SparkSession.active().createDataFrame(list(by_source.items()), "source string, size long")
        return {r["source"]: r["target"] for r in targets(rows, weights, share, most).collect()}
    ranked = numbered_rows(by_source.withColumn("name", _name()), [], "name", "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    table = written(ranked.withColumn("weight", weight).drop("place", "name"), "sources")
    level, bounded, known = 0.0, F.lit(False), -1
    while True:
        now = table.agg(F.sum("size").alias("size"), F.count_if(bounded).alias("n"),
                        F.sum(F.when(bounded, F.col("size"))).alias("bounded"),
                        F.sum(F.when(~bounded, F.col("weight"))).alias("weight")).first()
        if now["n"] == known or not now["weight"]:
            break
        known = now["n"]
        left = share * now["size"] - most * (now["bounded"] or 0)
        level = max(level, left / now["weight"])
        bounded = F.lit(level) * F.col("weight") > most * F.col("size")
    return table.withColumn("target", F.when(bounded, most * F.col("size")).otherwise(
        F.lit(level) * F.col("weight"))).drop("weight")


def flight(p: list[float], size: list[float], rng: random.Random, land: bool) -> list[float]:
    """Move probabilities ``p`` until at most two are fractions, keeping sum(p) and
    sum(p * size). With ``land``, the last documents don't fly: they and the two
    get the rounding that is nearest to the token total, then to the count."""
    p, held = list(p), []
    for k in range(len(p) - land * min(LAND, len(p))):
        if not EPS < p[k] < 1 - EPS:
            p[k] = float(round(p[k]))
            continue
        held.append(k)
        while len(held) == 3:
            # the direction that leaves both totals: orthogonal to (1, 1, 1) and the sizes
            a, b, c = held
            u = (size[c] - size[b], size[a] - size[c], size[b] - size[a])
            if not any(u):
                u = (1.0, -1.0, 0.0)
            up = min((1 - p[i]) / x if x > 0 else p[i] / -x for i, x in zip(held, u) if x)
            down = min(p[i] / x if x > 0 else (1 - p[i]) / -x for i, x in zip(held, u) if x)
            step = up if rng.random() * (up + down) < down else -down
            for i, x in zip(held, u):
                p[i] += step * x
                if not EPS < p[i] < 1 - EPS:
                    p[i] = float(round(p[i]))
            held = [i for i in held if 0 < p[i] < 1]
    if land:
        held += range(len(p) - min(LAND, len(p)), len(p))
        own, prob = np.array([size[i] for i in held]), np.array([p[i] for i in held])
        options = np.arange(1 << len(held))[:, None] >> np.arange(len(held)) & 1
        tokens, count = np.abs(options @ own - prob @ own), np.abs(options.sum(axis=1) - prob.sum())
        best = options[np.lexsort((count.round(6), tokens.round(6)))[0]]
        for i, x in zip(held, best):
            p[i] = float(x)
    return p


def _fly(seed: int, turn: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["h", "doc_id", "size"], na_position="first", kind="stable")
        first = block.iloc[0]
        text = f"{seed}|{turn}|{first['source']}|{first['block']}"
        rng = random.Random(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest())
        block["p"] = flight(block["p"].tolist(), block["size"].astype(float).tolist(), rng,
                            bool(first["blocks"] == 1))
        return block

    return run


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST,
        block: int = BLOCK, seed: int = 1) -> DataFrame:
    """(doc_id, row, size, source_size, target, copies, taken) for every row of ``docs``
    (doc_id, text, source): how often the mix takes the document. ``row`` is a hash
    of doc_id and text.

    ``size`` counts the words of the text (null: 0). The null source is a source
    of its own, the last in order. A source without words has target 0. Rows that
    repeat a doc_id are documents of their own; equal rows are told apart by number, so
    any number of them spreads over the blocks. Other columns are ignored. The same
    input gives the same mix: blocks, their order and their random numbers come
    from hashes.
    """
    counted = docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        _row().alias("row"))
    sized = written(_numbered(counted).withColumn(
        "h", F.when(F.col("nth") == 0, F.xxhash64("row", F.lit(seed)))
        .otherwise(F.xxhash64("row", F.lit(seed), "nth"))).drop("nth"), "sizes")
    by_source = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    rate = F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0.0)
    table = written(targets(by_source, weights, share, most).select(
        _name().alias("name"), "n", F.col("size").alias("source_size"), "target", rate.alias("rate"),
        F.ceil(F.col("n") / block).alias("blocks")), "targets")
    totals = table.agg(F.sum("n").alias("n"), F.max("blocks").alias("blocks")).first()
    state = (join_hubs(sized.withColumn("name", _name()), table, "name", "n", totals["n"] or 0, "h")
             .drop("name").withColumn("whole", F.floor("rate").cast("int"))
             .withColumn("p", F.col("rate") - F.col("whole")).drop("rate")
             .withColumn("block", F.lit(0).cast("long")))
    done, turn = [], 0
    fraction = (F.col("p") > EPS) & (F.col("p") < 1 - EPS)
    done.append(state.where(~fraction).withColumn("p", F.round("p")))
    state = state.where(fraction)
    most_blocks = totals["blocks"] or 0
    while most_blocks:
        cut = state.withColumn("block", F.pmod(F.xxhash64("h", F.lit(turn)), F.col("blocks")))
        flown = written(cut.groupBy("source", "block").applyInPandas(_fly(seed, turn), cut.schema),
                        "flight")
        done.append(flown.where(~fraction))
        if most_blocks == 1:
            break
        # each block leaves two documents at most
        state = flown.where(fraction & (F.col("blocks") > 1)).withColumn(
            "blocks", F.ceil(2 * F.col("blocks") / block))
        most_blocks, turn = -(-2 * most_blocks // block), turn + 1
    out = reduce(DataFrame.unionByName, [d.select(*state.columns) for d in done])
    copies = F.col("whole") + F.col("p").cast("int")
    return out.select("doc_id", "row", "size", "source_size", "target",
                      copies.cast("long").alias("copies"),
                      (F.col("size") * copies).cast("long").alias("taken"))


def _row() -> Column:
    return F.xxhash64("doc_id", "text")


def _name() -> Column:
    """The source as a join key that isn't null."""
    return F.when(F.col("source").isNull(), "b").otherwise(F.concat(F.lit("a"), F.col("source")))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with nth, which counts equal rows from 0. They are counted first, and
    a task gives RUN of them at most."""
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("same"))
    few = counted.where(F.col("same") <= RUN).select(
        *rows.columns, F.explode(F.expr("sequence(0, same - 1)")).alias("nth"))
    runs = (counted.where(F.col("same") > RUN)
            .withColumn("run", F.explode(F.expr(f"sequence(0, (same - 1) div {RUN})")))
            .repartition(*rows.columns, "run"))
    many = runs.select(*rows.columns, F.explode(F.expr(
        f"sequence(run * {RUN}, least(same, (run + 1) * {RUN}) - 1)")).alias("nth"))
    return few.union(many)


def take(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as ``mixed`` (from ``mix``) takes it. Rows
    that repeat a doc_id and text take their numbers in any order; no row of ``mixed``,
    no copy. All columns stay, whatever their names."""
    doc, row, copies, nth, copy = (fresh(docs, c) for c in ("doc", "row", "copies", "nth", "copy"))
    lists = (mixed.where("copies > 0")
             .select(F.col("doc_id").alias(doc), F.col("row").alias(row), F.col("copies").alias("x"))
             .groupBy(doc, row).agg(F.sort_array(F.collect_list("x"), False).alias(copies)))
    same = Window.partitionBy(doc, row).orderBy(row)  # rows that repeat a document
    return (docs.join(lists, F.col("doc_id").eqNullSafe(F.col(doc)) & (_row() == F.col(row)))
            .withColumn(nth, F.get(copies, F.row_number().over(same) - 1)).where(F.col(nth) > 0)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(nth).cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op2_mixing(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
