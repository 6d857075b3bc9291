"""Near-duplicate embeddings by a pivot-permutation index.

Reference points (pivots) are drawn from the vectors. A vector is described by
its nearest pivots in order; the first few put it on as many inverted lists, one
for each label and pivot. Vectors on one list that share enough pivots are
candidates, and their cosine is computed in double precision.

Equal vectors are one representative with a count from the start. Lists are cut
into blocks by a hash, and each pair of blocks is one task that computes counts
and cosines as matrix products: no pair is emitted, only each vector's number of
links and one edge to the smallest linked id, so a list of any length is
processed whole in tasks of bounded size. A pair on several lists counts on that
of its first shared pivot only.

The number of pivots grows with the square root of the number of vectors, which
keeps the length of a list, too, near the square root.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innspark.llm.common import components, written

COSINE = 0.98
NEAREST = 8  # pivots that describe a vector; it is on the lists of all of them
SHARED = 2  # pivots that candidates share at least
PIVOTS = (64, 8192)  # fewest and most
BLOCK = 1024  # vectors of a block


def _vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Unit vectors in double precision; null where the vector can't be linked."""
    for batch in batches:
        units = []
        for v in batch["embedding"]:
            unit = None
            if v is not None and len(v):
                x = np.array([np.nan if e is None else e for e in v], dtype=np.float64)
                if np.isfinite(x).all() and x.any():
                    # a power of two takes the largest component near one, exactly:
                    # squares of any finite vector neither over- nor underflow
                    x = np.ldexp(x, -int(np.frexp(np.abs(x).max())[1]))
                    unit = (x / np.sqrt((x * x).sum())).tobytes()
            units.append(unit)
        yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "unit": units})


def _matrix(units: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, units)), np.float64).reshape(len(units), -1)


def _order(pivots: dict[int, tuple[np.ndarray, np.ndarray]], nearest: int):
    """The nearest pivots of each vector, by dimension."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby("dim"):
                ids, points = pivots[size]
                x = _matrix(part["unit"])
                k = min(nearest, len(ids))
                near = np.argsort(-(x @ points.T), axis=1, kind="stable")[:, :k]
                yield pd.DataFrame({"rep": part["rep"], "nearest": list(ids[near].astype(np.int32))})

    return run


def _compare(cosine: float, shared: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        _, _, pivot, i, j = key
        left, right = group[group["block"] == i], group[group["block"] == j]
        none = pd.DataFrame({"rep": [], "links": [], "low": []}).astype("int64")
        if left.empty or right.empty:
            return none
        names, place = np.unique(np.concatenate([*left["nearest"], *right["nearest"]]),
                                 return_inverse=True)

        def uses(part: pd.DataFrame, at: np.ndarray) -> np.ndarray:
            out = np.zeros((len(part), len(names)), dtype=np.float32)
            out[np.repeat(np.arange(len(part)), [len(x) for x in part["nearest"]]), at] = 1
            return out

        n_left = sum(map(len, left["nearest"]))
        a, b = uses(left, place[:n_left]), uses(right, place[n_left:])
        earlier = names < pivot  # such a shared pivot's list has the pair
        least = min(shared, *(len(x) for x in group["nearest"]))
        near = (a @ b.T >= least) & (a[:, earlier] @ b[:, earlier].T == 0)
        x, y = _matrix(left["unit"]), _matrix(right["unit"])
        near &= x @ y.T >= cosine
        rep_a, rep_b = left["rep"].to_numpy(), right["rep"].to_numpy()
        near &= rep_a[:, None] != rep_b[None, :]
        if not near.any():
            return none
        links_a = near @ right["copies"].to_numpy()
        low_a = np.where(near, rep_b[None, :], np.iinfo(np.int64).max).min(axis=1)
        out = [pd.DataFrame({"rep": rep_a, "links": links_a, "low": low_a})]
        if i != j:
            out.append(pd.DataFrame({
                "rep": rep_b, "links": left["copies"].to_numpy() @ near,
                "low": np.where(near, rep_a[:, None], np.iinfo(np.int64).max).min(axis=0)}))
        # one edge for each vector can leave a component in pieces: join them here
        every = np.concatenate([rep_a, rep_b] if i != j else [rep_a])
        full = near if i == j else np.block([
            [np.zeros((len(x), len(x)), bool), near], [near.T, np.zeros((len(y), len(y)), bool)]])
        label = every.copy()
        while True:
            low = np.minimum(label, np.where(full, label[None, :], np.iinfo(np.int64).max).min(axis=1))
            if (low == label).all():
                break
            label = low
        out = pd.concat(out, ignore_index=True)
        out["low"] = label
        return out[out["links"] > 0].astype("int64")

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, nearest: int = NEAREST,
                 shared: int = SHARED, pivots: int | None = None, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id) for every row of ``vectors`` (vec_id, embedding, label).

    Vectors with equal labels are linked at a cosine of ``cosine`` or more.
    ``n_links`` counts the other rows linked directly; ``component_id`` is the
    smallest vec_id that links lead to, the vector itself included. Rows whose
    vec_id, label or embedding is null, and vectors that are empty, zero or hold
    a null or non-finite component, are linked with nothing; neither are vectors
    of different lengths. Repeated rows are vectors of their own. Other columns
    are ignored. The pivots are a bounded sample; every vector is indexed.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["label"].dataType.simpleString()
    rows = written(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
                   .mapInPandas(_vectors, f"vec_id long, label {kind}, unit binary")
                   .withColumn("print", F.md5("unit")), "vectors")
    linkable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("unit").isNotNull()
    reps = written(rows.where(linkable).groupBy("label", "print").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("unit").alias("unit"))
        .withColumn("dim", (F.length("unit") / 8).cast("int")), "representatives")
    sizes = {r["dim"]: r["count"] for r in reps.groupBy("dim").count().collect()}
    chosen = {}
    for dim, n in sizes.items():
        many = pivots or int(np.clip(np.sqrt(n), *PIVOTS))
        sample = reps.where(F.col("dim") == dim).orderBy(F.xxhash64("rep"), "rep").limit(many).select("unit")
        points = _matrix(sample.toPandas()["unit"])  # PIVOTS[1] vectors at most
        chosen[dim] = (np.arange(len(points)), points)
    ordered = written(reps.select("rep", "dim", "unit").mapInPandas(
        _order(chosen, nearest), "rep long, nearest array<int>"), "nearest")
    posted = (reps.join(ordered, "rep").withColumn("pivot", F.explode("nearest")))
    lists = posted.groupBy("label", "dim", "pivot").agg(
        F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = (posted.join(lists, ["label", "dim", "pivot"])
              .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int")))
    tasks = F.expr("concat(transform(sequence(0, block), x -> struct(x as i, block as j)), "
                   "if(block + 1 < blocks, transform(sequence(block + 1, blocks - 1), "
                   "x -> struct(block as i, x as j)), array()))")
    met = (placed.withColumn("t", F.explode(tasks))
           .select("label", "dim", "pivot", "t.i", "t.j", "block", "rep", "copies", "unit", "nearest")
           .groupBy("label", "dim", "pivot", "i", "j")
           .applyInPandas(_compare(cosine, shared), "rep long, links long, low long"))
    met = written(met, "links")
    counts = met.groupBy("rep").agg(F.sum("links").alias("links"))
    found = components(spark, met.select(F.col("rep").alias("a"), F.col("low").alias("b")))
    by_print = (reps.select("label", "print", "rep", "copies").join(counts, "rep", "left")
                .join(found.withColumnRenamed("node", "rep"), "rep", "left")
                .select("label", "print",
                        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
                        F.coalesce("component", "rep").alias("component")))
    joined = rows.join(by_print, ["label", "print"], "left")
    return joined.select(
        "vec_id", F.when(linkable, F.col("links")).otherwise(0).cast("long").alias("n_links"),
        F.when(linkable, F.col("component")).otherwise(F.col("vec_id")).alias("component_id"))


def op9_embeddings(vectors: DataFrame) -> DataFrame:
    return near_vectors(vectors).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
