"""Near-duplicate documents by circulant MinHash.

Two permutations give the whole signature: the first spreads the shingles over
the positions 0 .. 2^32 - 1, the second, shifted circularly by k positions,
orders them for coordinate k. Bands of four coordinates are buckets, and links
are confirmed by exact Jaccard similarity on the full shingle sets.

Copies with equal sets are one representative from the start. A bucket doesn't
emit its pairs: each member is compared with the bucket's hub, its smallest
doc_id, and links join components. Where a bucket still holds more than one
component, the members outside the hub's are compared with all others there. That
is done by the hub's component, in blocks of both sides, each a task of bounded
size that counts common shingles as a matrix product and returns links only. Any
pair that shares a bucket is so either compared or already in one component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innspark.llm.common import components, release_cache, trim_memory, written

WORDS = 4  # of a shingle
PERCENT = 80  # 100 * intersection >= PERCENT * union
BANDS, ROWS = 32, 4  # a pair at 0.8 shares no band with a probability of 5e-8
# A pair is read whole if at least this share of coordinates agrees; at a similarity
# of 0.8 fewer than 0.6 of 128 agree with a probability below 1e-7.
AGREE = 0.6
BATCH_BYTES = 1 << 19  # of texts that are cut together; the arrays over them take some fifty times that
BLOCK = 512  # documents on each side of a task that compares two blocks
BLOCK_SHINGLES = 1 << 20  # shingles of a block, in the mean over a component's blocks

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: list[np.ndarray] = []


def _base_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n of an odd base modulo 2^64, and of its inverse."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, BATCH_BYTES + 1)
        made = [np.concatenate([np.ones(1, _U), np.multiply.accumulate(
            np.full(size, b, dtype=_U))]) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
        if size > BATCH_BYTES + 1:  # for one long text only
            return made[0], made[1]
        _powers[:] = made
    return _powers[0], _powers[1]


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text.

    A-Z is lower-cased; words are what ASCII white space separates. Fewer than
    ``words`` words are one shingle; no word, no shingle.
    """
    out: list[np.ndarray] = []
    raw = [t.encode("utf-8", "surrogatepass").lower() if t else b"" for t in texts]
    at = 0
    while at < len(raw):
        upto, size = at, 0
        while upto < len(raw) and (upto == at or size + len(raw[upto]) < BATCH_BYTES):
            size += len(raw[upto]) + 1
            upto += 1
        out += _sets(raw[at:upto], words)
        at = upto
    return out


def _sets(raw: list[bytes], words: int) -> list[np.ndarray]:
    text = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    space = _SPACE[text]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    start, end = edge[0::2], edge[1::2]
    power, inverse = _base_powers(len(text))
    total = np.zeros(len(text) + 1, dtype=_U)
    np.cumsum(_BYTES[text] * power[:len(text)], out=total[1:])
    word = _mix((total[end] - total[start]) * inverse[start] + (end - start).astype(_U))
    ends = np.cumsum([len(r) + 1 for r in raw])
    cut = [0, *np.searchsorted(start, ends).tolist()]
    mark = [_U(x) for x in _mix(np.arange(1, words + 2, dtype=_U) * _U(_BASE)) | _U(1)]
    whole = np.zeros(max(0, len(word) - words + 1), dtype=_U)
    for k in range(words if len(whole) else 0):
        whole += word[k:k + len(whole)] * mark[k]
    whole = _mix(whole)
    out = []
    for a, b in zip(cut, cut[1:]):
        if b - a >= words:
            out.append(np.unique(whole[a:b - words + 1]))
        elif b > a:
            few = _U(b - a) * mark[words]
            for k in range(b - a):
                few = few + word[a + k] * mark[k]
            out.append(_mix(np.array([few])))
        else:
            out.append(np.zeros(0, dtype=_U))
    return out


def signature(shingles: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least pi(sigma(v) + k mod 2^32)."""
    sigma = (_mix(shingles ^ _U(0x5851F42D4C957F2D)) >> _U(32)).astype(np.uint32)
    shift = np.arange(size, dtype=np.uint32)[:, None]
    out = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    for a in range(0, len(sigma), 256):
        x = sigma[None, a:a + 256] + shift
        y = np.empty_like(x)
        for by, times in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, None)):
            np.right_shift(x, by, out=y)
            np.bitwise_xor(x, y, out=x)
            if times:
                np.multiply(x, np.uint32(times), out=x)
        np.minimum(out, x.min(axis=1), out=out)
    return out


def _describe(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_cache()
        band = _mix(np.arange(1, BANDS + 1, dtype=_U))
        with np.errstate(over="ignore"):
            for batch in batches:
                sets = shingle_sets(batch["text"].tolist(), words)
                prints, keys, coords = [], [], []
                for s in sets:
                    # a sum over the set doesn't depend on its order
                    prints.append((int(s.sum(dtype=_U)) - (1 << 63),
                                   int(_mix(s + _U(_BASE)).sum(dtype=_U)) - (1 << 63)))
                    sig = signature(s)
                    rows = sig.reshape(BANDS, ROWS).astype(_U)
                    key = band.copy()
                    for r in range(ROWS):
                        key = _mix(key ^ rows[:, r]) + _U(_BASE)
                    keys.append(key.view(np.int64))
                    coords.append(sig.astype(np.uint8).tobytes())
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"], "n": [len(s) for s in sets],
                    "f1": [p[0] for p in prints], "f2": [p[1] for p in prints],
                    "bands": keys, "coords": coords})
        trim_memory()

    return run


def _alike(a: pd.Series, b: pd.Series) -> pd.Series:
    left = np.frombuffer(b"".join(map(bytes, a)), np.uint8).reshape(len(a), -1)
    right = np.frombuffer(b"".join(map(bytes, b)), np.uint8).reshape(len(b), -1)
    return pd.Series((left == right).mean(axis=1))


def _confirm(words: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with np.errstate(over="ignore"):
            for batch in batches:
                texts = list(dict.fromkeys([*batch["text_a"], *batch["text_b"]]))
                sets = dict(zip(texts, shingle_sets(texts, words)))
                keep = []
                for a, b in zip(batch["text_a"], batch["text_b"]):
                    x, y = sets[a], sets[b]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                yield batch.loc[keep, ["a", "b"]]
        trim_memory()

    return run


def _common(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all ``xs`` with all ``ys``."""
    out = np.zeros((len(xs), len(ys)), dtype=np.float32)
    x, y = np.concatenate(xs), np.concatenate(ys)
    shared = np.intersect1d(x, y)

    def cells(flat: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(shared, flat)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        hit = at < len(shared)
        hit[hit] = shared[at[hit]] == flat[hit]
        order = np.argsort(at[hit], kind="stable")
        return row[hit][order], at[hit][order]

    (x_row, x_at), (y_row, y_at) = cells(x, xs), cells(y, ys)
    for low in range(0, len(shared), 2048):
        sides = []
        for row, at, n in ((x_row, x_at, len(xs)), (y_row, y_at, len(ys))):
            a, b = np.searchsorted(at, (low, low + 2048))
            side = np.zeros((n, 2048), dtype=np.float32)
            side[row[a:b], at[a:b] - low] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def _across(words: int, percent: int):
    """Links of one block of outer members with one of all members, as edges to
    the others' components."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows["outer"]], rows[~rows["outer"]]
        none = pd.DataFrame({"a": [], "b": []}).astype("int64")
        if left.empty or right.empty:
            return none
        with np.errstate(over="ignore"):
            xs, ys = (shingle_sets(part["text"].tolist(), words) for part in (left, right))
        both = _common(xs, ys).astype(np.int64)
        total = np.array([len(s) for s in xs])[:, None] + np.array([len(s) for s in ys]) - both
        near = (both > 0) & (100 * both >= percent * total)
        near &= left["c"].to_numpy()[:, None] != right["c"].to_numpy()
        a, b = np.nonzero(near)
        return pd.DataFrame({"a": left["rep"].to_numpy()[a], "b": right["c"].to_numpy()[b]}
                            ).drop_duplicates() if len(a) else none

    return run


def _hub_links(pairs: DataFrame, reps: DataFrame, texts: DataFrame, words: int, percent: int
               ) -> DataFrame:
    """The ``pairs`` (a, b) of representatives that are similar enough, as a table."""
    side = lambda x: reps.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"),
                                 F.col("coords").alias(f"coords_{x}"))
    alike = F.pandas_udf(_alike, "double")
    near = (pairs.join(side("a"), "a").join(side("b"), "b")
            .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
            .where(alike("coords_a", "coords_b") >= AGREE).select("a", "b"))
    both = (near.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a"))
    return written(both.select("a", "b", "text_a", "text_b").mapInPandas(
        _confirm(words, percent), "a long, b long"), "links")


def _split_links(left: DataFrame, texts: DataFrame, words: int, percent: int, block: int
                 ) -> DataFrame:
    """Edges that join components of buckets with several: ``left`` (rep, n, c, hc) has
    their members with their own component and that of the bucket's hub. Blocks are
    cut by members and by shingles: long texts share a task with few others."""
    rows = left.withColumn("outer", F.col("c") != F.col("hc")).distinct()

    def blocks(which: Column) -> Column:
        members, shingles = F.sum(which.cast("int")), F.sum(F.when(which, F.col("n")).otherwise(0))
        return F.greatest(F.ceil(members / block), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")

    sizes = rows.groupBy("hc").agg(blocks(F.col("outer")).alias("nx"), blocks(F.lit(True)).alias("ny"))
    own = F.xxhash64("rep")
    # each member is on the right side; the outer ones also on the left
    sides = F.when(F.col("outer"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))
    placed = (rows.join(sizes, "hc").withColumn("outer", F.explode(sides))
              .withColumn("i", F.when(F.col("outer"), F.pmod(own, "nx")).cast("int"))
              .withColumn("j", F.when(~F.col("outer"), F.pmod(own, "ny")).cast("int"))
              .withColumn("other", F.explode(F.when(F.col("outer"), F.sequence(F.lit(0), F.col("ny") - 1))
                                             .otherwise(F.sequence(F.lit(0), F.col("nx") - 1))))
              .select("hc", F.coalesce("i", "other").alias("i"), F.coalesce("j", "other").alias("j"),
                      "rep", "c", "outer"))
    return written(placed.join(texts, "rep").groupBy("hc", "i", "j").applyInPandas(
        _across(words, percent), "a long, b long"), "links")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                    block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id that links lead to, the document
    itself included. Null, empty and blank texts have no shingles and are linked
    with nothing. A row without doc_id is linked with nothing and has no
    component. Rows that repeat a doc_id are judged each by its text. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = written(docs.mapInPandas(
        _describe(words), "doc_id long, n long, f1 long, f2 long, bands array<long>, coords binary"),
        "described")
    alone = F.col("doc_id").isNull() | (F.col("n") == 0)
    reps = written(described.where(~alone).groupBy("f1", "f2", "n").agg(
        F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands"),
        F.min_by("coords", "doc_id").alias("coords")), "representatives")
    posted = reps.select("rep", "n", F.explode("bands").alias("key"))
    hubs = posted.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("size")).where(
        "size > 1").drop("size")
    members = written(posted.join(hubs, "key"), "buckets")
    # the ids grow with the input: they are joined by a shuffle, never broadcast
    ids = members.select("rep").distinct().hint("merge")
    texts = written(docs.select(F.col("doc_id").alias("rep"), "text").join(ids, "rep", "left_semi"),
                    "texts")
    pairs = members.where("rep != hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    links = _hub_links(pairs, reps, texts, words, percent)
    found = written(components(spark, links), "components")
    own = lambda x, c: F.coalesce(F.col(c), F.col(x))
    placed = written(
        members.join(found.select(F.col("node").alias("rep"), F.col("component").alias("c")), "rep", "left")
        .join(found.select(F.col("node").alias("hub"), F.col("component").alias("hc")), "hub", "left")
        .select("key", "rep", "n", own("rep", "c").alias("c"), own("hub", "hc").alias("hc")), "placed")
    split = placed.where("c != hc").select("key").distinct()
    left = placed.join(split, "key", "left_semi").select("rep", "n", "c", "hc")
    more = _split_links(left, texts, words, percent, block)
    # the components found so far stand for their links
    found = components(spark, found.toDF("a", "b").union(more))
    by_set = reps.select("f1", "f2", "n", "rep")
    return (described.select("doc_id", "n", "f1", "f2").join(by_set, ["f1", "f2", "n"], "left")
            .join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNull() | (F.col("n") == 0), F.col("doc_id"))
                    .otherwise(F.coalesce("component", "rep")).alias("component_id")))


def op3_near_duplicates(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
