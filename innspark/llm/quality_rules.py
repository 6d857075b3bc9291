"""Quality rules: gradient-boosted trees over document statistics.

Every text becomes a row of statistics (counts over words, lines, symbols and
repeated windows), computed batch by batch on the Arrow buffers. Trees boosted on a
bounded sample of labelled rows turn the statistics into a probability that the text
is good; some features are constrained so that more of them never helps. The trees
are flattened into numpy node arrays, through which all rows of a batch descend
together, one level of all trees a step.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 8
PART_BYTES = 4 << 20  # texts that are looked at together; a longer one is alone
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words in repeated windows

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "word_length", "symbols_per_word", "dup_line_share", "repeat_word_share",
            "upper_share", "digit_share", "marks_per_word", "words_per_line", "distinct_share",
            "wide_share", "ended_line_share", "blank_word_share", "shouts_per_word")
#: -1: the probability of a good text never rises with the feature
MONOTONE = {"symbols_per_word": -1, "dup_line_share": -1, "repeat_word_share": -1,
            "blank_word_share": -1}

WHITE, SYMBOL, UPPER, LOWER, DIGIT, MARK, TAIL, WIDE = (1 << k for k in range(8))
KIND = np.zeros(256, dtype=np.uint8)
for _chars, _kind in ((b" \t\n\x0b\x0c\r", WHITE), (b"#*$%&|<>", SYMBOL), (bytes(range(65, 91)), UPPER),
                      (bytes(range(97, 123)), LOWER), (bytes(range(48, 58)), DIGIT),
                      (b"!\"'()+,-./:;=?@[\\]^_`{}~", MARK), (bytes(range(128, 192)), TAIL),
                      (bytes(range(192, 256)), WIDE)):
    KIND[list(_chars)] = _kind


def _ids(values: np.ndarray) -> np.ndarray:
    return pd.factorize(values)[0].astype(np.int64)


def _repeated(words: list[bytes], home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(for each word: is it in a window that its text holds twice; word ids).

    Windows get their ids by joining neighbours, 1, 2, 4 and 8 words wide, so equal
    ids mean equal words."""
    ids = _ids(np.array(words, dtype=object))
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    if len(words) >= WINDOW:
        wide, step = ids, 1
        while step < WINDOW:
            pairs = wide[:-step] * (wide.max() + 1) + wide[step:]
            wide, step = _ids(pairs), 2 * step
        at = np.flatnonzero(home[:len(wide)] == home[WINDOW - 1:])
        keys = _ids(wide[at] * (home[-1] + 1) + home[at])
        twice = at[np.bincount(keys)[keys] > 1] if len(at) else at
        covered[twice] += 1
        np.subtract.at(covered, twice + WINDOW, 1)
    return np.cumsum(covered)[:-1] > 0, ids


def _part(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    n = len(texts)
    blob = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum([0, *map(len, texts)])
    kinds = KIND[blob]

    def count(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(mask), ends))

    white, wide = count(kinds == WHITE), count(kinds == WIDE)
    chars = np.diff(ends) - count(kinds == TAIL)
    symbols, digits = count(kinds == SYMBOL), count(kinds == DIGIT)
    upper, lower = count(kinds == UPPER), count(kinds == LOWER)
    marks, shouts = count(kinds == MARK), count(blob == ord("!"))
    words: list[bytes] = []
    sizes, lines, dup, ended = (np.zeros(n, dtype=np.int64) for _ in range(4))
    for k, text in enumerate(texts):
        own = text.split()  # at the six ASCII white spaces
        words += own
        sizes[k] = len(own)
        rows = text.split(b"\n")
        seen = Counter(rows)
        lines[k] = len(rows)
        if len(seen) < len(rows):
            dup[k] = sum(c - 1 for row, c in seen.items() if c > 1 and row.strip())
        ended[k] = sum(row.rstrip()[-1:] in (b".", b"!", b"?") for row in rows)
    home = np.repeat(np.arange(n), sizes)
    repeated, distinct, plain = (np.zeros(n, dtype=np.int64) for _ in range(3))
    if words:
        again, ids = _repeated(words, home)
        repeated = np.bincount(home, again, n).astype(np.int64)
        distinct = np.bincount(np.unique(home * (ids.max() + 1) + ids) // (ids.max() + 1), minlength=n)
        # words without a letter or digit: those whose bytes all are symbols and marks
        letter = np.concatenate([[0], np.cumsum(kinds & (UPPER | LOWER | DIGIT | TAIL | WIDE) != 0)])
        starts = np.flatnonzero((kinds != WHITE) & _fresh(kinds, ends))
        stops = starts + np.array([len(w) for w in words])
        plain = np.bincount(home, letter[stops] == letter[starts], n).astype(np.int64)
    counts = np.stack([sizes, chars - white, symbols, dup, repeated], axis=1).astype(np.int64)
    per_word, per_char = 1 / np.maximum(sizes, 1), 1 / np.maximum(chars, 1)
    features = np.stack([
        np.log1p(sizes), (chars - white) * per_word, symbols * per_word, dup / np.maximum(lines, 1),
        repeated * per_word, upper / np.maximum(upper + lower, 1), digits * per_char,
        marks * per_word, sizes / np.maximum(lines, 1), distinct * per_word, wide * per_char,
        ended / np.maximum(lines, 1), plain * per_word, shouts * per_word], axis=1)
    return counts, features


def _fresh(kinds: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places after white space or at the start of a text."""
    out = np.ones(len(kinds), dtype=bool)
    out[1:] = kinds[:-1] == WHITE
    out[ends[:-1][ends[:-1] < len(kinds)]] = True
    return out


def statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows x COUNTS, rows x FEATURES); null counts as empty."""
    raw = pc.fill_null(texts, "").cast(pa.large_binary()).to_pylist()
    counts, features, part, size = [], [], [], 0
    for k, text in enumerate(raw):
        part.append(text)
        size += len(text)
        if size >= PART_BYTES or k == len(raw) - 1:
            c, f = _part(part)
            counts.append(c)
            features.append(f)
            part, size = [], 0
    if not counts:
        return np.zeros((0, len(COUNTS)), np.int64), np.zeros((0, len(FEATURES)))
    return np.concatenate(counts), np.concatenate(features)


@dataclass
class Trees:
    """Complete binary trees of one depth as arrays (tree, node); node k's children
    are 2k + 1 and 2k + 2, and a row goes right where its feature exceeds the limit."""

    depth: int
    base: float
    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray  # (tree, leaf)

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if len(self.feature):
            trees = np.arange(len(self.feature))[None, :]
            node = np.zeros((len(x), len(self.feature)), dtype=np.int64)
            rows = np.arange(len(x))[:, None]
            for _ in range(self.depth):
                right = x[rows, self.feature[trees, node]] > self.limit[trees, node]
                node = 2 * node + 1 + right
            total = total + self.value[trees, node - (2 ** self.depth - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def boost(x: np.ndarray, y: np.ndarray, monotone: dict[int, int], trees: int = 60, depth: int = 3,
          rate: float = 0.2, bins: int = 64, ridge: float = 1.0) -> Trees:
    """Gradient boosting of the logistic loss on histograms of at most ``bins`` values.

    A split on a constrained feature must order its sides' values as demanded, and
    the middle of the two bounds all values below either side, so that the sum of the
    trees is monotone in the feature.
    """
    limits = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    place = np.stack([np.searchsorted(limits[f], x[:, f]) for f in range(x.shape[1])], axis=1)
    width = x.shape[1] * bins
    flat = place + np.arange(x.shape[1]) * bins
    rate_of = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(rate_of / (1 - rate_of)))
    score = np.full(len(x), base)
    inner, leaves = 2 ** depth - 1, 2 ** depth
    out = Trees(depth, base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf),
                np.zeros((trees, leaves)))

    def best_value(g: np.ndarray, h: np.ndarray, low: float, high: float) -> np.ndarray:
        return np.clip(-g / (h + ridge), low, high)

    def cost(g: np.ndarray, h: np.ndarray, v: np.ndarray) -> np.ndarray:
        return g * v + 0.5 * (h + ridge) * v * v

    sign = np.array([monotone.get(f, 0) for f in range(x.shape[1])])[:, None]
    real = np.array([[b < len(limits[f]) for b in range(bins)] for f in range(x.shape[1])])
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, p * (1 - p)
        members = {0: np.arange(len(x))}
        bounds = {0: (-np.inf, np.inf)}
        for node in range(inner):
            own, (low, high) = members.pop(node), bounds.pop(node)
            cells = flat[own].ravel()
            g = np.bincount(cells, np.repeat(grad[own], x.shape[1]), width).reshape(-1, bins).cumsum(axis=1)
            h = np.bincount(cells, np.repeat(hess[own], x.shape[1]), width).reshape(-1, bins).cumsum(axis=1)
            all_g, all_h = g[:, -1:], h[:, -1:]
            left, right = best_value(g, h, low, high), best_value(all_g - g, all_h - h, low, high)
            gain = cost(all_g, all_h, best_value(all_g, all_h, low, high)) - (
                cost(g, h, left) + cost(all_g - g, all_h - h, right))
            fits = real & (h > 1) & (all_h - h > 1) & (sign * (right - left) >= 0)
            gain = np.where(fits, gain, -np.inf)
            f, b = divmod(int(np.argmax(gain)), bins)
            goes = np.zeros(len(own), dtype=bool)
            sides = [(low, high), (low, high)]
            if gain[f, b] > 1e-9:
                out.feature[t, node], out.limit[t, node] = f, limits[f][b]
                goes = place[own, f] > b
                if sign[f, 0]:
                    middle = (left[f, b] + right[f, b]) / 2
                    below, above = (low, middle), (middle, high)
                    sides = [below, above] if sign[f, 0] > 0 else [above, below]
            for k, side in enumerate((own[~goes], own[goes])):
                members[2 * node + 1 + k], bounds[2 * node + 1 + k] = side, sides[k]
        for node, own in members.items():
            v = rate * float(best_value(grad[own].sum(), hess[own].sum(), *bounds[node]))
            out.value[t, node - inner] = v
            score[own] += v
    return out


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000) -> Trees | None:
    """Trees learned from ``labels`` (doc_id, quality 0 or 1) of ``docs``.

    About ``max_rows`` labelled documents, chosen by a hash of doc_id and at least a
    quarter of them of either quality where there are so many, bound what reaches the
    driver (one row of statistics each). Rows with another quality, without doc_id, or
    whose doc_id carries both qualities teach nothing. None if a quality is missing.
    """
    spark = docs.sparkSession
    marked = (labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
              .where("doc_id is not null and quality in (0, 1)").groupBy("doc_id")
              .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
              .where("quality = other").select("doc_id", "quality", F.xxhash64("doc_id").alias("th")))
    sizes = {r["quality"]: r["n"] for r in marked.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    total = sum(sizes.values())
    upto = F.lit(None).cast("long")
    for q, n in sizes.items():
        share = min(1.0, max(max_rows / total, max_rows / 4 / n))
        upto = F.when(F.col("quality") == q, F.lit(min((1 << 63) - 1, int(share * 2**64) - (1 << 63)))).otherwise(upto)
    # max_rows * 5 / 4 rows of 12 bytes at most, give or take the hash
    chosen = F.broadcast(marked.where(F.col("th") <= upto).select("doc_id", "quality"))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id")

    @F.arrow_udf("array<double>")
    def measured(texts: pa.Array) -> pa.Array:
        _, x = statistics(texts)
        return pa.ListArray.from_arrays(
            pa.array(np.arange(0, x.size + 1, len(FEATURES)), pa.int32()), pa.array(x.ravel()))

    seen = rows.select("quality", measured("text").alias("x")).toPandas()
    if seen["quality"].nunique() < 2:
        return None
    x, y = np.array(seen["x"].tolist()), seen["quality"].to_numpy(float)
    order = np.lexsort((*x.T, y))  # rows come in any order; sums shouldn't
    return boost(x[order], y[order], {FEATURES.index(k): v for k, v in MONOTONE.items()})


def judge(docs: DataFrame, model: Trees | None, least: float = 0.5) -> DataFrame:
    """All columns of ``docs`` with the counts, base_failed, score and kept (replaced if
    there).

    ``kept`` is false where ``base_failed`` (fewer than LEAST_WORDS words, or more than
    MOST_REPEATED percent of them in repeated windows), else whether ``score``, the
    trees' probability of a good text, reaches ``least``. Without a model score is 1.
    A null text counts as empty and fails. Only the text is read: repeated rows and rows
    without doc_id are each returned; very long texts are looked at alone.
    """
    out = [*COUNTS, "base_failed", "score", "kept"]
    kinds = ", ".join([*(f"{c} long" for c in COUNTS), "base_failed boolean, score double, kept boolean"])

    @F.arrow_udf(f"struct<{kinds}>")
    def judged(texts: pa.Array) -> pa.Array:
        counts, x = statistics(texts)
        failed = (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED * counts[:, 0])
        score = model.probability(x) if model else np.ones(len(x))
        arrays = [*(pa.array(counts[:, k]) for k in range(len(COUNTS))), pa.array(failed),
                  pa.array(score), pa.array(~failed & (score >= least))]
        return pa.StructArray.from_arrays(arrays, names=out)

    keep = [F.col(f"`{c}`") for c in docs.columns if c not in out]
    name = "judged"
    while name in docs.columns:
        name += "_"
    return docs.select(*keep, judged("text").alias(name)).select(
        *keep, *(F.col(f"`{name}`.{c}") for c in out))


def remove_bad(docs: DataFrame, model: Trees | None, least: float = 0.5) -> DataFrame:
    """``docs`` without the documents that ``judge`` doesn't keep."""
    name = "verdict"
    while name in docs.columns:
        name += "_"
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(name)
    kept = judge(docs.select("text", whole), model, least).where("kept")
    return kept.select(*(F.col(f"`{name}`.`{c}`") for c in docs.columns))


def op13_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The verdicts of all documents under trees learned from ``labels``.

    Odd input as in ``judge``; with no labels of one quality only the base rules judge.
    """
    model = fit(docs, labels)
    return judge(docs.select("doc_id", "text"), model).drop("text")
