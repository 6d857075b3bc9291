"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A word's probability is the sum over all its segmentations into pieces, which a
forward algorithm adds up; a text's is the product over its words. The piece
probabilities come from expectation-maximisation over the same segmentations
(forward and backward), on word counts of a bounded sample of labelled rows.

All words of one length run through the algorithm together as numpy columns. A
worker remembers the words it has scored.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innspark.llm.common import fresh, trim_memory, worker_cache, written

LETTERS = regex.compile(r"\p{L}+")
PART = 40  # letters; a longer word is scored in parts of this size
LEAST_ROWS = 200  # of each language in the sample; all of a rarer one
MARK = "▁"  # stands before a word, in vocabularies and here
UNKNOWN = 1e-7  # probability of a letter that the vocabulary lacks, in any language
CACHE_WORDS = 300_000  # words of which a worker remembers the scores
BASE = np.uint64(0x9E3779B97F4A7C15)
TABLE_BITS = 17


def vocabulary(path: str) -> list[str]:
    """Lower-case pieces of letters, with or without the word mark, in id order."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (sp.id_to_piece(k) for k in range(sp.get_piece_size()))
    return [p for p in pieces if p.removeprefix(MARK).isalpha() and p == p.lower()] + [MARK]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Pieces:
    """Places of the vocabulary's pieces by rolling hash."""

    def __init__(self, pieces: list[str]):
        self.count = len(pieces)
        self.longest = max(map(len, pieces))
        self.keys = np.zeros(1 << TABLE_BITS, dtype=np.uint64)
        self.places = np.full(1 << TABLE_BITS, -1, dtype=np.int32)
        self.probes = 0
        for place, piece in enumerate(pieces):
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for c in piece:
                    h = h * BASE + np.uint64(ord(c))
                h = _mixed(h)
            at, step = int(h) >> (64 - TABLE_BITS), 0
            while self.places[at] >= 0 and self.keys[at] != h:
                at, step = (at + 1) % (1 << TABLE_BITS), step + 1
            self.keys[at], self.places[at] = h, place
            self.probes = max(self.probes, step + 1)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash; ``count`` (a row of zeros) if there is none."""
        h = _mixed(h)
        at = (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        out = np.full(len(h), self.count, dtype=np.int32)
        for _ in range(self.probes):
            hit = self.keys[at] == h
            out[hit] = self.places[at[hit]]
            at = (at + 1) & ((1 << TABLE_BITS) - 1)
        return out


def _spans(pieces: Pieces, words: list[str]) -> tuple[int, dict[tuple[int, int], np.ndarray]]:
    """Places of the pieces at each (start, end) of words of one length, marked."""
    size = len(words[0]) + 1
    codes = np.frombuffer("".join(MARK + w for w in words).encode("utf-32-le"), np.uint32)
    codes = codes.reshape(-1, size).astype(np.uint64).T.copy()
    out = {}
    for s in range(size):
        h = np.zeros(codes.shape[1], dtype=np.uint64)
        for e in range(s + 1, min(size, s + pieces.longest) + 1):
            h = h * BASE + codes[e - 1]
            out[s, e] = pieces.find(h)
    return size, out


def _forward(size: int, spans: dict, table: np.ndarray, keep: bool = True
             ) -> tuple[list[np.ndarray], dict]:
    """alpha[i]: probability of the first i characters over all segmentations. With
    ``keep``, also the pieces' probabilities, which take most of the memory."""
    alpha = [np.ones((len(spans[0, 1]), table.shape[1]))]
    probs = {}
    for e in range(1, size + 1):
        total = 0.0
        for s in range(e):
            if (s, e) not in spans:
                continue
            p = table[spans[s, e]]
            if e == s + 1:  # a letter without a piece is still a segment
                p = np.maximum(p, UNKNOWN)
            if keep:
                probs[s, e] = p
            total = total + alpha[s] * p
        alpha.append(total)
    return alpha, probs


def _by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        out.setdefault(len(w), []).append(k)
    return out


def score_words(pieces: Pieces, table: np.ndarray, words: list[str]) -> np.ndarray:
    """log P(word) in each language, over all segmentations."""
    out = np.zeros((len(words), table.shape[1]))
    for length, places in _by_length(words).items():
        if length > PART:
            for k in places:
                parts = [words[k][a:a + PART] for a in range(0, length, PART)]
                out[k] = score_words(pieces, table, parts).sum(axis=0)
            continue
        for a in range(0, len(places), 2048):
            part = places[a:a + 2048]
            size, spans = _spans(pieces, [words[k] for k in part])
            out[part] = np.log(_forward(size, spans, table, keep=False)[0][size])
    return out


def expected_counts(pieces: Pieces, table: np.ndarray, words: list[str], counts: np.ndarray
                    ) -> np.ndarray:
    """Expected uses of each piece in each language (one step of E)."""
    out = np.zeros((pieces.count + 1, table.shape[1]))
    for length, places in _by_length(words).items():
        if length > PART:
            for k in places:  # in the parts that it is scored in
                parts = [words[k][a:a + PART] for a in range(0, length, PART)]
                out[:-1] += expected_counts(pieces, table, parts, np.repeat(counts[k:k + 1], len(parts), axis=0))
            continue
        for a in range(0, len(places), 8192):
            part = places[a:a + 8192]
            size, spans = _spans(pieces, [words[k] for k in part])
            alpha, probs = _forward(size, spans, table)
            beta = [None] * size + [np.ones_like(alpha[0])]
            for s in range(size - 1, -1, -1):
                beta[s] = sum(p * beta[e] for (b, e), p in probs.items() if b == s)
            weight = counts[part] / alpha[size]
            for (s, e), p in probs.items():
                use = alpha[s] * p * beta[e] * weight
                for k in range(use.shape[1]):
                    out[:, k] += np.bincount(spans[s, e], use[:, k], minlength=len(out))
    return out[:-1]


class Model:
    """Piece probabilities of the learned languages."""

    def __init__(self, pieces: Pieces, langs: list[str], table: np.ndarray):
        self.pieces, self.langs, self.table = pieces, langs, table


def fit(docs: DataFrame, vocab: str, max_rows: int = 6000, rounds: int = 3) -> Model:
    """Learn from the rows of ``docs`` (doc_id, text, lang) that have text and lang.

    About ``max_rows`` of those with a letter, chosen by a hash and shared out by the
    languages' sizes, give the word counts; a language has at least LEAST_ROWS, or all
    of its rows. This bounds the model's work at any size of the corpus and loses no
    language. The driver receives sums for each language and piece.
    """
    spark = docs.sparkSession
    rows = (docs.select("doc_id", "text", "lang").where("text is not null and lang is not null")
            .where(F.col("text").rlike(r"\p{L}")).withColumn("th", F.xxhash64("doc_id", "text")))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("th").alias("least")).collect()
    n = sum(r["n"] for r in sizes)
    upto = []
    for r in sizes:
        share = min(1.0, max(max_rows / n, LEAST_ROWS / r["n"]))
        upto.append((r["lang"], max(r["least"], min((1 << 63) - 1, int(share * 2**64) - (1 << 63)))))
    rows = rows.join(F.broadcast(spark.createDataFrame(upto, "lang string, upto long")), "lang"
                     ).where("th <= upto")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: Counter = Counter()
            for text, lang in zip(batch["text"], batch["lang"]):
                seen.update((lang, w) for w in LETTERS.findall(text.lower()))
            yield pd.DataFrame([(a, b, c) for (a, b), c in seen.items()],
                               columns=["lang", "word", "n"])

    counted = written(rows.select("text", "lang").mapInPandas(count, "lang string, word string, n long")
                      .groupBy("word").agg(F.collect_list(F.struct("lang", "n")).alias("by_lang")),
                      "words")
    langs = sorted(r["lang"] for r in counted.select(F.explode("by_lang.lang").alias("lang"))
                   .distinct().collect())
    pieces = vocabulary(vocab)
    known = Pieces(pieces)
    place = {x: k for k, x in enumerate(langs)}
    table = np.full((len(pieces) + 1, max(1, len(langs))), 1.0 / len(pieces))
    table[-1] = 0
    for _ in range(rounds if langs else 0):
        now = table

        def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = 0.0
            for batch in batches:
                n = np.zeros((len(batch), len(langs)))
                for k, pairs in enumerate(batch["by_lang"]):
                    for x in pairs:
                        n[k, place[x["lang"]]] += x["n"]
                total = total + expected_counts(known, now, batch["word"].tolist(), n)
            if not np.isscalar(total):
                yield pd.DataFrame({"piece": np.repeat(np.arange(len(pieces)), len(langs)),
                                    "lang": np.tile(np.arange(len(langs)), len(pieces)),
                                    "n": total.ravel()})

        sums = counted.mapInPandas(expect, "piece int, lang int, n double").groupBy(
            "piece", "lang").agg(F.sum(F.round("n", 6)).alias("n")).toPandas()
        table = np.full((len(pieces) + 1, len(langs)), 0.1)
        table[sums["piece"], sums["lang"]] += sums["n"]
        table[-1] = 0
        table /= table.sum(axis=0)
    return Model(known, langs, table)


class Scorer:
    """Scores texts; one for each model and Python worker."""

    def __init__(self, model: Model):
        self.model, self.pieces = model, model.pieces
        self.known: dict[str, int] = {}
        self.scores = np.zeros((CACHE_WORDS, len(model.langs)), dtype=np.float32)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """log P(text) in each language; nan for texts without a letter."""
        words = [LETTERS.findall(t.lower()) if t else [] for t in texts]
        flat = [w for ws in words for w in ws]
        known, scores = self.known, self.scores
        missing = sorted(set(flat) - known.keys())
        if missing:
            new = score_words(self.pieces, self.model.table, missing)
            room = CACHE_WORDS - len(known)
            if len(missing) <= room:
                scores[len(known):len(known) + len(missing)] = new
                known.update(zip(missing, range(len(known), len(known) + len(missing))))
            else:  # what is common is known by now
                ids = list(map(known.get, flat))
                other = dict(zip(missing, range(len(missing))))
                rows = np.array([-1 - other[w] if i is None else i for i, w in zip(ids, flat)])
                picked = np.where((rows >= 0)[:, None], scores[np.maximum(rows, 0)],
                                  new[np.maximum(-1 - rows, 0)])
                return self._sums(words, picked)
        return self._sums(words, scores[np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))])

    @staticmethod
    def _sums(words: list[list[str]], picked: np.ndarray) -> np.ndarray:
        sizes = np.array([len(w) for w in words])
        out = np.full((len(words), picked.shape[1]), np.nan)
        full = np.flatnonzero(sizes)
        if len(full):
            starts = (np.cumsum(sizes) - sizes)[full]
            out[full] = np.add.reduceat(picked.astype(np.float64), starts, axis=0)
        return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` with lang_pred and score (replaced if there).

    ``score`` is the language's posterior probability under equal priors; ties
    go to the first language in code point order. Text that is null or has no
    letter, and any text when no language was learned, is ``und`` with score 0.
    Repeated rows and rows without doc_id are each returned; only the text is
    read.
    """
    key = uuid.uuid4().hex

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = worker_cache(key, lambda: Scorer(model))
        for texts in batches:
            texts = [t if isinstance(t, str) else None for t in texts]
            names, scores = [], []
            for a in range(0, len(texts), 512):
                logs = scorer.score(texts[a:a + 512]) if model.langs else np.full(
                    (len(texts[a:a + 512]), 1), np.nan)
                for row in logs:
                    best = int(np.argmax(row)) if not np.isnan(row[0]) else -1
                    names.append(model.langs[best] if best >= 0 else "und")
                    scores.append(1 / np.exp(row - row[best]).sum() if best >= 0 else 0.0)
            yield pd.DataFrame({"lang_pred": names, "score": scores})
        trim_memory()

    guess = F.pandas_udf(run, "lang_pred string, score double")  # type: ignore[call-overload]
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    name = fresh(docs, "guess")
    return docs.select(*keep, guess("text").alias(name)).select(
        *keep, F.col(f"{name}.lang_pred"), F.col(f"{name}.score"))


def held_out(docs: DataFrame) -> DataFrame:
    """``docs`` with the boolean held_out: crc32 of the doc_id as text, mod 4, is 2."""
    return docs.withColumn("held_out", F.coalesce(
        F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)))


def op4_language(docs: DataFrame, vocab: str) -> DataFrame:
    docs = held_out(docs.select("doc_id", "text", "lang"))
    model = fit(docs.where("not held_out"), vocab)
    return predict(docs.select("doc_id", "text", "held_out"), model).select(
        "doc_id", "held_out", "lang_pred", "score")
