import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from innspark.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items, k=50):
    docs = [(d, Counter(terms(t))) for d, t in docs]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, want in asked.items():
        scored = []
        for d, c, n in docs:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in want if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        scored.sort(key=lambda x: x[:3])
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(scored[:k])]
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "item_id long, text string, q string, rank int")


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)] + ["É", "ñandú", "Ｗide", "a1b2"]
    pick = lambda k: " ".join(rng.choice(vocab[:int(4 + rng.paretovariate(0.5) * 8) % len(vocab) + 1]) for _ in range(k))
    docs = [(k, pick(rng.choice((1, 3, 20, 60, 400)))) for k in range(n)]
    docs += [(n + k, docs[5][1]) for k in range(200)]  # a group of copies: ties
    return docs, [(k, pick(rng.choice((2, 6, 30)))) for k in range(25)]


@pytest.mark.parametrize("k", (50, 3))
def test_against_brute_force(spark, docs_of, k):
    docs, items = corpus(k, 1200)
    assert result(L.search(docs_of(docs), items_of(spark, items), k)) == brute(docs, items, k)


def test_blocks_of_queries(spark, docs_of):
    docs, items = corpus(7, 150)
    assert result(L.search(docs_of(docs), items_of(spark, items), 10, block_terms=60)) == brute(docs, items, 10)


def test_odd_rows(spark, docs_of, odd_rows):
    docs = [r[:2] for r in odd_rows] + [(20, "Seven! one-two"), (21, "@@ [] ^_` {|} ~"), (22, "ONE\x7ftwo\x00three")]
    items = [(1, "one two lorem"), (1, "SEVEN seven"), (2, None), (3, ""), (None, "a id 日本語"), (4, "absent"), (5, "lorem lorem"),
             (5, "lorem lorem")]
    assert result(L.op11_lexical_search(docs_of(odd_rows + [(d, t, None, None) for d, t in docs[len(odd_rows):]]),
                                        items_of(spark, items))) == brute(docs, items)


def test_empty(spark, docs_of):
    assert result(L.search(docs_of([]), items_of(spark, [(1, "a")]))) == []
    assert result(L.search(docs_of([(1, "a")]), items_of(spark, []))) == []
    assert result(L.search(docs_of([(1, None), (2, "-")]), items_of(spark, [(1, "a")]))) == []


def test_bounds_discard_only_what_cannot_reach():
    """Buckets with thresholds keep every vector that reaches them, and skip some."""
    rng = np.random.default_rng(3)
    weights = rng.integers(0, 9000, 40)
    rows = [np.sort(rng.choice(40, rng.integers(1, 25), replace=False)) for _ in range(500)]
    impacts = [rng.integers(1, 900_000, len(r)) for r in rows]
    length = np.array([math.sqrt(float((weights[r] * x.astype(float) ** 2).sum())) for r, x in zip(rows, impacts)])
    order = np.argsort(-length)
    cells = [(t, new, x) for new, r in enumerate(order) for t, x in zip(rows[r], impacts[r])]
    cells.sort()
    t, row, impact = (np.array(c) for c in zip(*cells))
    bucket = {"length": length[order], "row": row, "impact": impact, "first": np.searchsorted(t, np.arange(41))}
    skipped = 0
    for _ in range(200):
        own = np.sort(rng.choice(40, rng.integers(1, 12), replace=False))
        want = np.array([sum(int(weights[a]) * int(x) for a, x in zip(rows[r], impacts[r]) if a in own) for r in order])
        for floor in (0, int(np.sort(want)[-5]), int(want.max()), int(want.max()) + 1, int(length.max() * 300)):
            at, scores = L._search_bucket(0, own, weights, floor, bucket)
            good = np.flatnonzero(want >= max(floor, 1))
            assert (at == good).all() and (scores == want[good]).all()
            skipped += floor > 0 and math.sqrt(float(weights[own].sum())) * length.max() < floor
    assert skipped
