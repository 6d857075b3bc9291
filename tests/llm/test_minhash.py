import random
import re
import tracemalloc
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from innspark.llm import common, minhash
from innspark.llm.common import components
from innspark.llm.minhash import near_duplicates, op3_near_duplicates


def shingles(text, k):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or "")) if x]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def brute(rows, k=4, percent=80):
    """Components of the rows by comparing all pairs."""
    sets = [shingles(t, k) if d is not None else set() for d, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                low, high = sorted((a, b), key=lambda x: rows[x][0])
                root[high] = low
    return [(d, len(shingles(t, k)), rows[find(i)][0]) for i, (d, t) in enumerate(rows)]


def chains(rng):
    """Groups of copies, near copies of near copies, and texts that share passages."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, base = [], [word() for _ in range(90)]
    for _ in range(40):  # a chain: each differs a little from the one before
        rows.append(" ".join(base))
        base[rng.randrange(90)] = word()
    passage = " ".join(word() for _ in range(60))
    rows += [passage + " " + " ".join(word() for _ in range(rng.randrange(5, 60))) for _ in range(40)]
    rows += [rng.choice(rows).upper() for _ in range(30)]
    rows += [" ".join(word() for _ in range(rng.randrange(1, 6))) for _ in range(30)]
    rng.shuffle(rows)
    return list(zip(rng.sample(range(10_000), len(rows)), rows))


@pytest.mark.parametrize("words, block", [(4, minhash.BLOCK), (5, 4)])
def test_components_equal_all_pairs(docs_of, words, block):
    rows = chains(random.Random(words))
    got = [tuple(r) for r in near_duplicates(docs_of(rows), words=words, block=block).collect()]
    assert sorted(got) == sorted(brute(rows, words))


def test_odd_rows(docs_of, odd_rows):
    rows = [r[:2] for r in odd_rows]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in op3_near_duplicates(docs_of(rows)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    assert op3_near_duplicates(docs_of([])).count() == 0


def test_shingles_of_long_and_chunked_texts(monkeypatch):
    texts = ["a b c d e", "", None, "A  b\tc", "x " * 3000 + "é ü"]
    with np.errstate(over="ignore"):
        want = minhash.shingle_sets(texts)
        monkeypatch.setattr(minhash, "BATCH_BYTES", 8)
        got = minhash.shingle_sets(texts)
    assert all((a == b).all() for a, b in zip(want, got))
    assert [len(s) for s in got] == [len(shingles(t, 4)) for t in texts]


def test_common_counts():
    rng = np.random.default_rng(1)
    xs, ys = ([np.unique(rng.integers(0, 6000, n).astype(np.uint64)) for n in sizes]
              for sizes in ((0, 1, 900, 3000), (5000, 10, 0)))
    assert minhash._common(xs, ys).tolist() == [[len(np.intersect1d(x, y)) for y in ys] for x in xs]


def test_signature_estimates_similarity():
    rng = np.random.default_rng(7)
    with np.errstate(over="ignore"):
        for share in (0.5, 0.8, 0.95):
            x = rng.integers(1, 2**63, 2000, dtype=np.uint64)
            y = x.copy()
            n = int(2000 * (1 - share) / (1 + share))
            y[:n] = rng.integers(1, 2**63, n, dtype=np.uint64)
            same = (minhash.signature(x, 512) == minhash.signature(y, 512)).mean()
            assert abs(same - share) < 0.08


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(35)] + [(300, 300)]
    rng.shuffle(edges)
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.component for r in components(
        spark, spark.createDataFrame([rng.sample(e, 2) for e in edges], "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root[x] for x in linked}


def test_components_with_hubs(spark, monkeypatch):
    monkeypatch.setattr(common, "HUB_ROWS", 3)
    test_components(spark)
    star = [(5, k) for k in range(6, 4000)] + [(k, k + 1) for k in range(5000, 5040)]
    got = {r.node: r.component for r in components(
        spark, spark.createDataFrame(star, "a long, b long")).collect()}
    assert got == {k: 5 for k in range(5, 4000)} | {k: 5000 for k in range(5000, 5041)}


def test_join_hubs(spark):
    rows = [(str(k % 7) if k % 3 else "hot", k) for k in range(3000)]
    counts = Counter(key for key, _ in rows)
    left = spark.createDataFrame(rows, "key string, v long")
    right = spark.createDataFrame([(key, n, f"x{key}", None) for key, n in counts.items()],
                                  "key string, n long, a string, b string")
    got = common.join_hubs(left, right, "key", "n", len(rows), "v")
    assert got.columns == ["key", "v", "a", "b"]
    assert sorted(map(tuple, got.collect())) == sorted((key, v, f"x{key}", None) for key, v in rows)


def test_blocks_cut_by_shingles(docs_of, monkeypatch):
    """Blocks of few long texts give the components of all pairs."""
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 400)
    rows = chains(random.Random(4))
    got = near_duplicates(docs_of(rows)).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(rows))


def test_worker_memory_is_small_and_given_back():
    """What a Python worker takes for 4 MB of texts, and what it keeps afterwards."""
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefgh", k=500)) for _ in range(4200)]
    texts.append("x " * 1_500_000)
    minhash._powers.clear()
    tracemalloc.start()
    with np.errstate(over="ignore"):
        minhash.shingle_sets(texts[:-1])
        assert tracemalloc.get_traced_memory()[1] < 60e6
        minhash.shingle_sets(texts)
    assert sum(p.nbytes for p in minhash._powers) < 10e6
    tracemalloc.stop()
    resident = lambda: int(Path("/proc/self/statm").read_text().split()[1]) * 4096
    held = [np.ones(1 << 13) for _ in range(4000)]  # 256 MB in pieces that malloc keeps
    last = np.ones(1 << 13)
    full = resident()
    del held
    common.release_cache()
    assert resident() < full - 200e6 and len(last)
