import numpy as np
import pytest

from innspark.llm import quality_rules as Q
from innspark.llm.common import table

WHITE = " \t\n\x0b\x0c\r"


def brute(text):
    text = text or ""
    words = "".join(" " if c in WHITE else c for c in text).split(" ")
    words = [w for w in words if w]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(line.strip(WHITE)) and line in seen
        seen.add(line)
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), failed)


TEXTS = [None, "", " \n\t", "a", "é b ñ x", "a b c d e f g h " * 4, "x y\nx y\n \n \nx y",
         " ".join(f"w{k % 9}" for k in range(40)), "|| ## a* <b> 100%\x0b&\x1c$ z\x85q",
         "one two three four five six seven eight nine. " + "filler words go here " * 3 + "one two three four five six seven eight nine.",
         " ".join(f"w{k}" for k in range(20)), " ".join(f"w{k}" for k in range(19)), "日本語 テキスト 😀\n日本語 テキスト 😀"]


def test_counts_against_brute_force(docs_of):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, TEXTS[5]), (3, TEXTS[5]), (3, TEXTS[5])]
    got = Q.judge(docs_of(rows), None).collect()
    want = sorted(((doc, *brute(t)) for doc, t in rows), key=str)
    assert sorted(((r.doc_id, *(r[c] for c in Q.COUNTS), r.base_failed) for r in got), key=str) == want
    assert all(r.kept == (not r.base_failed) and r.score == 1 and r.hash == "x" for r in got)


def test_parts_agree(monkeypatch):
    import pyarrow as pa
    texts = pa.array([t * 3 if t else t for t in TEXTS] * 5)
    whole = Q.statistics(texts)
    monkeypatch.setattr(Q, "PART_BYTES", 50)
    split = Q.statistics(texts)
    assert (whole[0] == split[0]).all() and np.allclose(whole[1], split[1])
    assert Q.statistics(pa.array([], pa.string()))[1].shape == (0, len(Q.FEATURES))


def test_trees_against_walking_them():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] + x[:, 1] * x[:, 2] - x[:, 3] + rng.normal(size=600) * 0.2) > 0).astype(float)
    model = Q.boost(x, y, {3: -1, 0: 1}, trees=30)
    got = model.probability(x)
    for k in range(0, 600, 37):
        total = model.base
        for t in range(30):
            node = 0
            while node < len(model.feature[t]):
                node = 2 * node + 1 + int(x[k, model.feature[t, node]] > model.limit[t, node])
            total += model.value[t, node - len(model.feature[t])]
        assert got[k] == pytest.approx(1 / (1 + np.exp(-total)))
    assert ((got > 0.5) == (y > 0)).mean() > 0.9
    for f, sign in ((3, -1), (0, 1)):  # every row along the whole range
        grid = np.linspace(-4, 4, 60)
        for k in range(0, 600, 61):
            line = np.repeat(x[k:k + 1], 60, axis=0)
            line[:, f] = grid
            assert (sign * np.diff(model.probability(line)) >= -1e-12).all()


def test_held_out_accuracy(spark):
    from pyspark.sql import functions as F
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = Q.fit(docs, labels.where(~held))
    seen = Q.judge(docs.join(labels.where(held), "doc_id"), model).where("not base_failed").select(
        "quality", "kept", "score").toPandas()
    good = seen[seen["quality"] == 1]
    assert (seen["kept"] == (seen["quality"] == 1)).mean() >= 0.97
    assert good["kept"].mean() >= 0.98


def test_labels_that_teach_nothing(spark, docs_of):
    docs = docs_of([(k, f"word{k} " * 25) for k in range(6)] + [(None, "x")])
    label = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int, th string")
    for rows in ([], [(1, 1, 0, "a")], [(None, 0, 0, "a"), (2, 1, 0, "a")], [(1, 0, 1, "a"), (1, 1, 1, "b"), (2, 1, 0, "")],
                 [(77, 0, 0, "a"), (78, 1, 0, "a")], [(1, 5, 0, "a"), (2, None, 0, "a")]):
        assert Q.fit(docs, label(rows)) is None
    model = Q.fit(docs, label([(k, k % 2, 0, "a") for k in range(6)] * 2))
    assert model is not None
    assert Q.op13_quality(docs_of([]), label([])).collect() == []
    out = Q.remove_bad(docs, None)
    assert out.columns == docs.columns and out.count() == 0  # all repeat their word


def test_reruns_agree(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "labels"))
    one = sorted(Q.op13_quality(docs, labels).collect())
    assert one == sorted(Q.op13_quality(docs.repartition(5), labels.repartition(3)).collect())
