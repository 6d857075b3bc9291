import hashlib
import re

import pytest

from innspark.llm import decontaminate
from innspark.llm.decontaminate import op6_decontaminate, remove_documents, remove_spans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, n=10):
    out = []
    for doc, text in docs:
        w, hit, met = words(text), set(), set()
        for item, bench in items:
            b = words(bench)
            k = min(n, len(b))
            windows = {tuple(b[i:i + k]) for i in range(len(b) - k + 1)} if k else set()
            for i in range(len(w) - k + 1 if k else 0):
                if tuple(w[i:i + k]) in windows:
                    hit.update(range(i, i + k))
                    met.add(item)
        ids = sorted(str(i) for i in met if i is not None)
        out.append((doc, len(w), len(hit), len(ids),
                    hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, "The quick brown fox jumps over the lazy dog, and then it sleeps for long."),
         (10, "short item"), (2, "quick brown FOX jumps over the lazy dog and then it"), (3, None), (4, "!!"),
         (None, "words without an id"), (2, "Éa b c d e f g h i j k l"), (5, "one")]
DOCS = [(1, "see: the QUICK brown fox jumps over the lazy dog and then, it sleeps for long!"),
        (2, "short; item short item"), (3, "the quick brown fox jumps over the lazy cat"),
        (4, "words without an id; éa b c d e f g h i j"), (5, "Éa b c d e f g h i j k"), (6, "o ne")]


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_WORDS, 0])
def test_windows(spark, docs_of, odd_rows, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_WORDS", limit)
    rows = DOCS + [r[:2] for r in odd_rows] + [DOCS[0]]
    bench = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, w string")
    got = [tuple(r) for r in op6_decontaminate(docs_of(rows), bench).collect()]
    assert sorted(got, key=str) == brute(rows, ITEMS)


def test_removal(spark, docs_of):
    bench = spark.createDataFrame(ITEMS[:2], "item_id long, text string")
    assert sorted(r.doc_id for r in remove_documents(docs_of(DOCS), bench).collect()) == [3, 4, 5, 6]
    kept = {r.doc_id: r.text for r in remove_spans(docs_of(DOCS), bench).collect()}
    assert kept[3] == DOCS[2][1] and words(kept[1]) == ["see"] and words(kept[2]) == []
    assert kept[1].startswith("see: ") and kept[1].endswith("!")


def test_empty(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert op6_decontaminate(docs_of([]), none).count() == 0
    rows = op6_decontaminate(docs_of(DOCS), none).collect()
    assert len(rows) == len(DOCS) and not any(r.contaminated for r in rows)


def test_removal_keeps_columns_with_its_own_names(spark):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, "x " + text, 5, 6, 7), (1, "clean", 5, 6, 7), (None, None, 5, 6, 7)],
                                 "doc_id long, text string, bad_id int, bad_text int, bad_at int")
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    left = remove_documents(docs, items)
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect()), key=str) == [(1, "clean", 5, 6, 7), (None, None, 5, 6, 7)]
    cut = remove_spans(docs, items)
    assert cut.columns == docs.columns
    assert sorted(map(tuple, cut.collect()), key=str) == [
        (1, "clean", 5, 6, 7), (1, "x ", 5, 6, 7), (None, None, 5, 6, 7)]


def test_ids_of_a_shared_window_count_in_the_broadcast(docs_of, spark, monkeypatch):
    """A window of many items: beyond the bound the join is a shuffle, with equal rows."""
    text = "one two three four five six seven eight nine ten"
    docs = docs_of([(1, text), (2, "nothing of it")])
    items = spark.createDataFrame([(k, text) for k in range(40)], "item_id long, text string")
    want = sorted(map(tuple, op6_decontaminate(docs, items).collect()))
    assert [r[3] for r in want] == [40, 0]
    monkeypatch.setattr(decontaminate, "BROADCAST_WORDS", 30)
    plan = op6_decontaminate(docs, items)
    assert sorted(map(tuple, plan.collect())) == want
