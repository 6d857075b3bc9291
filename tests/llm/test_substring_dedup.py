import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from innspark.llm import substring_dedup as sd


def brute(rows, length=100):
    first, out = {}, []
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    for doc, text in order:
        raw = (text or "").encode()
        for p in range(len(raw) - length + 1):
            place = first.setdefault(raw[p:p + length], (doc, p))
            first[raw[p:p + length]] = min(place, (doc, p))
    lost = {}
    for doc, text in order:  # rows that repeat a doc_id are one document
        raw = (text or "").encode()
        for p in range(len(raw) - length + 1):
            if first[raw[p:p + length]] < (doc, p):
                lost.setdefault(doc, set()).update(range(p, p + length))
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.isin(np.arange(len(raw)), list(lost.get(doc, ())))
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(40) for _ in range(4)]
    rows = []
    for _ in range(60):
        parts = [rng.choice(passages)[rng.randrange(60):rng.randrange(80, 200)] if rng.random() < 0.5
                 else text(rng.randrange(0, 40)) for _ in range(rng.randrange(1, 5))]
        rows.append("".join(parts))
    rows += [rng.choice(rows) for _ in range(10)] + ["x" * 350, "x" * 99, "ab" * 200, None, ""]
    rng.shuffle(rows)
    return list(zip(rng.sample(range(1000), len(rows)), rows))


def digest(df):
    return sorted(((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), r.kept_sha256)
                   for r in df.collect()), key=str)


@pytest.mark.parametrize("hot", [sd.HOT, 2])
def test_equals_brute_force(docs_of, hot):
    rows = made(hot)
    assert digest(sd.remove_repeats(docs_of(rows), hot=hot)) == brute(rows)


@pytest.mark.parametrize("chunk", [257, 3000, sd.CHUNK])
def test_chunks_cover_every_string(monkeypatch, chunk):
    # no worker: the chunk size is that of this process
    texts = {1: "abc" * 30 + "".join(random.Random(1).choices("ab", k=5000)), 2: "z" * 700}
    texts[3] = texts[1]
    monkeypatch.setattr(sd, "CHUNK", chunk)
    batch = pd.DataFrame(texts.items(), columns=["doc_id", "text"])
    found = pd.concat(sd._describe(100, 24)([batch]))
    places = [(g, d, p) for g, d, f, e in zip(found["gone"], found["doc_id"], found["first"], found["end"])
              for p in range(f, e - 99)]
    kept = [x[1:] for x in places if not x[0]]
    assert len(kept) == len(set(kept))
    assert {x[1:] for x in places} == {(d, p) for d, t in texts.items() for p in range(len(t) - 99)}
    # what a chunk finds gone is covered by strings that start earlier
    first, covered = {}, set()
    for d, t in texts.items():
        for p in range(len(t) - 99):
            if first.setdefault(t[p:p + 100], (d, p)) != (d, p):
                covered |= {(d, q) for q in range(p, p + 100)}
    gone = found[found["gone"]]
    assert {(d, q) for d, f, e in zip(gone["doc_id"], gone["first"], gone["end"]) for q in range(f, e)} <= covered


def test_a_passage_of_all_documents_sends_one_row_a_chunk():
    rng = random.Random(6)
    word = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage = word(400)
    batch = pd.DataFrame({"doc_id": range(500), "text": [word(150) + passage + word(150) for _ in range(500)]})
    found = pd.concat(sd._describe(100, 24)([batch]))
    per_gram = found[~found["gone"]].groupby(["gram", "context"]).size()
    assert per_gram.max() == 1
    # the passage's inner contexts are sent once, those of later documents are one interval each
    gone = found[found["gone"]]
    assert sorted(gone["doc_id"]) == list(range(1, 500))
    # letters beside the passage can agree by chance
    assert (gone["first"] >= 140).all() and (gone["end"] <= 560).all()


def test_spans_of_texts_that_share_an_id():
    doc, start, end = sd._spans(np.array([7, 7, 7, 8, 7]), np.array([10, 0, 300, 5, 50]),
                                np.array([120, 200, 400, 105, 150]))
    assert list(zip(doc, start, end)) == [(7, 0, 200), (7, 300, 400), (8, 5, 105)]
    assert [len(x) for x in sd._spans(*[np.zeros(0, np.int64)] * 3)] == [0, 0, 0]


def test_judging_doesn_t_depend_on_batches():
    rng = random.Random(3)
    rows = sorted((rng.randrange(12), rng.randrange(3), d, rng.randrange(50)) for d in range(150))
    rows = [(True, 0, 0, 200 + d, 3, 117) for d in range(9)] + [(False, *r, r[3] + 104) for r in rows]
    full = pd.DataFrame(rows, columns=["gone", "gram", "context", "doc_id", "first", "end"])

    def run(size):
        parts = [full.iloc[a:a + size] for a in range(0, len(full), size)]
        return sorted(map(tuple, pd.concat(sd._judge()(iter(parts))).fillna(0).astype("int64").values.tolist()))

    assert run(1) == run(2) == run(7) == run(1000)
    assert sum(r[2] >= 200 for r in run(7)) == 9


def test_odd_rows(docs_of, odd_rows):
    rows = [r[:2] for r in odd_rows if len(r[1] or "") < 1000] + [(4, "lorem ipsum " * 30), (5, "lorem ipsum " * 30),
                                                                  (5, "lorem ipsum " * 30), (None, "lorem ipsum " * 30)]
    assert digest(sd.remove_repeats(docs_of(rows))) == brute(rows)
    assert sd.op8_substrings(docs_of([])).count() == 0


def test_kept_bytes(docs_of):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdef ") for _ in range(300))
    got = {r.doc_id: bytes(r.kept) for r in sd.remove_repeats(docs_of([(1, text), (2, "new" + text + "end")])).collect()}
    assert got == {1: text.encode(), 2: b"newend"}
