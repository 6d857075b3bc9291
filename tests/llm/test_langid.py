import tracemalloc

import numpy as np
import public_tokenizers
import pytest

from innspark.llm import langid
from innspark.llm.common import table

VOCAB = public_tokenizers.path("piece_bpe_32k.model")
PIECES = ["a", "b", "ab", "▁a", "▁", "ba", "▁ab", "bab"]


def brute(word, table, k):
    marked = "▁" + word

    def rest(i):
        if i == len(marked):
            return 1.0
        total = 0.0
        for e in range(i + 1, len(marked) + 1):
            piece = marked[i:e]
            p = table[PIECES.index(piece), k] if piece in PIECES else 0.0
            total += (max(p, langid.UNKNOWN) if e == i + 1 else p) * rest(e)
        return total

    return np.log(rest(0))


def model():
    rng = np.random.default_rng(0)
    t = rng.random((len(PIECES) + 1, 2))
    t[-1] = 0
    return langid.Pieces(PIECES), t


@pytest.mark.parametrize("word", ["a", "b", "ab", "abba", "babab", "abcab", "ç", "bbbbbb"])
def test_forward_sums_all_segmentations(word):
    pieces, t = model()
    assert langid.score_words(pieces, t, [word, "a"])[0] == pytest.approx(
        [brute(word, t, 0), brute(word, t, 1)])


def test_long_words_are_scored_in_parts():
    pieces, t = model()
    got = langid.score_words(pieces, t, ["ab" * 50])[0]
    assert got == pytest.approx(2 * langid.score_words(pieces, t, ["ab" * 20])[0]
                                + langid.score_words(pieces, t, ["ab" * 10])[0])


def test_expected_counts():
    pieces, t = model()
    # each segmentation of a word uses every letter and the mark once
    uses = langid.expected_counts(pieces, t, ["abba", "ba"], np.array([[2.0, 1.0], [0.0, 3.0]]))
    letters = np.array([len(p) for p in PIECES])[:, None]
    assert (uses * letters).sum(axis=0) == pytest.approx([10.0, 5.0 + 9.0])


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = {r.doc_id: r for r in langid.op4_language(docs, VOCAB).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    judged = [(r.lang, got[r.doc_id].lang_pred) for r in rows if got[r.doc_id].held_out and r.lang]
    assert len(judged) > 20 and np.mean([a == b for a, b in judged]) > 0.95


def test_prediction_reads_the_text_only(spark, docs_of, odd_rows, monkeypatch):
    train = [(k, t, lang, "s") for k, (t, lang) in enumerate(
        [("the cat and the dog were there", "en"), ("der hund und die katze waren dort", "de")] * 40)]
    m = langid.fit(docs_of(train), VOCAB)
    assert m.langs == ["de", "en"]
    rows = odd_rows + [(50, "the dog", "de", None), (51, "die katze", None, None), (52, "123 _ ²½", "en", None)]
    scored = langid.predict(docs_of(rows), m)
    assert scored.columns[-2:] == ["lang_pred", "score"]
    got = [(r.doc_id, r.text, r.lang_pred, r.score) for r in scored.collect()]
    assert len(got) == len(rows)
    by_text = {t: p for _, t, p, _ in got}
    assert by_text["the dog"] == "en" and by_text["die katze"] == "de"
    assert all((p == "und") == (not t or not any(c.isalpha() for c in t)) for _, t, p, _ in got)
    assert all(0 <= s <= 1 for *_, s in got)
    blank = docs_of([(r[0], r[1], None, None) for r in rows])
    assert sorted(map(str, [(r.lang_pred, r.score) for r in langid.predict(blank, m).collect()])) == \
        sorted(map(str, [(p, s) for *_, p, s in got]))


def test_no_language_is_lost_by_size(docs_of):
    rows = [(k, "the cat and the dog were there", "en", "s") for k in range(600)]
    rows += [(1000 + k, "der hund und die katze", "de", "s") for k in range(300)]
    rows += [(None, "el perro y el gato", "es", "s"), (2000, "le chien", "fr", "s"), (2001, "1 2", "xx", "s")]
    assert langid.fit(docs_of(rows), VOCAB, max_rows=5, rounds=1).langs == ["de", "en", "es", "fr"]


def test_long_pieces_and_long_words_count():
    assert max(map(len, langid.vocabulary(VOCAB))) > 9
    pieces = langid.Pieces([*PIECES, "abbabbabbabba"])
    t = np.full((pieces.count + 1, 1), 1e-9)
    t[-2], t[-1] = 0.5, 0
    assert langid.score_words(pieces, t, ["abbabbabbabba"])[0, 0] > np.log(1e-10)
    pieces, t = model()
    uses = langid.expected_counts(pieces, t, ["ab" * 25], np.array([[1.0, 2.0]]))
    letters = np.array([len(p) for p in PIECES])[:, None]
    assert (uses * letters).sum(axis=0) == pytest.approx([52.0, 104.0])


def test_small_cache(monkeypatch):
    pieces, t = model()
    m = langid.Model(pieces, ["x", "y"], t)
    texts = ["ab ba abba", None, "a b ab", "12", "bab abab ab"]
    want = langid.Scorer(m).score(texts)
    monkeypatch.setattr(langid, "CACHE_WORDS", 3)
    own = langid.Scorer(m)
    for _ in range(2):
        assert np.allclose(own.score(texts), want, equal_nan=True, rtol=1e-5)


def test_no_labels_and_empty(docs_of):
    rows = [(k, "some words", None, None) for k in range(4)]
    assert {r.lang_pred for r in langid.op4_language(docs_of(rows), VOCAB).collect()} == {"und"}
    assert langid.op4_language(docs_of([]), VOCAB).count() == 0


def test_columns_with_its_own_names(spark):
    docs = spark.createDataFrame([("ab ba", 1, 2)], "text string, guess int, Guess_ int")
    pieces, t = model()
    out = langid.predict(docs, langid.Model(pieces, ["x", "y"], t))
    assert out.columns == ["text", "guess", "Guess_", "lang_pred", "score"]
    assert tuple(out.first())[:3] == ("ab ba", 1, 2)


def test_scoring_holds_no_pieces_probabilities():
    pieces = langid.Pieces(["a", "b", "ab", "abababababab", langid.MARK])
    table = np.full((6, 8), 0.2)
    table[-1] = 0
    words = [f"{k:030b}".replace("0", "a").replace("1", "b") for k in range(8192)]
    tracemalloc.start()
    scores = langid.score_words(pieces, table, words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.isfinite(scores).all()
    assert np.allclose(scores[[5]], langid.score_words(pieces, table, words[5:6]))
    assert peak < 40e6
