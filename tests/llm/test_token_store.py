import gc
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from innspark.llm import token_store as ts
from innspark.llm.common import scratch

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [0]


@given(st.lists(st.one_of(st.integers(0, 255), st.integers(0, 2**16), st.integers(0, 2**32 - 1)),
                max_size=1500))
@settings(max_examples=60, deadline=None)
def test_codes_round_trip(ids):
    codes = ts.encode_codes(np.array(ids, dtype=np.uint32))
    assert ts.decode_codes(codes).tolist() == ids
    assert [ts.access(codes, i) for i in range(len(ids))] == ids
    with pytest.raises(IndexError):
        ts.access(codes, len(ids))


PIECES = st.sampled_from([" ", "  ", "a", "the", "'s", "'ll", "\n", "\t", " ", "é", "日", "😀", "1",
                          ".", "ß", "<|endoftext|>", "\r\n", " The", "-", "x" * 30])


@given(st.lists(st.lists(PIECES, max_size=25).map("".join), max_size=6))
@settings(max_examples=200, deadline=None)
def test_words_give_the_library_s_ids(texts):
    got = ts.encoder(PATH).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() + [0] for g in got] == [ids_of(t) for t in texts]


def test_texts_that_begin_with_white_space():
    own = ts.WordEncoder(PATH)
    texts = ["\thß,, 'll b\n", "x\n\n 'lld", "\r\na b c\t", " a", "\n", "", "b\n c \xa0d"]
    assert [np.frombuffer(g, "<u4").tolist() + [0] for g in own.encode(texts)] == [ids_of(t) for t in texts]


@pytest.mark.parametrize("odd", ["\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", "\u2028", "\u180e", "\u200b",
                                 "\u0558", "\u088f", "\u209d", "\ua7ce", "\U0001fae9", "\0"])
def test_characters_that_unicode_tables_disagree_on(odd):
    own = ts.WordEncoder(PATH)
    texts = [f"some {odd}b words", f"a\n {odd} b\t {odd}{odd}c after it", f"x{odd} y{odd}z {odd}1", f"{odd} more {odd}",
             "words that follow in one batch"]
    assert [np.frombuffer(g, "<u4").tolist() + [0] for g in own.encode(texts)] == [ids_of(t) for t in texts]


def test_full_cache(monkeypatch):
    monkeypatch.setattr(ts, "CACHE_WORDS", 3)
    own = ts.WordEncoder(PATH)
    for text in ("a few words", "more words than fit in there", "a few more words again"):
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() + [0] == ids_of(text)
    assert len(own.words) <= 3


def test_store(spark, docs_of, odd_rows, monkeypatch):
    rows = odd_rows + [(k, f"document number {k} " * (k % 7)) for k in range(100, 160)]
    store = scratch(spark, "test-store")
    ts.write_store(docs_of(rows), store, PATH)
    got = sorted(ts.read_documents(spark, store).collect(), key=lambda r: r.start)
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(r[0]), ids_of(r[1])) for r in rows)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    place = 0
    for r in got:
        assert (r.start, r.n_tokens) == (place, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        place += r.n_tokens
    every = [i for r in got for i in r.ids]
    asked = spark.createDataFrame([(p,) for p in (0, 1, 5, 777, place - 1, place)], "position long")
    found = {r.position: r.token for r in ts.read_tokens(spark, store, asked).collect()}
    assert found == {p: every[p] for p in (0, 1, 5, 777, place - 1)}


def test_empty(spark, docs_of):
    assert ts.op1_token_store(docs_of([]), PATH).count() == 0


def made_up(n, seed):
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzé"))
    return ["".join(letters[rng.integers(0, 27, 8)]) for _ in range(n)]


def test_words_are_remembered_in_little_memory():
    words = made_up(60_000, 1)
    ts.WordEncoder(PATH).encode(["some words, before measuring"])
    own = ts.WordEncoder(PATH)
    tracemalloc.start()
    before = pa.total_allocated_bytes() + tracemalloc.get_traced_memory()[0]
    for k in range(0, len(words), 1000):
        own.encode([" ".join(words[k:k + 1000])])
    gc.collect()
    held = pa.total_allocated_bytes() + tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert len(own.words) > 50_000
    assert held / len(own.words) < 100


def test_words_that_end_in_a_comma_or_full_stop_are_learnt_once(monkeypatch):
    sent = []
    plain = ts.WordEncoder._ids
    monkeypatch.setattr(ts.WordEncoder, "_ids", lambda self, text: sent.append(text) or plain(self, text))
    own = ts.WordEncoder(PATH)
    words = made_up(500, 2)
    texts = ["so " + " ".join(words), "so " + " ".join(w + "," for w in words), "so " + " ".join(w + "." for w in words)]
    del sent[:]
    assert [np.frombuffer(g, "<u4").tolist() + [0] for g in own.encode(texts)] == [ids_of(t) for t in texts]
    assert sum(map(len, sent)) < 1.2 * len(texts[0])


def test_parts_of_texts():
    for sizes in ([], [0], [5, 5, 5], [40, 1, 1], [1, 40, 1], [10, 10, 1], [0, 0, 0]):
        texts = ["x" * n for n in sizes]
        parts = [texts[s] for s in ts._parts(texts, 20)]
        assert sum(parts, []) == texts
        assert all(p and (len(p) == 1 or sum(map(len, p)) <= 20) for p in parts)


LINES = st.sampled_from([" ", "a", "was", "é", ",", ".", "\n", "\t", "\x85", "\xa0", "1", "'s", "ⅷ", "ª", "ǅ", "𝒜",
                         "the", "word,", "end.", "end.,", "́"])


@given(st.lists(st.lists(LINES, max_size=20).map("".join), min_size=1, max_size=8))
@settings(max_examples=200, deadline=None)
def test_lines_and_tails(texts):
    own = ts.encoder(PATH)
    assert [np.frombuffer(g, "<u4").tolist() + [0] for g in own.encode(texts)] == [ids_of(t) for t in texts]


def test_cache_that_overflows_between_texts(monkeypatch):
    monkeypatch.setattr(ts, "CACHE_WORDS", 400)
    own = ts.WordEncoder(PATH)
    for seed in range(6):
        texts = ["so it is " + ", ".join(made_up(150, seed // 2 + k)) for k in range(2)]
        assert [np.frombuffer(g, "<u4").tolist() + [0] for g in own.encode(texts)] == [ids_of(t) for t in texts]
        assert len(own.words) <= 400


def test_lines_within_a_word_are_learnt_once():
    """A line feed between two words doesn't make each pair of them a new word."""
    encoder = ts.WordEncoder(PATH)
    words = ["thesher", "Vorbieg", "año", "x1", "don't", "...", "ab,", "日本"]
    texts = ["start " + " ".join(f"{a}\n{b}" for a in words for b in words),
             "\nfeed first a\n\nb c\n d\te\nf", " ab\r\ncd ab\n", "ab.\nab. ab.\nab.\nab,\n", "\n", " \n ", "a \nb"]
    for text, got in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == PLAIN.encode(text, add_special_tokens=False).ids, text
    # each word once behind a space and once behind a line feed; 64 pairs were learnt before
    assert len(encoder.words) <= 2 * len(words) + 12


def test_words_met_first_stay_when_the_cache_overflows(monkeypatch):
    monkeypatch.setattr(ts, "CACHE_WORDS", 8)
    encoder = ts.WordEncoder(PATH)
    texts = ["x alpha beta gamma delta epsilon zeta", "x one two three four", "x alpha one\nbeta five"]
    for text in texts:
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == PLAIN.encode(
            text, add_special_tokens=False).ids
        assert len(encoder.words) <= 8
    assert {"alpha", "beta", "gamma", "delta"} <= set(encoder.words.to_pylist())
