"""Token store of directly addressable codes.

Each segment holds whole documents in ascending doc_id order. Its ids are cut
into 8-bit chunks: level 0 has the lowest chunk of every id, level 1 the next
chunk of those ids that have one, and so on. A bitmap for each level marks the
ids that continue, and a rank directory (set bits before each 512-bit block)
turns a position of one level into that of the next. Any token is read with
one byte access and at most one block's popcount for each level; nothing else
of the segment is decoded.

A store is a folder with two Parquet tables: ``segments`` (shard, seg, first,
n_tokens, doc_ids, lengths, codes) and ``shards`` (shard, base, n_tokens). Both
are written by Spark's committer, so a lost executor's tasks are simply redone:
range bounds, order and ids don't depend on which attempt wrote them.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innspark.llm.common import scratch, worker_cache

MAGIC = b"DAC1"
SEGMENTS = ("shard int, seg int, first long, n_tokens long, doc_ids array<long>, "
            "lengths array<long>, codes binary")
SHARDS = "shard int, base long, n_tokens long"
BLOCK = 512  # bits of a rank block
SEGMENT_TOKENS = 1 << 18  # a segment is closed at this size, after a whole document
CACHE_WORDS = 600_000  # words of which a worker remembers the ids
PART_CHARS = 6 << 20  # of texts that are encoded together
TAILS = ",."  # cut off behind letters: the word with and without one is learnt once
LEARNT = 100  # words that the library encodes in one text


# --- directly addressable codes -------------------------------------------------

def encode_codes(ids: np.ndarray) -> bytes:
    """The ids (unsigned, 32 bits) as directly addressable codes."""
    levels, rest = [], np.asarray(ids, dtype=np.uint32)
    while True:
        more = rest > 0xFF
        levels.append(((rest & 0xFF).astype(np.uint8), more))
        if not more.any():
            break
        rest = rest[more] >> 8
    out = [MAGIC, struct.pack("<II", len(levels), len(ids))]
    for chunk, more in levels:
        bits = np.packbits(more, bitorder="little")
        ranks = np.zeros(-(-len(more) // BLOCK), dtype="<u4")
        if len(ranks) > 1:
            ranks[1:] = np.cumsum(np.add.reduceat(more, np.arange(0, len(more), BLOCK),
                                                  dtype=np.int64))[:-1]
        out += [struct.pack("<I", len(chunk)), chunk.tobytes(), bits.tobytes(), ranks.tobytes()]
    return b"".join(out)


def _levels(codes: bytes) -> list[tuple[int, int, int, int]]:
    """(count, place of chunks, of the bitmap, of the rank directory) by level."""
    if codes[:4] != MAGIC:
        raise ValueError("not a segment of directly addressable codes")
    n_levels, _ = struct.unpack_from("<II", codes, 4)
    at, out = 12, []
    for _ in range(n_levels):
        (count,) = struct.unpack_from("<I", codes, at)
        chunk, bits = at + 4, at + 4 + count
        ranks = bits + -(-count // 8)
        out.append((count, chunk, bits, ranks))
        at = ranks + 4 * -(-count // BLOCK)
    return out


def access(codes: bytes, i: int) -> int:
    """Token ``i`` of a segment, by rank; no block is decoded."""
    levels, value = _levels(codes), 0
    if not 0 <= i < levels[0][0]:
        raise IndexError(i)
    for k, (_, chunk, bits, ranks) in enumerate(levels):
        value |= codes[chunk + i] << (8 * k)
        if not codes[bits + i // 8] >> (i % 8) & 1:
            break
        (before,) = struct.unpack_from("<I", codes, ranks + 4 * (i // BLOCK))
        start = i // BLOCK * BLOCK
        own = int.from_bytes(codes[bits + start // 8: bits + i // 8 + 1], "little")
        i = before + (own & ((1 << (i - start)) - 1)).bit_count()
    return value


def decode_codes(codes: bytes) -> np.ndarray:
    """All ids of a segment."""
    ids = None
    for count, chunk, bits, _ in reversed(_levels(codes)):
        value = np.frombuffer(codes, np.uint8, count, chunk).astype(np.uint32)
        if ids is not None:
            more = np.unpackbits(np.frombuffer(codes, np.uint8, -(-count // 8), bits),
                                 count=count, bitorder="little").astype(bool)
            value[more] |= ids << 8
        ids = value
    return ids


# --- tokenizing -----------------------------------------------------------------

class WordEncoder:
    """Ids of whole texts through the tokenizers library, remembered by word.

    A byte-level BPE vocabulary splits a text into pieces before merging, and a
    space before a character that isn't white space always starts one. So a
    text falls into parts that begin with such a space, and the library encodes
    each part once. Which characters are white space or letters the library itself
    says, and a line feed between two parts shows where a part's ids begin. Texts
    with a part that can't be told apart so, and those with an added token's
    string, go to the library whole.

    Arrow numbers the parts of many texts and looks up those met before; numpy puts
    the ids together. Only a new part passes through Python.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = pa.array([], pa.large_string())  # met before, and lines behind a line feed
        self.ids = np.zeros(0, np.uint32)  # those of a space and each word, one after another
        self.sizes = np.zeros(0, np.int64)  # ids of each word
        self.opening: dict[str, bool] = {}  # by character: a space before it starts a piece
        self.letters: dict[str, bool] = {}  # by character: it continues a piece of letters
        feed = self._ids("\n")
        self.feed = feed[0] if len(feed) == 1 else -1
        plan = json.loads(self.tokenizer.to_str())
        split = plan["pre_tokenizer"] or {}
        # whether letters and what stands behind them are different pieces
        self.pieces = (plan["normalizer"] is None and split.get("type") == "ByteLevel"
                       and split.get("use_regex", True))
        tails = [self._ids(c) for c in TAILS]
        self.tails = [int(t[0]) if len(t) == 1 else -1 for t in tails]

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _opens(self, char: str) -> bool:
        """Whether the library starts a piece at a space before ``char``: other white
        space and the space are two pieces then, and one with more white space."""
        if char not in self.opening:
            e = self.tokenizer.encode("\n " + char, add_special_tokens=False)
            self.opening[char] = len(set(e.word_ids)) == 2
        return self.opening[char]

    def _letter(self, char: str) -> bool:
        """Whether the library has ``char`` and letters around it as one piece, and
        starts another behind it at each of TAILS."""
        if char not in self.letters:
            one = self.tokenizer.encode(f" a{char}a", add_special_tokens=False)
            more = [self.tokenizer.encode(f"{s}{char}{c}", add_special_tokens=False) for c in TAILS for s in (" ", "")]
            self.letters[char] = len(set(one.word_ids)) == 1 and all(len(set(e.word_ids)) == 2 for e in more)
        return self.letters[char]

    def _stems(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Each word without the one of TAILS that stands behind letters, and that one's
        place in TAILS or -1."""
        tail = np.full(len(words), -1, np.int64)
        if not self.pieces or not len(words):
            return words, tail
        stems = pc.utf8_rtrim(words, TAILS)
        cut = pc.and_(pc.equal(pc.subtract(pc.binary_length(words), pc.binary_length(stems)), 1),
                      pc.utf8_is_alpha(stems))
        for c in set("".join(stems.filter(cut).to_pylist())):
            if not self._letter(c):
                cut = pc.and_(cut, pc.invert(pc.match_substring(stems, c)))
        for k, c in enumerate(TAILS):
            if self.tails[k] >= 0:
                tail[pc.and_(cut, pc.ends_with(words, c)).to_numpy(zero_copy_only=False)] = k
        return pc.if_else(pa.array(tail >= 0), stems, words), tail

    def _sure(self, lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Whether each line begins with what the library starts a piece at behind a space,
        and whether it ends so, too. An empty line doesn't."""
        first, last = (pc.utf8_slice_codeunits(lines, *at).dictionary_encode() for at in ((0, 1), (-1,)))
        first, last = (np.array([c != "" and self._opens(c) for c in x.dictionary.to_pylist()], bool)[
            x.indices.to_numpy()] for x in (first, last))
        return first, first & last

    def _learn(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each key, one key after another, and how many each has. A key is a word,
        with a space before it, or a line feed and the line behind it."""
        later = pc.starts_with(keys, "\n").to_numpy(zero_copy_only=False)
        _, sure = self._sure(keys)
        sure &= ~pc.match_substring(keys, "\n").to_numpy(zero_copy_only=False)
        sure |= later
        # each after a line feed, the words after a space
        lines = pc.if_else(pa.array(later), keys, _joined("\n ", keys))
        sizes = np.zeros(len(keys), np.int64)
        found = []
        places, alone = np.flatnonzero(sure), np.flatnonzero(~sure)
        plain = lines.take(pa.array(places))
        cuts = np.append(np.arange(0, len(places), LEARNT), len(places))
        texts = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(cuts), plain), pa.scalar("", plain.type)).to_pylist()
        for a, b, text in zip(cuts.tolist(), cuts[1:].tolist(), texts):
            ids, sizes[places[a:b]] = self._between(text[1:], plain[a:b])
            found.append(ids)
        for k, line in zip(alone.tolist(), lines.take(pa.array(alone)).to_pylist()):
            found.append(self._ids(line[1:]))
            sizes[k] = len(found[-1])
        ids = np.concatenate(found) if found else self.ids[:0]
        order = np.concatenate([places, alone])
        own = sizes[order]
        begins = np.zeros(len(keys), np.int64)
        begins[order] = np.cumsum(own) - own
        # a line feed's id goes before its line's
        at = np.cumsum(sizes) - sizes
        return np.insert(_gathered(ids, begins, sizes), at[later], self.feed), sizes + later

    def _between(self, text: str, lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each of the ``lines`` that ``text`` joins, without their line feeds, and
        how many each has. No line ends in white space or begins with more than a space, so a
        line feed between two is a piece."""
        ids = self._ids(text)
        at = np.flatnonzero(ids == self.feed)
        if len(at) != len(lines) - 1:
            found = [self._ids(s[1:]) for s in lines.to_pylist()]
            return np.concatenate(found), np.array([len(x) for x in found])
        return np.delete(ids, at), np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1

    def _known(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a space and each of the (different) words, and how many each has: -1 for
        a word whose beginning the library doesn't vouch for.

        Lines that neither begin nor end in white space are learnt one by one; a word with
        others is learnt whole."""
        if not len(words):
            return self.ids[:0], np.zeros(0, np.int64)
        lines = pc.split_pattern(words, "\n")
        offsets = lines.offsets.to_numpy()
        lines = lines.flatten()
        opens, closes = self._sure(lines)
        firsts = offsets[:-1]
        sure = np.logical_and.reduceat(closes, firsts)
        if self.feed < 0:
            sure &= np.diff(offsets) == 1
        alone = opens[firsts] & ~sure
        counts = np.where(sure, np.diff(offsets), alone)  # keys of each word
        later = np.ones(len(lines), bool)
        later[firsts] = False
        owner = np.repeat(np.arange(len(words)), np.diff(offsets))
        take = sure[owner] | alone[owner] & ~later
        stems, tail = self._stems(lines)
        stems = pc.if_else(pa.array(later), _joined("\n", stems), stems)
        whole = alone[owner] & ~later
        stems = pc.if_else(pa.array(whole), words.take(pa.array(owner)), stems).filter(pa.array(take))
        tail = np.where(whole, -1, tail)[take]

        coded = stems.dictionary_encode()
        stems, which = coded.dictionary, coded.indices.to_numpy()
        at = pc.index_in(stems, self.words)
        new = stems.filter(pc.is_null(at))
        at = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        at[at < 0] = len(self.words) + np.arange(len(new))
        ids, sizes = self._learn(new)
        ids, sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        begins = np.cumsum(sizes) - sizes
        known = pa.concat_arrays([self.words, new])
        if len(known) <= CACHE_WORDS:
            self.words, self.ids, self.sizes = known, ids, sizes
        else:  # those in use now, and half of the room for those met first
            kept = np.union1d(np.arange(min(CACHE_WORDS // 2, len(known))), at)
            if len(kept) <= CACHE_WORDS:
                self.words, self.sizes = known.take(pa.array(kept)), sizes[kept]
                self.ids = _gathered(ids, begins[kept], sizes[kept])
        at = at[which]
        own = sizes[at] + (tail >= 0)
        # with a tail, one id more is taken, which the tail's replaces
        out = _gathered(ids, begins[at], own)
        tailed = tail >= 0
        out[(np.cumsum(own) - 1)[tailed]] = np.array(self.tails, np.int64)[tail[tailed]]
        total = np.concatenate([[0], np.cumsum(own)])[np.concatenate([[0], np.cumsum(counts)])]
        return out, np.where(sure | alone, np.diff(total), -1)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        column = pa.array(texts, pa.large_string())
        split = pc.split_pattern(column, " ")
        offsets = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        codes, firsts = coded.indices.to_numpy().astype(np.int64), offsets[:-1]
        heads = coded.dictionary.take(pa.array(codes[firsts])).to_pylist()
        # a word that stands only at a text's beginning has no space before it
        behind = np.ones(len(codes), bool)
        behind[firsts] = False
        used = np.flatnonzero(np.bincount(codes[behind], minlength=len(coded.dictionary)))
        place = np.zeros(len(coded.dictionary), np.int64)
        place[used] = np.arange(len(used))
        codes = place[codes]
        ids, sizes = self._known(coded.dictionary.take(pa.array(used)))
        owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
        whole = np.zeros(len(texts), bool)
        for a in self.added:
            whole |= pc.match_substring(column, a).to_numpy(zero_copy_only=False)
        whole[owner[np.append(sizes < 0, False)[codes] & behind]] = True
        own = [t if w else h for t, h, w in zip(texts, heads, whole.tolist())]
        own = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(own, add_special_tokens=False)]
        n = len(sizes)
        sizes = np.concatenate([np.maximum(sizes, 0), [0], [len(x) for x in own]]).astype(np.int64)
        ids = np.concatenate([ids, *own]).astype(np.uint32)
        codes[whole[owner]] = n
        codes[firsts] = n + 1 + np.arange(len(texts))
        counts = sizes[codes]
        return (_gathered(ids, (np.cumsum(sizes) - sizes)[codes], counts),
                np.diff(np.concatenate([[0], np.cumsum(counts)])[offsets]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if not texts:
            return []
        ids, sizes = self.encode_all(texts)
        return [ids[b - n:b].astype("<u4").tobytes() for b, n in zip(np.cumsum(sizes), sizes)]


def _joined(before: str, words: pa.Array) -> pa.Array:
    """``words`` with ``before`` in front of each."""
    kind = words.type
    return pc.binary_join_element_wise(pa.scalar(before, kind), words, pa.scalar("", kind))


def _gathered(ids: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` that begin at ``begins``, one after another; an end beyond the
    last id takes the last."""
    total = int(sizes.sum())
    if not total:
        return ids[:0]
    shift = (begins - (np.cumsum(sizes) - sizes)).astype(np.int32 if len(ids) + total < 1 << 31 else np.int64)
    at = np.repeat(shift, sizes)
    at += np.arange(total, dtype=at.dtype)
    return ids.take(at, mode="clip")


def encoder(path: str) -> WordEncoder:
    """One encoder for each vocabulary and Python worker."""
    return worker_cache(("encoder", path), lambda: WordEncoder(path))


# --- writing and reading a store --------------------------------------------------

def _parts(texts: list[str], most: int = PART_CHARS) -> Iterator[slice]:
    """Cuts ``texts`` into runs of ``most`` characters or less; a longer text is one of its own."""
    at, size = 0, 0
    for k, t in enumerate(texts):
        if k > at and size + len(t) > most:
            yield slice(at, k)
            at, size = k, 0
        size += len(t)
    if at < len(texts):
        yield slice(at, len(texts))


def _segments(path: str, end_id: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, seg, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, lengths, held = [], [], []
        end = np.array([end_id], dtype="<u4")

        def close() -> pd.DataFrame:
            return pd.DataFrame({"shard": [shard], "seg": [seg], "first": [first], "n_tokens": [sum(lengths)],
                                 "doc_ids": [list(doc_ids)], "lengths": [list(lengths)],
                                 "codes": [encode_codes(np.concatenate(held))]})

        size = 0
        for batch in batches:
            texts, docs = batch["text"].tolist(), batch["doc_id"].tolist()
            for part in _parts(texts):
                ids, counts = encoder(path).encode_all(texts[part])
                ends = np.cumsum(counts)
                for doc, b, n in zip(docs[part], ends.tolist(), counts.tolist()):
                    doc_ids.append(None if pd.isna(doc) else int(doc))
                    lengths.append(n + 1)
                    held += [ids[b - n:b], end]
                    size += n + 1
                    if size >= SEGMENT_TOKENS:
                        yield close()
                        seg, first, size = seg + 1, first + size, 0
                        doc_ids, lengths, held = [], [], []
        if doc_ids:
            yield close()

    return run


def write_store(docs: DataFrame, store: str, tokenizer: str, end_id: int = 0) -> None:
    """Write the token ids of ``docs`` (doc_id, text) to the folder ``store``.

    Every text is encoded whole and ends with ``end_id``. Documents follow one
    another in ascending doc_id order over the shards; rows without doc_id come
    first, rows that repeat a doc_id in the order of their texts. Null text is
    empty. Other columns are ignored; an empty table gives an empty store.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    # repeated ids fall apart by their text, so no key can fill a shard
    ranged = (docs.withColumn("th", F.xxhash64("text")).repartitionByRange("doc_id", "th")
              .sortWithinPartitions("doc_id", "th", "text").drop("th"))
    ranged.mapInPandas(_segments(tokenizer, end_id), SEGMENTS).write.parquet(f"{store}/segments")
    segments = spark.read.schema(SEGMENTS).parquet(f"{store}/segments")
    # one row for each write task: its count is that of the shuffle partitions
    sizes = sorted((r["shard"], r["n"]) for r in
                   segments.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    rows, base = [], 0
    for shard, n in sizes:
        rows.append((shard, base, n))
        base += n
    spark.createDataFrame(rows, SHARDS).coalesce(1).write.parquet(f"{store}/shards")


def _read(spark: SparkSession, store: str) -> DataFrame:
    shards = spark.read.schema(SHARDS).parquet(f"{store}/shards").select("shard", "base")
    return (spark.read.schema(SEGMENTS).parquet(f"{store}/segments")
            .join(F.broadcast(shards), "shard")
            .withColumn("start", F.col("base") + F.col("first")))


def read_documents(spark: SparkSession, store: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of each document, from the files."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start, docs, lengths, codes in zip(batch["start"], batch["doc_ids"],
                                                   batch["lengths"], batch["codes"]):
                tokens = decode_codes(codes).astype("<u4")
                ends = np.cumsum(lengths)
                cut = [tokens[b - n:b] for b, n in zip(ends, lengths)]
                out = {"doc_id": pd.array(list(docs), dtype="Int64"), "start": start + ends - lengths,
                       "n_tokens": lengths, "ids_crc32": [zlib.crc32(c.tobytes()) for c in cut]}
                yield pd.DataFrame(out | ({"ids": [c.tolist() for c in cut]} if ids else {}))

    return _read(spark, store).select("start", "doc_ids", "lengths", "codes").mapInPandas(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids)


def read_tokens(spark: SparkSession, store: str, positions: DataFrame) -> DataFrame:
    """(position, token) for the ``positions`` (position long) that the store has:
    random access by rank, without decoding segments."""
    @F.udf("long")
    def one(codes: bytes, i: int) -> int:
        return access(bytes(codes), i)

    return (_read(spark, store)
            .join(positions.select("position"), (F.col("position") >= F.col("start"))
                  & (F.col("position") < F.col("start") + F.col("n_tokens")))
            .select("position", one("codes", F.col("position") - F.col("start")).alias("token")))


def op1_token_store(docs: DataFrame, tokenizer: str) -> DataFrame:
    store = scratch(docs.sparkSession, "tokens")
    write_store(docs, store, tokenizer)
    return read_documents(docs.sparkSession, store, ids=False)
