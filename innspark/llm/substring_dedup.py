"""Removal of byte strings that occur earlier in the corpus.

A byte goes if a string of ``length`` bytes that covers it also starts earlier.
Every string of that length is judged, by winnowing: of its ``GRAM``-byte grams,
the one with the least hash is the string's anchor, so equal strings have equal
anchors at equal offsets and only strings with one anchor gram need comparing.
The strings of one anchor occurrence are neighbours; they form its context.

1. One pass hashes each anchor gram and its context. Equal contexts of one chunk
   of texts are combined at once: only the earliest goes on, all strings of the
   later ones are repeats. So a passage of very many documents sends one row a
   chunk. Sorted by gram and context, equal contexts of all chunks stand together.
2. Anchor grams with more than one context have strings that agree in part. The
   first occurrence of each such context is cut from its text, and the contexts
   of one gram are compared string by string.
3. The intervals go back to their documents, which are cut and hashed.

Tasks stream sorted rows and hold one gram's contexts at most; grams with very
many are compared by a grouping on the strings' own hashes instead.

A run-length BWT of the corpus would give the same answer; the README says why
it isn't used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innspark.llm.common import written

LENGTH = 100  # bytes of a string
GRAM = 24
CHUNK = 1 << 22  # bytes that are hashed together; places in them take 24 bits
HOT = 100_000  # contexts of one gram that a task compares; more go through a grouping

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20240502).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: list[np.ndarray] = []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _totals(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running totals of a polynomial hash, and the inverse powers of its base: the
    hash of data[a:b] is (totals[b] - totals[a]) * inverse[a]."""
    if not _powers or len(_powers[0]) <= len(data):
        size = max(len(data) + 1, 2 * CHUNK)
        _powers[:] = [np.concatenate([np.ones(1, _U), np.multiply.accumulate(
            np.full(size, b, dtype=_U))]) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    totals = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(_BYTES[data] * _powers[0][:len(data)], out=totals[1:])
    return totals, _powers[1]


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def _anchors(pieces: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(piece, first string's start, strings, gram hash, context hash) of each anchor."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    none = (np.zeros(0, np.int64),) * 5
    if len(data) < length:
        return none
    sizes = np.array([len(p) for p in pieces])
    offset = np.cumsum(sizes) - sizes
    totals, inverse = _totals(data)
    grams = _mix((totals[gram:] - totals[:-gram]) * inverse[:len(data) - gram + 1])
    # the least hash in each string, by doubling; its place is in the low bits, so
    # the first of equal grams is taken
    least = (grams >> _U(24) << _U(24)) | np.arange(len(grams), dtype=_U)
    width, reach = 1, length - gram + 1
    while 2 * width <= reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < reach:
        least = np.minimum(least[:width - reach], least[reach - width:])
    piece = np.repeat(np.arange(len(pieces)), sizes)[:len(least)]
    start = np.flatnonzero(np.arange(length, len(data) + 1) <= (offset + sizes)[piece])
    if not len(start):
        return none
    anchor, piece = (least[start] & _U(0xFFFFFF)).astype(np.int64), piece[start]
    new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(piece, prepend=-1) != 0))
    first, last = start[new], start[np.append(new[1:], len(start)) - 1]
    shape = ((last - first) * 4096 + anchor[new] - first).astype(_U) * _U(0x632BE59BD9B4E019)
    context = _mix((totals[last + length] - totals[first]) * inverse[first] + shape)
    return (piece[new], first - offset[piece[new]], last - first + 1,
            grams[anchor[new]].view(np.int64), context.view(np.int64))


def _describe(length: int, gram: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            docs, starts, pieces, size = [], [], [], 0
            # a long text is hashed in chunks that overlap by a string less a byte:
            # each string lies in one of them
            for doc, text in zip(batch["doc_id"], batch["text"]):
                raw = _bytes(text)
                for at in range(0, max(1, len(raw) - length + 1), CHUNK):
                    docs.append(doc)
                    starts.append(at)
                    pieces.append(raw[at:at + CHUNK + length - 1])
                    size += len(pieces[-1])
                    if size >= CHUNK:
                        yield out(docs, starts, pieces)
                        docs, starts, pieces, size = [], [], [], 0
            if pieces:
                yield out(docs, starts, pieces)

    def out(docs: list[int], starts: list[int], pieces: list[bytes]) -> pd.DataFrame:
        with np.errstate(over="ignore"):
            piece, first, count, key, context = _anchors(pieces, length, gram)
        doc, first = np.array(docs)[piece], np.array(starts)[piece] + first
        order, new, gone = _later(key, context, doc, first)
        keep, spans = order[new], _spans(doc[gone], first[gone], (first + count - 1 + length)[gone])
        none = np.zeros(len(spans[0]), dtype=np.int64)
        return pd.DataFrame({
            "gone": np.arange(len(keep) + len(none)) >= len(keep),
            "gram": np.concatenate([key[keep], none]), "context": np.concatenate([context[keep], none]),
            "doc_id": np.concatenate([doc[keep], spans[0]]),
            "first": np.concatenate([first[keep], spans[1]]),
            "end": np.concatenate([(first + count - 1 + length)[keep], spans[2]])})

    return run


def _later(gram: np.ndarray, context: np.ndarray, doc: np.ndarray, first: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by context, gram and place; which rows in it are the earliest of their
    context; and the rows, unordered, that stand at another place than the earliest."""
    order = np.lexsort((first, doc, gram, context))
    gram, context, doc, first = gram[order], context[order], doc[order], first[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (context[1:] != context[:-1]) | (gram[1:] != gram[:-1])
    at = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    return order, new, order[(doc != doc[at]) | (first != first[at])]


def _spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals of one document that touch, joined."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    other = np.ones(len(doc), dtype=bool)
    other[1:] = doc[1:] != doc[:-1]
    # the furthest end so far in the document: its texts may differ, if its id repeats
    shift = np.cumsum(other) * (end.max(initial=0) + 1)
    end = np.maximum.accumulate(end + shift) - shift
    new = other.copy()
    new[1:] |= start[1:] > end[:-1]
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(doc))[:len(begin)] - 1
    return doc[begin], start[begin], end[last]


def _judge():
    """Intervals found before, then rows sorted by gram, context and place: an interval for
    each occurrence of a context after its first (no gram), and the first ones of grams
    with several."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = (None, None)  # gram and context of the row before
        place = (0, 0)  # its context's first occurrence
        seen, held = 0, None  # contexts of its gram; the only one so far
        for batch in batches:
            found = batch["gone"].to_numpy()
            if found.any():
                yield pd.DataFrame({
                    "gram": pd.array(np.zeros(found.sum(), np.int64), dtype="Int64"), "ask": False,
                    "doc_id": batch["doc_id"].to_numpy()[found],
                    "start": batch["first"].to_numpy()[found], "end": batch["end"].to_numpy()[found]})
                batch = batch[~found]
            if not len(batch):
                continue
            gram, context, doc, first, end = (batch[c].to_numpy() for c in (
                "gram", "context", "doc_id", "first", "end"))
            new_gram = np.ones(len(gram), dtype=bool)
            new_gram[1:] = gram[1:] != gram[:-1]
            new_gram[0] = last[0] is None or gram[0] != last[0]
            new = new_gram.copy()
            new[1:] |= context[1:] != context[:-1]
            new[0] |= last[1] is None or context[0] != last[1]
            # the first occurrence of each row's context
            at = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
            doc0 = np.where(at >= 0, doc[np.maximum(at, 0)], place[0])
            first0 = np.where(at >= 0, first[np.maximum(at, 0)], place[1])
            gone = ~new & ((doc != doc0) | (first != first0))
            # contexts of each gram; group 0 goes on from the batch before
            group = np.cumsum(new_gram)
            contexts = np.bincount(group, new, minlength=group[-1] + 1).astype(np.int64)
            if seen == 1 and contexts[0]:
                yield held
            contexts[0] += seen
            ask = new & (contexts[group] > 1)
            rows = gone | ask
            if rows.any():
                yield pd.DataFrame({
                    "gram": pd.array(np.where(ask, gram, 0)[rows], dtype="Int64"),
                    "ask": ask[rows], "doc_id": doc[rows], "start": first[rows],
                    "end": end[rows]})
            seen = int(contexts[-1])
            k = int(at[-1])
            if seen == 1 and k >= 0:
                held = pd.DataFrame({"gram": pd.array(gram[k:k + 1], dtype="Int64"), "ask": [True],
                                     "doc_id": doc[k:k + 1], "start": first[k:k + 1],
                                     "end": end[k:k + 1]})
            last, place = (gram[-1], context[-1]), (int(doc0[-1]), int(first0[-1]))

    return run


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"],
                            "packed": [pack.compress(_bytes(t)) for t in batch["text"]]})


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(bytes(packed))


def _cut(length: int):
    """The bytes of the asked contexts; for hot grams a row for each string's hash."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for doc, packed, asks in zip(batch["doc_id"], batch["packed"], batch["asks"]):
                raw = _unpack(packed)
                for x in asks:
                    part = raw[x["start"]:x["end"]]
                    if len(part) < length:
                        continue  # another text under this doc_id
                    if not x["hot"]:
                        out.append((x["gram"], doc, x["start"], part))
                    else:
                        hashes = _strings(np.frombuffer(part, np.uint8), length)
                        out += [(int(h), doc, x["start"] + k, None) for k, h in enumerate(hashes)]
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=["key", "doc_id", "start", "part"])
                    out = []
            if out:
                yield pd.DataFrame(out, columns=["key", "doc_id", "start", "part"])

    return run


def _strings(data: np.ndarray, length: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        totals, inverse = _totals(data)
        return _mix((totals[length:] - totals[:-length]) * inverse[:len(data) - length + 1]
                    ).view(np.int64)


def _runs(doc: np.ndarray, start: np.ndarray, length: int) -> pd.DataFrame:
    """Intervals of bytes from the starts of repeated strings."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(doc))[:len(begin)] - 1
    return pd.DataFrame({"doc_id": doc[begin], "start": start[begin], "end": start[last] + length})


def _compare(length: int):
    """Rows (key, doc_id, start, part) sorted by key: intervals of later strings."""
    def repeats(rows: pd.DataFrame) -> pd.DataFrame:
        parts = rows["part"].tolist()
        sizes = np.array([len(p) for p in parts])
        data = np.frombuffer(b"".join(parts), np.uint8)
        offset = np.cumsum(sizes) - sizes
        hashes = _strings(data, length)
        count = sizes - length + 1
        own = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        hashes = hashes[np.repeat(offset, count) + own]
        key, doc = (np.repeat(rows[c].to_numpy(), count) for c in ("key", "doc_id"))
        start = np.repeat(rows["start"].to_numpy(), count) + own
        order = np.lexsort((start, doc, hashes, key))
        key, hashes, doc, start = key[order], hashes[order], doc[order], start[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (hashes[1:] != hashes[:-1])
        at = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        gone = (doc != doc[at]) | (start != start[at])
        return _runs(doc[gone], start[gone], length)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.iloc[at:at + 2000]
                held.append(part)
                size += int(part["part"].map(len).sum())
                if size < CHUNK:
                    continue
                rows = pd.concat(held)
                open_ = rows["key"] == rows["key"].iloc[-1]
                if not open_.all():
                    yield repeats(rows[~open_])
                    rows = rows[open_]
                held, size = [rows], int(rows["part"].map(len).sum())
        if held:
            yield repeats(pd.concat(held))

    return run


def _finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for packed, spans in zip(batch["packed"], batch["spans"]):
            raw = _unpack(packed)
            merged: list[list[int]] = []
            for x in sorted((s["start"], min(s["end"], len(raw))) for s in spans) \
                    if spans is not None else ():
                if x[0] >= len(raw):
                    continue
                if merged and x[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], x[1])
                else:
                    merged.append(list(x))
            kept, at = [], 0
            for a, b in merged:
                kept.append(raw[at:a])
                at = b
            kept = b"".join([*kept, raw[at:]])
            out.append((len(raw), merged, kept, hashlib.sha256(kept).hexdigest()))
        yield pd.DataFrame({
            "doc_id": batch["doc_id"], "n_bytes": [x[0] for x in out],
            "spans": [[{"start": a, "end": b} for a, b in x[1]] for x in out],
            "kept_sha256": [x[3] for x in out]} | (
                {"kept": [x[2] for x in out]} if "want" in batch else {}))


def repeated_strings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT
                     ) -> DataFrame:
    """(doc_id, start, end): byte intervals of ``docs`` (doc_id, text) covered by strings
    of ``length`` bytes that start earlier too: in a document with a smaller doc_id, or
    before in the same one. They can overlap. Rows without doc_id take no part."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    anchors = docs.mapInPandas(_describe(length, gram), "gone boolean, gram long, context long, "
                               "doc_id long, first long, end long")
    # intervals that are found already have no gram: they are spread by their place
    key = F.when(F.col("gone"), F.xxhash64("doc_id", "first")).otherwise(F.col("gram"))
    judged = written(anchors.repartition(key)
                     .sortWithinPartitions(F.col("gone").desc(), "gram", "context", "doc_id", "first")
                     .mapInPandas(_judge(), "gram long, ask boolean, doc_id long, start long, end long"),
                     "judged")
    asks = judged.where("ask").select("gram", "doc_id", "start", "end")
    busy = asks.groupBy("gram").count().where(F.col("count") > hot).select("gram", F.lit(True).alias("hot"))
    per_doc = (asks.join(busy, "gram", "left").groupBy("doc_id").agg(F.collect_set(F.struct(
        "gram", "start", "end", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("asks")))
    packed = docs.mapInPandas(_packed, "doc_id long, packed binary")
    parts = written(packed.join(per_doc, "doc_id").mapInPandas(
        _cut(length), "key long, doc_id long, start long, part binary"), "parts")
    cold = (parts.where("part is not null").repartition("key")
            .sortWithinPartitions("key", "doc_id", "start")
            .mapInPandas(_compare(length), "doc_id long, start long, end long"))
    strings = parts.where("part is null").select("key", "doc_id", "start")
    firsts = strings.groupBy("key").agg(F.min(F.struct("doc_id", "start")).alias("place"))
    later = (strings.join(firsts, "key").where(F.struct("doc_id", "start") > F.col("place"))
             .select("doc_id", "start", (F.col("start") + length).alias("end")))
    return written(judged.where("not ask").select("doc_id", "start", "end").union(cold).union(later),
                   "intervals")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT,
                   keep_bytes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, spans, kept_sha256[, kept]) for every row of ``docs``.

    ``spans`` are the maximal removed runs of the text's UTF-8 bytes, ``kept`` the
    bytes that remain. Null or empty text is empty; texts shorter than ``length``
    stay whole. A row without doc_id is kept whole and removes nothing elsewhere.
    Rows that repeat a doc_id are one document: a string at the same start isn't
    earlier, and what one of them loses the others lose. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = repeated_strings(docs, length, gram, hot).groupBy("doc_id").agg(
        F.collect_set(F.struct("start", "end")).alias("spans"))
    packed = docs.mapInPandas(_packed, "doc_id long, packed binary")
    if keep_bytes:
        packed = packed.withColumn("want", F.lit(True))
    return packed.join(spans, "doc_id", "left").mapInPandas(
        _finish, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, "
        "kept_sha256 string" + ", kept binary" * keep_bytes)


def op8_substrings(docs: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return remove_repeats(docs, keep_bytes=False).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256")
