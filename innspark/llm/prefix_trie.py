"""Prefix trie of conversations from padded turn-id matrices.

A conversation becomes the string of its turns' digests; equal prefixes are equal
string prefixes. The strings are range-partitioned and sorted, copies by conv_id, so
that a trie node is one contiguous run of rows and a hot prefix or a large group of
copies is spread over as many ranges as its size needs.

A task reads its range in chunks. A chunk is a padded matrix of turn ids: numpy's
lexsort orders it, OR-accumulated masks of column changes mark where each depth's
nodes start, and reduceat sums rows and turns to nodes. Nodes inside a chunk are
final. Those on the path of its first or last row (the chains) may go on in the next
chunk: they are merged in order on a stack, first over a task's chunks, then over the
ranges, FAN of them a task, until one range is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innspark.llm.common import written

CELLS = 1 << 20  # turns of a padded matrix; a longer conversation is alone in one
FAN = 512  # ranges whose chains one task merges
IDS_BYTES = 1 << 20  # member ids that an open node holds before they are written
RECORD = 24  # bytes of a turn: 16 of its digest, 8 of its text's length
SMALL_PARENTS = 200_000  # rows of some 40 bytes

OUT = ("kind string, shard int, seq long, conv_id long, depth int, key binary, pkey binary, digest binary, "
       "n_convs long, n_children long, n_leaves long, saved_tokens long, size long, ids binary, split boolean")
ARROW = pa.schema([
    ("kind", pa.string()), ("shard", pa.int32()), ("seq", pa.int64()), ("conv_id", pa.int64()),
    ("depth", pa.int32()), ("key", pa.binary()), ("pkey", pa.binary()), ("digest", pa.binary()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("size", pa.int64()), ("ids", pa.binary()), ("split", pa.bool_())])


def turn_record() -> Column:
    """Hex of a turn's digest over (role, text) and of its text's UTF-8 length."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return F.concat(
        F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32),
        F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0"))


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns: array of records) in turn order, null first; turns of one number
    are ordered by digest. Rows without conv_id belong to no conversation."""
    return (turns.where("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_record().alias("record"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "record"))).alias("turns"))
            .select("conv_id", F.col("turns.record").alias("turns")))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Each conversation c after the first h turns of conversation c - c % 5, with its own
    turns after its first h; h is crc32 of c in decimal, modulo 9."""
    heads = convs.where("conv_id % 5 = 0").select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("head"))
    h = F.crc32(F.col("conv_id").cast("string")) % 9
    whole = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(heads, "base", "left")
    own = F.filter("turns", lambda x, i: i >= h)
    head = F.filter(F.coalesce("head", F.array().cast("array<string>")), lambda x, i: i < h)
    return whole.select("conv_id", F.concat(head, own).alias("turns"))


class _Node:
    __slots__ = ("depth", "digest", "key", "pkey", "n", "conv", "children", "leaves", "saved", "size", "ids", "split", "left")

    def __init__(self, depth, digest, key, pkey, n, conv, children, leaves, saved, size, ids, split, left):
        self.depth, self.digest, self.key, self.pkey = depth, digest, key, pkey
        self.n, self.conv, self.children, self.leaves, self.saved = n, conv, children, leaves, saved
        self.size, self.ids, self.split, self.left = size, ids, split, left


class _Rows:
    """Output rows, given out as Arrow batches."""

    def __init__(self):
        self.lists = {f.name: [] for f in ARROW}

    def add(self, **values) -> None:
        for name, rows in self.lists.items():
            rows.append(values.get(name))

    def batch(self) -> pa.RecordBatch:
        arrays = [pa.array(self.lists[f.name], f.type) for f in ARROW]
        self.lists = {f.name: [] for f in ARROW}
        return pa.RecordBatch.from_arrays(arrays, schema=ARROW)

    def __len__(self) -> int:
        return len(self.lists["kind"])


class _Merge:
    """Joins partial nodes that come in pre-order, range after range.

    Nodes of the first range's first path stay open to the left, unless the range is
    the whole; what remains on the stack at the end is open to the right."""

    def __init__(self, rows: _Rows, shard: int, whole: bool):
        self.rows, self.shard, self.whole = rows, shard, whole
        self.stack: list[_Node] = []
        self.edge: list[_Node] = []  # open to the left, in order of depth
        self.inside = False  # a path other than the first one has begun

    def push(self, x: _Node) -> None:
        if x.depth < len(self.stack):
            top = self.stack[x.depth]
            if top.digest == x.digest:
                top.n, top.conv = top.n + x.n, min(top.conv, x.conv)
                top.children, top.leaves = top.children + x.children, top.leaves + x.leaves
                top.saved, top.split = top.saved + x.saved, top.split or x.split
                top.ids = b",".join(p for p in (top.ids, x.ids) if p)
                self._flush(top, IDS_BYTES)
                return
            self._close(x.depth)
            self.inside = True
        x.left = not self.whole and not self.inside
        if x.left:
            self.edge.append(x)
        self.stack.append(x)
        self._flush(x, IDS_BYTES)

    def _flush(self, x: _Node, beyond: int) -> None:
        if len(x.ids) > beyond:
            self.rows.add(kind="ids", key=x.key, seq=int(x.ids.split(b",", 1)[0]), ids=x.ids)
            x.ids, x.split = b"", True

    def _close(self, depth: int) -> None:
        while len(self.stack) > depth:
            x = self.stack.pop()
            if x.left:
                continue
            x.leaves += x.children == 0
            x.saved += (x.n - 1) * x.size
            if self.stack:
                up = self.stack[-1]
                up.children, up.leaves, up.saved = up.children + 1, up.leaves + x.leaves, up.saved + x.saved
            if x.split:
                self._flush(x, 0)
            self.rows.add(kind="node", conv_id=x.conv, depth=x.depth, key=x.key, pkey=x.pkey, n_convs=x.n,
                          n_children=x.children, n_leaves=x.leaves, saved_tokens=x.saved,
                          ids=None if x.split else hashlib.sha256(x.ids).hexdigest().encode(), split=x.split)

    def end(self) -> None:
        """Closes all, or writes the chains: the first path, then the last one below it."""
        if self.whole:
            return self._close(0)
        for seq, x in enumerate([*self.edge, *(x for x in self.stack if not x.left)]):
            self._flush(x, 0)
            self.rows.add(kind="chain", shard=self.shard, seq=seq, conv_id=x.conv, depth=x.depth, key=x.key,
                          pkey=x.pkey, digest=x.digest, n_convs=x.n, n_children=x.children, n_leaves=x.leaves,
                          saved_tokens=x.saved, size=x.size, split=x.split)


def _matrix(blobs: list[bytes], convs: np.ndarray) -> tuple:
    """Sorted rows as (order, lengths, ids, sizes): column 0 is the root of all."""
    lengths = np.array([len(b) // RECORD for b in blobs]) + 1
    cells = np.frombuffer(b"".join(blobs), dtype=">u8").reshape(-1, RECORD // 8)
    width = int(lengths.max())
    here = np.arange(width)[None, :] < lengths[:, None]
    here[:, 0] = False
    ids = np.zeros((len(blobs), width), dtype=np.int64)  # 0 pads and comes first
    sizes = np.zeros((len(blobs), width), dtype=np.int64)
    if len(cells):
        by = np.lexsort((cells[:, 1], cells[:, 0]))
        new = np.ones(len(by), dtype=np.int64)
        new[1:] = (cells[by[1:], :2] != cells[by[:-1], :2]).any(axis=1)
        numbers = np.empty(len(by), dtype=np.int64)
        numbers[by] = np.cumsum(new)
        ids[here], sizes[here] = numbers, cells[:, 2].astype(np.int64)
    ids[:, 0] = 1
    order = np.lexsort((convs, *ids.T[::-1]))
    return order, lengths[order], ids[order], sizes[order]


def _chunk(blobs: list[bytes], convs: np.ndarray, rows: _Rows) -> list[_Node]:
    """Writes the chunk's inner nodes; returns its chains in pre-order."""
    order, lengths, ids, sizes = _matrix(blobs, convs)
    convs, blobs = convs[order], [blobs[k] for k in order]
    n, width = ids.shape
    changed = np.ones((n, width), dtype=bool)
    changed[1:] = np.logical_or.accumulate(ids[1:] != ids[:-1], axis=1)
    starts = changed & (np.arange(width)[None, :] < lengths[:, None])
    runs = [np.flatnonzero(changed[:, d]) for d in range(width)]
    row = [r[starts[r, d]] for d, r in enumerate(runs)]  # first rows of the nodes at each depth
    stop, least, members, closing = [], [], [], []
    for d, r in enumerate(runs):
        real = starts[r, d]
        ends = np.append(r[1:], n)
        stop.append(ends[real])
        members.append((ends - r)[real])
        least.append(np.minimum.reduceat(convs, r)[real])
        closing.append(np.add.reduceat((lengths == d + 1).astype(np.int64), r)[real])
    chain = [np.zeros(len(r), dtype=bool) for r in row]  # on the first or the last row's path
    for d in range(width):
        chain[d][:1] = lengths[0] > d
        if lengths[-1] > d:
            chain[d][-1] = True
    # what starts at each row, without the chains: nodes, leaves, saved
    kids = [np.append(np.searchsorted(row[d + 1][~chain[d + 1]], np.arange(n)), (~chain[d + 1]).sum())
            if d + 1 < width else np.zeros(n + 1, dtype=np.int64) for d in range(width)]
    saves = np.zeros((n, width), dtype=np.int64)
    leaf = np.zeros((n, width), dtype=bool)
    for d in range(width):
        inner = ~chain[d]
        at = row[d][inner]
        saves[at, d] = (members[d][inner] - 1) * sizes[at, d]
        leaf[at, d] = closing[d][inner] == members[d][inner]
    below = saves[:, ::-1].cumsum(axis=1)[:, ::-1]
    saved_to = np.concatenate([[0], below[:, 0].cumsum()])
    leaves_to = np.concatenate([[0], leaf.sum(axis=1).cumsum()])

    def subtree(d: int, k) -> tuple:
        a, b = row[d][k], stop[d][k]
        children = kids[d][b] - kids[d][a]
        saved = below[a, d] + saved_to[b] - saved_to[a + 1]
        return children, leaves_to[b] - leaves_to[a], saved

    def ends_of(d: int, k: int) -> bytes:
        a, c = int(row[d][k]), int(closing[d][k])  # those that end here come first
        return ",".join(map(str, convs[a:a + c].tolist())).encode()

    def keys(blob: bytes) -> list[bytes]:
        h, out = hashlib.sha256(), []
        for a in range(-RECORD, len(blob), RECORD):
            h.update(blob[a:a + 16] if a >= 0 else b"")
            out.append(h.digest()[:16])
        return out

    empty = hashlib.sha256(b"").hexdigest().encode()
    path = {0: keys(blobs[0]), -1: keys(blobs[-1])}
    for d in range(1, width):
        inner = np.flatnonzero(~chain[d])
        if not len(inner):
            continue
        children, leaves, saved = subtree(d, inner)
        # the parent: the node one depth up that holds the row
        up = np.searchsorted(row[d - 1], row[d][inner], side="right") - 1
        on = chain[d - 1][up]
        of_first = (up == 0) & (lengths[0] > d - 1)
        known = least[d - 1][up]
        lists = rows.lists
        for j, k in enumerate(inner.tolist()):
            own = ends_of(d, k)
            lists["kind"].append("node")
            lists["conv_id"].append(int(least[d][k]))
            lists["depth"].append(d)
            lists["pkey"].append(path[0 if of_first[j] else -1][d - 1] if on[j] else None)
            lists["seq"].append(None if on[j] else int(known[j]))
            lists["n_convs"].append(int(members[d][k]))
            lists["n_children"].append(int(children[j]))
            lists["n_leaves"].append(int(leaves[j]))
            lists["saved_tokens"].append(int(saved[j]))
            lists["ids"].append(hashlib.sha256(own).hexdigest().encode() if own else empty)
            lists["split"].append(False)
        for name in ("shard", "key", "digest", "size"):
            lists[name].extend([None] * len(inner))

    def node(d: int, k: int, end: int, under: list[tuple[int, int]]) -> _Node:
        children, leaves, saved = subtree(d, k)
        for e, j in under:  # what its chain children bring to it themselves
            _, less, spared = subtree(e, j)
            leaves, saved = leaves - less, saved - spared
        blob = blobs[end]
        return _Node(d, blob[RECORD * (d - 1):RECORD * (d - 1) + 16] if d else b"", path[end][d],
                     path[end][d - 1] if d else None, int(members[d][k]), int(least[d][k]), int(children),
                     int(leaves), int(saved), int(sizes[row[d][k], d]), ends_of(d, k), False, False)

    first, last = int(lengths[0]), int(lengths[-1])
    same = 0  # depths at which both paths are one
    while same < min(first, last) and stop[same][0] == n:
        same += 1
    out = []
    for d in range(first):
        under = [(d + 1, 0)] if d + 1 < first else []
        if d == same - 1 and same < last:
            under.append((same, len(row[same]) - 1))
        out.append(node(d, 0, 0, under))
    for d in range(same, last):
        out.append(node(d, len(row[d]) - 1, -1, [(d + 1, len(row[d + 1]) - 1)] if d + 1 < last else []))
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Consecutive rows whose padded matrix has at most CELLS cells."""
    for batch in batches:
        blobs, convs = batch.column(1).to_pylist(), batch.column(0).to_numpy()
        at, widest = 0, 1
        for k, blob in enumerate(blobs):
            wide = max(widest, len(blob) // RECORD + 1)
            if k > at and wide * (k - at + 1) > CELLS:
                yield blobs[at:k], convs[at:k]
                at, wide = k, len(blob) // RECORD + 1
            widest = wide
        if len(blobs) > at:
            yield blobs[at:], convs[at:]


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, merge = _Rows(), None
    for blobs, convs in _chunks(batches):
        merge = merge or _Merge(rows, TaskContext.get().partitionId(), False)
        for x in _chunk(blobs, convs, rows):
            merge.push(x)
        if len(rows) > 5000:
            yield rows.batch()
    if merge:
        merge.end()
        yield rows.batch()


def _join_ranges(whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, merge = _Rows(), None
        for batch in batches:
            for r in batch.to_pylist():
                group = r["shard"] // FAN
                if merge is None or merge.shard != group:
                    if merge:
                        merge.end()
                    merge = _Merge(rows, group, whole)
                merge.push(_Node(r["depth"], r["digest"], r["key"], r["pkey"], r["n_convs"], r["conv_id"],
                                 r["n_children"], r["n_leaves"], r["saved_tokens"], r["size"], b"",
                                 r["split"], False))
            if len(rows) > 5000:
                yield rows.batch()
        if merge:
            merge.end()
            yield rows.batch()

    return run


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each key's pieces in order, a piece at a time."""
    def done(key, h):
        return pa.RecordBatch.from_pydict({"ends_key": [key], "ends": [h.hexdigest()]},
                                          schema=pa.schema([("ends_key", pa.binary()), ("ends", pa.string())]))

    key, h = None, None
    for batch in batches:
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if k == key:
                h.update(b",")
            else:
                if h:
                    yield done(key, h)
                key, h = k, hashlib.sha256()
            h.update(ids)
    if h:
        yield done(key, h)


def trie(convs: DataFrame) -> DataFrame:
    """Nodes of the trie over ``convs`` (conv_id unique, turns: array of records).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256); a conversation without turns is a member of the root alone, and no
    conversation gives no node, not even a root. A task holds one chunk's matrix and
    the open path, so equal conversations and common prefixes may be any number; a
    single conversation's records (24 bytes a turn) must fit in a task. A hash runs
    over ids in order: a large group's ids are read in pieces by one task, which holds
    one piece.
    """
    rows = written(convs.select("conv_id", F.array_join("turns", "").alias("s")), "sequences")
    ranged = (rows.repartitionByRange("s", "conv_id").sortWithinPartitions("s", "conv_id")
              .select("conv_id", F.unhex("s").alias("blob")))
    out = written(ranged.mapInArrow(_ranges, OUT), "trie")
    parts, chains = [out], out.where("kind = 'chain'")
    while True:
        shards = chains.agg(F.max("shard").alias("m")).first()["m"]
        if shards is None:
            break
        group = F.floor(F.col("shard") / FAN).cast("int")
        chains = chains.repartition(group).sortWithinPartitions("shard", "seq")
        if shards < FAN:
            parts.append(written(chains.mapInArrow(_join_ranges(True), OUT), "trie"))
            break
        # a task may hold several groups; shards, and so groups, come in order
        out = written(chains.mapInArrow(_join_ranges(False), OUT), "trie")
        parts.append(out)
        chains = out.where("kind = 'chain'")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    nodes = every.where("kind = 'node'")
    pieces = (every.where("kind = 'ids'").select("key", "seq", "ids").repartition("key")
              .sortWithinPartitions("key", "seq").mapInArrow(_hash_ids, "ends_key binary, ends string"))
    parents = nodes.where("key is not null").select(F.col("key").alias("up_key"), F.col("conv_id").alias("up"))
    if parents.count() <= SMALL_PARENTS:
        parents = F.broadcast(parents)
    return (nodes.join(parents, F.col("pkey") == F.col("up_key"), "left")
            .join(pieces, F.when(F.col("split"), F.col("key")) == F.col("ends_key"), "left")
            .select("conv_id", F.col("depth").cast("long").alias("depth"),
                    F.coalesce("up", "seq").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                    "saved_tokens", F.coalesce("ends", F.col("ids").cast("string")).alias("ends_sha256")))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie over ``turns`` (conv_id, turn, role, text) as they are.

    Null role or text counts as empty, a null turn comes first, rows without conv_id
    are left out, repeated rows are turns of their own; other columns are ignored.
    """
    return trie(sequences(turns))


def op12_prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie over the rebuilt conversations; odd input as in ``conversation_trie``."""
    return trie(rebuilt(written(sequences(turns), "conversations")))


ORACLE = r"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256)))
), own AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id,
         list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST,
              sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS w
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1
), hashed AS (
  SELECT conv_id, w, xor(list_reduce(list_prepend(4294967295, list_transform(
           string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
         lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 9 AS h
  FROM own, crc_table
), built AS (
  SELECT a.conv_id, list_concat(coalesce(b.w[1:a.h], []), a.w[a.h + 1:]) AS w
  FROM hashed a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5
), prefixes AS (
  SELECT conv_id, d AS depth, len(w) AS n, CAST(w[1:d] AS VARCHAR) || md5(CAST(w[1:d] AS VARCHAR)) AS p,
         CASE WHEN d > 0 THEN CAST(w[1:d - 1] AS VARCHAR) || md5(CAST(w[1:d - 1] AS VARCHAR)) END AS up,
         CASE WHEN d > 0 THEN strlen(w[d].t) ELSE 0 END AS bytes
  FROM (SELECT conv_id, w, unnest(range(0, len(w) + 1)) AS d FROM built)
), nodes AS (
  SELECT depth, p, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         bool_and(n = depth) AS leaf,
         sha256(coalesce(string_agg(CASE WHEN n = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS e
  FROM prefixes GROUP BY depth, p
), sums AS (
  SELECT a.depth, a.p, count(*) FILTER (WHERE x.leaf) AS n_leaves, sum((x.n_convs - 1) * x.bytes) AS saved
  FROM nodes x JOIN prefixes a ON a.conv_id = x.conv_id AND a.depth <= x.depth GROUP BY a.depth, a.p
), kids AS (
  SELECT depth - 1 AS depth, up AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs,
       coalesce(k.n, 0) AS n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.e AS ends_sha256
FROM nodes n JOIN sums s USING (depth, p) LEFT JOIN kids k USING (depth, p)
LEFT JOIN nodes u ON u.p = n.up AND u.depth = n.depth - 1
"""
