import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from innspark.llm import prefix_trie as T

SCHEMA = ("conv_id long, turn long, role string, text string, key string, kind string, seq string, s string, "
          "turns string, base string, depth int, record string")


def brute(rows, rebuild=True):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [x[2] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9 if rebuild else 0
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(built[c]) == len(p))))
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(children[p]),
                    leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(seed, n=300, copies=60):
    rng = random.Random(seed)
    rows = []
    for c in range(-20, n):
        for t in range(rng.choice((0, 1, 2, 3, 5, 8, 12))):
            rows.append((c, t if t else None, rng.choice(("user", "assistant", None)), rng.choice(("a", "é ñ", "", None, "bb"))))
    for c in range(n, n + copies):  # a large group of equal conversations
        rows += [(c, t, "user", f"turn {t}") for t in range(10)]
    rows += [(9999, t, "user", "a") for t in range(150)]
    rows += [(None, 1, "user", "a"), (12, 3, "user", "tie"), (12, 3, "user", "other"), (12, 3, "user", "tie")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x", "x", 1, "x") for r in rows], SCHEMA)


def result(df):
    return sorted((tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                        "saved_tokens", "ends_sha256")) for r in df.collect()), key=str)


def test_rebuilt_against_brute_force(spark):
    rows = rows_of(1)
    assert result(T.op12_prefix_trie(frame(spark, rows))) == brute(rows)


@pytest.mark.parametrize("seed", (2, 3))
def test_as_they_are(spark, seed):
    rows = rows_of(seed, 80)
    assert result(T.conversation_trie(frame(spark, rows))) == brute(rows, False)


def test_sizes_change_nothing(spark):
    """Small chunks, several merge levels and ids in pieces: in this process, where the
    sizes can be set (a task's worker has its own copy of the module)."""
    import pyarrow as pa

    rows = rows_of(4, 120, 200)
    want = brute(rows, False)
    seqs = sorted((bytes.fromhex("".join(r.turns)), r.conv_id) for r in T.sequences(frame(spark, rows)).collect())
    was = T.CELLS, T.FAN, T.IDS_BYTES
    try:
        T.CELLS, T.FAN, T.IDS_BYTES = 40, 3, 12
        for cut in (1, 7, 50):
            out, chains = [], []

            def keep(batch):
                for r in batch.to_pylist():
                    (chains if r["kind"] == "chain" else out).append(r)

            for shard, a in enumerate(range(0, len(seqs), cut)):
                part = seqs[a:a + cut]
                got, merge = T._Rows(), None
                for blobs, convs in T._chunks(iter([pa.RecordBatch.from_pydict(
                        {"conv_id": [c for _, c in part], "blob": [b for b, _ in part]})])):
                    merge = merge or T._Merge(got, shard, False)
                    for x in T._chunk(blobs, convs, got):
                        merge.push(x)
                merge.end()
                keep(got.batch())
            while chains:
                chains.sort(key=lambda r: (r["shard"], r["seq"]))
                whole, given = max(r["shard"] for r in chains) < T.FAN, pa.RecordBatch.from_pylist(chains, schema=T.ARROW)
                chains = []
                for batch in T._join_ranges(whole)(iter([given])):
                    keep(batch)
            pieces = sorted((r for r in out if r["kind"] == "ids"), key=lambda r: (r["key"], r["seq"]))
            ends = {}
            for batch in T._hash_ids(iter([pa.RecordBatch.from_pydict(
                    {k: [r[k] for r in pieces] for k in ("key", "seq", "ids")})])):
                ends |= {r["ends_key"]: r["ends"] for r in batch.to_pylist()}
            nodes = [r for r in out if r["kind"] == "node"]
            up = {r["key"]: r["conv_id"] for r in nodes if r["key"]}
            got = sorted(((r["conv_id"], r["depth"], up[r["pkey"]] if r["pkey"] else r["seq"], r["n_convs"],
                           r["n_children"], r["n_leaves"], r["saved_tokens"],
                           ends[r["key"]] if r["split"] else r["ids"].decode()) for r in nodes), key=str)
            assert got == want
            assert any(r["split"] for r in nodes)
    finally:
        T.CELLS, T.FAN, T.IDS_BYTES = was


def test_empty_and_turnless(spark):
    assert result(T.op12_prefix_trie(frame(spark, []))) == []
    rows = [(6, k, "user", "a") for k in range(zlib.crc32(b"6") % 9)]  # its base is absent
    assert rows and result(T.op12_prefix_trie(frame(spark, rows))) == brute(rows)
    assert brute(rows)[0][1:4] == (0, None, 1)
